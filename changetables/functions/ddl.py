"""Classification of DDL text by its white-space separated words.

The text is not parsed: the first words decide the statement, and identifiers are
taken where the statement form puts them. Everything is a column expression, so a
log of any size is classified in one scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changetables.functions.text import SPACE, blank_to_null, let, trim_space

_TABLE = "struct<schema:string,table:string>"
_TABLES = f"array<{_TABLE}>"


def strip_comments(query: Column) -> Column:
    """Remove comments in front of the statement; an unclosed one leaves nothing."""
    rest = F.regexp_replace(query, r"(?sU)\A(?:\s++|--[^\n]*+\n|/\*.*?\*/)*+", "")
    return let(rest, lambda r: F.when(r.rlike(r"\A(?:--|/\*)"), "").otherwise(trim_space(r)))


def ddl_tokens(query: Column) -> Column:
    """The words of the statement after its leading comments."""
    words = F.split(strip_comments(F.coalesce(query, F.lit(""))), SPACE + "+")
    return F.filter(words, lambda w: w != "")


def clean_identifier(token: Column) -> Column:
    """Drop list punctuation, an opening bracket and back-ticks around a name."""
    name = F.regexp_replace(token, r"\A[,;]+|[,;]+\z", "")
    name = F.regexp_replace(name, r"\(+\z", "")
    name = F.regexp_replace(name, r"\)+\z", "")
    name = F.regexp_replace(name, r"\A[,;]+|[,;]+\z", "")
    return trim_space(F.regexp_replace(name, "`", ""))


def parse_table(token: Column) -> Column:
    """``schema.table`` or ``table``, split at the first dot."""
    return let(clean_identifier(token), _split_name)


def _split_name(name: Column) -> Column:
    dotted = F.contains(name, F.lit("."))
    return F.struct(
        F.when(dotted, F.substring_index(name, ".", 1)).otherwise("").alias("schema"),
        F.when(dotted, F.regexp_replace(name, r"(?s)\A[^.]*\.", "")).otherwise(name).alias("table"),
    )


def _word(tokens: Column, index) -> Column:
    return F.upper(F.get(tokens, index if isinstance(index, Column) else F.lit(index)))


def _after_if_exists(tokens: Column, index: Column) -> Column:
    is_if = _word(tokens, index) == "IF"
    if_not_exists = (
        is_if & (_word(tokens, index + 1) == "NOT") & (_word(tokens, index + 2) == "EXISTS")
    )
    if_exists = is_if & (_word(tokens, index + 1) == "EXISTS")
    return F.when(if_not_exists, index + 3).when(if_exists, index + 2).otherwise(index)


def _one_table(token: Column) -> Column:
    name = F.array(parse_table(F.coalesce(token, F.lit(""))))
    return F.filter(name, lambda t: t["table"] != "")


def _table_list(tokens: Column, index: Column) -> Column:
    rest = F.slice(tokens, index + 1, F.greatest(F.size(tokens) - index, F.lit(0)))
    stops = F.transform(rest, lambda w: F.upper(w).isin("RESTRICT", "CASCADE"))
    names = let(
        F.array_position(stops, True).cast("int"),
        lambda stop: F.when(stop > 0, F.slice(rest, F.lit(1), stop - 1)).otherwise(rest),
    )
    parts = F.flatten(F.transform(names, lambda w: F.split(w, ",")))
    return F.filter(F.transform(parts, parse_table), lambda t: t["table"] != "")


def _rename_pairs(tokens: Column) -> Column:
    """Names of ``a TO b, c TO d``; a name that TO does not follow is passed over."""
    start = F.struct(
        F.lit("name").alias("want"),
        F.lit(None).cast(_TABLE).alias("name"),
        F.array().cast(_TABLES).alias("found"),
    )

    def advance(state: Column, word: Column, table: Column) -> Column:
        usable = table["table"] != ""
        is_new = state["want"] == "new"
        is_to = (state["want"] == "to") & (F.upper(word) == "TO")
        return F.struct(
            F.when(is_new, "name").when(is_to, "new").when(usable, "to").otherwise("name").alias("want"),
            F.when(is_to | is_new, state["name"]).otherwise(table).alias("name"),
            F.when(
                is_new & usable, F.concat(state["found"], F.array(state["name"], table))
            ).otherwise(state["found"]).alias("found"),
        )

    def step(state: Column, word: Column) -> Column:
        return let(parse_table(word), lambda table: advance(state, word, table))

    words = F.slice(tokens, F.lit(3), F.greatest(F.size(tokens) - 2, F.lit(0)))
    return F.aggregate(words, start, step, lambda state: state["found"])


def ddl_tables(tokens: Column) -> Column:
    """Tables a statement names, as ARRAY<STRUCT<schema, table>>; empty if none.

    CREATE [TEMPORARY] TABLE, ALTER TABLE, DROP [TEMPORARY] TABLE list, TRUNCATE
    [TABLE] and RENAME TABLE are known; every other statement names no table.
    """
    first, second = _word(tokens, 0), _word(tokens, 1)
    table_at = F.when(second == "TEMPORARY", F.lit(2)).otherwise(F.lit(1))
    is_table = _word(tokens, table_at) == "TABLE"
    after_table = _after_if_exists(tokens, table_at + 1)
    truncated = F.when(second == "TABLE", F.lit(2)).otherwise(F.lit(1))
    named = (
        F.when((first == "CREATE") & is_table, _one_table(F.get(tokens, after_table)))
        .when((first == "ALTER") & (second == "TABLE"), _one_table(F.get(tokens, F.lit(2))))
        .when((first == "DROP") & is_table, _table_list(tokens, after_table))
        .when(first == "TRUNCATE", _one_table(F.get(tokens, truncated)))
        .when((first == "RENAME") & (second == "TABLE"), _rename_pairs(tokens))
    )
    return F.coalesce(named, F.array().cast(_TABLES))


def ddl_database(tokens: Column) -> Column:
    """Database of CREATE/DROP DATABASE or SCHEMA, null for other statements."""
    known = _word(tokens, 0).isin("CREATE", "DROP") & _word(tokens, 1).isin("DATABASE", "SCHEMA")
    token = F.get(tokens, _after_if_exists(tokens, F.lit(2)))
    return F.when(known, blank_to_null(clean_identifier(token)))


def is_create_database(tokens: Column) -> Column:
    """CREATE DATABASE, but not its synonym CREATE SCHEMA."""
    words = (_word(tokens, 0) == "CREATE") & (_word(tokens, 1) == "DATABASE")
    return F.coalesce(words, F.lit(False))


def enters_schema(session_schema: Column, tokens: Column) -> Column:
    """The session schema is entered before the statement runs."""
    return (F.coalesce(session_schema, F.lit("")) != "") & ~is_create_database(tokens)


def resolve_tables(tables: Column, session_schema: Column) -> Column:
    """Give unqualified tables the session schema."""
    return F.transform(
        tables,
        lambda t: F.struct(
            F.coalesce(blank_to_null(t["schema"]), session_schema, F.lit("")).alias("schema"),
            t["table"].alias("table"),
        ),
    )


def with_ddl(log: DataFrame) -> DataFrame:
    """Add ``tokens``, ``ddl_tables``, ``ddl_database``, ``is_create_database`` and
    ``targets`` (the tables with the session schema filled in)."""
    session = F.col("schema_name")

    def parts(tokens: Column, tables: Column) -> Column:
        return F.struct(
            tokens.alias("tokens"),
            tables.alias("ddl_tables"),
            ddl_database(tokens).alias("ddl_database"),
            is_create_database(tokens).alias("is_create_database"),
            resolve_tables(tables, session).alias("targets"),
        )

    found = let(ddl_tokens(F.col("query")), lambda t: let(ddl_tables(t), lambda n: parts(t, n)))
    return log.select("*", found.alias("__ddl")).select(*log.columns, "__ddl.*")
