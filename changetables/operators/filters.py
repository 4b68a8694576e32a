"""Which databases and tables are replicated."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changetables.functions.text import trim_space

#: Above this many entries the lists are joined instead of written into the filter.
LARGE_LIST = 1_000


def _names(entries: Iterable[str]) -> tuple[str, ...]:
    return tuple(sorted({e.strip() for e in entries if e.strip()}))


class TableFilter:
    """Allow and deny lists of databases and tables, case-sensitive.

    Table entries read ``table`` or ``db.table``. A deny entry always wins. With any
    allow entry at all, a table passes if its database or the table is listed; the
    two allow lists widen each other. No entries allow everything.

    ``clean_names`` says that names in the log carry no white space around them, so
    the comparisons reach the Parquet scan; otherwise names are trimmed first.
    """

    def __init__(
        self,
        whitelist_dbs: Iterable[str] = (),
        whitelist_tables: Iterable[str] = (),
        blacklist_dbs: Iterable[str] = (),
        blacklist_tables: Iterable[str] = (),
        clean_names: bool = False,
    ):
        self.whitelist_dbs = _names(whitelist_dbs)
        self.whitelist_tables = _names(whitelist_tables)
        self.blacklist_dbs = _names(blacklist_dbs)
        self.blacklist_tables = _names(blacklist_tables)
        self.clean_names = clean_names

    @property
    def size(self) -> int:
        return sum(
            map(len, (self.whitelist_dbs, self.whitelist_tables, self.blacklist_dbs, self.blacklist_tables))
        )

    @property
    def has_whitelist(self) -> bool:
        return bool(self.whitelist_dbs or self.whitelist_tables)

    def allow(self, schema: Column, table: Column) -> Column:
        """Whether the table is replicated; an empty name part matches no entry."""
        if not self.size:
            return F.lit(True)
        if not self.clean_names:
            schema, table = trim_space(schema), trim_space(table)
        allowed = ~_listed(schema, table, self.blacklist_dbs, self.blacklist_tables)
        if self.has_whitelist:
            allowed = allowed & _listed(schema, table, self.whitelist_dbs, self.whitelist_tables)
        return allowed

    def rows(self, log: DataFrame, large: int = LARGE_LIST) -> DataFrame:
        """The row events that pass, by the event's own table."""
        if self.size <= large:
            return log.filter(self.allow(F.col("schema_name"), F.col("table_name")))
        return self._rows_by_join(log)

    def _rows_by_join(self, log: DataFrame) -> DataFrame:
        # the lists are held by the driver, so their size is known and broadcast is safe
        def hits(rows: DataFrame, dbs, tables, flag: str) -> DataFrame:
            spark = rows.sparkSession
            for side, entries in (("__schema", dbs), ("__table", tables), ("__both", tables)):
                listed = spark.createDataFrame(
                    [(e, True) for e in entries], f"{side} string, `{flag}{side}` boolean"
                )
                rows = rows.join(F.broadcast(listed), side, "left")
            found = reduce(
                lambda a, b: a | b,
                [F.coalesce(F.col(f"{flag}{s}"), F.lit(False)) for s in ("__schema", "__table", "__both")],
            )
            return rows.withColumn(flag, found)

        schema, table = F.coalesce("schema_name", F.lit("")), F.coalesce("table_name", F.lit(""))
        if not self.clean_names:
            schema, table = trim_space(schema), trim_space(table)
        rows = log.withColumns({"__schema": schema, "__table": table}).withColumn(
            "__both",
            F.when(
                (F.col("__schema") != "") & (F.col("__table") != ""),
                F.concat_ws(".", "__schema", "__table"),
            ),
        )
        rows = hits(rows, self.blacklist_dbs, self.blacklist_tables, "__black").filter("not __black")
        if self.has_whitelist:
            rows = hits(rows, self.whitelist_dbs, self.whitelist_tables, "__white").filter("__white")
        return rows.select(*log.columns)

    def allow_query(
        self, session_schema: Column, database: Column, tables: Column
    ) -> Column:
        """Whether a query event passes, given what its DDL text names.

        A session schema, if there is one, must pass by itself; so must the database
        the statement creates or drops, and every table it names, where unqualified
        tables take the session schema. Text naming none of these always passes.
        """
        if not self.size:
            return F.lit(True)
        session = F.coalesce(session_schema, F.lit(""))
        no_table = F.lit("")
        session_ok = (session == "") | self.allow(session, no_table)
        database_ok = database.isNull() | self.allow(database, no_table)
        tables_ok = F.forall(
            tables,
            lambda t: self.allow(
                F.when(t["schema"] != "", t["schema"]).otherwise(session), t["table"]
            ),
        )
        return session_ok & F.coalesce(database_ok, F.lit(True)) & tables_ok


def _listed(schema: Column, table: Column, dbs, tables) -> Column:
    # never null, and built from comparisons a Parquet scan understands
    tests = []
    if dbs:
        tests.append(schema.isNotNull() & schema.isin(*dbs))
    if tables:
        tests.append(table.isNotNull() & table.isin(*tables))
        for db, names in _qualified(tables).items():
            both = schema.isNotNull() & table.isNotNull()
            tests.append(both & (schema == db) & table.isin(*names))
    return reduce(lambda a, b: a | b, tests) if tests else F.lit(False)


def _qualified(tables: Iterable[str]) -> dict[str, list[str]]:
    """db -> tables for every way to read an entry as ``db.table``."""
    split: dict[str, list[str]] = {}
    for entry in tables:
        for at, char in enumerate(entry):
            if char == "." and 0 < at < len(entry) - 1:
                split.setdefault(entry[:at], []).append(entry[at + 1 :])
    return split
