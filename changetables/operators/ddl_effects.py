"""What DDL statements do to data that is already there."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changetables.functions.ddl import parse_table
from changetables.plans.asof import SMALL_LOOKUP, asof_lookup
from changetables.plans.chase import resolve_roots
from changetables.schema import SEGMENT_BYTES, before_all, order_key, segment_key
from changetables.session import fits, materialise

TABLE = ["schema_name", "table_name"]


def ddl_effects(ddl: DataFrame) -> DataFrame:
    """One row per effect of the statements in ``ddl`` (see ``with_ddl``).

    Columns: position (``ordinal`` counts inside the statement), ``action`` (erase,
    rename, erase_database), the table, and for renames ``to_schema``, ``to_table``.
    Statements without effect on existing rows give none, nor do those on temporary tables.
    """
    tokens, targets = F.col("tokens"), F.col("targets")
    first = F.upper(F.get(tokens, F.lit(0)))
    session = F.coalesce("schema_name", F.lit(""))
    # RENAME starts the first or a later clause of an ALTER
    clauses = F.filter(
        F.when(F.size(tokens) > 4, F.sequence(F.lit(3), F.size(tokens) - 2)),
        lambda i: (F.upper(F.get(tokens, i)) == "RENAME")
        & ((i == 3) | F.get(tokens, i - 1).endswith(","))
        & ~F.upper(F.get(tokens, i + 1)).isin("COLUMN", "INDEX", "KEY"),
    )
    at = F.get(clauses, F.lit(0))
    next_word = F.get(tokens, at + 1)
    named = F.when(F.upper(next_word).isin("TO", "AS"), F.get(tokens, at + 2)).otherwise(next_word)
    new_name = parse_table(F.coalesce(named, F.lit("")))

    def effect(action: str, schema: Column, table: Column, to_schema=None, to_table=None) -> Column:
        none = F.lit(None).cast("string")
        return F.struct(
            F.lit(action).alias("action"),
            schema.alias("schema_name"),
            table.alias("table_name"),
            (none if to_schema is None else to_schema).alias("to_schema"),
            (none if to_table is None else to_table).alias("to_table"),
        )

    erased = F.transform(targets, lambda t: effect("erase", t["schema"], t["table"]))
    pairs = F.floor(F.size(targets) / F.lit(2)).cast("int")
    renamed = F.transform(
        F.when(pairs > 0, F.sequence(F.lit(0), pairs - 1)),
        lambda i: effect(
            "rename",
            F.get(targets, i * 2)["schema"],
            F.get(targets, i * 2)["table"],
            F.get(targets, i * 2 + 1)["schema"],
            F.get(targets, i * 2 + 1)["table"],
        ),
    )
    alter_rename = F.transform(
        targets,
        lambda t: effect(
            "rename",
            t["schema"],
            t["table"],
            F.when(new_name["schema"] != "", new_name["schema"]).otherwise(session),
            new_name["table"],
        ),
    )
    is_alter_rename = (first == "ALTER") & at.isNotNull()
    is_temporary = F.coalesce(F.upper(F.get(tokens, F.lit(1))) == "TEMPORARY", F.lit(False))
    found = (
        F.when((first == "TRUNCATE") | ((first == "DROP") & F.col("ddl_database").isNull() & ~is_temporary), erased)
        .when(
            (first == "DROP") & F.col("ddl_database").isNotNull(),
            F.array(effect("erase_database", F.col("ddl_database"), F.lit(None).cast("string"))),
        )
        .when(first == "RENAME", renamed)
        .when(is_alter_rename, alter_rename)
    )
    return ddl.select("file_seq", "pos", F.posexplode(found).alias("ordinal", "e")).select(
        "file_seq", "pos", "ordinal", "e.*"
    )


def apply_ddl_epochs(
    changes: DataFrame,
    effects: DataFrame,
    segment_bytes: int = SEGMENT_BYTES,
    small: int = SMALL_LOOKUP,
    base: DataFrame | None = None,
) -> DataFrame:
    """Changes that survive the DDL, with ``final_schema`` and ``final_table``.

    ``base`` holds rows of all tables (``schema_name``, ``table_name`` and any columns of
    the log) that were there before the log starts. They are subject to every statement,
    and come along as rows before the first position, with ``is_base``.

    A change stays with its table until the table's next TRUNCATE, DROP or RENAME; a
    rename hands it on to the new name, whose own later DDL decides further. This is
    the same successor structure as in exact replay, with table names for values. A
    database that is dropped erases every table the log knows in it.
    """
    if base is not None:
        before = before_all()
        first = {"file_seq": before["file_seq"], "pos": before["pos"], "ordinal": before["ordinal"]}
        start = base.withColumns({**first, "is_base": F.lit(True)})
        changes = changes.withColumn("is_base", F.lit(False)).unionByName(start, allowMissingColumns=True)
    # the effects are read several times below; their texts are classified once
    effects = materialise(effects, "ddl")
    steps = _placed(effects.filter("action <> 'erase_database'"), segment_bytes)
    lookup = steps.select(*TABLE, "at", "segment", "__next")
    drops = effects.filter("action = 'erase_database' and schema_name is not null")
    drops = None if drops.isEmpty() else _placed(drops, segment_bytes).select("schema_name", "at", "segment", "__next")

    renames = steps.filter("action = 'rename'").select(
        "at",
        "segment",
        F.col("to_schema").alias("schema_name"),
        F.col("to_table").alias("table_name"),
    )
    found = _next_step(renames, lookup, drops, small)
    links = materialise(found.select("at", "__next"), "renames")
    roots = resolve_roots(
        links.select(
            F.col("at").alias("id"),
            F.col("__next.at").alias("next"),
            F.col("__next.erases").alias("next_erases"),
        )
    )
    names = (
        renames.withColumnRenamed("at", "root")
        .join(roots, "root")
        .select(
            F.col("id").alias("__id"),
            F.col("schema_name").alias("final_schema"),
            F.col("table_name").alias("final_table"),
        )
    )
    keyed = changes.withColumns({"at": order_key(), "segment": segment_key(segment_bytes)})
    taken = _next_step(keyed, lookup, drops, small)
    if fits(names, small):
        names = F.broadcast(names)
    kept = taken.filter(~F.coalesce(F.col("__next.erases"), F.lit(False)))
    # a change without later DDL takes its own position, which no DDL shares, so such
    # changes spread over the join instead of meeting under one NULL
    named = kept.join(names, F.coalesce("__next.at", "at") == F.col("__id"), "left")
    survives = F.col("__next").isNull() | F.col("__id").isNotNull()
    return named.filter(survives).select(
        *changes.columns,
        F.coalesce("final_schema", "schema_name").alias("final_schema"),
        F.coalesce("final_table", "table_name").alias("final_table"),
    )


def _placed(effects: DataFrame, segment_bytes: int) -> DataFrame:
    """Effects by position; ``__next`` is what a row before them meets."""
    return effects.withColumns({"at": order_key(), "segment": segment_key(segment_bytes)}).withColumn(
        "__next", F.struct("at", (F.col("action") != "rename").alias("erases"))
    )


def _next_step(rows: DataFrame, lookup: DataFrame, drops: DataFrame | None, small: int) -> DataFrame:
    """Add ``__next``: the next step of the row's own table, or of its database if that is sooner.

    A dropped database is looked up as such, so a drop stays one row however many tables
    it erases.
    """
    found = asof_lookup(rows, lookup, TABLE, "at", "segment", "__next", "next", small)
    if drops is None:
        return found
    drops = drops.withColumnRenamed("__next", "__drop")
    both = asof_lookup(found, drops, ["schema_name"], "at", "segment", "__drop", "next", small)
    return both.withColumn("__next", F.least("__next", "__drop")).drop("__drop")


def evolve_schema(rows: DataFrame, steps: Iterable[Mapping]) -> DataFrame:
    """Apply structured schema changes to a table, in order.

    Steps read ``{"action": "add", "column": …, "type": …, "default": …}``,
    ``{"action": "drop", "column": …}``, ``{"action": "rename", "column": …, "to": …}``
    or ``{"action": "modify", "column": …, "type": …}``; a value that does not fit a
    modified type becomes NULL.
    """
    for step in steps:
        action, column = step["action"], step["column"]
        if action == "add":
            value = F.lit(step.get("default")).cast(step["type"])
            rows = rows.withColumn(column, value)
        elif action == "drop":
            rows = rows.drop(column)
        elif action == "rename":
            rows = rows.withColumnsRenamed({column: step["to"]})
        elif action == "modify":
            rows = rows.withColumn(column, F.col(column).try_cast(step["type"]))
        else:
            raise ValueError(f"unknown schema change {action!r}")
    return rows


def union_epochs(epochs: Iterable[DataFrame]) -> DataFrame:
    """Rows written under different schemas as one table; absent columns are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), epochs)


def evolve_images(
    image: Column, at: Column, steps: Iterable[Mapping]
) -> Column:
    """A name/value image in terms of the final schema.

    Every step carries its position ``at`` (file_seq, pos); images logged before it
    are carried over it: renamed entries change name, dropped ones go, added ones
    take the default.
    """
    steps = list(steps)
    unknown = [s["action"] for s in steps if s["action"] not in ("rename", "drop", "add", "modify")]
    if unknown:
        raise ValueError(f"unknown schema change {unknown[0]!r}")
    if not steps:
        return image

    def text(value: object) -> Column:
        return F.lit(value).cast("string")

    rows = F.array(
        *(
            F.struct(
                F.struct(*[F.lit(x).cast("long") for x in s["at"]]).alias("at"),
                text(s["action"]).alias("action"),
                text(s["column"]).alias("column"),
                text(s.get("to")).alias("to"),
                text(s.get("type")).alias("type"),
                text(s.get("default")).alias("default"),
            )
            for s in steps
        )
    )
    kinds = sorted({s["type"] for s in steps if s["action"] == "modify"})

    def carried(held: Column, step: Column) -> Column:
        # one branch per kind of step, however many steps there are
        column, action = step["column"], step["action"]
        return (
            F.when(at >= step["at"], held)
            .when(action == "rename", F.transform_keys(held, lambda k, _: F.when(k == column, step["to"]).otherwise(k)))
            .when(action == "drop", F.map_filter(held, lambda k, _: k != column))
            .when(action == "add", F.map_concat(held, F.create_map(column, step["default"])))
            .otherwise(F.transform_values(held, lambda k, v: F.when(k == column, _modified(v, step["type"], kinds)).otherwise(v)))
        )

    return F.aggregate(rows, image.cast("map<string,string>"), carried)


#: A table of schema changes: whose, where in the log, and what.
STEP_FIELDS = (
    "schema_name string, table_name string, file_seq long, pos long, ordinal int, action string, "
    "`column` string, `to` string, type string, `default` string"
)

_ACTIONS = ("add", "drop", "rename", "modify")

#: What became of a column: the name it had (NULL if it was added), the name it has (NULL if
#: it was dropped), its default and the types it went through.
_FATES = "array<struct<origin:string,name:string,default:string,casts:array<string>>>"

#: Names of the types of ``modify`` steps. The engine's own types, decimals of every
#: precision and scale included, are fewer.
MAX_TYPES = 2_000


def schema_epochs(steps: DataFrame) -> DataFrame:
    """What each step and all later ones of its table make of an image logged before it.

    ``steps`` has STEP_FIELDS. Every step starts an epoch; its ``plan`` says where columns
    that the steps name have gone to (``moves``: old name -> new name and types on the way)
    and which come new (``adds``). Images of one epoch share a plan, so no image walks the
    steps. Steps of one table are gathered in one place, data is not.
    """
    at = order_key()
    action = F.when(F.col("action").isin(*_ACTIONS), F.col("action")).otherwise(
        F.raise_error(F.concat(F.lit("unknown schema change "), F.coalesce("action", F.lit("NULL"))))
    )
    kind = F.lower(F.trim("type"))
    marked = steps.select(
        *TABLE,
        at.alias("__at"),
        segment_key(SEGMENT_BYTES).alias("__segment"),
        F.struct(action.alias("action"), "column", "to", kind.alias("type"), "default").alias("step"),
    )
    onwards = Window.partitionBy(*TABLE).orderBy(F.desc("__at")).rowsBetween(Window.unboundedPreceding, 0)
    rest = marked.withColumn("__rest", F.reverse(F.collect_list("step").over(onwards)))
    fates = F.aggregate("__rest", F.array().cast(_FATES), _fates_after)
    named = lambda f: F.struct(
        f["origin"].alias("key"), F.struct(f["name"].alias("name"), f["casts"].alias("casts")).alias("value")
    )
    old = F.filter("__fates", lambda f: f["origin"].isNotNull())
    new = F.filter("__fates", lambda f: f["origin"].isNull() & f["name"].isNotNull())
    plan = F.struct(F.map_from_entries(F.transform(old, named)).alias("moves"), new.alias("adds"))
    return rest.withColumn("__fates", fates).select(*TABLE, "__at", "__segment", plan.alias("plan"))


def _fates_after(fates: Column, step: Column) -> Column:
    column, action = step["column"], step["action"]
    none = F.lit(None).cast("string")

    def fate(origin: Column, name: Column, default: Column, casts: Column) -> Column:
        return F.struct(origin.alias("origin"), name.alias("name"), default.alias("default"), casts.alias("casts"))

    no_casts = F.array().cast("array<string>")
    # a name that no step has touched yet is the image's own
    touched = F.exists(fates, lambda f: f["name"].eqNullSafe(column) | f["origin"].eqNullSafe(column))
    opened = F.when(touched, fates).otherwise(F.concat(fates, F.array(fate(column, column, none, no_casts))))

    def moved(f: Column) -> Column:
        name = F.when(action == "rename", step["to"]).when(action == "drop", none).otherwise(f["name"])
        casts = F.when(action == "modify", F.concat(f["casts"], F.array(step["type"]))).otherwise(f["casts"])
        return F.when(f["name"].eqNullSafe(column), fate(f["origin"], name, f["default"], casts)).otherwise(f)

    added = F.concat(fates, F.array(fate(none, column, step["default"], no_casts)))
    return F.when(action == "add", added).otherwise(F.transform(opened, moved))


def evolve_by_log(
    changes: DataFrame, steps: DataFrame, sides: Iterable[str] = ("before", "after"), small: int = SMALL_LOOKUP
) -> DataFrame:
    """Name/value images of many tables in terms of each table's final schema.

    ``steps`` is a table of schema changes (STEP_FIELDS, positions unique within a table) and
    may be as long as the log has DDL. An image takes the plan of the first step of its own
    table after it, by an as-of lookup. Steps on columns that an image lacks do nothing; an
    added column that it has keeps its value. Partial images (``<side>_present`` not NULL)
    follow renames, drops and types, but get no defaults. NULL images stay NULL.
    """
    kinds = _types_of(steps)
    epochs = materialise(schema_epochs(steps), "epochs").withColumnRenamed("plan", "__plan")
    keyed = changes.withColumns({"__at": order_key(), "__segment": segment_key(SEGMENT_BYTES)})
    placed = asof_lookup(keyed, epochs, TABLE, "__at", "__segment", "__plan", "next", small)
    plan, evolved = F.col("__plan"), {}
    for side in sides:
        present = f"{side}_present"
        is_whole = F.lit(True)
        if present in changes.columns:
            is_whole = F.col(present).isNull()
            names = F.transform(F.col(present), lambda n: _move_of(plan, n)["name"])
            evolved[present] = F.when(plan.isNull(), F.col(present)).otherwise(F.filter(names, lambda n: n.isNotNull()))
        evolved[side] = _evolved(F.col(side), plan, is_whole, kinds)
    return placed.withColumns(evolved).select(*changes.columns)


def _types_of(steps: DataFrame) -> list[str]:
    named = steps.filter("action = 'modify' and type is not null").select(F.lower(F.trim("type")).alias("kind"))
    kinds = [r.kind for r in named.distinct().limit(MAX_TYPES + 1).collect()]
    if len(kinds) > MAX_TYPES:
        raise ValueError(f"more than {MAX_TYPES} types in schema changes")
    return sorted(kinds)


def _move_of(plan: Column, name: Column) -> Column:
    """Where a column has gone to; columns that no step names stay."""
    own = F.struct(name.alias("name"), F.array().cast("array<string>").alias("casts"))
    return F.coalesce(F.try_element_at(plan["moves"], name), own)


def _evolved(image: Column, plan: Column, is_whole: Column, kinds: list[str]) -> Column:
    def through(value: Column, casts: Column) -> Column:
        return F.aggregate(casts, value.cast("string"), lambda v, kind: _modified(v, kind, kinds))

    def pair(name: Column, value: Column) -> Column:
        return F.struct(name.alias("key"), value.alias("value"))

    def moved(entry: Column) -> Column:
        move = _move_of(plan, entry["key"])
        return pair(move["name"], through(entry["value"], move["casts"]))

    kept = F.filter(F.transform(F.map_entries(image.cast("map<string,string>")), moved), lambda e: e["key"].isNotNull())
    lacking = F.filter(plan["adds"], lambda a: is_whole & ~F.exists(kept, lambda e: e["key"] == a["name"]))
    added = F.transform(lacking, lambda a: pair(a["name"], through(a["default"], a["casts"])))
    return F.when(plan.isNull(), image).otherwise(F.map_from_entries(F.concat(kept, added)))


def _modified(value: Column, kind: Column, kinds: Iterable[str]) -> Column:
    """A value's text after a change of type; NULL if it does not fit."""
    out = value
    for name in kinds:
        out = F.when(kind == name, value.try_cast(name).cast("string")).otherwise(out)
    return out


def evolved_type(fields: T.StructType, steps: Iterable[Mapping]) -> T.StructType:
    """The schema after ``steps``, for typing evolved images."""
    kinds = {f.name: f.dataType for f in fields}
    for step in steps:
        action, column = step["action"], step["column"]
        if action in ("add", "modify"):
            kinds[column] = T.DataType.fromDDL(step["type"])
        elif action == "drop":
            kinds.pop(column)
        elif action == "rename":
            kinds = {step["to"] if n == column else n: t for n, t in kinds.items()}
    return T.StructType([T.StructField(n, t) for n, t in kinds.items()])
