"""Tables that a stream of changes keeps up to date: their folders and their state.

A target holds the last action of every key. Fresh batches lie in ``deltas``, one folder
for each attempt, and count once the ledger ``progress`` names them. ``compact`` folds them
into ``state``, which is dealt by a hash of the key to a fixed number of buckets: it
rewrites only the buckets that fresh actions touch, as a new version, and records with it
which version holds each bucket. Readers take the buckets that the last record names, or
only those of the keys they ask for. ``clean`` deletes what no kept record names.

The state of a key is its ``row`` (null if it was removed) and the position ``at`` of its
last action. A target of partial images keeps cells instead: for each column its last value
and position, and ``reset``, the last insert or removal. A cell counts if it is not older
than that insert, so the order in which batches arrive does not matter here either.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changetables.operators.ddl_effects import apply_ddl_epochs
from changetables.schema import ORDER_TYPE, before_all
from changetables.session import delete_path, fits
from changetables.sources.versions import read_or_empty

#: Up to this many changed keys are sent to every executor when they are merged.
SMALL_DELTA = 100_000

AT = T.StructType([T.StructField("at", ORDER_TYPE), T.StructField("sub", T.IntegerType())])
RESET = T.StructType([T.StructField("at", AT), T.StructField("alive", T.BooleanType())])


def cell_of(kind: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("at", AT), T.StructField("v", kind)])


@dataclass(frozen=True)
class Target:
    """A keyed destination table: its folder, key and column types.

    ``partial``: images carry only some columns. ``defaults`` are values for columns that
    an insert lacks. ``buckets`` is fixed when the target is first compacted.
    """

    root: str
    keys: tuple[str, ...]
    fields: T.StructType
    partial: bool = False
    defaults: Mapping[str, object] = field(default_factory=dict)
    buckets: int = 16

    partitions = ()

    @property
    def others(self) -> list[T.StructField]:
        return [f for f in self.fields if f.name not in self.keys]

    @property
    def state_schema(self) -> T.StructType:
        by_name = {f.name: f for f in self.fields}
        held = [T.StructField("row", self.fields)]
        if self.partial:
            cells = T.StructType([T.StructField(f.name, cell_of(f.dataType)) for f in self.others])
            held = [T.StructField("reset", RESET), T.StructField("cells", cells)]
        return T.StructType([by_name[k] for k in self.keys] + held + [T.StructField("at", AT)])


@dataclass(frozen=True)
class TableSet:
    """Many keyed tables of one log under one folder: (schema, table) -> key columns.

    Rows are kept as name/value maps and typed when a table is read, so a batch takes
    one plan and one write for any number of tables. ``epoch`` is the position of the last
    RENAME to or from the table's name before the action.
    """

    root: str
    tables: Mapping[tuple[str, str], Sequence[str]]
    partial: bool = False
    buckets: int = 16

    partitions = ("schema_name", "table_name")
    keys = ("schema_name", "table_name", "epoch", "key")

    @property
    def state_schema(self) -> T.StructType:
        text = T.StringType()
        held = [T.StructField("row", T.MapType(text, text))]
        if self.partial:
            held = [T.StructField("reset", RESET), T.StructField("cells", T.MapType(text, cell_of(text)))]
        return T.StructType(
            [
                T.StructField("schema_name", text),
                T.StructField("table_name", text),
                T.StructField("epoch", ORDER_TYPE),
                T.StructField("key", T.ArrayType(text)),
                *held,
                T.StructField("at", AT),
            ]
        )


#: Positions of one statement's effects on tables, as ``ddl_effects`` gives them.
EFFECTS = (
    "file_seq long, pos long, ordinal int, action string, schema_name string, table_name string, "
    "to_schema string, to_table string"
)
_PROGRESS = "number long, query string, batch long, folder string, file_seq long, pos long, ddl boolean"
#: Folders of what a batch leaves to the next one.
BESIDE = ("held", "commits")
_VERSIONS = "upto long, buckets int, held array<struct<bucket:int,version:string>>"


# -- merging -------------------------------------------------------------------------


def latest(actions: DataFrame, target: Target | TableSet) -> DataFrame:
    """One row per key of several; combines on the map side."""
    keys = list(target.keys)
    if not target.partial:
        return actions.groupBy(*keys).agg(
            F.max_by(F.struct("row"), "at")["row"].alias("row"), F.max("at").alias("at")
        )
    if isinstance(target, Target):
        cells = F.struct(*[F.max(f"cells.`{f.name}`").alias(f.name) for f in target.others])
        return actions.groupBy(*keys).agg(F.max("reset").alias("reset"), cells.alias("cells"), F.max("at").alias("at"))
    heads = actions.select(*keys, "reset", "at", F.lit(None).cast("string").alias("name"), F.lit(None).cast(cell_of(T.StringType())).alias("cell"))
    named = actions.select(*keys, F.explode("cells").alias("name", "cell"))
    by_name = heads.unionByName(named, allowMissingColumns=True).groupBy(*keys, "name").agg(
        F.max("reset").alias("reset"), F.max("at").alias("at"), F.max("cell").alias("cell")
    )
    pair = F.when(F.col("name").isNotNull(), F.struct("name", "cell"))
    return by_name.groupBy(*keys).agg(
        F.max("reset").alias("reset"), F.map_from_entries(F.collect_list(pair)).alias("cells"), F.max("at").alias("at")
    )


def _later(target: Target | TableSet | None) -> list[Column]:
    """The state columns of two sides ``s`` and ``n`` of one key."""
    if target is None or not target.partial:
        is_newer = F.coalesce(F.col("s.at") <= F.col("n.at"), F.col("s.at").isNull())
        return [F.when(is_newer, F.col(f"n.{c}")).otherwise(F.col(f"s.{c}")).alias(c) for c in ("row", "at")]
    if isinstance(target, Target):
        names = [f.name for f in target.others]
        cells = F.struct(*[F.greatest(F.col(f"s.cells.`{n}`"), F.col(f"n.cells.`{n}`")).alias(n) for n in names])
    else:
        zipped = F.map_zip_with("s.cells", "n.cells", lambda _, a, b: F.greatest(a, b))
        cells = F.coalesce(zipped, "s.cells", "n.cells")
    return [
        F.greatest("s.reset", "n.reset").alias("reset"),
        cells.alias("cells"),
        F.greatest("s.at", "n.at").alias("at"),
    ]


def merge_state(
    state: DataFrame,
    fresh: DataFrame,
    keys: Sequence[str],
    small: int = SMALL_DELTA,
    target: Target | TableSet | None = None,
) -> DataFrame:
    """Two sets of per-key actions as one, the later position winning.

    Both sides hold a key once. A newer side counted to be small is broadcast, so the
    older, larger one is scanned without a shuffle; otherwise the two meet in one full
    outer join.
    """
    columns = [F.coalesce(f"s.{k}", f"n.{k}").alias(k) for k in keys] + _later(target)
    same = reduce(lambda a, b: a & b, [F.col(f"s.{k}") == F.col(f"n.{k}") for k in keys])
    if not fits(fresh, small):
        return state.alias("s").join(fresh.alias("n"), same, "full_outer").select(*columns)
    fresh = F.broadcast(fresh)
    updated = state.alias("s").join(fresh.alias("n"), same, "left").select(*columns)
    held = state.select(*keys).join(fresh.select(*keys), list(keys), "left_semi")
    return updated.unionByName(fresh.join(F.broadcast(held), list(keys), "left_anti"))


def live_rows(state: DataFrame, target: Target | TableSet) -> DataFrame:
    """The state's keys that are there, with their ``row``."""
    if not target.partial:
        return state.filter("row is not null")
    alive = state.filter("reset.alive")
    if isinstance(target, Target):
        values = [
            F.col(f.name)
            if f.name in target.keys
            else F.when(F.col(f"cells.`{f.name}`.at") >= F.col("reset.at"), F.col(f"cells.`{f.name}`.v")).alias(f.name)
            for f in target.fields
        ]
        return alive.withColumn("row", F.struct(*values))
    kept = F.map_filter("cells", lambda _, c: c["at"] >= F.col("reset.at"))
    return alive.withColumn("row", F.transform_values(kept, lambda _, c: c["v"]))


# -- folders -------------------------------------------------------------------------


def bucket_of(target: Target | TableSet) -> Column:
    return F.pmod(F.xxhash64(*target.keys), F.lit(target.buckets)).cast("int")


def _ledger(spark: SparkSession, path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _append(spark: SparkSession, path: str, schema: str, row: tuple) -> None:
    spark.createDataFrame([row], schema).coalesce(1).write.mode("append").json(path)


def progress(spark: SparkSession, target: Target | TableSet) -> DataFrame:
    """The ledger: one row per applied batch; batches that ``clean`` folded have no folder."""
    return _ledger(spark, f"{target.root}/progress", _PROGRESS)


def _last_version(spark: SparkSession, target: Target | TableSet) -> tuple[int, dict[int, str]]:
    """The last batch in the state, and the version that holds each bucket."""
    last = _ledger(spark, f"{target.root}/compactions", _VERSIONS).agg(F.max_by(F.struct("*"), "upto")).first()[0]
    if last is None:
        return -1, {}
    if last["buckets"] != target.buckets:
        raise ValueError(f"this target has {last['buckets']} buckets")
    return last["upto"], {h["bucket"]: h["version"] for h in last["held"]}


def applied(spark: SparkSession, target: Target | TableSet, query: str) -> tuple[int, int]:
    """The last number of the ledger and the query's last batch, -1 for none."""
    mine = F.when(F.col("query") == query, F.col("batch"))
    last = progress(spark, target).agg(F.max("number"), F.max(mine)).first()
    return -1 if last[0] is None else last[0], -1 if last[1] is None else last[1]


def last_attempt(spark: SparkSession, target: Target | TableSet) -> str | None:
    """The folder name of the last recorded batch."""
    row = progress(spark, target).where("folder is not null").orderBy(F.desc("number")).select("folder").first()
    return row[0] if row else None


def write_batch(
    actions: DataFrame,
    batch_id: int,
    target: Target | TableSet,
    query: str = "",
    effects: DataFrame | None = None,
    beside: Mapping[str, DataFrame] | None = None,
) -> None:
    """Write one batch of per-key actions, then record it: applied first, saved second.

    ``query`` tells apart the batch numbers of different queries, which ascend. A recorded
    batch is not applied again. ``effects`` are those of the batch's DDL statements;
    ``beside`` are tables by folder that become valid with the batch and replace those of
    the batch before.
    """
    spark = actions.sparkSession
    upto, _ = _last_version(spark, target)
    number, known = applied(spark, target, query)
    if batch_id <= known:
        return
    number = max(upto, number) + 1
    folder = f"attempt={uuid.uuid4().hex}"
    path = f"{target.root}/deltas/{folder}"
    _writer(actions.select(*target.state_schema.names), target.partitions).parquet(path)
    for name, table in (beside or {}).items():
        table.write.parquet(f"{target.root}/{name}/{folder}")
    last = read_or_empty(spark, path, target.state_schema).agg(F.max("at.at")).first()[0]
    has_ddl = effects is not None and not effects.isEmpty()
    if has_ddl:
        effects.select(*spark.createDataFrame([], EFFECTS).columns).write.parquet(f"{target.root}/ddl/{folder}")
    at = (last["file_seq"], last["pos"]) if last else (None, None)
    _append(spark, f"{target.root}/progress", _PROGRESS, (number, query, batch_id, folder, *at, has_ddl))


def _writer(rows: DataFrame, partitions: Sequence[str]) -> DataFrameWriter:
    if partitions:
        # rows of one folder go into few files; a large one is split by its size
        rows = rows.hint("rebalance", *[F.col(c) for c in partitions])
    return rows.write.mode("overwrite").partitionBy(*partitions)


def _fresh(spark: SparkSession, target: Target | TableSet, upto: int) -> DataFrame:
    recorded = progress(spark, target).where((F.col("number") > upto) & F.col("folder").isNotNull())
    folders = [f"{target.root}/deltas/{r.folder}" for r in recorded.select("folder").collect()]
    names = target.state_schema.names
    if not folders:
        return spark.createDataFrame([], target.state_schema)
    schema = T.StructType([*target.state_schema.fields, T.StructField("attempt", T.StringType())])
    return spark.read.schema(schema).option("basePath", f"{target.root}/deltas").parquet(*folders).select(*names)


def _read_buckets(spark: SparkSession, target: Target | TableSet, held: Mapping[int, str]) -> DataFrame:
    if not held:
        return spark.createDataFrame([], target.state_schema)
    place = [T.StructField("version", T.StringType()), T.StructField("bucket", T.IntegerType())]
    schema = T.StructType([*target.state_schema.fields, *place])
    paths = [f"{target.root}/state/version={v}/bucket={b}" for b, v in sorted(held.items())]
    rows = spark.read.schema(schema).option("basePath", f"{target.root}/state").parquet(*paths)
    return rows.select(*target.state_schema.names)


def _write_version(state: DataFrame, target: Target | TableSet) -> dict[int, str]:
    """Write rows as a new version; returns it for each bucket that has rows."""
    spark, version = state.sparkSession, uuid.uuid4().hex
    path = f"{target.root}/state/version={version}"
    _writer(state.withColumn("bucket", bucket_of(target)), ("bucket", *target.partitions)).parquet(path)
    written = read_or_empty(spark, path, T.StructType([*target.state_schema.fields, T.StructField("bucket", T.IntegerType())]))
    return {r["bucket"]: version for r in written.select("bucket").distinct().collect()}


def _record_version(spark: SparkSession, target: Target | TableSet, upto: int, held: Mapping[int, str]) -> None:
    _append(spark, f"{target.root}/compactions", _VERSIONS, (upto, target.buckets, sorted(held.items())))


def create(target: Target, base: DataFrame) -> None:
    """Fill a new target with rows that were there before the log starts."""
    at = F.struct(before_all().alias("at"), F.lit(0).alias("sub"))
    held = [F.struct(*target.fields.names).alias("row")]
    if target.partial:
        cells = [F.struct(at.alias("at"), F.col(f.name).alias("v")).alias(f.name) for f in target.others]
        held = [F.struct(at.alias("at"), F.lit(True).alias("alive")).alias("reset"), F.struct(*cells).alias("cells")]
    _record_version(base.sparkSession, target, -1, _write_version(base.select(*target.keys, *held, at.alias("at")), target))


# -- reading -------------------------------------------------------------------------


def read_effects(spark: SparkSession, target: Target | TableSet) -> DataFrame | None:
    """The effects of all recorded DDL statements; None if there were none."""
    recorded = progress(spark, target).where("ddl and folder is not null").select("folder").collect()
    if not recorded:
        return None
    return spark.read.schema(EFFECTS).parquet(*[f"{target.root}/ddl/{r.folder}" for r in recorded])


def _settled(state: DataFrame, effects: DataFrame) -> DataFrame:
    """State rows that no DDL statement erased, with ``final_schema`` and ``final_table``."""
    placed = state.select("*", "at.at.*").withColumnRenamed("at", "last_at")
    kept = apply_ddl_epochs(placed, effects).drop("at").withColumnRenamed("last_at", "at")
    return kept.select(*state.columns, "final_schema", "final_table")


def read_state(
    spark: SparkSession, target: Target | TableSet, only: DataFrame | None = None
) -> DataFrame:
    """The last action of every key, removals included, of all recorded batches.

    ``only`` has key columns: just the buckets of its keys are read. In a set of tables,
    rows that a TRUNCATE or DROP erased are gone and renamed tables have their last name.
    """
    upto, held = _last_version(spark, target)
    keys = list(target.keys)
    fresh = _fresh(spark, target, upto)
    if only is not None:
        wanted = only.select(*keys).distinct()
        held = {b: held[b] for b in _buckets(wanted, target) if b in held}
        fresh = fresh.join(wanted, keys, "left_semi")
    merged = merge_state(_read_buckets(spark, target, held), latest(fresh, target), keys, target=target)
    if only is not None:
        merged = merged.join(wanted, keys, "left_semi")
    effects = None if isinstance(target, Target) else read_effects(spark, target)
    if effects is None:
        return merged
    names = [F.col("final_schema").alias("schema_name"), F.col("final_table").alias("table_name")]
    epoch = before_all().alias("epoch")
    rest = [c for c in merged.columns if c not in ("schema_name", "table_name", "epoch")]
    return latest(_settled(merged, effects).select(*names, epoch, *rest), target).select(*merged.columns)


def read_current(spark: SparkSession, target: Target, only: DataFrame | None = None) -> DataFrame:
    """The table's current rows, or just those of the keys in ``only``."""
    return live_rows(read_state(spark, target, only), target).select("row.*")


def read_current_table(
    spark: SparkSession, tables: TableSet, schema: str, table: str, fields: T.StructType
) -> DataFrame:
    """Current rows of one table of a set.

    Without DDL statements in the log only the table's own folders are read.
    """
    mine = (F.col("schema_name") == schema) & (F.col("table_name") == table)
    state = live_rows(read_state(spark, tables).filter(mine), tables)
    return state.select(*[F.col("row")[f.name].cast(f.dataType).alias(f.name) for f in fields])


# -- upkeep --------------------------------------------------------------------------


def _buckets(rows: DataFrame, target: Target | TableSet) -> set[int]:
    """Buckets of a table's keys, at most as many as the target has."""
    return {r[0] for r in rows.select(bucket_of(target)).distinct().collect()}


def compact(
    spark: SparkSession, target: Target | TableSet, forget_before: tuple[int, int] | None = None
) -> int:
    """Fold the recorded batches into the state; returns the last one.

    Only buckets with fresh actions are rewritten, as a new version that becomes valid
    with its record, so readers and a crash see either the old or the new state.
    ``forget_before`` drops removals logged before a position no late file can precede
    any more, which rewrites the buckets that hold such removals, too.
    """
    upto, held = _last_version(spark, target)
    last = max(upto, applied(spark, target, "")[0])
    fresh = latest(_fresh(spark, target, upto), target)
    touched = _buckets(fresh, target)
    keep = F.lit(True)
    if forget_before:
        moment = F.struct(*[F.lit(x).cast("long") for x in forget_before])
        gone = F.col("reset.alive").eqNullSafe(False) if target.partial else F.col("row").isNull()
        forgotten = gone & (F.struct("at.at.file_seq", "at.at.pos") < moment)
        keep = ~forgotten
        touched |= _buckets(_read_buckets(spark, target, held).filter(forgotten), target)
    effects = None if isinstance(target, Target) else read_effects(spark, target)
    old = {b: v for b, v in held.items() if b in touched}
    rows = merge_state(_read_buckets(spark, target, old), fresh, list(target.keys), target=target).filter(keep)
    if effects is not None:
        rows = _settled(rows, effects).select(*target.state_schema.names)
    kept = {b: v for b, v in held.items() if b not in touched}
    _record_version(spark, target, last, kept | (_write_version(rows, target) if touched else {}))
    return last


def clean(spark: SparkSession, target: Target | TableSet, keep: int = 1) -> int:
    """Delete what the last ``keep`` compactions do not need; returns how many folders.

    Versions of buckets that no kept record names, batches that are in all kept records
    and their ledger rows (folded into one per query) go, and so do attempts that were
    never recorded. Readers of an older record must be done, and no query may be running.
    """
    records = _ledger(spark, f"{target.root}/compactions", _VERSIONS).orderBy(F.desc("upto")).limit(keep).collect()
    if not records:
        return 0
    oldest = records[-1]["upto"]
    needed = {(h["version"], h["bucket"]) for r in records for h in r["held"]}
    fresh = {r[0] for r in progress(spark, target).where(F.col("number") > oldest).select("folder").collect()}
    deleted = 0
    for version, bucket, path in list_folders(spark, f"{target.root}/state"):
        if (version, bucket) not in needed:
            delete_path(spark, path)
            deleted += 1
    for name in list_names(spark, f"{target.root}/deltas"):
        if name.startswith("attempt=") and name not in fresh:
            delete_path(spark, f"{target.root}/deltas/{name}")
            deleted += 1
    last = last_attempt(spark, target)
    for part in BESIDE:
        for name in list_names(spark, f"{target.root}/{part}"):
            if name.startswith("attempt=") and name != last:
                delete_path(spark, f"{target.root}/{part}/{name}")
                deleted += 1
    if not list_names(spark, f"{target.root}/progress"):
        return deleted
    # one row stands for the batches of a query that are in the state; those with DDL keep theirs
    files = _ledger(spark, f"{target.root}/progress", _PROGRESS).select("*", F.col("_metadata.file_path").alias("file"))
    old = files.groupBy("file").agg(F.max("number").alias("n"), F.max("ddl").alias("ddl")).where(F.col("n") <= oldest)
    newest = applied(spark, target, "")[0]
    old = [r["file"] for r in old.where(~F.col("ddl") & (F.col("n") < newest)).collect()]
    if len(old) > 1:
        done = progress(spark, target).where((F.col("number") <= oldest) & (F.col("number") < newest))
        folded = done.groupBy("query").agg(F.max("number").alias("number"), F.max("batch").alias("batch"))
        folded = folded.selectExpr("number", "query", "batch", "null as folder", "null as file_seq", "null as pos", "false as ddl")
        folded.coalesce(1).write.mode("append").json(f"{target.root}/progress")
        for file in old:
            delete_path(spark, file)
    return deleted


def list_names(spark: SparkSession, path: str) -> list[str]:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in files.listStatus(place)) if files.exists(place) else []


def list_folders(spark: SparkSession, path: str) -> list[tuple[str, int, str]]:
    """(version, bucket, path) of every bucket folder."""
    out = []
    for version in list_names(spark, path):
        for bucket in list_names(spark, f"{path}/{version}") if version.startswith("version=") else ():
            if bucket.startswith("bucket="):
                out.append((version[8:], int(bucket[7:]), f"{path}/{version}/{bucket}"))
    return out
