"""Sets of executed transactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changetables.functions.text import trim_space

# The flavors of transaction ids; an empty flavor means mysql.
FLAVORS = ("mysql", "mariadb")


def normalise_flavor(flavor: str | None) -> str:
    name = (flavor or "").strip().lower() or "mysql"
    if name not in FLAVORS:
        raise ValueError(f"invalid flavor {flavor!r}")
    return name


def flavor_or_default(flavor: Column) -> Column:
    """Lower-case flavor, ``mysql`` where it is blank."""
    name = F.lower(trim_space(F.coalesce(flavor, F.lit(""))))
    return F.when(name == "", "mysql").otherwise(name)


def gtid_intervals(df: DataFrame, column: str, flavor: str | None = "mysql") -> DataFrame:
    """One row (gtid_source, lo, hi) per interval of the sets in ``column``.

    mysql sets read ``uuid:1-5:7,uuid:…``. mariadb sets read ``domain-server-seq,…``
    and name the last executed number of each domain.
    """
    kind = normalise_flavor(flavor)
    keep = [c for c in df.columns if c != column]
    parts = df.select(
        *keep, F.explode(F.split(trim_space(F.col(column)), r"\s*,\s*")).alias("__part")
    ).filter("__part != ''")
    if kind == "mariadb":
        bits = F.split("__part", "-")
        return parts.select(
            *keep,
            F.get(bits, F.lit(0)).alias("gtid_source"),
            F.lit(1).cast("long").alias("lo"),
            F.get(bits, F.lit(2)).cast("long").alias("hi"),
        )
    bits = F.split("__part", r"\s*:\s*")
    ranges = parts.select(
        *keep,
        F.lower(F.get(bits, F.lit(0))).alias("gtid_source"),
        F.explode(F.slice(bits, 2, F.size(bits))).alias("__range"),
    )
    ends = F.split("__range", r"\s*-\s*")
    lo = F.get(ends, F.lit(0)).cast("long")
    return ranges.select(
        *keep,
        "gtid_source",
        lo.alias("lo"),
        F.coalesce(F.get(ends, F.lit(1)).cast("long"), lo).alias("hi"),
    )


def interval_text(lo: Column, hi: Column) -> Column:
    return F.when(lo == hi, lo.cast("string")).otherwise(F.concat_ws("-", lo, hi))
