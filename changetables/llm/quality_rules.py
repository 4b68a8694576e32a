"""Quality rules: word and line statistics of a text, and lines that a host repeats.

A line's frequency is the number of *different* texts of a host that hold it, so exact
copies of a document count once. Lines above the limit are removed; a document that
loses too many of its words with them is depleted and rejected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changetables.functions.text import let
from changetables.llm.common import BROADCAST_BYTES, SPACES, words
from changetables.session import materialise


@dataclass(frozen=True)
class LineRules:
    """Limits of the cross-document part.

    A line is frequent if more than ``min_docs`` texts of its host hold it and more than
    ``max_share`` of them do. A document is depleted if less than ``min_left`` of its
    words is left without its frequent lines.
    """

    min_docs: int = 10
    max_share: float = 0.01
    min_left: float = 0.5


def normal_lines(text: Column) -> Column:
    """Lines of a text, in order: lower case, digits as 0, white space as single blanks."""
    whole = F.regexp_replace(F.lower(text), r"[\x20\x09\x0B-\x0D]+", " ")
    whole = F.regexp_replace(whole, "[0-9]+", "0")
    return F.transform(F.split(whole, "\n"), lambda line: F.trim(line))


def _repeated_words(found: Column) -> Column:
    """How many words lie in 3-word windows that occur twice or more."""

    def covered(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def again(s: Column) -> Column:
            same = lambda x, k: F.coalesce(F.get(s, k)["h"] == x["h"], F.lit(False))
            return F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1))

        starts = let(placed, lambda s: F.sort_array(F.transform(again(s), lambda x: x["i"])))
        total = F.aggregate(
            starts,
            F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
            lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n")),
            lambda acc: acc["n"],
        )
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(total)

    windows = F.transform(
        F.sequence(F.lit(0), F.size(found) - 3),
        lambda i: F.xxhash64(F.get(found, i), F.get(found, i + 1), F.get(found, i + 2)),
    )
    return F.when(F.size(found) < 4, F.lit(0).cast("long")).otherwise(let(windows, covered))


def text_statistics(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    symbols = F.length(F.regexp_replace(text, "[^#*$%&|<>]+", ""))
    return let(
        words(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            symbols.cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            _repeated_words(w).alias("n_repeat_words"),
        ),
    )


def frequent_lines(docs: DataFrame, rules: LineRules = LineRules(), text: str = "text", host: str = "source") -> DataFrame:
    """Hashes of each host's frequent lines: (host, lines array<long>, n_texts).

    Counting combines before each shuffle, so a hot line, host or text costs a row per
    task. A host has at most ``1 / max_share`` times its mean lines per text in its array.
    A null host is a host of its own, the empty name; null texts have no lines.
    """
    seen = docs.select(
        F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"),
        F.xxhash64(F.col(text)).alias("doc"),
        F.array_distinct(
            F.transform(F.filter(normal_lines(F.col(text)), lambda x: x != ""), lambda x: F.xxhash64(x))
        ).alias("lines"),
    ).where(F.col(text).isNotNull())
    texts = seen.groupBy("host").agg(F.count_distinct("doc").alias("n_texts"))
    counted = (
        seen.select("host", "doc", F.explode("lines").alias("line"))
        .groupBy("host", "line")
        .agg(F.count_distinct("doc").alias("n"))
        .where(F.col("n") > rules.min_docs)
    )
    return (
        counted.join(texts, "host")
        .where(F.col("n") > rules.max_share * F.col("n_texts"))
        .groupBy("host")
        .agg(F.sort_array(F.collect_list("line")).alias("lines"), F.first("n_texts").alias("n_texts"))
    )


def judge(docs: DataFrame, rules: LineRules = LineRules(), text: str = "text", host: str = "source") -> DataFrame:
    """``docs`` with a struct ``verdict``: the text's statistics, base_failed,
    n_lines_removed, n_words_removed, kept and the text without its frequent lines.

    Every input row comes back, repeated rows too. A null or empty text has no words and
    fails. A column of the name ``verdict`` is replaced.
    """
    lists = materialise(frequent_lines(docs, rules, text, host), "frequent-lines")
    size = lists.agg(F.sum(F.size("lines") * 8 + F.length("host") + 64)).first()[0] or 0
    lists = lists.select(F.col("host").alias("__host"), F.col("lines").alias("__lines"))
    if size <= BROADCAST_BYTES:
        lists = F.broadcast(lists)
    doc = F.coalesce(F.col(text), F.lit(""))

    def without(lines: Column) -> Column:
        """Struct of the lines that stay and those that go."""
        both = F.arrays_zip(F.split(doc, "\n").alias("raw"), normal_lines(doc).alias("normal"))
        return let(
            F.transform(both, lambda x: F.struct(x["raw"], F.array_contains(lines, F.xxhash64(x["normal"])).alias("out"))),
            lambda x: F.struct(
                F.array_join(F.transform(F.filter(x, lambda y: ~y["out"]), lambda y: y["raw"]), "\n").alias("text"),
                F.transform(F.filter(x, lambda y: y["out"]), lambda y: y["raw"]).alias("gone"),
            ),
        )

    no_lines = F.struct(doc.alias("text"), F.array().cast("array<string>").alias("gone"))
    joined = (
        docs.withColumn("__host", F.coalesce(F.col(host).cast("string"), F.lit("")))
        .join(lists, "__host", "left")
        .withColumn("__stat", text_statistics(F.col(text)))
        .withColumn("__cut", F.when(F.col("__lines").isNull(), no_lines).otherwise(without(F.col("__lines"))))
        .withColumn("__gone", F.size(words(F.array_join("__cut.gone", "\n"))).cast("long"))
    )
    stat = F.col("__stat")
    failed = (stat["n_words"] < 50) | (100 * stat["n_repeat_words"] > 50 * stat["n_words"])
    depleted = stat["n_words"] - F.col("__gone") < rules.min_left * stat["n_words"]
    return joined.withColumn(
        "verdict",
        F.struct(
            "__stat.*",
            failed.alias("base_failed"),
            F.size("__cut.gone").cast("long").alias("n_lines_removed"),
            F.col("__gone").alias("n_words_removed"),
            (~failed & ~depleted).alias("kept"),
            F.col("__cut.text").alias("text"),
        ),
    ).drop("__host", "__lines", "__stat", "__cut", "__gone")


def keep_good(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """Documents that pass, without the lines that their host repeats; n_chars follows the text."""
    out = judge(docs, rules).where("verdict.kept").withColumn("text", F.col("verdict.text"))
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*docs.columns)
