"""Ranked lexical search by MaxScore with bounds of term pairs.

``build_index`` makes an inverted index in shards of documents: a row for each shard and term
with the term's documents and counts. A shard is made by one task and holds at most
``shard_postings`` postings (a longer document is a shard of its own), so nothing is shuffled
and no task's work grows with a term's frequency.

``search`` takes the queries in blocks of bounded size. For each block it stores, by shard,
the intersection lists of pairs of terms: the documents that hold both and the highest joint
impacts. Pairs are terms of one query next to each other by weight, whose impacts are about
equal, so that a pair saves most. Two terms that seldom meet are bounded by little more than
the greater of them, where independent maxima would add up. The search uses the lists thrice:

* the k-th highest joint impact of a pair over all shards is a score that k documents reach,
  so a query's threshold starts there;
* the terms of a query are matched into pairs that save most. Units (pairs and single terms)
  are read from the highest bound down, and once the bounds of the rest together are below the
  threshold, no further document can enter;
* a candidate outside a pair's list is bounded by the greater of the two terms alone.

Each shard gives its k best documents, and Spark merges them; ranks are exact.

Scores are whole numbers, see ``impacts``. Null and empty texts have no terms, take no part
and count for no statistic; long texts are read whole. Equal scores go by ascending key, null
keys last. Repeated rows of documents are documents of their own, repeated query rows give
their results again. Queries without terms and empty tables give no rows. Only the named
columns are read; keys may not share a name or be called ``rank`` or ``score``.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changetables.llm.common import broadcast_if_small
from changetables.session import materialise


@dataclass(frozen=True)
class Search:
    """Documents wanted for each query, and sizes of the work."""

    best: int = 20
    shard_postings: int = 2_000_000
    block_bytes: int = 4 << 20


#: ASCII letters and digits and all bytes of other characters belong to terms; A to Z in lower case.
_TERM_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERM_BYTES).split()


def build_index(docs: DataFrame, how: Search = Search(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """The index as a table: rows (shard, term, docs, counts), and for each shard a row without
    a term that has its documents' keys, ascending, and lengths.

    Store the result (a shard's name and cut belong to one run).
    """
    chosen = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = T.StructType(
        [
            T.StructField("shard", T.StringType()),
            T.StructField("term", T.StringType()),
            T.StructField("docs", T.ArrayType(T.IntegerType())),
            T.StructField("counts", T.ArrayType(T.IntegerType())),
            T.StructField("keys", T.ArrayType(chosen.schema["key"].dataType)),
            T.StructField("lengths", T.ArrayType(T.LongType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[bytes, int] = {}
        keys: list[pa.Array] = []
        lengths: list[int] = []
        postings: list[tuple[np.ndarray, np.ndarray]] = []
        size, cut = 0, 0

        def out() -> Iterator[pa.RecordBatch]:
            shard = f"{TaskContext.get().partitionId()}-{cut}"
            ints, kept = pa.list_(pa.int32()), pa.concat_arrays(keys)
            by_key = pc.array_sort_indices(kept, null_placement="at_end").to_numpy()
            kept = kept.take(pa.array(by_key))
            place = np.empty(len(by_key), np.int32)
            place[by_key] = np.arange(len(by_key))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([shard]),
                    pa.array([None], pa.string()),
                    pa.array([None], ints),
                    pa.array([None], ints),
                    pa.ListArray.from_arrays(pa.array([0, len(kept)], pa.int32()), kept),
                    pa.array([np.array(lengths)[by_key]], pa.list_(pa.int64())),
                ],
                names=schema.names,
            )
            owner = np.repeat(place, [len(p[0]) for p in postings])
            number, count = (np.concatenate(x) for x in zip(*postings))
            order = np.lexsort((owner, number))
            owner, count = owner[order], count[order]
            ends = np.cumsum(np.bincount(number, minlength=len(names)))
            spelled = list(names)
            for a in range(0, len(spelled), 50_000):
                part = spelled[a : a + 50_000]
                first = int(ends[a - 1]) if a else 0
                last = int(ends[a + len(part) - 1])
                at = pa.array(np.concatenate([[0], ends[a : a + len(part)] - first]).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard] * len(part)),
                        pa.array(part, pa.binary()).cast(pa.string()),
                        pa.ListArray.from_arrays(at, pa.array(owner[first:last])),
                        pa.ListArray.from_arrays(at, pa.array(count[first:last])),
                        pa.nulls(len(part), pa.list_(kept.type)),
                        pa.nulls(len(part), pa.list_(pa.int64())),
                    ],
                    names=schema.names,
                )

        for batch in batches:
            for place in range(batch.num_rows):
                found = Counter(terms(batch.column(1)[place].as_py()))
                if not found:
                    continue
                if postings and size + len(found) > how.shard_postings:
                    yield from out()
                    names, keys, lengths, postings, size, cut = {}, [], [], [], 0, cut + 1
                number = np.fromiter((names.setdefault(t, len(names)) for t in found), np.int32, len(found))
                count = np.fromiter(found.values(), np.int32, len(found))
                postings.append((number, count))
                keys.append(batch.column(0).slice(place, 1))
                lengths.append(int(count.sum()))
                size += len(found)
        if postings:
            yield from out()

    return chosen.mapInArrow(run, schema)


def impacts(weight: int, counts: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """What a term adds to the scores of documents that hold it ``counts`` times.

    A term's weight is ``floor(1000 ln((2N+2)/(2df+1)))``; a document of n terms has the norm
    ``75 + 25 n N div L`` of N documents with L terms.
    """
    counts = counts.astype(np.int64)
    return weight * (1_000_000_000 * counts // (1000 * counts + 12 * norms))


class Query:
    """One query: its distinct terms by falling weight, and how often it has each."""

    def __init__(self, number: int, repeats: dict[str, int], weights: dict[str, int]):
        self.number = number
        self.terms = sorted((t for t in repeats if weights.get(t, 0) > 0), key=lambda t: (-weights[t], t))
        self.repeats = repeats
        self.pairs = list(zip(self.terms, self.terms[1:]))


class Shard:
    """Postings of one shard with impacts, as read for a block of queries."""

    def __init__(self, rows: pd.DataFrame, weights: dict[str, int], documents: int, length: int):
        whole = rows[rows["term"].isna()].iloc[0]
        self.size = len(whole["lengths"])
        self.norms = 75 + 25 * np.asarray(whole["lengths"], np.int64) * documents // length
        self.lists: dict[str, tuple[np.ndarray, np.ndarray, int]] = {}
        held = rows[rows["term"].notna() & rows["other"].isna()]
        for term, docs, counts in zip(held["term"], held["docs"], held["counts"]):
            docs = np.asarray(docs)
            value = impacts(weights[term], np.asarray(counts), self.norms[docs])
            self.lists[term] = (docs, value, int(value.max()))
        both = rows[rows["other"].notna()]
        self.pairs = {(a, b): (np.asarray(d), int(t[0])) for a, b, d, t in zip(both["term"], both["other"], both["docs"], both["top"])}

    def join(self, one: str, two: str) -> tuple[np.ndarray, np.ndarray]:
        """Documents that hold both terms, and their joint impacts."""
        (a, x, _), (b, y, _) = self.lists[one], self.lists[two]
        docs, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
        return docs, x[i] + y[j]

    def units(self, query: Query) -> list[tuple[int, int, tuple[str, ...]]]:
        """(bound, bound outside the pair's list, terms), highest bound first."""
        repeats = query.repeats
        most = {t: repeats[t] * self.lists[t][2] for t in query.terms if t in self.lists}
        options = []
        for a, b in query.pairs:
            if a in most and b in most:
                apart = max(most[a], most[b])
                bound = apart
                if (a, b) in self.pairs:
                    common = min(repeats[a], repeats[b])
                    more = sum((repeats[t] - common) * self.lists[t][2] for t in (a, b))
                    bound = max(apart, min(most[a] + most[b], common * self.pairs[a, b][1] + more))
                options.append((most[a] + most[b] - bound, bound, apart, (a, b)))
        out, left = [], dict(most)
        for saved, bound, apart, pair in sorted(options, reverse=True):
            if saved > 0 and pair[0] in left and pair[1] in left:
                out.append((bound, apart, pair))
                del left[pair[0]], left[pair[1]]
        out += [(m, m, (t,)) for t, m in left.items()]
        return sorted(out, reverse=True)

    def search(self, query: Query, least: int, best: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) among the shard's best with a score of at least ``least``, ties included."""
        units = self.units(query)
        rest = np.cumsum([0] + [u[0] for u in units[::-1]])[::-1].tolist()
        score = np.zeros(self.size, np.int64)
        opened = 0
        while opened < len(units) and rest[opened] >= least:
            for term in units[opened][2]:
                docs, value, _ = self.lists[term]
                score[docs] += query.repeats[term] * value
            opened += 1
            least = max(least, self._reached(score, best))
        found = np.flatnonzero(score)
        if opened < len(units):
            # no new documents from here on: bound each candidate by the lists it is in
            bound = np.full(len(found), sum(u[1] for u in units[opened:]))
            member = {}
            for high, apart, names in units[opened:]:
                if high > apart and names in self.pairs:
                    inside = np.isin(found, self.pairs[names][0], assume_unique=True)
                    member[names] = np.where(inside, high - apart, 0)
                    bound += member[names]
            partial = score[found]
            for _, apart, names in units[opened:]:
                stay = partial + bound >= least
                found, partial, bound = found[stay], partial[stay], bound[stay]
                member = {n: v[stay] for n, v in member.items()}
                if not len(found):
                    break
                for term in names:
                    docs, value, _ = self.lists[term]
                    at = np.minimum(np.searchsorted(docs, found), len(docs) - 1)
                    partial = partial + np.where(docs[at] == found, query.repeats[term] * value[at], 0)
                bound = bound - apart - member.get(names, 0)
                least = max(least, self._reached(partial, best))
            score = partial
        else:
            score = score[found]
        stay = score >= max(least, 1)
        return found[stay], score[stay]

    @staticmethod
    def _reached(score: np.ndarray, best: int) -> int:
        """A score that as many documents as wanted reach already."""
        return int(np.partition(score, len(score) - best)[len(score) - best]) if len(score) >= best else 0


def _asked(items: DataFrame, key: str, text: str) -> DataFrame:
    """(query, item, term, repeats) for every row of the queries."""
    chosen = items.select(F.monotonically_increasing_id().alias("query"), F.col(key).alias("item"), F.col(text).alias("text"))
    item_type = chosen.schema["item"].dataType
    schema = T.StructType(
        [
            T.StructField("query", T.LongType()),
            T.StructField("item", item_type),
            T.StructField("term", T.StringType()),
            T.StructField("repeats", T.IntegerType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Counter(terms(v.as_py())) for v in batch.column(2)]
            at = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(at),
                    batch.column(1).take(at),
                    pa.array([t for f in found for t in f], pa.binary()).cast(pa.string()),
                    pa.array([n for f in found for n in f.values()], pa.int32()),
                ],
                names=schema.names,
            )

    return materialise(chosen.mapInArrow(run, schema), "queries")


def _search_block(index: DataFrame, asked: DataFrame, documents: int, length: int, how: Search) -> DataFrame:
    """(query, key, score): the best documents of each shard for a block of queries.

    A shard numbers its documents by ascending key, so equal scores go by number.
    """
    queries: dict[int, dict[str, int]] = {}
    for row in asked.select("query", "term", "repeats").collect():
        queries.setdefault(row["query"], {})[row["term"]] = row["repeats"]
    wanted = F.broadcast(asked.select("term").distinct())  # a part of the block, bounded like it
    held = index.where("term is not null").join(wanted, "term").select(*index.columns)
    held = materialise(held.unionByName(index.where("term is null")).drop("keys"), "wanted-postings")
    frequency = held.where("term is not null").groupBy("term").agg(F.sum(F.size("docs")).alias("df")).collect()
    weights = {r["term"]: math.floor(1000 * math.log((2 * documents + 2) / (2 * r["df"] + 1))) for r in frequency}
    plan = [Query(number, repeats, weights) for number, repeats in sorted(queries.items())]
    pairs = sorted({p for q in plan for p in q.pairs})
    best = how.best

    def join_pairs(rows: pd.DataFrame) -> pd.DataFrame:
        shard = Shard(rows.assign(other=None, top=None), weights, documents, length)
        out = []
        for one, two in pairs:
            if one in shard.lists and two in shard.lists:
                docs, joint = shard.join(one, two)
                if len(docs):
                    out.append((rows["shard"].iloc[0], one, two, docs, np.sort(joint)[::-1][:best]))
        return pd.DataFrame(out, columns=["shard", "term", "other", "docs", "top"])

    joined = held.groupBy("shard").applyInPandas(
        join_pairs, "shard string, term string, other string, docs array<int>, top array<long>"
    )
    joined = materialise(joined, "pair-lists")

    # a score that enough documents reach, for each pair that has so many
    high = joined.select("term", "other", F.explode("top").alias("joint"))
    by_joint = Window.partitionBy("term", "other").orderBy(F.desc("joint"))
    high = high.withColumn("k", F.row_number().over(by_joint)).where(F.col("k") <= best)
    high = high.where(F.col("k") == best).select("term", "other", "joint").collect()
    reached = {(r["term"], r["other"]): r["joint"] for r in high}
    start = {q.number: max((reached.get(p, 0) for p in q.pairs), default=0) for q in plan}

    schema = T.StructType(
        [
            T.StructField("query", T.LongType()),
            T.StructField("shard", T.StringType()),
            T.StructField("doc", T.IntegerType()),
            T.StructField("score", T.LongType()),
        ]
    )

    def search_shard(rows: pd.DataFrame) -> pd.DataFrame:
        shard = Shard(rows, weights, documents, length)
        out: list[tuple] = []
        for query in plan:
            docs, score = shard.search(query, start[query.number], best)
            first = np.lexsort((docs, -score))[:best]
            out += [(query.number, rows["shard"].iloc[0], d, x) for d, x in zip(docs[first], score[first])]
        return pd.DataFrame(out, columns=schema.names)

    nothing = lambda name, kind: F.lit(None).cast(kind).alias(name)
    postings = held.select("*", nothing("other", "string"), nothing("top", "array<long>"))
    lists = joined.select(
        "shard", "term", "docs", nothing("counts", "array<int>"), nothing("lengths", "array<long>"), "other", "top"
    )
    found = postings.unionByName(lists).groupBy("shard").applyInPandas(search_shard, schema)
    found = materialise(postings.unionByName(lists).groupBy("shard").applyInPandas(search_shard, schema), "found")
    keys = index.where("term is null").select("shard", F.posexplode("keys").alias("doc", "key"))
    return keys.join(broadcast_if_small(found, 64), ["shard", "doc"]).select("query", "key", "score")


def search(
    index: DataFrame, items: DataFrame, how: Search = Search(), item: str = "item_id", text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """(item, rank, key, score): each query's best documents in a stored index, ranks from 1.

    The queries are dealt into blocks of about ``block_bytes``; what a block's terms are is
    all that the driver and the tasks hold at once.
    """
    if len({item, key, "rank", "score"}) < 4:
        raise ValueError("the keys' names clash")
    asked = _asked(items, item, text)
    total = index.where("term is null").agg(F.sum(F.size("keys")), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b)))
    documents, length = (int(x or 0) for x in total.first())
    blocks = max(1, math.ceil((asked.agg(F.sum(F.octet_length("term") + 16)).first()[0] or 0) / how.block_bytes))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)))
    names = asked.select("query", "item").distinct()
    found = None
    for block in range(blocks if documents else 0):
        part = _search_block(index, asked.where(F.col("block") == block), documents, length, how)
        found = part if found is None else found.unionByName(part)
    if found is None:
        empty = T.StructType(
            [
                items.select(F.col(item)).schema[0],
                T.StructField("rank", T.IntegerType()),
                T.StructField(key, index.schema["keys"].dataType.elementType),
                T.StructField("score", T.LongType()),
            ]
        )
        return index.sparkSession.createDataFrame([], empty)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("key"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= how.best)
    named = ranked.join(broadcast_if_small(names, 64), "query")
    return named.select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score")
