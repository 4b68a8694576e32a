"""Approximate nearest neighbours by a hash-prefix forest, for the largest inner product.

Each tree gives every vector a long string of bits, the sides of random hyperplanes. A
query descends to the block of vectors that share a long prefix with it; a crowded block
is cut by a longer prefix, ``step`` bits at a time. Queries that do not expect enough of
their neighbours there, judged by the angles of those they found, ascend together in all
trees: a round compares them with the vectors of a prefix shorter by ``rise`` bits, down to
none, which is all vectors. Trees and first depth are fitted on a bounded sample of
queries, compared with all vectors, to reach the wanted recall at the least work.

Vectors get one more component that makes all of one length, so that the angle to a query
orders them as the inner product does. Equal vectors are indexed once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changetables.session import fits, materialise


@dataclass(frozen=True)
class Forest:
    """Bounds of the index: at most ``trees`` trees of ``bits`` bits, fitted on ``sample`` queries.

    ``recall`` is what the fit aims at in the mean; a query ascends by ``rise`` bits while it
    expects less than ``least``. A block above ``crowd`` times the mean and ``block`` vectors
    is cut by ``step`` more bits. A task compares parts of about ``block`` vectors and as many
    queries of a block at most. Blocks without queries are left out if at most ``few``
    queries are open.
    """

    recall: float = 0.96
    least: float = 0.9
    trees: int = 40
    bits: int = 32
    sample: int = 64
    block: int = 4096
    crowd: int = 4
    step: int = 4
    rise: int = 2
    few: int = 4096
    seed: int = 7


def _vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v binary of float64) of the vectors that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, data = [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if i is None or not v or any(x is None for x in v):
                    continue
                x = np.array(v, "<f8")
                if np.isfinite(x).all() and x.any():
                    ids.append(i)
                    data.append((x + 0.0).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(data, pa.binary())], names=["id", "v"])

    return rows.select(F.col(key).cast("long").alias("id"), vector).mapInArrow(run, "id long, v binary")


def _distinct(vectors: DataFrame, most: int) -> DataFrame:
    """(rep, v, ids): every different vector with its ``most`` smallest ids, the least of them its rep.

    Copies combine inside each task first, so a vector with any share of the rows costs a
    short list per task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[bytes, list[int]] = {}
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by.setdefault(v, []).append(i)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(by), pa.binary()), pa.array([sorted(set(i))[:most] for i in by.values()], pa.list_(pa.int64()))],
                names=["v", "ids"],
            )

    merged = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, most)
    combined = vectors.mapInArrow(run, "v binary, ids array<long>").groupBy("v").agg(merged.alias("ids"))
    return combined.select(F.col("ids")[0].alias("rep"), "v", "ids")


def _matrix(batch_column) -> np.ndarray:
    values = batch_column.to_pylist()
    return np.frombuffer(b"".join(values), "<f8").reshape(len(values), -1)


def _nearest(vectors: DataFrame, queries: np.ndarray, k: int) -> np.ndarray:
    """Cosines of each given query's ``k`` nearest vectors, by comparison with all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        best = np.zeros((len(queries), 0))
        for batch in batches:
            if batch.num_rows:
                best = np.sort(np.hstack([best, queries @ _matrix(batch.column(0)).T]), axis=1)[:, -k - 1 :]
        rows = [(q, s) for q, row in enumerate(best.tolist()) for s in row]
        yield pa.RecordBatch.from_pandas(pd.DataFrame(rows, columns=["q", "s"]).astype({"q": "int32", "s": "float64"}))

    found = vectors.select("v").mapInArrow(run, "q int, s double")
    top = found.groupBy("q").agg(F.slice(F.sort_array(F.collect_list("s"), asc=False), 2, k).alias("s")).collect()
    return np.array([s for row in top for s in row["s"]])


def fit(cosines: np.ndarray, n: int, how: Forest) -> tuple[int, int]:
    """(trees, depth): the least work whose expected recall is high enough.

    Two vectors at angle t agree in a bit with chance 1 - t / pi, so a neighbour is found
    by one of L trees at depth d with chance 1 - (1 - p^d)^L. Work is the vectors compared
    with a query, and a visit for each tree.
    """
    if not len(cosines):
        return 1, 0
    agree = 1 - np.arccos(np.clip(cosines, -1, 1)) / math.pi
    best = (math.inf, 1, 0)
    for depth in range(1, how.bits + 1):
        for trees in range(1, how.trees + 1):
            if (1 - (1 - agree**depth) ** trees).mean() >= how.recall:
                best = min(best, (trees * (n / 2**depth + 200), trees, depth))
                break
    return (best[1], best[2]) if best[0] < math.inf else (1, 0)


class Hasher:
    """Bit strings of vectors; equal on the driver and in all tasks."""

    def __init__(self, dimension: int, trees: int, longest: float, how: Forest):
        rng = np.random.default_rng(how.seed)
        self.planes = rng.standard_normal((dimension + 1, trees * how.bits))
        self.trees, self.bits, self.longest = trees, how.bits, longest

    def strings(self, x: np.ndarray, query: bool) -> np.ndarray:
        """One row of ``trees`` bit strings per vector, as numbers whose first bit is the highest."""
        if query:
            x = np.hstack([x / np.linalg.norm(x, axis=1, keepdims=True), np.zeros((len(x), 1))])
        else:
            x = x / self.longest
            x = np.hstack([x, np.sqrt(np.maximum(0.0, 1 - (x * x).sum(axis=1, keepdims=True)))])
        sides = (x @ self.planes > 0).reshape(len(x), self.trees, self.bits)
        return sides.astype(np.uint64) @ (np.uint64(1) << np.arange(self.bits - 1, -1, -1, dtype=np.uint64))


@dataclass(frozen=True)
class Round:
    """One level of the ascent: the first ``trees`` trees at ``depth``, with the blocks that are cut further."""

    trees: int
    depth: int
    crowded: dict[int, set]


def _rounds(trees: int, depth: int, crowded: dict[int, set], how: Forest) -> list[Round]:
    """Levels from the deepest up; the last is all vectors, where the trees would compare as many."""
    if not depth:
        return [Round(1, 0, {})]
    above = [Round(trees, d, {}) for d in range(depth - how.rise, 0, -how.rise) if trees < 2**d]
    uncut = [Round(trees, depth, {})] if crowded else []
    return [Round(trees, depth, crowded), *uncut, *above, Round(1, 0, {})]


def _place(strings: np.ndarray, tree: int, depth: int, crowded: dict[int, set], how: Forest) -> tuple[np.ndarray, np.ndarray]:
    """(depth, prefix) of each string's block: longer where the shorter prefix is crowded."""
    depths = np.full(len(strings), depth, np.int64)
    prefixes = strings >> np.uint64(how.bits - depth) if depth else np.zeros(len(strings), np.uint64)
    for level in sorted(crowded):
        inside = (depths == level) & np.array([(tree, int(p)) in crowded[level] for p in prefixes], bool)
        deeper = min(level + how.step, how.bits)
        depths[inside] = deeper
        prefixes[inside] = strings[inside] >> np.uint64(how.bits - deeper)
    return depths, prefixes


def _crowded(vectors: DataFrame, hasher: Hasher, depth: int, n: int, how: Forest) -> dict[int, set]:
    """Blocks that are cut further, by depth: at most trees x n / block of each."""
    limit = max(how.block, how.crowd * n / 2**depth)
    crowded: dict[int, set] = {}
    while depth and depth < how.bits:

        def run(batches: Iterator[pa.RecordBatch], level=depth, known=dict(crowded)) -> Iterator[pa.RecordBatch]:
            first = min(known, default=level)
            for batch in batches:
                if not batch.num_rows:
                    continue
                strings = hasher.strings(_matrix(batch.column(0)), False)
                parts = []
                for tree in range(hasher.trees):
                    depths, prefixes = _place(strings[:, tree], tree, first, known, how)
                    value, count = np.unique(prefixes[depths == level], return_counts=True)
                    parts.append(pd.DataFrame({"tree": tree, "prefix": value.astype(np.int64), "n": count}))
                yield pa.RecordBatch.from_pandas(pd.concat(parts).astype({"tree": "int32", "n": "int64"}), preserve_index=False)

        counted = vectors.select("v").mapInArrow(run, "tree int, prefix long, n long").groupBy("tree", "prefix")
        found = counted.agg(F.sum("n").alias("n")).where(F.col("n") > limit).collect()
        if not found:
            break
        crowded[depth] = {(r["tree"], r["prefix"]) for r in found}
        depth = min(depth + how.step, how.bits)
    return crowded


def _blocks(
    hasher: Hasher, level: Round, query: bool, wanted: dict[int, np.ndarray] | None, parts: list[dict[tuple[int, int], int]], how: Forest
):
    """Task that puts (id, v) into the blocks of a level; only those of ``wanted`` prefixes, if given.

    ``parts`` are the numbers of parts of large blocks' vectors and queries; a vector goes to
    all parts of the queries, and a query to all parts of the vectors.
    """

    def pieces(batch: pa.RecordBatch):
        ids, x = batch.column(0).to_numpy(zero_copy_only=False), _matrix(batch.column(1))
        strings = hasher.strings(x, query)
        spread = (ids.astype("<i8").view("<u8") * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
        for tree in range(level.trees):
            numbers = _numbers(strings, tree, level, how)
            order = np.argsort(numbers, kind="stable")
            if wanted is not None:
                order = order[np.isin(numbers[order], wanted[tree])]
            if not len(order):
                continue
            for block in np.split(order, np.flatnonzero(np.diff(numbers[order])) + 1):
                number = int(numbers[block[0]])
                vectors, queries = (p.get((tree, number), 1) for p in parts)
                own, others = (queries, vectors) if query else (vectors, queries)
                for a in range(own):
                    part = block[spread[block] % np.uint64(own) == a]
                    if len(part):
                        data = ids[part].astype("<i8").tobytes(), x[part].tobytes()
                        for b in range(others):
                            yield f"{tree}/{number}/" + (f"{b}/{a}" if query else f"{a}/{b}"), *data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = pieces(batch)
            while out := list(islice(found, 256)):
                names, *data = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names), pa.array([query] * len(names))] + [pa.array(d, pa.binary()) for d in data],
                    names=["block", "query", "ids", "v"],
                )

    return run


def _numbers(strings: np.ndarray, tree: int, level: Round, how: Forest) -> np.ndarray:
    """Each string's block as a number of depth and prefix."""
    depths, prefixes = _place(strings[:, tree], tree, level.depth, level.crowded, how)
    return depths << how.bits | prefixes.astype(np.int64)


def _sizes(rows: DataFrame, hasher: Hasher, level: Round, query: bool, how: Forest) -> DataFrame:
    """(tree, block, n): how many vectors or queries each block of a level has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                strings = hasher.strings(_matrix(batch.column(0)), query)
                for tree in range(level.trees):
                    block, count = np.unique(_numbers(strings, tree, level, how), return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([tree] * len(block), pa.int32()), pa.array(block), pa.array(count)], names=["tree", "block", "n"]
                    )

    return rows.select("v").mapInArrow(run, "tree int, block long, n long").groupBy("tree", "block").agg(F.sum("n").alias("n"))


def _wanted(queries: DataFrame, hasher: Hasher, level: Round, how: Forest) -> dict[int, np.ndarray] | None:
    """Blocks of the queries by tree; None if there are many queries."""
    if not fits(queries, how.few):
        return None
    found = _sizes(queries, hasher, level, True, how).toPandas()
    return {tree: found["block"][found["tree"] == tree].to_numpy(np.int64) for tree in range(level.trees)}


def _parts(rows: DataFrame, hasher: Hasher, level: Round, query: bool, how: Forest) -> dict[tuple[int, int], int]:
    """How many parts of about ``block`` rows the larger blocks have, by tree and block."""
    found = _sizes(rows, hasher, level, query, how).where(F.col("n") > how.block).collect()
    return {(r["tree"], r["block"]): math.ceil(r["n"] / how.block) for r in found}


def _best(vectors: DataFrame, queries: DataFrame, hasher: Hasher, level: Round, k: int, how: Forest) -> DataFrame:
    """(q, best): the k + 1 best vectors, as (-score, rep), of each query's blocks of a level."""
    schema = "block string, query boolean, ids binary, v binary"
    wanted = _wanted(queries, hasher, level, how)
    parts = [_parts(vectors, hasher, level, False, how), _parts(queries, hasher, level, True, how)]
    placed = vectors.select("rep", "v").mapInArrow(_blocks(hasher, level, False, wanted, parts, how), schema)
    placed = placed.unionByName(queries.mapInArrow(_blocks(hasher, level, True, None, parts, how), schema))

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        """The best of the vectors that share the block's prefix."""

        def joined(of: pd.DataFrame):
            ids = np.frombuffer(b"".join(of["ids"]), "<i8")
            return ids, np.frombuffer(b"".join(of["v"]), "<f8").reshape(len(ids), -1)

        of_queries = part[part["query"]]
        if not len(of_queries) or len(of_queries) == len(part):
            return pd.DataFrame({"q": [], "ids": [], "scores": []}, dtype=object)
        ids, x = joined(part[~part["query"]])
        q_ids, q = joined(of_queries)
        found_ids, found_scores = [], []
        for start in range(0, len(q), 256):
            scores = np.einsum("ij,kj->ik", q[start : start + 256], x, optimize=True)
            for row in scores:
                best = np.argpartition(-row, k)[: k + 1] if len(row) > k + 1 else np.arange(len(row))
                edge = row[best].min()
                best = np.flatnonzero(row >= edge) if len(row) > k + 1 else best  # ties at the edge all stay
                best = best[np.lexsort((ids[best], -row[best]))][: k + 1]
                found_ids.append(ids[best])
                found_scores.append(row[best])
        return pd.DataFrame({"q": q_ids, "ids": found_ids, "scores": found_scores})

    found = placed.groupBy("block").applyInPandas(compare, "q long, ids array<long>, scores array<double>")
    each = found.select("q", F.explode(F.arrays_zip("ids", "scores")).alias("x"))
    each = each.groupBy("q", F.col("x.ids").alias("rep")).agg(F.max("x.scores").alias("score"))
    return each.groupBy("q").agg(
        F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "rep"))), 1, k + 1).alias("best")
    )


def _rated(best: DataFrame, queries: DataFrame, hasher: Hasher, level: Round, k: int, n: int, how: Forest) -> DataFrame:
    """``best`` with ``expected``, the share of its neighbours that a query found at least, in the mean.

    Crowded blocks count with the depth they were cut to. True neighbours are at least as near as those found, so the chance to find vectors at
    the found angles does not overrate them; each one that is missing counts as not found.
    """
    need = min(k, n - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            q, x = batch.column(0).to_numpy(zero_copy_only=False), _matrix(batch.column(1))
            row = np.repeat(np.arange(len(q)), pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False))
            flat = batch.column(2).flatten()
            other = flat.field("rep").to_numpy(zero_copy_only=False) != q[row]
            row, score = row[other], -flat.field("s").to_numpy(zero_copy_only=False)[other]
            near = np.arange(len(row)) - np.searchsorted(row, row) < need
            row, score = row[near], score[near]
            cosines = score / (np.linalg.norm(x, axis=1)[row] * hasher.longest)
            agree = 1 - np.arccos(np.clip(cosines, -1, 1)) / math.pi
            missed, strings = np.ones(len(row)), hasher.strings(x, True)
            for tree in range(level.trees):
                missed *= 1 - agree ** _place(strings[:, tree], tree, level.depth, level.crowded, how)[0][row]
            expected = np.bincount(row, 1 - missed, len(q)) / need if need else np.ones(len(q))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(expected)], names=["q", "best", "expected"])

    joined = queries.join(best, queries["rep"] == best["q"]).select("q", "v", "best")
    return joined.mapInArrow(run, "q long, best array<struct<s:double,rep:bigint>>, expected double")


def search(
    rows: DataFrame, is_query: Column, k: int = 20, how: Forest = Forest(), key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` nearest vectors that the forest finds.

    Queries are the rows where ``is_query`` holds; candidates are all rows but the query's
    own. The score is the inner product in double precision; ties go to the smaller id.
    Null, zero, empty or not finite vectors, null ids and vectors of another length than
    most take no part. Rows with one id and different vectors are all candidates.
    """
    every = _vectors(rows, key, vector)
    common = every.groupBy(F.length("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    size = common["size"] if common else 8
    every = materialise(every.where(F.length("v") == size), "vectors")
    vectors = materialise(_distinct(every, k + 1), "distinct-vectors")
    asked = materialise(
        _vectors(rows.where(is_query), key, vector).join(vectors.select("v", "rep"), "v").select("id", "rep").distinct(), "queries"
    )
    queries = vectors.join(asked.select("rep").distinct(), "rep", "left_semi").select("rep", "v")

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                most = float((_matrix(batch.column(0)) ** 2).sum(axis=1).max())
                yield pa.RecordBatch.from_arrays([pa.array([most]), pa.array([batch.num_rows])], names=["most", "n"])

    total = vectors.select("v").mapInArrow(lengths, "most double, n long").agg(F.max("most"), F.sum("n")).first()
    longest, n = math.sqrt(total[0] or 1.0) * (1 + 1e-12), total[1] or 0
    sample = [bytes(r["v"]) for r in queries.orderBy(F.xxhash64("rep"), "rep").limit(how.sample).select("v").collect()]
    cosines = np.zeros(0)
    if n > k + 1 and sample:
        asked_for = np.frombuffer(b"".join(sample), "<f8").reshape(len(sample), -1)
        unit = asked_for / np.linalg.norm(asked_for, axis=1, keepdims=True)
        cosines = _nearest(vectors, unit, k) / longest
    trees, depth = fit(cosines, n, how)
    hasher = Hasher(size // 8, trees, longest, how)
    rounds = _rounds(trees, depth, _crowded(vectors, hasher, depth, n, how), how)
    settled, waiting = [], queries
    for level in rounds:
        rated = _rated(_best(vectors, waiting, hasher, level, k, how), waiting, hasher, level, k, n, how)
        rated = materialise(rated, "rated")
        settled.append((rated if level is rounds[-1] else rated.where(F.col("expected") >= how.least)).select("q", "best"))
        if level is not rounds[-1]:
            waiting = materialise(waiting.join(settled[-1], waiting["rep"] == settled[-1]["q"], "left_anti"), "waiting-queries")
            if waiting.isEmpty():
                break
    best = reduce(DataFrame.unionByName, settled)
    copies = vectors.where(F.size("ids") > 1).select("rep", "ids")
    spread = (
        best.select("q", F.explode("best").alias("x"))
        .select("q", F.col("x.rep").alias("rep"), F.col("x.s").alias("s"))
        .join(copies, "rep", "left")
        .groupBy("q")
        .agg(F.flatten(F.collect_list(F.transform(F.coalesce("ids", F.array("rep")), lambda i: F.struct(F.col("s").alias("s"), i.alias("id"))))).alias("c"))
        .select("q", F.slice(F.array_sort("c"), 1, k + 1).alias("c"))
    )
    return (
        asked.join(spread, asked["rep"] == spread["q"])
        .select(F.col("id").alias("query_id"), F.slice(F.filter("c", lambda x: x["id"] != F.col("id")), 1, k).alias("c"))
        .select("query_id", F.posexplode("c").alias("p", "x"))
        .select("query_id", (F.col("p") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), (-F.col("x.s")).alias("score"))
    )
