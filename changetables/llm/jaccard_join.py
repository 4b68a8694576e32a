"""N-gram Jaccard join by a universe partition and the pigeonhole principle.

Two sets of sizes p <= q with a Jaccard similarity of at least s differ in at most
(p + q)(1 - s)/(1 + s) shingles. All shingles are hashed into segments whose number
depends on the size band of the larger set, so similar sets agree on enough segments:

* exact segments: with more segments than differences, similar sets agree on all but that
  many. Ordered by cost, the segments with fewest shingles (the likeliest to agree by
  chance) last, they agree on one of the first ``differences + 1`` of each;
* one-deletion neighbourhoods: with half as many segments, some segment differs in one
  shingle at most, so the segments and those less one shingle have one in common.

Each band takes the allocation of less cost. What agrees is verified exactly; sets found
linked are not compared again, so a group of copies costs a comparison for each member.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changetables.llm.common import BROADCAST_BYTES, release
from changetables.llm.components import components
from changetables.session import materialise


@dataclass(frozen=True)
class Join:
    """Similarity in percent, words of a shingle, and sizes of the work.

    ``growth`` is the ratio of a size band's bounds, ``spare`` the share of extra exact
    segments, ``chance`` the cost of a segment that may agree by chance, in signatures. Up
    to ``direct`` sets with one signature are compared pairwise at once; more are compared
    with the least and the most central of them first and with each other only across what
    is not yet linked, up to ``block`` members in one task.
    """

    percent: int = 80
    words: int = 5
    growth: float = 1.5
    spare: float = 0.25
    chance: float = 50.0
    direct: int = 8
    block: int = 2048
    bucket: int = 500_000
    flush: int = 300_000


def _poisson(mean: float, most: int) -> float:
    """Chance of at most ``most``."""
    return sum(math.exp(-mean) * mean**k / math.factorial(k) for k in range(most + 1))


class Bands:
    """Size bands, each with its number of segments and its allocation."""

    def __init__(self, how: Join):
        self.how = how
        self.known: list[tuple[int, int, int, bool]] = []  # low, high (exclusive), segments, with deletions
        self.low = 1

    def differences(self, p: int, q: int) -> int:
        """Most shingles in which linked sets of these sizes differ."""
        return (p + q) * (100 - self.how.percent) // (100 + self.how.percent)

    def largest(self, size: int) -> int:
        """Size of the largest set that a set can be linked with."""
        return size * 100 // self.how.percent

    def _plan(self, low: int, high: int) -> tuple[int, bool]:
        how, most = self.how, self.differences(high - 1, high - 1)
        if not most:
            return 0, False
        middle = (low + high - 1) / 2
        exact = math.ceil((1 + how.spare) * (most + 1))
        chosen = self.differences(middle, middle) + 1
        poor = max(0.0, chosen / exact - 1 + _poisson(middle / exact, 1))
        near = (most + 2) // 2
        cost_exact = chosen + how.chance * exact * poor
        cost_near = middle + near + how.chance * near * _poisson(middle / near, 2)
        return (near, True) if cost_near < cost_exact else (exact, False)

    def of(self, size: int) -> int:
        """Number of the band that holds a size."""
        while not self.known or self.known[-1][1] <= size:
            low = self.known[-1][1] if self.known else 1
            high = max(low + 1, math.floor(low * self.how.growth))
            self.known.append((low, high, *self._plan(low, high)))
        lo, hi = 0, len(self.known) - 1
        while lo < hi:
            mid = (lo + hi + 1) // 2
            lo, hi = (mid, hi) if self.known[mid][0] <= size else (lo, mid - 1)
        return lo


def _mixed(x: np.ndarray) -> np.ndarray:
    """Well-spread 64-bit numbers of 64-bit numbers, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingles:
    """Sets of word shingles as sorted 64-bit hashes.

    Hashes of up to ``REMEMBERED`` words of up to ``LONGEST`` bytes are kept.
    """

    REMEMBERED, LONGEST = 100_000, 40

    def __init__(self, words: int):
        self.words = words
        self.known: dict[bytes, int] = {}
        self.factors = _mixed(np.arange(1, words + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)

    def _hash(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        try:
            return np.array([known[w] for w in words], np.uint64)
        except KeyError:
            pass
        fresh = {w: xxhash.xxh64_intdigest(w) for w in set(words) if w not in known}
        found = np.array([known[w] if w in known else fresh[w] for w in words], np.uint64)
        if len(known) + len(fresh) > self.REMEMBERED:
            known.clear()
        known.update((w, h) for w, h in fresh.items() if len(w) <= self.LONGEST)
        return found

    def of(self, text: str | None) -> np.ndarray:
        """Words are runs without ASCII white space, A to Z in lower case."""
        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(words) < self.words:
            return np.array([xxhash.xxh64_intdigest(b" ".join(words), 1)], np.uint64)
        h = self._hash(words)
        n = len(h) - self.words + 1
        # words' hashes are well spread and factors odd, so sums need mixing only once
        total = h[:n] * self.factors[0]
        for k in range(1, self.words):
            total += h[k : k + n] * self.factors[k]
        out = _mixed(total)
        out.sort()
        is_new = np.empty(n, bool)
        is_new[0] = True
        np.not_equal(out[1:], out[:-1], out=is_new[1:])
        return out[is_new]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Arrow batches a few rows at a time, so that little of one is decoded at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def identity(shingles: np.ndarray) -> int:
    """A set's own signed 64-bit number."""
    return int(np.uint64(xxhash.xxh64_intdigest(shingles.tobytes())).astype(np.int64))


def sketch(shingles: np.ndarray) -> np.ndarray:
    """Parities of the set's shingles in 2^k >= 2n buckets, as bits of 64-bit words.

    Two sketches differ in no more bits than their sets differ in shingles. The longer of
    two is brought to the other's length by adding its halves.
    """
    words = max(1, 1 << (2 * len(shingles) - 1).bit_length() - 6 if len(shingles) > 32 else 1)
    place = shingles & np.uint64(64 * words - 1)
    bits = np.bincount(place.astype(np.int64), minlength=64 * words).astype(np.uint8) & 1
    return np.packbits(bits, bitorder="little").view("<u8")


def may_be_linked(pairs: np.ndarray, sizes: np.ndarray, sketches: list[np.ndarray], bands: Bands) -> np.ndarray:
    """Which of the pairs (rows of two places) their sizes and sketches allow to be linked."""
    p, q = np.minimum(sizes[pairs[:, 0]], sizes[pairs[:, 1]]), np.maximum(sizes[pairs[:, 0]], sizes[pairs[:, 1]])
    allowed = 100 * p >= bands.how.percent * q
    most = (p + q) * (100 - bands.how.percent) // (100 + bands.how.percent)
    lengths = np.array([len(s) for s in sketches])
    shorter = np.minimum(lengths[pairs[:, 0]], lengths[pairs[:, 1]])
    for words in np.unique(shorter[allowed]):
        folded = np.zeros((len(sketches), words), np.uint64)
        for k in np.flatnonzero(lengths >= words):
            folded[k] = np.bitwise_xor.reduce(sketches[k].reshape(-1, words), axis=0)
        these = np.flatnonzero(allowed & (shorter == words))
        step = max(1, 2_000_000 // int(words))
        for start in range(0, len(these), step):
            part = these[start : start + step]
            differ = np.bitwise_count(folded[pairs[part, 0]] ^ folded[pairs[part, 1]]).sum(axis=1, dtype=np.int64)
            allowed[part] = differ <= most[part]
    return allowed


def signatures(shingles: np.ndarray, bands: Bands) -> np.ndarray:
    """Signatures of one set: linked sets have one in common, whatever their bands."""
    size = len(shingles)
    largest = bands.largest(size)
    own = bands.of(size)
    out = []
    for band in range(own, bands.of(largest) + 1):
        _, high, segments, near = bands.known[band]
        if not segments:
            continue
        place = ((shingles >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
        counts = np.bincount(place.astype(np.int64), minlength=segments)
        ends = np.cumsum(counts)
        spread = _mixed(shingles + np.uint64(band))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(spread, dtype=np.uint64)])
        content = sums[ends] - sums[ends - counts]
        salt = (np.uint64(band) << np.uint64(40)) + np.arange(segments, dtype=np.uint64)
        marks = _mixed(content ^ _mixed(salt + np.uint64(1)))
        if near:
            less = _mixed((content[place.astype(np.int64)] - spread) ^ _mixed(salt[place.astype(np.int64)] + np.uint64(1)))
            out += [marks, less]
            continue
        first = bands.differences(size, min(largest, high - 1)) + 1
        if first < segments:
            order = (np.uint64(255) - np.minimum(counts, 255).astype(np.uint64) << np.uint64(56)) | (marks >> np.uint64(8))
            marks = marks[np.argpartition(order, first - 1)[:first]]
        out.append(marks)
    return np.unique(np.concatenate(out)) if out else np.zeros(0, np.uint64)


#: A signature's posting: the set, its size class (1/28 of a factor e) and whether it stands for others.
POSTING = np.dtype([("mark", "<u8"), ("set", "<i8"), ("size", "u1"), ("more", "u1")])
PAIR = np.dtype([("x", "<i8"), ("y", "<i8")])


def _groups(postings: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Postings by signature and set, each once; group number of each; size of each group."""
    order = np.lexsort((postings["set"], postings["mark"]))
    postings = postings[order]
    del order
    same = (postings["mark"][1:] == postings["mark"][:-1]) & (postings["set"][1:] == postings["set"][:-1])
    more = postings["more"].copy()
    if same.any():
        starts = np.flatnonzero(np.concatenate([[True], ~same]))
        more = np.maximum.reduceat(postings["more"], starts)
        postings = postings[starts].copy()
        postings["more"] = more
    new = np.concatenate([[True], postings["mark"][1:] != postings["mark"][:-1]])
    group = np.cumsum(new) - 1
    return postings, group, np.bincount(group)


def _pairs(a: np.ndarray, b: np.ndarray, reach: int) -> np.ndarray:
    """Pairs of postings whose sizes may be similar, least set first."""
    far = np.abs(a["size"].astype(np.int16) - b["size"].astype(np.int16)) > reach
    far &= (a["size"] < 255) & (b["size"] < 255)
    a, b = a["set"][~far], b["set"][~far]
    out = np.empty(len(a), PAIR)
    out["x"], out["y"] = np.minimum(a, b), np.maximum(a, b)
    return out


def _star(postings: np.ndarray, group: np.ndarray, chosen: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of each chosen group's members with its first, and the members as (mark, set)."""
    firsts = np.concatenate([[True], group[1:] != group[:-1]])
    first = np.flatnonzero(firsts)[group]
    inside = chosen[group]
    members = np.empty(int(inside.sum()), PAIR)
    members["x"], members["y"] = postings["mark"][inside].view(np.int64), postings["set"][inside]
    rest = inside & ~firsts
    return _pairs(postings[first[rest]], postings[rest], reach), members


def _reach(how: Join) -> int:
    return math.ceil(28 * math.log(100 / how.percent)) + 1


def _postings(docs: DataFrame, how: Join, text: str, buckets: int) -> DataFrame:
    """(bucket, kind, data): postings for a bucket, pairs to compare, members of large groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, bands, reach = Shingles(how.words), Bands(how), _reach(how)
        seen: set[int] = set()
        held: list[np.ndarray] = []
        count = 0

        def rows() -> Iterator[pa.RecordBatch]:
            joined = np.concatenate(held)
            held.clear()
            postings, group, sizes = _groups(joined)
            del joined
            crowded = sizes > how.direct
            pairs, members = _star(postings, group, crowded, reach)
            firsts = np.concatenate([[True], group[1:] != group[:-1]])
            postings["more"][crowded[group]] = 1
            postings = postings[firsts | ~crowded[group]]
            out: list[tuple[int, int, bytes]] = []
            for kind, data, by in ((0, postings, postings["mark"]), (1, pairs, pairs["y"]), (2, members, members["x"])):
                place = (_mixed(by.astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(place, kind="stable")
                data, place = data[order], place[order]
                ends = np.flatnonzero(np.concatenate([place[1:] != place[:-1], [True]])[: len(place)]) + 1
                start = 0
                for end in ends.tolist():
                    out.append((int(place[start]), kind, data[start:end].tobytes()))
                    start = end
            for k in range(0, len(out), 64):
                part = list(zip(*out[k : k + 64]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[0], pa.int32()), pa.array(part[1], pa.int32()), pa.array(part[2], pa.binary())],
                    names=["bucket", "kind", "data"],
                )

        for batch in batches:
            for value in batch.column(0):
                found = shingles.of(value.as_py())
                if not len(found):
                    continue
                number = identity(found)
                if number in seen:
                    continue
                if len(seen) > 200_000:
                    seen.clear()
                seen.add(number)
                marks = signatures(found, bands)
                entry = np.zeros(len(marks), POSTING)
                entry["mark"], entry["set"] = marks, number
                entry["size"] = min(255, int(28 * math.log(len(found))))
                held.append(entry)
                count += len(marks)
                if count >= how.flush:
                    yield from rows()
                    count = 0
        if count:
            yield from rows()
        release()

    return docs.select(text).mapInArrow(run, "bucket int, kind int, data binary")


def _matched(postings: DataFrame, how: Join) -> DataFrame:
    """(kind, x, y): kind 1 a pair of sets to compare, kind 2 a member y of the large group x."""
    reach = _reach(how)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        kinds = {k: b"".join(rows["data"][rows["kind"] == k]) for k in (0, 1, 2)}
        pairs = [np.frombuffer(kinds[1], PAIR)]
        members = [np.frombuffer(kinds[2], PAIR)]
        if kinds[0]:
            found, group, sizes = _groups(np.frombuffer(kinds[0], POSTING))
            large = (sizes > how.direct) | (np.bincount(group, weights=found["more"]) > 0)
            star, inside = _star(found, group, large, reach)
            pairs.append(star)
            members.append(inside)
            small = ~large
            for step in range(1, how.direct):
                a, b = np.arange(0, len(found) - step), np.arange(step, len(found))
                ok = (group[a] == group[b]) & small[group[a]]
                pairs.append(_pairs(found[a[ok]], found[b[ok]], reach))
        pairs, members = np.unique(np.concatenate(pairs)), np.unique(np.concatenate(members))
        kinds.clear()
        release()
        return pd.DataFrame(
            {
                "kind": np.repeat([1, 2], [len(pairs), len(members)]).astype(np.int32),
                "x": np.concatenate([pairs["x"], members["x"]]),
                "y": np.concatenate([pairs["y"], members["y"]]),
            }
        )

    return postings.groupBy("bucket").applyInPandas(run, "kind int, x long, y long")


def shingle_counts(docs: DataFrame, how: Join, key: str, text: str) -> DataFrame:
    """(key, n_shingles, set): the size and the number of each document's set; null if empty."""
    chosen = docs.select(key, text)
    schema = T.StructType([chosen.schema[0], T.StructField("n_shingles", T.LongType()), T.StructField("set", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(how.words)
        for batch in batches:
            sizes, sets = [], []
            for value in batch.column(1):
                found = shingles.of(value.as_py())
                sizes.append(len(found))
                sets.append(identity(found) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(sets, pa.int64())], names=schema.names
            )
        release()

    return chosen.mapInArrow(run, schema)


def _sets(docs: DataFrame, wanted: DataFrame, how: Join, key: str, text: str) -> DataFrame:
    """(set, n, sketch, shingles) of the sets that ``wanted`` (set, key) names, read from the texts."""
    keys = wanted.select(F.col("key").alias(key)).where(F.col(key).isNotNull()).distinct()
    if keys.count() * 32 <= BROADCAST_BYTES:
        keys = F.broadcast(keys)
    chosen = docs.select(key, text)
    chosen = chosen.join(keys, key, "left_semi").select(text).unionByName(chosen.where(F.col(key).isNull()).select(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(how.words)
        for batch in slices(batches):
            found = [f for f in (shingles.of(v.as_py()) for v in batch.column(0)) if len(f)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([identity(f) for f in found], pa.int64()),
                    pa.array([len(f) for f in found], pa.int64()),
                    pa.array([sketch(f).tobytes() for f in found], pa.binary()),
                    pa.array([f.tobytes() for f in found], pa.binary()),
                ],
                names=["set", "n", "sketch", "shingles"],
            )
        release()

    read = chosen.mapInArrow(run, "set long, n long, sketch binary, shingles binary")
    return read.dropDuplicates(["set"])


def _linked(pairs: DataFrame, sets: DataFrame, how: Join) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, compared exactly."""
    percent = how.percent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keep = []
            for one, two in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(one.as_py(), np.uint64), np.frombuffer(two.as_py(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                common = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])
        release()

    both = pairs.join(sets.select(F.col("set").alias("b"), F.col("shingles").alias("two")), "b").join(
        sets.select(F.col("set").alias("a"), F.col("shingles").alias("one")), "a"
    )
    return both.select("a", "b", "one", "two").mapInArrow(run, "a long, b long")


def _across(members: DataFrame, sets: DataFrame, how: Join) -> DataFrame:
    """(a, b): members (mark, set, met, label) of one large group, apart so far, that may be linked.

    Groups with one central set mostly hold the same sets, so they go to one task, which
    compares each of their pairs once, by sizes and sketches; with very many members the
    groups are dealt to several tasks. A group above ``block`` members is cut into chunks,
    and each two chunks are a task's work.
    """
    groups = members.groupBy("mark").agg(F.count(F.lit(1)).alias("n"), F.max_by("set", F.struct("met", "set")).alias("center"))
    groups = groups.withColumn("chunks", F.ceil(F.col("n") / how.block).cast("int"))
    tasks = groups.groupBy("center").agg(F.ceil(F.sum("n") / (8 * how.block)).alias("tasks"))
    task = F.concat_ws("/", "center", F.pmod(F.xxhash64("mark"), F.col("tasks")))
    chunk = F.pmod(F.xxhash64("set"), F.col("chunks")).cast("int")
    pair = lambda k: F.concat_ws("/", "mark", F.least(k, F.col("chunk")), F.greatest(k, F.col("chunk")))
    blocks = F.when(F.col("chunks") == 1, F.array(task)).otherwise(F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), pair))
    rows = (
        members.join(groups.join(tasks, "center"), "mark")
        .withColumn("chunk", chunk)
        .join(sets.select("set", F.col("n").alias("size"), "sketch"), "set")
        .select(F.explode(blocks).alias("block"), "mark", "chunk", "set", "label", "size", "sketch")
    )

    def run(part: pd.DataFrame) -> pd.DataFrame:
        bands = Bands(how)
        names, first, place = np.unique(part["set"].to_numpy(), return_index=True, return_inverse=True)
        sizes = part["size"].to_numpy()[first]
        labels = part["label"].to_numpy()[first]
        sketches = [np.frombuffer(s, "<u8") for s in part["sketch"].iloc[first]]
        chunks = part["chunk"].to_numpy()
        order = np.argsort(part["mark"].to_numpy(), kind="stable")
        marks = part["mark"].to_numpy()[order]
        found: list[np.ndarray] = []
        held = 0

        def settle() -> None:
            keys = np.unique(np.concatenate(found))
            pairs = np.stack([keys // len(names), keys % len(names)], axis=1)
            keep = may_be_linked(pairs, sizes, sketches, bands)
            settled.append(keys[keep])
            found.clear()

        settled: list[np.ndarray] = []
        for rows_of in np.split(order, np.flatnonzero(np.diff(marks)) + 1):
            inside = np.unique(place[rows_of])
            two = np.unique(chunks[rows_of])
            side = np.zeros(len(names), np.int64)
            side[place[rows_of]] = chunks[rows_of]
            for k, one in enumerate(inside):
                others = inside[k + 1 :]
                others = others[labels[others] != labels[one]]
                if len(two) > 1:
                    others = others[side[others] != side[one]]
                found.append(one * len(names) + others)
                held += len(others)
            if held > 1_000_000:
                settle()
                held = 0
        if found:
            settle()
        keys = np.unique(np.concatenate(settled)) if settled else np.zeros(0, np.int64)
        x, y = names[keys // len(names)], names[keys % len(names)]
        del sketches, settled, found
        release()
        return pd.DataFrame({"a": np.minimum(x, y), "b": np.maximum(x, y)})

    return rows.groupBy("block").applyInPandas(run, "a long, b long").distinct()


def link(
    docs: DataFrame, how: Join = Join(), key: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(counts, links, labels): every document's (key, n_shingles, set), verified links (a, b)
    of sets, and (node, label) of the sets that have links.

    Following the links reaches every set that any chain of similar sets reaches. Equal
    sets are one set. Not every similar pair is a link: pairs already joined are not
    compared. Null and empty texts have no set. Rows with a null key take part; repeated
    rows are equal sets.
    """
    counts = materialise(shingle_counts(docs, how, key, text), "shingle-counts")
    total = counts.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = max(64, math.ceil(0.4 * total / how.bucket))
    found = materialise(_matched(_postings(docs, how, text, buckets), how), "matched")
    pairs = found.where("kind = 1").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()
    members = found.where("kind = 2").select(F.col("x").alias("mark"), F.col("y").alias("set")).distinct()
    classes = counts.where("set is not null").groupBy("set").agg(F.min(key).alias("key"))
    named = pairs.select(F.explode(F.array("a", "b")).alias("set")).unionByName(members.select("set")).distinct()
    sets = materialise(_sets(docs, classes.join(named, "set", "left_semi"), how, key, text), "sets")

    # First each set with the least it shares a signature with, then what is still apart.
    pairs = materialise(pairs, "pairs")
    first = pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    links = materialise(_linked(first, sets, how), "links")
    labels = materialise(components(links), "labels")

    def apart(candidates: DataFrame) -> DataFrame:
        """Candidates (a, b) whose sets are not in one component."""
        one = labels.select(F.col("node").alias("a"), F.col("label").alias("la"))
        two = labels.select(F.col("node").alias("b"), F.col("label").alias("lb"))
        joined = candidates.join(one, "a", "left").join(two, "b", "left")
        return joined.where(F.coalesce("la", "a") != F.coalesce("lb", "b")).select("a", "b")

    second = materialise(_linked(apart(pairs).join(first, ["a", "b"], "left_anti"), sets, how), "links")
    if second.take(1):
        links = links.unionByName(second)
        labels = materialise(components(links), "labels")

    # Members of large groups: each with its group's most central set, the one that meets most
    # others, then with all that are still apart and that sizes and sketches allow.
    met = members.join(members.groupBy("mark").agg(F.count(F.lit(1)).alias("n")), "mark")
    central = materialise(met.groupBy("set").agg(F.sum("n").alias("met")), "central")
    members = materialise(members.join(central, "set"), "members")
    for last in (False, True):
        label = F.coalesce("label", "set").alias("label")
        labelled = members.join(labels.withColumnRenamed("node", "set"), "set", "left").select("mark", "set", "met", label)
        mixed = labelled.groupBy("mark").agg(F.min("label").alias("l"), F.max("label").alias("h")).where("l <> h")
        apart_still = materialise(labelled.join(mixed.select("mark"), "mark"), "mixed-groups")
        if not apart_still.take(1):
            break
        if last:
            across = _across(apart_still, sets, how)
        else:
            one = apart_still.select("mark", F.col("set").alias("a"), F.col("label").alias("la"))
            two = apart_still.groupBy("mark").agg(F.max_by(F.struct("set", "label"), F.struct("met", "set")).alias("c"))
            two = one.join(two, "mark").where("la <> c.label")
            across = two.select(F.least("a", "c.set").alias("a"), F.greatest("a", "c.set").alias("b")).distinct()
        found = materialise(_linked(materialise(across, "pairs"), sets, how), "links")
        if found.take(1):
            links = links.unionByName(found)
            labels = materialise(components(links), "labels")
    return counts, links, labels


def classes(docs: DataFrame, how: Join = Join(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, n_shingles, component_id.

    ``component_id`` is the least key that similar documents lead to, the document's own
    included; a document without words is linked with nothing. Where all keys of a
    component are null it is null.
    """
    counts, _, labels = link(docs, how, key, text)
    joined = counts.join(labels.withColumnRenamed("node", "set"), "set", "left").select(
        F.col(key), "n_shingles", F.coalesce("label", "set").alias("label")
    )
    joined = materialise(joined, "labelled")
    least = joined.where("label is not null").groupBy("label").agg(F.min(key).alias("least"))
    return joined.join(least, "label", "left").select(
        F.col(key), "n_shingles", F.when(F.col("label").isNull(), F.col(key)).otherwise(F.col("least")).alias("component_id")
    )


def keep_first(docs: DataFrame, how: Join = Join(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Documents that are the first of their component, by key, with their own columns.

    Rows of one key are one document and go or stay together, except that of rows with
    the same key and text one stays. Documents without words and rows with a null key stay.
    """
    judged = materialise(classes(docs, how, key, text), "judged")
    losers = judged.where(F.col(key) != F.col("component_id")).select(key).distinct()
    repeated = judged.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(key)

    def sized(keys: DataFrame) -> DataFrame:
        keys = materialise(keys, "keys")
        return F.broadcast(keys) if keys.count() * 32 <= BROADCAST_BYTES else keys

    losers, repeated = sized(losers), sized(repeated)
    kept = docs.join(losers, key, "left_anti")
    if repeated.take(1):
        again = kept.join(repeated, key, "left_semi").dropDuplicates([key, text])
        kept = kept.join(repeated, key, "left_anti").unionByName(again)
    return kept.select(*docs.columns)
