"""Best-fit packing of tokenised documents by a grouping genetic algorithm.

Documents longer than a sequence are cut; whole pieces are sequences of their own. The
other pieces are dealt by hash into blocks of bounded size. Several islands evolve
packings of a block: crossover injects the well-filled bins of one parent into the other,
drops the bins that hold the same pieces and puts the displaced pieces back by best fit.
Between rounds each island's elite moves to the next island. Bins with next to no room
left are final; the pieces of the others meet those of other blocks on the next level.
"""

from __future__ import annotations

import json
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changetables.llm.common import release
from changetables.session import materialise


@dataclass(frozen=True)
class Evolution:
    """Sizes of the search.

    A block has about ``block`` pieces. ``tolerance`` is the room that a final bin may
    have, as a share of a sequence; the bins of the last level are all final. An island
    rests after ``patience`` children without a better best packing.
    """

    block: int = 32768
    islands: int = 2
    rounds: int = 2
    population: int = 4
    generations: int = 24
    patience: int = 3
    elite: int = 2
    levels: int = 3
    tolerance: float = 0.05


# ---------------------------------------------------------------- tokens


class ByteBpe:
    """Ids of a byte-level BPE vocabulary file, as the public library gives them.

    ``special``: a special string in a text is its one id; else it is ordinary text.
    """

    #: Longer runs without or of white space go to the engine whose time does not grow with their square.
    LONG_RUN = 1000

    def __init__(self, definition: str, special: bool = True):
        import re

        import tiktoken
        import tokenizers

        self.whole = tokenizers.Tokenizer.from_str(definition)
        self.whole.encode_special_tokens = not special
        added = [t["content"] for t in json.loads(definition).get("added_tokens", []) if t["content"]]
        self.special = re.compile("|".join(map(re.escape, added))) if special and added else None
        model = json.loads(definition)["model"]
        self.long_run = re.compile(rf"\S{{{self.LONG_RUN}}}|\s{{{self.LONG_RUN}}}")
        vocabulary = model["vocab"]
        merges = [m.split(" ", 1) if isinstance(m, str) else m for m in model["merges"]]
        merged = [vocabulary[a + b] for a, b in merges]
        letters = self._letters()
        self.fast = None
        if merged == sorted(merged):  # a merge's place is its id's, so ranks say the same as merges
            special = {t["id"] for t in json.loads(definition).get("added_tokens", [])}
            ranks = {bytes(letters[c] for c in t): i for t, i in vocabulary.items() if i not in special}
            pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
            self.fast = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    @staticmethod
    def _letters() -> dict[str, int]:
        """The byte that each character of a byte-level vocabulary stands for."""
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in plain]
        return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}

    def encode(self, text: str) -> np.ndarray:
        if self.fast is None or self.long_run.search(text) or (self.special and self.special.search(text)):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return np.array(self.fast.encode_ordinary(text), dtype="<u4")


def tokenised_pieces(
    docs: DataFrame,
    tokenizer: str,
    limit: int,
    end_id: int,
    key: str = "doc_id",
    text: str = "text",
    keep_ids: bool = False,
    special: bool = True,
) -> DataFrame:
    """Pieces of at most ``limit`` tokens: key, piece, start, length, ids_crc32, ids if kept.

    A document is the ids of its text (null: empty) and ``end_id``. Only longer ones are
    cut, into pieces of ``limit``, of which the first may be shorter. Repeated rows give
    repeated pieces. The vocabulary file is read once, by the driver. ``special`` strings
    in a text are their own ids, or ordinary text.
    """
    definition = Path(tokenizer).read_text()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        engine = ByteBpe(definition, special)
        for batch in batches:
            rows, numbers, starts, lengths, sums, kept = [], [], [], [], [], []
            for row, value in enumerate(batch.column(1)):
                ids = np.append(engine.encode(value.as_py() or ""), np.uint32(end_id)).astype("<u4")
                cut = len(ids) % limit or limit
                bounds = [0, *range(cut, len(ids) + 1, limit)]
                for piece, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    part = ids[a:b]
                    rows.append(row)
                    numbers.append(piece)
                    starts.append(a)
                    lengths.append(b - a)
                    sums.append(zlib.crc32(part.tobytes()))
                    if keep_ids:
                        kept.append(part.astype(np.int32))
            columns = [
                batch.column(0).take(pa.array(rows, pa.int64())),
                pa.array(numbers, pa.int32()),
                pa.array(starts, pa.int64()),
                pa.array(lengths, pa.int64()),
                pa.array(sums, pa.int64()),
            ]
            if keep_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)
        release()

    chosen = docs.select(key, text)
    schema = T.StructType(
        [chosen.schema[0], T.StructField("piece", T.IntegerType())]
        + [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32")]
        + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * keep_ids
    )
    return chosen.mapInArrow(pieces, schema)


# ---------------------------------------------------------------- one island


def best_fit(order, lengths: list[int], room: int, loads: list[int], bins: np.ndarray) -> None:
    """Put the pieces of ``order`` each into the fullest bin that holds it, or a new one.

    ``loads`` and ``bins`` (a piece's bin) are changed in place. A bit set of the free
    rooms that occur finds the bin in constant time.
    """
    by_room: dict[int, list[int]] = defaultdict(list)
    mask = 0
    for b, load in enumerate(loads):
        if load < room:
            by_room[room - load].append(b)
            mask |= 1 << (room - load)
    for i in order:
        size = lengths[i]
        fitting = mask >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            same = by_room[free]
            b = same.pop()
            if not same:
                mask &= ~(1 << free)
            loads[b] += size
        else:
            free, b = room, len(loads)
            loads.append(size)
        bins[i] = b
        if free > size:
            by_room[free - size].append(b)
            mask |= 1 << (free - size)


def fitness(bins: np.ndarray, lengths: np.ndarray) -> tuple[int, float]:
    """Smaller is better: the number of bins, then how evenly they are filled."""
    loads = np.bincount(bins, weights=lengths)
    return len(loads), -float(np.dot(loads, loads))


def cross(a: np.ndarray, b: np.ndarray, lengths: np.ndarray, room: int, rng: np.random.Generator) -> np.ndarray:
    """A child of ``a`` with well-filled bins of ``b`` in place of those that they overlap."""
    loads = np.bincount(b, weights=lengths)
    good = np.flatnonzero(loads >= np.quantile(loads, 0.5))
    chosen = np.zeros(len(loads), bool)
    chosen[rng.choice(good, max(1, int(len(good) * rng.uniform(0.1, 0.4))), replace=False)] = True
    injected = chosen[b]
    dropped = np.zeros(a.max() + 1, bool)
    dropped[a[injected]] = True
    poor = np.bincount(a, weights=lengths)
    dropped |= poor < np.quantile(poor, rng.uniform(0.0, 0.15))
    loose = dropped[a] & ~injected
    child = np.where(injected, b + len(dropped), a)
    fixed = np.flatnonzero(~loose)
    _, child[fixed] = np.unique(child[fixed], return_inverse=True)
    filled = np.bincount(child[fixed], weights=lengths[fixed]).astype(np.int64).tolist()
    out = np.flatnonzero(loose)
    noise = rng.uniform(0, 0.1 * room, len(out)) if rng.random() < 0.5 else 0
    best_fit(out[np.argsort(-(lengths[out] + noise), kind="stable")].tolist(), lengths.tolist(), room, filled, child)
    return child


def evolve(lengths: np.ndarray, room: int, seeds: list[np.ndarray], how: Evolution, rng: np.random.Generator) -> list[np.ndarray]:
    """Best packings first, after some generations from ``seeds`` and noisy best-fit packings.

    The search ends at the lower bound: all tokens, or all pieces above half a sequence.
    """
    sizes = lengths.tolist()
    people = [np.asarray(s) for s in seeds]
    least = max(-(-int(lengths.sum()) // room), int((2 * lengths > room).sum()))
    while len(people) < how.population:
        noise = rng.uniform(0, room * 0.2 * rng.random(), len(lengths)) if people else 0
        bins = np.zeros(len(lengths), np.int64)
        best_fit(np.argsort(-(lengths + noise), kind="stable").tolist(), sizes, room, [], bins)
        people.append(bins)
        if fitness(bins, lengths)[0] == least:
            break
    ranked = sorted(((fitness(p, lengths), k, p) for k, p in enumerate(people)), key=lambda x: x[:2])
    idle = 0
    for step in range(how.generations):
        if ranked[0][0][0] == least or len(ranked) < 2 or idle == how.patience:
            break
        one, two = sorted(rng.choice(len(ranked), 2, replace=False))
        child = cross(ranked[one][2], ranked[two][2], lengths, room, rng)
        mark = fitness(child, lengths)
        idle = 0 if mark < ranked[0][0] else idle + 1
        if mark < ranked[-1][0]:
            ranked[-1] = (mark, how.population + step, child)
            ranked.sort(key=lambda x: x[:2])
    return [p for _, _, p in ranked]


# ---------------------------------------------------------------- all blocks


def _level(items: DataFrame, room: int, how: Evolution, level: int, blocks: int) -> DataFrame:
    """``items`` (uid, length, ...) with sequence_id, offset and free, packed block by block."""

    def frame(rows: pd.DataFrame) -> pd.DataFrame:
        return rows.sort_values(["length", "__uid"], ascending=[False, True], kind="stable").reset_index(drop=True)

    def rng(block: int, island: int, turn: int) -> np.random.Generator:
        return np.random.default_rng([level, block, island, turn])

    def elite(block: int, island: int, turn: int, lengths: np.ndarray, seeds: list[np.ndarray]) -> pd.DataFrame:
        best = evolve(lengths, room, seeds, how, rng(block, island, turn))[: how.elite]
        return pd.DataFrame(
            {"__block": block, "__island": island, "rank": range(len(best)), "bins": [p.astype("<u4").tobytes() for p in best]}
        )

    def first(key, rows: pd.DataFrame) -> pd.DataFrame:
        return elite(int(key[0]), int(key[1]), 0, frame(rows)["length"].to_numpy(np.int64), [])

    def later(turn: int):
        def run(key, rows: pd.DataFrame, seeds: pd.DataFrame) -> pd.DataFrame:
            seeds = seeds.sort_values(["rank", "source"])
            people = [np.frombuffer(s, "<u4").astype(np.int64) for s in seeds["bins"]][: how.population]
            return elite(int(key[0]), int(key[1]), turn, frame(rows)["length"].to_numpy(np.int64), people)

        return run

    def settle(rows: pd.DataFrame, people: pd.DataFrame) -> pd.DataFrame:
        rows = frame(rows)
        lengths = rows["length"].to_numpy(np.int64)
        options = [np.frombuffer(s, "<u4").astype(np.int64) for s in people.sort_values(["__island", "rank"])["bins"]]
        rows["__bin"] = min(options, key=lambda p: fitness(p, lengths))
        rows = rows.sort_values(["__bin", "__uid"], kind="stable")
        groups = rows.groupby("__bin", sort=False)
        rows["offset"] = groups["length"].cumsum() - rows["length"]
        rows["sequence_id"] = groups["__uid"].transform("min")
        rows["__free"] = room - groups["length"].transform("sum")
        return rows[names]

    dealt = items.withColumn("__block", F.pmod(F.xxhash64(F.lit(level), "__uid"), F.lit(blocks)).cast("int"))
    copies = F.explode(F.array(*(F.lit(k) for k in range(how.islands)))).alias("__island")
    narrow = dealt.select("__block", "__uid", "length", copies)
    people_schema = "__block int, __island int, rank int, bins binary"
    people = narrow.groupBy("__block", "__island").applyInPandas(first, people_schema)
    for turn in range(1, how.rounds):
        moved = people.select(
            "__block",
            F.col("__island").alias("source"),
            "rank",
            "bins",
            F.explode(F.array_distinct(F.array("__island", ((F.col("__island") + 1) % how.islands).cast("int")))).alias("__island"),
        )
        people = (
            narrow.groupBy("__block", "__island")
            .cogroup(moved.groupBy("__block", "__island"))
            .applyInPandas(later(turn), people_schema)
        )
    schema = T.StructType(list(items.schema) + [T.StructField(n, T.LongType()) for n in ("sequence_id", "offset", "__free")])
    names = schema.names
    return dealt.groupBy("__block").cogroup(people.groupBy("__block")).applyInPandas(settle, schema)


def pack(pieces: DataFrame, room: int, how: Evolution = Evolution()) -> DataFrame:
    """``pieces`` (length <= ``room``, any other columns) with sequence_id and offset.

    Every input row comes back once. No sequence holds more than ``room`` tokens; offsets
    are gapless from 0 in each. Sequence numbers are unique, with gaps. Columns of these
    two names are replaced.
    """
    pieces = pieces.drop("sequence_id", "offset")
    numbered = pieces.withColumn("__uid", F.monotonically_increasing_id())
    numbered = materialise(numbered, "pieces")
    columns = [*pieces.columns, "sequence_id", "offset"]
    done = [
        numbered.where(F.col("length") >= room)
        .withColumn("sequence_id", F.col("__uid"))
        .withColumn("offset", F.lit(0).cast("long"))
        .select(columns)
    ]
    items = numbered.where(F.col("length") < room)
    left = items.count()
    for level in range(how.levels):
        if not left:
            break
        blocks = -(-left // how.block)
        packed = materialise(_level(items, room, how, level, blocks), "packed")
        last = blocks == 1 or level == how.levels - 1
        final = F.lit(True) if last else F.col("__free") <= int(how.tolerance * room)
        done.append(packed.where(final).select(columns))
        items = packed.where(~final).select(*numbered.columns)
        left = 0 if last else items.count()
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out
