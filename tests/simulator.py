"""One change after the other, as the oracle for the parallel replay."""

import random

from pyspark.sql import types as T

IMAGE = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())])
CHANGES = T.StructType(
    [
        T.StructField("file_seq", T.LongType()),
        T.StructField("pos", T.LongType()),
        T.StructField("ordinal", T.IntegerType()),
        T.StructField("op", T.StringType()),
        T.StructField("before", IMAGE),
        T.StructField("after", IMAGE),
    ]
)


def positions(n, rnd):
    """Ascending positions with several rows per event and several files."""
    file_seq, pos, ordinal, out = 1, 4, 0, []
    for _ in range(n):
        out.append((file_seq, pos, ordinal))
        step = rnd.random()
        if step < 0.2:
            ordinal += 1
        elif step < 0.9:
            pos, ordinal = pos + rnd.randint(20, 200), 0
        else:
            file_seq, pos, ordinal = file_seq + 1, 4, 0
    return out


def bag_changes(seed, n, hot=0.4, domain=4, ops=("insert", "update", "delete")):
    """Random changes on few values; one value holds ``hot`` of all images."""
    rnd = random.Random(seed)

    def image():
        if rnd.random() < hot:
            return (1, "hot")
        k = rnd.choice([None, *range(domain)])
        return (k, rnd.choice(["a", None]))

    log = []
    for at in positions(n, rnd):
        op = rnd.choices(ops, weights=[3, 2, 1][: len(ops)])[0]
        log.append((*at, op, image() if op != "insert" else None, image() if op != "delete" else None))
    return log


def replay_bag(base, log):
    """(bag, positions of changes that met no row)"""
    bag, unmatched = list(base), []
    for file_seq, pos, ordinal, op, before, after in log:
        if op == "insert":
            bag.append(after)
            continue
        hits = bag.count(before)
        if not hits:
            unmatched.append((file_seq, pos, ordinal))
        bag = [r for r in bag if r != before] + ([after] * hits if op == "update" else [])
    return sorted(bag, key=repr), unmatched


def keyed_changes(seed, n, keys=12, moves=0.2):
    """A random log that is consistent with the base it returns."""
    rnd = random.Random(seed)
    table = {k: f"b{k}" for k in range(keys) if rnd.random() < 0.5}
    base, log = sorted(table.items()), []
    for i, at in enumerate(positions(n, rnd)):
        free = [k for k in range(keys) if k not in table]
        op = rnd.choice(["insert", "update", "update", "delete"])
        if op == "insert" and free:
            k = rnd.choice(free)
            table[k] = f"v{i}"
            log.append((*at, "insert", None, (k, table[k])))
        elif op == "update" and table:
            k = 0 if 0 in table and rnd.random() < 0.5 else rnd.choice(sorted(table))
            old, new = table.pop(k), f"v{i}"
            to = rnd.choice(free) if free and rnd.random() < moves else k
            table[to] = new
            log.append((*at, "update", (k, old), (to, new)))
        elif op == "delete" and table:
            k = rnd.choice(sorted(table))
            log.append((*at, "delete", (k, table.pop(k)), None))
    return base, log, sorted(table.items())


ROW = T.StructType([*IMAGE, T.StructField("w", T.IntegerType())])
NAMES = T.ArrayType(T.StringType())
PARTIAL = T.StructType(
    [
        *CHANGES.fields[:4],
        T.StructField("before", ROW),
        T.StructField("after", ROW),
        T.StructField("before_present", NAMES),
        T.StructField("after_present", NAMES),
    ]
)


def partial_changes(seed, n, patterns, inserts=3):
    """Random changes whose images carry only some of the columns k, v, w."""
    rnd = random.Random(seed)
    names = ROW.names

    def image(present):
        full = (rnd.choice([None, 0, 1]), rnd.choice(["a", None]), rnd.choice([7, 8]))
        return tuple(x if c in present else None for c, x in zip(names, full)), list(present)

    log = []
    for at in positions(n, rnd):
        op = rnd.choices(["insert", "update", "delete"], weights=[inserts, 4, 1])[0]
        before, b = image(rnd.choice(patterns)) if op != "insert" else (None, None)
        after, a = image(rnd.sample(names, rnd.randint(1, 3))) if op != "delete" else (None, None)
        log.append((*at, op, before, after, b, a))
    return log


def replay_partial_bag(base, log, defaults):
    """The bag of rows; absent columns of an insert take ``defaults`` (by name)."""
    bag, names = [dict(zip(ROW.names, r)) for r in base], ROW.names
    for *_, op, before, after, b, a in log:
        if op == "insert":
            bag.append({c: x if c in a else defaults.get(c) for c, x in zip(names, after)})
            continue
        wanted = {c: x for c, x in zip(names, before) if c in b}
        hit = [all(r[c] == x for c, x in wanted.items()) for r in bag]
        if op == "update":
            new = {c: x for c, x in zip(names, after) if c in a}
            bag = [{**r, **new} if h else r for r, h in zip(bag, hit)]
        else:
            bag = [r for r, h in zip(bag, hit) if not h]
    return sorted((tuple(r[c] for c in names) for r in bag), key=repr)
