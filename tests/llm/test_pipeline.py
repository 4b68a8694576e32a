"""The corpus pipeline, stage by stage, each against the operator's own oracle."""

import check
import pytest

import corpus_pipeline
from changetables.llm import queries

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage got and gave, written and read as Parquet."""
    folder = tmp_path_factory.mktemp("stages")
    docs, out = queries.table(spark, SF, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(folder / f"{name}.parquet"))
        after = spark.read.parquet(str(folder / f"{name}.parquet"))
        out[name] = (docs, after)
        docs = after
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def oracle(name, before):
    db = check.tables(SF)
    db.execute("drop view documents")
    db.register("documents", before.toPandas())
    return db.execute(queries.ORACLES[name]).df()


def test_columns_stay(stages):
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        assert all(r.n_chars == len(r.text) for r in after.collect())


def test_quality_rules(stages):
    before, after = stages["quality_rules"]
    want = oracle("op2_line_frequency", before)
    assert set(texts(after)) == set(want["doc_id"][want["kept"]])
    old, new = texts(before), texts(after)
    gone = dict(zip(want["doc_id"], want["n_words_removed"]))
    assert all(len(old[k].split()) - len(new[k].split()) == gone[k] for k in new)


def test_classifier(spark, stages):
    before, after = stages["quality_classifier"]
    labels = {r.doc_id: r for r in queries.table(spark, SF, "labels").collect()}
    old, new = texts(before), texts(after)
    assert new.items() <= old.items()
    good = [k for k in old if k in labels and labels[k].quality == 1 and labels[k].toxic == 0]
    bad = [k for k in old if k in labels and k not in good]
    assert sum(k in new for k in good) >= 0.95 * len(good)
    assert sum(k in new for k in bad) <= 0.4 * len(bad)


def test_near_duplicates(stages):
    before, after = stages["ngram_jaccard_join"]
    want = oracle("op10_partition_join", before)
    assert set(texts(after)) == set(want["doc_id"][want["doc_id"] == want["component_id"]])


def test_personal_data(stages):
    import re

    before, after = stages["pii"]
    old, new = texts(before), texts(after)
    assert old.keys() == new.keys()
    private = re.compile(r"[\w.]+@mail\d+\.example\.com|\+1 \(\d{3}\) 555-\d{4}")
    for k, text in old.items():
        assert not any(m in new[k] for m in private.findall(text))
        assert re.search(r"[0-9@]", text) or new[k] == text


def test_sequences(stages):
    before, after = stages["best_fit_packing"]
    rows = after.collect()
    assert {r.doc_id for r in rows} == set(texts(before))
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sum(n for _, n in v) <= 1024 and min(v)[0] == 0 for v in by.values())


def test_run(spark, stages):
    last = stages["best_fit_packing"][1]
    got = corpus_pipeline.run(spark, SF)
    cut = lambda df: sorted(tuple(r) for r in df.select("doc_id", "piece", "start", "length").collect())
    assert got.columns == last.columns and len(cut(got)) > 0
    assert cut(got) == cut(last)


def test_odd_rows_and_an_empty_table(spark, tmp_path):
    """Every stage by itself on null, empty and repeated rows, and on no rows."""
    long = "word " * 300
    data = [
        (None, long + "a", "en", "s", 1501),
        (1, None, None, None, None),
        (2, "", "en", "s", 0),
        (3, long, "en", "s", 1500),
        (3, long, "en", "s", 1500),
        (4, long + "b", None, None, 1501),
    ]
    schema = queries.table(spark, SF, "documents").schema
    docs = spark.createDataFrame(data, schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, SF)
        assert got.columns == schema.names
        assert stage(spark, docs.limit(0), SF).count() == 0, name
        if name == "pii":
            assert sorted(map(repr, got.collect())) == sorted(map(repr, docs.collect()))
        if name == "ngram_jaccard_join":
            assert sorted(map(str, (r.doc_id for r in got.collect()))) == sorted(["None", "1", "2", "3", "4"])
        if name == "quality_rules":
            assert all(r.text for r in got.collect())
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, docs, SF).count() == 6
    assert last(spark, docs.limit(0), SF).count() == 0
