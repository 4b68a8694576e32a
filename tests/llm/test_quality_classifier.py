"""Quality classifier: held-out accuracy, shrinkage of sites, odd input."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from changetables.llm import quality_classifier as q
from changetables.llm import queries

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    """Labels of a fifth of the documents are hidden from training and counted after."""
    docs, labels = (queries.table(spark, SF, t) for t in ("documents", "labels"))
    hidden = F.pmod("doc_id", F.lit(5)) == 3
    out = q.classify(docs, labels.where(~hidden)).select("doc_id", "classified.kept")
    rows = out.join(labels.where(hidden), "doc_id").toPandas()
    bad = (rows["quality"] == 0) | (rows["toxic"] == 1)
    assert len(rows) > 500
    assert (~rows["kept"][bad]).mean() > 0.9
    assert rows["kept"][~bad].mean() > 0.98


def test_whole_table(spark):
    docs = queries.table(spark, SF.replace("0.1", "0.01"), "documents")
    out = queries.QUERIES["op9_site_classifier"](spark, SF.replace("0.1", "0.01")).toPandas()
    assert sorted(out["doc_id"]) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    assert out[["evidence", "host_rate", "path_rate", "p_bad"]].notna().all().all()


@pytest.fixture(scope="module")
def sites(spark):
    """A clean and a foul site with many labels, and one with a single document."""
    rng = np.random.default_rng(2)
    vocabulary = [f"w{i}" for i in range(200)]
    data, labels = [], []
    for i in range(600):
        site, foul = ("good", 0.02) if i % 2 else ("foul", 0.9)
        bad = bool(rng.random() < foul)
        text = " ".join(rng.choice(vocabulary, 80)) + (" vile" if bad and rng.random() < 0.6 else "")
        data.append((i, text, site, "en", "x"))
        labels.append((i, 1, int(bad)))
    plain = " ".join(vocabulary[:80])
    data += [(1000, plain, "good", "en", "x"), (1001, plain, "foul", "en", "x"), (1002, plain, "new", None, "x")]
    data += [(1003, None, None, None, None), (1004, "", "good", "en", "x"), (1005, plain * 3000, "good", "en", "x")]
    data += [(None, plain, "good", "en", "x")] * 2
    docs = spark.createDataFrame(data, "doc_id long, text string, source string, lang string, classified string")
    return docs, spark.createDataFrame(labels + labels[:9] + [(None, 0, 1)], "doc_id long, quality int, toxic int")


def test_sites_shift_the_verdict(spark, sites):
    out = {r.doc_id: r for r in q.classify(*sites).where("doc_id >= 1000").select("doc_id", "classified.*").collect()}
    assert out[1000].path_rate < 0.15 < 0.6 < out[1001].path_rate
    assert out[1000].path_rate < out[1002].path_rate < out[1001].path_rate
    assert out[1000].kept and not out[1001].kept
    assert out[1003].evidence == out[1004].evidence == 0
    assert q.classify(*sites).count() == sites[0].count()
    assert q.keep_good(*sites).columns == sites[0].columns


def test_no_labels_and_empty_tables(spark, sites):
    docs, labels = sites
    out = q.classify(docs, labels.limit(0)).select("classified.*").collect()
    assert all(r.evidence == 0 and abs(r.p_bad - 0.5) < 0.01 for r in out)
    assert q.classify(docs.limit(0), labels).count() == 0
