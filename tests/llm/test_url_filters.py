"""URL rules and host reputation."""

import check
import pytest

from changetables.llm import queries, url_filters
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"

URLS = [
    (None, "", "", None),
    ("no scheme", "", "", None),
    ("", "", "", None),
    ("http://a.com", "a.com", "", None),
    ("http://a.com/", "a.com", "/", "com/"),
    ("HTTPS://WWW.Example.COM/en/1?x#y", "www.example.com", "/en/1", "www.example.com/en/"),
    ("http://x.www.example.com/en/", "x.www.example.com", "/en/", "www.example.com/en/"),
    ("http://b.example.com/en/x", "b.example.com", "/en/x", "example.com/en/"),
    ("http://notexample.com/en/x", "notexample.com", "/en/x", "com/"),
    ("http://b.example.com/EN/x", "b.example.com", "/EN/x", "com/"),
    ("ftp://net/es/", "net", "/es/", "net/es/"),
    ("http://a.net?/fr/", "a.net", "", None),
    ("http://ÄB.net/fr/://b.com/", "Äb.net", "/fr/://b.com/", "net/fr/"),
    ("http://" + "a" * 100_000 + ".org/x", "a" * 100_000 + ".org", "/x", None),
]


def judge(spark, rows, outcomes):
    pages = spark.createDataFrame(rows, "page_id int, url string, doc_id long, judged string")
    labels = spark.createDataFrame(outcomes, "doc_id long, bad boolean")
    return url_filters.judge(pages, labels, F.col("doc_id"), queries.URL_RULES)


def test_rules(spark):
    rows = [(i, u[0], None, "x") for i, u in enumerate(URLS)] * 2
    got = judge(spark, rows, []).select("page_id", "judged.*").collect()
    assert len(got) == 2 * len(URLS)
    for r in got:
        assert (r.host, r.path, r.rule) == URLS[r.page_id][1:]
        assert r.verdict == (queries.URL_RULES[r.rule] if r.rule else "allow")


def test_reputation_shrinks(spark):
    """A host with many bad pages is blocked; one bad page of a new host is not enough."""
    rows, labels = [], []
    for k, (host, n, bad) in enumerate([("bad.a.org", 60, 58), ("good.b.org", 400, 4), ("new.c.org", 1, 1), ("none.d.org", 5, 0)]):
        for i in range(n):
            rows.append((len(rows), f"http://{host}/{i}", 1000 * k + i, "x"))
            if host[0:4] != "none":
                labels += [(1000 * k + i, i < bad)]
    labels += labels[:10] + [(None, True)]
    got = {r.host: r for r in judge(spark, rows, labels).select("judged.*").distinct().collect()}
    assert {h: r.verdict for h, r in got.items()} == {
        "bad.a.org": "block", "good.b.org": "allow", "new.c.org": "allow", "none.d.org": "allow",
    }
    assert got["good.b.org"].bad_rate < 0.1 < got["new.c.org"].bad_rate < got["bad.a.org"].bad_rate
    assert (got["bad.a.org"].n_labels, got["bad.a.org"].n_bad, got["none.d.org"].n_labels) == (60, 58, 0)


def test_empty_tables(spark):
    assert judge(spark, [], []).count() == 0


@pytest.mark.parametrize("name", ["op2_line_frequency", "op4_host_reputation"])
def test_sql(spark, name):
    got = queries.QUERIES[name](spark, SF).toPandas()
    assert check.compare(got, check.tables(SF).execute(queries.ORACLES[name]).df()) == ""
