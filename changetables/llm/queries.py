"""Registered queries of this package and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changetables.llm import (
    jaccard_join,
    packing,
    prefix_forest,
    pseudonyms,
    quality_classifier,
    quality_rules,
    ranked_search,
    secrets,
    sentencepiece_unigram,
    sharding,
    simhash_variants,
    spelling_variants,
    url_filters,
)
from changetables.session import materialise, scratch_root

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL if there is one."""

    def add(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


LINE_FREQUENCY_SQL = r"""
with docs as (
  select row_number() over () as rid, doc_id, coalesce(text, '') as text, coalesce(source, '') as host,
         text is not null as has_text from documents),
lines as (
  select rid, host, text, has_text, unnest(string_split(text, chr(10))) as raw,
         unnest(range(len(string_split(text, chr(10))))) as k from docs),
normal as (
  select *, trim(regexp_replace(regexp_replace(lower(raw), '[\x20\x09\x0B-\x0D]+', ' ', 'g'), '[0-9]+', '0', 'g')) as line,
         len(regexp_extract_all(raw, '[^\x20\x09-\x0D]+')) as w from lines),
texts as (select host, count(distinct text) as n_texts from docs where has_text group by host),
frequent as (
  select host, line from normal join texts using (host) where line <> '' and has_text
  group by host, line, n_texts having count(distinct text) > 10 and count(distinct text) > 0.01 * n_texts),
removed as (
  select rid, count(f.line) as n_lines_removed, coalesce(sum(w) filter (f.line is not null), 0) as n_words_removed
  from normal n left join frequent f on n.host = f.host and n.line = f.line group by rid),
dup as (
  select rid, count(*) filter (w > 0) - count(distinct raw) filter (w > 0) as n_dup_lines from normal group by rid),
words as (select rid, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as w from docs),
windows as (
  select rid, unnest(range(1, len(w) - 1)) as p, w[unnest(range(1, len(w) - 1))] as a,
         w[unnest(range(1, len(w) - 1)) + 1] as b, w[unnest(range(1, len(w) - 1)) + 2] as c
  from words where len(w) > 2),
again as (select rid, p from (select *, count(*) over (partition by rid, a, b, c) as n from windows) where n > 1),
repeated as (
  select rid, count(distinct q) as n_repeat_words from (select rid, unnest([p, p + 1, p + 2]) as q from again) group by rid),
stat as (
  select rid, doc_id, len(w)::bigint as n_words,
         length(array_to_string(w, ''))::bigint as word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
         coalesce(n_dup_lines, 0)::bigint as n_dup_lines,
         coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
         n_lines_removed::bigint as n_lines_removed, n_words_removed::bigint as n_words_removed
  from docs join words using (rid) left join dup using (rid) left join repeated using (rid) join removed using (rid))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
       not (n_words < 50 or 100 * n_repeat_words > 50 * n_words)
         and n_words - n_words_removed >= 0.5 * n_words as kept,
       n_lines_removed, n_words_removed
from stat
"""


@query(LINE_FREQUENCY_SQL)
def op2_line_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's statistics and verdict, with lines that its host repeats taken out."""
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    columns = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept n_lines_removed n_words_removed"
    return judged.select("doc_id", *(f"verdict.{name}" for name in columns.split()))


#: Stands for the key that a caller takes from its own store of secrets.
PSEUDONYM_KEY = "key of the registered query"


@query()
def op3_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data replaced, and how many values of each kind."""
    out = pseudonyms.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), PSEUDONYM_KEY)
    count = lambda k: F.size(F.filter("replaced", lambda x: x == k)).cast("long").alias(f"n_{k}")
    return out.select("doc_id", "text", *(count(k) for k in pseudonyms.KINDS))


# The rules of the result's contract.
URL_RULES = {
    "com/": "allow",
    "example.com/en/": "block",
    "www.example.com/en/": "allow",
    "net/es/": "block",
    "net/fr/": "block",
}

HOST_REPUTATION_SQL = r"""
with parts as (
  select page_id, url, coalesce(case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end, '') as rest
  from pages),
split as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from parts),
linked as (select *, try_cast(regexp_extract(path, '/([0-9]{1,18})(?:\.html)?/?$', 1) as bigint) as doc_id from split),
outcomes as (select doc_id, max(case when quality = 0 or toxic = 1 then 1 else 0 end) as bad from labels group by doc_id),
hosts as (
  select host, count(o.bad) as n, coalesce(sum(o.bad), 0) as bad,
         case when array_to_string(string_split(host, '.')[-2:], '.') in {suffixes}
           then array_to_string(string_split(host, '.')[-3:], '.')
           else array_to_string(string_split(host, '.')[-2:], '.') end as domain,
         case when array_to_string(string_split(host, '.')[-2:], '.') in {suffixes}
           then array_to_string(string_split(host, '.')[-2:], '.') else string_split(host, '.')[-1] end as suffix
  from linked left join outcomes o using (doc_id) group by host),
top as (select (sum(bad) + 0.5) / (sum(n) + 1.0) as above from hosts),
s0 as (select suffix, sum(n) as n, sum(bad) as bad, any_value(above) as above from hosts, top group by suffix),
sw as (select sum(case when n > 0 then pow(bad / n - above, 2) * n / (above * (1 - above)) end) as s,
              count(*) filter (n > 0) as g, sum(n) as n from s0),
sk as (select case when g = 0 or n <= g or s <= g then 1000.0
                   else least(1000.0, greatest(2.0, (n - g) / (s - g) - 1)) end as w from sw),
s1 as (select suffix, (bad + w * above) / (n + w) as above from s0, sk),
d0 as (select domain, suffix, sum(n) as n, sum(bad) as bad from hosts group by all),
d1 as (select d0.*, s1.above from d0 join s1 using (suffix)),
dw as (select sum(case when n > 0 then pow(bad / n - above, 2) * n / (above * (1 - above)) end) as s,
              count(*) filter (n > 0) as g, sum(n) as n from d1),
dk as (select case when g = 0 or n <= g or s <= g then 1000.0
                   else least(1000.0, greatest(2.0, (n - g) / (s - g) - 1)) end as w from dw),
d2 as (select domain, (bad + w * above) / (n + w) as above from d1, dk),
h1 as (select hosts.*, d2.above from hosts join d2 using (domain)),
hw as (select sum(case when n > 0 then pow(bad / n - above, 2) * n / (above * (1 - above)) end) as s,
              count(*) filter (n > 0) as g, sum(n) as n from h1),
hk as (select case when g = 0 or n <= g or s <= g then 1000.0
                   else least(1000.0, greatest(2.0, (n - g) / (s - g) - 1)) end as w from hw),
h2 as (select host, n, bad, (bad + w * above) / (n + w) as rate, n + w as weight from h1, hk),
known as (select *, rate - 2 * sqrt(rate * (1 - rate) / (weight + 1)) as bound from h2),
fits as (
  select page_id, host, path, case
    when (host = 'www.example.com' or host like '%.www.example.com') and starts_with(path, '/en/') then 'www.example.com/en/'
    when (host = 'example.com' or host like '%.example.com') and starts_with(path, '/en/') then 'example.com/en/'
    when (host = 'net' or host like '%.net') and starts_with(path, '/es/') then 'net/es/'
    when (host = 'net' or host like '%.net') and starts_with(path, '/fr/') then 'net/fr/'
    when (host = 'com' or host like '%.com') and starts_with(path, '/') then 'com/' end as rule
  from split)
select page_id, f.host, path, rule,
       case when rule in ('com/', 'www.example.com/en/') then 'allow' when rule is not null then 'block'
            when bound > 0.5 then 'block' else 'allow' end as verdict,
       n::bigint as n_labels, bad::bigint as n_bad, round(rate, 6) as bad_rate, round(bound, 6) as bad_bound
from fits f join known k on f.host = k.host
""".replace("{suffixes}", str(url_filters.TWO_LABEL_SUFFIXES))


@query(HOST_REPUTATION_SQL)
def op4_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url under the rules and the reputation of its host.

    A page's path ends in the number of the document it shows; a document's labels are
    the outcome of its pages.
    """
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labels = table(spark, sf_dir, "labels")
    outcomes = labels.select("doc_id", ((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    path = url_filters.host_and_path(F.col("url"))["path"]
    number = F.regexp_extract(path, r"/([0-9]{1,18})(?:\.html)?/?$", 1)
    doc_id = F.when(number != "", number.cast("long"))
    judged = url_filters.judge(pages, outcomes, doc_id, URL_RULES)
    rounded = [F.round(f"judged.{c}", 6).alias(c) for c in ("bad_rate", "bad_bound")]
    return judged.select("page_id", *(f"judged.{c}" for c in "host path rule verdict n_labels n_bad".split()), *rounded)


@query()
def op6_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, by pattern and by character model."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.find(docs, secrets.train(docs))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] < 3)
    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"),
        count(3).alias("n_markov"),
    )


@query()
def op7_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards of near-equal bytes."""
    folder = f"{scratch_root(spark)}/slot-maps-{uuid.uuid4().hex}"
    placed = sharding.shard_by_slots(table(spark, sf_dir, "documents"), 8, folder)
    return placed.select(
        F.col("key").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("place").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("slot").alias("virtual_slot"),
    )


#: Tokens of a sequence, and the id that ends a document.
SEQUENCE, END_ID = 1024, 2


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    """Path of an installed public vocabulary file."""
    return public_tokenizers.path(name)


@query()
def op8_genetic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    docs = table(spark, sf_dir, "documents")
    return packing.pack(packing.tokenised_pieces(docs, vocabulary(), SEQUENCE, END_ID), SEQUENCE)


@query()
def op9_site_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's posterior of being bad, from its text and its site."""
    out = quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "classified.*")


@query()
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's unigram pieces, decoded again to see that nothing was lost."""
    return sentencepiece_unigram.encode(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


NEAR_DUPLICATES_SQL = r"""
with recursive words as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
starts as (select doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from words where len(w) > 0),
shingles as (select distinct doc_id, array_to_string(w[i:i + 4], ' ') as s from starts),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as o
  from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by all),
links as (
  select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b
  where 100 * o >= 80 * (x.n + y.n - o)),
both_ways as (select a, b from links union all select b, a from links),
reached as (
  select doc_id as a, doc_id as b from documents
  union
  select r.a, l.b from reached r join both_ways l on r.b = l.a)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, c.component_id
from documents d left join sizes using (doc_id) join (select a, min(b) as component_id from reached group by a) c on c.a = d.doc_id
"""


@query(NEAR_DUPLICATES_SQL)
def op10_partition_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component of near duplicates."""
    return jaccard_join.classes(table(spark, sf_dir, "documents"))


@query()
def op5_prefix_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector, among all vectors."""
    return prefix_forest.search(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(20)) == 0)


RANKED_SEARCH_SQL = r"""
with docs as (
  select row_number() over () as rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as w
  from documents),
held as (select rid, doc_id, w, len(w) as n from docs where len(w) > 0),
total as (select count(*) as big_n, sum(n) as big_l from held),
counts as (select rid, t, count(*) as tf from (select rid, unnest(w) as t from held) group by all),
weights as (
  select t, cast(floor(1000 * ln((2 * any_value(big_n) + 2)::double / (2 * count(*) + 1)::double)) as bigint) as w
  from counts, total group by t),
norms as (select rid, doc_id, 100 - 25 + cast((25 * n * big_n) // big_l as bigint) as m from held, total),
asked as (
  select q, item_id, t, count(*) as r from (
    select row_number() over () as q, item_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as t from benchmark) group by all),
scored as (
  select q, item_id, rid, doc_id, sum(r * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::bigint as score
  from asked join counts using (t) join weights using (t) join norms using (rid) group by all),
ranked as (
  select *, row_number() over (partition by q order by score desc, doc_id) as rank from scored where score > 0)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= 20
"""


@query(RANKED_SEARCH_SQL)
def op11_pair_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents for every benchmark item."""
    index = materialise(ranked_search.build_index(table(spark, sf_dir, "documents")), "index")
    return ranked_search.search(index, table(spark, sf_dir, "benchmark"))


@query()
def op12_simhash_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and component of near duplicates."""
    found = simhash_variants.classes(table(spark, sf_dir, "documents"))
    return found.withColumn("fingerprint", simhash_variants.as_hex(F.col("fingerprint")))


@query()
def op13_count_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word with its form and root, a letter dropped from one run in 97."""
    how = spelling_variants.Variants(drop_one_in=97)
    return spelling_variants.group(spelling_variants.count_words(table(spark, sf_dir, "documents"), how), how)
