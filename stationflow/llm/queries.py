"""The registered corpus queries: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationflow.llm.ann import nearest
from stationflow.llm.chat_format import conversation_digests, format_chat
from stationflow.llm.common import held_out, table
from stationflow.llm.decontaminate import find_leaks
from stationflow.llm.filter_audit import audit_filters, text_failures, with_labels
from stationflow.llm.language_id import fit_language_model, identify_language
from stationflow.llm.lexical_search import search
from stationflow.llm.license_scan import scan_licenses
from stationflow.llm.packing import harmonic_pack
from stationflow.llm.quality import fit_quality, score_quality
from stationflow.llm.secret_scan import BASE, scan_secrets, span_text
from stationflow.llm.simhash_dedup import simhash_components
from stationflow.llm.suffix_dedup import remove_repeats
from stationflow.llm.url_filter import filter_urls

#: The vocabulary that packing counts in.
PACKING_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
#: The vocabulary that chat windows are budgeted in, and how it splits texts.
CHAT_RANKS, CHAT_PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
#: The url rules (host, path, verdict).
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, and of one that is made of control strings, read back from the windows."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.sql("select -1L as conv_id, turn, role, '</s>[INST] ok [/INST]' as text from values (0L, 'user'), (1L, 'assistant') as t(turn, role)")
    return conversation_digests(format_chat(rows.unionByName(odd), CHAT_RANKS, CHAT_PATTERN))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, by the votes of labelled documents not held out."""
    docs = table(spark, sf_dir, "documents")
    found = score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, by a network that learned from documents not held out."""
    docs = table(spark, sf_dir, "documents")
    found = identify_language(docs, fit_language_model(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest vectors found for each vector whose id is divisible by 50."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices of every document."""
    return scan_licenses(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document packed into sequences of 4096 ids; the pieces' ids as their checksum."""
    pieces = harmonic_pack(table(spark, sf_dir, "documents"), PACKING_TOKENIZER)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 50-byte strings of earlier documents."""
    found = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents hold, each at its best window."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash_components(table(spark, sf_dir, "documents"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: base counts and digest, and all spans."""
    found = scan_secrets(table(spark, sf_dir, "documents"))

    def of(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(span_text(of(*BASE)), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's url."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return filter_urls(table(spark, sf_dir, "pages"), rules)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest-scoring documents of every benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five text filters remove in each of their orders, by source."""
    failures = text_failures(table(spark, sf_dir, "documents"))
    return audit_filters(with_labels(failures, table(spark, sf_dir, "labels")), 5)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_quality": op2_quality,
    "op3_language_id": op3_language_id,
    "op4_ann": op4_ann,
    "op5_license_scan": op5_license_scan,
    "op6_packing": op6_packing,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_decontaminate": op8_decontaminate,
    "op9_simhash_dedup": op9_simhash_dedup,
    "op10_secret_scan": op10_secret_scan,
    "op11_url_filter": op11_url_filter,
    "op12_lexical_search": op12_lexical_search,
    "op13_filter_audit": op13_filter_audit,
}

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_URL = r"'(?s)^.*?://([^/?#]*)([^?#]*)'"

OP11_SQL = rf"""
with parts as (
  select row_number() over () as n, page_id, coalesce(translate(regexp_extract(url, {_URL}, 1), {_LOWER}), '') as host,
    coalesce(regexp_extract(url, {_URL}, 2), '') as path
  from pages),
rules(rule_host, rule_path, rule_verdict) as (values {", ".join(map(str, URL_RULES))}),
fits as (
  select *, row_number() over (partition by n order by length(rule_host || rule_path) desc, length(rule_host) desc) as place
  from parts left join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path))
select page_id, host, path, rule_host || rule_path as rule, coalesce(rule_verdict, 'allow') as verdict from fits where place = 1
"""

_TERM = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"

OP12_SQL = rf"""
with docs as (select row_number() over () as d, doc_id, regexp_extract_all(translate(text, {_LOWER}), {_TERM}) as terms from documents),
words as (select d, unnest(terms) as term from docs),
tf as (select d, term, count(*) as tf from words group by all),
size as (select d, doc_id, len(terms)::bigint as n from docs where len(terms) > 0),
total as (select count(*) as docs, sum(n)::bigint as terms from size),
df as (select term, count(*) as df from tf group by all),
asked as (select row_number() over () as i, item_id, unnest(regexp_extract_all(translate(text, {_LOWER}), {_TERM})) as term, text from benchmark),
items as (select item_id, text, term, count(*) as times from asked group by all),
weights as (select items.*, floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double))::bigint as w from items join df using (term), total),
scored as (
  select item_id, text, d, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total.terms))))::bigint as score
  from weights join tf using (term) join size using (d), total
  group by all),
ranked as (
  select item_id, doc_id, score, row_number() over (partition by item_id, text order by score desc, doc_id nulls last) as rank
  from scored join size using (d) where score > 0)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= 20
"""

OP13_SQL = r"""
with texts as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as t from documents),
words as (select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w, min(doc_id) over (partition by t) as least from texts),
labelled as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by 1),
facts as (
  select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic,
    case when len(w) < 50 then 'A' else '' end
    || case when 100 * len(list_distinct(w)) < 65 * len(w) then 'B' else '' end
    || case when 100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 5 * length(t) then 'C' else '' end
    || case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end
    || case when words.doc_id > least then 'E' else '' end as fails
  from words left join labelled using (doc_id)),
counts as (select part, fails, count(*) as n, sum(good) as good, sum(toxic) as toxic from facts group by all),
letters(c) as (values ('A'), ('B'), ('C'), ('D'), ('E')),
orders as (
  select a.c || b.c || x.c || y.c || z.c as filter_order from letters a, letters b, letters x, letters y, letters z
  where len(list_distinct([a.c, b.c, x.c, y.c, z.c])) = 5),
steps as (select filter_order, k::int as step, filter_order[k] as own, filter_order[1:k - 1] as done from orders, range(1, 6) r(k)),
marked as (
  select part, filter_order, step, n, good, toxic, fails, own, contains(fails, own) as hit,
    length(translate(fails, done, '')) < length(fails) as gone
  from counts, steps),
result as (
  select part, filter_order, step, any_value(own) as own, coalesce(sum(n) filter (not gone and not hit), 0)::bigint as kept,
    coalesce(sum(n) filter (not gone and hit), 0)::bigint as removed, coalesce(sum(n) filter (gone and hit), 0)::bigint as redundant,
    coalesce(sum(n) filter (fails = own), 0)::bigint as unique_fails, coalesce(sum(good) filter (not gone and hit), 0)::bigint as good_lost,
    coalesce(sum(toxic) filter (not gone and hit), 0)::bigint as toxic_lost
  from marked group by part, filter_order, step)
select * exclude (own), sum(removed) over (partition by part, own)::bigint as shapley from result
"""

#: DuckDB SQL for the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {"op11_url_filter": OP11_SQL, "op12_lexical_search": OP12_SQL, "op13_filter_audit": OP13_SQL}
