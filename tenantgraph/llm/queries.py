"""One query per operator, over its whole table with production parameters, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenantgraph.llm.chat_format import read_back
from tenantgraph.llm.line_dedup import drop_boilerplate_lines
from tenantgraph.llm.mixing import mix_sources
from tenantgraph.llm.packing import pack
from tenantgraph.llm.pii import KINDS, find_pii, joined
from tenantgraph.llm.quality_rules import quality_rules
from tenantgraph.llm.simhash import simhash_components
from tenantgraph.llm.substring_dedup import _WEIGHTS, BLANKS, JOINED, repeated_spans
from tenantgraph.llm.token_scan import token_counts
from tenantgraph.llm.topk_search import exact_topk


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).drop("longest_repeat")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk(table(spark, sf_dir, "embeddings"), is_query=F.col("vec_id") % 100 == 0)


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return read_back(rows.unionByName(extra))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_spans(table(spark, sf_dir, "documents"), inside=24)
    listed = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    total = lambda f: F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + f(s))
    return found.select("doc_id", F.size("spans").cast("long").alias("n_spans"), total(lambda s: s["end"] - s["start"]).alias("removed_chars"), total(lambda s: s["words"]).alias("removed_words"), listed.alias("spans"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1).alias("host"), F.split(F.regexp_replace("html", "<[^>]*>", "\n"), "\n", -1).alias("lines"))
    pages = pages.select("page_id", "host", F.filter("lines", lambda x: F.trim(x) != "").alias("lines"))
    kept = drop_boilerplate_lines(pages, site=F.col("host"), lines=F.col("lines"), out="kept")
    n = lambda c: F.coalesce(F.size(c), F.lit(0)).cast("long")
    return kept.select("page_id", "host", n("lines").alias("n_lines"), (n("lines") - n("kept")).alias("n_dropped"), F.md5(F.array_join("kept", "\n")).alias("kept_md5"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))
    of = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    counts = [of(k).alias(f"n_{k}") for k in KINDS]
    added = (F.size("spans") - F.size("base")).cast("long").alias("n_added")
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"), added)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_quality_rules, op2_best_fit_packing, op3_exact_topk, op4_chat_format, op5_simhash, op6_token_counts, op7_mixing, op8_substring_dedup, op9_line_dedup, op10_pii, pipeline)
    return {f.__name__: f for f in own}


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_PARTS = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, %s AS w FROM documents),
win AS (SELECT r, k, i, array_to_string(w[i:i + k - 1], ' ') AS g FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (VALUES (5), (10), (51)) AS s(k))),
rep AS (SELECT r, k, i FROM (SELECT r, k, i, count(*) OVER (PARTITION BY r, k, g) AS n FROM win) WHERE n > 1),
cover AS (SELECT r, count(DISTINCT p) FILTER (k = 5) AS n_repeat_words, count(DISTINCT p) FILTER (k = 10) AS covered_words, bool_or(k = 51) AS long_repeat
  FROM (SELECT r, k, unnest(range(i, i + k)) AS p FROM rep) GROUP BY r),
l AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars, length(regexp_replace(text, '[^#*$%%&|<>]', '', 'g')) AS n_symbols,
  coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(covered_words, 0) AS covered_words, coalesce(long_repeat, FALSE) AS long_repeat
  FROM d LEFT JOIN cover USING (r) LEFT JOIN l USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, covered_words, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND 100 * covered_words <= 15 * n_words AND NOT long_repeat AS kept FROM m
""" % _WORDS

_TOPK = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

_MIX = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]'))::DOUBLE AS symbols,
  (CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || coalesce(md5(text), 'null') || ':' || (row_number() OVER (PARTITION BY doc_id, text) - 1)), 1, 13) AS BIGINT)::DOUBLE + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u FROM documents),
k AS (SELECT *, -ln(u) / (1.0::DOUBLE / (1.0::DOUBLE + 4.0::DOUBLE * symbols / greatest(size, 1)::DOUBLE)) AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
w AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS weight, source_size * 3.0::DOUBLE AS most FROM s),
b AS (SELECT *, sum(source_size) OVER ()::DOUBLE AS total, sum(weight) OVER () AS weights, coalesce(sum(most) OVER f, 0) AS most_before, coalesce(sum(weight) OVER f, 0) AS weight_before FROM w
  WINDOW f AS (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, most * (weights - weight_before) <= weight * (total - most_before) AS is_full FROM b),
t AS (SELECT source, source_size, CASE WHEN is_full THEN most ELSE weight * ((total - coalesce(sum(most) FILTER (is_full) OVER (), 0)) / sum(weight) FILTER (NOT is_full) OVER ()) END AS target FROM c),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t),
p AS (SELECT k.*, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS part,
  coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY key, k.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS prefix FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source),
x AS (SELECT *, max(key) FILTER (prefix + size / 2.0::DOUBLE <= part) OVER (PARTITION BY source) AS cut FROM p)
SELECT doc_id, size, source_size, target, size * (epochs + CASE WHEN key <= cut THEN 1 ELSE 0 END) AS taken FROM x
"""

_LINES = r"""
WITH p AS (SELECT row_number() OVER () AS r, page_id, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host, string_split(regexp_replace(html, '<[^>]*>', chr(10), 'g'), chr(10)) AS lines FROM pages),
l AS (SELECT r, host, pos, line FROM (SELECT r, host, unnest(lines) AS line, unnest(range(1, len(lines) + 1)) AS pos FROM p) WHERE trim(line) <> ''),
t AS (SELECT host, count(*) AS n FROM p GROUP BY host),
bad AS (SELECT l.host, trim(line) AS line FROM l JOIN t ON l.host IS NOT DISTINCT FROM t.host GROUP BY l.host, trim(line), n HAVING count(DISTINCT r) >= 2 AND count(DISTINCT r) > n * 0.1::DOUBLE),
m AS (SELECT l.*, bad.line IS NOT NULL AS gone FROM l LEFT JOIN bad ON bad.host IS NOT DISTINCT FROM l.host AND bad.line = trim(l.line)),
a AS (SELECT r, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone) AS kept FROM m GROUP BY r)
SELECT page_id, host, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, CASE WHEN lines IS NOT NULL THEN md5(coalesce(kept, '')) END AS kept_md5 FROM p LEFT JOIN a USING (r)
"""

def _class(chars: str) -> str:
    """Characters as a class of DuckDB's patterns."""
    return "".join(c if c == "-" else f"\\x{{{ord(c):x}}}" for c in chars)


_KEY = " + ".join(f"CASE WHEN length(w) > {i} THEN unicode(substr(w, {i + 1}, 1)) * {x} ELSE 0 END" for i, x in enumerate(_WEIGHTS))
_REPEATS = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[{_class(JOINED)}]|[^{_class(BLANKS + JOINED)}]+|[{_class(BLANKS)}]') AS t FROM documents),
p AS (SELECT r, i, w, sum(length(w)) OVER (PARTITION BY r ORDER BY i) AS e, sum((w = chr(10))::INT) OVER (PARTITION BY r ORDER BY i) AS ln FROM (SELECT r, unnest(t) AS w, unnest(range(len(t))) AS i FROM d)),
w AS (SELECT *, {_KEY} AS key, count(*) OVER (PARTITION BY r, ln) AS held FROM p WHERE NOT regexp_matches(w, '^[{_class(BLANKS)}]$')),
c AS (SELECT *, row_number() OVER l = 1 OR held >= 24 AND (37 * key + coalesce(lead(key) OVER l, 0)) % 1009 < 126 AS cut FROM w WINDOW l AS (PARTITION BY r, ln ORDER BY i)),
u AS (SELECT r, k, min(e - length(w)) AS a, max(e) AS b, count(*) AS words, max(held) < 24 AS line, string_agg(w, ' ' ORDER BY i) AS txt FROM (SELECT *, sum(cut::INT) OVER (PARTITION BY r ORDER BY i) AS k FROM c) GROUP BY r, k),
n AS (SELECT r, k, a, b, words, line, row_number() OVER (PARTITION BY txt ORDER BY doc_id NULLS LAST, r, k) AS nth FROM u JOIN d USING (r)),
g AS (SELECT *, k - row_number() OVER (PARTITION BY r ORDER BY k) AS g FROM n WHERE nth > 1),
s AS (SELECT *, k - row_number() OVER (PARTITION BY r ORDER BY k) AS h FROM (SELECT *, sum(words) OVER (PARTITION BY r, g) AS run FROM g) WHERE line OR run >= 20),
o AS (SELECT r, min(a) AS a, max(b) AS b, sum(words) AS words FROM s GROUP BY r, h),
j AS (SELECT r, count(*) AS n, sum(b - a) AS chars, sum(words) AS words, string_agg(a || ':' || b, ',' ORDER BY a) AS spans FROM o GROUP BY r)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_spans, coalesce(chars, 0)::BIGINT AS removed_chars, coalesce(words, 0)::BIGINT AS removed_words, coalesce(spans, '') AS spans FROM d LEFT JOIN j USING (r)
"""


def oracle_sql() -> dict[str, str]:
    """Tokens, XXH64, components, transducers and SHA-256 over control strings are beyond SQL; tests hold those against brute force."""
    return {"op1_quality_rules": _PARTS, "op3_exact_topk": _TOPK, "op7_mixing": _MIX, "op8_substring_dedup": _REPEATS, "op9_line_dedup": _LINES}
