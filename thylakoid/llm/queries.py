"""The queries ``opN_<name>`` of this subpackage over the test tables, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from thylakoid.llm import crosstoken, decontaminate, importance, jaccard, langid, lm, mixing, quality, sharding, tokencounts, toxicity, urlrules, warc
from thylakoid.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

#: The rules of op3, as host, path and verdict.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_manifest(table(spark, sf_dir, "documents"), 8)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urlrules.judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"), n=4, num=85, den=100)


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10, F.lit(0)) == 0
    return lm.score_texts(table(spark, sf_dir, "documents"), ~held_out).withColumn("train", ~F.col("train")).withColumnRenamed("train", "held_out")


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.section_tokens(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.archive_folder(spark)
    warc.write_archive(warc.with_records(table(spark, sf_dir, "pages")), folder)
    return warc.read_archive(spark, folder).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", F.col("kind").alias("record_type"), F.col("refers").alias("refers_to")
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_plan(table(spark, sf_dir, "documents")).drop("_ident")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    def fold(key: str) -> Column:
        return F.coalesce(F.crc32(F.col(key).cast("string")) % 3, F.lit(0))

    labels = table(spark, sf_dir, "labels").filter(fold("doc_id") != 1).select("doc_id", "toxic")
    docs = table(spark, sf_dir, "documents").select("doc_id", (fold("doc_id") == 1).alias("held_out"), "text")
    return toxicity.score_toxicity(docs, labels).drop("text").withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_documents(table(spark, sf_dir, "documents"))


def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3, F.lit(0)) == 1
    docs = table(spark, sf_dir, "documents").select("doc_id", held_out.alias("held_out"), "lang", "text")
    return langid.identify(docs, ~F.col("held_out")).select("doc_id", "held_out", "lang_pred", "score")


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crosstoken.align_tokens(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_sharding": op1_sharding,
    "op2_decontamination": op2_decontamination,
    "op3_url_filters": op3_url_filters,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_lm_scoring": op5_lm_scoring,
    "op6_token_counts": op6_token_counts,
    "op7_warc": op7_warc,
    "op8_mixing": op8_mixing,
    "op9_toxicity": op9_toxicity,
    "op10_quality_rules": op10_quality_rules,
    "op11_language_id": op11_language_id,
    "op12_importance": op12_importance,
    "op13_cross_tokenizer": op13_cross_tokenizer,
}

_URL = """
SELECT page_id, host, path, r.rule, coalesce(r.verdict, 'allow') AS verdict
FROM (SELECT page_id, translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages) p
LEFT JOIN LATERAL (
  SELECT h || q AS rule, v AS verdict
  FROM (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')) t(h, q, v)
  WHERE (p.host = h OR p.host LIKE '%.' || h) AND starts_with(p.path, q)
  ORDER BY length(h || q) DESC LIMIT 1) r ON true
"""

_JACCARD = r"""
WITH RECURSIVE d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT doc_id, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
s AS (SELECT DISTINCT doc_id, g FROM (
  SELECT doc_id, array_to_string(w, ' ') AS g FROM w WHERE len(w) BETWEEN 1 AND 3 UNION ALL
  SELECT doc_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] FROM (SELECT doc_id, w, unnest(range(1, len(w) - 2)) AS i FROM w))),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM d UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.doc_id WHERE r.root < e.b)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, min(r.root) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN r USING (doc_id) GROUP BY ALL
"""

_WARC = """
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first
      FROM (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages))
"""

_QUALITY = r"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, source, coalesce(text, '') AS text FROM documents),
words AS (SELECT k, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM d),
windows AS (SELECT k, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT k, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
again AS (SELECT k, count(DISTINCT j) AS n FROM (
  SELECT k, unnest([i, i + 1, i + 2]) AS j FROM (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS c FROM windows) WHERE c > 1) GROUP BY k),
lines AS (SELECT k, count(*) - count(DISTINCT l) AS n FROM (SELECT k, unnest(string_split(text, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY k),
m AS (SELECT d.k, doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
  coalesce(lines.n, 0)::BIGINT AS n_dup_lines, coalesce(again.n, 0)::BIGINT AS n_repeat_words
  FROM d JOIN words USING (k) LEFT JOIN lines USING (k) LEFT JOIN again USING (k)),
f AS (SELECT *, (n_words < 50)::INT AS short, (100 * n_repeat_words > 50 * n_words)::INT AS repeats,
  (5 * n_symbols > 4 * n_words)::INT AS symbols, (5 * n_dup_lines > n_words)::INT AS dup FROM m),
h AS (SELECT source, unnest([1, 2, 3, 4]) AS r, count(*) AS n, unnest([sum(short), sum(repeats), sum(symbols), sum(dup)])::BIGINT AS x FROM f GROUP BY source),
p AS (SELECT r, avg(x / n) AS mean, var_pop(x / n) AS v FROM h GROUP BY r),
s AS (SELECT r, mean, CASE WHEN v > 0 THEN least(1000.0::DOUBLE, greatest(2.0::DOUBLE, mean * (1 - mean) / v - 1)) ELSE 1000.0::DOUBLE END AS strength FROM p),
verdict AS (SELECT source, bool_and((x + mean * strength) / (n + strength) < 0.6) AS ok FROM h JOIN s USING (r) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (short = 1 OR repeats = 1) AS base_failed, (NOT (short = 1 OR repeats = 1) AND ok) AS kept
FROM f JOIN verdict ON f.source IS NOT DISTINCT FROM verdict.source
"""



def _crc_step(c: int) -> int:
    for _ in range(8):
        c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
    return c


# CRC-32 byte by byte, by the table of all bytes' remainders
_CRC = f"""list_reduce(list_prepend(4294967295, list_transform(range(octet_length(encode(f))), lambda i: ('0x' || substr(x, (2 * i + 1)::INT, 2))::BIGINT)),
  lambda c, b: xor(({[_crc_step(c) for c in range(256)]}::BIGINT[])[xor(c, b) % 256 + 1], c >> 8))"""
_IMPORTANCE = rf"""
WITH t AS (SELECT true AS doc, row_number() OVER () AS k, doc_id, text FROM documents UNION ALL SELECT false, row_number() OVER (), NULL, text FROM benchmark),
w AS (SELECT doc, k, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM t),
g AS (SELECT doc, k, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM w),
n AS (SELECT doc, k, f, count(*) AS n FROM g GROUP BY ALL),
b AS (SELECT f, xor({_CRC}, 4294967295) % 10000 AS b FROM (SELECT f, hex(encode(f)) AS x FROM (SELECT DISTINCT f FROM n))),
c AS (SELECT b, sum(n) FILTER (doc) AS s, sum(n) FILTER (NOT doc) AS t FROM n JOIN b USING (f) GROUP BY b),
a AS (SELECT sum(s)::DOUBLE AS s, coalesce(sum(t), 0)::DOUBLE AS t FROM c),
gain AS (SELECT b, floor(1000 * ln((coalesce(c.t, 0) + 1)::DOUBLE * (a.s + 10000) / ((coalesce(c.s, 0) + 1)::DOUBLE * (a.t + 10000)))) AS gain FROM c, a),
p AS (SELECT k, sum(n) AS n, floor(sum(n * gain) / sum(n)) AS weight FROM n JOIN b USING (f) JOIN gain USING (b) WHERE doc GROUP BY k),
d AS (SELECT doc_id, len(w) AS n_words, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
  ('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT::DOUBLE AS h FROM w LEFT JOIN p USING (k) WHERE doc),
z AS (SELECT *, (weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296))))::BIGINT AS score FROM d),
r AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS r, 25 * count(*) OVER (PARTITION BY n_words >= 20) // 100 AS most FROM z)
SELECT doc_id, n_words, n_features, weight, score, CASE WHEN n_words >= 20 AND r <= most THEN r END AS rank FROM r
"""

ORACLE_SQL: dict[str, str] = {"op3_url_filters": _URL, "op4_jaccard_join": _JACCARD, "op7_warc": _WARC, "op10_quality_rules": _QUALITY, "op12_importance": _IMPORTANCE}
