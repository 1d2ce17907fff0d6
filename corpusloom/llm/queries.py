"""The queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import byte_bpe, embedding_join, language_id, license_scan, packing, quality, ranked_search, simhash, substring_dedup, suffix_dedup, transport_stream, url_filter, vector_codes
from corpusloom.llm.common import bound_batches


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the driver's; the session of these queries gets a bound on batches to Python, for texts are long."""
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(substring_dedup.remove_repeated_words(table(spark, sf_dir, "documents")))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.digest(license_scan.scan_licenses(table(spark, sf_dir, "documents")))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, digests=True)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(suffix_dedup.remove_repeated_bytes(table(spark, sf_dir, "documents")))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The rate in thousandths: a whole number does not hang on the order of a sum.
    judged = quality.judge(table(spark, sf_dir, "documents"))
    return judged.withColumn("host_permille", F.floor(F.col("host_rate") * 1000 + 0.5)).drop("host_rate")


def op8_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.range_join(table(spark, sf_dir, "embeddings"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = language_id.identify(table(spark, sf_dir, "documents"))
    return got.select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(ranked_search.build_index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op13_transport_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transport_stream.round_trip(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_substring_dedup, op2_packing, op3_license_scan, op4_simhash, op5_byte_bpe, op6_suffix_dedup, op7_quality_rules, op8_embedding_join, op9_url_filter, op10_language_id, op11_ranked_search, op12_vector_codes, op13_transport_stream)}
ORACLES: dict[str, str] = {}
ORACLES["op1_substring_dedup"]=r"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM t),
s AS (SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS k FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 18, 1))) AS i FROM t)),
late AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM s) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM late, (SELECT unnest(range(20)) AS j))
SELECT t.doc_id, CAST(len(words) AS BIGINT) AS n_words, count(g.i) AS n_removed,
  sha256(coalesce(string_agg(CASE WHEN g.i IS NULL THEN w.word END, ' ' ORDER BY w.i), '')) AS kept_sha256
FROM t LEFT JOIN w ON t.doc_id = w.doc_id LEFT JOIN gone g ON g.doc_id = w.doc_id AND g.i = w.i GROUP BY t.doc_id, len(words)"""
ORACLES["op6_suffix_dedup"]=r"""
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
s AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS k FROM (SELECT doc_id, h, unnest(range(length(h) // 2 - 49)) AS i FROM t WHERE length(h) >= 100)),
late AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS d FROM s) WHERE doc_id > d),
runs AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM (
  SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 50 THEN 0 ELSE 1 END AS new FROM late)) GROUP BY doc_id, r),
gaps AS (SELECT r.doc_id, substr(h, 2 * coalesce(lag(b) OVER (PARTITION BY r.doc_id ORDER BY a), 0) + 1, 2 * (a - coalesce(lag(b) OVER (PARTITION BY r.doc_id ORDER BY a), 0))) AS part, a, b, h FROM runs r JOIN t ON r.doc_id = t.doc_id),
cut AS (SELECT doc_id, string_agg(part, '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS kept, sum(b - a) AS n, count(*) AS spans FROM gaps GROUP BY doc_id)
SELECT t.doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM t LEFT JOIN cut ON t.doc_id = cut.doc_id"""
ORACLES["op7_quality_rules"]=r"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT doc_id, i, words[i:i + 2] AS k FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, 1))) AS i FROM t)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS n FROM s) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, (SELECT unnest(range(3)) AS j) GROUP BY doc_id),
m AS (SELECT t.doc_id, source, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))) - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS BIGINT) AS n_dup_lines,
  coalesce(c.n, 0) AS n_repeat_words FROM t LEFT JOIN covered c ON t.doc_id = c.doc_id),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
h AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS bad FROM f WHERE source IS NOT NULL GROUP BY source),
g AS (SELECT sum(n) AS n, sum(bad) AS bad, sum(n * (bad / n) * (bad / n)) AS sq, count(*) AS k FROM h),
p AS (SELECT least(0.99, greatest(0.01, bad / n)) AS mean, greatest(1e-6, sq / n - (bad / n) ** 2) AS spread, n IS NULL OR k < 2 AS none FROM g),
q AS (SELECT CASE WHEN none THEN 1.0 ELSE mean * least(1000.0, greatest(2.0, mean * (1 - mean) / spread - 1)) END AS a,
  CASE WHEN none THEN 1.0 ELSE (1 - mean) * least(1000.0, greatest(2.0, mean * (1 - mean) / spread - 1)) END AS b FROM p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce((h.bad + a) / (h.n + a + b) <= 0.8, true) AS kept, CAST(floor((h.bad + a) / (h.n + a + b) * 1000 + 0.5) AS BIGINT) AS host_permille
FROM f LEFT JOIN h ON f.source = h.source, q"""
ORACLES["op8_embedding_join"]=r"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
r(n, m) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.n, p.b FROM r JOIN p ON r.m = p.a),
c AS (SELECT n, min(m) AS root FROM r GROUP BY n), l AS (SELECT a, count(*) AS n_links FROM p GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(root, vec_id) AS component_id, coalesce(root, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN c ON vec_id = c.n LEFT JOIN l ON vec_id = l.a"""

_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""
ORACLES["op11_ranked_search"] = rf"""
WITH w AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents), d AS (SELECT doc_id, count(*) AS n FROM w GROUP BY doc_id),
c AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS l FROM d), tf AS (SELECT doc_id, term, count(*) AS tf FROM w GROUP BY doc_id, term),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
v AS (SELECT term, CAST(floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, c GROUP BY term, nn),
s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * nn) // l)))) AS BIGINT) AS score
  FROM q JOIN v USING (term) JOIN tf USING (term) JOIN d USING (doc_id), c GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0) WHERE rank <= 10"""


def _codes_sql(rounds: int = 4) -> str:
    """Rounds of training, one after the other.  Distances are sums of products, exact in doubles for whole numbers of this size."""
    def nearest(k: int) -> str:
        return (
            f"SELECT vec_id, label, p, x, xx, min(struct_pack(d := xx - 2 * list_inner_product(x, e) + ee, k := k)) AS best FROM v JOIN (SELECT p, k, e, list_inner_product(e, e) AS ee FROM b{k}) USING (p) GROUP BY vec_id, label, p, x, xx"
        )

    steps = [
        "r AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda c: floor(1024 * CAST(c AS DOUBLE))) AS c, row_number() OVER (ORDER BY vec_id) - 1 AS n FROM embeddings "
        "WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)",
        "v AS MATERIALIZED (SELECT *, list_inner_product(x, x) AS xx FROM (SELECT vec_id, label, n, p, c[len(c) // 4 * p + 1:len(c) // 4 * (p + 1)] AS x FROM r, (SELECT unnest(range(4)) AS p)))",
        "b0 AS MATERIALIZED (SELECT p, n AS k, x AS e FROM v WHERE n < 256)",
    ]
    for k in range(rounds):
        steps += [
            f"a{k} AS MATERIALIZED ({nearest(k)})",
            f"m{k} AS (SELECT p, k, list(floor(s / n) ORDER BY j) AS e FROM (SELECT p, best.k AS k, j, sum(x[j]) AS s, count(*) AS n FROM a{k}, (SELECT unnest(range(1, (SELECT max(len(x)) FROM v) + 1)) AS j) GROUP BY p, best.k, j) GROUP BY p, k)",
            f"b{k + 1} AS MATERIALIZED (SELECT p, k, coalesce(m{k}.e, b{k}.e) AS e FROM b{k} LEFT JOIN m{k} USING (p, k))",
        ]
    return f"""WITH {", ".join(steps)}, a AS ({nearest(rounds)}),
c AS (SELECT vec_id, label, string_agg(format('{{:02x}}', best.k), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a GROUP BY vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(list_transform(e, lambda y: CAST(CAST(y AS BIGINT) AS VARCHAR)), ','), ',' ORDER BY p, k)) FROM b{rounds}) AS codebooks_sha256 FROM c"""


ORACLES["op12_vector_codes"] = _codes_sql()
