"""Queries and oracle SQL of the training-data operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import read, spread, tune
from . import decontaminate as _bench
from . import exact_dedup as _exact
from . import language as _language
from . import license_scan as _license
from . import pii as _pii
from . import sentencepieces as _pieces
from . import simhash as _simhash
from . import substring as _substring
from . import toxicity as _toxicity
from . import urls as _urls

Query = Callable[[SparkSession, str], DataFrame]


def fold(doc_id: Column, parts: int) -> Column:
    """The contract's fold of a document: crc32 of its id as text."""
    return F.crc32(doc_id.cast("string")) % parts


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(read(tune(spark), sf_dir, "documents"))


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pieces.round_trip(_documents(spark, sf_dir))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exact.exact_dedup(_documents(spark, sf_dir)).drop("n_chunks")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _license.license_scan(_documents(spark, sf_dir)).drop("places")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _documents(spark, sf_dir), read(spark, sf_dir, "labels")
    model = _toxicity.train(docs, labels.filter(fold(F.col("doc_id"), 5) != 0))
    judged = _toxicity.judge(docs, model)
    return judged.select("doc_id", F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted", F.size("passages").cast("long").alias("n_passages"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bench.digest(_bench.decontaminate(_documents(spark, sf_dir), read(spark, sf_dir, "benchmark")))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _simhash.near_duplicates(_documents(spark, sf_dir))
    return found.select("doc_id", _simhash.hexed(F.col("fp")).alias("fingerprint"), "component_id")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _substring.incremental_dedup(_documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def language_model(docs: DataFrame) -> _language.Model:
    """The model of the contract's learning rows."""
    return _language.train(docs.filter(fold(F.col("doc_id"), 4) != 2))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    found = _language.identify(docs, language_model(docs))
    return found.select("doc_id", F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", F.array_join("languages.lang", ",").alias("languages"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _urls.filter_urls(spread(read(tune(spark), sf_dir, "pages"))).drop("score")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pii.digest(_pii.find_pii(_documents(spark, sf_dir)))


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9's columns that SQL can say: host, path and rule."""
    return op9_url_filter(spark, sf_dir).select("page_id", "host", "path", "rule")


def pii_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10's columns that SQL can say: the numbers of base spans."""
    return op10_pii(spark, sf_dir).select("doc_id", "n_email", "n_ip", "n_card", "n_phone")


URL_SQL = r"""
WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages)
SELECT page_id, host, path, CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/' WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
  WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/' WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM u"""

PII_SQL = r"""
WITH m AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+') AS e, regexp_extract_all(coalesce(text, ''), '[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)') AS i,
  list_transform(regexp_extract_all(coalesce(text, ''), '[0-9](?:[\x20-]?[0-9])+'), lambda x: regexp_replace(x, '[^0-9]', '', 'g')) AS c, list_transform(regexp_extract_all(coalesce(text, ''), '\+[0-9][\x20().0-9-]+[0-9]'), lambda x: length(regexp_replace(x, '[^0-9]', '', 'g'))) AS p FROM documents)
SELECT doc_id, len(e)::BIGINT AS n_email, len(list_filter(i, lambda x: list_max(list_transform(string_split(x, '.'), lambda y: y::HUGEINT)) <= 255))::BIGINT AS n_ip,
  len(list_filter(c, lambda d: length(d) BETWEEN 12 AND 19 AND list_sum(list_transform(range(length(d)), lambda k: CASE WHEN k % 2 = 0 THEN d[length(d) - k]::INT WHEN d[length(d) - k]::INT > 4 THEN d[length(d) - k]::INT * 2 - 9 ELSE d[length(d) - k]::INT * 2 END)) % 10 = 0))::BIGINT AS n_card,
  len(list_filter(p, lambda n: n BETWEEN 9 AND 15))::BIGINT AS n_phone FROM m"""

OP2_SQL = r"""
WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm FROM documents),
g AS (SELECT *, first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM n)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(norm) AS text_sha256 FROM g"""

OP5_SQL = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
starts AS (SELECT item_id, w, unnest(range(greatest(1, len(w) - 7))) AS k FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, least(8, len(w)) AS n, array_to_string(w[k + 1:k + 8], ' ') AS s FROM starts),
sizes AS (SELECT DISTINCT n FROM windows),
places AS (SELECT doc_id, w, unnest(range(len(w))) AS k FROM words),
cut AS (SELECT doc_id, k, n, array_to_string(w[k + 1:k + n], ' ') AS s FROM places, sizes WHERE k + n <= len(w)),
hits AS (SELECT doc_id, k, cut.n AS n, item_id FROM cut JOIN windows ON cut.s = windows.s AND cut.n = windows.n),
covered AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(k, k + n)) AS at FROM hits) GROUP BY doc_id),
found AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hits GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_items, 0) >= 2 AS contaminated
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)"""

OP7_SQL = r"""
WITH words AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(len(w) - 12)) AS k FROM words WHERE len(w) > 12),
windows AS (SELECT doc_id, k, array_to_string(w[k + 1:k + 13], ' ') AS s FROM places),
least_doc AS (SELECT s, min(doc_id) AS m FROM windows GROUP BY s),
hits AS (SELECT doc_id, k FROM windows JOIN least_doc USING (s) WHERE m < doc_id),
gone AS (SELECT doc_id, list(DISTINCT pos) AS poss FROM (SELECT doc_id, unnest(range(k, k + 13)) AS pos FROM hits) GROUP BY doc_id),
kept AS (SELECT doc_id, w, poss, CASE WHEN poss IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(poss, i - 1)) END AS v FROM words LEFT JOIN gone USING (doc_id))
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(poss), 0)::BIGINT AS n_removed, sha256(array_to_string(v, ' ')) AS kept_sha256 FROM kept"""

QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_sentencepiece, op2_exact_dedup, op3_license_scan, op4_toxicity, op5_decontaminate, op6_simhash, op7_substring_dedup, op8_language, op9_url_filter, op10_pii, url_rules, pii_counts)}

ORACLES: dict[str, str] = {
    "op2_exact_dedup": OP2_SQL,
    "op3_license_scan": _license.scan_sql(),
    "op5_decontaminate": OP5_SQL,
    "op7_substring_dedup": OP7_SQL,
    "url_rules": URL_SQL,
    "pii_counts": PII_SQL,
}
