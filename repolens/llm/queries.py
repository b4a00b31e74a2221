"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from repolens.llm import doubling, exact, html_main, imatch, langid, merkle, mixing, near, ngrams, packing, quality, spelling, suffixes

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return register


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query("op1_imatch")
def op1_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(documents(spark, sf_dir))


EXACT_SQL = f"""
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents)"""


@query("op2_exact_dedup", EXACT_SQL)
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_dedup(documents(spark, sf_dir))


def mixing_sql(table: str = "documents") -> str:
    """The mix as DuckDB SQL: per source, a running sum over hash values."""
    return rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM {table}),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::BIGINT AS weight
  FROM sized GROUP BY source),
lev AS (
  SELECT *, 2 * source_size AS cap, (2 * source_size)::DOUBLE / weight AS ratio,
         (sum(source_size) OVER ())::DOUBLE * 1.5::DOUBLE AS total FROM src),
cap AS (
  SELECT a.*, (SELECT sum(CASE WHEN b.ratio < a.ratio THEN b.cap ELSE 0 END)::DOUBLE
                    + a.ratio * sum(CASE WHEN b.ratio >= a.ratio THEN b.weight ELSE 0 END)::DOUBLE FROM lev b) <= a.total AS capped
  FROM lev a),
tgt AS (
  SELECT source, source_size,
         CASE WHEN capped THEN cap::DOUBLE
              ELSE (total - (sum(CASE WHEN capped THEN cap ELSE 0 END) OVER ())::DOUBLE)
                   / (sum(CASE WHEN capped THEN 0 ELSE weight END) OVER ())::DOUBLE * weight END AS target
  FROM cap),
bud AS (
  SELECT *, CASE WHEN target >= source_size THEN 1 ELSE 0 END AS whole,
         CASE WHEN target >= source_size THEN target - source_size ELSE target END AS budget FROM tgt),
run AS (
  SELECT source, h, words, sum(words) OVER (PARTITION BY source ORDER BY h)::BIGINT AS upto
  FROM (SELECT source, h, sum(size)::BIGINT AS words FROM sized GROUP BY source, h)),
pick AS (
  SELECT r.source, r.h, r.upto <= b.budget OR (r.upto - r.words < b.budget AND r.upto - b.budget <= b.budget - (r.upto - r.words)) AS more
  FROM run r JOIN bud b ON r.source IS NOT DISTINCT FROM b.source)
SELECT s.doc_id, s.source, s.size, b.source_size, b.target,
       (s.size * (b.whole + CASE WHEN p.more THEN 1 ELSE 0 END))::BIGINT AS taken
FROM sized s JOIN bud b ON s.source IS NOT DISTINCT FROM b.source
JOIN pick p ON s.source IS NOT DISTINCT FROM p.source AND s.h = p.h"""


NEAR_SQL = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[s:s + 4], ' ')) AS k
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS s FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both FROM shingles a JOIN shingles b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT p.a, p.b FROM pairs p JOIN sizes x ON x.doc_id = p.a JOIN sizes y ON y.doc_id = p.b
  WHERE 100 * p.both >= 85 * (x.n + y.n - p.both)),
sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT a, b FROM sides UNION SELECT r.doc_id, s.b FROM reach r JOIN sides s ON s.a = r.other),
least AS (SELECT doc_id, min(other) AS low FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(z.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(l.low, d.doc_id)) AS component_id,
       least(d.doc_id, coalesce(l.low, d.doc_id)) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes z ON z.doc_id = d.doc_id LEFT JOIN least l ON l.doc_id = d.doc_id"""


@query("op5_near_dedup", NEAR_SQL)
def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(documents(spark, sf_dir))


@query("op6_mix_sources", mixing_sql())
def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


@query("op3_html_main_text")
def op3_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_main.extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


@query("op4_language_id")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(documents(spark, sf_dir))


BYTES_SQL = r"""
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
windows AS (
  SELECT doc_id, s, md5(substr(x, 2 * s + 1, 200)) AS k
  FROM (SELECT doc_id, x, unnest(range(0, len(x) // 2 - 99)) AS s FROM texts WHERE len(x) >= 200)),
again AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS nth FROM windows) WHERE nth > 1),
runs AS (
  SELECT doc_id, min(s) AS a, max(s) + 100 AS b FROM (
    SELECT doc_id, s, sum(new) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM (
      SELECT doc_id, s, CASE WHEN s > lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100 THEN 1 ELSE 0 END AS new FROM again))
  GROUP BY doc_id, run),
gaps AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS from_, row_number() OVER (PARTITION BY doc_id ORDER BY a DESC) AS back FROM runs),
cut AS (
  SELECT t.doc_id, sum(g.b - g.a) AS removed, count(*) AS spans,
         string_agg(substr(t.x, 2 * g.from_ + 1, 2 * (g.a - g.from_)), '' ORDER BY g.a) || substr(any_value(t.x), 2 * max(g.b) + 1) AS kept
  FROM texts t JOIN gaps g ON g.doc_id = t.doc_id GROUP BY t.doc_id)
SELECT t.doc_id, (len(t.x) // 2)::BIGINT AS n_bytes, coalesce(c.removed, 0)::BIGINT AS n_removed, coalesce(c.spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(c.kept, t.x))) AS kept_sha256
FROM texts t LEFT JOIN cut c ON c.doc_id = t.doc_id"""


@query("op7_suffix_dedup", BYTES_SQL)
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeated_bytes(documents(spark, sf_dir))


@query("op8_packing")
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


WORDS_SQL = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, s, md5(array_to_string(w[s:s + 49], ' ')) AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS s FROM words WHERE len(w) >= 50)),
again AS (SELECT doc_id, s FROM (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY k) AS low FROM windows) WHERE low < doc_id),
gone AS (SELECT DISTINCT doc_id, s + o AS p FROM again, (SELECT unnest(range(0, 50)) AS o)),
cut AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM gone GROUP BY doc_id),
flat AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM words),
kept AS (
  SELECT f.doc_id, string_agg(f.word, ' ' ORDER BY f.p) AS t FROM flat f ANTI JOIN gone g ON g.doc_id = f.doc_id AND g.p = f.p GROUP BY f.doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(c.n, 0)::BIGINT AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM words d LEFT JOIN cut c ON c.doc_id = d.doc_id LEFT JOIN kept k ON k.doc_id = d.doc_id"""


@query("op9_substring_dedup", WORDS_SQL)
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return doubling.remove_repeated_words(documents(spark, sf_dir))


@query("op10_lm_scores")
def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.score_documents(documents(spark, sf_dir))


@query("op11_merkle_manifest", merkle.manifest_sql())
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(documents(spark, sf_dir))


@query("op12_quality_rules", quality.quality_sql())
def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(documents(spark, sf_dir))


@query("op13_spelling_variants", spelling.variants_sql())
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir))
