"""Registered queries of the operators, with their production parameters, and the SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalmart.llm import (
    common, decontaminate, lexical_search, line_dedup, order_minhash, piece_codec, pivot_dedup, simhash,
    source_audit, suffix_dedup, token_counts, token_files, toxicity, url_reputation,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = common.stage_path(spark, "token-files")
    token_files.write(_table(spark, sf_dir, "documents"), path)
    return token_files.read(spark, path)


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontaminate.contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"),
    )


def is_contaminated():
    """A twentieth of the words, and one at least, is hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "n_lines", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_of("fp").alias("fingerprint"), "component_id")


def piece_digests(encoded: DataFrame) -> DataFrame:
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op6_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(piece_codec.encode_decode(_table(spark, sf_dir, "documents")))


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def labelled_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with `bad`: does a label call the page's document toxic or of low quality?

    The document's number stands in the url's path (`/en/7198`).
    """
    labels = _table(spark, sf_dir, "labels").groupBy("doc_id").agg(
        F.max(((F.col("toxic") == 1) | (F.col("quality") == 0)).cast("int")).alias("bad")
    )
    pages = _table(spark, sf_dir, "pages").select("page_id", "url").withColumn(
        "doc_id",
        F.regexp_extract(url_reputation.path_of(F.col("url")), r"^/[^/]*/([0-9]+)", 1).try_cast("long"),
    )
    return pages.join(labels, "doc_id", "left").select("page_id", "url", "bad")


def op8_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_reputation.judge(labelled_pages(spark, sf_dir))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op9_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.edited_likeness(_table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id",
        F.coalesce(toxicity.held_out(), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "evidence",
    )


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_pivot_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.divergence(_table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (op1_token_counts, op2_token_files, op3_decontaminate, op4_line_dedup,
              op5_simhash, op6_piece_codec, op7_suffix_dedup, op8_url_reputation, op9_order_minhash, op10_toxicity,
              op11_lexical_search, op12_pivot_dedup, op13_source_audit)
}


#: Host, path, rules, counts per level and the posterior bound, level by level.
URL_REPUTATION_SQL = """
WITH bad AS (
  SELECT doc_id, max(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id
), placed AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), labelled AS (
  SELECT p.*, b.bad FROM placed p LEFT JOIN bad b
    ON b.doc_id = TRY_CAST(regexp_extract(p.path, '^/[^/]*/([0-9]+)', 1) AS BIGINT)
), named AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '[.]$', '') AS name
  FROM labelled
), counted AS (
  SELECT name, regexp_extract(name, '(?:^|[.])((?:{second})[.][a-z][a-z])$', 1) AS two,
    regexp_matches(name, '^([0-9]{1,3}([.][0-9]{1,3}){3}|\\[.*\\])$') AS address,
    count(bad) AS n, coalesce(sum(bad), 0) AS bad
  FROM named GROUP BY name
), hosts AS (
  SELECT name, n, bad,
    CASE WHEN address THEN '[address]' WHEN two <> '' THEN two ELSE regexp_extract(name, '[^.]*$') END AS suffix,
    CASE WHEN address THEN name WHEN two <> '' THEN regexp_extract(name, '([^.]*[.])?[^.]*[.][^.]*$')
      ELSE regexp_extract(name, '([^.]*[.])?[^.]*$') END AS domain
  FROM counted
), domains AS (
  SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY domain, suffix
), suffixes AS (
  SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY suffix
), above0 AS (
  SELECT s.*, (SELECT (sum(bad) + 0.5::DOUBLE) / (sum(n) + 1) FROM suffixes) AS above FROM suffixes s
), m0 AS (SELECT {strength} AS m FROM above0 WHERE n > 0
), rate0 AS (SELECT suffix, (bad + m * above) / (n + m) AS rate FROM above0, m0
), above1 AS (SELECT d.*, r.rate AS above FROM domains d JOIN rate0 r USING (suffix)
), m1 AS (SELECT {strength} AS m FROM above1 WHERE n > 0
), rate1 AS (SELECT domain, (bad + m * above) / (n + m) AS rate FROM above1, m1
), above2 AS (SELECT h.*, r.rate AS above FROM hosts h JOIN rate1 r USING (domain)
), m2 AS (SELECT {strength} AS m FROM above2 WHERE n > 0
), rate2 AS (SELECT name, n + m AS weight, (bad + m * above) / (n + m) AS rate FROM above2, m2
), ruled AS (
  SELECT p.*, CASE
    WHEN ('.' || host) LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN ('.' || host) LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN ('.' || host) LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN ('.' || host) LIKE '%.net' AND path LIKE '/%' THEN 'net/' END AS rule
  FROM named p
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN rate - 1.645::DOUBLE * sqrt(rate * (1 - rate) / (weight + 1)) > 0.5::DOUBLE THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled JOIN rate2 USING (name)
"""

#: Prior strength of a level by the method of moments.
STRENGTH_SQL = """CASE
  WHEN coalesce(sum(n * above * (1 - above)), 0) <= 0 THEN 1000::DOUBLE
  WHEN sum(n * (bad / n - above) ** 2) <= sum(above * (1 - above)) THEN 1000::DOUBLE
  ELSE least(1000::DOUBLE, greatest(1::DOUBLE, 1 / ((sum(n * (bad / n - above) ** 2) - sum(above * (1 - above)))
    / sum(n * above * (1 - above))) - 1)) END"""


#: Every document's score for every item, term by term.
LEXICAL_SEARCH_SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{words}') AS w
  FROM documents
), sized AS (
  SELECT d, doc_id, w, len(w) AS n FROM words WHERE len(w) > 0
), corpus AS (
  SELECT count(*) AS nd, sum(n)::BIGINT AS nl FROM sized
), asked AS (
  SELECT i, item_id, term, count(*) AS times FROM (
    SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{words}')) AS term
    FROM benchmark) GROUP BY ALL
), postings AS (
  SELECT d, doc_id, n, term, count(*) AS tf FROM (SELECT d, doc_id, n, unnest(w) AS term FROM sized)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM postings, corpus GROUP BY term, nd
), impacts AS (
  SELECT d, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * nd) // nl))) AS score
  FROM postings JOIN weights USING (term), corpus
), scores AS (
  SELECT i, item_id, d, doc_id, sum(times * score)::BIGINT AS score
  FROM asked JOIN impacts USING (term) GROUP BY ALL
)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id, d)::INTEGER AS rank
  FROM scores WHERE score > 0)
WHERE rank <= 20
""".replace("{words}", r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


#: All pairs, and everything reachable by links.
PIVOT_DEDUP_SQL = """
WITH RECURSIVE vectors AS (
  SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS v FROM embeddings
), usable AS (
  SELECT r, v, sqrt(list_dot_product(v, v)) AS size FROM vectors
  WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(v, v) > 0
), links AS (
  SELECT a.r AS a, b.r AS b FROM usable a JOIN usable b ON a.r <> b.r AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / (a.size * b.size) >= 0.9::DOUBLE
), reach AS (
  SELECT r, vec_id AS id FROM vectors
  UNION
  SELECT l.b AS r, reach.id FROM reach JOIN links l ON l.a = reach.r
), parts AS (
  SELECT r, min(id) AS component_id FROM reach GROUP BY r
), degrees AS (
  SELECT a AS r, count(*) AS n_links FROM links GROUP BY a
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM vectors JOIN parts USING (r) LEFT JOIN degrees USING (r)
"""

#: Every group's share of every kept term against every other's.
SOURCE_AUDIT_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), words AS (
  SELECT d, lang, source, unnest(w) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS lang_n FROM words GROUP BY lang, term HAVING count(DISTINCT d) >= 3
), langs AS (
  SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang
), sources AS (
  SELECT DISTINCT lang, source FROM docs
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), totals AS (
  SELECT lang, source, coalesce(sum(n), 0) AS total FROM sources LEFT JOIN counts USING (lang, source) GROUP BY lang, source
), shares AS (
  SELECT t.lang, t.source, k.term, coalesce(n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(n, 0) + 1)) // (total + v)::HUGEINT AS p,
    1 + (1000000000::HUGEINT * (lang_n + 1)) // (lang_total + v)::HUGEINT AS q
  FROM totals t JOIN langs USING (lang) JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value
  FROM shares WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op8_url_reputation": URL_REPUTATION_SQL.replace("{strength}", STRENGTH_SQL).replace(
            "{second}", "|".join(url_reputation.SECOND_LEVEL)
        ),
        "op11_lexical_search": LEXICAL_SEARCH_SQL,
        "op12_pivot_dedup": PIVOT_DEDUP_SQL,
        "op13_source_audit": SOURCE_AUDIT_SQL,
    }
