"""The queries opN_<name> of this subpackage, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from firelark.llm import decontaminate, html_text, jaccard_join, mixing, quality_crf, quality_rules, suffix_dedup, token_counts, toxicity, warc


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(~toxicity.held_out("doc_id", 4, 2)))
    out = toxicity.toxicity_scores(docs, model)
    return out.select("doc_id", toxicity.held_out("doc_id", 4, 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), F.size("passages").alias("n_passages"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_passages(_read(spark, sf_dir, "documents"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_read(spark, sf_dir, "documents"), 3, 90, 100).select("doc_id", "n_shingles", "component_id")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.token_counts(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), 1024)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(_read(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.capture_history(_read(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(_read(spark, sf_dir, "documents")).select("doc_id", "source", "mix_block", "mix_slot", "mix_position")


def op9_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    model = quality_crf.fit(docs, labels.where(~toxicity.held_out("doc_id", 5, 0)))
    out = quality_crf.quality_scores(docs, model)
    return out.select("doc_id", toxicity.held_out("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "n_lines", "good_share")


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(_read(spark, sf_dir, "pages"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_toxicity, op2_suffix_dedup, op3_jaccard_join, op4_decontamination, op5_token_counts, op6_quality_rules, op7_warc, op8_mixing, op9_quality_crf, op10_html_text)}


OP3_SQL = """WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS g FROM d),
u AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b FROM u a JOIN u b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
e AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT doc_id, doc_id AS c FROM s UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id)
SELECT s.doc_id, CAST(len(any_value(s.g)) AS BIGINT) AS n_shingles, min(r.c) AS component_id FROM s JOIN r ON s.doc_id = r.doc_id GROUP BY s.doc_id"""

OP7_SQL = """SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes,
array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((((instr('0123456789abcdef', substr(x, CAST(5 * i // 4 + 1 AS INTEGER), 1)) - 1) * 16
+ instr('0123456789abcdef', substr(x || '0', CAST(5 * i // 4 + 2 AS INTEGER), 1)) - 1) >> CAST(3 - (5 * i) % 4 AS INTEGER)) & 31) AS INTEGER), 1)), '') AS payload_digest,
CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> f THEN f END AS refers_to
FROM (SELECT page_id, h, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS f FROM (SELECT page_id, coalesce(html, '') AS h FROM pages))"""


def _op4_sql() -> str:
    mark = decontaminate.PUNCTUATION.replace("'", "''")
    toks = f"list_filter(list_transform(regexp_split_to_array(lower(text), '[\\x20\\x09-\\x0D]+'), lambda x: trim(x, '{mark}')), lambda x: x <> '')"
    take = lambda m, w: " || ' ' || ".join(f"{w}[i + {k}]" for k, c in enumerate(m) if c == "1")
    grams = lambda source, w: " UNION ALL ".join(f"SELECT *, i - 1 AS p, '{t}|' || {take(m, w)} AS h FROM (SELECT *, unnest(range(1, len({w}) - {len(m)} + 2)) AS i FROM {source})" for t, m in enumerate(decontaminate.SEEDS))
    # items of under 12 tokens: all their tokens, at each place of the text
    return f"""WITH b AS (SELECT * FROM (SELECT item_id, {toks} AS b FROM benchmark WHERE item_id IS NOT NULL) WHERE len(b) > 0),
d AS (SELECT doc_id, {toks} AS w FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
l AS (SELECT * FROM b WHERE len(b) >= 12), c AS (SELECT * FROM b WHERE len(b) < 12),
s AS ({grams('l', 'b')}), g AS ({grams('d', 'w')}), f AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d),
h AS (SELECT DISTINCT g.doc_id, s.item_id, g.p - s.p AS k FROM g JOIN s ON g.h = s.h
UNION SELECT f.doc_id, c.item_id, f.i - 1 FROM f JOIN c ON f.w[f.i] = c.b[1] AND list_slice(f.w, f.i, f.i + len(c.b) - 1) = c.b),
v AS (SELECT h.*, CASE WHEN len(b.b) < 12 THEN len(b.b) ELSE least(24, len(b.b)) END AS run, len(b.b) AS m, list_transform(range(0, len(b.b)), lambda j: CASE WHEN k + j >= 0 AND k + j < len(d.w) AND d.w[k + j + 1] = b.b[j + 1] THEN 1 ELSE 0 END) AS eq FROM h JOIN b ON b.item_id = h.item_id JOIN d ON d.doc_id = h.doc_id),
n AS (SELECT doc_id, item_id, k, run, m, list_max(list_transform(range(0, len(eq) - run + 1), lambda x: list_sum(list_slice(eq, x + 1, x + run)))) AS n FROM v)
SELECT DISTINCT doc_id, item_id, CAST(k AS INTEGER) AS at_token, CAST(n AS INTEGER) AS n_equal, CAST(run AS INTEGER) AS n_compared FROM n WHERE n >= CASE WHEN m < 12 THEN run ELSE 0.8 * run END"""


def oracle_sql() -> dict[str, str]:
    return {"op3_jaccard_join": OP3_SQL, "op4_decontamination": _op4_sql(), "op7_warc": OP7_SQL}
