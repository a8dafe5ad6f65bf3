"""The registered queries of the text operators: name -> (query, SQL that gives the same rows or None)."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import boilerplate, bpe, dialogue, jaccard, langid, licenses, manifest, mixing, pii, repeats, sketch, topk, urls
from strata.llm.oracle import OP11_SQL, OP13_SQL

VOCABULARY = "byte_bpe_50k.tiktoken"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    cut = repeats.cut_repeats(documents).select(
        F.col("doc_id").alias("id"), "mark", F.sha2("kept", 256).alias("sha"), F.octet_length("kept").alias("left"),
        (F.size("spans") / 2).cast("long").alias("spans"),
    ).distinct()
    text = F.coalesce("text", F.lit(""))
    whole = documents.select(
        "doc_id", F.xxhash64("text").alias("m"), F.octet_length(text).cast("long").alias("n_bytes"),
        F.sha2(text.cast("binary"), 256).alias("whole"),
    )
    both = whole.join(cut, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("m") == F.col("mark")), "left")
    return both.select(
        "doc_id", "n_bytes", F.coalesce(F.col("n_bytes") - F.col("left"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("spans", F.lit(0)).cast("long").alias("n_spans"), F.coalesce("sha", "whole").alias("kept_sha256"),
    )


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(read(spark, sf_dir, "documents"))
    added = lambda kind: F.filter("added", lambda s: s["kind"] == kind)
    texts = lambda spans, kind: F.transform(spans, lambda s: pii.span_text(F.lit(kind), s["start"], s["end"]))
    base = F.concat(*[texts(F.col(k), k) for k in pii.KINDS])
    all_of = lambda kind: F.array_sort(
        F.concat(*[F.transform(x, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))) for x in (F.col(kind), added(kind))])
    )
    return found.select(
        "doc_id", *[F.size(all_of(k)).cast("long").alias(f"n_{k}") for k in pii.KINDS],
        F.sha2(F.array_join(base, ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.concat(*[texts(all_of(k), k) for k in pii.KINDS]), ",").alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.copies_plan(read(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


OP3_SQL = """
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM d GROUP BY source),
r AS (SELECT *, 3.0::DOUBLE * source_size AS top, 3.0::DOUBLE * source_size / weight AS turn FROM s),
l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(top) OVER w, 0.0::DOUBLE))::DOUBLE
              / sum(weight) OVER (ORDER BY turn, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
         row_number() OVER (ORDER BY turn, source ASC NULLS LAST) AS place
  FROM r WINDOW w AS (ORDER BY turn, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size,
         least(top, weight * (SELECT level FROM l WHERE level <= turn ORDER BY place LIMIT 1)) AS target
  FROM l),
e AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS expected,
         ('0x' || substr(md5('mix:' || coalesce('=' || source, '-')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS start
  FROM t),
n AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, md5(doc_id::VARCHAR)) AS rank FROM d)
SELECT doc_id, size, source_size, target,
       CAST(floor(start + rank * expected) - floor(start + (rank - 1) * expected) AS BIGINT) * size AS taken
FROM n JOIN e ON n.source IS NOT DISTINCT FROM e.source
"""


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = boilerplate.drop_boilerplate(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


OP4_SQL = """
WITH l AS (
  SELECT doc_id, source, i, line, trim(line, chr(32) || chr(9) || chr(13) || chr(11) || chr(12)) AS core
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE text IS NOT NULL)),
p AS (SELECT source, count(*) AS of_pages FROM documents GROUP BY source),
b AS (
  SELECT l.source, core FROM l JOIN p ON l.source IS NOT DISTINCT FROM p.source WHERE core <> ''
  GROUP BY l.source, core, of_pages
  HAVING count(DISTINCT doc_id) >= 2 AND count(DISTINCT doc_id) > 0.1::DOUBLE * of_pages),
k AS (
  SELECT l.*, EXISTS (SELECT 1 FROM b WHERE b.source IS NOT DISTINCT FROM l.source AND b.core = l.core) AS gone FROM l),
g AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS kept
  FROM k GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, sha256(kept) AS kept_sha256
FROM documents d LEFT JOIN g ON d.doc_id = g.doc_id
"""


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", topk.whole_numbers(F.col("embedding")).alias("vector"))
    return topk.top_k(vectors, vectors.filter(F.col("vec_id") % 20 == 0), 20)


OP5_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS vector FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_inner_product(q.vector, d.vector) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id % 20 = 0 AND q.vec_id <> d.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join_similar(read(spark, sf_dir, "documents"))


def op7_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents").select("doc_id", "text", "lang", langid.held_out(F.col("doc_id")).alias("held_out"))
    model = langid.fit(documents.filter(~F.col("held_out")))
    return langid.identify(documents, model, keep=("doc_id", "held_out"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.find_licenses(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_paragraphs", F.size("notices").cast("long").alias("n_licenses"),
        F.array_join(F.array_sort(F.array_distinct(F.col("notices.family"))), ",").alias("families"),
        F.array_join(F.transform("notices", lambda n: F.concat_ws(":", n["family"], n["line"].cast("string"))), ",").alias("spans"),
    )


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(VOCABULARY)
    coded = bpe.encode(read(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN, keep=("doc_id",), decoded=True)
    return coded.select(
        "doc_id", (F.octet_length("tokens") / 4).cast("long").alias("n_tokens"),
        F.sha2(F.col("tokens"), 256).alias("ids_sha256"), F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sketch.compare_edited(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    )


def op11_dialogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged, copies = dialogue.damage(read(spark, sf_dir, "conversations"))
    return dialogue.judged(damaged, copies)


URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op12_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(read(spark, sf_dir, "pages"), URL_RULES)


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    leaf = lambda text: manifest.leaf(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars")], text)
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    built = manifest.build(
        documents, F.col("lang"), F.col("doc_id"), leaf(F.col("text")),
        {"doc_id": F.col("doc_id"), "changed": F.unhex(F.when(tampered, leaf(lowered)))},
    )
    found = manifest.proofs(built)
    now = F.coalesce(F.lower(F.hex("changed")), F.col("leaf"))
    return found.select(
        "doc_id", "leaf", "subroot", "root", manifest.siblings_digest(F.col("proof")).alias("proof_sha256"),
        manifest.fold(now, F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = {
    "op1_repeats": (op1_repeats, None),
    "op2_pii": (op2_pii, None),
    "op3_source_mix": (op3_source_mix, OP3_SQL),
    "op4_line_dedup": (op4_line_dedup, OP4_SQL),
    "op5_topk": (op5_topk, OP5_SQL),
    "op6_jaccard_join": (op6_jaccard_join, None),
    "op7_langid": (op7_langid, None),
    "op8_licenses": (op8_licenses, None),
    "op9_bpe": (op9_bpe, None),
    "op10_fingerprints": (op10_fingerprints, None),
    "op11_dialogue": (op11_dialogue, OP11_SQL),
    "op12_urls": (op12_urls, None),
    "op13_manifest": (op13_manifest, OP13_SQL),
}
