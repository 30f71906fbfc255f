"""Registered queries of this subpackage: each operator over its whole table with production parameters.

``LLM_QUERIES[name] = (fn(spark, sf_dir) -> DataFrame, oracle SQL or None)``.
The queries derive digest columns from the operators' real outputs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from capstream.llm import align, ann_tree, budget_mix, exact_topk, fim, main_text, pii_crf, quality_gam, shards, simhash, spm_spans, token_pack, warc_index

LLM_QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def _tokenizer(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _register(name: str, sql: str | None = None):
    def put(fn):
        LLM_QUERIES[name] = (fn, sql)
        return fn
    return put


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# CRC-32 byte by byte over the text's UTF-8, as the engine has no function for it
_CRC_SQL = """
crc_table AS (SELECT list(c ORDER BY i) AS crcs FROM (
  SELECT i, list_reduce(list_prepend(i, range(8)), lambda a, _: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c
  FROM (SELECT unnest(range(256)) AS i))),
hexed AS (SELECT doc_id, source, coalesce(text, '') AS t, hex(encode(coalesce(text, ''))) AS h FROM documents),
bytes AS (SELECT doc_id, source, t, [CAST('0x' || substr(h, k, 2) AS BIGINT) FOR k IN range(1, length(h), 2)] AS b FROM hexed),
docs AS (SELECT doc_id, source, CAST(strlen(t) + 1 AS BIGINT) AS size, CAST(xor(list_reduce(list_prepend(4294967295, b),
  lambda a, x: xor(a >> 8, crcs[xor(a & 255, x) + 1])), 4294967295) AS BIGINT) AS text_crc32 FROM bytes, crc_table)"""


@_register("op1_interleave_shards", f"""
WITH {_CRC_SQL},
keyed AS (SELECT *, CASE WHEN source IS NULL THEN 'n' ELSE 'v' || source END AS s,
                 CAST('0x' || substr(md5('42:' || coalesce('v' || doc_id, 'n')), 1, 15) AS BIGINT) AS key FROM docs),
ranked AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY key) - 1 AS place, count(*) OVER (PARTITION BY s) AS n,
                  CAST('0x' || substr(md5('42:phase:' || s), 1, 15) AS BIGINT) / 1152921504606846976.0::DOUBLE AS phase FROM keyed),
placed AS (SELECT *, row_number() OVER (ORDER BY (place + phase) / n, s, key) - 1 AS pos, count(*) OVER () AS total FROM ranked)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(pos * 16 // total AS INTEGER) AS shard,
       CAST(pos - ((pos * 16 // total) * total + 15) // 16 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM placed""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    narrow = docs.select("doc_id", "source", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
                         F.coalesce(F.crc32("text"), F.lit(0)).cast("long").alias("text_crc32"))
    return shards.interleave_shards(narrow, 16, seed=42).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


@_register("op2_pack_tokens")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_pack.encode_and_pack(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"), end_id=0)
    return token_pack.read_packed(spark, manifest, token_pack.digest,
                                  "doc_id long, start long, n_tokens long, ids_crc32 long")


@_register("op9_budget_mix")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return budget_mix.mix_sources(_table(spark, sf_dir, "documents"), weights=(1, 2, 3), max_repeat=3, seed=42,
                                  carry=["doc_id"])


@_register("op10_sentencepiece_spans")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spm_spans.encode_spans(_table(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model"),
                                  spm_spans.digests, spm_spans.DIGESTS)


@_register("op7_simhash_components")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), words=4, distance=4)


@_register("op8_exact_top_k", """
WITH v AS (
  SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS f FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.f, c.f) AS BIGINT) AS score,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY CAST(list_dot_product(q.f, c.f) AS BIGINT) DESC, c.vec_id) AS rank
  FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0)
WHERE rank <= 10""")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.exact_top_k(_table(spark, sf_dir, "embeddings"), k=10, every=100)


@_register("op4_kmeans_tree_neighbours")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_tree.nearest(_table(spark, sf_dir, "embeddings"), k=5, every=50, recall=0.975)


def read_back(spark: SparkSession, top: str, pages: DataFrame) -> DataFrame:
    """Every page's record, found through the index and read from the archives; digests are taken of the payload read."""
    def row(r: dict) -> dict:
        digest = r["digest"] if r["payload"] is None else hashlib.sha1(r["payload"]).hexdigest()
        return {"page_id": r["page_id"], "payload_bytes": r["payload_bytes"] if r["payload"] is None else len(r["payload"]),
                "payload_digest": digest, "record_type": r["type"], "refers_to": r["refers_to"]}

    return warc_index.fetch(warc_index.lookup(spark, top, pages), row,
                            "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


@_register("op3_warc_index", """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS n FROM pages),
g AS (SELECT h, max(page_id) AS keep FROM p WHERE n >= 1000 GROUP BY h HAVING count(*) > 1)
SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes, sha1(p.h) AS payload_digest,
       CASE WHEN g.keep IS NULL OR p.page_id = g.keep THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN p.page_id <> g.keep THEN g.keep END AS refers_to
FROM p LEFT JOIN g ON p.h = g.h""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return read_back(spark, warc_index.archive(pages), pages)


def pii_digest(found: DataFrame) -> DataFrame:
    """Counts and hash of the patterns' spans and the text of all spans."""
    def told(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["base"])
    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, pii_crf.KINDS), F.sha2(told(base), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))


@_register("op5_pii_crf")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_digest(pii_crf.find(_table(spark, sf_dir, "documents"), pii_crf.kept(spark)))


@_register("op6_quality_gam")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality_gam.fit(docs, _table(spark, sf_dir, "labels"))
    return quality_gam.score(docs, model, ["doc_id"], "doc_id long").select(
        "doc_id", quality_gam.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@_register("op11_fill_in_middle", """
WITH hashed AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
cut AS (SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS u,
               [CAST('0x' || substr(h, 8 * k + 1, 8) AS BIGINT) FOR k IN range(4)] AS h FROM hashed),
ends AS (SELECT *, CAST(len(u) AS BIGINT) AS n, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS a,
                greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS b FROM cut),
parts AS (SELECT doc_id, t, n, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s,
                 CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
                      WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM ends)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256 FROM parts""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    def digest(text):
        return F.sha2(text.cast("binary"), 256)

    return fim.transform(_table(spark, sf_dir, "documents"), seed=1).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
        digest(fim.restored()).alias("restored_sha256"))


# the given pages mark the article by its element and use these references alone
@_register("op12_main_text", """
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's') AS a FROM pages),
t AS (SELECT page_id, url, regexp_replace(regexp_replace(a, '</?b>', '', 'g'), '<[^>]*>', ' ', 'g') AS a FROM a),
d AS (SELECT page_id, url, replace(replace(replace(replace(replace(replace(a, '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&gt;', '>'),
             '&quot;', '"'), '&amp;', '&') AS a FROM t),
w AS (SELECT page_id, url, trim(regexp_replace(a, '\\s+', ' ', 'g')) AS text FROM d)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM w""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(_table(spark, sf_dir, "pages"))


@_register("op13_token_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.aligned(_table(spark, sf_dir, "documents"), _tokenizer("byte_bpe_50k.json"), _tokenizer("piece_bpe_32k.model"))


@_register("pipeline")
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
