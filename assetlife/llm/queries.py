"""Registered queries of the training-data operators and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assetlife.llm import chat, langid, packing, secret_scan
from assetlife.llm.common import held_out, ship, table
from assetlife.llm.decontam import contaminated, contamination
from assetlife.llm.embed_dedup import near_vectors
from assetlife.llm.lm_score import cross_entropy_difference
from assetlife.llm.mixing import mix
from assetlife.llm.quality import fit as fit_quality
from assetlife.llm.quality import score as score_quality
from assetlife.llm.resampling import resample
from assetlife.llm.simhash import simhash_components
from assetlife.llm.suffix_dedup import cut_repeats
from assetlife.llm.whitening import whiten

#: A public tokenizer's vocabulary file.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Register ``f``; its tasks find this package wherever they run."""

    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return f(spark, sf_dir)

    QUERIES[f.__name__] = run
    return run


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id."""
    out = simhash_components(table(spark, sf_dir, "documents"), shingle=4, max_bits=4, seed=42)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    out = cut_repeats(table(spark, sf_dir, "documents"), length=100)
    return out.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    out = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), size=13)
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), contaminated().alias("contaminated"))


ORACLE["op9_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS k, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT k FROM win),
pos AS (
  SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT doc_id, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k)),
hit AS (SELECT doc_id, item_id, pos.k, i FROM pos JOIN win ON pos.k = win.k AND pos.s = win.s),
n AS (SELECT doc_id, COUNT(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT doc_id, k, i FROM hit)) GROUP BY doc_id),
it AS (SELECT doc_id, COUNT(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= coalesce(len(w), 0) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN it USING (doc_id)
"""


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    docs = table(spark, sf_dir, "documents")
    weights = fit_quality(docs, table(spark, sf_dir, "labels"), ~held_out("doc_id"), max_per_class=4000)
    return score_quality(docs, weights).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score, second, ambiguous."""
    docs = table(spark, sf_dir, "documents")
    out = langid.predict(docs, langid.learn(docs, ~held_out("doc_id")))
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "second", "ambiguous")


@query
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, end, kind, score, is_secret, value_sha256: every candidate."""
    docs = table(spark, sf_dir, "documents")
    found = secret_scan.scan(docs, *secret_scan.learn(docs))
    return found.select("doc_id", "start", "end", "kind", "score", secret_scan.is_secret().alias("is_secret"), F.sha2("value", 256).alias("value_sha256"))


@query
def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    conversations = chat.with_probe(spark, table(spark, sf_dir, "conversations"))
    return chat.read_back(chat.format_conversations(conversations, tokenizer_path=TOKENIZER))


@query
def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, n_links, component_id, kept."""
    out = near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)
    return out.select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, source_size, target, taken."""
    out = mix(table(spark, sf_dir, "documents"), share=1.5, max_epochs=2.0, seed=7)
    return out.select("doc_id", "size", "source_size", "target", "taken")


ORACLE["op7_mixing"] = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(SUM(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST([3, 1, 2][CAST((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS BIGINT)] AS DOUBLE) AS weight,
             2.0::DOUBLE * source_size AS cap FROM s),
r AS (SELECT *, coalesce(SUM(cap) OVER o, 0.0) AS full_before, SUM(weight) OVER u AS free_from FROM w
      WINDOW o AS (ORDER BY cap / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
             u AS (ORDER BY cap / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
k AS (SELECT *, (1.5::DOUBLE * (SELECT SUM(source_size) FROM s) - full_before) / free_from AS level FROM r),
lv AS (SELECT level FROM k WHERE level * weight < cap ORDER BY cap / weight, source LIMIT 1),
t AS (SELECT source, source_size, CASE WHEN level * weight >= cap THEN cap ELSE level * weight END AS target FROM w, lv),
n AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
p AS (SELECT d.doc_id, d.size, n.source_size, n.target, n.whole, n.target - n.whole * n.source_size AS need,
             coalesce(SUM(d.size) OVER (PARTITION BY d.source
               ORDER BY CAST('0x' || substr(md5('7:' || coalesce(CAST(d.doc_id AS VARCHAR), '') || ':' || CAST(d.size AS VARCHAR)), 1, 13) AS BIGINT), d.doc_id, d.size
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
      FROM d JOIN n ON d.source IS NOT DISTINCT FROM n.source)
SELECT doc_id, size, source_size, target, CAST(size * (whole + CASE WHEN 2.0::DOUBLE * ahead + size <= 2.0::DOUBLE * need THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM p
"""


@query
def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss, score."""
    target = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return cross_entropy_difference(table(spark, sf_dir, "documents"), target)


@query
def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = packing.cut_documents(table(spark, sf_dir, "documents"), tokenizer_path=TOKENIZER, size=1024, end_id=2)
    placed = packing.place(packing.digested(pieces), packing.plan(pieces, size=1024))
    return placed.select(F.col("doc").alias("doc_id"), "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", "sequence_id", F.col("offset").cast("long").alias("offset"))


@query
def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_features, weight, score, rank."""
    out = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=10, least_words=20, buckets=10_000, runs=1, seed=2024)
    return out.select("doc_id", "n_features", "weight", "score", "rank")


ORACLE["op13_resampling"] = r"""
WITH RECURSIVE hexes AS (SELECT list_transform(range(256), lambda x: printf('%02X', x)) AS h),
step(b, c, k) AS (
  SELECT range AS b, CAST(range AS BIGINT) AS c, 0 AS k FROM range(256)
  UNION ALL
  SELECT b, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM step WHERE k < 8),
tbl AS (SELECT list(c ORDER BY b) AS t FROM step WHERE k = 8),
d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
dw AS (SELECT doc_id, w, COUNT(*) AS n FROM (SELECT doc_id, unnest(w) AS w FROM d) GROUP BY ALL),
bw AS (SELECT w, COUNT(*) AS n FROM (SELECT unnest(w) AS w FROM b) GROUP BY ALL),
words AS (SELECT w, hex(encode(w)) AS x FROM (SELECT w FROM dw UNION SELECT w FROM bw)),
buckets AS (
  SELECT w, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
                  list_transform(range(len(x) // 2), lambda i: CAST(list_position(h, substr(x, 2 * i + 1, 2)) - 1 AS BIGINT))),
                lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1])), 4294967295) % 10000 AS k
  FROM words, tbl, hexes),
ds AS (SELECT k, CAST(SUM(n) AS BIGINT) AS s FROM dw JOIN buckets USING (w) GROUP BY k),
bs AS (SELECT k, CAST(SUM(n) AS BIGINT) AS t FROM bw JOIN buckets USING (w) GROUP BY k),
tot AS (SELECT CAST(coalesce((SELECT SUM(s) FROM ds), 0) AS BIGINT) AS sa, CAST(coalesce((SELECT SUM(t) FROM bs), 0) AS BIGINT) AS ta),
gain AS (SELECT k, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * (sa + 10000) AS DOUBLE) / CAST((s + 1) * (ta + 10000) AS DOUBLE))) AS BIGINT) AS g
         FROM ds LEFT JOIN bs USING (k), tot),
ws AS (SELECT doc_id, CAST(SUM(n * g) AS BIGINT) AS weight FROM dw JOIN buckets USING (w) JOIN gain USING (k) GROUP BY doc_id),
sc AS (SELECT d.doc_id, CAST(coalesce(len(w), 0) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
              coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || CAST(d.doc_id AS VARCHAR)), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
       FROM d LEFT JOIN ws USING (doc_id)),
r AS (SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS place, COUNT(*) OVER () AS n FROM sc WHERE n_features >= 20)
SELECT sc.doc_id, sc.n_features, sc.weight, sc.score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM sc LEFT JOIN r USING (doc_id)
"""


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row
    for each vector and component."""
    out = whiten(table(spark, sf_dir, "embeddings"), components=8)
    each = out.select("vec_id", "n", F.col("deviation").cast("long").alias("deviation"), "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "of"))
    return each.select("vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "of.whitened", "of.explained", "identity_error")
