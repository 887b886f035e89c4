"""Queries of the operators for training text, over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import pii, quality, secrets, toxicity
from .common import held_out, table
from .decontaminate import find_passages, hit_words
from .exact_dedup import duplicate_groups
from .language_id import identify_language, train
from .mixing import taken_words
from .ngram_join import near_duplicates
from .pii import scan_personal_data
from .resampling import resample
from .secrets import scan_secrets
from .suffix_dedup import without_repeats
from .url_filter import judge_urls
from .vector_codes import compress


def _spelt(spans: Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end of spans by start, then in the order of ``kinds``, then of the others."""
    order = F.array(*(F.lit(k) for k in kinds))
    place = lambda s: F.coalesce(F.nullif(F.array_position(order, s["kind"]), F.lit(0)), F.lit(len(kinds) + 1))
    ranked = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], place(s), s["kind"], s["end"])))
    return F.array_join(F.transform(ranked, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _span_columns(found: str, kinds: tuple[str, ...]) -> list[Column]:
    of = lambda k: F.filter(found, lambda s: s["kind"] == k)
    base = F.filter(found, lambda s: s["kind"].isin(*kinds))
    return [
        *(F.size(of(k)).cast("long").alias(f"n_{k}") for k in kinds),
        F.sha2(_spelt(base, kinds), 256).alias("base_sha256"),
        _spelt(F.col(found), kinds).alias("spans"),
    ]


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_groups(table(spark, sf_dir, "documents"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *_span_columns("found", secrets.BASE))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    return toxicity.score_toxicity(docs, toxicity.train(docs, labels), ["doc_id"]).select(
        "doc_id", held_out().alias("held_out"), "score", "predicted"
    )


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return find_passages(docs, benchmark, ["doc_id"]).select(
        "doc_id",
        "n_words",
        hit_words().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_personal_data(table(spark, sf_dir, "documents"), ["doc_id"])
    return found.select("doc_id", *_span_columns("found", pii.BASE))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken_words(table(spark, sf_dir, "documents"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages).select("page_id", "host", "path", "rule", "verdict")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify_language(docs, train(docs), ["doc_id"]).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score"
    )


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"), ["doc_id"])


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id"
    )


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(table(spark, sf_dir, "embeddings"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (table(spark, sf_dir, t) for t in ("documents", "benchmark"))
    return resample(docs, benchmark, ["doc_id"]).select("doc_id", "n_features", "weight", "score", "rank")


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, t) for t in ("documents", "labels"))
    held = held_out("doc_id", quality.FOLDS, quality.HELD_OUT)
    return quality.score_quality(docs, labels, ["doc_id"]).select("doc_id", held.alias("held_out"), "score", "predicted")


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id IS NOT DISTINCT FROM min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""

OP4_SQL = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size,
    array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS win
  FROM item_words, LATERAL (SELECT unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i)
  WHERE len(w) > 0),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
  SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS win
  FROM doc_words, sizes, LATERAL (SELECT unnest(range(1, len(w) - size + 2)) AS i)
  WHERE len(w) >= size),
hits AS (SELECT doc_id, item_id, i, places.size FROM places JOIN windows USING (size, win)),
hit_words AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_hit
  FROM hits, LATERAL (SELECT unnest(range(0, size)) AS k) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""


def _vector_codes_sql(rounds: int = 6) -> str:
    """Rounds as a chain of tables: the nearest entries, then the entries of their means."""

    def assign(turn: int) -> str:
        return f"""far{turn} AS (
  SELECT vec_id, p, j, sum((x.c - e.c) * (x.c - e.c)) AS d
  FROM x JOIN e{turn} e USING (p, i) GROUP BY vec_id, p, j),
near{turn} AS MATERIALIZED (
  SELECT vec_id, p, j, d FROM far{turn}
  QUALIFY row_number() OVER (PARTITION BY vec_id, p ORDER BY d, j) = 1)"""

    chain = "".join(
        f"""{assign(t)},
mean{t} AS (
  SELECT p, j, i, CAST(floor(sum(c) / count(*)) AS BIGINT) AS c
  FROM near{t} JOIN x USING (vec_id, p) GROUP BY p, j, i),
e{t + 1} AS MATERIALIZED (
  SELECT p, j, i, coalesce(m.c, e.c) AS c FROM e{t} e LEFT JOIN mean{t} m USING (p, j, i)),
"""
        for t in range(rounds)
    )
    return f"""
WITH kept AS (
  SELECT vec_id, label, embedding AS v, CAST(len(embedding) // 8 AS BIGINT) AS w FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
x AS MATERIALIZED (
  SELECT vec_id, k // w AS p, k % w AS i, CAST(floor(4096 * CAST(v[k + 1] AS DOUBLE)) AS BIGINT) AS c
  FROM (SELECT vec_id, v, w, unnest(range(0, 8 * w)) AS k FROM kept)),
seeds AS (
  SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS j FROM kept ORDER BY vec_id LIMIT 16),
e0 AS MATERIALIZED (SELECT p, j, i, c FROM seeds JOIN x USING (vec_id)),
{chain}{assign(rounds)},
codes AS (
  SELECT vec_id, string_agg(format('{{:02x}}', j), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM near{rounds} GROUP BY vec_id),
books AS (
  SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, j, i)) AS codebooks_sha256 FROM e{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  codebooks_sha256
FROM codes JOIN kept USING (vec_id), books
"""


REGISTRY = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_secrets": op2_secrets,
    "op3_toxicity": op3_toxicity,
    "op4_decontaminate": op4_decontaminate,
    "op5_pii": op5_pii,
    "op6_mixing": op6_mixing,
    "op7_url_filter": op7_url_filter,
    "op8_language_id": op8_language_id,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_ngram_join": op10_ngram_join,
    "op11_vector_codes": op11_vector_codes,
    "op12_resampling": op12_resampling,
    "op13_quality": op13_quality,
}

ORACLES = {
    "op1_exact_dedup": OP1_SQL,
    "op4_decontaminate": OP4_SQL,
    "op11_vector_codes": _vector_codes_sql(),
}
