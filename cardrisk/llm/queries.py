"""The registered queries: each applies one operator to its whole table and derives digest columns.

SQL is given where it can state the result on whole tables; the other queries
are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardrisk.llm.common import read_table

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def _query(fn):
    _QUERIES[fn.__name__] = fn
    return fn


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


@_query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with each class of equal test items that it contains."""
    from cardrisk.llm.decontaminate import contaminated

    found = contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.array_join("item_ids", ",").alias("item_ids"), "shared", "item_shingles", "doc_shingles", "containment")


@_query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardrisk.llm.packing import pack

    pieces = pack(read_table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@_query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardrisk.llm.simhash import near_duplicates

    found = near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


@_query
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardrisk.llm.token_counts import token_counts

    counts = token_counts(read_table(spark, sf_dir, "documents"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)


@_query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardrisk.llm.substring_dedup import dedup

    kept = dedup(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@_query
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardrisk.llm.sharding import kd_shards

    placed = kd_shards(read_table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@_query
def op10_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardrisk.llm import winnowing as W

    pairs = W.edited_pairs(read_table(spark, sf_dir, "documents"))
    names = ("marks", "edited_marks", "next_marks")
    pairs = pairs.withColumns({f"h_{n}": W.hashes(F.col(n)) for n in names})
    return pairs.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        W.fingerprint(F.col("marks")).alias("fingerprint"), W.fingerprint(F.col("edited_marks")).alias("edited_fingerprint"),
        W.likeness(F.col("h_marks"), F.col("h_edited_marks")).alias("near_edited"), W.likeness(F.col("h_marks"), F.col("h_next_marks")).alias("near_next"),
    )


@_query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardrisk.llm.toxicity import THRESHOLD, held_out, scored

    found = scored(read_table(spark, sf_dir, "documents").select("doc_id", "text"), read_table(spark, sf_dir, "labels"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


@_query
def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardrisk.llm import spans as S
    from cardrisk.llm.pii import KINDS, personal_data

    found = personal_data(read_table(spark, sf_dir, "documents"))
    terms = F.transform("terms", lambda t: F.struct(t["start"].alias("start"), t["kind"].alias("kind"), t["end"].alias("end")))
    return found.select(
        "doc_id", *[S.count(F.col("base"), i).alias(f"n_{k}") for i, k in enumerate(KINDS[:4])],
        F.sha2(S.named(F.col("base"), KINDS), 256).alias("base_sha256"), S.named(F.concat("base", terms), KINDS).alias("spans"),
        F.size("terms").cast("bigint").alias("n_term"),
    )


@_query
def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardrisk.llm import spans as S
    from cardrisk.llm.secret_scan import KINDS, NOVEL, scanned

    found = scanned(read_table(spark, sf_dir, "documents").select("doc_id", "text"), "found").select("doc_id", "found")
    base = F.filter("found", lambda s: s["kind"] < NOVEL)
    return found.select(
        "doc_id", *[S.count(F.col("found"), i).alias(f"n_{k}") for i, k in enumerate(KINDS[:3])],
        F.sha2(S.named(base, KINDS), 256).alias("base_sha256"), S.named(F.col("found"), KINDS).alias("spans"),
        S.count(F.col("found"), NOVEL).alias("n_novel"), F.array_join(F.transform(F.array_sort("found"), lambda s: s["bytes"].cast("string")), ",").alias("span_bytes"),
    )


@_query
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardrisk.llm.token_alignment import token_alignment

    return token_alignment(read_table(spark, sf_dir, "documents"))


@_query
def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardrisk.llm.html_extraction import main_text

    return main_text(read_table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))


@_query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cardrisk.llm.common import written
    from cardrisk.llm.vector_codes import digest, vector_codes, with_label_error

    codes, books = vector_codes(read_table(spark, sf_dir, "embeddings"))
    found = with_label_error(written(codes, "vector-codes"))
    return found.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _words_sql(text: str) -> str:
    return f"list_filter(regexp_split_to_array({text}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"


_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SHINGLES = (
    "CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))\n"
    "  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END"
)

_SQL["op1_decontamination"] = f"""
WITH dw AS (SELECT row_number() OVER () AS r, doc_id, {_words_sql(_FOLDED)} AS w FROM documents),
ds AS (SELECT r, doc_id, {_SHINGLES} AS s FROM dw),
iw AS (SELECT item_id, {_words_sql(_FOLDED)} AS w FROM benchmark),
items AS (SELECT min(item_id) AS item_id, array_to_string(list(item_id ORDER BY item_id), ',') AS item_ids, s
  FROM (SELECT item_id, list_sort({_SHINGLES}) AS s FROM iw) WHERE len(s) > 0 GROUP BY s),
d AS (SELECT r, doc_id, len(s) AS n, unnest(s) AS g FROM ds),
i AS (SELECT item_id, item_ids, len(s) AS q, unnest(s) AS g FROM items),
pairs AS (SELECT r, doc_id, n, item_id, item_ids, q, count(*) AS shared FROM d JOIN i USING (g) GROUP BY ALL)
SELECT doc_id, item_id, item_ids, shared, q AS item_shingles, n AS doc_shingles, CAST(shared AS DOUBLE) / q AS containment
FROM pairs WHERE shared >= CAST(0.8 AS DOUBLE) * q
""".strip()

_SQL["op6_substring_dedup"] = f"""
WITH dw AS (SELECT row_number() OVER () AS r, doc_id, {_words_sql("coalesce(text, '')")} AS w FROM documents),
runs AS (SELECT r, unnest(range(1, len(w) - 33)) AS pos, unnest(list_transform(range(1, len(w) - 33), lambda i: hash(w[i:i + 34]))) AS h FROM dw WHERE len(w) >= 35),
twice AS (SELECT r, pos FROM runs WHERE h IN (SELECT h FROM runs GROUP BY h HAVING count(*) > 1)),
words AS (SELECT r, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS word FROM dw),
marked AS (SELECT words.r, words.pos, word, max(CASE WHEN twice.pos IS NULL THEN 0 ELSE 1 END)
    OVER (PARTITION BY words.r ORDER BY words.pos ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone
  FROM words LEFT JOIN twice ON twice.r = words.r AND twice.pos = words.pos),
kept AS (SELECT r, sum(gone) AS n_removed, string_agg(CASE WHEN gone = 0 THEN word END, ' ' ORDER BY pos) AS kept FROM marked GROUP BY r)
SELECT doc_id, len(w) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM dw LEFT JOIN kept USING (r)
""".strip()
