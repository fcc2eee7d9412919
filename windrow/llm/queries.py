"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from windrow.llm import (
    bpe,
    collocations,
    decontamination,
    infill,
    language,
    licences,
    near_duplicates,
    outliers,
    pages,
    resampling,
    sharding,
    surrogates,
    toxicity,
)
from windrow.llm.sampling import id_remainder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.round_trip(docs, ranks, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = decontamination.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return judged.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

OP1_SQL = rf"""
    WITH item AS (
        SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
    run AS (
        SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i + 1 : i + 13], ' ') AS phrase
        FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 12, 1))) AS i FROM item WHERE len(w) > 0)),
    doc AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
               '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
    place AS (
        SELECT doc_id, n, i, array_to_string(w[i + 1 : i + n], ' ') AS phrase
        FROM (SELECT doc_id, w, n, unnest(range(len(w) - n + 1)) AS i
              FROM doc, (SELECT DISTINCT n FROM run) WHERE len(w) >= n)),
    hit AS (SELECT doc_id, item_id, i, place.n FROM place JOIN run USING (phrase) WHERE place.n = run.n),
    covered AS (
        SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM hit)) GROUP BY doc_id),
    listed AS (
        SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)"""


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(_table(spark, sf_dir, "documents"), size=3, percent=85)


OP4_SQL = rf"""
    WITH RECURSIVE doc AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
               '[^\x20\x09-\x0D]+') AS w FROM documents),
    shingle AS (
        SELECT DISTINCT doc_id, array_to_string(w[i + 1 : i + 3], ' ') AS s
        FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 2, 1))) AS i FROM doc WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
    shared AS (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
        FROM shingle x JOIN shingle y USING (s) WHERE x.doc_id < y.doc_id GROUP BY 1, 2),
    link AS (
        SELECT a, b FROM shared JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
        WHERE 100 * k >= 85 * (p.n + q.n - k)),
    near AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
    reach AS (SELECT a, b FROM near UNION SELECT reach.a, near.b FROM reach JOIN near ON reach.b = near.a),
    least AS (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a)
    SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id,
           doc_id <= coalesce(low, doc_id) AS kept
    FROM doc LEFT JOIN n USING (doc_id) LEFT JOIN least USING (doc_id)"""


# Production jobs pass a secret of their own; the queries need one that gives the same rows each time.
QUERY_KEY = b"key of the registered queries"


def op3_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replace(docs, QUERY_KEY)


def op5_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.extract(_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    text = F.col("main_text")
    return found.select("page_id", "url", text.alias("text"), F.char_length(text).cast("long").alias("n_chars"))


TOXIC_FROM = 0.7


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.trained(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        (id_remainder(F.col("doc_id"), 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
    )


def op7_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = outliers.reject_outliers(_table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *outliers.STATISTICS, "base_failed", "kept", "distance")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(language.training_rows(docs))
    found = language.predict(docs.select("doc_id", "text"), model)
    held_out = (id_remainder(F.col("doc_id"), 4) == 2).alias("held_out")
    return found.select("doc_id", held_out, "language.lang_pred", "language.score", "language.rejected")


def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licences.scan(docs, licences.fit(licences.ordinary_paragraphs(docs)))
    return found.select(
        "doc_id",
        F.size("licences").cast("long").alias("n_licence_paragraphs"),
        F.array_join(F.array_sort(F.array_distinct(F.col("licences.family"))), ",").alias("families"),
    )


def op10_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = _table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return resampling.resample(_table(spark, sf_dir, "documents"), good)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents").select("lang", "text"))


OP11_SQL = rf"""
    WITH piece AS (
        SELECT lang, row_number() OVER () AS id, piece
        FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
              translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
    cut AS (SELECT lang, id, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM piece),
    run AS (
        SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS p
        FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM cut, (VALUES (1), (2), (3)) AS sizes(m)
              WHERE len(w) >= m)),
    f AS (SELECT lang, m, p, count(*) AS f FROM run GROUP BY ALL),
    total AS (SELECT lang, sum(f) AS n FROM f WHERE m = 1 GROUP BY lang),
    common AS (SELECT lang, m, p, f FROM f WHERE f >= 10),
    part AS (
        SELECT lang, m, p, f AS a, k, array_to_string(string_split(p, ' ')[: k], ' ') AS x,
               array_to_string(string_split(p, ' ')[k + 1 :], ' ') AS y
        FROM common, (VALUES (1), (2)) AS cuts(k) WHERE m > k),
    scored AS (
        SELECT part.lang, part.m, part.p, a, k, left_side.f AS l, right_side.f AS r,
               1000000 * CAST(a AS HUGEINT) * a // (CAST(left_side.f AS HUGEINT) * right_side.f) AS score
        FROM part JOIN common left_side ON left_side.lang = part.lang AND left_side.p = x
        JOIN common right_side ON right_side.lang = part.lang AND right_side.p = y),
    lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
    around AS (
        SELECT lang, q, max(f) AS most
        FROM (SELECT lang, f, unnest([array_to_string(string_split(p, ' ')[: 2], ' '),
                                      array_to_string(string_split(p, ' ')[2 :], ' ')]) AS q FROM common WHERE m = 3)
        GROUP BY lang, q),
    ranked AS (
        SELECT s.lang, p AS phrase, a, l, r, score,
               row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, p) AS rank
        FROM lowest s LEFT JOIN around ON around.lang = s.lang AND around.q = s.p AND s.m = 2
        WHERE most IS NULL OR 100 * most < 50 * a)
    SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
           CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
    FROM ranked JOIN total USING (lang) WHERE rank <= 2000"""


SHARDS = 16


def op12_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    sized = docs.select(
        "doc_id",
        sharding.text_size(F.col("text")).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
    )
    dealt = sharding.shuffle_into_shards(sized, SHARDS)
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = infill.rearrange(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = infill.restored(F.col("fim.output"), F.col("fim.form"))
    return cut.select(
        "doc_id",
        "fim.n",
        "fim.form",
        "fim.prefix_chars",
        "fim.middle_chars",
        F.sha2(F.col("fim.output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(text.cast("binary"), 256).alias("restored_sha256"),
    )


OP13_SQL = r"""
    WITH doc AS (
        SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || doc_id) AS h,
               regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
        FROM documents),
    drawn AS (
        SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS UBIGINT) % (len(u) + 1) AS x,
               CAST('0x' || h[9:16] AS UBIGINT) % (len(u) + 1) AS y,
               CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                         OR CAST('0x' || h[17:24] AS UBIGINT) % 100 >= 50 THEN 'plain'
                    WHEN CAST('0x' || h[25:32] AS UBIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
        FROM doc),
    cut AS (
        SELECT *, coalesce(array_to_string(u[1 : least(x, y)], ''), '') AS p,
               coalesce(array_to_string(u[least(x, y) + 1 : greatest(x, y)], ''), '') AS m,
               coalesce(array_to_string(u[greatest(x, y) + 1 :], ''), '') AS s
        FROM drawn)
    SELECT doc_id, CAST(n AS BIGINT) AS n, form,
           CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                  ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM cut"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_decontamination": op1_decontamination,
        "op2_licences": op2_licences,
        "op3_surrogates": op3_surrogates,
        "op4_minhash": op4_minhash,
        "op5_pages": op5_pages,
        "op6_toxicity": op6_toxicity,
        "op7_outliers": op7_outliers,
        "op8_language": op8_language,
        "op9_byte_bpe": op9_byte_bpe,
        "op10_resampling": op10_resampling,
        "op11_collocations": op11_collocations,
        "op12_shuffle": op12_shuffle,
        "op13_infill": op13_infill,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_decontamination": OP1_SQL, "op4_minhash": OP4_SQL, "op11_collocations": OP11_SQL, "op13_infill": OP13_SQL}
