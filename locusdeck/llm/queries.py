"""The registered queries of the corpus operators."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusdeck.llm import (
    alignment, fill_middle, language, packing, pieces, secret_scan, seeds, simhash, spots, templates, toxicity, urls, warc,
)
from locusdeck.llm.shared import read, remainder
from locusdeck.session import new_folder

#: The vocabulary files of op8, op12, op13 and the pipeline; every executor has them at the same paths.
MODEL_FILE = os.environ.get("LOCUSDECK_PIECE_MODEL", "")
BYTE_FILE = os.environ.get("LOCUSDECK_BYTE_MODEL", "")


def _public(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def model_file() -> str:
    return MODEL_FILE or _public("piece_bpe_32k.model")


def byte_file() -> str:
    return BYTE_FILE or _public("byte_bpe_50k.json")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from rows whose remainder is not 2."""
    docs = read(spark, sf_dir, "documents")
    held = remainder("doc_id", 4) == 2
    model = language.fit(docs, ~held)
    rows = docs.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "text")
    return language.predict(rows, model, ("doc_id", "held_out"))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC files and read back."""
    folder = new_folder(spark, "warc")
    warc.write(read(spark, sf_dir, "pages"), folder)
    return warc.read(spark, folder, payloads=False).drop("payload", "url")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without lines whose template recurs."""
    docs = read(spark, sf_dir, "documents")
    return templates.without_recurring(docs, counts=True).select("doc_id", "n_lines", "n_dropped", "text")


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(read(spark, sf_dir, "documents"))
    return found.withColumn("base_sha256", F.sha2("base", 256)).drop("base")


def op5_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spots.edited(read(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        spots.as_text(F.col("signs")).alias("fingerprint"),
        spots.as_text(F.col("edited_signs")).alias("edited_fingerprint"), "near_edited", "near_next",
    )


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each contaminated document and benchmark item."""
    found = seeds.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(read(spark, sf_dir, "documents"), model_file())


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(read(spark, sf_dir, "pages"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document, learned from labels whose remainder is not 1."""
    docs = read(spark, sf_dir, "documents")
    held = remainder("doc_id", 3) == 1
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"), ~held)
    rows = docs.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "text")
    found = toxicity.scored(rows, model, ("doc_id", "held_out"))
    return found.withColumn("predicted", (F.col("score") >= toxicity.THRESHOLD).cast("int"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_middle.rearranged(read(spark, sf_dir, "documents"))
    back = fill_middle.restored(F.col("output"), F.col("form"))
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2(back, 256).alias("restored_sha256"),
    )


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cut freely; all of a document's ids bear loss, so its tokens bound that, too."""
    return packing.packed(read(spark, sf_dir, "documents"), byte_file(), packing.Limits(1024, 64, 1024))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.measured(read(spark, sf_dir, "documents"), byte_file(), model_file())


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id, op2_warc, op3_line_dedup, op4_secrets, op5_spotsigs, op6_decontamination, op7_simhash,
        op8_sentencepiece, op9_url_filter, op10_toxicity, op11_fill_middle, op12_packing, op13_alignment,
    )
}
_UNSIGNED = " + ".join(f"(strpos('0123456789abcdef', substr(h, {{at}} + {i}, 1)) - 1) * {16 ** (7 - i)}" for i in range(8))
ORACLE: dict[str, str] = {
    "op11_fill_middle": f"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), units AS (
    SELECT doc_id, t, regexp_extract_all(t, '[A-Za-z]+|[^A-Za-z]') AS u,
           {_UNSIGNED.format(at=1)} AS h1, {_UNSIGNED.format(at=9)} AS h2,
           {_UNSIGNED.format(at=17)} AS h3, {_UNSIGNED.format(at=25)} AS h4
    FROM texts
), planned AS (
    SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM units
), cut AS (
    SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:n], '') AS s FROM planned
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM cut""",
}
