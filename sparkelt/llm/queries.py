"""Registered queries of the text operators: name -> callable(spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontam, divergence, license, lines, merkle, mixing, pii, quality, simhash, suffix, tokens, warc
from .common import literal_table, shared_dir, table

Query = Callable[[SparkSession, str], DataFrame]


def _license(spark: SparkSession, d: str) -> DataFrame:
    return license.scan(table(spark, d, "documents"))


def _quality(spark: SparkSession, d: str) -> DataFrame:
    shown = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return quality.judged(table(spark, d, "documents")).select("doc_id", *shown)


def _pii(spark: SparkSession, d: str) -> DataFrame:
    found = pii.detect(table(spark, d, "documents"))

    def count(kind: str):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in pii.BASE_KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans")
    )


def _warc(spark: SparkSession, d: str) -> DataFrame:
    back = warc.round_trip(table(spark, d, "pages"), f"{shared_dir(spark)}/warc")
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def _tokens(spark: SparkSession, d: str) -> DataFrame:
    return tokens.count(table(spark, d, "documents"))


def _decontam(spark: SparkSession, d: str) -> DataFrame:
    return decontam.matches(table(spark, d, "documents"), table(spark, d, "benchmark")).drop("row")


def _simhash(spark: SparkSession, d: str) -> DataFrame:
    found = simhash.grouped(table(spark, d, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _suffix(spark: SparkSession, d: str) -> DataFrame:
    return suffix.repeats(table(spark, d, "documents")).drop("spans")


def _lines(spark: SparkSession, d: str) -> DataFrame:
    left = lines.stripped(table(spark, d, "documents").select("doc_id", "text"))
    kept = F.coalesce("text", F.lit(""))
    return left.select(
        "doc_id", "n_lines", "n_dropped", F.length(kept).cast("long").alias("n_kept_chars"), F.sha2(kept, 256).alias("kept_sha256")
    )


def _mixing(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mixed(table(spark, d, "documents"), table(spark, d, "labels")).drop("key")


def tampered_manifest(docs: DataFrame, levels: int = merkle.LEVELS) -> DataFrame:
    """The manifest of ``docs``, and the roots that rows lead to after every second lost its newlines."""
    text = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    other = merkle.leaf_digest(*[text if f == "text" else F.col(f) for f in merkle.FIELDS])
    found = merkle.manifest(docs, carried={"other": other}, levels=levels)
    found = found.withColumn("folded_root", merkle.folded(F.col("other"), F.col("path")))
    proof = merkle.proof_digest(F.col("path")).alias("proof_sha256")
    verified = (F.col("folded_root") == F.col("root")).alias("verified")
    return found.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", verified)


def _merkle(spark: SparkSession, d: str) -> DataFrame:
    return tampered_manifest(table(spark, d, "documents"))


def _chat(spark: SparkSession, d: str) -> DataFrame:
    awkward = "</s>[INST] ok [/INST]"
    rows = [(-7, 0, "user", awkward), (-7, 1, "assistant", awkward)]
    own = literal_table(spark, rows, ["conv_id", "turn", "role", "text"])
    given = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.segments(given.unionByName(own.select(*[own[f.name].cast(f.dataType) for f in given.schema]))))


def _divergence(spark: SparkSession, d: str) -> DataFrame:
    return divergence.audit(table(spark, d, "documents"))


def queries() -> dict[str, Query]:
    return {
        "op1_license_scan": _license,
        "op2_simhash_groups": _simhash,
        "op3_warc_segments": _warc,
        "op4_pii_spans": _pii,
        "op5_line_templates": _lines,
        "op6_suffix_repeats": _suffix,
        "op7_token_counts": _tokens,
        "op8_soft_mixing": _mixing,
        "op9_quality_rules": _quality,
        "op10_benchmark_leaks": _decontam,
        "op11_merkle_manifest": _merkle,
        "op12_chat_format": _chat,
        "op13_source_divergence": _divergence,
    }
