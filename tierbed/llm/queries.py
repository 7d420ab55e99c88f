"""One query per operator, over whole tables, and the SQL that checks it where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierbed.llm import oracles
from tierbed.llm.arc import convert_pages
from tierbed.llm.best_fit import pack_best_fit
from tierbed.llm.chosen_path import ngram_join
from tierbed.llm.collocations import collocations
from tierbed.llm.cotraining import quality_scores
from tierbed.llm.curve_packing import pack_along_curve
from tierbed.llm.fair_mixing import fair_mix
from tierbed.llm.line_dedup import dedup_lines
from tierbed.llm.quality_rules import Limits, quality_rules
from tierbed.llm.secret_scan import joined_spans, scan_secrets
from tierbed.llm.simhash import as_hex, fingerprints, likeness, neighbours
from tierbed.llm.storage import saved, scratch
from tierbed.llm.suffix_tree import suffix_tree_scores
from tierbed.llm.turn_repair import damaged, repair_turns, repaired_digests


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 7
    return suffix_tree_scores(table(spark, sf_dir, "documents"), fold != 2)


def op2_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_along_curve(table(spark, sf_dir, "documents"))


def op3_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents")).drop("row", "class")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``n_near``: other rows within Hamming radius 3, for every row whose id 100 divides."""
    prints = saved(fingerprints(table(spark, sf_dir, "documents")), "fingerprints")
    near = neighbours(prints, prints.filter("doc_id % 100 = 0")).withColumnRenamed("fp", "found")
    asked = (F.col("fp") == F.col("found")) & (F.col("doc_id") % 100 == 0)
    return prints.join(near, asked, "left").select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_hex("fp").alias("fingerprint"),
        as_hex("edited_fp").alias("edited_fingerprint"),
        likeness("fp", "edited_fp").alias("near_edited"),
        likeness("fp", "next_fp").alias("near_next"),
        (F.col("near") - 1).alias("n_near"),
    )


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [F.expr(f"cast(size(filter(spans, x -> x.kind = {i})) as bigint)") for i in range(3)]
    return scan_secrets(table(spark, sf_dir, "documents")).select(
        "doc_id",
        counts[0].alias("n_assign"),
        counts[1].alias("n_access"),
        counts[2].alias("n_hex"),
        F.sha2(joined_spans("spans", 3), 256).alias("base_sha256"),
        joined_spans("spans", 4).alias("spans"),
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).drop("removed_words")


def op8_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_fair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fair_mix(table(spark, sf_dir, "documents")).drop("copies", "shuffle")


def op10_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = convert_pages(table(spark, sf_dir, "pages"), scratch(spark, "warc"))
    return records.filter(F.col("type").isin("response", "revisit")).select(
        "page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to"
    )


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    repair = repair_turns(damaged(rows))
    every = rows.select("conv_id").distinct()
    found = repair.conversations.join(
        repaired_digests(repair.turns).withColumnRenamed("conv", "of"), F.col("conv").eqNullSafe(F.col("of")), "left"
    )
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("conv")), "left").select(
        "conv_id",
        *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op13_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_best_fit(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_suffix_tree": op1_suffix_tree,
        "op2_curve_packing": op2_curve_packing,
        "op3_chosen_path": op3_chosen_path,
        "op4_simhash": op4_simhash,
        "op5_secret_scan": op5_secret_scan,
        "op6_line_dedup": op6_line_dedup,
        "op7_quality_rules": op7_quality_rules,
        "op8_cotraining": op8_cotraining,
        "op9_fair_mixing": op9_fair_mixing,
        "op10_arc_to_warc": op10_arc_to_warc,
        "op11_turn_repair": op11_turn_repair,
        "op12_collocations": op12_collocations,
        "op13_best_fit": op13_best_fit,
    }


def oracle_sql() -> dict[str, str]:
    limits = Limits()
    return {
        "op10_arc_to_warc": oracles.ARC_TO_WARC,
        "op12_collocations": oracles.COLLOCATIONS,
        "op6_line_dedup": oracles.LINE_DEDUP,
        "op7_quality_rules": oracles.quality_rules(
            limits.min_docs, limits.share, limits.depletion, limits.min_words,
            limits.max_repeat_percent,
        ),
        "op9_fair_mixing": oracles.FAIR_MIXING,
    }
