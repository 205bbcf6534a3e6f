"""Queries of the training-data operators: each reads its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Where a public tokenizer's file is; the operators take any path."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_frames import token_files

    return token_files(_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), end_id=2)


def op2_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .kmeans_tree import nearest

    return nearest(_table(spark, sf_dir, "embeddings"))


def op3_quality_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_crf import quality_scores

    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_gif_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .gif_media import text_media

    return text_media(_table(spark, sf_dir, "documents"))


def gif_timed_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frames of operator 4's GIFs, each drawing what has changed, with their times and colour histograms."""
    from .gif_media import text_gifs, timed_frames

    frames = timed_frames(text_gifs(_table(spark, sf_dir, "documents"), delta=True))
    return frames.withColumn("histogram", F.array_join(frames["histogram"].cast("array<string>"), " "))


def op5_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .preference import parroting, preference_pairs, spans_text

    said = _table(spark, sf_dir, "conversations")
    pairs = preference_pairs(said.withColumnRenamed("conv_id", "pair_id"), parroting(said).withColumnRenamed("conv_id", "pair_id"))
    return pairs.withColumns({c: spans_text(pairs[c]) for c in ("chosen_spans", "rejected_spans")})


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bottomk_dedup import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"))


def op7_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .separator_scan import token_counts

    return token_counts(_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), end_id=50256)


def op8_sainte_lague_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix_quotas

    return mix_quotas(_table(spark, sf_dir, "documents"))


def op9_pii_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii_crf import find_pii

    return find_pii(_table(spark, sf_dir, "documents"))


def op10_bpe_segment_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe_segment_tree import bpe_round_trip

    return bpe_round_trip(_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op11_crochemore_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .partition_runs import run_report

    return run_report(_table(spark, sf_dir, "documents"))


def op12_elkan_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .elkan import clustered

    return clustered(_table(spark, sf_dir, "embeddings"))


def op13_zstd_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .zstd_toxicity import toxicity_scores

    return toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_frames": op1_token_frames,
        "op2_kmeans_tree": op2_kmeans_tree,
        "op3_quality_crf": op3_quality_crf,
        "op4_gif_media": op4_gif_media,
        "op5_preference_pairs": op5_preference_pairs,
        "op6_minhash_near_dedup": op6_minhash_near_dedup,
        "op7_separator_scan": op7_separator_scan,
        "op8_sainte_lague_mix": op8_sainte_lague_mix,
        "op9_pii_crf": op9_pii_crf,
        "op10_bpe_segment_tree": op10_bpe_segment_tree,
        "op11_crochemore_runs": op11_crochemore_runs,
        "op12_elkan_clusters": op12_elkan_clusters,
        "op13_zstd_toxicity": op13_zstd_toxicity,
        "gif_timed_frames": gif_timed_frames,
    }


def oracle_sql() -> dict[str, str]:
    from . import bottomk_dedup, elkan, preference

    return {"op5_preference_pairs": preference.SQL, "op6_minhash_near_dedup": bottomk_dedup.SQL, "op12_elkan_clusters": elkan.sql()}
