"""One registered query per corpus operator, over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import prepare_workers
from ..sources.scratch import scratch_path
from . import brown, byte_bpe, decontaminate, fim, lines, minhash_forest, mixing, resample, secrets, sketch, target, tokens, toxicity
from .oracle import ORACLE_SQL  # noqa: F401


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = mixing.mixture(table(spark, sf_dir, "documents"))
    return drawn.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.near_duplicate_lines(table(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = [rule.kind for rule in secrets.BASE]
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    own = F.filter("__secrets", lambda s: s["kind"].isin(*base))
    count = lambda kind: F.size(F.filter("__secrets", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in base], F.sha2(listed(own), 256).alias("base_sha256"), listed(F.col("__secrets")).alias("spans")
    )


def op4_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_forest.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = toxicity.held_out(F.col("doc_id"))
    lexicon = toxicity.learn(docs, table(spark, sf_dir, "labels"), usable=~out)
    score = F.col("__tox_score")
    return toxicity.scored(docs, lexicon).select("doc_id", out.alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))


def op6_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    hit = decontaminate.hit_words()
    return found.select(
        "doc_id",
        F.col("__bench_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("__bench_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("__bench_items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "tokens")
    manifest = tokens.write_tokens(table(spark, sf_dir, "documents"), folder, tokenizer_path())
    return tokens.read_tokens(spark, folder, manifest).withColumnRenamed("id", "doc_id")


def op9_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = brown.held_out(F.col("doc_id"))
    model, counts = brown.train(docs.where(~out))
    scored = brown.scored(docs, model, counts)
    return scored.select("doc_id", out.alias("held_out"), *scored.columns[1:])


def op10_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch.edited(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op11_target_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return target.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = tokenizer_path("byte_bpe_50k.tiktoken")
    tokens = byte_bpe.encoded(table(spark, sf_dir, "documents"), ranks).select("id", "ids")
    return byte_bpe.decoded(tokens, ranks).select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fim.transformed(table(spark, sf_dir, "documents")).drop("pieces")
    return fim.restored(out).withColumnRenamed("id", "doc_id").drop("output", "restored")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_pareto_mix,
        op2_line_dedup,
        op3_secret_scan,
        op4_minhash_forest,
        op5_toxicity,
        op6_importance_resampling,
        op7_decontaminate,
        op8_token_files,
        op9_brown_lm,
        op10_scaled_sketch,
        op11_target_resampling,
        op12_byte_bpe,
        op13_fill_in_middle,
    )
}
