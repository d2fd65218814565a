"""How the work is dealt: one shard per reading task, one range per sketching task."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from corpus_fixtures import awkward, frame
from cohortflow.llm import sketch, tokens
from cohortflow.sources.scratch import scratch_path


@pytest.fixture
def whole_shuffles(spark):
    """Tiny shuffles stay in their partitions, as large ones do."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_a_task_reads_one_shard(spark, whole_shuffles):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id")).alias("text"))
    folder = scratch_path(spark, "tokens")
    manifest = tokens.write_tokens(docs, folder, public_tokenizers.path("word_bpe_49k.json"))
    shards = manifest.count()
    assert shards == int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = tokens.read_tokens(spark, folder, manifest)
    assert out.rdd.getNumPartitions() == shards
    assert out.groupBy(F.spark_partition_id()).count().count() == shards
    assert [r.start for r in out.orderBy("id").collect()][:2] == [0, out.orderBy("id").first().n_tokens]


def test_rows_of_one_id_fill_several_shards(spark, whole_shuffles):
    docs = spark.range(600).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("t"), F.lpad(F.col("id"), 4, "0")).alias("text"))
    manifest = tokens.write_tokens(docs, scratch_path(spark, "tokens"), public_tokenizers.path("word_bpe_49k.json"))
    assert manifest.count() > 4 and manifest.agg(F.max("docs")).first()[0] < 300


def test_a_task_sketches_one_range(spark):
    docs = spark.range(2000).select(F.col("id"), F.lit("some text").alias("text"))
    rows = sketch.with_successors(docs, 50)
    sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 50 and max(sizes) < 2 * 2000 / 50


def test_empty_tables(spark):
    none = frame(spark, awkward()).limit(0)
    folder = scratch_path(spark, "tokens")
    assert tokens.read_tokens(spark, folder, tokens.write_tokens(none, folder, public_tokenizers.path("word_bpe_49k.json"))).count() == 0
    assert sketch.edited(none).count() == 0


def test_runs_of_known_letters_are_encoded_once():
    encoder = tokens.Encoder(public_tokenizers.path("word_bpe_49k.json"), "<u2")
    calls, whole, runs, one = [], encoder._ids, [], encoder.runs.encode
    encoder._ids = lambda text: calls.append(text) or whole(text)
    encoder.runs.encode = lambda run: runs.append(run) or one(run)
    plain = ["Tokens, 'tokens' TOKENS!!! don't 's3 12", "tokens. (TOKENS) 3's don't Gr\u00fc\u00dfe \u00c9T\u00c9s gr\u00fc\u00dfe\u00d8\u00fe\u00ff"]
    odd = ["\x01 a\x01b \x1c\x7f H\u0331 'LL <|endoftext|> <|ENDOFTEXT|>x \u0130I e\u0301", "\u00d7\u00f7 \u00aa\u00b2\u00bd a\u00a0b \u0440\u0443\u0441 \u65e5\u672c \u212b \u03a3\u03a3 \u00b5"]
    for text in plain:
        assert encoder.encode(text) == whole(text).tobytes()
    assert not calls and len(runs) == len(set(runs)) and "tokens" in runs and "grü\u00dfe" in runs
    for text in plain + odd + [None]:
        assert encoder.encode(text) == whole(text or "").tobytes()
    small = tokens.Encoder(public_tokenizers.path("word_bpe_49k.json"), "<u4", 4)  # forgets
    for text in (plain + odd) * 2:
        assert small.encode(text) == whole(text).astype("<u4").tobytes() and len(small.chunks) <= 4 and len(small.runs) <= 2


def test_other_tokenizers_encode_whole_chunks(tmp_path):
    import json

    own = json.loads(open(public_tokenizers.path("word_bpe_49k.json")).read())
    own["normalizer"]["normalizers"].pop()  # keeps capitals
    (tmp_path / "own.json").write_text(json.dumps(own))
    encoder = tokens.Encoder(str(tmp_path / "own.json"), "<u2")
    assert encoder.chunks is None
    for text in ("Some TEXT, don't", "<| \x01 a"):
        assert encoder.encode(text) == encoder._ids(text).tobytes()
