"""Session helpers: cluster sizing and the shared checkpoint folder."""

from __future__ import annotations

from cohortflow.session import MAX_PARTITIONS, PARTITION_BYTES, checkpoint_dir, size_for_input


def test_size_for_input_sets_partitions_from_volume(spark):
    keys = ["spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes",
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"]
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        conf = size_for_input(spark, 100 * 1024**4)  # 100 TB of facts
        assert int(conf["spark.sql.shuffle.partitions"]) == MAX_PARTITIONS < 50_000
        assert int(size_for_input(spark, 1024**4)["spark.sql.shuffle.partitions"]) == 1024**4 // PARTITION_BYTES
        conf = size_for_input(spark, 100 * 1024**4)
        assert spark.conf.get("spark.sql.shuffle.partitions") == conf["spark.sql.shuffle.partitions"]
        small = size_for_input(spark, 1024)
        assert int(small["spark.sql.shuffle.partitions"]) == spark.sparkContext.defaultParallelism
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_checkpoint_dir_comes_from_the_session(spark):
    configured = checkpoint_dir(spark)
    assert configured
    # a fallback never overrides a folder the session already names
    assert checkpoint_dir(spark, fallback="/nonexistent/never-used") == configured
