"""Partitions of the warehouse queries."""

from pyspark.sql import functions as F

from stockloom import session


def test_shuffles_are_cut_by_bytes(spark):
    keys = ["spark.sql.adaptive.coalescePartitions.initialPartitionNum",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes"]
    before = {k: spark.conf.get(k, None) for k in keys}
    for key in keys:
        spark.conf.unset(key)
    try:
        session.spread(spark)
        found = spark.range(5_000_000).select(F.xxhash64("id").alias("k")).groupBy("k").count()
        found = found.withColumn("part", F.spark_partition_id()).agg(
            F.count_distinct("part").alias("parts"), F.sum("count").alias("n")).first()
        assert found.parts > 4 and found.n == 5_000_000
        spark.conf.set(keys[1], "32m")  # set by hand
        session.spread(spark)
        assert spark.conf.get(keys[1]) == "32m"
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
