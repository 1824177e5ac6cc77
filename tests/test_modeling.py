"""Model fits: how their rows are dealt."""

from riskloom.plans import modeling


def test_rows_of_a_fit_are_dealt_by_their_number_not_by_the_shuffle_setting(spark):
    cores, before = spark.sparkContext.defaultParallelism, spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        df = spark.range(1000).withColumnRenamed("id", "k")
        small = modeling.spread_by_rows(df, "k", 1000)
        assert small.rdd.getNumPartitions() == cores and small.count() == 1000
        assert modeling.spread_by_rows(df, "k", 3 * cores * modeling.ROWS_PER_TASK - 1).rdd.getNumPartitions() == 3 * cores
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
