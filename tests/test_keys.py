"""K1 dense keys: dense, ordered, no single-partition funnel."""

from pyspark.sql import functions as F

from starloom.operators.keys import assign_dense_keys, dense_keys, next_key


def test_keys_are_dense_and_follow_the_order(spark):
    df = spark.range(0, 5000).select(
        (F.col("id") % 7).alias("a"), (F.col("id") * 13 % 5000).alias("b"), F.col("id").alias("payload")
    )
    out = dense_keys(df, ["a", "b"], "k", start=1, partitions=6)
    assert out.rows == 5000
    rows = out.df.select("k", "a", "b").collect()
    keys = sorted(r["k"] for r in rows)
    assert keys == list(range(1, 5001))
    by_key = sorted(rows, key=lambda r: r["k"])
    assert [(r["a"], r["b"]) for r in by_key] == sorted((r["a"], r["b"]) for r in rows)


def test_hot_leading_value_is_split_and_still_dense(spark):
    # a third of the rows share one leading value; the second column splits them
    df = spark.range(0, 9000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).alias("a"), F.col("id").alias("b")
    )
    out = dense_keys(df, ["a", "b"], "k", start=101, partitions=8).df
    keys = [r["k"] for r in out.select("k").collect()]
    assert sorted(keys) == list(range(101, 9101))
    # the hot value did not end up in one range partition
    sizes = out.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) < 9000


def test_start_from_existing_max(spark):
    existing = spark.range(1, 11).withColumnRenamed("id", "k")
    assert next_key(existing, "k") == 11
    assert next_key(None, "k") == 1
    new = spark.range(0, 3).select(F.col("id").alias("x"))
    got = sorted(r["k"] for r in assign_dense_keys(new, ["x"], "k", start=next_key(existing, "k")).collect())
    assert got == [11, 12, 13]


def test_empty_input(spark):
    out = dense_keys(spark.range(0).select(F.col("id").alias("x")), ["x"], "k")
    assert out.rows == 0
    assert out.df.count() == 0


def test_explicit_partition_count_gives_the_same_keys(spark):
    df = spark.range(0, 3000).select((F.col("id") * 7 % 3000).alias("a"))
    one = {r["a"]: r["k"] for r in dense_keys(df, ["a"], "k", partitions=1).df.collect()}
    many = {r["a"]: r["k"] for r in dense_keys(df, ["a"], "k").df.collect()}
    assert one == many and sorted(one.values()) == list(range(1, 3001))


def test_columns_that_only_order_are_not_kept(spark):
    df = spark.createDataFrame([(i % 7, i, f"x{i}") for i in range(50)], "a int, b int, c string")
    whole = dense_keys(df, ["a", "b"], "k", partitions=3).df
    kept = dense_keys(df, ["a", "b"], "k", partitions=3, keep=["c"]).df
    assert kept.columns == ["k", "c"]
    assert kept.sort("k").collect() == whole.select("k", "c").sort("k").collect()
    assert dense_keys(df, ["a", "b"], "k", partitions=1, keep=["c"]).df.sort("k").collect() == kept.sort("k").collect()
