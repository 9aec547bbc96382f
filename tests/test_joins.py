"""Joins that stand skew and interval joins against brute force."""

from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from marketlens.operators import joins as jn
from marketlens.session import settings


def _sides(spark):
    rnd = random.Random(1)
    left = [("hot", i) for i in range(300)] + [(f"k{rnd.randrange(40)}", 1000 + i) for i in range(200)] + [
        (None, 5000)] + [("hot", 7)] * 50
    right = [("hot", f"r{i}") for i in range(20)] + [(f"k{i}", f"s{i % 3}") for i in range(20)] + [("right", "x"), (None, "n")]
    return (spark.createDataFrame(left, "k STRING, a INT").repartition(6),
            spark.createDataFrame(right, "k STRING, b STRING").repartition(3))


def _largest_task(df):
    """Rows of the largest partition as adaptive execution leaves them."""
    return max(df.rdd.mapPartitions(lambda it: [sum(1 for _ in it)]).collect())


SPLIT = {"spark__sql__autoBroadcastJoinThreshold": "-1", "spark__sql__adaptive__advisoryPartitionSizeInBytes": "16k",
         "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "16k",
         "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "1.5", "spark__sql__shuffle__partitions": "24"}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_equi_join_equals_plain_join(spark, how):
    left, right = _sides(spark)
    if how == "left":
        right = right.groupBy("k").agg(F.min("b").alias("b"))
    got = jn.equi_join(left, right, ["k"], how).select("k", "a", "b")
    assert rows(got) == rows(left.join(right, "k", how).select("k", "a", "b"))


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("clustered", [False, True])
def test_hot_key_is_split_whatever_the_input_order(spark, how, clustered):
    with settings(spark, **SPLIT):
        left = spark.range(60_000, numPartitions=12).selectExpr(
            "IF(id % 3 = 0, 'hot', CAST(id AS STRING)) AS k", "id", "sha2(CAST(id AS STRING), 256) AS pad")
        if clustered:
            left = left.groupBy("k", "id").agg(F.max("pad").alias("pad")).repartition(8, "k")
        right = spark.range(60_000).selectExpr("IF(id = 0, 'hot', CAST(id AS STRING)) AS k", "id AS v")
        got = jn.equi_join(left, right, ["k"], how, clustered=clustered)
        assert got.count() == 60_000
        assert _largest_task(got) < 15_000


def test_hot_key_of_both_sides_is_split(spark):
    with settings(spark, **SPLIT):
        left = spark.range(6000, numPartitions=8).selectExpr("IF(id % 3 = 0, 'hot', CAST(id AS STRING)) AS k", "id",
                                                             "sha2(CAST(id AS STRING), 512) AS pad")
        right = spark.range(3000, numPartitions=4).selectExpr("IF(id < 300, 'hot', CAST(id AS STRING)) AS k", "id AS v",
                                                              "sha2(CAST(id AS STRING), 512) AS pad2")
        got = jn.equi_join(left, right, ["k"])
        assert got.where("k = 'hot'").count() == 2000 * 300
        assert _largest_task(got) < 300_000


def test_null_keys_of_a_left_join_are_spread(spark):
    with settings(spark, **SPLIT):
        left = spark.range(6000).selectExpr("IF(id % 3 = 0, CAST(id AS STRING), NULL) AS k", "id", "map('a', id) AS m")
        right = spark.range(6000).selectExpr("CAST(id AS STRING) AS k", "id AS v")
        got = jn.equi_join(left, right, ["k"], "left")
        assert got.where("k IS NULL AND v IS NULL").count() == 4000
        assert _largest_task(got) < 1500


def test_sides_are_read_once(spark):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        left, right = _sides(spark)
        plan = jn.equi_join(left, right, ["k"], "left")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("LogicalRDD") == 2


@pytest.mark.parametrize("before,after", [(10, 10), (0, 7), (25, 3), (0, 0)])
def test_interval_join_equals_brute_force(spark, before, after):
    rnd = random.Random(before * 31 + after)
    lhs = [(rnd.choice("ab"), rnd.randrange(200), i) for i in range(150)]
    rhs = [(rnd.choice("abc"), rnd.randrange(200), i) for i in range(150)]
    want = sorted((k, i, j) for k, t, i in lhs for q, u, j in rhs if k == q and t - before <= u <= t + after)
    left = spark.createDataFrame(lhs, "k STRING, lt BIGINT, i INT")
    right = spark.createDataFrame(rhs, "k STRING, rt BIGINT, j INT")
    got = jn.interval_join(left, right, ["k"], "lt", "rt", before, after).select("k", "i", "j")
    assert sorted(map(tuple, got.collect())) == want


def test_dim_lookup_defaults(spark):
    fact = spark.createDataFrame([("1",), ("9",), (None,)], "pid STRING")
    dim = spark.createDataFrame([("1", "north")], "id STRING, name STRING")
    got = jn.dim_lookup(fact, jn.DimSpec(dim, "id", {"name": "pname"}, {"pname": ""}), "pid")
    assert rows(got) == [("1", "north"), ("9", ""), (None, "")]


def test_first_match_takes_the_smallest_id(spark):
    dim = spark.createDataFrame([("a", "y", 2), ("a", "x", 1), ("b", "z", 3)], "n STRING, v STRING, id INT")
    assert rows(jn.first_match(dim, "n", "v", "id")) == [("a", "x"), ("b", "z")]


def test_words_of_keeps_whole_texts(spark):
    text = "Ça va, ÇA! 42-x " * 3000
    got = jn.words_of(spark.createDataFrame([(1, text)], "id INT, t STRING"), "t", ["id"]).groupBy("word").count()
    assert rows(got) == [("42", 3000), ("va", 3000), ("x", 3000), ("ça", 6000)]
