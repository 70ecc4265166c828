"""The bucketed building blocks against plain windows, on skewed keys and odd widths."""

import random

import pytest
from conftest import rows
from pyspark.sql import Window, functions as F

from varloom.operators import scale


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(5)
    data = [
        ("hot" if i % 3 else f"k{i % 7}", i, rnd.randrange(50), None if rnd.random() < 0.6 else f"v{i}")
        for i in range(600)
    ]
    return spark.createDataFrame(data, "k string, i bigint, x bigint, v string").repartition(7)


def test_numbered(skewed):
    plain = skewed.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("x", "i")))
    for width in (1, 3, 100):
        got = scale.numbered(skewed, ["k"], F.floor(F.col("x") / width), [F.col("x"), F.col("i")], "n")
        assert rows(got, "k", "i", "n") == rows(plain, "k", "i", "n")


def test_previous_value(skewed):
    plain = skewed.withColumn("p", F.lag("x").over(Window.partitionBy("k").orderBy("i")))
    for width in (1, 10, 1000):
        got = scale.previous_value(skewed, ["k"], "i", "x", width, "p")
        assert rows(got, "k", "i", "p") == rows(plain, "k", "i", "p")


def test_filled_forward_and_running_total(skewed):
    w = Window.partitionBy("k").orderBy("i")
    filled = skewed.withColumn("f", F.last("v", ignorenulls=True).over(w))
    total = skewed.withColumn(
        "t", F.coalesce(F.sum("x").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    for width in (1, 13, 1000):
        got = scale.filled_forward(skewed, ["k"], "i", "v", width, "f")
        assert rows(got, "k", "i", "f") == rows(filled, "k", "i", "f")
        got = scale.running_total(skewed, ["k"], F.floor(F.col("i") / width), ["i"], "x", "t")
        assert rows(got, "k", "i", "t") == rows(total, "k", "i", "t")


def test_lists_are_complete_at_any_size(spark):
    big = spark.range(5003).selectExpr("if(id < 5000, 'hot', 'cold') as k", "id as i")
    got = {r["k"]: (r["ids_count"], r["ids"]) for r in scale.listed(big, ["k"], F.col("i"), "ids").collect()}
    assert got == {"hot": (5000, list(range(5000))), "cold": (3, [5000, 5001, 5002])}


def test_balanced_join_equals_the_plain_join(spark, monkeypatch):
    rnd = random.Random(3)
    left = spark.createDataFrame([(f"s{i}", "m" if i < 50 else f"m{i % 7}") for i in range(120)] + [("s", None)] * 3, "s string, model string")
    right = spark.createDataFrame([("m" if i < 40 else f"m{rnd.randrange(9)}", f"v{i}") for i in range(90)] + [(None, "v")], "model string, v string")
    for most in (1, 7, 10_000):
        monkeypatch.setattr(scale, "PART_ROWS", most)
        assert rows(scale.balanced_join(left, right, ["model"]), "s", "v") == rows(left.join(right, "model"), "s", "v")
    none = scale.balanced_join(left.limit(0), right, ["model"])
    assert none.count() == 0 and none.columns == ["model", "s", "v"]


def test_copies_of_a_model_follow_its_own_requests(spark):
    """1,000 models of 50 rows; one is asked for by 5,000 samples, the others by one each."""
    left = spark.range(5000).selectExpr("id as s", "0 as model").union(spark.range(1, 1000).selectExpr("id as s", "cast(id as int) as model"))
    right = spark.range(50_000).selectExpr("cast(id % 1000 as int) as model", "id as v")
    a, b, keys = scale.balanced_sides(left, right, ["model"], 100, 20)
    assert keys == ["model", "_left_part", "_right_part"]
    # every model has 50 rows, so 3 parts; the hot one has 50 parts of requests
    assert a.count() == 3 * 5999
    assert b.count() == 50_000 + 49 * 50 and b.where("model <> 0").count() == 999 * 50
    sizes = a.groupBy(*keys).count().join(b.groupBy(*keys).agg(F.count("*").alias("m")), keys)
    assert sizes.agg(F.max("count")).first()[0] < 200 and sizes.agg(F.max("m")).first()[0] < 60
    assert sizes.agg(F.sum(F.col("count") * F.col("m"))).first()[0] == 5999 * 50


def test_one_hot_key_is_spread_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(scale, "PART_ROWS", 50)
    left = spark.range(2000).selectExpr("id as s", "'m' as model")
    right = spark.range(400).selectExpr("'m' as model", "id as v")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        per_task = scale.balanced_join(left, right, ["model"]).groupBy(F.spark_partition_id().alias("t")).count()
        assert max(r["count"] for r in per_task.collect()) < 0.15 * 2000 * 400
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_one_value_and_blocks(spark):
    small = scale.one_value(spark.range(3), F.col("id"))
    assert spark.range(1).select(small.alias("a")).first()["a"] == [0, 1, 2]
    left = spark.range(3).select(F.col("id").alias("q"))
    met = scale.in_blocks(left, spark.range(50), "id", F.col("id"), 7).select("q", F.explode("block").alias("t"))
    assert sorted(tuple(r) for r in met.collect()) == [(q, t) for q in range(3) for t in range(50)]


def test_order_violations_meet_across_ranges(skewed, spark):
    from varloom.operators import checks as ck

    w = Window.partitionBy("k").orderBy("i")
    for keys in (["k"], []):
        own = w if keys else Window.orderBy("i")
        for strict in (True, False):
            prior = F.lag("x").over(own)
            plain = skewed.withColumn("p", prior).where(F.col("x") <= F.col("p") if strict else F.col("x") < F.col("p"))
            got = ck.order_violations(skewed, keys, "i", ["x"], strict)
            assert got.columns == skewed.columns
            assert rows(got, "k", "i") == rows(plain, "k", "i")
    assert ck.order_violations(skewed.limit(0), [], "i", ["x"]).count() == 0


def test_findings_with_one_key_share_a_join(spark):
    from varloom.operators import qc

    seen = spark.createDataFrame(
        [("s", 1, "m", "1", 5, "AA"), ("s", 2, "m", "1", 5, "AA"), ("s", 3, "m", "1", 6, "AG"), ("s", 4, "n", "2", 7, "AA")],
        "sample_id string, source_line_number long, source_marker_id string, source_chromosome string, source_position long, raw_genotype string",
    )
    out = qc.finding_lines(seen)
    assert out._jdf.queryExecution().analyzed().toString().count("Join Inner") == 3
    told = sorted((r["code"], r["source_line_number"]) for r in out.collect())
    assert told == [
        ("CONFLICTING_DUPLICATE_MARKER", 1), ("CONFLICTING_DUPLICATE_MARKER", 2), ("CONFLICTING_DUPLICATE_MARKER", 3),
        ("DUPLICATE_COORDINATE", 1), ("DUPLICATE_COORDINATE", 2),
        ("DUPLICATE_MARKER_ID", 1), ("DUPLICATE_MARKER_ID", 2), ("DUPLICATE_MARKER_ID", 3),
        ("EXACT_DUPLICATE_RECORD", 1), ("EXACT_DUPLICATE_RECORD", 2),
    ]
