from __future__ import annotations

import itertools

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from plumbline import catalog
from plumbline.operators import nearest, sketches
from tests.conftest import MIDDLE

WORDS = ["", "a", "b", "ab", "ba", "abc", "acb", "abcd", "xabc", "aabbcc", "aabbc", "zzzz", "naïve", "naive", "日本語", "日語"]


def edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def expected(asked, listed, most):
    out = {}
    for a in set(asked) - {None}:
        near = [(edits(a, v), v) for v in set(listed) - {None} if edits(a, v) <= most]
        if near:
            distance, value = min(near, key=lambda x: (x[0], x[1].encode()))
            out[a] = (value, distance)
    return out


def found(spark, asked, listed, most):
    index = nearest.remainder_index(spark.createDataFrame([(v,) for v in listed], "name string"), "name", most)
    rows = nearest.nearest_listed(spark.createDataFrame([(v,) for v in asked], "given string"), "given", index, most).collect()
    assert len({r.given for r in rows}) == len(rows)
    return {r.given: (r.nearest, r.distance) for r in rows}


def test_equals_all_pairs(spark):
    listed = ["".join(p) for n in (1, 3, 4) for p in itertools.product("ab", repeat=n)][::2] + ["naïve", "日本語", None, "ab", "ab"]
    for most in (0, 1, 2):
        assert found(spark, WORDS + [None, "ab"], listed, most) == expected(WORDS, listed, most)


def test_any_strings(spark):
    @settings(max_examples=5, deadline=None)
    @given(st.lists(st.text("abé", max_size=6), max_size=12), st.lists(st.text("abé", max_size=6), max_size=12))
    def check(asked, listed):
        assert found(spark, asked, listed, 2) == expected(asked, listed, 2)
    check()


def test_empty_tables(spark):
    assert found(spark, [], ["a"], 2) == {} and found(spark, ["a"], [], 2) == {}


def test_no_cross_join(spark):
    plan = catalog.QUERIES["product_label_repair"](spark, MIDDLE)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_remainders_are_not_broadcast(spark, folder):
    """A small file of values has hundreds of times its size of remainders; neither side may go through the driver."""
    spark.range(300).select(F.concat(F.lit("some longer label "), F.md5(F.col("id").cast("string"))).alias("name")).write.parquet(folder + "/names")
    names = spark.read.parquet(folder + "/names")
    near = nearest.nearest_listed(names, "name", nearest.remainder_index(names, "name"))
    assert near.count() == 300
    near.collect()  # adaptive execution may change joins while it runs
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_remainders_are_made_in_many_tasks(spark):
    names = spark.range(300).select(F.col("id").cast("string").alias("name"))
    tasks = nearest.remainder_index(names, "name").select(F.spark_partition_id().alias("task")).distinct().count()
    assert tasks == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_estimates_keep_their_bound(spark):
    rows = spark.range(60000).select((F.col("id") % 6).cast("int").alias("month"), (F.col("id") % 17011).alias("k"))
    rows = rows.unionByName(spark.createDataFrame([(None, 1), (2, None)], "month int, k long"))
    estimates = {r.batch: r.estimate for r in sketches.running_estimates(
        sketches.batch_sketches(rows, ["k"], F.col("month"))).collect()}
    seen = set()
    data = rows.collect()
    for batch in [None, *range(6)]:
        seen |= {r.k for r in data if r.month == batch and r.k is not None}
        assert abs(estimates[batch] - len(seen)) <= sketches.bound() * len(seen)


def test_sketches_shuffle_no_keys(spark):
    """One exchange by batch; its rows are sketches."""
    rows = spark.range(1000).select((F.col("id") % 3).alias("month"), F.col("id").alias("k"))
    plan = sketches.batch_sketches(rows, ["k"], F.col("month"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(batch") == plan.count("Exchange ") == 1
