"""Raw tables, generator, storage."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.draws import MERSENNE, MULTIPLIER, PRIME, STRIDE, draw, identifier
from plumbline.operators.updates import inject_duplicates, preview, sample_rows, update_where
from plumbline.session import shared_folder, written
from plumbline.sources import schemas
from plumbline.sources.generator import generate_orders
from plumbline.sources.shop import raw
from plumbline.sources.storage import BatchLog, VersionedTable, append, read_or_empty
from tests.conftest import SMALL


def test_draws_are_whole_for_any_key(spark):
    keys = [0, 1, 599_999, 2**31, 600_000_000_000, 2**62]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for salt, n in ((1, 100), (59, 30), (12, 29400)):
        got = [r.d for r in df.select(draw("k", salt, n).alias("d")).collect()]
        start = [(k + salt * STRIDE) % MERSENNE for k in keys]
        assert got == [s * s % MERSENNE * MULTIPLIER % PRIME % n for s in start]


def test_wide_identifiers_stay_different(spark):
    df = spark.createDataFrame([(7,), (123_456_789,), (1_234_567_890,)], "k long")
    assert [r[0] for r in df.select(identifier("ORD", F.col("k"))).collect()] == [
        "ORD-00000007", "ORD-123456789", "ORD-1234567890"]


@pytest.mark.parametrize("name", list(schemas.TABLES))
def test_raw_tables_have_the_declared_schema(spark, name):
    found = raw(spark, SMALL, name).schema
    assert [(f.name, f.dataType) for f in found] == [(f.name, f.dataType) for f in schemas.TABLES[name]]


def test_raw_orders_take_one_scan(spark):
    text = raw(spark, SMALL, "orders")._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "Exchange" not in text and "Union" not in text


def test_generator_is_parallel_and_reproducible(spark):
    one = generate_orders(spark, 20_000, 500)
    assert one.rdd.getNumPartitions() > 1
    assert one.repartition(3).exceptAll(generate_orders(spark, 20_000, 500).coalesce(2)).isEmpty()
    shares = one.agg(F.avg(F.col("customer_id").isNull().cast("int")).alias("nulls"),
                     F.avg((F.col("order_total") < 0).cast("int")).alias("negative"),
                     (F.count("*") - F.count_distinct("order_id")).alias("copies")).first()
    assert 0.08 < shares.nulls < 0.10 and 0.015 < shares.negative < 0.025 and 400 < shares.copies < 800


def test_updates_and_samples(spark):
    df = spark.createDataFrame([(i, "A" if i % 2 else None) for i in range(100)], "k long, s string")
    changed = update_where(df, "k", F.lit(-1).cast("long"), F.col("s") == "A")
    assert changed.filter("k = -1").count() == 50 and changed.filter("s is null and k >= 0").count() == 50
    chosen = sample_rows(df, "k", 10, salt=3)
    assert chosen.count() == 10 and chosen.exceptAll(sample_rows(df.repartition(5), "k", 10, salt=3)).isEmpty()
    assert inject_duplicates(df, "k", 10, salt=3).groupBy("k").count().filter("count = 2").count() == 10
    assert [r.k for r in preview(df, "k", 3).collect()] == [0, 1, 2]


LOG = T.StructType([T.StructField("x", T.LongType())])


def test_batches_overwrite_only_themselves(spark, folder):
    log = BatchLog(spark, f"{folder}/log", LOG)
    assert log.read().count() == 0
    for batch, n in ((0, 3), (1, 5), (1, 4)):
        log.write(spark.range(n).toDF("x"), batch)
    assert {(r.batch_id, r["count"]) for r in log.read().groupBy("batch_id").count().collect()} == {(0, 3), (1, 4)}
    assert log.batch(1).count() == 4 and log.previous(0).count() == 0 and log.previous(1).count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        log.previous(9)


def test_versions_replace_the_table(spark, folder):
    table = VersionedTable(spark, f"{folder}/t", LOG)
    assert table.current() == (0, -1) and table.read().count() == 0
    table.publish(spark.range(3).toDF("x"))
    before = table.read()
    # A version whose list entry is missing was never finished.
    spark.range(9).toDF("x").write.parquet(f"{folder}/t/data/version=2")
    assert table.read().count() == 3
    table.publish(table.read().unionByName(spark.range(2).toDF("x")), through_batch=7)
    assert table.current() == (2, 7) and table.read().count() == 5 and before.count() == 3


def test_append(spark, folder):
    for _ in range(2):
        append(spark.range(2).toDF("x"), f"{folder}/a")
    assert read_or_empty(spark, f"{folder}/a", LOG).count() == 4


class Session:
    """Only what choosing a folder looks at."""

    def __init__(self, master, folder):
        self.sparkContext, self.conf = self, self
        self.master, self.folder = master, folder

    def get(self, key, default=None):
        return self.folder if key == "spark.checkpoint.dir" else default


def test_shared_folder(spark):
    assert shared_folder(Session("yarn", "s3://bucket/dir/"), "x").startswith("s3://bucket/dir/x-")
    assert "plumbline-" in shared_folder(Session("local[2]", None), "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session("yarn", None), "x")
    assert written(spark.range(4).toDF("x"), "w").count() == 4
