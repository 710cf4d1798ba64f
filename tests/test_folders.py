"""Tables that are folders of several files give what single files give."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline import catalog
from plumbline.sources.storage import BatchLog
from tests.compare import _rows
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def split(spark, tmp_path_factory):
    """The smallest tables once more; three of them in four files each, written one after the other in order of time."""
    folder = str(tmp_path_factory.mktemp("split"))
    order = {"orders": "o_orderkey", "customer": "c_custkey", "events": "ts"}
    for file in os.listdir(SMALL):
        if not file.endswith(".parquet"):
            continue
        by = order.get(file.split(".")[0])
        if by is None:
            os.symlink(f"{SMALL}/{file}", f"{folder}/{file}")
            continue
        cut = spark.read.parquet(f"{SMALL}/{file}").withColumn("slice", F.ntile(4).over(Window.orderBy(by))).cache()
        for i in range(1, 5):
            cut.filter(F.col("slice") == i).drop("slice").coalesce(1).write.mode("append").parquet(f"{folder}/{file}")
    return folder


@pytest.mark.parametrize("key", list(catalog.QUERIES))
def test_same_answer(spark, split, key):
    one, many = catalog.QUERIES[key](spark, SMALL), catalog.QUERIES[key](spark, split)
    assert one.columns == many.columns
    assert _rows(one.columns, [tuple(r) for r in one.collect()]) == _rows(many.columns, [tuple(r) for r in many.collect()])


def test_streams_run_in_batches(spark, split, monkeypatch):
    seen = []
    write = BatchLog.write
    monkeypatch.setattr(BatchLog, "write", lambda self, df, batch_id: (seen.append((self.path.rsplit("/", 1)[1], batch_id)), write(self, df, batch_id)))
    for key in ("stream_validated", "stream_metrics", "stream_alerts"):
        catalog.QUERIES[key](spark, split)
    for log in ("changes", "results", "alerts"):
        assert {i for name, i in seen if name == log} >= {0, 1, 2, 3}
