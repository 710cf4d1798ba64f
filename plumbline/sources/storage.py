"""Parquet tables that survive a lost executor or a restarted driver.

Appends keyed by batch overwrite only their own partition, so a batch that is
run again leaves no trace of its first attempt.  A table that is replaced as a
whole gets a new version folder; it becomes visible when one small row is added
to the list of versions, after all data is in place.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSIONS = T.StructType([T.StructField("version", T.LongType()), T.StructField("through_batch", T.LongType())])


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A typed scan, without rows as long as nothing was written."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through Spark's own file systems; nothing happens if there is none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class BatchLog:
    """Rows written per batch, one partition for each."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path = spark, path
        self.schema = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])

    def write(self, df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")

    def add(self, df: DataFrame, batch_id: int) -> None:
        """Rows beside those that the batch has already."""
        append(df, f"{self.path}/batch_id={batch_id}")

    def retire(self, before: int, since: int = 0) -> None:
        """Drop the rows of batches that nothing reads any more."""
        for batch_id in range(max(0, since), before):
            remove(self.spark, f"{self.path}/batch_id={batch_id}")

    def batch(self, batch_id: int) -> DataFrame:
        """The rows of one batch, without touching the others."""
        rows = T.StructType(self.schema.fields[:-1])
        return read_or_empty(self.spark, f"{self.path}/batch_id={batch_id}", rows)

    def previous(self, batch_id: int) -> DataFrame:
        """What the batch before wrote, for state that is carried along.  Only
        the first batch may find nothing; a gap later on is an error."""
        rows = T.StructType(self.schema.fields[:-1])
        if batch_id == 0:
            return self.spark.createDataFrame([], rows)
        return self.spark.read.schema(rows).parquet(f"{self.path}/batch_id={batch_id - 1}")

    def read(self) -> DataFrame:
        return read_or_empty(self.spark, self.path, self.schema)


class VersionedTable:
    """A table that is replaced as a whole; readers see old or new, never both."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path, schema

    def current(self) -> tuple[int, int]:
        """Newest version and the last batch it covers; (0, -1) without any."""
        newest = read_or_empty(self.spark, f"{self.path}/versions", VERSIONS).agg(
            F.max(F.struct("version", "through_batch")).alias("v")).first()["v"]
        return (newest["version"], newest["through_batch"]) if newest else (0, -1)

    def publish(self, df: DataFrame, through_batch: int = -1) -> int:
        version = self.current()[0] + 1
        df.write.mode("overwrite").parquet(f"{self.path}/data/version={version}")
        mark = self.spark.range(1).select(F.lit(version).cast("bigint").alias("version"),
                                          F.lit(through_batch).cast("bigint").alias("through_batch"))
        append(mark, f"{self.path}/versions")
        return version

    def retire(self, keep: int = 2) -> None:
        """Drop the data of all but the newest versions."""
        for version in range(1, self.current()[0] - keep + 1):
            remove(self.spark, f"{self.path}/data/version={version}")

    def read(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.path}/data/version={self.current()[0]}", self.schema)
