"""Nearest listed value where the list is a table.

Two strings within ``most`` edits of each other have a string in common that is
left after taking at most ``most`` characters out of each.  So the list is stored
once with a row for every such remainder (its *deletion neighbourhood*, known by
a 64-bit hash), values are spread the same way, and one hash join gives every
pair within reach; the edit distance itself then decides, so equal hashes of
different remainders do no harm.  Nothing is compared with the whole list.

A string of n characters has about ``n ** most / most!`` remainders: meant for
names and codes, with ``most`` of 1 or 2.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainders(value: Column, most: int) -> Column:
    """Hashes of the strings left after taking at most ``most`` characters out of the value, each once."""
    def one_less(v: Column) -> Column:
        # An empty string has itself as its only remainder.
        places = F.sequence(F.lit(1), F.greatest(F.length(v), F.lit(1)))
        return F.transform(places, lambda i: F.concat(v.substr(F.lit(1), i - 1), v.substr(i + 1, F.length(v))))

    left = F.array(value)
    hashes = [F.transform(left, lambda v: F.xxhash64(v))]
    for _ in range(most):
        left = F.array_distinct(F.flatten(F.transform(left, one_less)))
        hashes.append(F.transform(left, lambda v: F.xxhash64(v)))
    return F.array_distinct(F.flatten(F.array(*hashes)))


def _different(df: DataFrame, column: str) -> DataFrame:
    """The different values, over as many tasks as a shuffle has: remainders take
    hundreds of times their space, which adaptive coalescing can't foresee.  Dealt
    by another expression than the aggregate's, else its coalesced exchange would do."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.select(column).dropna().distinct().repartition(tasks, F.xxhash64(column))


def remainder_index(accepted: DataFrame, column: str, most: int = 2) -> DataFrame:
    """(remainder, accepted): a row for every remainder of every different value.  NULL is not a value."""
    values = _different(accepted, column).withColumnRenamed(column, "accepted")
    return values.select(F.explode(remainders(F.col("accepted"), most)).alias("remainder"), "accepted")


def nearest_listed(values: DataFrame, column: str, index: DataFrame, most: int = 2) -> DataFrame:
    """(column, nearest, distance) for every different value with a listed one
    within ``most`` edits; ties go to the first by name.  ``index`` is that of
    ``remainder_index`` with the same ``most``."""
    spread = _different(values, column).select(column, F.explode(remainders(F.col(column), most)).alias("remainder"))
    # A pair met through several remainders is checked each time; the minimum does not mind.
    distance = F.levenshtein(F.col(column), F.col("accepted"), most)
    # Remainders are sized as the values they come from, so Spark would broadcast all of them through the driver.
    near = spread.hint("merge").join(index, "remainder").select(column, distance.alias("distance"), "accepted").filter("distance >= 0")
    best = near.groupBy(column).agg(F.min(F.struct("distance", "accepted")).alias("best"))
    return best.select(column, F.col("best.accepted").alias("nearest"), F.col("best.distance").alias("distance"))
