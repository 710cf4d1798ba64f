"""The validated table: deduplicate, score 0–100, classify."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.operators.dedup import first_per_key


@dataclass(frozen=True)
class Rule:
    """A row breaks the rule when ``predicate`` is true; unknown is not broken."""

    name: str
    predicate: str
    points: int = 0

    def broken(self) -> Column:
        return F.coalesce(F.expr(self.predicate), F.lit(False))


# ---- fixed values -----------------------------------------------------------
HARD_RULES = (
    Rule("null_customer", "customer_id is null"),
    Rule("negative_total", "order_total < 0"),
)
SOFT_RULES = (
    Rule("zero_total", "order_total = 0", 20),
    Rule("missing_address", "shipping_address is null", 15),
    Rule("total_mismatch", "abs(order_total - quantity * unit_price) > 1.00D", 10),
)
FULL_SCORE = 100
CLEAN_AT = 90
CLEAN, REVIEW_NEEDED, REJECTED = "CLEAN", "REVIEW_NEEDED", "REJECTED"
# -----------------------------------------------------------------------------


def dedup_orders(orders: DataFrame) -> DataFrame:
    return first_per_key(orders, "order_id", "order_date")


def flag_hard_failures(df: DataFrame, hard: Sequence[Rule] = HARD_RULES) -> DataFrame:
    """One boolean column per hard rule, left NULL where it is unknown."""
    return df.select("*", *[F.expr(r.predicate).alias(f"is_{r.name}") for r in hard])


def score(df: DataFrame, hard: Sequence[Rule] = HARD_RULES, soft: Sequence[Rule] = SOFT_RULES,
          clean_at: int = CLEAN_AT) -> DataFrame:
    """All columns plus ``quality_score`` and ``quality_status``.  Rejected rows
    stay in the table with score 0."""
    rejected = reduce(lambda a, b: a | b, [r.broken() for r in hard])
    penalties = [F.when(r.broken(), r.points).otherwise(0) for r in soft]
    points = reduce(lambda a, b: a - b, penalties, F.lit(FULL_SCORE))
    final = F.when(rejected, 0).otherwise(points).cast("int")
    status = (F.when(rejected, REJECTED).when(points >= clean_at, CLEAN).otherwise(REVIEW_NEEDED))
    return df.select("*", final.alias("quality_score"), status.alias("quality_status"))


def validated_orders(orders: DataFrame) -> DataFrame:
    """Deduplicate first, then apply the rules: one shuffle, on ``order_id``."""
    return score(dedup_orders(orders))


def share_of_total(counts: DataFrame, count: str) -> Column:
    """Percentage of all groups together.  The window only ever sees the
    already aggregated groups."""
    everything = Window.partitionBy(F.lit(1))
    n = F.col(count).cast("double")
    return F.round(n * 100 / F.sum(n).over(everything), 1)


def status_pct(validated: DataFrame) -> DataFrame:
    counts = validated.groupBy("quality_status").agg(F.count("*").alias("order_count"))
    return counts.select("quality_status", "order_count",
                         share_of_total(counts, "order_count").alias("pct")).orderBy("quality_status")


def region_status(validated: DataFrame) -> DataFrame:
    return (validated.groupBy("region", "quality_status").agg(F.count("*").alias("cnt"))
            .orderBy("region", "quality_status"))


def score_histogram(validated: DataFrame) -> DataFrame:
    return (validated.groupBy("quality_score").agg(F.count("*").alias("orders"))
            .orderBy("quality_score"))
