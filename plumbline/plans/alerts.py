"""Alerts: violated expectations, at most one per cooldown, with their details."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators.cooldown import alerts_with_cooldown
from plumbline.plans.monitor import TABLE_COLUMNS

# ---- fixed values -----------------------------------------------------------
COOLDOWN = timedelta(hours=1)
# -----------------------------------------------------------------------------
SUBJECT = (*TABLE_COLUMNS, "expectation_name")


def with_payload(statuses: DataFrame) -> DataFrame:
    """One JSON text per violated row, ready for any messenger."""
    details = F.struct(
        F.col("table_name").alias("table"), F.col("metric_name").alias("metric"), "columns",
        F.col("value").cast("double").alias("value"), F.col("expectation_name").alias("expectation"),
        F.date_format("measurement_time", "yyyy-MM-dd HH:mm:ss").alias("measurement_time"))
    return statuses.filter("violated").select(
        *SUBJECT, "measurement_time", F.to_json(details).alias("payload"))


def alerts(statuses: DataFrame, cooldown: timedelta = COOLDOWN, last_sent: DataFrame | None = None) -> DataFrame:
    """The violations that are sent, with payload."""
    violations = with_payload(statuses)
    sent = alerts_with_cooldown(violations, SUBJECT, "measurement_time", cooldown, last_sent)
    return violations.join(sent, [*SUBJECT, "measurement_time"], "left_semi")
