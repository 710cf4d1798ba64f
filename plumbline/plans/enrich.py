"""Enrichment of orders, documents, pages and conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions import address as a
from plumbline.functions import text as t
from plumbline.operators.updates import preview


ADDRESS, PARTS = "shipping_address", "address_parts"


def _taken_apart(orders: DataFrame) -> DataFrame:
    """Addresses matched once, ahead of everything that uses their parts."""
    return orders.withColumn(PARTS, a.address_parts(F.col(ADDRESS)))


def _components():
    return a.extract_address(F.col(ADDRESS), F.col(PARTS)).alias("address_components")


def _redacted():
    return a.redact_address(F.col(ADDRESS), F.col(PARTS)).alias("redacted_address")


def enriched_orders(orders: DataFrame) -> DataFrame:
    """Address parts and a masked address next to the business columns."""
    return _taken_apart(orders).select(
        "order_id", "customer_id", "order_total", "order_date", "region", ADDRESS, _components(), _redacted())


def flat(enriched: DataFrame) -> DataFrame:
    """One column per address part, for sinks without nested types."""
    others = [c for c in enriched.columns if c != "address_components"]
    return enriched.select(*others, "address_components.*")


def extracted_addresses(orders: DataFrame) -> DataFrame:
    known = orders.filter(F.col(ADDRESS).isNotNull())
    return flat(_taken_apart(known).select("order_id", ADDRESS, _components()))


def redacted_addresses(orders: DataFrame) -> DataFrame:
    known = orders.filter(F.col(ADDRESS).isNotNull())
    return _taken_apart(known).select("order_id", F.col(ADDRESS).alias("original_address"), _redacted())


def address_preview(orders: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` addresses by order, as extracted and as redacted.  The
    rows are chosen first, so only those are worked on."""
    first = preview(orders.filter(F.col(ADDRESS).isNotNull()).select("order_id", ADDRESS), "order_id", n)
    return flat(_taken_apart(first).select("order_id", ADDRESS, _components(), _redacted()))


def redacted_documents(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", t.redact(F.col("text")).alias("redacted_text"))


def _hit_columns(df: DataFrame) -> DataFrame:
    """Hits per kind, computed once per text."""
    return df.select(*[c for c in df.columns if c != "text"],
                     *[t.hits(F.col("text"), kind).alias(kind) for kind in t.PERSONAL_DATA])


def redaction_counts(documents: DataFrame) -> DataFrame:
    """Texts with a hit, and hits, per kind of personal data."""
    kinds = list(t.PERSONAL_DATA)
    totals = _hit_columns(documents.select("text")).agg(
        *[F.struct(F.count_if(F.col(k) > 0).alias("texts"),
                   F.coalesce(F.sum(k), F.lit(0)).alias("hits")).alias(k) for k in kinds])
    return totals.select(F.inline(F.array(*[
        F.struct(F.lit(k).alias("kind"), F.col(f"{k}.texts").alias("texts"), F.col(f"{k}.hits").alias("hits"))
        for k in kinds])))


def conversation_hits(conversations: DataFrame) -> DataFrame:
    """Hits per role and kind."""
    per_role = _hit_columns(conversations.select("role", "text")).groupBy("role").agg(
        F.count("*").alias("turns"),
        *[F.sum(k).cast("bigint").alias(f"{k.lower()}_hits") for k in t.PERSONAL_DATA])
    return per_role


def page_fields(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", *t.extract_fields(t.PAGE_FIELDS))
