"""Sharding by best-fit-decreasing bin packing.

Indivisible groups (equal texts stay together) enter, largest first, the shard
with the tightest remaining capacity that still holds them; the shards stand in
a balanced tree ordered by remaining capacity.  For a fixed number of shards the
capacity is the smallest one found by bisection with which the packing needs no
more shards (multifit), so that the shards come out nearly equal.

The packing itself is sequential, so it must not grow with the data.  Groups of
at least a ``1 / (n_shards * pieces)`` part of all bytes are packed one by one;
there are at most ``n_shards * pieces`` of them.  All smaller groups are first
gathered by a hash of their text into as many bundles, which are packed like
groups.  At most twice ``n_shards * pieces`` items reach the driver, at any size.

A group larger than a shard's fair part gets a shard of its own, and the others
share the rest.  Null texts form one group, empty ones another, both of size 8
per row.  Repeated rows stay separate rows with slots of their own.  An empty
table gives no rows.  Extra columns are kept; ``size``, ``text_crc32``, ``shard``
and ``slot`` replace columns of the same name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.columns import aside
from plumbline.session import written


@dataclass
class _Node:
    key: tuple[int, int]  # (remaining capacity, shard)
    left: "_Node | None" = None
    right: "_Node | None" = None
    height: int = 1


def _height(node: _Node | None) -> int:
    return node.height if node else 0


def _rotated(node: _Node, up: str, down: str) -> _Node:
    top = getattr(node, up)
    setattr(node, up, getattr(top, down))
    setattr(top, down, node)
    for x in (node, top):
        x.height = 1 + max(_height(x.left), _height(x.right))
    return top


def _balanced(node: _Node) -> _Node:
    node.height = 1 + max(_height(node.left), _height(node.right))
    lean = _height(node.left) - _height(node.right)
    if abs(lean) < 2:
        return node
    up, down = ("left", "right") if lean > 0 else ("right", "left")
    heavy = getattr(node, up)
    if _height(getattr(heavy, down)) > _height(getattr(heavy, up)):
        setattr(node, up, _rotated(heavy, down, up))
    return _rotated(node, up, down)


def _added(node: _Node | None, key: tuple[int, int]) -> _Node:
    if node is None:
        return _Node(key)
    side = "left" if key < node.key else "right"
    setattr(node, side, _added(getattr(node, side), key))
    return _balanced(node)


def _removed(node: _Node, key: tuple[int, int]) -> _Node | None:
    if key == node.key:
        if node.left is None or node.right is None:
            return node.left or node.right
        least = node.right
        while least.left:
            least = least.left
        node.key, node.right = least.key, _removed(node.right, least.key)
    else:
        side = "left" if key < node.key else "right"
        setattr(node, side, _removed(getattr(node, side), key))
    return _balanced(node)


def _tightest(node: _Node | None, size: int) -> tuple[int, int] | None:
    """The shard with the least remaining capacity of at least ``size``."""
    best = None
    while node:
        if node.key[0] >= size:
            best, node = node.key, node.left
        else:
            node = node.right
    return best


def best_fit_decreasing(sizes: list[int], capacity: int, most: int | None = None) -> list[int] | None:
    """The shard of each size; sizes must not ascend. None if more than ``most`` shards are needed."""
    tree, opened, out = None, 0, []
    for size in sizes:
        found = _tightest(tree, size)
        if found is None:
            if size > capacity or opened == most:
                return None
            found = (capacity, opened)
            opened += 1
        else:
            tree = _removed(tree, found)
        tree = _added(tree, (found[0] - size, found[1]))
        out.append(found[1])
    return out


def even_shards(sizes: list[int], n_shards: int, rounds: int = 24) -> list[int]:
    """Shards 0 … n_shards - 1 for sizes that do not ascend, as even as multifit makes them."""
    out, left, total = [], n_shards, sum(sizes)
    while len(out) < len(sizes) and left > 1 and sizes[len(out)] * left >= total:
        total -= sizes[len(out)]  # its own shard: alone it fills a fair part
        out.append(len(out))
        left -= 1
    rest, first = sizes[len(out):], len(out)
    if not rest:
        return out
    low, high = max(rest[0], -(-total // left)), max(rest[0], 2 * -(-total // left))
    best = best_fit_decreasing(rest, low, left)
    if best is None:
        best = best_fit_decreasing(rest, high, left)
        for _ in range(rounds):
            if high - low <= 1:
                break
            middle = (low + high) // 2
            found = best_fit_decreasing(rest, middle, left)
            low, high, best = (low, middle, found) if found else (middle, high, best)
    return out + [first + s for s in best]


def sharded(docs: DataFrame, n_shards: int = 24, pieces: int = 128, slot_rows: int = 20_000, text: str = "text",
            doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` with size, text_crc32, shard and slot (gapless from 0 within a shard).

    ``slot_rows`` bounds how many rows of a shard are numbered by one task; the
    numbers of the parts of a shard are put one after another.
    """
    away, back = aside(docs, "size", "text_crc32", "shard", "slot")
    body = F.col(f"`{text}`")
    rows = docs.select(
        *away, F.col(f"`{doc_id}`").alias("_id"),
        (F.coalesce(F.octet_length(body), F.lit(0)) + 8).cast("long").alias("_size"),
        F.crc32(F.coalesce(body, F.lit(""))).alias("_crc"), F.coalesce(F.md5(body), F.lit("null")).alias("_group"))
    groups = written(rows.groupBy("_group").agg(F.sum("_size").alias("_bytes"), F.count("*").alias("_rows")), "shard-groups")
    total, n_rows = groups.agg(F.sum("_bytes"), F.sum("_rows")).first()
    bundles = n_shards * pieces
    bundle = F.concat(F.lit("#"), F.pmod(F.xxhash64("_group"), F.lit(bundles)))
    large = F.col("_bytes") * bundles >= (total or 0)
    items = groups.groupBy(F.when(large, F.col("_group")).otherwise(bundle).alias("_item")).agg(F.sum("_bytes").alias("_bytes"))
    items = sorted(items.collect(), key=lambda r: (-r["_bytes"], r["_item"]))  # at most 2 * n_shards * pieces rows
    shards = even_shards([r["_bytes"] for r in items], n_shards)
    where = docs.sparkSession.createDataFrame([(r["_item"], s) for r, s in zip(items, shards)], "_at string, _shard int")
    # The large groups are known by name, as few as they are; any other group follows its bundle.
    own = where.filter("_at not like '#%'").select(F.col("_at").alias("_name"), F.col("_shard").alias("_own"))
    rest = where.filter("_at like '#%'").select(F.col("_at").alias("_bundle"), F.col("_shard").alias("_rest"))
    placed = (rows.join(F.broadcast(own), F.col("_group") == F.col("_name"), "left")
              .join(F.broadcast(rest), bundle == F.col("_bundle"), "left")
              .withColumn("_shard", F.coalesce("_own", "_rest"))
              .withColumn("_part", F.pmod(F.xxhash64("_id", "_crc"), F.lit(max(1, -(-(n_rows or 0) // (n_shards * slot_rows)))))))
    parts = written(placed.groupBy("_shard", "_part").agg(F.count("*").alias("_n")), "shard-parts")
    before = Window.partitionBy("_shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(F.col("_shard").alias("_s2"), F.col("_part").alias("_p2"),
                          F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_shard", "_part").orderBy("_id", "_crc", "_size")
    return (placed.withColumn("_k", F.row_number().over(within))
            .join(starts, (F.col("_shard") == F.col("_s2")) & (F.col("_part") == F.col("_p2")))
            .select(*back, F.col("_size").alias("size"),
                    F.col("_crc").alias("text_crc32"), F.col("_shard").alias("shard"),
                    (F.col("_before") + F.col("_k") - 1).cast("long").alias("slot")))
