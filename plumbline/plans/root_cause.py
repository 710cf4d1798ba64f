"""Which group is worse than the rest, and why."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from plumbline.plans.semantic import SemanticModel
from plumbline.plans.validate import HARD_RULES, SOFT_RULES, Rule
from plumbline.session import written

# ---- fixed values -----------------------------------------------------------
TOLERANCE = 0.10        # more than 10 % worse than overall is flagged
ROWS = "n_rows"         # the measure that counts all rows
# -----------------------------------------------------------------------------


def _groups():
    """A window over the groups: one row each, after the aggregation."""
    return Window.partitionBy(F.lit(1))


def issues_by(validated: DataFrame, dimension: str,
              rules: Sequence[Rule] = (*HARD_RULES, *SOFT_RULES)) -> DataFrame:
    """How often each rule is broken in each group."""
    wide = validated.groupBy(dimension).agg(*[F.count_if(r.broken()).alias(r.name) for r in rules])
    return wide.unpivot(dimension, [r.name for r in rules], "issue", "orders")


def rejection_causes(validated: DataFrame, dimension: str, rules: Sequence[Rule] = HARD_RULES) -> DataFrame:
    """Groups ranked by rejection rate, with each hard rule's share of the
    rejections and the rule that causes most of them."""
    counts = validated.groupBy(dimension).agg(
        F.count("*").alias("total_orders"),
        F.count_if(F.col("quality_status") == "REJECTED").alias("rejected_count"),
        *[F.count_if(r.broken()).alias(f"{r.name}_count") for r in rules])
    whole = F.col("total_orders").cast("double")
    rejected = F.nullif(F.col("rejected_count").cast("double"), F.lit(0.0))
    # greatest() compares the count first; on a tie the later name wins.
    top = F.greatest(*[F.struct(F.col(f"{r.name}_count").alias("n"), F.lit(r.name).alias("rule")) for r in rules])
    rated = counts.select(
        "*", F.round(F.col("rejected_count") * 100 / whole, 2).alias("rejection_rate"),
        *[F.round(F.col(f"{r.name}_count") * 100 / rejected, 2).alias(f"{r.name}_share") for r in rules],
        F.when(top["n"] > 0, top["rule"]).alias("main_cause"))
    worst_first = _groups().orderBy(F.col("rejection_rate").desc(), F.col(dimension).asc_nulls_last())
    return rated.select("*", F.row_number().over(worst_first).cast("bigint").alias("rank"))


def flags(model: SemanticModel, dimension: str, higher_is_worse: Mapping[str, tuple[str, str, bool]],
          causes: Mapping[str, str], tolerance: float = TOLERANCE) -> DataFrame:
    """Groups that are more than ``tolerance`` worse than all groups together,
    and for each of them the likeliest cause.

    Each entry maps a name to (numerator measure, denominator measure, higher is
    worse).  Overall figures are sums over the groups, so no second pass over
    the rows is needed.  ``causes`` maps a rule to the measure that counts the
    rows breaking it; the cause is the rule whose share of the group's rows
    exceeds its share of all rows the most.
    """
    measures = dict.fromkeys(m for n, d, _ in higher_is_worse.values() for m in (n, d))
    measures = list({**measures, **dict.fromkeys(causes.values()), ROWS: None})
    groups = model.sums(measures, [dimension])
    whole = {m: F.sum(m).over(_groups()) for m in measures}

    def share(top: Column, bottom: Column) -> Column:
        return top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))

    excess = [F.struct((share(F.col(m), F.col(ROWS)) - share(whole[m], whole[ROWS])).alias("excess"),
                       F.lit(rule).alias("rule")) for rule, m in causes.items()]
    columns = [F.greatest(*excess).alias("_worst") if len(excess) > 1 else excess[0].alias("_worst")]
    for name, (top, bottom, worse_when_higher) in higher_is_worse.items():
        value, overall = share(F.col(top), F.col(bottom)), share(whole[top], whole[bottom])
        flagged = value > overall * (1 + tolerance) if worse_when_higher else value < overall * (1 - tolerance)
        columns += [value.alias(f"{name}_v"), overall.alias(f"{name}_o"), flagged.alias(f"{name}_f")]
    cause = F.when(F.col("_worst.excess") > 0, F.col("_worst.rule"))
    return groups.select(dimension, *columns).select(dimension, F.inline(F.array(*[
        F.struct(F.lit(name).alias("metric_name"), F.col(f"{name}_v").alias("value"),
                 F.col(f"{name}_o").alias("overall"), F.col(f"{name}_f").alias("flagged"),
                 F.when(F.col(f"{name}_f"), cause).alias("cause"))
        for name in higher_is_worse])))


def one_against_rest(model: SemanticModel, dimension: str, group: str, metrics: Sequence[str]) -> DataFrame:
    """One group beside all others together (those without a group included),
    metric by metric.  The measures of the others are added up first, so any
    dimension and any metric will do."""
    measures = model.measures_of(metrics)
    one = F.coalesce(F.col(dimension) == F.lit(group), F.lit(False))
    sides = model.sums(measures, [dimension]).groupBy(one.alias("_one")).agg(*[F.sum(m).alias(m) for m in measures])
    long = sides.select("_one", *[F.expr(model.metrics[m]).cast("double").alias(m) for m in metrics]) \
        .unpivot("_one", list(metrics), "metric_name", "v")
    both = long.groupBy("metric_name").agg(
        F.max(F.when(F.col("_one"), F.col("v"))).alias("group_value"),
        F.max(F.when(~F.col("_one"), F.col("v"))).alias("rest_value"))
    return both.select("metric_name", "group_value", "rest_value",
                       (F.col("group_value") - F.col("rest_value")).alias("difference"))


def slices(model: SemanticModel, bad: str, total: str, dims: Sequence[str], least_rows: int = 20,
           least_share: float = 0.01, above_parents: float = 1.05) -> DataFrame:
    """Combinations of dimension values ("GOLD in WEST") where ``bad`` rows are in excess.

    A slice fixes the values of some dimensions.  Its excess is what it has of
    ``bad`` beyond the overall rate; it is reported if it has ``least_rows`` rows,
    its excess is at least ``least_share`` of all bad rows, and its rate is
    ``above_parents`` times that of each slice with one dimension less (so a
    combination that adds nothing to its parts is left out).

    The rows are read once, into sums by all dimensions; the lattice of slices is
    searched on these, from few dimensions to many.  A slice is not looked into
    if it is too small, or if even all its bad rows together in one part would
    not be enough excess: no slice below it could be reported.
    """
    finest = written(model.sums([bad, total], dims).select(*dims, F.col(bad).alias("bad"), F.col(total).alias("n")), "finest")
    whole = finest.agg(F.sum("bad").alias("bad"), F.sum("n").alias("n")).first()
    if not whole["n"]:
        whole = {"bad": 0, "n": 1}
    rate = whole["bad"] / whole["n"]
    enough = least_share * whole["bad"]
    excess = F.col("bad") - F.col("n") * F.lit(rate)
    alive: dict[tuple[str, ...], DataFrame] = {}
    found = None

    def joined(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
        same = reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[f"_{c}"]) for c in on])
        return left.join(right, same, how)

    for size in range(1, len(dims) + 1):
        for fixed in combinations(dims, size):
            parents = [p for p in combinations(fixed, size - 1) if p]
            if not all(p in alive for p in parents):
                continue
            cells = finest
            for p in parents:
                cells = joined(cells, alive[p].select(*[F.col(c).alias(f"_{c}") for c in p]), p, "left_semi")
            one = cells.groupBy(*fixed).agg(F.sum("bad").alias("bad"), F.sum("n").alias("n"))
            one = written(one.filter((F.col("n") >= least_rows) & (F.col("bad") * F.lit(1 - rate) >= enough)), "slices")
            if one.isEmpty():
                continue
            alive[fixed] = one
            above = one.withColumn("_above", F.lit(rate))
            for p in parents:
                parent = alive[p].select(*[F.col(c).alias(f"_{c}") for c in p], (F.col("bad").cast("double") / F.col("n")).alias("_rate"))
                above = joined(above, parent, p, "inner").withColumn("_above", F.greatest("_above", "_rate")) \
                    .select(*fixed, "bad", "n", "_above")
            kept = above.filter((excess >= enough) & (F.col("bad") > 0) & (F.col("bad").cast("double") / F.col("n") >= above_parents * F.col("_above")))
            kept = kept.select(F.lit(",".join(fixed)).alias("fixed"), *[F.col(d) if d in fixed else F.lit(None).cast(finest.schema[d].dataType).alias(d) for d in dims],
                               F.col("n").alias("row_count"), F.col("bad").alias("bad_count"),
                               F.round(F.col("bad").cast("double") * 100 / F.col("n"), 2).alias("bad_rate"), F.round(excess, 4).alias("excess"))
            found = kept if found is None else found.unionByName(kept)
    if found is None:
        kinds = ", ".join(f"{d} {finest.schema[d].dataType.simpleString()}" for d in dims)
        return finest.sparkSession.createDataFrame([], f"fixed string, {kinds}, row_count long, bad_count long, bad_rate double, excess double")
    return found
