"""Exact order statistics by narrowing histograms: what is selected from isn't sorted or moved.

A pass counts rows per bin with map-side combine and keeps each bin's smallest and largest value. The
bins that hold the wanted positions are known from these counts; the next pass divides only them, between
the values they were found to hold. The first pass divides by magnitude, so that neither the range nor
the sign of the values matters, and each later one divides an octave's part by ``BINS``: five passes reach
single values however the data lie. A bin of at most ``direct`` rows is finished by ordering its
distinct values instead.

What is shuffled is a row per non-empty bin (and group), and at the end the rows of the bins that are
finished directly. A group may hold all rows: no task sees more of it than its share of the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workspace import stage
from .ordered import null_safe_join

PARTS = 16  # of an octave, in the first pass
BINS = 4096  # of a bin, in the later ones
DIRECT = 50_000  # rows of a bin that one task may order
_OFFSET = 1100 * PARTS  # above the magnitude of the smallest double


def _magnitude(v: Column) -> Column:
    """A whole number that never falls as ``v`` rises; infinities and zero have their own."""
    size = (F.floor(F.log2(F.abs(v)) * PARTS) + _OFFSET).cast("int")
    size = F.when(F.abs(v) == float("inf"), 3 * _OFFSET).otherwise(size)
    return F.when(v == 0, 0).when(v < 0, -size).otherwise(size)


def _binned(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
    )


def _owned(rows: DataFrame, state: DataFrame, by: list[str], targets: int) -> DataFrame:
    """The rows within the bins of ``state``, with the bin's owner (its first target) and limits.

    The bins of a group become columns of one row, so a row of the data meets one row at most.
    """
    mine = F.col("_owner") == F.col("_target")
    limits = state.groupBy(*by).agg(
        *[
            F.max(F.when(mine & (F.col("_target") == i), F.col(c))).alias(f"{c}{i}")
            for i in range(targets)
            for c in ("_lo", "_hi")
        ]
    )
    if by:
        met = null_safe_join(rows, limits, by)
    else:
        one = limits.select(F.struct(*limits.columns)).scalar()
        met = rows.withColumn("_s", one).select("_v", "_s.*")
    inside = [F.col("_v").between(F.col(f"_lo{i}"), F.col(f"_hi{i}")) for i in range(targets)]
    owner, low, high = F.lit(None).cast("int"), F.lit(None).cast("double"), F.lit(None).cast("double")
    for i in reversed(range(targets)):
        owner = F.when(inside[i], F.lit(i)).otherwise(owner)
        low = F.when(inside[i], F.col(f"_lo{i}")).otherwise(low)
        high = F.when(inside[i], F.col(f"_hi{i}")).otherwise(high)
    found = met.select(*by, "_v", owner.alias("_owner"), low.alias("_from"), high.alias("_to"))
    return found.filter("_owner is not null")


def _with_owner(state: DataFrame, by: list[str]) -> DataFrame:
    return state.withColumn("_owner", F.min("_target").over(Window.partitionBy(*by, "_lo")))


def _descend(state: DataFrame, bins: DataFrame, by: list[str], order: str) -> DataFrame:
    """Every target moves into the bin of its owner that holds its position."""
    before = Window.partitionBy(*by, "_owner").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    placed = bins.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    wanted = state.select(*by, "_owner", "_target", "_spot", "_total")
    met = null_safe_join(wanted, placed, [*by, "_owner"])
    at = F.col("_spot") - F.col("_before")
    here = met.filter((at >= 0) & (at < F.col("_n")))
    return here.select(*by, "_target", at.alias("_spot"), "_total", "_n", "_lo", "_hi")


def _narrow(rows: DataFrame, state: DataFrame, by: list[str], targets: int) -> DataFrame:
    share = (F.col("_v") - F.col("_from")) / (F.col("_to") - F.col("_from"))
    part = F.least(F.floor(share * BINS), F.lit(BINS - 1)).cast("int")
    rows = _owned(rows, state, by, targets).withColumn("_part", part)
    return _descend(state, _binned(rows, [*by, "_owner", "_part"]), by, "_part")


def _finish(rows: DataFrame, state: DataFrame, by: list[str], targets: int) -> DataFrame:
    values = _owned(rows, state, by, targets).withColumn("_value", F.col("_v"))
    return _descend(state, _binned(values, [*by, "_owner", "_value"]), by, "_value")


def select_positions(
    rows: DataFrame, spots: Sequence[Column], by: Sequence[str] = (), direct: int = DIRECT
) -> DataFrame:
    """The values at ``spots`` (from 0, expressions of ``_total``) of each group in ascending order.

    ``rows`` holds the group and ``_v``, a double without null and NaN, and is read once per pass; a table
    of at most ``direct`` rows is its own bin. One row per group and spot: group, ``_target`` (the spot's number), ``_total`` and ``_value``.
    """
    by, targets = list(by), len(spots)
    small = rows.limit(direct + 1).count() <= direct
    part = F.col("_v") if small else _magnitude(F.col("_v"))
    bins = _binned(rows.withColumn("_part", part), [*by, "_part"])
    group = Window.partitionBy(*by)
    total = bins.withColumn("_total", F.sum("_n").over(group))
    wanted = F.array(
        *[F.struct(F.lit(i).alias("_target"), s.cast("long").alias("_spot")) for i, s in enumerate(spots)]
    )
    before = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    total = total.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    met = total.select("*", F.inline(wanted))
    at = F.col("_spot") - F.col("_before")
    here = met.filter((at >= 0) & (at < F.col("_n")))
    state = here.select(*by, "_target", at.alias("_spot"), "_total", "_n", "_lo", "_hi")
    if small:
        return state.select(*by, "_target", "_total", F.col("_lo").alias("_value"))
    state = stage(state, "bins")
    found = F.col("_lo") == F.col("_hi")
    while True:
        largest = state.filter(~found).agg(F.max("_n")).first()[0]
        if largest is None:
            break
        if largest <= direct:
            large, act = ~found, _finish
        else:
            large, act = ~found & (F.col("_n") > direct), _narrow
        chosen = _with_owner(state.filter(large), by)
        state = stage(state.filter(~large).unionByName(act(rows, chosen, by, targets)), "bins")
    return state.select(*by, "_target", "_total", F.col("_lo").alias("_value"))


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: dict[str, float],
    by: Sequence[str] = (),
    direct: int = DIRECT,
    stored: bool = False,
) -> DataFrame:
    """Exact interpolated quantiles per group, plus ``n``; nulls and NaN are left out.

    Groups and values are written once, so that passes don't repeat what ``df`` is made by;
    ``stored`` says that ``df`` is a written table and can be read again as it is.
    """
    by = list(by)
    # Adding zero makes -0.0 an ordinary zero.
    v = F.col(value).cast("double") + F.lit(0.0)
    rows = df.select(*by, v.alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    rows = rows if stored else stage(rows, "values")
    spots = []
    for p in probs.values():
        spot = F.lit(float(p)) * (F.col("_total") - 1)
        spots += [F.floor(spot), F.ceil(spot)]
    chosen = select_positions(rows, spots, by, direct)
    value_of = [F.max(F.when(F.col("_target") == i, F.col("_value"))).alias(f"_q{i}") for i in range(len(spots))]
    picked = chosen.groupBy(*by).agg(F.max("_total").alias("n"), *value_of)
    out = []
    for i, (name, p) in enumerate(probs.items()):
        spot = F.lit(float(p)) * (F.col("n") - 1)
        lo, hi = F.col(f"_q{2 * i}"), F.col(f"_q{2 * i + 1}")
        # Equal ends are the value itself, also if they are infinite.
        between = lo + (hi - lo) * (spot - F.floor(spot))
        out.append(F.when(lo == hi, lo).otherwise(between).alias(name))
    return picked.select(*by, "n", *out)


def group_median(df: DataFrame, value: str, by: Sequence[str], name: str = "median") -> DataFrame:
    return exact_quantiles(df, value, {name: 0.5}, by).drop("n")
