"""Global positions and running sums without a single-task window.

Rows are range-partitioned on a unique sort key, so no partition holds more
than its share however uneven the data is. Each partition counts its own rows;
only the table of per-partition totals (one row per shuffle partition) is
ordered globally and broadcast back. The range-partitioned rows are written to
the shared folder once, so both passes see the same partitions even when an
executor is lost. Pass narrow frames (keys and sizes) and join texts back later.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import durable

_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits
_ROW_MASK = (1 << _ROW_BITS) - 1


def _as_columns(order) -> list[Column]:
    return [F.col(o) if isinstance(o, str) else o for o in order]


def _ranged(df: DataFrame, order) -> DataFrame:
    columns = _as_columns(order)
    placed = (
        df.repartitionByRange(*columns)
        .sortWithinPartitions(*columns)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    return durable(placed).withColumn("_part", F.shiftright("_mid", _ROW_BITS))


def _offsets(totals: DataFrame, value: str, offset: str) -> DataFrame:
    """Sum of ``value`` over all earlier partitions; the input has one row per partition."""
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    return totals.select("_part", F.coalesce(F.sum(value).over(before), F.lit(0)).alias(offset))


def _positioned(df: DataFrame, order, name: str) -> DataFrame:
    rows = _ranged(df, order)
    counts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = _offsets(counts, "_n", "_offset")
    return (
        rows.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_mid").bitwiseAND(F.lit(_ROW_MASK)) + F.col("_offset"))
        .drop("_offset")
    )


def with_global_position(df: DataFrame, order, name: str = "position") -> DataFrame:
    """Adds the 0-based position of each row in the global order; ``order`` must be unique."""
    return _positioned(df, order, name).drop("_mid", "_part")


def _summed(df: DataFrame, order, value: str, name: str, position: str | None, costly: bool) -> DataFrame:
    rows = _ranged(durable(df) if costly else df, order)
    totals = rows.groupBy("_part").agg(F.sum(value).alias("_v"), F.count(F.lit(1)).alias("_n"))
    offsets = _offsets(totals, "_v", "_before")
    if position:
        offsets = offsets.join(_offsets(totals, "_n", "_offset"), "_part")
    local = W.partitionBy("_part").orderBy("_mid").rowsBetween(W.unboundedPreceding, 0)
    out = (
        rows.withColumn("_local", F.sum(value).over(local))
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_local") + F.col("_before"))
    )
    if position:
        out = out.withColumn(position, F.col("_mid").bitwiseAND(F.lit(_ROW_MASK)) + F.col("_offset"))
    return out.drop("_local", "_before", "_offset")


def with_running_sum(df: DataFrame, order, value: str, name: str = "running",
                     position: str | None = None, costly: bool = True) -> DataFrame:
    """Adds the inclusive running sum of an integer column in the global order.

    Range partitioning reads its input twice, once to sample it. ``costly``
    rows (sizes made by tokenising a text, say) are therefore written first.
    """
    return _summed(df, order, value, name, position, costly).drop("_mid", "_part")


def _group_start(rows: DataFrame, group: str, at: str, name: str) -> DataFrame:
    """Adds the value of ``at`` in the first row of the group; rows are ranged by group first.

    A group is a run of rows. Its start is found inside the partition, and for
    the run that a partition takes over from earlier ones in a table of one row
    per partition, so no join moves rows by group. Null is a group like any other.
    """
    here = F.first(at).over(W.partitionBy("_part", group).orderBy("_mid").rowsBetween(W.unboundedPreceding, 0))
    local = rows.withColumn(name, here)
    ends = local.groupBy("_part").agg(
        F.min_by(F.struct(F.col(group).alias("g")), "_mid").alias("first"),
        F.max_by(F.struct(F.col(group).alias("g"), F.col(name).alias("start")), "_mid").alias("last"))
    heads = ends.groupBy(F.struct(F.col("last.g").alias("g")).alias("first")).agg(
        F.min("_part").alias("_since"), F.min_by("last.start", "_part").alias("_carried"))
    carried = ends.select("_part", "first").join(heads, "first").where(F.col("_since") < F.col("_part")).select(
        "_part", F.col("first.g").alias("_run"), "_carried", F.lit(True).alias("_taken"))
    goes_on = F.coalesce("_taken", F.lit(False)) & F.col(group).eqNullSafe(F.col("_run"))
    return local.join(F.broadcast(carried), "_part", "left").withColumn(
        name, F.when(goes_on, F.col("_carried")).otherwise(F.col(name))).drop("_run", "_carried", "_taken")


def with_group_position(df: DataFrame, group: str, order, name: str = "position") -> DataFrame:
    """0-based position inside each group, safe when one group holds most rows."""
    placed = _group_start(_positioned(df, [group, *order], "_global"), group, "_global", "_start")
    return placed.withColumn(name, F.col("_global") - F.col("_start")).drop("_global", "_start", "_mid", "_part")


def with_group_running_sum(df: DataFrame, group: str, order, value: str, name: str = "running") -> DataFrame:
    """Inclusive running sum inside each group, safe when one group holds most rows."""
    summed = _summed(df, [group, *order], value, "_total", None, True).withColumn("_prior", F.col("_total") - F.col(value))
    started = _group_start(summed, group, "_prior", "_start")
    return started.withColumn(name, F.col("_total") - F.col("_start")).drop("_total", "_prior", "_start", "_mid", "_part")
