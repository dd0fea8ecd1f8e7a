"""Scans of the readings. Date ranges and columns reach the parquet scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from limitlens.functions.dates import in_window
from limitlens.operators.heat import broadcast_if_small

# The only columns that the calculations read.
CALC_COLUMNS = (
    "eqp_id", "spec_id", "param_value", "processid", "act_time",
    "upper_spec", "lower_spec", "root_lot_id", "wafer_id",
)


def tool_window_scan(
    readings: DataFrame,
    end: Column,
    days: int,
    tools: DataFrame | None = None,
    columns: Sequence[str] = CALC_COLUMNS,
    add_partition_date: bool = True,
    sort_by: str | None = None,
    strict: bool = True,
    broadcast_rows: int = 500_000,
) -> DataFrame:
    """Readings of the given tools (default: all) over the window, laid out tool by tool.

    With ``sort_by`` the rows of a tool's day share a task and are sorted there by tool and that
    column (if it exists): a consumer reads each tool in order, and no total order over all tools
    is made. ``strict=False`` leaves out columns that the files lack. Days without data add no rows.
    """
    rows = readings.where(in_window(F.col("d"), end, days))
    if tools is not None:
        wanted = broadcast_if_small(tools.select("eqp_id").distinct(), broadcast_rows)
        rows = rows.join(wanted, "eqp_id", "left_semi")
    kept = list(columns) if strict else [c for c in columns if c in readings.columns]
    if sort_by is not None and sort_by in kept:
        rows = rows.repartition("eqp_id", "d").sortWithinPartitions("eqp_id", sort_by)
    if add_partition_date:
        rows = rows.withColumn("partition_date", F.col("d").cast("string"))
        kept.append("partition_date")
    return rows.select(*kept)


def readings_filtered(
    readings: DataFrame,
    catalog: DataFrame,
    first: Column,
    last: Column,
    grades: Sequence[str],
    broadcast_rows: int,
) -> DataFrame:
    """Readings of an inclusive date range whose spec is in the catalog with an allowed grade.

    A semi join replaces a long list of ids. The spec list is broadcast if a count shows that
    it is small; otherwise the sort-merge join's skew handling splits a hot spec.
    """
    specs = catalog.where(F.col("grade").isin(*grades)).select("eqp_id", "spec_id").distinct()
    return readings.where(F.col("d").between(first, last)).join(
        broadcast_if_small(specs, broadcast_rows), ["eqp_id", "spec_id"], "left_semi"
    )
