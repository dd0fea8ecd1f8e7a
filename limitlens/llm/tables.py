"""Shared helpers: reading the given tables, sizing shuffles, scratch tables, group answers."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from limitlens.storage import scratch_table, stored


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Scratch tables of the running stage, when somebody listens; see :func:`recorded`.
_MADE: list[list[str]] = []


def scratch(spark: SparkSession, name: str) -> str:
    path = scratch_table(spark, f"llm-{name}")
    for paths in _MADE:
        paths.append(path)
    return path


@contextmanager
def recorded() -> Iterator[list[str]]:
    """The paths of the scratch tables made inside the block, for their removal later."""
    paths: list[str] = []
    _MADE.append(paths)
    try:
        yield paths
    finally:
        _MADE.remove(paths)


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there."""
    return stored(df, scratch(df.sparkSession, name))


def partitions_of(df: DataFrame) -> int:
    """How many tasks a shuffle of the whole table needs.

    As many as its scans have splits by the optimizer's size estimate (no job is run), and never
    fewer than ordinary shuffles use. A source of unknown size counts as nothing.
    """
    spark = df.sparkSession
    conf = spark._jsparkSession.sessionState().conf()
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.length())]
    size = sum(s for s in sizes if s < conf.defaultSizeInBytes())
    ordinary = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(ordinary, min(100_000, math.ceil(size / conf.filesMaxPartitionBytes())))


def held_out(doc_id: str | Column = "doc_id", folds: int = 5) -> Column:
    """The rows no model may learn from: crc32 of the id as text, remainder 0."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(folds)) == 0, F.lit(True))


def text_bytes(column: str = "text") -> Column:
    """UTF-8 bytes of a text; null counts as empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def answer_groups(
    rows: DataFrame, keys: Sequence[str], spread: str, aggregates: dict[str, tuple[str, Column, str]]
) -> DataFrame:
    """Give every row the aggregates of its group, without ever bringing a group together.

    ``spread`` is a column that splits each group over tasks. ``aggregates`` maps an output
    name to (partial name, partial aggregate, how partials combine: "max", "min" or "sum").
    A group of any size becomes at most one row per value of ``spread``; those are combined,
    and the answer goes back the same way, so the widest join key is a group's share.
    """
    keys = list(keys)
    parts = rows.groupBy(*keys, spread).agg(*[a.alias(p) for p, a, _ in aggregates.values()])
    totals = parts.groupBy(*keys).agg(
        *[getattr(F, how)(p).alias(out) for out, (p, _, how) in aggregates.items()]
    )
    answers = parts.select(*keys, spread).join(totals, keys)
    return rows.join(answers, [*keys, spread])
