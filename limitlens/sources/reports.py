"""Published reports of earlier weeks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from limitlens import schemas
from limitlens.operators.verdict import prior_flags
from limitlens.sources.tables import read_table


def report_week(spark: SparkSession, root: str, week: str) -> DataFrame:
    return read_table(spark, root, schemas.REPORT).where(F.col("week") == week)


def prior_week_fails(spark: SparkSession, root: str, week: str) -> DataFrame:
    """(eqp_id, spec_id, fail_flag) of a published week; empty when that week was never published.

    The flag is that week's own verdict, not its confirmed one: a confirmed fail needs an
    earlier fail, so nothing could ever become one.
    """
    return prior_flags(report_week(spark, root, week))
