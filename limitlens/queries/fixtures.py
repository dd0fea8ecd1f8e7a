"""The logical inputs (readings, catalog sources, ...) derived from the given tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from limitlens.config import Settings
from limitlens.functions.dates import day_closed
from limitlens.operators.cache import day_manifest
from limitlens.operators.catalog import CatalogSources
from limitlens.operators.run_log import run_log
from limitlens.operators.verdict import CURRENT, PRIOR

# Fixed values of the test tables: their 30 days, and the two windows that are compared.
FIRST_DAY, RUN_DAY = date(2024, 1, 1), date(2024, 1, 30)
CACHED_BEFORE = date(2024, 1, 24)
WINDOWS = {CURRENT: ("2024-01-08", "2024-01-30"), PRIOR: ("2024-01-01", "2024-01-23")}
CATALOG_DAY = date(2001, 11, 4)
RUN_TIME = "2024-01-30 06:00:00"

SETTINGS = Settings(window_days=30)
CATALOG_SETTINGS = Settings(recent_days=1000, excluded_areas=("MIDDLE EAST",))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_day() -> Column:
    return F.lit(RUN_DAY)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor readings: a user is a tool, a (user, event type) pair is a spec."""
    step = F.get_json_object("props", "$.k")
    tool = F.col("user_id").cast("string")
    return table(spark, sf_dir, "events").select(
        tool.alias("eqp_id"),
        F.concat_ws("-", tool, "event_type").alias("spec_id"),
        F.col("value").alias("param_value"),
        F.col("event_type").alias("processid"),
        F.col("ts").alias("act_time"),
        F.col("event_id").alias("reading_id"),
        (F.lit(100.0) + step.cast("int")).alias("upper_spec"),
        F.lit(0.0).alias("lower_spec"),
        F.concat(F.lit("L"), step).alias("root_lot_id"),
        F.col("event_id").cast("string").alias("wafer_id"),
        F.col("ts").cast("date").alias("d"),
    )


def _pattern(event_type: Column) -> Column:
    return (
        F.when(event_type == "click", "PATTERN_A")
        .when(event_type == "view", "PATTERN_B")
        .when(event_type == "purchase", "PATTERN_C")
        .when(event_type == "signup", "PATTERN_D")
        .otherwise("UNSUPPORTED")
    )


def registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog of the readings' specs; a spec is registered once per process unit."""
    rows = table(spark, sf_dir, "events")
    tool = F.col("user_id").cast("string")
    low = F.get_json_object("props", "$.k").cast("int") < 50
    return rows.select(
        tool.alias("eqp_id"),
        F.concat_ws("-", tool, "event_type").alias("spec_id"),
        _pattern(F.col("event_type")).alias("pattern"),
        F.concat(F.lit("G"), (F.col("user_id") % 5 + 1).cast("string")).alias("grade"),
        F.when(low, "U1").otherwise("U2").alias("process_unit"),
    ).distinct()


def graded(catalog: DataFrame) -> DataFrame:
    return catalog.where(
        F.col("grade").isin(*SETTINGS.grades) & F.col("pattern").isin(*SETTINGS.patterns)
    )


def tools(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registrations(spark, sf_dir).select("eqp_id").distinct()


def catalog_sources(spark: SparkSession, sf_dir: str) -> CatalogSources:
    part = table(spark, sf_dir, "part")
    name = F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string"))
    kind = F.col("p_type")
    code = (
        F.when(kind == "ECONOMY", 1).when(kind == "LARGE", 2).when(kind == "MEDIUM", 3)
        .when(kind == "PROMO", 4).when(kind == "SMALL", 5).otherwise(6)
    )
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return CatalogSources(
        parameters=part.select(
            F.col("p_partkey").alias("param_id"),
            F.col("p_brand").alias("unit"),
            name.alias("name"),
            F.concat(F.lit("G"), (F.col("p_size") % 5 + 1).cast("string")).alias("grade"),
        ),
        limits=spec_limits(spark, sf_dir),
        tool_config=supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
        .join(region, nation.n_regionkey == region.r_regionkey)
        .select(
            F.col("s_suppkey").cast("string").alias("eqp_id"),
            F.col("r_name").alias("area"),
            # Every third tool is configured twice, once for each of its chambers.
            F.explode(
                F.when(
                    F.col("s_suppkey") % 3 == 0, F.array("n_name", F.concat("n_name", F.lit(" B")))
                ).otherwise(F.array("n_name"))
            ).alias("model"),
        ),
        equipment_names=supplier.select(
            F.col("s_suppkey").cast("string").alias("eqp_id"), F.col("s_name").alias("eqp_name")
        ),
        pattern_definitions=part.select(
            F.lower(F.concat(F.lit(" "), name, F.lit(". "))).alias("param_name"),
            code.alias("type_code"),
        ),
        overrides=part.where("p_size = 50").select(
            F.col("p_partkey").alias("param_id"), F.lit("PATTERN_A").alias("pattern")
        ),
    )


def reading_sources(spark: SparkSession, sf_dir: str) -> CatalogSources:
    """Catalog sources that describe the readings' own specs, as :func:`registrations` has them."""
    rows = registrations(spark, sf_dir)
    specs = rows.select("eqp_id", "spec_id", "pattern", "grade").distinct()
    kinds = F.create_map(*[F.lit(x) for pair in (("PATTERN_A", 1), ("PATTERN_B", 2), ("PATTERN_C", 3), ("PATTERN_D", 4)) for x in pair])
    number = F.abs(F.xxhash64("spec_id"))
    tools = specs.select("eqp_id").distinct()
    return CatalogSources(
        parameters=specs.select(number.alias("param_id"), F.lit("u").alias("unit"), F.col("spec_id").alias("name"), "grade"),
        limits=rows.select(
            number.alias("param_id"), "eqp_id", "spec_id", "process_unit", F.lit("100").alias("upper_text"),
            F.lit("0").alias("lower_text"), F.lit("F").alias("limit_formula"), F.lit("fixed").alias("range_flag"),
            run_day().alias("last_used"), F.lit(1).cast("bigint").alias("used_count"),
        ),
        tool_config=tools.select("eqp_id", F.lit("ETCH").alias("area"), F.lit("M").alias("model")),
        equipment_names=tools.select("eqp_id", F.lit("n").alias("eqp_name")),
        pattern_definitions=specs.select(
            F.col("spec_id").alias("param_name"), F.coalesce(F.try_element_at(kinds, "pattern"), F.lit(9)).alias("type_code")
        ),
    )


def spec_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Limits per (part, supplier), registered per line status as process unit.

    Every seventh part's specs are registered again a day later, on another tool and, for even
    part numbers, under the next parameter; some of these do not count for the catalog.
    """
    one = F.col("used_count") == 1
    first = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_partkey", "l_suppkey", "l_linestatus")
        .agg(
            F.max("l_quantity").alias("_hi"),
            F.min("l_quantity").alias("_lo"),
            F.max("l_shipdate").cast("date").alias("last_used"),
            F.count("*").alias("used_count"),
            # The greatest flag by its code: a number aggregates by hashing, text by sorting.
            F.max(F.ascii("l_returnflag")).alias("_code"),
        )
        .withColumn("_flag", F.chr("_code"))
        .withColumn(
            "spec_id",
            F.concat_ws("-", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")),
        )
    )
    part = F.col("l_partkey")
    again = first.where(part % 7 == 0).select(
        (part + F.when(part % 2 == 0, 1).otherwise(0)).alias("l_partkey"),
        ((part + F.col("l_suppkey")) % 10 + 1).alias("l_suppkey"),
        F.concat("l_linestatus", F.lit("M")).alias("l_linestatus"),
        "_hi", "_lo", F.date_add("last_used", 1).alias("last_used"), "used_count", "_code", "_flag",
        "spec_id",
    )
    return (
        first.unionByName(again)
        .select(
            F.col("l_partkey").alias("param_id"),
            F.col("l_suppkey").cast("string").alias("eqp_id"),
            "spec_id",
            F.col("l_linestatus").alias("process_unit"),
            F.when(one & (F.col("_hi") < 10), "n/a")
            .otherwise(F.concat(F.lit(" "), F.col("_hi").cast("int").cast("string")))
            .alias("upper_text"),
            F.col("_lo").cast("int").cast("string").alias("lower_text"),
            F.concat(F.lit("F"), F.col("_flag")).alias("limit_formula"),
            F.when(F.col("_flag") == "A", "auto").otherwise("fixed").alias("range_flag"),
            "last_used",
            "used_count",
        )
    )


def cached_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run on the evening before CACHED_BEFORE left behind; its last day was still open."""
    before = readings(spark, sf_dir).where(F.col("d") < F.lit(CACHED_BEFORE))
    return day_manifest(before, F.date_sub(F.lit(CACHED_BEFORE), 1))


def object_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored file per reading's tool and day, some with a bad date or another suffix."""
    name = (
        F.when(F.col("event_type") == "error", F.lit("not-a-date.parquet"))
        .when(F.col("event_type") == "signup", F.concat(F.col("ts").cast("date").cast("string"), F.lit(".tmp")))
        .otherwise(F.concat(F.col("ts").cast("date").cast("string"), F.lit(".parquet")))
    )
    return table(spark, sf_dir, "events").select(
        F.concat_ws("/", F.lit("readings"), F.col("user_id").cast("string"), name).alias("key")
    ).distinct()


def unit_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run log with one unit per tool and window day, times derived from the values."""
    rows = readings(spark, sf_dir)
    units = tools(spark, sf_dir).select(
        "eqp_id", F.explode(F.sequence(F.lit(FIRST_DAY), run_day())).alias("d")
    )
    facts = rows.groupBy("eqp_id", "d").agg(
        F.count("*").alias("_n"),
        F.sum("param_value").alias("_work"),
        F.max("param_value").alias("_top"),
    )
    failed = F.col("_top") > 300
    actual = F.when(failed, 0).otherwise(F.coalesce("_n", F.lit(0)))
    return run_log(
        units.join(facts, ["eqp_id", "d"], "left").select(
            F.col("d").cast("string").alias("timestamp"),
            "eqp_id",
            "d",
            F.when(F.col("_n").isNull(), "empty").when(failed, "failed").otherwise("wrote").alias("status"),
            (F.ceil(F.coalesce("_n", F.lit(0)) / 5) * 5).alias("est_rows"),
            actual.alias("actual_rows"),
            F.coalesce(F.col("_work") / 1000, F.lit(0.0)).alias("fetch_sec"),
            (actual / 100).alias("write_sec"),
            F.when(failed, "fetch").alias("stage"),
            F.when(failed, "value above 300").alias("error"),
        )
    )


def carve_outs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Specs that are excluded by configuration: those that ever had the widest limit."""
    return readings(spark, sf_dir).where("upper_spec >= 199").select("spec_id")


def closed_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days that the cache holds completely."""
    days = readings(spark, sf_dir).select("d").distinct()
    return days.where(day_closed(F.col("d"), F.date_sub(F.lit(CACHED_BEFORE), 1)) == 1)
