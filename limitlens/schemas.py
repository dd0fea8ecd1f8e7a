"""Declared schemas. Columns missing from older files read as NULL; nothing is inferred."""

from pyspark.sql import types as T


_TYPES = {
    "STRING": T.StringType(),
    "DOUBLE": T.DoubleType(),
    "BIGINT": T.LongType(),
    "INT": T.IntegerType(),
    "DATE": T.DateType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
    "WIDE": T.DecimalType(38, 0),
}


def _schema(text: str) -> T.StructType:
    """Schema from ``name TYPE, ...`` without needing a session at import time."""
    pairs = [column.split() for column in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


READINGS = _schema(
    "eqp_id STRING, spec_id STRING, param_value DOUBLE, processid STRING, "
    "act_time TIMESTAMP_NTZ, reading_id BIGINT, upper_spec DOUBLE, lower_spec DOUBLE, "
    "root_lot_id STRING, wafer_id STRING, d DATE"
)

# Equal values of a spec and day; ``newest`` orders readings by time and then id.
VALUE_RUNS = _schema(
    "eqp_id STRING, spec_id STRING, param_value DOUBLE, n_values BIGINT, newest WIDE, "
    "upper_spec DOUBLE, lower_spec DOUBLE, d DATE"
)

# Older files name the same facts differently.
READINGS_OLD_NAMES = {
    "create_time": "act_time",
    "sensor_value": "param_value",
    "sensor_name": "param_name",
}

SPEC_CATALOG = _schema(
    "eqp_id STRING, spec_id STRING, pattern STRING, grade STRING, param_id BIGINT, "
    "process_unit STRING, area STRING, model STRING, eqp_name STRING, param_name STRING, "
    "upper_text STRING, lower_text STRING, limit_formula STRING, last_used DATE, "
    "used_count BIGINT, upper_spec DOUBLE, lower_spec DOUBLE, tolerance INT, "
    "script_run_time STRING, type STRING"
)

PARAMETERS = _schema("param_id BIGINT, unit STRING, name STRING, grade STRING")
SPEC_LIMITS = _schema(
    "param_id BIGINT, eqp_id STRING, spec_id STRING, process_unit STRING, upper_text STRING, "
    "lower_text STRING, limit_formula STRING, range_flag STRING, last_used DATE, used_count BIGINT"
)
TOOL_CONFIG = _schema("eqp_id STRING, area STRING, model STRING")
EQUIPMENT_NAMES = _schema("eqp_id STRING, eqp_name STRING")
PATTERN_DEFINITIONS = _schema("param_name STRING, type_code INT")
PATTERN_OVERRIDES = _schema("param_id BIGINT, pattern STRING")
CALENDAR = _schema("ww_start_date DATE, ww_end_date DATE, year_ww STRING")
MANIFEST = _schema(
    "eqp_id STRING, row_count BIGINT, byte_size BIGINT, day_closed INT, d DATE"
)
# What a refresh stores: also a digest of the specs that the tool-day was read for, and one of its rows.
REFRESH_MANIFEST = _schema(
    "eqp_id STRING, row_count BIGINT, byte_size BIGINT, day_closed INT, specs_digest STRING, content_sum WIDE, d DATE"
)
# The specs behind each digest.
SPEC_LEDGER = _schema("eqp_id STRING, specs_digest STRING, spec_id STRING")
RUN_LOG = _schema(
    "timestamp STRING, out_name STRING, eqp_id STRING, d DATE, status STRING, est_rows BIGINT, "
    "actual_rows BIGINT, est_over_actual DOUBLE, nbytes_mb DOUBLE, fetch_sec DOUBLE, "
    "write_sec DOUBLE, total_sec DOUBLE, stage STRING, error STRING, attempt INT"
)
REPORT = _schema(
    "spec_id STRING, eqp_id STRING, pattern STRING, grade STRING, n_points BIGINT, mean DOUBLE, "
    "std DOUBLE, cv DOUBLE, upper_spec DOUBLE, lower_spec DOUBLE, ucl DOUBLE, lcl DOUBLE, "
    "sigma_ratio DOUBLE, relative_ratio DOUBLE, suppress_reason STRING, cww_fail INT, "
    "pww_fail INT, fail INT, days_present BIGINT, days_expected INT, week STRING"
)
