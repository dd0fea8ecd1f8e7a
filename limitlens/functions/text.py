"""Text parsing and formatting with native string functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: size text as a query planner prints it, e.g. "Output:12 rows(3.5kB)".
SIZE_TEXT = r"^Output:(\d+)\s*rows?\(([\d.]+)([a-zA-Z]+)\)"


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def key_date(key: Column) -> Column:
    """Date of ``.../tool/date.parquet``; NULL for other files and for bad dates."""
    stem = F.regexp_extract(file_name(key), r"^(\d{4}-\d{1,2}-\d{1,2})\.parquet$", 1)
    return F.try_to_date(F.nullif(stem, F.lit("")), "yyyy-M-d")


def key_tool(key: Column) -> Column:
    """Folder above the file name; NULL when there is none."""
    return F.get(F.reverse(F.split(key, "/")), F.lit(1))


def chunk_tool(path: Column) -> Column:
    """Tool id of a chunk file: the file name up to its first underscore."""
    return F.substring_index(file_name(path), "_", 1)


def clean_name(path: Column) -> Column:
    """File name without folder and without any extension."""
    return F.substring_index(file_name(path), ".", 1)


def parse_size_text(df: DataFrame, column: str) -> DataFrame:
    """Split size text into rows, size and unit; text of another form is dropped."""
    text = F.col(column)
    return df.where(text.rlike(SIZE_TEXT)).select(
        *df.columns,
        F.regexp_extract(text, SIZE_TEXT, 1).cast("bigint").alias("rows"),
        F.regexp_extract(text, SIZE_TEXT, 2).try_cast("double").alias("size_value"),
        F.regexp_extract(text, SIZE_TEXT, 3).alias("size_unit"),
    )


def quoted_list(values: Column) -> Column:
    """``['a','b']`` to the text ``'a','b'``."""
    return F.concat_ws(",", F.transform(values, lambda v: F.concat(F.lit("'"), v, F.lit("'"))))


def integer_list(values: Column) -> Column:
    """``[1.0, 2.7]`` to the text ``1,2`` (fractions cut off)."""
    return F.concat_ws(",", F.transform(values, lambda v: v.cast("bigint").cast("string")))


def canonical_name(name: Column) -> Column:
    """Upper case, runs of other characters as one underscore, none at the ends."""
    joined = F.regexp_replace(F.upper(name), r"[^A-Z0-9]+", "_")
    return F.regexp_replace(joined, r"^_|_$", "")
