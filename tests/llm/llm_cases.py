"""Shared inputs: the small documents table and frames with every odd case."""

import duckdb

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, kept string"


def texts_of(sf_dir, name="documents", columns="doc_id, text"):
    return duckdb.connect().execute(f"select {columns} from '{sf_dir}/{name}.parquet'").fetchall()


def docs_of(spark, rows):
    """A documents frame whose extra columns clash with result names."""
    return spark.createDataFrame(
        [(i, t, "en", None, None, 0.5, "x") for i, t in rows],
        SCHEMA,
    )


def odd_rows():
    long_text = " ".join(f"word{i % 977} and{i % 13}," for i in range(30_000))
    return [
        (1, None), (2, ""), (3, "One text. Two texts."), (4, "one TEXT. two texts."), (5, long_text),
        (6, long_text), (7, " \n\t "), (8, "é É ß 漢字 😀"), (9, "x" * 20_000), (9, "x" * 20_000),
        (10, "same id"), (10, "another text"), (None, "no id"), (None, None), (11, "a"), (-4, "negative id"),
    ]


def odd_documents(spark):
    rows = odd_rows()
    return docs_of(spark, rows).repartition(5), rows
