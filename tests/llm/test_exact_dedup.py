import hashlib
from collections import defaultdict

import duckdb
import pytest
from llm_cases import SF_DIR, docs_of, odd_documents

from limitlens.llm import exact_dedup, queries

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected(rows, pick=max):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").translate(ASCII)].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = pick((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), i == keep, digest) for i in ids]
    return sorted(map(str, out))


@pytest.mark.parametrize("largest", [True, False])
@pytest.mark.parametrize("arity", [2, 4])
def test_odd_documents(spark, largest, arity):
    df, rows = odd_documents(spark)
    found = exact_dedup.exact_duplicates(df, largest, arity).collect()
    assert sorted(str(tuple(r)) for r in found) == expected(rows, max if largest else min)


def test_no_documents(spark):
    assert exact_dedup.exact_duplicates(docs_of(spark, [])).collect() == []


def test_copies_of_a_third_of_all_rows_over_many_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    rows = [(i, "Hot Text" if i % 3 else f"text {i // 6}") for i in range(3000)]
    found = exact_dedup.exact_duplicates(docs_of(spark, rows).repartition(7)).collect()
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(str(tuple(r)) for r in found) == expected(rows)


def test_equal_digests_of_different_texts_stay_apart(spark):
    entries = spark.createDataFrame(
        [(0, bytearray(b"d" * 32), 5, 1, 7, 1), (0, bytearray(b"d" * 32), 5, 2, 3, 1),
         (0, bytearray(b"d" * 32), 5, 1, 4, 2)], exact_dedup._ENTRY,
    )
    merged = exact_dedup._merge_runs(entries, 3).collect()
    assert sorted((r["proof"], r["first"], r["copies"]) for r in merged) == [(1, 4, 3), (2, 3, 1)]


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF_DIR}/documents.parquet'")
    names = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    wanted = con.execute(f"select {', '.join(names)} from ({queries.ORACLE['op2_exact_dedup']})").fetchall()
    found = queries.QUERIES["op2_exact_dedup"](spark, SF_DIR).select(*names).collect()
    assert sorted(tuple(r) for r in found) == sorted(wanted)
