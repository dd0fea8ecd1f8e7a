"""Exact duplicates by a tree of sorted digest runs.

Every document becomes one small entry: SHA-256 of the normalised text, its length, and an
independent 64-bit hash. Entries are dealt into ``arity ** rounds`` runs by document id, so the
copies of one text start spread over all runs. Each run is sorted and collapsed to one entry per
text. In round ``l`` the runs that differ only in digit ``l`` of their number exchange slices: an
entry goes to the run whose digit ``l`` equals digit ``l`` of its digest, and the receiver
merges the sorted slices, keeping the smallest identifier of each text. After the last round a
run's number equals the last digits of its digests: every text lies in exactly one run, and no run ever
held more than one entry per text and sender. With ``arity=2`` the rounds are the binomial ones.

The answers go back by the run an entry came from, so a text that a third of all documents
share is one row per run on the way and each run's share of it at the end.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from limitlens.llm.tables import keep, partitions_of, text_bytes

# A text is identified by all three; equal digests with another length or hash stay apart.
IDENTITY = ["digest", "n_bytes", "proof"]
_NO_ID = (1 << 63) - 1
_ENTRY = "run long, digest binary, n_bytes long, proof long, first long, copies long"


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests, lengths, proofs = [], [], []
        for value in batch.column("text"):
            text = value.as_py().lower()  # bytes.lower() changes A-Z only
            digests.append(hashlib.sha256(text).digest())
            lengths.append(len(text))
            proofs.append(xxhash.xxh3_64_intdigest(text) - (1 << 63))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(digests, pa.binary()), pa.array(lengths, pa.int64()),
             pa.array(proofs, pa.int64())],
            ["doc_id", "digest", "n_bytes", "proof"],
        )


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    raw = b"".join(batch.column("digest").to_pylist())
    words = np.frombuffer(raw, np.uint64).reshape(-1, 4)
    names = ("run", "n_bytes", "proof", "first", "copies")
    return (words, *[batch.column(n).to_numpy(zero_copy_only=False) for n in names])


def _merge_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Collapse neighbours of the sorted stream; the last text of a batch waits for the next batch."""
    waiting: list[np.ndarray] | None = None

    def out(parts: list[np.ndarray]) -> pa.RecordBatch:
        words, run, n_bytes, proof, first, copies = parts
        raw = np.ascontiguousarray(words).tobytes()
        digests = [raw[i : i + 32] for i in range(0, len(raw), 32)]
        return pa.RecordBatch.from_arrays(
            [pa.array(run, pa.int64()), pa.array(digests, pa.binary()), *[
                pa.array(x, pa.int64()) for x in (n_bytes, proof, first, copies)]],
            ["run", *IDENTITY, "first", "copies"],
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        parts = list(_columns(batch))
        if waiting is not None:
            parts = [np.concatenate([w, p]) for w, p in zip(waiting, parts, strict=True)]
        words, run, n_bytes, proof, first, copies = parts
        new = np.ones(len(run), bool)
        new[1:] = (
            (words[1:] != words[:-1]).any(1) | (run[1:] != run[:-1])
            | (n_bytes[1:] != n_bytes[:-1]) | (proof[1:] != proof[:-1])
        )
        starts = np.flatnonzero(new)
        merged = [words[starts], run[starts], n_bytes[starts], proof[starts],
                  np.minimum.reduceat(first, starts), np.add.reduceat(copies, starts)]
        waiting = [x[-1:] for x in merged]
        if len(starts) > 1:
            yield out([x[:-1] for x in merged])
    if waiting is not None:
        yield out(waiting)


def _merge_runs(entries: DataFrame, partitions: int) -> DataFrame:
    """One merge of every run: its slices meet in one task, sorted by digest (the sort spills)."""
    return (
        entries.repartition(partitions, "run")
        .sortWithinPartitions("run", *IDENTITY, "first")
        .mapInArrow(_merge_sorted, _ENTRY)
    )


def exact_duplicates(docs: DataFrame, largest: bool = True, arity: int = 4) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; null counts as empty, so all null
    and empty texts are one group. The document with the largest id stays (``largest=False``:
    the smallest). Rows that repeat a doc_id count as copies and share its fate; a row without
    doc_id stays only if no copy has one. No documents give no rows. Other columns are ignored.
    """
    partitions = partitions_of(docs)
    rounds, runs = 1, arity
    while runs < partitions:
        rounds, runs = rounds + 1, runs * arity
    rows = (
        docs.select(F.col("doc_id").cast("long"), text_bytes().alias("text"))
        .mapInArrow(_digests, "doc_id long, digest binary, n_bytes long, proof long")
        .withColumn("run", F.pmod(F.xxhash64("doc_id"), F.lit(runs)))
    )
    rows = keep(rows, "digests")

    order = F.bitwise_not("doc_id") if largest else F.col("doc_id")
    entries = rows.select(
        "run", *IDENTITY, F.coalesce(order, F.lit(_NO_ID)).alias("first"), F.lit(1).cast("long").alias("copies")
    )
    leaves = keep(_merge_runs(entries, partitions), "leaf-runs")

    merged = leaves
    tail = F.conv(F.hex(F.substring("digest", 29, 4)), 16, 10).cast("long")
    for level in range(rounds):
        unit = arity**level
        mine = F.pmod(F.floor(F.col("run") / unit), F.lit(arity))
        wanted = F.pmod(F.floor(tail / unit), F.lit(arity))
        merged = _merge_runs(merged.withColumn("run", F.col("run") + (wanted - mine) * unit), partitions)

    winners = merged.select(*IDENTITY, "first", F.col("copies").alias("group_size"))
    answers = leaves.select("run", *IDENTITY).join(winners, IDENTITY)
    keep_key = F.when(F.col("first") != _NO_ID, F.col("first"))
    keep_id = F.bitwise_not(keep_key) if largest else keep_key
    return rows.join(answers, ["run", *IDENTITY]).select(
        "doc_id",
        keep_id.alias("keep_id"),
        "group_size",
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
