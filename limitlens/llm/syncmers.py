"""Document fingerprints from closed syncmers.

A k-mer is selected when the smallest hash among its inner s-mers is that of its first or
last one. The choice depends on the k-mer alone, so an edit changes only the k-mers it touches
and every other anchor stays, with its position moved as a whole. A fingerprint is the set of the
smallest hashes of a text's anchors.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from limitlens.llm.tables import partitions_of, whole_text

K, S = 20, 8
KEPT = 64
# Ranges of ids; a range is sorted and streamed, never held.
MAX_RANGES = 4096
_HEX = 12
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def _power(n: int) -> np.uint64:
    return np.uint64(pow(_BASE, n, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return x


def _rolling(codes: np.ndarray, length: int) -> np.ndarray:
    """Polynomial hashes of all substrings of ``length``, by doubling."""
    have, width, out, done = codes, 1, None, 0
    while True:
        if length & width:
            out = have if out is None else out[: len(out) - width] * _power(width) + have[done : done + len(out) - width]
            done += width
        if done == length:
            return out
        have = have[:-width] * _power(width) + have[width:]
        width *= 2


def _smallest(values: np.ndarray, window: int) -> np.ndarray:
    have, width = values, 1
    while 2 * width <= window:
        have = np.minimum(have[:-width], have[width:])
        width *= 2
    rest = window - width
    return np.minimum(have[: len(have) - rest], have[rest:]) if rest else have


def anchors_of(text: str, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of a text's closed syncmers, by code points."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    if len(codes) < k:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    inner = _mix(_rolling(codes, s))
    window = k - s + 1
    least = _smallest(inner, window)
    places = np.flatnonzero((least == inner[: len(least)]) | (least == inner[window - 1 :]))
    hashes = np.zeros(len(places), np.uint64)
    for j in range(k):
        hashes = hashes * np.uint64(_BASE) + codes[places + j]
    return places, _mix(hashes)


def sketch_of(text: str) -> np.ndarray:
    """The smallest distinct anchor hashes; a text without anchors is one hash of itself."""
    if not text:
        return np.zeros(0, np.uint64)
    _, hashes = anchors_of(text)
    if not len(hashes):
        digest = sha256(text.encode("utf-8", "surrogatepass")).digest()
        hashes = np.frombuffer(digest[:8], "<u8")
    hashes = hashes >> np.uint64(64 - 4 * _HEX)
    if len(hashes) > 8 * KEPT:
        # The smallest distinct values lie below a rank that leaves room for repeats; else sort all.
        part = np.unique(np.partition(hashes, 4 * KEPT)[: 4 * KEPT])
        if len(part) >= KEPT:
            return part[:KEPT]
    return np.unique(hashes)[:KEPT]


def fingerprint_of(sketch: np.ndarray) -> str:
    return "".join(f"{v:0{_HEX}x}" for v in sketch.tolist())


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of common anchors: over the smallest values of the union."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = np.union1d(a, b)[:KEPT]
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(union, both, assume_unique=True).sum() / len(union))


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
            places, hashes = anchors_of(text.as_py())
            yield pa.RecordBatch.from_arrays(
                [pa.array([doc_id.as_py()] * len(places), pa.int64()), pa.array(places, pa.int64()),
                 pa.array(hashes.view(np.int64))],
                ["doc_id", "position", "anchor"],
            )


def anchors(docs: DataFrame) -> DataFrame:
    """One row per anchor: doc_id, position, anchor (hash). Equal anchors of two texts are
    matches, and runs of them with one difference of positions are shared passages."""
    rows = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    return rows.mapInArrow(_anchor_rows, "doc_id long, position long, anchor long")


_RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by bucket in chain order; guests (the next bucket's first row) end a bucket."""
    before: tuple[int, int | None, str, np.ndarray] | None = None
    out: list[tuple] = []

    def flush() -> pa.RecordBatch:
        kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
        names, types = zip(*[p.split() for p in _RESULT.split(", ")], strict=True)
        columns = zip(*out, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, kinds[t]) for c, t in zip(columns, types, strict=True)], list(names)
        )

    for batch in batches:
        names = ("_bucket", "_guest", "doc_id", "text")
        for bucket, guest, doc_id, text in zip(*map(batch.column, names), strict=True):
            bucket, guest, doc_id, text = bucket.as_py(), guest.as_py(), doc_id.as_py(), text.as_py()
            if guest and (before is None or before[0] != bucket):
                continue  # another guest row of a repeated id
            sketch = sketch_of(text)
            if before is not None and before[0] == bucket:
                _, name, own, mine = before
                third = len(own) // 3
                edited = own[: len(own) - third] + text[:third]
                theirs = sketch_of(edited)
                out.append((
                    name, len(own), sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                    fingerprint_of(mine), fingerprint_of(theirs), likeness(mine, theirs), likeness(mine, sketch),
                ))
            before = None if guest else (bucket, doc_id, text, sketch)
        if out:
            yield flush()
            out = []


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and their likeness.

    The edited text ends in the next document's beginning; documents follow each other by
    descending doc_id and the last is followed by the first. Null text counts as empty: its
    fingerprint is empty, and empty fingerprints are alike (1.0). Repeated ids follow each other
    by text, rows without id come last. A single document is its own next one; none give no rows.

    Ids are cut into ranges at approximate quantiles, so no task holds more than a share; the
    first row of the following range visits each range as its last row's neighbour. Only one id per
    range goes through the driver.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    partitions = partitions_of(docs)
    steps = min(4 * partitions, MAX_RANGES)
    cuts = rows.agg(
        F.percentile_approx("doc_id", [i / steps for i in range(1, steps)], F.lit(10 * steps)).alias("c")
    ).first()["c"]
    cuts = sorted(set(cuts or []), reverse=True)
    # Buckets by falling id: 0 holds the largest; rows without id are last.
    listed = F.array(*[F.lit(c) for c in reversed(cuts)]) if cuts else F.array().cast("array<long>")
    bucket = F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1)).otherwise(
        F.lit(len(cuts)) - F.size(F.filter(listed, lambda c: c <= F.col("doc_id")))
    )
    rows = rows.withColumn("_bucket", bucket)
    heads = sorted(tuple(r) for r in rows.groupBy("_bucket").agg(F.max("doc_id")).collect())
    visits = [(head, heads[i - 1][0]) for i, (_, head) in enumerate(heads)]
    guests = spark.createDataFrame(visits, "_head long, _to int")
    visiting = rows.join(F.broadcast(guests), F.col("doc_id").eqNullSafe(F.col("_head")))
    chain = rows.select("_bucket", F.lit(False).alias("_guest"), "doc_id", "text").unionByName(
        visiting.select(F.col("_to").alias("_bucket"), F.lit(True).alias("_guest"), "doc_id", "text")
    )
    return (
        chain.repartition(partitions, "_bucket")
        .sortWithinPartitions("_bucket", "_guest", F.col("doc_id").desc_nulls_last(), "text")
        .mapInArrow(_with_next, _RESULT)
    )
