"""Quality: logistic regression over hashed word n-grams, learned by following the regularised leader.

A text is read as two streams: its words, and their shapes (case, digits, symbols, sentence
ends, whether a word repeats the one before). Unigrams and bigrams of words and unigrams to
trigrams of shapes are hashed into one weight vector. Scoring is a sparse dot product.

Learning is FTRL-proximal with per-coordinate rates. A bounded sample of labelled rows is dealt
into a fixed number of shards; each shard makes a pass in one task, and after every pass the shards'
states are averaged (parameter mixing).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from limitlens.llm.tables import held_out, whole_text
from limitlens.llm.toxicity import training_sample

MAX_TRAINING_ROWS = 20_000
BITS = 18
SHARDS, PASSES = 4, 3
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.02, 0.05
CACHED = 400_000
_BIAS = 0
_ENDS = ".,;:!?"


def _shape(word: str) -> int:
    core = word.rstrip(_ENDS)
    bits = 0
    bits |= 1 * (core[:1].isupper() and not core.isupper())
    bits |= 2 * (len(core) > 1 and core.isupper())
    bits |= 4 * any(c.isdigit() for c in core)
    bits |= 8 * (bool(core) and not core.replace("'", "").isalnum())
    bits |= 16 * (len(core) < len(word))
    bits |= 32 * (not any(c.isalnum() for c in word))
    bits |= 64 * (len(core) > 14)
    bits |= 128 * (len(word) - len(core) > 1)
    return bits


class _Words(dict):
    """word -> hash with its shape in the low eight bits."""

    def __missing__(self, word: str) -> int:
        value = (xxhash.xxh3_64_intdigest(word.lower().encode("utf-8", "surrogatepass")) >> 9 << 8) | _shape(word)
        if len(self) < CACHED:
            self[word] = value
        return value


WORDS = _Words()


def _slots(values: np.ndarray, salt: int) -> np.ndarray:
    x = (values + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    return (x >> np.uint64(64 - BITS)).astype(np.int64)


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Slots and values: word n-grams by presence, shape n-grams by share; the bias is slot 0."""
    words = text.split()
    if not words:
        return np.asarray([_BIAS]), np.asarray([1.0])
    coded = np.fromiter(map(WORDS.__getitem__, words), np.uint64, len(words))
    same = np.zeros(len(words), np.uint64)
    same[1:] = (coded[1:] == coded[:-1]).astype(np.uint64)
    word, shape = coded >> np.uint64(8), (coded & np.uint64(255)) | (same << np.uint64(8))
    grams = np.unique(np.concatenate([
        _slots(word, 1), _slots(word[:-1] * np.uint64(31) ^ word[1:], 2),
    ]))
    two = shape[:-1] * np.uint64(512) + shape[1:]
    three = two[:-1] * np.uint64(512) + shape[2:]
    shapes, counts = np.unique(
        np.concatenate([_slots(shape, 3), _slots(two, 4), _slots(three, 5)]), return_counts=True
    )
    slots = np.concatenate([[_BIAS], grams, shapes])
    values = np.concatenate([
        [1.0], np.full(len(grams), 1.0 / np.sqrt(len(grams))), np.sqrt(counts / len(words)),
    ])
    return slots, values


def weights_of(z: np.ndarray, n: np.ndarray) -> np.ndarray:
    w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
    w[np.abs(z) <= L1] = 0.0
    return w


def _probability(x: float) -> float:
    return float(1.0 / (1.0 + np.exp(-min(35.0, max(-35.0, x)))))


def _pass_over(z0: bytes | None, n0: bytes | None):
    """One pass of a shard's rows in the order of their ids; gives the shard's state."""

    def run(group: pa.Table) -> pa.Table:
        size = 1 << BITS
        z = np.zeros(size) if z0 is None else np.frombuffer(z0).copy()
        n = np.zeros(size) if n0 is None else np.frombuffer(n0).copy()
        group = group.sort_by([("order", "ascending"), ("doc_id", "ascending")])
        for text, label in zip(group["text"], group["label"], strict=True):
            slots, values = features(text.as_py())
            zi, ni = z[slots], n[slots]
            w = weights_of(zi, ni)
            gradient = (_probability(float(w @ values)) - label.as_py()) * values
            squared = gradient * gradient
            step = (np.sqrt(ni + squared) - np.sqrt(ni)) / ALPHA
            # A slot that two n-grams share takes both updates.
            np.add.at(z, slots, gradient - step * w)
            np.add.at(n, slots, squared)
        return pa.table({"rows": pa.array([group.num_rows], pa.int64()),
                         "z": pa.array([z.tobytes()], pa.binary()), "n": pa.array([n.tobytes()], pa.binary())})

    return run


def learn(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAINING_ROWS) -> np.ndarray:
    """The weight vector. Shards and slots are fixed, so what the driver gathers is too."""
    sample = training_sample(docs, labels, "quality", most)
    order = F.xxhash64("doc_id", F.lit(3))
    dealt = sample.select(
        "doc_id", "text", "label", order.alias("order"), F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(SHARDS)).alias("shard")
    )
    z = n = None
    for _ in range(PASSES):
        states = dealt.groupBy("shard").applyInArrow(_pass_over(z, n), "rows long, z binary, n binary").collect()
        if not states:
            return np.zeros(1 << BITS)
        rows = np.asarray([s["rows"] for s in states], float)
        share = (rows / rows.sum())[:, None]
        z = (np.stack([np.frombuffer(s["z"]) for s in states]) * share).sum(0).tobytes()
        n = (np.stack([np.frombuffer(s["n"]) for s in states]) * share).sum(0).tobytes()
    return weights_of(np.frombuffer(z), np.frombuffer(n))


def _scores(weights: np.ndarray):
    packed = weights.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = []
            for text in batch.column("_text"):
                slots, values = features(text.as_py())
                scores.append(_probability(float(packed[slots] @ values)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "score"],
            )

    return run


def quality(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAINING_ROWS, threshold: float = 0.3) -> DataFrame:
    """One row per document: doc_id, held_out, score (1: good), predicted (score >= ``threshold``).

    Null text counts as empty and is scored by the bias alone. Without usable labels every score is 0.5. Rows are scored alone, so repeated rows
    get equal scores; a row without doc_id counts as held out. No documents give no rows.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), whole_text().alias("_text")
    )
    scored = rows.mapInArrow(_scores(learn(docs, labels, most)), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
