"""Scores against plain dictionaries of exact counts, and the filter against the counts it holds."""

import math
from collections import Counter
from zlib import crc32

import duckdb
import numpy as np
import pytest
from llm_cases import SF_DIR, docs_of, odd_documents

from limitlens.llm import language_model as lm
from limitlens.llm.language_model import LogFrequencyFilter, language_scores

WIDE = 600  # bits an entry: no chance hit is to be expected, so scores equal those of exact counts


def scores_of(rows, folds=10):
    held = [i is None or crc32(str(i).encode()) % folds == 0 for i, _ in rows]
    texts = [(t or "").encode().lower().split() for _, t in rows]
    words, pairs, docs = Counter(), Counter(), 0
    for out, text in zip(held, texts, strict=True):
        if not out:
            words.update([*text, None])
            pairs.update(zip(["start", *text], [*text, None], strict=True))
            docs += 1
    train, room = sum(words.values()), sum(words.values()) + 0.1 * (len(words) + 1)

    def rounded(count):
        return float(lm.typical(lm.level_of(np.array([count])))[0])

    found = []
    for (doc_id, _), out, text in zip(rows, held, texts, strict=True):
        known, base, score = 0, 0.0, 0.0
        for before, word in zip(["start", *text], [*text, None], strict=True):
            known += words[word] > 0
            base += math.log10((words[word] + 0.1) / room)
            seen = rounded(docs if before == "start" else words[before])
            alone = (rounded(words[word]) + 0.1) / room
            score += math.log10((min(rounded(pairs[before, word]), seen) + lm.PRIOR * alone) / (seen + lm.PRIOR))
        found.append((doc_id, out, len(text) + 1, known, train, base, score))
    return found


def compare(found, rows):
    key = lambda r: (str(r[0]), r[2], r[5])
    found, want = sorted(map(tuple, found), key=key), sorted(scores_of(rows), key=key)
    assert len(found) == len(want)
    for mine, theirs in zip(found, want, strict=True):
        assert mine[:5] == theirs[:5]
        assert mine[5:] == pytest.approx(theirs[5:], rel=1e-9, abs=1e-9)


SHAPES = [
    {},  # one block a task, one segment, the filter broadcast
    {"block_tokens": 3000, "segment_ngrams": 5000},  # many blocks and segments
    {"block_tokens": 3000, "segment_ngrams": 5000, "broadcast_bytes": 0},  # the filter stays with its segments
]


@pytest.mark.parametrize("shape", SHAPES)
def test_scores_of_the_documents(spark, shape):
    rows = duckdb.connect().execute(f"select doc_id, text from '{SF_DIR}/documents.parquet'").fetchall()
    frame = spark.read.parquet(f"{SF_DIR}/documents.parquet").repartition(3)
    compare(language_scores(frame, bits=WIDE, **shape).collect(), rows)


@pytest.mark.parametrize("shape", SHAPES)
def test_odd_documents(spark, shape):
    frame, rows = odd_documents(spark)
    compare(language_scores(frame, bits=WIDE, **shape).collect(), rows)


def test_a_third_of_all_rows_alike(spark):
    rows = [(i, "hot hot hot pair" if i % 3 == 0 else f"text {i} of its own") for i in range(900)]
    compare(language_scores(docs_of(spark, rows).repartition(5), bits=WIDE, **SHAPES[2]).collect(), rows)


@pytest.mark.parametrize("broadcast", [0, 1 << 20])
def test_without_training_documents(spark, broadcast):
    assert language_scores(docs_of(spark, [])).count() == 0
    rows = [(None, "no id"), (None, None)]
    compare(language_scores(docs_of(spark, rows), broadcast_bytes=broadcast).collect(), rows)


def test_more_chance_hits_never_lower_a_count():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 48, 30_000, dtype=np.uint64))
    counts = rng.integers(0, 40, len(keys)) ** 3
    levels = lm.level_of(counts)
    assert (levels <= counts).all()
    found = LogFrequencyFilter.of(keys, counts).levels(keys)
    assert (found >= levels).all()
    assert (found > levels).mean() < 0.01
    assert LogFrequencyFilter.of(keys[:0], counts[:0]).levels(keys).max() == 0


def test_keys_come_back():
    rng = np.random.default_rng(2)
    for size in (0, 1, 5, 70_000):
        keys = np.unique(rng.integers(0, 1 << 48, size, dtype=np.uint64))
        assert (lm._unpacked(lm._packed(keys)) == keys).all()
        own = lm.segment_of(keys, 77)
        assert (np.diff(own) >= 0).all() and (not size or own.max() < 77)
