"""Vector codes against a full search in plain numpy, and the tree against every distance."""

import math
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from limitlens.llm.vector_codes import ENTRIES, PARTS, ROUNDS, EntryTree, _squares, vector_codes


def codes_of(rows):
    """Rows (vec_id, vector, label) to the result, by comparing every part with every entry."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    if not kept:
        return []
    longest = max(len(r[1]) for r in kept)
    width = -(-longest // PARTS) * PARTS
    whole = np.zeros((len(kept), width), np.int64)
    for row, (_, v, _) in zip(whole, kept, strict=True):
        row[: len(v)] = [math.floor(1024 * x) for x in v]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, whole[i].tolist()))
    step = width // PARTS
    parts = [whole[:, p * step : (p + 1) * step] for p in range(PARTS)]
    books = [part[order[:ENTRIES]].copy() for part in parts]

    def nearest(part, book):
        squares = ((part[:, None, :] - book[None]) ** 2).sum(2)
        return squares.argmin(1), squares.min(1)

    for _ in range(ROUNDS):
        for part, book in zip(parts, books, strict=True):
            code, _ = nearest(part, book)
            for entry in set(code.tolist()):
                book[entry] = part[code == entry].sum(0) // (code == entry).sum()
    found = [nearest(part, book) for part, book in zip(parts, books, strict=True)]
    error = sum(f[1] for f in found).tolist()
    by_label = defaultdict(int)
    for (_, _, label), e in zip(kept, error, strict=True):
        by_label[label] += e
    digest = sha256(",".join(str(x) for b in books for e in b.tolist() for x in e).encode()).hexdigest()
    return [
        (r[0], "".join(f"{f[0][i]:02x}" for f in found), error[i], by_label[r[2]], digest) for i, r in enumerate(kept)
    ]


@given(st.integers(0, 2**32 - 1), st.integers(1, 256), st.integers(1, 20), st.sampled_from([1, 3, 1000, 1 << 26]))
@settings(max_examples=60, deadline=None)
def test_the_tree_answers_as_a_full_search(seed, entries, width, size):
    rng = np.random.default_rng(seed)
    book, queries = rng.integers(-size, size + 1, (entries, width)), rng.integers(-size, size + 1, (100, width))
    queries[: min(entries, 30)] = book[:30][: len(queries)]
    index, squares = EntryTree(book).nearest(queries)
    every = _squares(queries, book)
    assert (every == ((queries[:, None, :] - book[None]) ** 2).sum(2)).all()
    assert (index == every.argmin(1)).all() and (squares == every.min(1)).all()


def test_the_tree_leaves_out_what_cannot_win():
    rng = np.random.default_rng(3)
    book = (rng.integers(0, 9, (256, 1)) * 4000 + rng.integers(0, 50, (256, 4))).astype(np.int64)
    tree = EntryTree(book)
    queries = book[rng.integers(0, 256, 500)] + rng.integers(-20, 21, (500, 4))
    index, _ = tree.nearest(queries)
    assert (index == _squares(queries, book).argmin(1)).all()
    assert tree.compared < 0.5 * 500 * len(book)


def test_too_large_components_are_an_error():
    with pytest.raises(OverflowError):
        EntryTree(np.array([[1 << 40]])).nearest(np.array([[0]]))


SCHEMA = "vec_id long, embedding array<float>, label int, code string, v int, _share string, `_label` int"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], SCHEMA).repartition(3)


def compare(spark, rows):
    found = [tuple(r) for r in vector_codes(frame(spark, rows)).collect()]
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(found, key=key) == sorted(codes_of(rows), key=key)


def test_codes_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(0, 0.2, (600, 10)).astype(np.float32)
    vectors[::3] = vectors[0]  # one vector holds a third of the rows
    rows = [(i // 2, v.tolist(), None if i % 7 == 0 else int(i % 3 == 0)) for i, v in enumerate(vectors)]
    compare(spark, rows)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, None, 1), (2, [1.0, None], 1), (3, [nan, 1.0], 1), (4, [inf, 0.0], 2), (5, [-inf], None),
        (6, [], None), (7, [0.5], 1), (7, [0.5], 1), (None, [0.25, -0.001, 3.0], None), (8, [0.1] * 5, 3), (-2, [-0.0001] * 4, None),
    ]
    compare(spark, rows)


def test_tables_without_vectors(spark):
    assert vector_codes(frame(spark, [])).count() == 0
    assert vector_codes(frame(spark, [(1, None, None)])).count() == 0
    compare(spark, [(1, [], 1), (2, [], 1)])
