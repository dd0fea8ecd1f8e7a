"""Vectors as short codes: one codebook per part, searched by a geometric near-neighbour tree.

Components become integers, a vector is cut into equal parts, and a codebook of each part position
is improved over a few rounds. The nearest entry of a part is found in a tree over the entries: a tree node has
split points, every other entry hangs below its nearest one, and for each (split point, child) the node keeps the
range of distances from the split point to what the child holds. A query's distance to a split point then
rules out whole children: those that its best distance so far cannot reach. Ranges and roots are
rounded outwards and a child goes only if it is strictly out of reach; what is left is compared by
integer squared distances, ties to the lower index, so the answer is that of a full search.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from limitlens.llm.tables import answer_groups, keep, partitions_of

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
# Split points of a tree node; nodes with fewer entries than twice that are leaves.
DEGREE = 16


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of all rows of two integer matrices."""
    most = max((int(np.abs(m).max(initial=0)) for m in (a, b)), default=0)
    bound = 4 * max(1, a.shape[1]) * most * most
    if bound >= 1 << 63:
        raise OverflowError("components are too large for distances of 64 bits")
    if bound < 1 << 53:  # every intermediate value is a whole number that a double holds
        a, b = a.astype(np.float64), b.astype(np.float64)
    found = (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]
    return found.astype(np.int64)


# Wider than the rounding of a root and of one sum together.
_WIDER = 1 + 2.0**-40


def _down(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64)) / _WIDER


def _up(squares: np.ndarray) -> np.ndarray:
    return np.sqrt(squares.astype(np.float64)) * _WIDER


class EntryTree:
    """A geometric near-neighbour access tree over the rows of ``entries``."""

    def __init__(self, entries: np.ndarray):
        self.entries = np.asarray(entries, np.int64)
        # Of equal entries only the lowest index can be an answer.
        _, first = np.unique(self.entries, axis=0, return_index=True)
        self.root = self._node(np.sort(first))
        self.compared = 0

    def _node(self, members: np.ndarray):
        if len(members) < 2 * DEGREE:
            return members, None, None, None
        points = self.entries[members]
        # Far-apart split points: each is the member farthest from those before it.
        chosen, least = [0], _squares(points, points[:1])[:, 0]
        while len(chosen) < DEGREE:
            chosen.append(int(least.argmax()))
            least = np.minimum(least, _squares(points, points[chosen[-1:]])[:, 0])
        to_splits = _squares(points, points[chosen])
        owner = to_splits.argmin(1)
        owner[chosen] = -1
        children, near, far = [], np.zeros((DEGREE, DEGREE)), np.full((DEGREE, DEGREE), -1.0)
        for j in range(DEGREE):
            below = np.flatnonzero(owner == j)
            children.append(self._node(members[below]) if len(below) else None)
            if len(below):
                near[:, j], far[:, j] = _down(to_splits[below].min(0)), _up(to_splits[below].max(0))
        return members[chosen], children, near, far

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry of each query; ties to the lower index."""
        best = np.full(len(queries), np.iinfo(np.int64).max)
        index = np.full(len(queries), len(self.entries), np.int64)
        if len(queries):
            self._visit(self.root, np.asarray(queries, np.int64), np.arange(len(queries)), best, index)
        return index, best

    def _visit(self, node, queries, rows, best, index) -> None:
        points, children, near, far = node
        order = np.argsort(points)
        squares = _squares(queries[rows], self.entries[points])
        self.compared += squares.size
        at = squares[:, order].argmin(1)
        found, entry = squares[:, order][np.arange(len(rows)), at], points[order][at]
        better = (found < best[rows]) | ((found == best[rows]) & (entry < index[rows]))
        best[rows[better]], index[rows[better]] = found[better], entry[better]
        if children is None:
            return
        closest, low, high = squares.argmin(1), _down(squares), _up(squares)
        for own in (True, False):  # the child of the closest split point first: it shortens the reach
            for j, child in enumerate(children):
                if child is None:
                    continue
                some = np.flatnonzero((closest == j) == own)
                if not own and len(some):
                    reach = _up(best[rows[some]])[:, None]
                    out = (low[some] > far[:, j] + reach) | (near[:, j] > high[some] + reach)
                    some = some[~out.any(1)]
                if len(some):
                    self._visit(child, queries, rows[some], best, index)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of integer lists, filled up with zeros to ``width``."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    sizes = np.diff(column.offsets.to_numpy())
    if (sizes == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width), np.int64)
    row = np.repeat(np.arange(len(column)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _sums(books: list[np.ndarray], width: int):
    """Per task one row for each used entry: how many parts it is nearest to, and their sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, step = [EntryTree(b) for b in books], width // len(books)
        counts = [np.zeros(len(b), np.int64) for b in books]
        sums = [np.zeros(b.shape, np.int64) for b in books]
        for batch in batches:
            rows = _matrix(batch.column("v"), width)
            for p, tree in enumerate(trees):
                part = rows[:, p * step : (p + 1) * step]
                code, _ = tree.nearest(part)
                order = np.argsort(code, kind="stable")
                used, start = np.unique(code[order], return_index=True)
                if len(used):
                    sums[p][used] += np.add.reduceat(part[order], start, axis=0) if step else 0
                    counts[p] += np.bincount(code, minlength=len(counts[p]))
        for p in range(len(books)):
            used = np.flatnonzero(counts[p])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(used), p, np.int32)), pa.array(used.astype(np.int32)), pa.array(counts[p][used]),
                 pa.array(sums[p][used].tolist(), pa.list_(pa.int64()))],
                ["part", "entry", "n", "sums"],
            )

    return run


def _improved(vectors: DataFrame, books: list[np.ndarray], width: int) -> list[np.ndarray]:
    step = width // len(books)
    partial = vectors.select("v").mapInArrow(_sums(books, width), "part int, entry int, n long, sums array<long>")
    wide = lambda c: F.sum(c.cast("decimal(38,0)"))
    total = partial.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), F.array(*[wide(F.col("sums")[i]) for i in range(step)]).alias("sums")
    )
    out = [b.copy() for b in books]
    for row in total.collect():  # at most one row per entry of a codebook
        out[row.part][row.entry] = [int(s) // row.n for s in row.sums]
    return out


def _coded(books: list[np.ndarray], width: int, shares: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, step, seen = [EntryTree(b) for b in books], width // len(books), 0
        for batch in batches:
            rows = _matrix(batch.column("v"), width)
            found = [t.nearest(rows[:, p * step : (p + 1) * step]) for p, t in enumerate(trees)]
            code = np.stack([f[0] for f in found], 1).astype(np.uint8) if len(rows) else np.zeros((0, len(books)), np.uint8)
            share = (np.arange(seen, seen + len(rows)) + int(code[:1].sum())) % shares
            seen += len(rows)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("_label"), pa.array([bytes(c).hex() for c in code], pa.string()),
                 pa.array(sum(f[1] for f in found)), pa.array(share.astype(np.int64))],
                ["vec_id", "_label", "code", "error", "_share"],
            )

    return run


def whole_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, label and the components as integers; vectors that are null or hold null, NaN or infinity are dropped."""
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    floats = F.col("embedding").cast("array<double>")
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", floats.alias("_e")).where(
        F.col("_e").isNotNull() & F.coalesce(F.forall("_e", sound), F.lit(False))
    ).select("vec_id", "label", F.transform("_e", lambda x: F.floor(x * SCALE)).alias("v"))


def fit(vectors: DataFrame, width: int, rounds: int = ROUNDS) -> list[np.ndarray]:
    """Codebooks of :func:`whole_vectors` rows. What travels is one row per entry and task."""
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(ENTRIES).select("v").collect()
    start = np.zeros((len(first), width), np.int64)
    for row, values in zip(start, first, strict=True):
        row[: len(values.v)] = values.v
    books = np.split(start, PARTS, axis=1)
    for _ in range(rounds if len(start) else 0):
        books = _improved(vectors, books, width)
    return books


def vector_codes(embeddings: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of each kept vector.

    A vector that is null or holds a null, NaN or infinite component is dropped; every other row is
    coded, repeated ones each for itself. Rows without vec_id are coded but come last when the codebooks are begun; of
    equal ids the smaller vector comes first. Vectors of different lengths are filled up with zeros to
    the longest, rounded up to a multiple of four. Fewer than 256 vectors make smaller codebooks, an
    empty table an empty result. Labels are equal when their texts are, and nulls are one
    group. Other columns are ignored, whatever their names. Components beyond 64-bit distances raise.
    """
    rows = keep(whole_vectors(embeddings), "vectors")
    longest = rows.agg(F.max(F.size("v"))).first()[0] or 0
    width = -(-longest // PARTS) * PARTS
    books = fit(rows, width)
    numbers = ",".join(str(x) for book in books for entry in book.tolist() for x in entry)
    ready = rows.select("vec_id", F.col("label").cast("string").alias("_label"), "v")
    found = keep(
        ready.mapInArrow(
            _coded(books, width, partitions_of(rows)), "vec_id long, _label string, code string, error long, _share long"
        ),
        "codes",
    )
    named = found.withColumns({"_group": F.coalesce("_label", F.lit("")), "_none": F.col("_label").isNull()})
    answered = answer_groups(
        named, ["_group", "_none"], "_share", {"label_error": ("_part", F.sum("error"), "sum")}
    )
    digest = sha256(numbers.encode()).hexdigest()
    return answered.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
