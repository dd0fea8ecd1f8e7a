"""Packing documents into sequences: first-fit decreasing with a tournament tree of free room.

Every document is encoded where it is read and cut into pieces of a full sequence and a
remainder. Pieces are dealt into randomised groups of bounded size; a group packs its
remainders by falling length, each into the first sequence with room. The tree holds the
largest room below each node, so finding that sequence takes a logarithmic descent.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from limitlens.llm.tables import partitions_of, whole_text
from limitlens.llm.words import ID_BYTES, encoder

_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class RoomTree:
    """Complete binary tree over sequences; a node holds the most room among its leaves."""

    def __init__(self, leaves: int, room: int):
        self.width = 1 << max(0, leaves - 1).bit_length()
        self.most = [room] * (2 * self.width)

    def place(self, size: int) -> tuple[int, int]:
        """The first sequence with room for ``size``: its number and the room it had."""
        most, node = self.most, 1
        while node < self.width:
            node *= 2
            if most[node] < size:
                node += 1
        had = most[node]
        most[node] = had - size
        leaf = node - self.width
        node //= 2
        while node:
            left, right = most[2 * node], most[2 * node + 1]
            best = left if left >= right else right
            if most[node] == best:
                break
            most[node] = best
            node //= 2
        return leaf, had


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of every size, in the given (falling) order."""
    tree = RoomTree(max(1, len(sizes)), capacity)
    numbers, offsets = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    for i, size in enumerate(sizes.tolist()):
        numbers[i], had = tree.place(size)
        offsets[i] = capacity - had
    return numbers, offsets


def _pieces(path: str, capacity: int, end: bytes):
    step = capacity * ID_BYTES

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = encoder(path).ids, TaskContext.get().partitionId() << 32
        # Equal rows of a task are told apart by their number, so a lost task that runs again deals the same.
        copies: Counter[int] = Counter()
        for batch in batches:
            doc, start, length, crc, total, copy = [], [], [], [], [], []
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                ids = encode(text.as_py()) + end
                doc_id, n = doc_id.as_py(), len(ids) // ID_BYTES
                same = hash((doc_id, ids))
                number = task + copies[same]
                copies[same] += 1
                for at in range(0, len(ids), step):
                    piece = ids[at : at + step]
                    doc.append(doc_id)
                    start.append(at // ID_BYTES)
                    length.append(len(piece) // ID_BYTES)
                    crc.append(zlib.crc32(piece))
                    total.append(n)
                    copy.append(number)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in (doc, start, length, crc, total, copy)],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "_copy"],
            )

    return cut


def pack(
    docs: DataFrame,
    capacity: int = 1024,
    group_docs: int = 4000,
    seed: int = 17,
    tokenizer: str | None = None,
    end_id: int = 0,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids and ``end_id``; null text counts as empty and still gives one piece.
    Pieces of ``capacity`` ids fill a sequence alone. ``group_docs`` bounds what one task packs
    (documents on average). Each piece is dealt by its id, place and ids, by the task that read it and by its number
    among equal rows there, so neither rows without id, nor repeated rows, nor one very long
    text gather in a group. Each row is packed on its own; equal lengths are ordered by
    doc_id and start. Extra columns are ignored. No documents, no rows.
    """
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    end = np.asarray([end_id], "<u4").tobytes()
    groups = max(1, math.ceil(docs.count() / group_docs))
    pieces = (
        docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
        .mapInArrow(_pieces(path, capacity, end), f"{_PIECE}, _copy long")
        .withColumn("_group", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "_copy", F.lit(seed)), F.lit(groups)))
        .drop("_copy")
    )

    def pack_group(group: pa.Table) -> pa.Table:
        order = pc.sort_indices(
            group,
            sort_keys=[("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"),
                       ("ids_crc32", "ascending")],
        )
        group = group.take(order)
        lengths = group["length"].to_numpy()
        full = int((lengths == capacity).sum())
        rest, offsets = first_fit_decreasing(lengths[full:], capacity)
        numbers = np.concatenate([np.arange(full), full + rest])
        number = numbers * groups + group["_group"][0].as_py()
        offset = np.concatenate([np.zeros(full, np.int64), offsets])
        return (
            group.drop_columns("_group")
            .append_column("sequence_id", pa.array(number, pa.int64()))
            .append_column("offset", pa.array(offset, pa.int64()))
        )

    return (
        pieces.repartition(max(groups, partitions_of(docs)), "_group")
        .groupBy("_group")
        .applyInArrow(pack_group, f"{_PIECE}, sequence_id long, offset long")
    )
