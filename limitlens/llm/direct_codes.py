"""Token ids in directly addressable codes, written as binary files and read back.

An id is split into chunks of eight bits, lowest first. Level 0 holds the first chunk of every
id, level 1 the second chunk of the ids that go on, and so on. A bitmap per level marks the ids
that go on; a directory holds the number of marks before every block of 512, so the place of an
id in the next level is a directory entry plus a count inside one block. Any id is read by
at most one step per level; nothing before it is decoded.

A file is a sequence of segments, each followed by one newline byte (the row end of the
writer). Segment, all little-endian: ``DACS``, u32 shard, u64 documents, u64 ids, u32 levels;
per document i64 id, u64 number of ids, u8 whether the id is null; per level u64 entries, the
chunks (u8), the bitmap (bit i of byte i // 8) and the u32 directory. The last level has an
all-zero bitmap. Files are shards in ascending doc_id order.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from limitlens.llm.tables import keep, partitions_of, scratch, whole_text
from limitlens.llm.words import encoder

MAGIC = b"DACS"
CHUNK_BITS = 8
BLOCK = 512
SEGMENT_IDS = 1 << 18
_HEAD = struct.Struct("<4sIQQI")


class Codes:
    """Directly addressable ids: levels of (chunks, marks as bits, marks before each block)."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.levels = levels

    @classmethod
    def of(cls, ids: np.ndarray) -> Codes:
        levels, rest = [], ids.astype(np.uint32)
        while True:
            more = rest >> CHUNK_BITS
            marks = more > 0
            counts = np.add.reduceat(marks, np.arange(0, len(marks), BLOCK)) if len(marks) else []
            before = np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(marks) else np.zeros(0)
            levels.append(
                (rest.astype(np.uint8), np.packbits(marks, bitorder="little"), before.astype("<u4"))
            )
            if not marks.any():
                return cls(levels)
            rest = more[marks]

    def _rank(self, level: int, at: int) -> int:
        """Marks before position ``at``."""
        _, bits, before = self.levels[level]
        block = at // BLOCK
        if block >= len(before):
            block = len(before) - 1
        start = block * BLOCK // 8
        inside = np.unpackbits(bits[start : (at + 7) // 8], bitorder="little")[: at - block * BLOCK]
        return int(before[block]) + int(inside.sum())

    def at(self, position: int) -> int:
        """One id, by one step per level."""
        value = 0
        for level, (chunks, bits, _) in enumerate(self.levels):
            value |= int(chunks[position]) << (CHUNK_BITS * level)
            if not bits[position // 8] >> (position % 8) & 1:
                break
            position = self._rank(level, position)
        return value

    def between(self, start: int, stop: int) -> np.ndarray:
        """The ids of a range; each level is entered at the rank of the range's start."""
        out = np.zeros(stop - start, "<u4")
        places = np.arange(stop - start)
        for level, (chunks, bits, _) in enumerate(self.levels):
            if not len(places):
                break
            out[places] |= chunks[start:stop].astype(np.uint32) << np.uint32(CHUNK_BITS * level)
            first = start // 8
            marks = np.unpackbits(bits[first : (stop + 7) // 8], bitorder="little")
            marks = marks[start - first * 8 : stop - first * 8].astype(bool)
            places = places[marks]
            if len(places):
                start = self._rank(level, start)
                stop = start + len(places)
        return out


def segment(shard: int, docs: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    codes = Codes.of(ids)
    parts = [
        _HEAD.pack(MAGIC, shard, len(docs), len(ids), len(codes.levels)),
        np.asarray([0 if d is None else d for d in docs], "<i8").tobytes(),
        np.asarray(lengths, "<u8").tobytes(),
        np.asarray([d is None for d in docs], "u1").tobytes(),
    ]
    for chunks, bits, before in codes.levels:
        parts += [struct.pack("<Q", len(chunks)), chunks.tobytes(), bits.tobytes(), before.tobytes()]
    return b"".join(parts)


def segments(content: bytes) -> Iterator[tuple[int, list[int | None], np.ndarray, Codes]]:
    """Shard, document ids, their lengths and the codes of every segment of a file."""
    place = 0

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal place
        found = np.frombuffer(content, kind, count, place)
        place += found.nbytes
        return found

    while place < len(content):
        magic, shard, n_docs, n_ids, n_levels = _HEAD.unpack_from(content, place)
        if magic != MAGIC:
            raise ValueError(f"no segment at byte {place}")
        place += _HEAD.size
        docs, lengths, null = take("<i8", n_docs), take("<u8", n_docs), take("u1", n_docs)
        levels = []
        for _ in range(n_levels):
            entries = int(take("<u8", 1)[0])
            levels.append((take("u1", entries), take("u1", -(-entries // 8)), take("<u4", -(-entries // BLOCK))))
        place += 1  # the newline
        names = [None if gone else d for d, gone in zip(docs.tolist(), null.tolist(), strict=True)]
        yield shard, names, lengths.astype(np.int64), Codes(levels)


def _write_segments(path: str, end: bytes):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, shard = encoder(path).ids, TaskContext.get().partitionId()
        docs: list[int | None] = []
        coded: list[bytes] = []
        waiting = 0

        def out() -> pa.RecordBatch:
            made = segment(shard, docs, [len(c) // 4 for c in coded], np.frombuffer(b"".join(coded), "<u4"))
            return pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], ["value"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                docs.append(doc_id.as_py())
                coded.append(encode(text.as_py()) + end)
                waiting += len(coded[-1]) // 4
                if waiting >= SEGMENT_IDS:
                    yield out()
                    docs, coded, waiting = [], [], 0
        if docs:
            yield out()

    return write


def write_ids(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = 2) -> None:
    """Encode whole texts (null: empty), end each with ``end_id``, write files by ascending doc_id.

    Rows without doc_id come first; rows that repeat a doc_id are ordered by text (over several files by its first
    32 characters, then by a hash), so that many of them do not meet in one task. Equal rows can change places
    unseen and are ranged by where they were read. A file holds a range of this order and is
    written by one task, segment by segment; Spark's committer keeps files of lost tasks
    out. No documents: no segments.
    """
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    rows = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")).select(
        "*", F.substring("text", 1, 32).alias("_first"), F.xxhash64("text").alias("_hash"),
        F.monotonically_increasing_id().alias("_place"),
    )
    (
        rows.repartitionByRange(partitions_of(docs), "doc_id", "_first", "_hash", "_place")
        .sortWithinPartitions("doc_id", "text")
        .select("doc_id", "text")
        .mapInArrow(_write_segments(path, np.asarray([end_id], "<u4").tobytes()), "value binary")
        .select(F.col("value").cast("string").alias("value"))  # the bytes stay as they are
        .write.option("lineSep", "\n")
        .text(folder)
    )


def _read_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column("content"):
            before = 0
            for shard, docs, lengths, codes in segments(content.as_py()):
                stops = np.cumsum(lengths)
                # Every document is wanted: each level is entered once for the whole segment.
                ids = codes.between(0, int(stops[-1]))
                crcs = [
                    zlib.crc32(ids[stop - n : stop])
                    for stop, n in zip(stops.tolist(), lengths.tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, pa.int64()) for x in (
                        [shard] * len(docs), docs, before + stops - lengths, lengths, crcs)],
                    ["shard", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )
                before += int(stops[-1])


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """One row per stored document: doc_id, start (ids of all documents before), n_tokens, ids_crc32.

    Shards are read independently; their starts come from the shards' totals, one row per file.
    """
    files = spark.read.format("binaryFile").load(folder).select("content")
    rows = keep(
        files.mapInArrow(
            _read_segments, "shard long, doc_id long, inside long, n_tokens long, ids_crc32 long"
        ),
        "read-ids",
    )
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = rows.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    bases = shards.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(bases), "shard").select(
        "doc_id", (F.col("base") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )


def stored_ids(docs: DataFrame, tokenizer: str | None = None, end_id: int = 2) -> DataFrame:
    """Write the ids of whole texts and read them back; see :func:`write_ids` and :func:`read_ids`.

    Null and empty texts are the end id alone; texts may be of any length, a segment always holds whole documents;
    each of repeated rows has a row of its own; extra columns are ignored; no documents give no rows.
    """
    folder = scratch(docs.sparkSession, "token-ids")
    write_ids(docs, folder, tokenizer, end_id)
    return read_ids(docs.sparkSession, folder)
