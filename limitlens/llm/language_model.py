"""Smoothed n-gram scores from a log-frequency Bloom filter.

Counts of words and word pairs are quantised to levels, logarithmically, and a filter holds (n-gram, level) for every level
up to an n-gram's own. A count is asked for by probing level after level until one is missing, so an answer is never too low and
too high with a chance that falls geometrically. Probabilities are a Dirichlet-smoothed pair model
over the smoothed word model, all from such probes; exact word counts serve the base score only.

Texts are tokenised once into blocks of about a million tokens with their own vocabularies. A block sends
its distinct n-grams with their training counts to segments, ranges of the n-grams' hashes, where they are
merged and become the segment's part of the filter. A filter of proven small size is broadcast to the workers; a larger
one stays where its segments are, which answer the blocks' probes by the same code.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from limitlens.llm.tables import held_out, keep, partitions_of, scratch, text_bytes

FOLDS = 10
# Levels grow by this factor in count; the weight of the word model under the pair model, in counts.
GROWTH, PRIOR = 1.5, 100.0
BITS, PROBES = 12, 6  # bits for each (n-gram, level), and how many of them are looked at
ADDED = 0.1
BLOCK_TOKENS = 1 << 20
SEGMENT_NGRAMS = 1 << 20
# Larger filters are not broadcast: every Python worker holds a copy.
BROADCAST_BYTES = 32 << 20
# N-grams are told apart by so many bits: chance matches stay below those of the filter up to 10^12 n-grams.
HASH_BITS = 48
END, START, WORDS = 0, 1, 2  # local numbers: two marks, then a block's words

_LEAST = np.unique(np.ceil(GROWTH ** np.arange(110, dtype=np.float64)))  # smallest count of each level
_LEAST = _LEAST[_LEAST < 2**62].astype(np.int64)
_TYPICAL = np.concatenate([[0.0], (_LEAST[:-1] + _LEAST[1:] - 1) / 2, [float(_LEAST[-1])]])
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def level_of(counts: np.ndarray) -> np.ndarray:
    """0 for 0, else the number of levels up to the count."""
    return np.searchsorted(_LEAST, counts, "right")


def typical(levels: np.ndarray) -> np.ndarray:
    """The count that a level stands for."""
    return _TYPICAL[levels]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD[3]
    x = (x ^ (x >> np.uint64(29))) * _ODD[4]
    return x ^ (x >> np.uint64(32))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def word_keys(hashes: np.ndarray) -> np.ndarray:
    return _mix(hashes * _ODD[0]) >> np.uint64(64 - HASH_BITS)


def pair_keys(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return _mix(first * _ODD[1] + second * _ODD[2]) >> np.uint64(64 - HASH_BITS)


def segment_of(keys: np.ndarray, segments: int) -> np.ndarray:
    """Ranges of keys: a larger key has no smaller segment."""
    return ((keys >> np.uint64(HASH_BITS - 24)) * np.uint64(segments) >> np.uint64(24)).astype(np.int64)


def _packed(keys: np.ndarray) -> bytes:
    """Sorted keys as gaps of 32 bits, and what is above them for the few larger gaps."""
    gaps = np.diff(keys, prepend=np.uint64(0))
    high = gaps >> np.uint64(32)
    at = np.flatnonzero(high)
    return b"".join([
        np.asarray([len(keys), len(at)], "<u8").tobytes(), at.astype("<u4").tobytes(), high[at].astype("<u4").tobytes(),
        gaps.astype("<u4").tobytes(),
    ])


def _unpacked(data: bytes) -> np.ndarray:
    n, large = np.frombuffer(data, "<u8", 2).tolist()
    at, high = np.frombuffer(data, "<u4", large, 16), np.frombuffer(data, "<u4", large, 16 + 4 * large)
    gaps = np.frombuffer(data, "<u4", n, 16 + 8 * large).astype(np.uint64)
    gaps[at] |= high.astype(np.uint64) << np.uint64(32)
    return np.cumsum(gaps, dtype=np.uint64)


class LogFrequencyFilter:
    """Quantised counts of n-grams in a bit array."""

    def __init__(self, data: bytes):
        self.data = data
        self.bits = np.frombuffer(data, np.uint8)

    @classmethod
    def of(cls, keys: np.ndarray, counts: np.ndarray, bits: int = BITS) -> LogFrequencyFilter:
        levels = level_of(counts)
        size = max(64, -(-int(levels.sum()) * bits // 8) * 8)
        held = np.zeros(size, bool)
        for level in range(1, int(levels.max(initial=0)) + 1):
            held[_places(keys[levels >= level], level, size)] = True
        return cls(np.packbits(held, bitorder="little").tobytes())

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The highest level up to which nothing is missing."""
        out, left, level = np.zeros(len(keys), np.uint8), np.arange(len(keys)), 0
        while len(left) and level < len(_LEAST):
            level += 1
            place, stride = _start(keys[left], level)
            for _ in range(PROBES):
                at = place % np.uint64(8 * len(self.bits))
                there = (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
                left, stride, place = left[there], stride[there], (place + stride)[there]
            out[left] = level
        return out


def _start(keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    first = _mix(keys * _ODD[0] + np.uint64(level * int(_ODD[2]) % (1 << 64)))
    return first, _mix(first + _ODD[1]) | np.uint64(1)


def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    place, stride = _start(keys, level)
    return np.concatenate([(place + np.uint64(i) * stride) % np.uint64(size) for i in range(PROBES)])


# --- blocks ----------------------------------------------------------------------------------


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self) + WORDS
        return number


_BLOCK = "block string, docs array<long>, held array<boolean>, sizes array<long>, ids binary, words binary, n_train long, n_train_docs long"


def _block(name: str, docs: list, held: list, numbers: _Numbers, found: list[np.ndarray]) -> pa.RecordBatch:
    words = list(numbers)
    order = np.argsort(word_keys(word_hashes(words)), kind="stable")
    rank = np.zeros(len(words) + WORDS, np.int32)
    rank[START], rank[order + WORDS] = START, np.arange(len(words)) + WORDS
    sizes = np.asarray([len(f) for f in found])
    learnt = ~np.asarray(held)
    columns = [
        [name], [docs], [held], [sizes.tolist()], [rank[np.concatenate(found)].astype("<i4").tobytes()],
        [b"\n".join(words[i] for i in order.tolist())], [int(sizes[learnt].sum())], [int(learnt.sum())],
    ]
    kinds = [pa.string(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
    names = [c.split()[0] for c in _BLOCK.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _blocks(tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, held, numbers, found, waiting = [], [], _Numbers(), [], 0
        made = xxhash.xxh3_128()
        for batch in batches:
            columns = (batch.column(c) for c in ("doc_id", "held", "text", "_row"))
            for doc_id, out, text, row in zip(*columns, strict=True):
                words = text.as_py().lower().split()  # bytes: only A-Z and ASCII white space count
                ids = np.fromiter(map(numbers.__getitem__, words), np.int32, len(words))
                if not docs:
                    made.update(str(row.as_py()).encode())
                docs.append(doc_id.as_py())
                held.append(out.as_py())
                found.append(np.append(ids, np.int32(END)))
                waiting += len(ids) + 1
                if waiting >= tokens:
                    yield _block(made.hexdigest(), docs, held, numbers, found)
                    docs, held, numbers, found, waiting = [], [], _Numbers(), [], 0
        if docs:
            yield _block(made.hexdigest(), docs, held, numbers, found)

    return run


def token_blocks(docs: DataFrame, folds: int = FOLDS, tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Documents as blocks of numbered tokens, stored: one row per block, with its own vocabulary."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id").cast("long"), folds).alias("held"),
        text_bytes().alias("text"), F.monotonically_increasing_id().alias("_row"),
    )
    path = scratch(docs.sparkSession, "blocks")
    # Rows are large: a row group is closed by its size, not after a hundred rows.
    rows.mapInArrow(_blocks(tokens), _BLOCK).write.option("compression", "zstd").option(
        "parquet.block.size", str(32 << 20)
    ).option("parquet.block.size.row.check.min", "1").option("parquet.block.size.row.check.max", "4").parquet(path)
    return docs.sparkSession.read.schema(_BLOCK).parquet(path)


class _Tokens:
    """A block's tokens as pairs: what stands before each token, and the distinct pairs by key."""

    def __init__(self, ids: bytes, words: bytes, sizes: list[int]):
        self.ids = np.frombuffer(ids, "<i4")
        self.words = words.split(b"\n") if words else []
        self.sizes = np.asarray(sizes, np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.before = np.empty_like(self.ids)
        self.before[1:], self.before[self.starts] = self.ids[:-1], START
        marks = np.asarray([END, START], np.uint64)
        hashes = word_hashes(self.words)
        self.word_keys = word_keys(hashes)
        of = np.concatenate([marks, hashes])
        self.pairs, self.pair_of = np.unique(pair_keys(of[self.before], of[self.ids]), return_inverse=True)


def _messages(segments: int):
    """What a block asks of each segment: words and pairs with their counts in training documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                tokens = _Tokens(row["ids"], row["words"], row["sizes"])
                learnt = np.repeat(~np.asarray(row["held"]), tokens.sizes)
                of_words = np.bincount(tokens.ids[learnt], minlength=len(tokens.words) + WORDS)[WORDS:]
                of_pairs = np.bincount(tokens.pair_of[learnt], minlength=len(tokens.pairs))
                out = []
                for kind, keys, counts in ((1, tokens.word_keys, of_words), (2, tokens.pairs, of_pairs)):
                    own = segment_of(keys, segments)
                    for seg in np.unique(own).tolist():
                        a, b = np.searchsorted(own, [seg, seg + 1])
                        asked = b"\n".join(tokens.words[a:b]) if kind == 1 else _packed(keys[a:b])
                        out.append((seg, kind, row["block"], asked, counts[a:b].astype("<u4").tobytes()))
                yield _rows(out, ("seg", "kind", "block", "asked", "counts"), (pa.int64(), pa.int32(), pa.string(), pa.binary(), pa.binary()))

    return run


def _rows(rows: list[tuple], names: tuple[str, ...], kinds: tuple) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], list(names))


# --- segments --------------------------------------------------------------------------------


class _Places(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = place = len(self)
        return place


_ANSWER = "block string, kind int, seg long, counts binary, levels binary, n long"


def _answers(seg: int, rows: list[tuple], resident: bool, bits: int) -> pa.RecordBatch:
    """A segment's merged counts as a filter, and what it answers each block.

    kind 0: the filter (if it is not ``resident``) and the number of distinct training words; 1: exact word counts, and
    levels; 2: levels of pairs. Levels are probed by the segment only where its filter stays.
    """
    words, asked = _Places(), [r for r in rows if r[0] == 1]
    at = [np.fromiter(map(words.__getitem__, r[2].split(b"\n")), np.int64) for r in asked]
    counted = [np.frombuffer(r[3], "<u4").astype(np.float64) for r in asked]
    # Sums below 2 ** 53 are exact.
    totals = np.bincount(np.concatenate(at), np.concatenate(counted)).astype(np.int64) if asked else np.zeros(0, np.int64)
    pairs = [r for r in rows if r[0] == 2]
    sent = [_unpacked(r[2]) for r in pairs]
    keys, own = np.unique(np.concatenate(sent), return_inverse=True) if sent else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    of_pairs = np.bincount(own, np.concatenate([np.frombuffer(r[3], "<u4") for r in pairs]), len(keys)).astype(np.int64) if sent else own
    of_words = word_keys(word_hashes(list(words)))
    built = LogFrequencyFilter.of(np.concatenate([of_words, keys]), np.concatenate([totals, of_pairs]), bits)
    out = [(None, 0, seg, None, None if resident else built.data, int(np.count_nonzero(totals)))]
    probed = built.levels(of_words) if resident else None
    for row, places in zip(asked, at, strict=True):
        out.append((row[1], 1, seg, totals[places].astype("<i8").tobytes(), probed[places].tobytes() if resident else None, None))
    if resident:
        probed, done = built.levels(keys), 0
        for row, part in zip(pairs, sent, strict=True):
            out.append((row[1], 2, seg, None, probed[own[done : done + len(part)]].tobytes(), None))
            done += len(part)
    kinds = (pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int64())
    return _rows(out, tuple(c.split()[0] for c in _ANSWER.split(", ")), kinds)


def _segments(resident: bool, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg, rows = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("seg", "kind", "block", "asked", "counts")]
            for own, *row in zip(*columns, strict=True):
                if own != seg and rows:
                    yield _answers(seg, rows, resident, bits)
                    rows = []
                seg = own
                rows.append(tuple(row))
        if rows:
            yield _answers(seg, rows, resident, bits)

    return run


# --- scores ----------------------------------------------------------------------------------


_SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _scores(train: int, distinct: int, train_docs: int, segments: int, filters):
    """Scores of the documents of a block, once its answers have come in."""

    def score(row: dict, counts: np.ndarray, word_levels: np.ndarray | None, pair_levels: np.ndarray | None) -> pa.RecordBatch:
        tokens = _Tokens(row["ids"], row["words"], row["sizes"])
        if filters is not None:
            word_levels, pair_levels = (
                _probed(filters.value, keys, segments) for keys in (tokens.word_keys, tokens.pairs)
            )
        exact = np.concatenate([[train_docs, 0], counts])
        room = train + ADDED * (distinct + 1)
        base = np.log10((exact + ADDED) / room)
        mark = level_of(np.asarray([train_docs]))
        seen = typical(np.concatenate([mark, mark, word_levels]))
        alone = (seen + ADDED) / room
        alone[START] = ADDED / room  # nothing is followed by a start
        together = np.minimum(typical(pair_levels)[tokens.pair_of], seen[tokens.before])
        chance = (together + PRIOR * alone[tokens.ids]) / (seen[tokens.before] + PRIOR)
        add = lambda x: np.add.reduceat(x, tokens.starts)
        n = len(row["docs"])
        columns = [
            row["docs"], row["held"], row["sizes"], add((exact[tokens.ids] > 0).astype(np.int64)), [train] * n, add(base[tokens.ids]),
            add(np.log10(chance)),
        ]
        names, kinds = zip(*(c.split() for c in _SCORED.split(", ")), strict=True)
        types = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
        return pa.RecordBatch.from_arrays([pa.array(c, types[k]) for c, k in zip(columns, kinds, strict=True)], list(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, words, pairs = [], [], []
        for batch in batches:
            for row in batch.to_pylist():
                if row["kind"] == 1:
                    counts.append(row["counts"])
                    words.append(row["levels"] or b"")
                elif row["kind"] == 2:
                    pairs.append(row["levels"])
                else:  # the block itself comes after its answers, which come by segment
                    yield score(
                        row, np.frombuffer(b"".join(counts), "<i8"), np.frombuffer(b"".join(words), np.uint8),
                        np.frombuffer(b"".join(pairs), np.uint8),
                    )
                    counts, words, pairs = [], [], []

    return run


def _probed(filters: dict[int, bytes], keys: np.ndarray, segments: int) -> np.ndarray:
    """Levels of sorted keys from the filters of all segments; a segment without any n-gram has none."""
    own = segment_of(keys, segments)
    out = np.zeros(len(keys), np.uint8)
    for seg in np.unique(own).tolist():
        if seg in filters:
            a, b = np.searchsorted(own, [seg, seg + 1])
            out[a:b] = LogFrequencyFilter(filters[seg]).levels(keys[a:b])
    return out


def language_scores(
    docs: DataFrame, folds: int = FOLDS, bits: int = BITS, broadcast_bytes: int = BROADCAST_BYTES,
    block_tokens: int = BLOCK_TOKENS, segment_ngrams: int = SEGMENT_NGRAMS,
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document.

    Learns from the rows whose id's checksum leaves a remainder; rows without doc_id are scored only. Null text
    is empty: it is one token, its end. Rows that repeat count and are scored each for itself. A text of any
    length is one document of one block. No training document leaves every chance at that of an
    unseen word. An empty table gives no rows; other columns are ignored, whatever their names. ``score`` depends on
    the filter: one n-gram in some hundred that was never seen is taken for one that was.
    """
    blocks = token_blocks(docs, folds, block_tokens)
    total = blocks.agg(
        F.sum("n_train"), F.sum("n_train_docs"), F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, b: a + b))
    ).first()
    train, train_docs, tokens = (x or 0 for x in total)
    segments = max(1, -(-tokens // segment_ngrams))
    # An n-gram has no more levels than occurrences, and a training token is one word and one pair.
    small = 2 * train * bits // 8 + 8 * segments <= broadcast_bytes
    spark = docs.sparkSession
    asked = blocks.select("block", "held", "sizes", "ids", "words").mapInArrow(
        _messages(segments), "seg long, kind int, block string, asked binary, counts binary"
    )
    tasks = max(partitions_of(blocks), min(segments, 100_000))
    answers = keep(
        asked.repartition(tasks, "seg").sortWithinPartitions("seg", "kind", "block").mapInArrow(
            _segments(not small, bits), _ANSWER
        ),
        "answers",
    )
    own = answers.where("kind = 0")
    distinct = (own.agg(F.sum("n")).first()[0] or 0) + (train_docs > 0)
    filters = None
    if small:  # at most broadcast_bytes, by the bound above
        filters = spark.sparkContext.broadcast({r.seg: bytes(r.levels) for r in own.select("seg", "levels").collect()})
    none = lambda kind: F.lit(None).cast(kind)
    block_columns = [c.split() for c in _BLOCK.split(", ")][1:6]
    answer_rows = answers.where("kind > 0").select(
        "block", "kind", "seg", "counts", "levels", *[none(k).alias(c) for c, k in block_columns]
    )
    block_rows = blocks.select(
        "block", F.lit(3).alias("kind"), none("long").alias("seg"), none("binary").alias("counts"), none("binary").alias("levels"),
        *[c for c, _ in block_columns],
    )
    return answer_rows.unionByName(block_rows).repartition(tasks, "block").sortWithinPartitions("block", "kind", "seg").mapInArrow(
        _scores(train, distinct, train_docs, segments, filters), _SCORED
    )
