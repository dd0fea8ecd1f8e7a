"""Near-duplicates by bottom-k sketches of one hash function, confirmed on full shingle sets.

A document is the set of its hashed word shingles; documents with one set are one node. The
``SKETCH`` smallest hashes of a set are its sketch. Inverted lists of the smallest retained values give
candidates: values are ordered by how many nodes hold them, rarest first, and a node enters
only the lists of as many of its rarest values as a partner at the threshold cannot avoid, so
passages that many documents share open no lists. Candidates of short lists are filtered by the
similarity that the sketch of the union estimates, and confirmed on the full sets.

A long list (many near copies, or much shared text) is never paired up in one task. Its
nodes get a second, exact prefix over their full sets, which drops all that have too many
shingles of their own; what still hangs together is cut into blocks, every pair of blocks is a
task, and a task counts intersections exactly and returns only the links of a spanning forest.
No case is dropped: the length of a list decides the way, not the result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from limitlens.llm.tables import keep, text_bytes

SKETCH, LISTED = 128, 32
# A list up to this long gives pairs; a longer one goes through blocks of ``BLOCK`` nodes.
SHORT_LIST, BLOCK = 64, 256
# Chance that the lists or the estimate miss a pair exactly at the threshold.
_MISS = 1e-9
_ESTIMATE_MISS = 1e-12
CACHED = 400_000
_SLAB = 4096
# The table of how often shingles are held: at most 2 ** _MOST_BITS entries, summed in _PARTS tasks.
_MOST_BITS, _PARTS = 22, 16

_FACTORS = [
    0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
    0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3,
]


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < CACHED:
            self[word] = value
        return value


_WORDS = _Words()


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a lower-cased (A-Z) text.

    Words are what ASCII white space separates. Fewer words than a shingle has are one shingle.
    """
    found = text.lower().split()  # bytes: both are ASCII only
    if not found:
        return np.zeros(0, np.uint64)
    coded = np.fromiter(map(_WORDS.__getitem__, found), np.uint64, len(found))
    width = min(words, len(found))
    count = len(found) - width + 1
    mixed = np.full(count, np.uint64(width))
    for i in range(width):
        factor = (_FACTORS[i % len(_FACTORS)] + 2 * (i // len(_FACTORS))) & ((1 << 64) - 1)
        mixed += coded[i : i + count] * np.uint64(factor)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def _signed(values: np.ndarray) -> np.ndarray:
    """Unsigned order kept in signed integers."""
    return (values ^ np.uint64(1 << 63)).view(np.int64)


def _node(values: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(values.tobytes())


def _signatures(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes, sketches = [], [], []
            for text in batch.column("text"):
                values = shingle_set(text.as_py(), words)
                sizes.append(len(values))
                nodes.append(_node(values))
                sketches.append(_signed(values[:SKETCH]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.binary()),
                 pa.array(sketches, pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "node", "sketch"],
            )

    return run


def _full_sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t.as_py(), words) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_node(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                ["node", "values"],
            )

    return run


def sure_overlap(percent: int, drawn: int = LISTED, miss: float = _MISS) -> int:
    """How many of ``drawn`` smallest values two sets at the threshold share, but for a chance of ``miss``."""
    p, below = percent / 100, 0.0
    for count in range(drawn + 1):
        below += math.comb(drawn, count) * p**count * (1 - p) ** (drawn - count)
        if below > miss:
            return max(1, count)
    return drawn


def _prefix_length(size: Column, percent: int) -> Column:
    """Values of a node that enter lists. ``size``: shingles of the node."""
    # A whole set shares percent of its size with a partner, less what the partner's own cut hides.
    hidden = F.greatest(F.lit(0), F.floor(size * 100 / percent) - LISTED)
    whole = size - F.greatest(F.lit(1), F.ceil(size * percent / 100) - hidden) + 1
    return F.when(size < LISTED, whole).otherwise(LISTED - sure_overlap(percent) + 1).cast("int")


def _lists(nodes: DataFrame, percent: int) -> DataFrame:
    """(value, node): every node in the lists of its rarest retained values that another node holds."""
    listed = nodes.select(
        "node", "n_shingles", F.explode(F.slice("sketch", 1, LISTED)).alias("value")
    )
    common = listed.groupBy("value").agg(F.count("*").alias("holders")).where("holders > 1")
    shared = listed.join(common, "value").groupBy("node", "n_shingles").agg(
        F.array_sort(F.collect_list(F.struct("holders", "value"))).alias("held")  # at most LISTED
    )
    # Values that nobody else holds are the rarest of all and use up the prefix first.
    alone = F.least(F.lit(LISTED), F.col("n_shingles")) - F.size("held")
    room = F.greatest(F.lit(0), _prefix_length(F.col("n_shingles"), percent) - alone).cast("int")
    rarest = shared.select("node", F.explode(F.slice("held", F.lit(1), room)).alias("held"))
    return rarest.select(F.col("held.value").alias("value"), "node")


def _pairs(lists: DataFrame) -> DataFrame:
    """Distinct pairs of nodes of one list; lists are short."""
    members = lists.groupBy("value").agg(F.array_sort(F.collect_list("node")).alias("members"))
    first = members.where(F.size("members") > 1).select("members", F.posexplode("members").alias("at", "a"))
    later = first.select("a", F.explode(F.slice("members", F.col("at") + 2, F.lit(SHORT_LIST))).alias("b"))
    return later.distinct()


def _estimated(percent: int):
    """Pairs whose union's sketch allows the threshold, and whose sizes do."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        threshold, sure = percent / 100, sure_overlap(percent, SKETCH, _ESTIMATE_MISS)
        for batch in batches:
            n_a, n_b = (batch.column(c).to_numpy() for c in ("n_a", "n_b"))
            kept = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                small, large = sorted((int(n_a[i]), int(n_b[i])))
                if 100 * small < percent * large:
                    continue
                a, b = (batch.column(c)[i].values.to_numpy() for c in ("s_a", "s_b"))
                union = np.union1d(a, b)
                if large > SKETCH:
                    union = union[:SKETCH]
                    least = sure
                else:
                    least = threshold * len(union) - 1e-9  # both sketches are the whole sets
                both = np.intersect1d(a, b, assume_unique=True)
                kept[i] = np.searchsorted(both, union[-1], "right") >= least
            yield batch.select(["a", "b"]).filter(pa.array(kept))

    return run


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                a, b = (np.frombuffer(batch.column(c)[i].as_py(), np.uint64) for c in ("v_a", "v_b"))
                both = len(np.intersect1d(a, b, assume_unique=True))
                kept[i] = 100 * both >= percent * (len(a) + len(b) - both)
            yield batch.select(["a", "b"]).filter(pa.array(kept))

    return run


def _with_sides(pairs: DataFrame, side: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Attach columns of both nodes; ``columns`` maps a column to its short prefix."""
    for end in ("a", "b"):
        named = side.select(F.col("node").alias(end), *[F.col(c).alias(f"{p}_{end}") for c, p in columns.items()])
        pairs = pairs.join(named, end)
    return pairs


def _crossing_links(percent: int):
    """Exact links between two blocks (or inside one), as a spanning forest."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("block", "ascending"), ("node", "ascending")])
        nodes = group["node"].to_pylist()
        sets = [np.frombuffer(v, np.uint64) for v in group["values"].to_pylist()]
        sizes = np.asarray([len(s) for s in sets], np.int64)
        blocks = group["block"].to_numpy()
        # Only shingles that two nodes hold can add to an intersection.
        every, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        vocabulary, place, held = np.unique(every, return_inverse=True, return_counts=True)
        shared = np.flatnonzero(held > 1)
        column = np.full(len(vocabulary), -1)
        column[shared] = np.arange(len(shared))
        place = column[place]
        owner, place = owner[place >= 0], place[place >= 0]
        order = np.argsort(place, kind="stable")
        owner, place = owner[order], place[order]
        both = np.zeros((len(sets), len(sets)), np.float32)
        for start in range(0, len(shared), _SLAB):
            low, high = np.searchsorted(place, [start, start + _SLAB])
            slab = np.zeros((len(sets), min(_SLAB, len(shared) - start)), np.float32)
            slab[owner[low:high], place[low:high] - start] = 1
            both += slab @ slab.T
        common = np.rint(both).astype(np.int64)
        linked = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
        if blocks[0] != blocks[-1]:
            linked &= blocks[:, None] != blocks[None, :]
        root = list(range(len(sets)))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        a, b = [], []
        for i, j in zip(*np.nonzero(np.triu(linked, 1)), strict=True):
            x, y = find(int(i)), find(int(j))
            if x != y:
                root[max(x, y)] = min(x, y)
                a.append(nodes[i])
                b.append(nodes[j])
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return run


def _bucket_counts(bits: int):
    """How many of a task's nodes hold a shingle of each bucket: only the buckets that have any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, np.uint32)
        for batch in batches:
            for values in batch.column("values"):
                np.add.at(counts, _bucket(np.frombuffer(values.as_py(), np.uint64), bits), 1)
        held = np.flatnonzero(counts).astype(np.uint32)
        for part in range(_PARTS):
            own = held[held % _PARTS == part]
            if len(own):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([own.tobytes()], pa.binary()),
                     pa.array([counts[own].tobytes()], pa.binary())],
                    ["part", "buckets", "counts"],
                )

    return run


def _bucket(values: np.ndarray, bits: int) -> np.ndarray:
    return (values >> np.uint64(64 - bits)).astype(np.int64)


def _sum_counts(bits: int):
    def run(group: pa.Table) -> pa.Table:
        counts = np.zeros(1 << bits, np.uint64)
        for buckets, own in zip(group["buckets"], group["counts"], strict=True):
            counts[np.frombuffer(buckets.as_py(), np.uint32)] += np.frombuffer(own.as_py(), np.uint32)
        part = group["part"][0].as_py()
        mine = np.minimum(counts[part::_PARTS], 65_535).astype(np.uint16)
        return pa.table({"part": pa.array([part], pa.int32()), "counts": pa.array([mine.tobytes()], pa.binary())})

    return run


def _holders(sets: DataFrame, bits: int) -> np.ndarray:
    """Nodes that hold a shingle of each of ``2 ** bits`` buckets; its size does not grow with the data."""
    parts = (
        sets.mapInArrow(_bucket_counts(bits), "part int, buckets binary, counts binary")
        .groupBy("part").applyInArrow(_sum_counts(bits), "part int, counts binary").collect()
    )
    counts = np.zeros(1 << bits, np.uint16)
    for r in parts:
        counts[r["part"] :: _PARTS] = np.frombuffer(r["counts"], np.uint16)
    return counts


def _prefixes(holders: np.ndarray, bits: int, percent: int):
    """A node's rarest shingles: as many as a partner at the threshold cannot avoid.

    Any order that all nodes share is right; this one puts shingles of little held buckets first.
    Those that no other node can hold use up the prefix and are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, values in zip(batch.column("node"), batch.column("values"), strict=True):
                own = np.frombuffer(values.as_py(), np.uint64)
                held = holders[_bucket(own, bits)]
                room = len(own) - -(-len(own) * percent // 100) + 1
                first = np.lexsort((own, held))[:room]
                first = first[held[first] > 1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([node.as_py()] * len(first), pa.binary()), pa.array(_signed(own[first]))],
                    ["node", "value"],
                )

    return run


def _links_of_long_lists(hot: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links among the nodes of long lists; ``hot``: node, ``sets``: node, values."""
    own = keep(sets.join(hot, "node", "left_semi"), "long-list-sets")
    rows = own.select(F.sum(F.length("values") / 8)).first()[0] or 0
    bits = min(_MOST_BITS, max(10, math.ceil(math.log2(4 * rows + 1))))
    entered = keep(
        own.mapInArrow(_prefixes(_holders(own, bits), bits, percent), "node binary, value long"),
        "long-list-prefixes",
    )

    # What shares a list at all hangs together: a star per list, then components of the stars.
    centres = entered.groupBy("value").agg(F.min("node").alias("b"))
    stars = entered.join(centres, "value").where("node <> b").select(F.col("node").alias("a"), "b").distinct()
    groups = components(stars)
    sizes = groups.groupBy("root").agg(F.count("*").alias("members"))
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    dealt = groups.join(sizes, "root").select(
        "node", "root", F.pmod(F.xxhash64("node"), blocks).cast("int").alias("block"), blocks.alias("blocks")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    tasks = dealt.join(own, "node").select("node", "root", "block", "values", other).select(
        "node", "block", "values", "root",
        F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
    )
    return tasks.groupBy("root", "low", "high").applyInArrow(_crossing_links(percent), "a binary, b binary")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of the nodes of an edge table (a, b), by large-star and small-star rounds.

    Every round links a node's neighbours to the smallest of them, first the larger ones and then
    the smaller ones, until nothing changes; each round's edges are written to the shared folder.
    """
    edges = keep(edges.select("a", "b").where("a <> b"), "edges")
    known = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        least = least.select("a", F.least("a", "m").alias("m"))
        larger = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = larger.groupBy("a").agg(F.min("b").alias("m"))
        smaller = larger.join(lowest, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = keep(smaller.unionByName(lowest.select("a", F.col("m").alias("b"))).distinct(), "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == known:
            roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
            return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
        known = tuple(state)


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Two documents are linked when 100 * |intersection| >= ``percent`` * |union| of their sets of
    ``words``-word shingles; component_id is the smallest doc_id reachable by links. Null and empty
    texts and texts without words have no shingles and link with nothing. Rows that repeat a doc_id
    are documents of their own that share a name. A row without doc_id is linked like any other,
    names no component unless nobody else does, and is then kept. No documents give no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes().alias("text"))
    signed = keep(
        texts.mapInArrow(_signatures(words), "doc_id long, n_shingles long, node binary, sketch array<long>"),
        "signatures",
    )
    nodes = keep(
        signed.where("n_shingles > 0").groupBy("node").agg(
            F.min("doc_id").alias("label"), F.first("n_shingles").alias("n_shingles"),
            F.first("sketch").alias("sketch"),
        ),
        "nodes",
    )
    lists = keep(_lists(nodes, percent), "lists")
    sizes = lists.groupBy("value").agg(F.count("*").alias("members"))
    short = lists.join(sizes.where((F.col("members") > 1) & (F.col("members") <= SHORT_LIST)), "value", "left_semi")
    hot = keep(
        lists.join(sizes.where(F.col("members") > SHORT_LIST), "value", "left_semi").select("node").distinct(), "hot"
    )

    sketched = _with_sides(_pairs(short), nodes, {"n_shingles": "n", "sketch": "s"})
    likely = keep(sketched.mapInArrow(_estimated(percent), "a binary, b binary"), "likely-pairs")

    ends = [likely.select(F.col(c).alias("node")) for c in ("a", "b")]
    wanted = reduce(DataFrame.unionByName, [*ends, hot]).distinct().join(nodes.select("node", "label"), "node")
    found = texts.join(
        wanted.select(F.col("label").alias("doc_id")).distinct().withColumnRenamed("doc_id", "_label"),
        F.col("doc_id").eqNullSafe(F.col("_label")), "left_semi",
    ).mapInArrow(_full_sets(words), "node binary, values binary")
    sets = keep(found.join(wanted.select("node"), "node", "left_semi").dropDuplicates(["node"]), "full-sets")

    confirmed = _with_sides(likely, sets, {"values": "v"}).mapInArrow(_confirmed(percent), "a binary, b binary")
    links = keep(confirmed, "links")
    if not hot.isEmpty():
        links = links.unionByName(keep(_links_of_long_lists(hot, sets, percent), "long-list-links"))

    named = nodes.select("node", "label").join(components(links), "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    names = named.groupBy("root").agg(F.min("label").alias("component_id"))
    answers = named.join(names, "root").select("node", "component_id")

    # Copies of one text may be a third of all rows: the answer goes to shares of each node.
    share = F.pmod(F.xxhash64("doc_id", "n_shingles"), F.lit(int(spark.conf.get("spark.sql.shuffle.partitions"))))
    rows = signed.select("doc_id", "n_shingles", "node", share.alias("share"))
    parts = rows.where("n_shingles > 0").select("node", "share").distinct().join(answers, "node")
    out = rows.join(parts, ["node", "share"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )
