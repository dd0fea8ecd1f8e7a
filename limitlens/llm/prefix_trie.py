"""The trie of conversation prefixes, measured by an Euler tour.

Turns are numbered and chained by a distributed scan: rows are sorted over the whole table, each task
digests its own stretch, and what a conversation had in earlier tasks is added afterwards, because
the digest of a sequence is a polynomial over a prime field and those of its pieces combine.
Equal digests are one node. The tour enters and leaves every node once; list ranking gives the sums of leaves
and savings from each arc to the end, and a subtree is what lies between its two arcs.
No conversation, no node's children and no node's members are ever brought together in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from limitlens.llm.list_ranking import suffix_sums
from limitlens.llm.tables import keep, partitions_of

# The field of the digests, the base of their polynomials and the digest of the empty sequence.
_PRIME = (1 << 127) - 1
_BASE = 0x5F3C1A7E9B24D86C0D2E4F6A8B9C7153
ROOT = (1).to_bytes(16, "big")
# A conversation begins with fewer turns of another than that, and conversations of so many ids share them.
HEADS, SHARED = 6, 100
_PIECE = 4096  # bytes of an id list that travel as one row
_NOBODY = sha256(b"").hexdigest()


def _number(digest: bytes) -> int:
    return int.from_bytes(digest, "big")


class _Powers(dict):
    """Powers of the base; those of short stretches are kept."""

    def __missing__(self, n: int) -> int:
        value = pow(_BASE, n, _PRIME)
        if len(self) < 100_000:
            self[n] = value
        return value


def _bytes(values: list[int]) -> pa.Array:
    return pa.array([v.to_bytes(16, "big") for v in values], pa.binary())


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place and digest of each turn inside its task's stretch of the conversation; the task's last row is marked."""
    conv, place, digest, held = None, 0, 0, None
    for batch in batches:
        places, befores, afters = [], [], []
        for own, element in zip(batch.column("conv_id").to_pylist(), batch.column("element").to_pylist(), strict=True):
            if own != conv:
                conv, place, digest = own, 0, 0
            place += 1
            befores.append(digest)
            digest = (digest * _BASE + _number(element) + 1) % _PRIME
            places.append(place)
            afters.append(digest)
        if not places:
            continue
        if held is not None:
            yield held
        ends = pa.array(np.zeros(len(places), bool))
        held = pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), pa.array(places, pa.int64()), _bytes(befores), _bytes(afters),
             batch.column("n_chars"), batch.column("_task"), ends],
            ["conv_id", "place", "before", "after", "n_chars", "_task", "_end"],
        )
    if held is not None:
        last = np.zeros(held.num_rows, bool)
        last[-1] = True
        yield held.set_column(held.num_columns - 1, "_end", pa.array(last))


def _carries(ends: list) -> dict[int, tuple[int, int, int]]:
    """For each task what its first conversation had before: (conv_id, turns, digest)."""
    out, open_ = {}, None
    for row in sorted(ends, key=lambda r: r._task):
        if open_ is not None:
            out[row._task] = open_
        turns, digest = 0, 0
        if open_ is not None and open_[0] == row.conv_id:
            turns, digest = open_[1:]
        open_ = (row.conv_id, turns + row.place, (digest * pow(_BASE, row.place, _PRIME) + _number(row.after)) % _PRIME)
    return out


def _joined_up(carries: dict[int, tuple[int, int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _Powers()
        for batch in batches:
            carry = [carries.get(t) for t in batch.column("_task").to_pylist()]
            conv, place = batch.column("conv_id").to_pylist(), batch.column("place").to_pylist()
            before, after = batch.column("before").to_pylist(), batch.column("after").to_pylist()
            for i, had in enumerate(carry):
                if had is not None and had[0] == conv[i]:
                    n = place[i]
                    before[i] = ((had[2] * powers[n - 1] + _number(before[i])) % _PRIME).to_bytes(16, "big")
                    after[i] = ((had[2] * powers[n] + _number(after[i])) % _PRIME).to_bytes(16, "big")
                    place[i] = n + had[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.array(place, pa.int64()), pa.array(before, pa.binary()),
                 pa.array(after, pa.binary()), batch.column("n_chars"), batch.column("_task")],
                ["conv_id", "place", "before", "after", "n_chars", "_task"],
            )

    return run


def chained_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), before and after (digests of the turns up to and with this one), n_chars, _task.

    Turns of a conversation go by turn (null first); those of one turn number by the digest of role and text.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # The role's length keeps ('a', 'bc') and ('ab', 'c') apart.
    element = F.unhex(F.substring(F.sha2(F.concat_ws("\n", F.length(role), role, text), 256), 1, 30))
    turns = keep(
        conversations.where("conv_id is not null").select(
            F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
            element.alias("element"), F.length(text).cast("long").alias("n_chars"),
            F.monotonically_increasing_id().alias("_row"),
        ),
        "turns",
    )
    # Rows that repeat differ by their number, so even one turn repeated without end is dealt to many tasks.
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("element"), F.col("_row")]
    sorted_ = turns.repartitionByRange(partitions_of(turns), *order).sortWithinPartitions(*order)
    stretches = keep(
        sorted_.withColumn("_task", F.spark_partition_id()).mapInArrow(
            _stretches, "conv_id long, place long, before binary, after binary, n_chars long, _task int, _end boolean"
        ),
        "stretches",
    )
    ends = stretches.where("_end").select("conv_id", "place", "after", "_task").collect()  # one row per task
    return keep(
        stretches.drop("_end").mapInArrow(
            _joined_up(_carries(ends)), "conv_id long, place long, before binary, after binary, n_chars long, _task int"
        ),
        "chained",
    )


def _rebuilt_own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of own turns behind another conversation's first turns."""
    powers = _Powers()
    for batch in batches:
        nodes, parents = [], []
        columns = [batch.column(c).to_pylist() for c in ("place", "before", "after", "h", "shared", "left")]
        for place, before, after, h, shared, left in zip(*columns, strict=True):
            # What is cut off in front and what stands there instead move up by as many powers.
            swap = _number(shared) - _number(left)
            nodes.append((_number(after) + swap * powers[place - h]) % _PRIME)
            parents.append((_number(before) + swap * powers[place - h - 1]) % _PRIME)
        yield pa.RecordBatch.from_arrays(
            [_bytes(nodes), _bytes(parents), *(batch.column(c) for c in ("depth", "n_chars", "conv_id", "is_end"))],
            ["node", "parent", "depth", "n_chars", "conv_id", "is_end"],
        )


def _seeded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests that begin with the empty sequence's digest, which keeps lengths apart."""
    powers, seed = _Powers(), _number(ROOT)
    for batch in batches:
        place = batch.column("place").to_pylist()
        before, after = (
            _bytes([(_number(d) + seed * powers[p - back]) % _PRIME for p, d in zip(place, batch.column(c).to_pylist(), strict=True)])
            for c, back in (("before", 1), ("after", 0))
        )
        yield batch.set_column(batch.schema.get_field_index("before"), "before", before).set_column(
            batch.schema.get_field_index("after"), "after", after
        )


def rebuilt_rows(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (node, parent, depth, n_chars, conv_id, is_end), one per rebuilt turn, and the facts of each conversation.

    A conversation takes the first h turns of the one whose id ends its hundred (floor, also below
    zero), then its own turns after its first h. ``is_end`` marks the last turn of a rebuilt conversation;
    facts are conv_id and length, the number of its turns.
    """
    schema = "conv_id long, place long, before binary, after binary, n_chars long, _task int"
    own = keep(chained_turns(conversations).mapInArrow(_seeded, schema), "own")
    first = F.when(F.col("place") < HEADS, F.struct("place", "before", "after", "n_chars"))
    heads = own.groupBy("conv_id").agg(
        F.count("*").alias("n"), F.array_sort(F.collect_list(first)).alias("heads")  # fewer than HEADS each
    )
    heads = keep(
        heads.withColumn("h", F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEADS)).cast("int")), "heads"
    )
    givers = heads.where(F.pmod("conv_id", F.lit(SHARED)) == 0).select(
        F.col("conv_id").alias("_giver"), F.col("heads").alias("given")
    )
    given = F.slice(F.coalesce("given", F.array().cast(heads.schema["heads"].dataType)), F.lit(1), F.col("h"))
    digest = lambda turns, n: F.when(n > 0, F.element_at(turns, F.when(n > 0, n).otherwise(1)).getField("after")).otherwise(F.lit(ROOT))
    facts = (
        heads.join(givers, F.col("conv_id") - F.pmod("conv_id", F.lit(SHARED)) == F.col("_giver"), "left")
        .withColumn("given", given)
        .withColumn("taken", F.size("given"))
        .withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
        .withColumn("shared", digest(F.col("given"), F.col("taken")))
        .withColumn("left", F.when(F.col("n") > F.col("h"), digest(F.col("heads"), F.col("h"))))
        .drop("_giver", "heads")
    )
    facts = keep(facts, "conversations")
    in_front = facts.select("conv_id", "length", F.explode("given").alias("turn")).select(
        F.col("turn.after").alias("node"), F.col("turn.before").alias("parent"), F.col("turn.place").alias("depth"),
        F.col("turn.n_chars").alias("n_chars"), "conv_id", (F.col("turn.place") == F.col("length")).alias("is_end"),
    )
    # Facts go to each task's share of a conversation, so a conversation of any length stays spread.
    behind = facts.where("n > h").select("conv_id", "h", "taken", "length", "shared", "left")
    shares = own.select("conv_id", "_task").distinct().join(behind, "conv_id")
    depth = F.col("taken") + F.col("place") - F.col("h")
    own_rows = own.join(shares, ["conv_id", "_task"]).where("place > h").withColumns(
        {"depth": depth, "is_end": depth == F.col("length")}
    )
    rows = own_rows.select("place", "before", "after", "h", "shared", "left", "depth", "n_chars", "conv_id", "is_end").mapInArrow(
        _rebuilt_own, "node binary, parent binary, depth long, n_chars long, conv_id long, is_end boolean"
    )
    return keep(in_front.unionByName(rows), "rebuilt"), facts.select("conv_id", "length")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Comma-joined ids of a node, a few kilobytes to a row; rows come sorted."""
    node, ids, size, first = None, [], 0, None
    out: list[tuple] = []
    for batch in batches:
        for own, conv in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            if ids and (own != node or size >= _PIECE):
                out.append((node, first, ",".join(ids)))
                ids, size = [], 0
            if not ids:
                node, first = own, conv
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        yield _piece_rows(out)
        out = []
    if ids:
        yield _piece_rows([(node, first, ",".join(ids))])


def _piece_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, (pa.binary(), pa.int64(), pa.string()), strict=True)],
        ["node", "first", "piece"],
    )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    node, state = None, None
    for batch in batches:
        done = []
        for own, piece in zip(batch.column("node").to_pylist(), batch.column("piece").to_pylist(), strict=True):
            if own != node:
                if state is not None:
                    done.append((node, state.hexdigest()))
                node, state = own, sha256()
            else:
                state.update(b",")
            state.update(piece.encode())
        yield _hash_rows(done)
    if state is not None:
        yield _hash_rows([(node, state.hexdigest())])


def _hash_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[], []]
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.string())], ["node", "ends_sha256"]
    )


def end_digests(ends: DataFrame, tasks: int) -> DataFrame:
    """(node, ends_sha256) from (node, conv_id). Ids are sorted and joined all over the cluster; only the
    hashing itself, which has an order, streams through one task per node, in constant memory."""
    pieces = ends.repartitionByRange(tasks, "node", "conv_id").sortWithinPartitions("node", "conv_id").mapInArrow(
        _pieces, "node binary, first long, piece string"
    )
    return pieces.repartition(tasks, "node").sortWithinPartitions("node", "first").mapInArrow(
        _hashed, "node binary, ends_sha256 string"
    )


def _arc(node: str, leaves: bool) -> Column:
    return F.concat(F.col(node), F.lit(b"\x01" if leaves else b"\x00"))


def prefix_trie(conversations: DataFrame, rest: int | None = None) -> DataFrame:
    """One row per distinct sequence of first turns of the rebuilt conversations, see :func:`rebuilt_rows`.

    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256. Null role or text is an empty
    one; rows without conv_id belong to no conversation and are left out; rows that repeat are turns of
    their own; a null turn comes first. A conversation without turns after the rebuilding ends at the
    root. Texts of any length enter by digest. An empty table has no trie, not even a root. Other columns are
    ignored, whatever their names. Sequences are told apart by 127-bit digests.
    """
    rows, facts = rebuilt_rows(conversations)
    tasks = partitions_of(rows)
    # A node's members are counted where they lie; every conversation has a node once.
    inner = rows.groupBy("node", "parent", "depth", "n_chars").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")
    )
    root = facts.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0").select(
        F.lit(ROOT).alias("node"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"),
        F.lit(0).cast("long").alias("n_chars"), "n_convs", "conv_id",
    )
    nodes = keep(inner.unionByName(root).withColumn("_share", F.pmod(F.xxhash64("node"), F.lit(tasks))), "nodes")

    # Children are linked inside shares of their parent, and the shares one after the other.
    in_share = Window.partitionBy("parent", "_share").orderBy("node")
    linked = nodes.where("parent is not null").select(
        "node", "parent", "_share", "conv_id", F.lead("node").over(in_share).alias("_later"),
        F.row_number().over(in_share).alias("_nth"),
    )
    linked = keep(linked, "siblings")
    sizes = linked.groupBy("parent", "_share").agg(F.count("*").alias("_n"))
    of_parent = Window.partitionBy("parent").orderBy("_share")
    shares = (
        linked.where("_nth = 1").select("parent", "_share", F.col("node").alias("_first"))
        .join(sizes, ["parent", "_share"])
        .select(
            "parent", "_share", "_first", F.lead("_first").over(of_parent).alias("_next_share"),
            F.row_number().over(of_parent).alias("_nth"), F.sum("_n").over(Window.partitionBy("parent")).alias("n_children"),
        )
    )
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    shares = keep(shares.join(parents, "parent"), "shares")
    firsts = shares.where("_nth = 1").select(F.col("parent").alias("node"), F.col("_first").alias("_child"), "n_children")
    answers = shares.select("parent", "_share", "_next_share", "parent_conv_id")
    siblings = linked.join(answers, ["parent", "_share"]).select(
        "node", F.coalesce("_later", "_next_share").alias("_sibling"), "parent_conv_id"
    )
    tree = keep(nodes.drop("_share").join(siblings, "node", "left").join(firsts, "node", "left"), "tree")

    childless = F.col("_child").isNull()
    zero = F.lit(0).cast("long")
    enter = tree.select(
        _arc("node", False).alias("id"), F.when(childless, _arc("node", True)).otherwise(_arc("_child", False)).alias("next"),
        childless.cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("n_chars")).alias("saved"),
    )
    leave = tree.select(
        _arc("node", True).alias("id"),
        F.when(F.col("_sibling").isNotNull(), _arc("_sibling", False)).when(F.col("parent").isNotNull(), _arc("parent", True)).alias("next"),
        zero.alias("leaves"), zero.alias("saved"),
    )
    sums = suffix_sums(enter.unionByName(leave), ["leaves", "saved"], **({} if rest is None else {"rest": rest}))
    sign = F.when(F.substring("id", 17, 1) == F.lit(b"\x00"), 1).otherwise(-1)
    spans = sums.groupBy(F.substring("id", 1, 16).alias("node")).agg(
        F.sum(sign * F.col("leaves")).alias("n_leaves"), F.sum(sign * F.col("saved")).alias("saved_tokens")
    )
    ends = rows.where("is_end").select("node", "conv_id").unionByName(
        facts.where("length = 0").select(F.lit(ROOT).alias("node"), "conv_id")
    )
    return (
        tree.join(spans, "node").join(end_digests(ends, tasks), "node", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"),
            "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(_NOBODY)).alias("ends_sha256"),
        )
    )
