"""The prefix trie against plain dictionaries, and list ranking against a walk."""

import random
from collections import defaultdict
from hashlib import sha256
from zlib import crc32

import duckdb
import pytest
from llm_cases import SF_DIR

from limitlens.llm import prefix_trie as module
from limitlens.llm.list_ranking import suffix_sums
from limitlens.llm.prefix_trie import prefix_trie


def trie_of(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = sha256(f"{len(role)}\n{role}\n{text}".encode()).hexdigest()[:30]
            found[conv].append((turn is not None, turn or 0, tie, (role, text)))
    own = {c: [t[3] for t in sorted(turns)] for c, turns in found.items()}
    whole = {}
    for conv, turns in own.items():
        h = crc32(str(conv).encode()) % 6
        whole[conv] = own.get(conv - conv % 100, [])[:h] + turns[h:]
    members, children = defaultdict(list), defaultdict(list)
    for conv, turns in whole.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        leaves[path] = sum(leaves[c] for c in children[path]) or 1
        saved[path] = sum(saved[c] for c in children[path])
        saved[path] += (len(members[path]) - 1) * len(path[-1][1]) if path else 0
    return [
        (min(ids), len(path), min(members[path[:-1]]) if path else None, len(ids), len(children[path]), leaves[path], saved[path],
         sha256(",".join(str(c) for c in sorted(ids) if len(whole[c]) == len(path)).encode()).hexdigest())
        for path, ids in members.items()
    ]


SCHEMA = "conv_id long, turn long, role string, text string, node string, _task int, depth double"


def compare(spark, rows, rest=20):
    frame = spark.createDataFrame([(*r, "x", 1, 0.5) for r in rows], SCHEMA).repartition(4)
    found = [tuple(r) for r in prefix_trie(frame, rest).collect()]
    assert sorted(found, key=str) == sorted(trie_of(rows), key=str)


def test_given_conversations(spark):
    rows = duckdb.connect().execute(f"select conv_id, turn, role, text from '{SF_DIR}/conversations.parquet'").fetchall()
    compare(spark, rows)


def test_ties_nulls_negative_ids_and_long_conversations(spark, monkeypatch):
    # Each task takes a few rows, so that the long conversations run through many of them.
    monkeypatch.setattr(module, "partitions_of", lambda df: 7)
    rnd = random.Random(5)
    ids = [None, -150, -100, -1, 0, *range(1, 20), 100, 205, 206]
    rows = [
        (rnd.choice(ids), rnd.choice([None, 0, 1, 2, 3]), rnd.choice([None, "u", "a"]), rnd.choice([None, "", "x", "yy", "😀é"]))
        for _ in range(150)
    ]
    rows += [(7, i // 3, "u", f"t{i % 2}") for i in range(300)]  # a third of all rows
    rows += [(8, 1, "u", "same")] * 150 + [(9, 1, "ab", "c"), (10, 1, "a", "bc"), (300, 0, "u", "z" * 100_000)]
    rows += [(400 + i, t, "u", "common") for i in range(30) for t in range(3)]
    compare(spark, rows)


@pytest.mark.parametrize("rows", [[], [(None, 1, "u", "x")], [(100, None, None, None)], [(201, 0, "u", "x")]])
def test_small_tables(spark, rows):
    compare(spark, rows)


def test_id_lists_longer_than_a_piece(spark, monkeypatch):
    monkeypatch.setattr(module, "_PIECE", 16)
    compare(spark, [(i * 100, 0, "u", "hello") for i in range(60)])


def test_list_ranking(spark):
    rnd, links, want = random.Random(2), [], {}
    for length in (1, 2, 700):
        ids = [rnd.randbytes(6) for _ in range(length)]
        total = 0
        for at in range(length - 1, -1, -1):
            weight = rnd.randint(-5, 9)
            total += weight
            links.append((ids[at], ids[at + 1] if at + 1 < length else None, weight))
            want[ids[at]] = total
    rnd.shuffle(links)
    frame = spark.createDataFrame(links, "id binary, next binary, w long")
    found = {bytes(r.id): r.w for r in suffix_sums(frame, ["w"], rest=40).collect()}
    assert found == want
