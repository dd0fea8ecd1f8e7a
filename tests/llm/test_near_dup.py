"""Near-duplicates against brute force over the full shingle sets."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import SF_DIR, docs_of, odd_documents, texts_of

from limitlens.llm import near_dup, queries

WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def shingles(text, words):
    found = WORDS.findall((text or "").encode().lower())
    if len(found) < words:
        return frozenset([tuple(found)]) if found else frozenset()
    return frozenset(zip(*[found[i:] for i in range(words)]))


def expected(rows, words, percent):
    """Rows are nodes of their own; a component is named by its smallest id."""
    sets = [shingles(t, words) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    holders = defaultdict(list)
    for i, own in enumerate(sets):
        overlaps = Counter(j for s in own for j in holders[s])
        for s in own:
            holders[s].append(i)
        for j, both in overlaps.items():
            if 100 * both >= percent * (len(own) + len(sets[j]) - both):
                root[find(i)] = find(j)
    names = {}
    for i, (doc_id, _) in enumerate(rows):
        known = names.get(find(i))
        names[find(i)] = doc_id if known is None else known if doc_id is None else min(known, doc_id)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        name = names[find(i)] if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), name, doc_id == name))
    return sorted(map(str, out))


def found(df):
    return sorted(str(tuple(r)) for r in df.collect())


def near_copies(copies=70, seed=4):
    """A group of near copies with 0 to 30 changed words, a chain, and unrelated texts with one passage."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    base = rng.choices(vocabulary, k=260)
    passage = rng.choices(vocabulary, k=60)
    rows = []
    for _ in range(copies):
        text = list(base)
        for at in rng.sample(range(260), rng.choice([0, 1, 2, 4, 6, 8, 12, 20, 30])):
            text[at] = rng.choice(vocabulary)
        rows.append(" ".join(text))
    chain = rng.choices(vocabulary, k=300)
    for step in range(8):
        rows.append(" ".join(chain[6 * step : 6 * step + 250]))
    rows += [" ".join(passage + rng.choices(vocabulary, k=120)) for _ in range(70)]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("short, block, words, percent", [(64, 256, 3, 85), (3, 16, 5, 80)])
def test_near_copies_both_ways(spark, monkeypatch, short, block, words, percent):
    monkeypatch.setattr(near_dup, "SHORT_LIST", short)
    monkeypatch.setattr(near_dup, "BLOCK", block)
    monkeypatch.setattr(near_dup, "_SLAB", 100)
    rows = near_copies()
    assert found(near_dup.near_duplicates(docs_of(spark, rows).repartition(4), words, percent)) == expected(
        rows, words, percent
    )


def test_query(spark):
    assert found(queries.QUERIES["op9_near_duplicates"](spark, SF_DIR)) == expected(texts_of(SF_DIR), 3, 85)


def test_odd_documents(spark):
    df, rows = odd_documents(spark)
    assert found(near_dup.near_duplicates(df, 3, 85)) == expected(rows, 3, 85)


def test_no_documents_and_no_words(spark):
    assert near_dup.near_duplicates(docs_of(spark, [])).collect() == []
    rows = [(1, ""), (2, None), (3, " \n"), (4, None)]
    assert found(near_dup.near_duplicates(docs_of(spark, rows))) == expected(rows, 5, 80)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 200), (7, 7)]
    df = spark.createDataFrame([(bytearray([a]), bytearray([b])) for a, b in edges], "a binary, b binary")
    got = {r["node"][0]: r["root"][0] for r in near_dup.components(df).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, 200: 200, 201: 200}


def test_sure_overlap_is_a_binomial_tail():
    rng = np.random.default_rng(2)
    least = rng.binomial(near_dup.LISTED, 0.85, 2_000_000).min()
    assert near_dup.sure_overlap(85) <= least
    assert near_dup.sure_overlap(100) == near_dup.LISTED


def test_estimate_keeps_pairs_up_to_the_stated_miss():
    import math

    import numpy as np
    import pyarrow as pa

    from limitlens.llm import near_dup

    for percent in (80, 85):
        p, size = percent / 100, near_dup.SKETCH
        tail = [sum(math.comb(size, i) * p**i * (1 - p) ** (size - i) for i in range(k)) for k in range(size + 1)]
        least = max(k for k in range(size + 1) if tail[k] <= 1e-12)
        for both in (least, least - 1):
            alone = (size - both) // 2
            a = np.arange(both + alone)
            b = np.concatenate([np.arange(both), np.arange(500, 500 + size - both - alone)])
            pair = pa.table({
                "a": pa.array([b"a"]), "b": pa.array([b"b"]), "n_a": [1000], "n_b": [1000],
                "s_a": pa.array([np.append(a, np.arange(1000, 1020)).tolist()], pa.list_(pa.int64())),
                "s_b": pa.array([np.append(b, np.arange(2000, 2020)).tolist()], pa.list_(pa.int64())),
            }).to_batches()
            (kept,) = near_dup._estimated(percent)(pair)
            assert kept.num_rows == (both == least), (percent, both)
