import hashlib
import random

import numpy as np
import pytest
from llm_cases import SF_DIR, docs_of, odd_documents, texts_of

from limitlens.llm import queries, syncmers


def plain_anchors(text, k, s):
    """By definition, with the module's own hash of an s-mer."""
    places = []
    for i in range(len(text) - k + 1):
        inner = [int(syncmers._mix(syncmers._rolling(codes(text[i + j : i + j + s]), s))[0]) for j in range(k - s + 1)]
        if min(inner) in (inner[0], inner[-1]):
            places.append(i)
    return places


def codes(text):
    return np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)


def test_selection_by_definition():
    rng = random.Random(1)
    for length in (0, 19, 20, 21, 40, 150):
        text = "".join(rng.choices("abcé 漢", k=length))
        places, hashes = syncmers.anchors_of(text)
        assert places.tolist() == plain_anchors(text, syncmers.K, syncmers.S)
        assert len(hashes) == len(places)


def test_anchors_keep_their_hash_when_text_moves():
    rng = random.Random(2)
    text = "".join(rng.choices("abcdef ", k=400))
    a, h = syncmers.anchors_of(text)
    b, g = syncmers.anchors_of("new words first " + text)
    moved = dict(zip((b - 16).tolist(), g.tolist(), strict=True))
    assert all(moved[p] == x for p, x in zip(a.tolist(), h.tolist(), strict=True))


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for i, (doc_id, text) in enumerate(order):
        own, other = text or "", order[(i + 1) % len(order)][1] or ""
        third = len(own) // 3
        edited = own[: len(own) - third] + other[:third]
        a, b, c = map(syncmers.sketch_of, (own, edited, other))
        out.append((doc_id, len(own), hashlib.sha256(edited.encode()).hexdigest(), syncmers.fingerprint_of(a),
                    syncmers.fingerprint_of(b), syncmers.likeness(a, b), syncmers.likeness(a, c)))
    return sorted(map(str, out))


@pytest.mark.parametrize("partitions", [1, 6])
def test_odd_documents(spark, partitions):
    df, rows = odd_documents(spark)
    assert sorted(str(tuple(r)) for r in syncmers.fingerprints(df.repartition(partitions)).collect()) == expected(rows)


def test_few_documents(spark):
    assert syncmers.fingerprints(docs_of(spark, [])).collect() == []
    for rows in ([(5, "one text " * 9)], [(None, "no id")], [(1, None), (2, "")]):
        assert sorted(str(tuple(r)) for r in syncmers.fingerprints(docs_of(spark, rows)).collect()) == expected(rows)


def test_query_tells_edited_texts_from_others(spark):
    found = queries.QUERIES["op8_closed_syncmers"](spark, SF_DIR).collect()
    assert sorted(str(tuple(r)) for r in found) == expected(texts_of(SF_DIR))
    long = [r for r in found if r["n_chars"] > 1000]
    assert np.median([r["near_edited"] for r in long]) > 0.4 and np.median([r["near_next"] for r in long]) < 0.05


def test_positions_of_anchors(spark):
    rows = [(1, "some words to select anchors from " * 3), (2, None)]
    found = syncmers.anchors(docs_of(spark, rows)).collect()
    assert {r["doc_id"] for r in found} == {1}
    assert sorted(r["position"] for r in found) == syncmers.anchors_of(rows[0][1])[0].tolist()
