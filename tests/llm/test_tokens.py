"""Token ids: the library's own encoder, exact round trips, random access, packing by brute force."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from llm_cases import SF_DIR, docs_of, odd_documents, texts_of
from tokenizers import Tokenizer

from limitlens.llm import bpe, direct_codes, packing, queries
from limitlens.llm.tables import scratch
from limitlens.llm.words import _CHUNKS, WordEncoder, encoder, stretches

STRANGE = [
    "", "a", " a", "a ", "a  b", "\n\nx", " \n y", "don't I'LL x's", "<|endoftext|> hi <|ENDOFTEXT|>",
    "a\xa0b\x1cc !\x1c", "\xa0\n b", "漢字 テスト 😀 x", "foo\r\n bar\t\tbaz.", "a  c　d", "xq" * 3000,
    "ΟΔΟΣ Σας", "İstanbul", "é é", "µ ªº ß. ÀÉ!", "\n", "   ", "12 345,6.7",
]


def library(name):
    return Tokenizer.from_file(public_tokenizers.path(name))


def random_texts(n=400):
    rng = random.Random(5)
    letters = "abcdeiou aé 12.,'\n漢"
    return ["".join(rng.choices(letters, k=rng.randint(1, 200))) for _ in range(n)]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_word_by_word_equals_the_library(name):
    path, whole = public_tokenizers.path(name), library(name)
    for text in STRANGE + random_texts():
        ids = whole.encode(text, add_special_tokens=False).ids
        assert encoder(path).ids(text) == np.asarray(ids, "<u4").tobytes(), text


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_latin_stretches_reach_the_model_without_the_whole_encoder(name, monkeypatch):
    mine, whole, calls = WordEncoder(public_tokenizers.path(name)), library(name), []
    monkeypatch.setattr(mine, "_encode", lambda text: calls.append(text) or WordEncoder._encode(mine, text))
    rng = random.Random(8)
    latin = [chr(c) for c in [*range(32, 127), *range(0xA1, 0x100), 9, 10, 13]]
    texts = [
        'call +1 (017) 555-7713, or und.34@mail7.example.com', 'a = "04dbebab91" | 3rd###', "don't I'LL ''s 's 12's",
        "für äöü. ½² ªµº×÷ß\xad", "\n(x)\r\n\n 12 \t.", *["".join(rng.choices(latin, k=rng.randint(1, 30))) for _ in range(2000)],
    ]
    for text in texts:
        ids = whole.encode(text, add_special_tokens=False).ids
        assert mine.ids(text) == np.asarray(ids, "<u4").tobytes(), text
    assert calls == []


def test_stretches_begin_with_their_blanks():
    for text in [t for t in STRANGE + random_texts() if "\x1f" not in t]:
        assert [s for s in stretches(text) if s] == _CHUNKS.findall(text), text


def test_prefix_encoder_equals_the_library_and_decodes():
    mine, whole = bpe.prefix_bpe(public_tokenizers.path("byte_bpe_50k.json")), library("byte_bpe_50k.json")
    runs = ["a" * n for n in range(1, 40)] + [" " * n + "b" for n in range(20)] + ["-" * n for n in range(90)]
    for text in STRANGE + random_texts() + runs:
        ids = whole.encode(text, add_special_tokens=False).ids
        assert mine.encode(text) == ids, text
        assert mine.decode(ids) == text
    broken = mine.encode("漢字")[:-1]
    assert mine.decode(broken) == whole.decode(broken, skip_special_tokens=False)


def test_codes_give_any_id_directly():
    rng = np.random.default_rng(3)
    ids = np.concatenate([
        rng.integers(0, 200, 700), rng.integers(0, 50_000, 2000), [0, 255, 256, 65_535, 65_536, 2**32 - 1],
        rng.integers(0, 2**32, 1500),
    ]).astype(np.uint32)
    codes = direct_codes.Codes.of(ids)
    assert [codes.at(i) for i in range(len(ids))] == ids.tolist()
    for a, b in [(0, len(ids)), (5, 5), (511, 513), (1000, 1700), (len(ids) - 1, len(ids))]:
        assert codes.between(a, b).tolist() == ids[a:b].tolist()


def test_a_segment_is_read_level_by_level(monkeypatch):
    rng = np.random.default_rng(4)
    lengths = rng.integers(1, 40, 500).tolist()
    ids = rng.integers(0, 50_000, sum(lengths)).astype("<u4")
    content = direct_codes.segment(3, list(range(500)), lengths, ids) + b"\n"
    entered, between = [], direct_codes.Codes.between
    monkeypatch.setattr(
        direct_codes.Codes, "between", lambda self, start, stop: entered.append(start) or between(self, start, stop)
    )
    batch = pa.RecordBatch.from_arrays([pa.array([content * 2], pa.binary())], ["content"])
    found = [r for b in direct_codes._read_segments([batch]) for r in b.to_pylist()]
    assert len(entered) == 2  # two segments
    at, stops = 0, np.cumsum(lengths).tolist()
    for i, r in enumerate(found):
        own = ids[stops[i % 500] - lengths[i % 500] : stops[i % 500]]
        assert r == {"shard": 3, "doc_id": i % 500, "inside": at, "n_tokens": len(own), "ids_crc32": zlib.crc32(own.tobytes())}
        at += len(own)


def expected_store(rows):
    whole, out, start = library("word_bpe_49k.json"), [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.asarray([*whole.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_stored_ids(spark):
    rows = texts_of(SF_DIR)
    found = queries.QUERIES["op4_direct_codes"](spark, SF_DIR).collect()
    assert sorted(tuple(r) for r in found) == expected_store(rows)


def test_stored_ids_of_odd_documents(spark, monkeypatch):
    monkeypatch.setattr(direct_codes, "SEGMENT_IDS", 50)
    df, rows = odd_documents(spark)
    found = direct_codes.stored_ids(df).collect()
    assert sorted((tuple(r) for r in found), key=lambda r: r[1]) == expected_store(rows)
    assert direct_codes.stored_ids(df.limit(0)).collect() == []


def test_prefix_query(spark):
    from hashlib import sha256

    whole = library("byte_bpe_50k.json")
    digest = lambda text: sha256(text.encode()).hexdigest()
    for found, rows in [
        (queries.QUERIES["op7_prefix_bpe"](spark, SF_DIR), texts_of(SF_DIR)),
        (bpe.round_trip(odd_documents(spark)[0]), odd_documents(spark)[1]),
    ]:
        wanted = []
        for doc_id, text in rows:
            ids = whole.encode(text or "", add_special_tokens=False).ids
            wanted.append((doc_id, len(ids), digest(",".join(map(str, ids))), digest(text or "")))
        assert sorted(map(str, (tuple(r) for r in found.collect()))) == sorted(map(str, wanted))
    assert bpe.round_trip(docs_of(spark, [])).collect() == []
    assert bpe.encode_documents(docs_of(spark, [(1, "a b"), (2, None)])).orderBy("doc_id").collect()[1]["ids"] == []


def check_packing(found, rows, capacity=1024):
    whole = library("byte_bpe_50k.json")
    wanted = defaultdict(list)
    for doc_id, text in rows:
        wanted[doc_id].append(np.asarray([*whole.encode(text or "", add_special_tokens=False).ids, 0], "<u4"))
    got = defaultdict(list)
    sequences = defaultdict(list)
    for r in found:
        got[r["doc_id"]].append((r["doc_tokens"], r["start"], r["length"], r["ids_crc32"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert got.keys() == wanted.keys()
    for doc_id, texts in wanted.items():
        pieces = [
            (len(ids), at, len(ids[at : at + capacity]), zlib.crc32(ids[at : at + capacity].tobytes()))
            for ids in texts for at in range(0, len(ids), capacity)
        ]
        assert sorted(got[doc_id]) == sorted(pieces)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return sum(n for s in sequences.values() for _, n in s) / (capacity * len(sequences))


def test_packing_query(spark):
    found = queries.QUERIES["op10_packing"](spark, SF_DIR).collect()
    assert check_packing(found, texts_of(SF_DIR)) > 0.97


def test_packing_odd_documents(spark):
    df, rows = odd_documents(spark)
    check_packing(packing.pack(df).collect(), rows)
    check_packing(packing.pack(df, capacity=8, group_docs=2).collect(), rows, 8)
    assert packing.pack(df.limit(0)).collect() == []


def test_first_fit_decreasing_by_brute_force():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 17, 300):
        sizes = np.sort(rng.integers(1, 101, n))[::-1]
        numbers, offsets = packing.first_fit_decreasing(sizes, 100)
        room = [100] * n
        for i, size in enumerate(sizes):
            bin_ = next(b for b in range(n) if room[b] >= size)
            assert (numbers[i], offsets[i]) == (bin_, 100 - room[bin_])
            room[bin_] -= size


@pytest.mark.parametrize("doc_id", [None, 7])
def test_rows_without_an_id_of_their_own_spread(spark, doc_id, monkeypatch):
    """Missing or repeated ids, half of the texts equal: no group and no file gathers them."""
    rows = [(doc_id, "the same words" if i % 2 else f"words of text {i} " * (i % 5)) for i in range(3000)]
    df = docs_of(spark, rows).repartition(4)
    packed = packing.pack(df, group_docs=300).collect()
    check_packing(packed, rows)
    groups = Counter(r["sequence_id"] % 10 for r in packed)  # ten groups
    assert len(groups) == 10 and max(groups.values()) < 450
    folder = scratch(spark, "ids")
    monkeypatch.setattr(direct_codes, "partitions_of", lambda docs: 8)
    direct_codes.write_ids(df, folder)
    found = direct_codes.read_ids(spark, folder).orderBy("start").collect()
    assert Counter((r["n_tokens"], r["ids_crc32"]) for r in found) == Counter((n, c) for _, _, n, c in expected_store(rows))
    at = 0
    for r in found:
        assert r["start"] == at
        at += r["n_tokens"]
    files = spark.read.format("binaryFile").load(folder).select("content").collect()
    held = [sum(len(docs) for _, docs, _, _ in direct_codes.segments(bytes(f["content"]))) for f in files]
    assert sum(held) == 3000 and max(held) < 900


def test_a_long_text_is_packed_by_many_groups(spark):
    rows = [(1, "word " * 20_000), *[(i, "a b c") for i in range(2, 60)]]
    packed = packing.pack(docs_of(spark, rows), capacity=64, group_docs=6).collect()
    check_packing(packed, rows, 64)
    full = Counter(r["sequence_id"] % 10 for r in packed if r["length"] == 64)
    assert len(full) == 10 and max(full.values()) < 3 * min(full.values())
