"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

In byte-pair encoding every prefix of a piece has exactly one last token. An automaton over all
token strings with suffix links reports, for every end position, the tokens that are suffixes of
the prefix, longest first. The one that may follow the last token of the remaining prefix (a
test on the pair alone) is stored; back-pointers then give the ids.

Two neighbours are compatible when no merge crosses their border. Undoing merges from the
latest to the earliest on both sides of the border shows every pair of parts that ever met there;
the pair is refused if such parts have a rule that comes before the merges that took them away.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import ahocorasick
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from limitlens.llm.tables import whole_text
from limitlens.llm.words import _CHUNKS, _OTHER_SPACE, byte_letters

# Kept per worker, for speed only.
CACHED_CHUNKS, CACHED_PIECES, CACHED_PAIRS = 300_000, 300_000, 600_000
_NEVER = 1 << 60
# White space as Unicode has it (\s would add the four ASCII separators).
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


class PrefixBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        bytes_of = {letter: b for b, letter in enumerate(byte_letters())}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        vocab = {k: v for k, v in spec["model"]["vocab"].items() if k not in special}

        self.text: dict[int, bytes] = {i: bytes(map(bytes_of.__getitem__, s)) for s, i in vocab.items()}
        self.ids = {b: i for i, b in self.text.items()}
        self.size = {i: len(b) for i, b in self.text.items()}
        self.special = special
        self.text |= {i: s.encode() for s, i in special.items()}

        # Rule of a pair, and for every token the rule that makes it with its two parts.
        self.rule: dict[tuple[int, int], int] = {}
        self.made: dict[int, int] = {i: -1 for i, n in self.size.items() if n == 1}
        self.parts: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            pair, whole = (vocab[left], vocab[right]), vocab[left + right]
            self.rule[pair] = rank
            if whole not in self.made:
                self.made[whole], self.parts[whole] = rank, pair

        # A token that its own text does not encode to never appears.
        self.valid = {i: True for i, rank in self.made.items() if rank < 0}
        for token, (left, right) in self.parts.items():
            self.valid[token] = (
                self.valid.get(left, False) and self.valid.get(right, False)
                and not self._crossed(left, right, self.made[token])
            )

        self.suffixes = ahocorasick.Automaton()
        for i, text in self.text.items():
            if i in self.size and self.valid.get(i, False):
                self.suffixes.add_word(text.decode("latin-1"), i)
        self.suffixes.make_automaton()

        space = public_tokenizers.PATTERN.replace(r"[^\s", f"[^{_SPACE}")
        space = space.replace(r"(?!\S)", f"(?![^{_SPACE}])").replace(r"\s+", f"[{_SPACE}]+")
        self.pieces = regex.compile(space)
        self.cut = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.chunks: dict[str, tuple[int, ...]] = {}
        self.known: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}

    def _crossed(self, left: int, right: int, limit: int = _NEVER) -> bool:
        """Whether a rule before ``limit`` merges across the border of two neighbours."""
        rule, made, parts = self.rule, self.made, self.parts
        left_gone = right_gone = limit  # when the current parts are taken away
        while True:
            rank = rule.get((left, right))
            # Of equal rules the one further left is applied first.
            if rank is not None and rank < left_gone and rank <= right_gone and rank < limit:
                return True
            if made[right] >= made[left]:
                if made[right] < 0:
                    return False
                right_gone, right = made[right], parts[right][0]
            else:
                left_gone, left = made[left], parts[left][1]

    def compatible(self, left: int, right: int) -> bool:
        found = self.pairs.get((left, right))
        if found is None:
            found = not self._crossed(left, right)
            if len(self.pairs) < CACHED_PAIRS:
                self.pairs[left, right] = found
        return found

    def encode_piece(self, piece: bytes) -> tuple[int, ...]:
        last: list[int | None] = [None] * (len(piece) + 1)
        size, valid, compatible = self.size, self.valid, self.compatible
        for end, token in self.suffixes.iter(piece.decode("latin-1")):
            if last[end + 1] is not None:
                continue
            start = end + 1 - size[token]
            if not start:
                if valid[token]:
                    last[end + 1] = token
            elif last[start] is not None and compatible(last[start], token):
                last[end + 1] = token
        out, at = [], len(piece)
        while at:
            out.append(last[at])
            at -= size[last[at]]
        return tuple(reversed(out))

    def _piece(self, piece: str) -> tuple[int, ...]:
        found = self.known.get(piece)
        if found is None:
            found = self.encode_piece(piece.encode())
            if len(self.known) < CACHED_PIECES:
                self.known[piece] = found
        return found

    def _chunk(self, chunk: str) -> tuple[int, ...]:
        found = self.chunks.get(chunk)
        if found is None:
            found = tuple(chain.from_iterable(map(self._piece, self.pieces.findall(chunk))))
            if len(self.chunks) < CACHED_CHUNKS:
                self.chunks[chunk] = found
        return found

    def encode(self, text: str) -> list[int]:
        """The ids of a text; a special token's text is that token."""
        ids: list[int] = []
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.special:
                ids.append(self.special[part])
            elif _OTHER_SPACE.search(part):  # a cut at white space could matter
                for piece in self.pieces.findall(part):
                    ids += self.encode_piece(piece.encode())
            else:
                ids += chain.from_iterable(map(self._chunk, _CHUNKS.findall(part)))
        return ids

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.text.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def prefix_bpe(path: str) -> PrefixBpe:
    """One encoder per worker process and vocabulary."""
    return PrefixBpe(path)


def _round_trip(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = prefix_bpe(path)
        names = {i: str(i) for i in bpe.text}
        for batch in batches:
            counts, id_digests, text_digests = [], [], []
            for value in batch.column("text"):
                ids = bpe.encode(value.as_py())
                counts.append(len(ids))
                id_digests.append(sha256(",".join(map(names.__getitem__, ids)).encode()).hexdigest())
                text_digests.append(sha256(bpe.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(id_digests, pa.string()),
                 pa.array(text_digests, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return run


def _ids(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = prefix_bpe(path)
        for batch in batches:
            ids = [bpe.encode(v.as_py()) for v in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
            )

    return run


def encode_documents(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id and the array of ids of every whole text (null: empty, no ids). Row by row."""
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    rows = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    return rows.mapInArrow(_ids(path), "doc_id long, ids array<int>")


def round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text, encoded and decoded again.

    Null text counts as empty: no ids, and the digest of the empty string twice. Every row is
    handled alone, so repeated rows, missing ids and empty tables need no rule.
    """
    path = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    rows = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    return rows.mapInArrow(
        _round_trip(path), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
