"""Encoding whole texts with the tokenizers library, word by word.

A tokenizer's ids of a text are the ids of its stretches between white space, one after the
other, so ids of recurring stretches are kept per Python worker (a bounded dictionary, which
changes speed only). Latin-1 stretches are cut into pieces by the tokenizer's own pattern and go
piece by piece to the library's BPE model; anything else goes through the library's whole
encoder. Texts in which a cut at white space could matter are encoded whole.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import public_tokenizers
from tokenizers import Tokenizer

CACHED = 400_000
ID_BYTES = 4  # ids are little-endian unsigned 32-bit integers

_CHUNKS = re.compile(r"[ \n\t\r]*[^ \n\t\r]+|[ \n\t\r]+")
# White space beyond the cut set, and separators that Python's split() takes for it.
_OTHER_SPACE = re.compile(
    r"[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
)
_LATIN_OTHER_SPACE = "\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"
_BLANKS = " \n\t\r"
_CUT = "\x1f"  # in no text that is cut
# The letters and numbers among Latin-1.
_LETTERS, _NUMBERS = "A-Za-zªµº\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9²³¹¼½¾"


def byte_letters() -> list[str]:
    """The byte-level alphabet: printable Latin-1 stands for itself, the rest follows from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, extra = {b: chr(b) for b in plain}, 256
    for b in range(256):
        if b not in table:
            table[b] = chr(extra)
            extra += 1
    return [table[b] for b in range(256)]


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _other_space(text: str) -> bool:
    if _latin(text):  # looking for single characters is much faster than the pattern
        return any(space in text for space in _LATIN_OTHER_SPACE)
    return _OTHER_SPACE.search(text) is not None


def stretches(text: str) -> list[str]:
    """The text cut before every run of blanks; empty first if it begins with one."""
    for blank in _BLANKS:
        text = text.replace(blank, _CUT + blank)
    for blank in _BLANKS:
        text = text.replace(blank + _CUT, blank)
    return text.split(_CUT)


def _latin_pattern(path: str) -> re.Pattern[str] | None:
    """What cuts Latin-1 into the tokenizer's pieces: the pattern of its file; None if that is of another kind."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)["pre_tokenizer"] or {}
    steps = spec.get("pretokenizers", [spec])
    first = steps[0]
    if first.get("type") == "Split" and first["invert"] and first["behavior"] == "Removed" and len(steps) == 2:
        pattern, rest = first["pattern"].get("Regex"), steps[1]
        if rest["type"] != "ByteLevel" or rest["use_regex"] or rest["add_prefix_space"]:
            return None
    elif first.get("type") == "ByteLevel" and first["use_regex"] and not first["add_prefix_space"] and len(steps) == 1:
        pattern = public_tokenizers.PATTERN
    else:
        return None
    if not pattern:
        return None
    pattern = pattern.replace(r"[\p{L}]", r"\p{L}").replace(r"[\p{N}]", r"\p{N}")
    pattern = pattern.replace(r"[^\s\p{L}\p{N}]", rf"[^\s{_LETTERS}{_NUMBERS}]")
    pattern = pattern.replace(r"\p{L}", f"[{_LETTERS}]").replace(r"\p{N}", f"[{_NUMBERS}]")
    return None if r"\p" in pattern else re.compile(pattern)


class WordEncoder(dict):
    """``ids(text)``: the bytes of all ids. The dictionary maps a stretch to its ids' bytes."""

    def __init__(self, path: str):
        super().__init__({"": b""})
        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        self.model = self.whole.model
        letters = byte_letters()
        self.letters = {c: "".join(letters[b] for b in chr(c).encode()) for c in range(256)}
        self.packed = [i.to_bytes(ID_BYTES, "little") for i in range(max(self.whole.get_vocab().values()) + 1)]
        self.pattern = _latin_pattern(path)
        self.folds_case = self.whole.normalizer is not None
        self.special = [t.content for t in self.whole.get_added_tokens_decoder().values()]

    def _encode(self, text: str) -> bytes:
        return b"".join([self.packed[i] for i in self.whole.encode(text, add_special_tokens=False).ids])

    def _piece(self, piece: str) -> bytes:
        return b"".join([self.packed[t.id] for t in self.model.tokenize(piece.translate(self.letters))])

    def __missing__(self, chunk: str) -> bytes:
        word = chunk[1:] if not self.folds_case and chunk[0] == " " else chunk
        if not _latin(chunk):
            ids = self._encode(chunk)
        elif word.isalpha():
            ids = self._piece(chunk)
        elif self.pattern is None:
            ids = self._encode(chunk)
        else:
            pieces = self.pattern.findall(chunk)
            ids = self._piece(chunk) if len(pieces) == 1 else b"".join(map(self.__getitem__, pieces))
        if len(self) < CACHED:
            self[chunk] = ids
        return ids

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        folded = text.lower() if self.folds_case else text
        if any(s in text or s in folded for s in self.special) or _other_space(text):
            return self._encode(text)
        if self.folds_case:
            # Lower-casing Latin-1 first changes nothing else; other scripts are left to the library.
            if not _latin(text):
                return self._encode(text)
            return b"".join(map(self.__getitem__, folded.split()))
        return b"".join(map(self.__getitem__, stretches(text)))


@lru_cache(maxsize=4)
def encoder(path: str) -> WordEncoder:
    """One encoder per worker process and vocabulary."""
    return WordEncoder(path)
