"""Whole texts to token ids with the tokenizers library, word by word with a bounded cache.

Texts of characters below U+0250 are cut into words by the tokenizer's own pattern, and each different word is merged once;
for the tokenizer that drops white space many texts are cut at once, and each different word of them is looked up once.
In other texts a byte-level tokenizer never puts a token across the change from a non-blank to a blank, so the text may be cut
there, and equal parts are encoded once. A cache holds CACHE words or parts and starts anew when full; long ones are not kept. Texts
for which the cut is not provably the same (marks of special tokens inside, odd control characters) go to the library whole.
"""

from __future__ import annotations

import re
import struct
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from tokenizers import Tokenizer

CACHE = 3 << 18
KEPT_LENGTH = 64
_PART = re.compile(r"\s*\S+|\s+").findall
_LONG_BLANK = re.compile(r"\s\s(?:\s|\Z)").search
_PLAIN = re.compile("[\x00-ɏ]*").fullmatch  # letters and digits of these are the same in every version of Unicode


def plain_pattern(pattern: str) -> re.Pattern:
    """The pattern for texts below U+0250, with its classes spelled out: the standard module finds their words twice as fast."""
    for name in (r"\p{L}", r"\p{N}", r"\s"):
        members = "".join(f"\\u{c:04x}" for c in range(0x250) if regex.fullmatch(name, chr(c)))
        pattern = re.sub(r"\[[^]]*\]", lambda m: m[0].replace(name, members), pattern).replace(name, f"[{members}]")
    return re.compile(pattern)


# The public split pattern of the byte-level vocabulary.
_WORDS = plain_pattern(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?![^\s])|\s+").findall


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones themselves, the others from 256 on."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, following = [], 256
    for b in range(256):
        out.append(chr(b if b in own else following))
        following += b not in own
    return out


_LETTERS = {b: c for b, c in enumerate(byte_letters())}


_PACKERS = [struct.Struct(f"<{n}I").pack for n in range(KEPT_LENGTH)]


def pack_ids(ids: list[int]) -> bytes:
    return _PACKERS[len(ids)](*ids) if len(ids) < KEPT_LENGTH else struct.pack(f"<{len(ids)}I", *ids)


def letters_of(word: str) -> str:
    """The word's bytes as the vocabulary writes them; ASCII letters stand for themselves."""
    return word if word.isascii() and word.isalpha() else word.encode("utf-8").decode("latin-1").translate(_LETTERS)


class Parts(dict):
    """Part of a text to the bytes of its ids, filled by ``encode`` (which gives bytes) and emptied when full."""

    def __init__(self, encode, most: int = CACHE):
        super().__init__()
        self.encode, self.most = encode, most

    def __missing__(self, part: str) -> bytes:
        ids = self.encode(part)
        if len(part) <= KEPT_LENGTH:
            if len(self) >= self.most:
                self.clear()
            self[part] = ids
        return ids


class ByteLevelEncoder:
    """Ids of whole texts under a byte-level BPE tokenizer without normaliser; ``word`` may replace the model's merging.

    ``cache`` bounds each of four caches; an entry takes some 200 bytes."""

    def __init__(self, description: str, word=None, cache: int = CACHE):
        self.library = Tokenizer.from_str(description)
        self.library.no_truncation()
        self.library.no_padding()
        self.model, self.split = self.library.model, self.library.pre_tokenizer
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.word = word or self._by_model
        self.plain = Parts(lambda w: pack_ids(self.word(letters_of(w))), cache)
        self.words = Parts(lambda w: pack_ids(self.word(w)), cache)
        self.after_blank = Parts(self._after_blank, cache)
        self.exact = Parts(self._exact, cache)

    def close(self) -> None:
        """Give the caches and the tables back at once: the caches refer to the encoder, so it would wait for the cycle collector."""
        for parts in (self.plain, self.words, self.after_blank, self.exact):
            parts.clear()
            parts.encode = None
        self.word = None

    def _by_model(self, word: str) -> list[int]:
        return [t.id for t in self.model.tokenize(word)]

    def _exact(self, part: str) -> bytes:
        if _PLAIN(part):
            return b"".join(map(self.plain.__getitem__, _WORDS(part)))
        return b"".join([self.words[w] for w, _ in self.split.pre_tokenize_str(part)])

    def _after_blank(self, part: str) -> bytes:
        """A part that follows a single blank in the text, or that begins with a newline and follows none."""
        if part.isascii() and part.isalpha():
            return self.plain[" " + part]
        return self._exact(part if part[:1] == "\n" else " " + part)

    def _special(self, text: str) -> bytes:
        """The text between the marks of added tokens is encoded part by part, as the library does."""
        marks = {t.content: pack_ids([i]) for i, t in self.library.get_added_tokens_decoder().items()}
        pieces = re.split("(" + "|".join(re.escape(m) for m in sorted(marks, key=len, reverse=True)) + ")", text)
        return b"".join(marks[p] if p in marks else self._exact(p) for p in pieces if p)

    def encode(self, text: str) -> bytes:
        if any(mark in text for mark in self.added):
            return self._special(text)
        if _PLAIN(text) or any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return self._exact(text)
        if _LONG_BLANK(text):
            return b"".join(map(self.exact.__getitem__, _PART(text)))
        first, *rest = text.replace("\n", " \n").split(" ")
        return (self.exact[first] if first else b"") + b"".join(map(self.after_blank.__getitem__, rest))


_BLANK, _LETTER, _DIGIT, _SIGN = range(4)
_KINDS = np.array(
    [_LETTER if regex.match(r"\p{L}", c) else _DIGIT if regex.match(r"\p{N}", c) else _BLANK if regex.match(r"\s", c) else _SIGN for c in map(chr, range(0x250))],
    dtype=np.uint8)


def cut_words(text: str) -> tuple[pa.Array, np.ndarray]:
    """The words of a lower-case text below U+0250 that ends in three blanks, in UTF-16, and where they begin.

    Same words as ``LowerWordEncoder._SPLIT`` finds: runs of letters, single digits, runs of other signs, and short forms like 's."""
    code = np.frombuffer(text.encode("utf-16-le"), "<u2")
    kind = _KINDS[code]
    begin = np.append(kind[:1] != _BLANK, (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)) & (kind != _BLANK)
    mark = np.flatnonzero(code == ord("'"))
    mark = mark[begin[mark] & (kind[mark + 1] == _LETTER)]  # a sign alone before letters
    after, pair = code[mark + 1], code[mark + 1].astype(np.uint32) << 16 | code[mark + 2]
    size = np.isin(after, [ord(c) for c in "stmd"]) + 2 * np.isin(pair, [ord(c) << 16 | ord(d) for c, d in ("re", "ve", "ll")])
    mark, size = mark[size > 0], size[size > 0]
    begin[mark + 1] = False
    rest = mark + 1 + size
    begin[rest[kind[rest] == _LETTER]] = True
    inside = np.flatnonzero(kind)
    edges = np.append(np.flatnonzero(begin[inside]), len(inside)).astype(np.int32) * np.int32(2)
    words = pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges), pa.py_buffer(code[inside])])
    return words, np.flatnonzero(begin)


class LowerWordEncoder:
    """Ids under a tokenizer that drops white space: texts and parts between blanks are encoded apart, plain ones without its normaliser."""

    # fixed value, as in its file but for the order: words first, as nothing else begins like one
    _SPLIT = plain_pattern(r"[\p{L}]+|'s|'t|'re|'ve|'m|'ll|'d|[\p{N}]|[^\s\p{L}\p{N}]+").findall

    def __init__(self, description: str):
        self.library = Tokenizer.from_str(description)
        self.library.no_truncation()
        self.library.no_padding()
        self.model = self.library.model
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.parts = Parts(self._part)
        self.words = Parts(self._word)

    def _word(self, word: str) -> bytes:
        return pack_ids([t.id for t in self.model.tokenize(letters_of(word))])

    def _low(self, text: str) -> str | None:
        """Below U+0250 characters are composed already, and lower-cased alike if that stays below; None for others."""
        return low if _PLAIN(text) and ((low := text.lower()).isascii() or _PLAIN(low)) else None

    def _part(self, part: str) -> bytes:
        if (low := self._low(part)) is None:
            return pack_ids(self.library.encode(part, add_special_tokens=False).ids)
        return b"".join(map(self.words.__getitem__, self._SPLIT(low)))

    def _special(self, text: str) -> bool:
        return any(mark in text for mark in self.added) or any(c in text for c in "\x1c\x1d\x1e\x1f")

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; the plain texts are cut together."""
        out, plain, lows = [b""] * len(texts), [], []
        for i, text in enumerate(texts):
            if self._special(text):
                out[i] = pack_ids(self.library.encode(text, add_special_tokens=False).ids)
            elif (low := self._low(text)) is None:
                out[i] = b"".join(map(self.parts.__getitem__, text.split()))
            else:
                plain.append(i)
                lows.append(low)
        for i, ids in zip(plain, self._together(lows)):
            out[i] = ids
        return out

    def _together(self, lows: list[str]) -> list[bytes]:
        """The ids of lower-case texts below U+0250: each different word is looked up once, and its ids are copied to where it stands."""
        words, begin = cut_words("\n".join([*lows, "\n\n"]))
        coded = words.dictionary_encode()
        kinds = coded.dictionary
        letters = kinds.buffers()[2].to_pybytes().decode("utf-16-le") if len(kinds) else ""
        edges = np.frombuffer(kinds.buffers()[1], np.int32, len(kinds) + 1) // 2 if len(kinds) else np.zeros(1, dtype=np.int32)
        found = [self.words[letters[a:b]] for a, b in pairwise(edges.tolist())]
        size = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4
        at = coded.indices.to_numpy(zero_copy_only=False)
        each = size[at]
        ahead = np.append(0, np.cumsum(each))
        ids = np.frombuffer(b"".join(found), "<u4")[np.repeat((np.cumsum(size) - size)[at] - ahead[:-1], each) + np.arange(ahead[-1])].tobytes()
        texts = np.cumsum([len(low) + 1 for low in lows])  # where each text ends, its line break included
        ends = (4 * ahead[np.searchsorted(begin, texts)]).tolist()
        return [ids[a:b] for a, b in pairwise([0, *ends])]


@lru_cache(maxsize=1)
def byte_encoder(description: str, cache: int = CACHE) -> ByteLevelEncoder:
    """As ``word_encoder``; for jobs whose later stages leave room for its caches."""
    return ByteLevelEncoder(description, cache=cache)


@lru_cache(maxsize=1)
def word_encoder(description: str) -> LowerWordEncoder:
    """One encoder per Python worker: its tables are loaded once, and its cache stays warm from task to task."""
    return LowerWordEncoder(description)


def description_of(path: str) -> str:
    """The tokenizer file as text, read by the driver and sent along, so that tasks need no file."""
    with open(path, encoding="utf-8") as f:
        return f.read()
