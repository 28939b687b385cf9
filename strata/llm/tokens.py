"""Token ids of many texts with the tokenizers library.

Each distinct word is encoded once by a worker and its ids are remembered, up to MEMO_WORDS words;
later words are encoded again each time. Words are encoded many at a time, as one text.

Texts of one-byte characters are cut into the very pieces the tokenizer's pattern gives, for the
patterns known here (PATTERNS), many texts at once with numpy and Arrow: the library meets each
distinct piece, and no Python code runs per word. Of texts with other characters, the words around
these are cut only where any splitting cuts, at a single space between two other characters. Both
give the ids of the whole text.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa

MEMO_WORDS = 500_000
RUN = 512  # words encoded as one text
BLOCK = 2_000_000  # characters cut at once

# U+180E counts as white space in some regex engines: no cut is made beside it.
_SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace()) + "᠎"
_ODD_PAIRS = [*{pair for c in _SPACES for pair in (" " + c, c + " ")}]
_SAFE_SPACE = re.compile(r"(?<=[^\s᠎]) (?=[^\s᠎])")

# Any pattern cuts at a space between two printable characters of ASCII.
_PLAIN_SPACE = re.compile(r"(?<=[!-~]) (?=[!-~])")
_PLAIN_SPACE_BYTES = re.compile(_PLAIN_SPACE.pattern.encode())
_ODD = re.compile(r"[^\x01-\xff]+|<\|")  # what pieces can't take, and beginnings of special tokens
NEAR = 200  # characters; odd ones so near to each other stay in one part

# Kinds of the one-byte characters as the patterns see them; NUL stands between two texts.
SPACE, LETTER, NUMBER, OTHER, BETWEEN = range(5)


def _kind(char: str) -> int:
    if char in "\t\n\v\f\r \x85\xa0":
        return SPACE
    return {"L": LETTER, "N": NUMBER}.get(unicodedata.category(char)[0], OTHER)


_KINDS = np.array([BETWEEN, *(_kind(chr(c)) for c in range(1, 256))], np.uint8)
_LOWER = "".join(map(chr, range(256))).lower().encode("latin-1")

# What a tokenizers file says of its splitting, by the way it is done here.
PATTERNS = {
    "dropped": {
        "normalizer": {
            "type": "Sequence",
            "normalizers": [
                {"type": "NFC"},
                {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
                {"type": "Lowercase"},
            ],
        },
        "pre_tokenizer": {
            "type": "Sequence",
            "pretokenizers": [
                {
                    "type": "Split",
                    "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
                    "behavior": "Removed",
                    "invert": True,
                },
                {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
            ],
        },
    },
    "leads": {
        "normalizer": None,
        # Its pattern: 's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+
        "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True},
    },
}

_tokenizers: dict[str, WordMemo] = {}


def _latin(text: str) -> bool:
    """Whether every character is one byte: then lower case is the same everywhere."""
    try:
        return bool(text.encode("latin-1"))
    except UnicodeEncodeError:
        return False


def _contractions(data: np.ndarray, begins: np.ndarray) -> None:
    """Makes 's, 't, 'm, 'd, 're, 've and 'll pieces of their own where an apostrophe begins a piece."""
    quotes = np.flatnonzero(data == ord("'"))
    quotes = quotes[begins[quotes]]
    quotes = quotes[quotes + 2 < len(data)]
    one, two = data[quotes + 1], data[quotes + 2]
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    begins[quotes[short | long] + 1] = False
    begins[quotes[short] + 2] = True
    after = quotes[long] + 3
    begins[after[after < len(data)]] = True


def pieces(texts: list[bytes], space: str) -> tuple[pa.BinaryArray, np.ndarray]:
    """The pieces a pattern cuts Latin-1 texts into, one after another, and their number in each text.

    With "leads" white space is in pieces too, and the NUL after each text is one.
    """
    data = np.frombuffer(b"".join([t + b"\0" for t in texts]), np.uint8)
    kinds = _KINDS[data]
    begins = np.empty(len(data), bool)
    begins[0] = True
    np.not_equal(kinds[1:], kinds[:-1], out=begins[1:])
    if space == "dropped":
        begins |= kinds == NUMBER
        _contractions(data, begins)
        held = (kinds != SPACE) & (kinds != BETWEEN)
        begins &= held
    else:
        # The last of some white space goes to what follows if it is a space, else it stands alone.
        last = np.flatnonzero((kinds[:-1] == SPACE) & (kinds[1:] != SPACE) & (kinds[1:] != BETWEEN))
        begins[last] = True
        begins[last[data[last] == ord(" ")] + 1] = False
        begins |= kinds == BETWEEN
        _contractions(data, begins)
        held = None
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    counts = np.add.reduceat(begins, np.cumsum(sizes) - sizes, dtype=np.int64)
    if held is not None:
        data, begins = data[held], begins[held]
    offsets = np.append(np.flatnonzero(begins), len(data)).astype(np.int32)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1, buffers), counts


def _next_cut(text: str, at: int) -> int:
    space = _PLAIN_SPACE.search(text, at)
    return space.start() if space else len(text)


def _parted(text: str) -> Iterator[tuple[bool, str]]:
    """A text in parts, each with whether it is plain: one that ``pieces`` takes."""
    at, odd = 0, _ODD.search(text)
    while odd:
        begin = text.rfind(" ", at, odd.start())
        while begin > at and not _PLAIN_SPACE.match(text, begin):
            begin = text.rfind(" ", at, begin)
        begin = max(begin, at)
        if begin > at:
            yield True, text[at:begin]
        end = _next_cut(text, odd.end())
        while (odd := _ODD.search(text, end)) and odd.start() <= end + NEAR:
            end = _next_cut(text, odd.end())
        yield False, text[begin:end]
        at = end
    if at < len(text):
        yield True, text[at:]


def _blocks(text: bytes) -> Iterator[bytes]:
    """A long text in parts of about BLOCK characters, cut where any pattern cuts."""
    at = 0
    while len(text) - at > BLOCK and (space := _PLAIN_SPACE_BYTES.search(text, at + BLOCK)):
        yield text[at : space.start()]
        at = space.start()
    yield text[at:]


class PieceMemo:
    """The ids of pieces, remembered up to MEMO_WORDS of them, for a tokenizer whose pattern is known.

    ``place`` numbers the pieces; the ids of number i are ``ids[upto[i] : upto[i + 1]]``.
    """

    def __init__(self, tokenizer, space: str):
        self.tokenizer, self.space = tokenizer, space
        vocabulary = tokenizer.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)  # ids at which a piece ends in a run
        if space == "dropped":
            suffix = tokenizer.model.end_of_word_suffix
            self.closes[[i for t, i in vocabulary.items() if suffix and t.endswith(suffix)]] = True
        else:
            self.closes[tokenizer.encode("\n", add_special_tokens=False).ids] = True
        self.place = {b"\0": 0}
        self.ids, self.upto = np.zeros(0, np.uint32), np.zeros(2, np.int64)

    def _one_by_one(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        coded = self.tokenizer.encode_batch([w.decode("latin-1") for w in new], add_special_tokens=False)
        found = [e.ids for e in coded]
        flat = np.fromiter((i for f in found for i in f), np.uint32)
        return flat, np.fromiter(map(len, found), np.int64, len(found))

    def _run(self, run: list[bytes], flat: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids and their number for each piece of a run, from the ids of its text."""
        closes = np.flatnonzero(self.closes[flat])
        if self.space == "leads":  # a line feed after each piece
            kept, upto = np.delete(flat, closes), closes - np.arange(len(closes))
        else:
            kept, upto = flat, closes + 1
        if len(upto) != len(run) or upto[-1] != len(kept):
            return self._one_by_one(run)
        return kept, np.diff(upto, prepend=0)

    def _coded(self, new: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """RUN pieces at a time are encoded as one text, with white space between that changes none."""
        between = b"\n" if self.space == "leads" else b" "
        runs = [new[i : i + RUN] for i in range(0, len(new), RUN)]
        texts = [(between.join(r) + between).decode("latin-1") for r in runs]
        for run, coded in zip(runs, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            yield self._run(run, np.array(coded.ids, np.uint32))

    def _learn(self, new: list[bytes]) -> None:
        blank = [w for w in new if not w.strip(b"\t\n\v\f\r \x85\xa0")]
        if blank:
            new = [*set(new).difference(blank)]
        parts = [*self._coded(new)] + ([self._one_by_one(blank)] if blank else [])
        self.place.update(zip(new + blank, range(len(self.place), len(self.place) + len(new) + len(blank))))
        self.ids = np.concatenate([self.ids, *(p[0] for p in parts)])
        sizes = np.concatenate([p[1] for p in parts])
        self.upto = np.concatenate([self.upto, self.upto[-1] + np.cumsum(sizes)])

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of texts (Latin-1, without NUL and special tokens)."""
        found, counts = pieces(texts, self.space)
        coded = found.dictionary_encode()
        distinct, before = coded.dictionary.to_numpy(zero_copy_only=False), len(self.place)
        places = np.fromiter(map(self.place.get, distinct, repeat(-1)), np.int64, len(distinct))
        unknown = np.flatnonzero(places < 0)
        new = distinct[unknown].tolist()
        if new:
            self._learn(new)
            places[unknown] = [self.place[w] for w in new]
        at = places[coded.indices.to_numpy()]
        start = self.upto[at]
        sizes = self.upto[at + 1] - start
        ends = np.cumsum(sizes)
        ids = self.ids[np.repeat(start - ends + sizes, sizes) + np.arange(sizes.sum())]
        cuts = (np.append(0, ends)[np.append(0, np.cumsum(counts))] * 4).tolist()
        data = ids.tobytes()
        self._forget(new, max(before, MEMO_WORDS))
        return [data[a:b] for a, b in zip(cuts, cuts[1:])]

    def _forget(self, new: list[bytes], most: int) -> None:
        if len(self.place) > most:
            for w in new:
                if self.place[w] >= most:
                    del self.place[w]
            self.upto = self.upto[: most + 1]
            self.ids = self.ids[: self.upto[-1]]


class WordMemo:
    """A tokenizer of this worker; ``encode`` gives ids as little-endian unsigned 32-bit integers.

    ``space`` tells what the tokenizer does with a space before a word: "leads" (it belongs to the
    word) or "dropped".
    """

    def __init__(self, path: str, space: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.lead = {"leads": " ", "dropped": ""}[space]
        same = [self.tokenizer.encode(c, add_special_tokens=False).ids for c in "Aa"]
        self.folds = space == "dropped" and same[0] == same[1]  # the tokenizer lower-cases
        self.first: dict[str, bytes] = {}
        self.rest: dict[str, bytes] = self.first if space == "dropped" else {}
        with open(path, encoding="utf-8") as file:
            says = json.load(file)
        known = all(says.get(k) == v for k, v in PATTERNS[space].items())
        special = all("<|" in t["content"] for t in says["added_tokens"])
        self.pieces = PieceMemo(self.tokenizer, space) if known and special else None

    def _learn(self, known: dict[str, bytes], words: set[str], lead: str) -> list[str]:
        """Adds the ids of words not known yet; returns those that have no room for longer."""
        new = list(words.difference(known))
        room = max(0, MEMO_WORDS - len(known))
        if known is self.rest:
            known.update(self._coded([w for w in new if w]))
            known.setdefault("", b"")
        else:
            coded = self.tokenizer.encode_batch_fast([lead + w for w in new], add_special_tokens=False)
            known.update((w, array("I", e.ids).tobytes()) for w, e in zip(new, coded))
        return new[room:]

    def _coded(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        """The ids of words, RUN of them encoded as one text with a space between each two."""
        runs = [words[i : i + RUN] for i in range(0, len(words), RUN)]
        for run, coded in zip(runs, self.tokenizer.encode_batch([self.lead + " ".join(r) for r in runs], add_special_tokens=False)):
            ids = array("I", coded.ids).tobytes()
            # A token begins in its word or at the space before it.
            begins = np.fromiter((a for a, _ in coded.offsets), np.int64, len(coded.ids))
            ends = np.cumsum(np.fromiter(map(len, run), np.int64, len(run)) + 1) - 1 + len(self.lead)
            upto = (np.searchsorted(begins, ends) * 4).tolist()
            yield from zip(run, (ids[a:b] for a, b in zip([0, *upto], upto)))

    def _parts(self, text: str) -> list[str]:
        if self.lead and (text[0] in _SPACES or text[-1] in _SPACES or any(pair in text for pair in _ODD_PAIRS)):
            return _SAFE_SPACE.split(text)
        if self.folds and "<|" not in text and _latin(text):  # capitals make no special token
            text = text.lower()
        return text.split(" ")

    def encode(self, texts: list[str | None], group: int = 256) -> list[bytes]:
        if self.pieces is None:
            return self._by_words([t or "" for t in texts], group)
        owners: list[int] = []  # whose text each part is
        found: list[bytes] = []
        odd: list[tuple[int, str]] = []
        block: list[tuple[int, bytes]] = []
        waiting = 0

        def coded() -> None:
            nonlocal block, waiting
            for (n, _), ids in zip(block, self.pieces.encode([part for _, part in block])):
                found[n] = ids
            block, waiting = [], 0

        for i, text in enumerate(texts):
            for plain, part in _parted(text or ""):
                if not plain:
                    odd.append((len(found), part))
                    owners.append(i)
                    found.append(b"")
                    continue
                data = part.encode("latin-1")
                for some in _blocks(data.translate(_LOWER) if self.pieces.space == "dropped" else data):
                    block.append((len(found), some))
                    owners.append(i)
                    found.append(b"")
                    waiting += len(some)
                    if waiting >= BLOCK:
                        coded()
        if block:
            coded()
        for (n, _), ids in zip(odd, self._by_words([part for _, part in odd], group)):
            found[n] = ids
        out: list[list[bytes]] = [[] for _ in texts]
        for i, ids in zip(owners, found):
            out[i].append(ids)
        return [b"".join(o) for o in out]

    def _by_words(self, texts: list[str], group: int) -> list[bytes]:
        out: list[bytes] = []
        for at in range(0, len(texts), group):
            split = [self._parts(t) if t else [""] for t in texts[at : at + group]]
            heads = [p.pop(0) for p in split]
            one = [] if self.rest is self.first else self._learn(self.first, set(heads), "")
            two = self._learn(self.rest, set().union(*split, heads if self.rest is self.first else ()), self.lead)
            head, rest = self.first.__getitem__, self.rest.__getitem__
            out += [head(h) + b"".join(map(rest, p)) for h, p in zip(heads, split)]
            for memo, passing in ((self.first, one), (self.rest, two)):
                for w in passing:
                    del memo[w]
        return out


def tokenizer(path: str, space: str) -> WordMemo:
    """This worker's tokenizer for a file, loaded once."""
    if path not in _tokenizers:
        _tokenizers[path] = WordMemo(path, space)
    return _tokenizers[path]
