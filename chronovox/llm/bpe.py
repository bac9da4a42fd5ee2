"""BPE encoding and decoding.

A word's symbols form a doubly linked list; a priority queue holds the merge
rank of every adjacent pair.  The lowest rank (leftmost on ties) is merged
first, and queue entries whose pair no longer stands are skipped.  Decoding
concatenates vocabulary strings.

Words are cut out of a text by the vocabulary file's own normaliser and
pre-tokeniser.  For texts of plain Latin, Greek or Cyrillic letters an
equivalent pattern of the standard library does it faster; any other text
goes through the tokenizers library's components.  Words repeat, so a worker
keeps a bounded cache from word to ids.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import unicodedata
from array import array

import numpy as np

#: Entries a worker's word cache may hold before it is halved; about 140 MB.
CACHE_WORDS = 700_000
#: Code points below this bound may take the fast path.
PLAIN_BELOW = 0x500


def _ranges(keep) -> str:
    """A character class of the code points below PLAIN_BELOW that ``keep`` accepts."""
    out, start = [], None
    for c in range(PLAIN_BELOW + 1):
        inside = c < PLAIN_BELOW and keep(chr(c))
        if inside and start is None:
            start = c
        elif not inside and start is not None:
            out.append(f"\\u{start:04x}-\\u{c - 1:04x}")
            start = None
    return "".join(out)


@functools.cache
def plain_classes() -> tuple[str, str, str, re.Pattern]:
    """Letter, number and space classes below PLAIN_BELOW, and a pattern that finds any character outside the fast path."""
    letter = _ranges(lambda c: unicodedata.category(c)[0] == "L")
    number = _ranges(lambda c: unicodedata.category(c)[0] == "N")
    space = r"\t-\r\x20\x85\xa0"
    # Combining marks and unassigned code points are left to the library: normalisation may change them.
    odd = _ranges(lambda c: unicodedata.category(c)[0] == "M" or unicodedata.category(c) == "Cn" or unicodedata.normalize("NFC", c) != c)
    return letter, number, space, re.compile(f"[{odd}\\x1c-\\x1f\\u03a3\\u0130\\u{PLAIN_BELOW:04x}-\\U0010ffff]")


@functools.cache
def byte_letters() -> tuple[str, ...]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    stand, spare = {b: chr(b) for b in shown}, 0
    for b in range(256):
        if b not in stand:
            stand[b] = chr(256 + spare)
            spare += 1
    return tuple(stand[b] for b in range(256))


class TwoAges(dict):
    """A bounded cache: values come from ``make``; once ``limit`` are held they become the old age, from which hits move back."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class Bpe:
    """Encoder and decoder for one vocabulary file of the tokenizers library (kind BPE)."""

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.path = path
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.strings = {i: s for s, i in self.vocab.items()}
        #: The rank of a pair of ids (in one integer), and the id that a rank's merge makes.
        self.rank_of: dict[int, int] = {}
        self.made_by: list[int] = []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank_of[self.vocab[a] << 32 | self.vocab[b]] = rank
            self.made_by.append(self.vocab[a + b])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings |= {i: s for s, i in self.special.items()}
        self.kind = np.dtype("<u2" if max([*self.strings, 0]) < 1 << 16 else "<u4")
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.lower = "Lowercase" in json.dumps(spec["normalizer"])
        self.level = spec["decoder"] is not None  # a byte-level decoder; without one, vocabulary strings are joined by a space
        self.inner = [self.vocab[c] for c in byte_letters()]
        self.final = [self.vocab[c + self.suffix] for c in byte_letters()]
        self.code = {2: "H", 4: "I"}[self.kind.itemsize]
        letter, number, space, self.odd = plain_classes()
        other = f"[^{space}{letter}{number}]+"
        self.words = (
            re.compile(f"[{letter}]+|[{number}]|'(?:[stmd]|re|ve|ll)|{other}")
            if self.lower
            else re.compile(f" ?[{letter}]+| ?[{number}]+|'(?:[stmd]|re|ve|ll)| ?{other}|[{space}]+(?![^{space}])|[{space}]+")
        )
        self.marks = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.by_word = TwoAges(self._word, cache_words // 2)

    def merge(self, symbols: list[int]) -> list[int]:
        """Merge one word's symbols.  Queue entries are rank and place in one integer, so that they order by both."""
        n = len(symbols)
        if n < 2:
            return symbols
        get, made_by, push, pop = self.rank_of.get, self.made_by, heapq.heappush, heapq.heappop
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        queue = []
        for i in range(n - 1):
            if (rank := get(symbols[i] << 32 | symbols[i + 1])) is not None:
                queue.append(rank << 32 | i)
        heapq.heapify(queue)
        while queue:
            top = pop(queue)
            rank, i = top >> 32, top & 0xFFFFFFFF
            j = right[i]
            if symbols[i] < 0 or j == n or get(symbols[i] << 32 | symbols[j]) != rank:
                continue  # stale: one of its symbols has been merged meanwhile
            new = symbols[i] = made_by[rank]
            symbols[j] = -1
            k = right[i] = right[j]
            if k < n:
                left[k] = i
                if (rank := get(new << 32 | symbols[k])) is not None:
                    push(queue, rank << 32 | i)
            h = left[i]
            if h >= 0 and (rank := get(symbols[h] << 32 | new)) is not None:
                push(queue, rank << 32 | h)
        return [s for s in symbols if s >= 0]

    def _word(self, word: str) -> bytes:
        """Packed ids of one normalised word in plain characters."""
        raw = word.encode("utf-8", "surrogateescape")
        if not raw:
            return b""
        symbols = [self.inner[b] for b in raw]
        symbols[-1] = self.final[raw[-1]]
        return array(self.code, self.merge(symbols)).tobytes()

    def split(self, text: str) -> list[str]:
        """Normalised words of a text without special tokens, as plain characters."""
        if not self.odd.search(text):
            return self.words.findall(text.lower() if self.lower else text)
        if self.library.normalizer is not None:
            text = self.library.normalizer.normalize_str(text)
        back = _bytes_of_letters()
        return [bytes(back[c] for c in word).decode("utf-8", "surrogateescape") if word else "" for word, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def parts(self, text: str) -> list[str | int]:
        """A text cut at special tokens: strings between them and their ids."""
        if self.marks is None or not self.marks.search(text):
            return [text]
        out: list[str | int] = []
        at = 0
        for m in self.marks.finditer(text):
            out += [text[at : m.start()], self.special[m[0]]]
            at = m.end()
        return [*out, text[at:]]

    def packed(self, text: str) -> np.ndarray:
        """Ids as the tokenizers library gives with add_special_tokens=False, little-endian in ``kind``."""
        out = []
        for part in self.parts(text):
            if isinstance(part, int):
                out.append(np.array([part], self.kind).tobytes())
            elif part:
                out.extend(map(self.by_word.__getitem__, self.split(part)))
        return np.frombuffer(b"".join(out), self.kind)

    def encode(self, text: str) -> list[int]:
        return self.packed(text).tolist()

    def decode(self, ids: list[int]) -> str:
        """Vocabulary strings put together, as the library's decode with skip_special_tokens=False."""
        if not self.level:
            return " ".join([self.strings[i] for i in ids])
        back, out = _bytes_of_letters(), []
        for i in ids:
            s = self.strings[i]
            # as in the library: a string with any character outside the byte alphabet stands for its own UTF-8 bytes
            out.append(bytes(back[c] for c in s) if all(c in back for c in s) else s.encode())
        return b"".join(out).decode("utf-8", "replace")


#: Fixed value: how byte-level vocabularies cut a text into words.
BYTE_LEVEL_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class LibraryBpe(Bpe):
    """The same ids for a byte-level file, by compiled code.

    tiktoken encodes some five times as fast as the tokenizers library and
    gives the same ids where the file's ids follow its merge order, which is
    checked here; the library itself serves any other file.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        super().__init__(path, cache_words)
        back = _bytes_of_letters()
        self.compiled = None
        if self.level and not self.suffix and self.made_by == sorted(set(self.made_by)) and all(c in back for s in self.vocab for c in s):
            import tiktoken

            ranks = {bytes(back[c] for c in s): i for s, i in self.vocab.items()}
            self.compiled = tiktoken.Encoding("words", pat_str=BYTE_LEVEL_WORDS, mergeable_ranks=ranks, special_tokens=self.special)
            self.allowed = set(self.special)
            # the tables of merges are not needed beside the compiled ones
            self.library, self.rank_of, self.made_by, self.vocab = None, {}, [], {}

    def packed(self, text: str) -> np.ndarray:
        if self.compiled is None:
            return np.array(self.library.encode(text, add_special_tokens=False).ids, self.kind)
        return self.compiled.encode_to_numpy(text, allowed_special=self.allowed).astype(self.kind)


@functools.cache
def _bytes_of_letters() -> dict[str, int]:
    return {c: b for b, c in enumerate(byte_letters())}


@functools.lru_cache(maxsize=4)
def loaded(path: str) -> Bpe:
    """One encoder per worker and file."""
    return Bpe(path)


@functools.lru_cache(maxsize=4)
def loaded_library(path: str) -> LibraryBpe:
    return LibraryBpe(path)
