"""Token counts under a unigram vocabulary, without the tokens.

An Aho-Corasick automaton enumerates every vocabulary match in a word in one
pass.  Dynamic programming over the ends of matches carries the best score
and, for it, the number of pieces.  Among equal scores the match that starts
first stays, as in the tokenizers library's Viterbi, where a later candidate
must be strictly better.  A character that no single-character piece matches
may be unknown, ten below the least score of the vocabulary; unknown
characters in a row are one piece, or one piece for each byte if the
vocabulary has all byte pieces.

White space becomes the word mark, which also goes before a text; a word is
what runs from one mark to before the next.  Where a piece of the vocabulary
has two marks in a row, marks in a row stay together before their word.  No
piece then spans the end of a word, so the counts are those of one Viterbi
over the whole text; a vocabulary with such a piece is refused.  Words repeat,
so a worker keeps a bounded cache from word to count.

Defined cases: a null or empty text has no tokens; rows are counted each; a
text may be of any length, and the tables of the dynamic programming reach
back over the longest piece only, so a word may be, too.  Words of over 200
characters are not kept.  Further columns are passed over, whatever their
names.
"""

from __future__ import annotations

import functools
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .bpe import TwoAges

#: The word mark, and what an unknown character costs below the least score.
MARK, UNKNOWN_COST = "▁", 10.0
CACHE_WORDS = 700_000
MARKED_WORDS = re.compile(f"{MARK}+[^{MARK}]*")


def _start(match: tuple) -> int:
    return match[0]


class ShortWords(TwoAges):
    """A cache that long words pass by."""

    def __missing__(self, key):
        return self.make(key) if len(key) > 200 else super().__missing__(key)


class Unigram:
    """Counts for pieces with scores; ``runs`` keeps marks in a row in one word."""

    def __init__(self, vocabulary: list[tuple[str, float]], byte_pieces: bool, cache_words: int = CACHE_WORDS, runs: bool = False):
        import ahocorasick

        if runs and any(re.search(f"[^{MARK}]{MARK}", p) for p, _ in vocabulary):
            raise ValueError("a piece goes on into the next word")
        self.runs = runs

        self.longest = max([1, *(len(p) for p, _ in vocabulary)])
        self.find = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece:
                self.find.add_word(piece, (len(piece), score))
        self.find.make_automaton()
        self.unknown = min(s for _, s in vocabulary) - UNKNOWN_COST
        self.byte_pieces = byte_pieces
        self.of_word = ShortWords(self.count_word, cache_words // 2)

    def count_word(self, word: str) -> int:
        # Per place, as far back as a piece reaches: best score, pieces before the last run of unknown characters, bytes of that run.
        held = self.longest + 1
        best: list = [(0.0, 0, 0)] + [None] * self.longest
        matches = self.find.iter(word)
        match = next(matches, None)
        for end in range(1, len(word) + 1):
            top, found, single = None, [], False
            while match is not None and match[0] == end - 1:
                size, score = match[1]
                found.append((end - size, score))
                single |= size == 1
                match = next(matches, None)
            if not single:
                found.append((end - 1, None))
            # by start, so that of equal scores the earliest start stays
            found.sort(key=_start)
            for start, score in found:
                value = best[start % held][0] + (self.unknown if score is None else score)
                if top is None or value > top[0]:
                    top = (value, start, score is None)
            value, start, odd = top
            _, pieces, run = best[start % held]
            if odd:
                best[end % held] = (value, pieces, run + len(word[start].encode("utf-8", "replace")))
            else:
                best[end % held] = (value, pieces + self._run(run) + 1, 0)
        _, pieces, run = best[len(word) % held]
        return pieces + self._run(run)

    def _run(self, size: int) -> int:
        return size if self.byte_pieces else min(size, 1)

    def count(self, text: str) -> int:
        if not text:
            return 0
        text = text.replace(" ", MARK)
        if self.runs and MARK * 2 in text:
            known = self.of_word
            return sum([known[w] for w in MARKED_WORDS.findall(text if text.startswith(MARK) else MARK + text)])
        words = text.split(MARK)
        # what stands before the first mark gets one; a mark alone is a word too
        first = words[1:] if text.startswith(MARK) else words
        known = self.of_word
        return sum([known[MARK + w] for w in first])


def pieces_of(path: str) -> tuple[list[tuple[str, float]], bool]:
    """A sentencepiece file's pieces and scores; control pieces can't be matched and are left out."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    out, bytes_seen = [], 0
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            bytes_seen += 1
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            out.append((model.id_to_piece(i), float(model.get_score(i))))
    return out, bytes_seen == 256


@functools.lru_cache(maxsize=2)
def loaded(path: str) -> Unigram:
    return Unigram(*pieces_of(path), runs=True)


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and n_tokens of every document."""
    common.text_session(docs.sparkSession)

    def run(batches):
        model = loaded(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([common.column(batch, "id"), pa.array([model.count(t) for t in common.texts(batch, "text")], pa.int64())], names=["id", "n_tokens"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, n_tokens long").withColumnRenamed("id", id_col)
