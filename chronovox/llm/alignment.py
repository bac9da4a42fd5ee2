"""Alignment of two tokenizers' tokens, and how often linked tokens meet in a corpus.

Text goes through a byte-level BPE (A) and a piece BPE with byte fallback (B).
Places where tokens of both end cut a document into groups; every occurrence
of an A token is linked with every occurrence of a B token of its group.

Each document's links are counted by pair of ids first.  These postings
(document, A id, B id, multiplicity) are shuffled by A id and sorted by pair, as
Spark's sort-merge join does, which spills; the counts of documents of each pair,
summed before the shuffle, meet them there with the greatest count of their A
id.  What a document's postings contribute is summed by document.  A row holds
one pair's postings from some two thousand documents, which saves most of the
shuffle.  An A id with many postings (every document may hold one) is dealt
over as many parts as its postings fill; its counts go to each part.  They are
bounded by the vocabulary, as is the table of parts.

A space goes before each text.  No token of either kind goes over a place where
a space follows a character that is no white space, so groups of the whole text
are those of its words, in order.  A process remembers what recent words are in
both tokenizers, and only encodes the others, in blocks that begin at such
places; when its memory is full, the words that were used most stay.

Defined cases: a null or empty text has no tokens, nor has one whose tokens'
bytes differ from the space and the text (U+2581 in it, for one); its numbers
are 0 and its groups empty.  Strings of special tokens are plain text.  Rows
are documents, equal ids or not.  A text may be of any length: a text without
a cut is one block.  Further columns are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import bpe, common

BLOCK = 1 << 16
#: Postings of one A id in one part of the join, and those that are laid out by pair together.
PART_POSTINGS, TOGETHER = 1_000_000, 1 << 20
#: Documents that are laid out together at most, so that their places fit two bytes.
MOST_ROWS = 32_767
#: Fixed value: the mark for a space in pieces.
MARK = "▁"
CUT = re.compile(r"(?<=\S)(?= .)", re.DOTALL)  # a last space alone would be no text for B
NO_CUT = re.compile(r"\s(?: |\Z)")
#: Characters of a word up to which it is remembered, and bytes of a process's memory of words, roughly.
LONGEST, MEMORY = 64, 32 << 20
#: Links of a group up to which they are laid out one by one; beyond, by distinct ids and their counts.
LAID_OUT = 64


def blocks(full: str):
    """Parts of a text that no token goes over, each beginning with a space as the text does."""
    at = 0
    while at < len(full):
        cut = CUT.search(full, at + BLOCK) if len(full) - at > BLOCK else None
        end = cut.start() if cut else len(full)
        yield full[at:end]
        at = end


class Pair:
    """Both tokenizers: ids, and how many bytes each stands for."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        import tiktoken

        own, letters = bpe.Bpe(path_a, 2), {c: b for b, c in enumerate(bpe.byte_letters())}
        ranks = {bytes(letters[c] for c in s): i for s, i in own.vocab.items() if all(c in letters for c in s)}
        if not own.level or own.suffix or own.made_by != sorted(set(own.made_by)):
            raise ValueError("A must be a byte-level BPE whose ids follow its merges")
        self.a = tiktoken.Encoding("a", pat_str=bpe.BYTE_LEVEL_WORDS, mergeable_ranks=ranks, special_tokens={})
        self.bytes_a = np.zeros(max(ranks.values()) + 1, np.int64)
        self.bytes_a[list(ranks.values())] = [len(b) for b in ranks]
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces):
            raise ValueError("a piece goes on into the next word")
        self.strings_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.bytes_b = np.array([len(s) for s in self.strings_b], np.int64)
        #: Ids and what may follow one, by id * 2 and whether it ends its side of a group; those of B come after those of A.
        self.written = [f"{i}{end}" for n, ends in ((len(self.bytes_a), ",|"), (len(pieces), ",;")) for i in range(n) for end in ends]

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of A and B for a space and the text; None where their bytes differ from it."""
        a, b = [], []
        for block in blocks(" " + text):
            a.append(self.a.encode_to_numpy(block, disallowed_special=()))
            ids = self.b.encode_as_numpy(block[1:])
            if b"".join(map(self.strings_b.__getitem__, ids.tolist())) != block.encode():
                return None
            b.append(ids.astype(np.int64))
        a, b = np.concatenate(a).astype(np.int64), np.concatenate(b)
        return (a, b) if self.bytes_a[a].sum() == self.bytes_b[b].sum() else None


def groups(pair: Pair, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of each group, as numbers of tokens of A and of B so far."""
    ends_a, ends_b = np.cumsum(pair.bytes_a[a]), np.cumsum(pair.bytes_b[b])
    common_ends = np.intersect1d(ends_a, ends_b, assume_unique=True)
    return np.searchsorted(ends_a, common_ends) + 1, np.searchsorted(ends_b, common_ends) + 1


def written(pair: Pair, a: np.ndarray, b: np.ndarray, to_a: np.ndarray, to_b: np.ndarray) -> list[str]:
    """The tokens of ``a1,a2|b1;a3|b2,b3;``, each with what follows it."""
    codes_a, codes_b = a * 2, (b + len(pair.bytes_a)) * 2
    codes_a[to_a - 1] += 1
    codes_b[to_b - 1] += 1
    # a token's place among all: after the tokens of its kind before it, and those of the other kind in earlier groups (A) or up to its own (B)
    sizes_a, sizes_b = np.diff(to_a, prepend=0), np.diff(to_b, prepend=0)
    out = np.empty(len(a) + len(b), np.int64)
    out[np.arange(len(a)) + np.repeat(to_b - sizes_b, sizes_a)] = codes_a
    out[np.arange(len(b)) + np.repeat(to_a, sizes_b)] = codes_b
    return list(map(pair.written.__getitem__, out.tolist()))


def links(a: np.ndarray, b: np.ndarray, to_a: np.ndarray, to_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Linked pairs (A id << 32 | B id), how many times each stands there, and the group of each; in order of groups."""
    sizes_a, sizes_b = np.diff(to_a, prepend=0), np.diff(to_b, prepend=0)
    sizes = sizes_a * sizes_b
    small = sizes <= LAID_OUT
    n = sizes[small]
    group = np.repeat(np.flatnonzero(small), n)
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    pairs = [a[(to_a - sizes_a)[group] + place // sizes_b[group]] << 32 | b[(to_b - sizes_b)[group] + place % sizes_b[group]]]
    times, of = [np.ones(len(group), np.int64)], [group]
    for g in np.flatnonzero(~small):
        (x, nx), (y, ny) = (np.unique(v[to[g] - s[g] : to[g]], return_counts=True) for v, to, s in ((a, to_a, sizes_a), (b, to_b, sizes_b)))
        pairs.append((x[:, None] << 32 | y).ravel())
        times.append((nx[:, None] * ny).ravel())
        of.append(np.full(len(pairs[-1]), g))
    if len(pairs) == 1:
        return pairs[0], times[0], group
    pairs, times, of = np.concatenate(pairs), np.concatenate(times), np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return pairs[order], times[order], of[order]


def summed(pairs: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs and their multiplicities."""
    if times.max(initial=1) == 1:
        return np.unique(pairs, return_counts=True)
    found, inverse = np.unique(pairs, return_inverse=True)
    return found, np.bincount(inverse, times).astype(np.int64)


def postings(a: np.ndarray, b: np.ndarray, to_a: np.ndarray, to_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct linked pairs, their multiplicities, and the number of links."""
    pairs, times, _ = links(a, b, to_a, to_b)
    return *summed(pairs, times), int(times.sum())


def grown(array: np.ndarray, n: int) -> np.ndarray:
    """The array with room for n rows."""
    if n <= len(array):
        return array
    out = np.zeros((max(n, 2 * len(array)), *array.shape[1:]), array.dtype)
    out[: len(array)] = array
    return out


#: Counts of tokens, groups and links with the groups' SHA-256; distinct pairs; their multiplicities.
Found = tuple[tuple, np.ndarray, np.ndarray]


class Words:
    """What recent words (without the space before them) are in both tokenizers: a word's code is its place in the lists.

    ``texts`` holds the groups as written, ``counts`` the tokens of A and B,
    groups and links; a word's pairs lie at ``ends - sizes`` to ``ends``.
    """

    def __init__(self, pair: Pair):
        self.pair, self.known, self.texts, self.held = pair, {}, [], 0
        self.counts, self.pairs, self.times = np.zeros((1024, 4), np.int64), np.zeros(1024, np.int64), np.zeros(1024, np.int64)
        self.sizes, self.ends, self.uses = (np.zeros(1024, np.int64) for _ in range(3))

    def codes(self, blocks: list[str]) -> list[list[int]] | None:
        """Codes of each block's words; None where a text's bytes are not its tokens'."""
        parts = [block[1:].split(" ") for block in blocks]
        fresh = self.fresh(parts)
        together, ending = fresh, []
        if NO_CUT.search(" " + " ".join(fresh)):
            parts = [[w[1:] for w in CUT.split(block)] for block in blocks]
            fresh = self.fresh(parts)
            # a text's last word may end in white space: what such words are is found one by one
            together, ending = ([w for w in fresh if w[-1].isspace() == last] for last in (False, True))
        new = {}
        for words in ([together] if together else []) + [[w] for w in ending]:
            first = len(self.texts)
            if not self.learn(words):
                return None
            new.update(zip(words, range(first, len(self.texts)), strict=True))
        self.known.update(new)
        codes = [list(map(self.known.__getitem__, words)) for words in parts]
        for w in {*ending, *(w for w in fresh if len(w) > LONGEST)}:
            del self.known[w]
        return codes

    def fresh(self, parts: list[list[str]]) -> list[str]:
        return [w for w in dict.fromkeys(chain.from_iterable(parts)) if w not in self.known]

    def learn(self, words: list[str]) -> bool:
        """Encodes words in one text and lists each; one that ends in white space must be alone."""
        found = self.pair.encode(" ".join(words))
        if found is None:
            return False
        (a, b), (to_a, to_b) = found, groups(self.pair, *found)
        ends, until = np.cumsum(list(map(len, map(str.encode, words)))) + np.arange(1, len(words) + 1), np.cumsum(self.pair.bytes_a[a])[to_a - 1]
        last = np.searchsorted(until, ends)
        if (until[last] != ends).any():
            raise ValueError("a token goes over a word's end")
        pairs, times, of = links(a, b, to_a, to_b)
        of = np.searchsorted(last, of)
        texts, at = written(self.pair, a, b, to_a, to_b), [0, *(to_a[last] + to_b[last]).tolist()]
        n, held = len(self.texts), int(self.ends[len(self.texts) - 1]) if self.texts else 0
        self.texts.extend("".join(texts[x:y]) for x, y in zip(at, at[1:]))
        to, size = len(self.texts), np.bincount(of, minlength=len(words))
        self.counts, self.sizes, self.ends, self.uses = (grown(x, to) for x in (self.counts, self.sizes, self.ends, self.uses))
        self.counts[n:to] = np.stack([np.diff(x, prepend=0) for x in (to_a[last], to_b[last], last + 1, np.cumsum(np.bincount(of, times, len(words)).astype(np.int64)))], 1)
        self.sizes[n:to], self.ends[n:to], self.uses[n:to] = size, held + np.cumsum(size), 0
        self.pairs, self.times = grown(self.pairs, held + len(pairs)), grown(self.times, held + len(pairs))
        self.pairs[held : held + len(pairs)], self.times[held : held + len(pairs)] = pairs, times
        self.held += self.weights(n).sum()
        return True

    def weights(self, at: int = 0) -> np.ndarray:
        """Bytes that each word takes here, roughly."""
        return 250 + np.array(list(map(len, self.texts[at:])), np.int64) + 16 * self.sizes[at : len(self.texts)]

    def listed(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of words, and how many times each stands there."""
        n = self.sizes[codes]
        at = np.arange(n.sum()) + np.repeat(self.ends[codes] - np.cumsum(n), n)
        return self.pairs[at], self.times[at]

    def trim(self) -> None:
        """If they take more than their memory, only the words used most stay, in at most half of it."""
        if self.held <= MEMORY:
            return
        codes = np.array(list(self.known.values()), np.int64)
        order = codes[np.argsort(-self.uses[codes], kind="stable")]
        order = order[(self.uses[order] > 1) & (np.cumsum(self.weights()[order]) <= MEMORY // 2)]
        places = dict(zip(order.tolist(), range(len(order)), strict=True))
        self.pairs, self.times = self.listed(order)
        self.texts, self.known = [self.texts[c] for c in places], {w: places[c] for w, c in self.known.items() if c in places}
        self.counts, self.sizes = self.counts[order], self.sizes[order]
        self.ends, self.uses = np.cumsum(self.sizes), np.ones(len(order), np.int64)
        self.held = self.weights().sum()

    def documents(self, texts: Iterable[str | None]) -> Iterator[Found]:
        """What is found in each text; words of some texts are looked up together."""
        some, size = [], 0
        for text in texts:
            if some and size + len(text or "") > BLOCK:
                yield from self.together(some)
                some, size = [], 0
            some.append(text)
            size += len(text or "")
        yield from self.together(some)

    def together(self, texts: list[str | None]) -> Iterator[Found]:
        self.trim()
        whole = [" " + text for text in texts if text]
        # one may be long; if one has no tokens, each goes alone
        found = iter(self.codes(whole) or ()) if len(whole) > 1 else iter(())
        for text in texts:
            codes = next(found, None) if text else None
            yield self.summary([codes] if codes else self.by_blocks(text or ""))

    def by_blocks(self, text: str) -> Iterator[list[int] | None]:
        for block in blocks(" " + text) if text else ():
            self.trim()
            found = self.codes([block])
            yield found and found[0]

    def summary(self, of: Iterable[list[int] | None]) -> Found:
        """A document's numbers and postings from its blocks' codes."""
        counts, lists, h = np.zeros(4, np.int64), [], hashlib.sha256()
        for some in of:
            if some is None:
                lists = []
                break
            h.update(((";" if lists else "") + "".join(map(self.texts.__getitem__, some))[:-1]).encode())
            codes = np.array(some, np.int64)
            np.add.at(self.uses, codes, 1)
            counts += self.counts[codes].sum(0)
            lists.append(summed(*self.listed(codes)))
        if not lists:
            return (0, 0, 0, 0, ""), np.zeros(0, np.int64), np.zeros(0, np.int64)
        return (*counts.tolist(), h.hexdigest()), *(lists[0] if len(lists) == 1 else summed(*map(np.concatenate, zip(*lists, strict=True))))


@functools.lru_cache(maxsize=2)
def loaded(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


@functools.lru_cache(maxsize=2)
def remembered(path_a: str, path_b: str) -> Words:
    return Words(loaded(path_a, path_b))


COLUMNS = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


def tokens(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of documents (``base``, ``row``, id, counts of tokens, groups and links, digest of the groups) and, with ``a`` set, of postings: ``rows`` and ``times`` (``few``, if none is over 127) of one pair from ``base`` on."""
    common.text_session(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"base long, row int, id {source.schema['id'].dataType.simpleString()}, {COLUMNS}, a int, b int, rows array<smallint>, few array<tinyint>, times array<int>"
    arrow = to_arrow_schema(T._parse_datatype_string(schema))
    names = [f.name for f in T._parse_datatype_string(COLUMNS).fields]

    def filled(n: int, **known) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([known[f.name].cast(f.type) if f.name in known else pa.nulls(n, f.type) for f in arrow], schema=arrow)

    def laid_out(base: int, ids: list[pa.Array], counts: list[tuple], lists: list[tuple]):
        n = len(counts)
        yield filled(n, base=pa.repeat(base, n), row=pa.array(np.arange(n)), id=pa.concat_arrays(ids), **{c: pa.array(v) for c, v in zip(names, zip(*counts, strict=True), strict=True)})
        keys, times, rows = *(np.concatenate([x[i] for x in lists]) for i in (0, 1)), np.repeat(np.arange(n), [len(k) for k, _ in lists])
        order = np.argsort(keys, kind="stable")
        keys, times, rows = keys[order], times[order], rows[order].astype(np.int16)
        starts = np.flatnonzero(np.diff(keys, prepend=-1))
        many = np.maximum.reduceat(times, starts) > 127 if len(starts) else np.zeros(0, bool)
        sizes = np.diff(starts, append=len(keys))
        for of, name, kind in ((np.flatnonzero(~many), "few", np.int8), (np.flatnonzero(many), "times", np.int32)):
            for at in range(0, len(of), 1 << 16):
                some = of[at : at + (1 << 16)]
                offsets = np.concatenate([[0], np.cumsum(sizes[some])])
                place = np.arange(offsets[-1]) + np.repeat(starts[some] - offsets[:-1], sizes[some])
                listed = {c: pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(v[place].astype(k))) for c, v, k in (("rows", rows, np.int16), (name, times, kind))}
                yield filled(len(some), base=pa.repeat(base, len(some)), a=pa.array(keys[starts[some]] >> 32), b=pa.array(keys[starts[some]] & 0xFFFFFFFF), **listed)

    def run(batches):
        words, base = remembered(path_a, path_b), TaskContext.get().partitionId() << 33
        ids, counts, lists, held = [], [], [], 0
        for batch in batches:
            for at, (numbers, *listed) in enumerate(words.documents(text.as_py() for text in batch.column(1))):
                ids.append(batch.column(0).slice(at, 1))
                counts.append(numbers)
                lists.append(listed)
                held += len(lists[-1][0]) + 1
                if held >= TOGETHER or len(ids) >= MOST_ROWS:
                    yield from laid_out(base, ids, counts, lists)
                    base += len(ids)
                    ids, counts, lists, held = [], [], [], 0
        if ids:
            yield from laid_out(base, ids, counts, lists)

    return source.mapInArrow(run, schema)


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", part_postings: int = PART_POSTINGS) -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, groups_sha256, n_best and count_sum."""
    coded = common.written(tokens(docs, path_a, path_b, id_col, text_col), "alignment-postings", compression="zstd")
    posted = coded.filter("a IS NOT NULL").select("base", "a", "b", "rows", "few", "times")
    counts = common.written(posted.groupBy("a", "b").agg(F.sum(F.size("rows").cast("long")).alias("n")), "alignment-counts")
    tops = counts.groupBy("a").agg(F.max("n").alias("most"), F.ceil(F.sum("n") / part_postings).cast("int").alias("parts"))
    # A ids in several parts are no more than the vocabulary has
    split = F.broadcast(tops.filter("parts > 1").select("a", F.col("parts").alias("of")))
    dealt = posted.join(split, "a", "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("base"), F.col("of")), F.lit(0)).cast("int")).drop("of")
    known = counts.join(tops, "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    # both sides by side id, so that a pair's postings and its counts meet, sorted by pair
    met = dealt.repartition("a", "part").join(known.repartition("a", "part").hint("merge"), ["a", "part", "b"])
    times = F.coalesce("times", F.col("few").cast("array<int>")).alias("times")
    each = met.select("base", "n", "best", F.explode(F.arrays_zip("rows", times)).alias("p")).select("base", "p.rows", "p.times", "n", "best")
    sums = each.groupBy("base", F.col("rows").alias("row")).agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    found = coded.filter("a IS NULL").select("base", "row", "id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    return found.join(sums, ["base", "row"], "left").select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "groups_sha256", zero("n_best"), zero("count_sum"))
