"""Language identification by cross-parsing.

Labelled text of each language becomes a suffix automaton, whose states follow
every substring of it.  A text is parsed greedily: each phrase is the longest
match in the language's text from where the one before ended.  Text of the
same language needs fewer phrases; a phrase costs as many bits as a place in
the language's text has, and the language of fewest bits wins (the first by
name on ties).  The score is that language's share if a bit halves a share.

Text is lower-cased UTF-8; ASCII characters that are no letters become
one space for each run, and a space goes before and after.  It is parsed in
blocks of 256 bytes, in which phrases begin anew, so that the blocks of many
texts go through all automata at once, one table look-up a byte and language.

What is learned from is bounded: 128 KB a language and 512 KB in all, of
passages of at most 2,000 characters, one from each labelled text, chosen by
the texts' hashes alone.  So the automata can be sent to every task, where their
table takes some 130 MB with four languages.  Phrases of every whole text are
counted.

Defined cases: a null text, or one without a letter (Unicode category L), is
``und`` with score 0, and so is every text where nothing is labelled.  A
labelled text that is null or has no letter teaches nothing.  Equal rows are
alike.  A text may be of any length; it is parsed in slices of a million
characters.  An empty table gives an empty result.  Further columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import io
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

UNDETERMINED = "und"
#: Bytes of labelled text for a language and for all; characters of a passage.
PER_LANGUAGE, IN_ALL, PASSAGE = 1 << 17, 1 << 19, 2000
BLOCK, SLICE, AT_ONCE = 256, 1 << 20, 1 << 21
#: ASCII letters in lower case and bytes beyond ASCII stand for themselves.
FOLDED = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
LETTER = r"\p{L}"


def folded(text: str) -> np.ndarray:
    """A slice of text as bytes to parse."""
    raw = np.frombuffer(f" {text} ".lower().encode().translate(FOLDED), np.uint8)
    again = raw == 32
    again[1:] &= again[:-1].copy()
    again[0] = False
    return raw[~again]


def automaton(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Transitions of the suffix automaton: from state, byte, to state; 0 is the root."""
    arcs: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in text:
        new = len(arcs)
        arcs.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in arcs[p]:
            arcs[p][c] = new
            p = link[p]
        if p >= 0:
            q = arcs[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                twin = len(arcs)
                arcs.append(dict(arcs[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and arcs[p].get(c) == q:
                    arcs[p][c] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    sizes = [len(a) for a in arcs]
    byte = np.fromiter((c for a in arcs for c in a), np.uint8, sum(sizes))
    to = np.fromiter((t for a in arcs for t in a.values()), np.int32, sum(sizes))
    return np.repeat(np.arange(len(arcs), dtype=np.int32), sizes), byte, to


class Parser:
    """All languages' automata in one table: entries are the next state, doubled, and 1 where a phrase begins."""

    def __init__(self, languages: list[tuple[str, int, bytes]]):
        self.names = [name for name, _, _ in languages]
        #: Bits of a phrase.
        self.bits = np.array([math.log2(max(2, size)) for _, size, _ in languages])
        parts = [np.load(io.BytesIO(blob)) for _, _, blob in languages]
        known = np.unique(np.concatenate([p["byte"] for p in parts])) if parts else np.zeros(0, np.uint8)
        self.kind = np.zeros(256, np.intp)  # 0: no language has this byte
        self.kind[known] = np.arange(1, len(known) + 1)
        self.width = len(known) + 1
        self.roots, tables, base = [], [], 0
        for p in parts:
            states = int(max(p["to"].max(initial=0), p["of"].max(initial=0))) + 1
            table = np.full((states, self.width), -1, np.int32)
            table[p["of"], self.kind[p["byte"]]] = p["to"]
            anew = np.where(table[0] < 0, 0, table[0])
            known_arc = table >= 0
            table = np.where(known_arc, table, anew) + base
            table *= 2
            table += ~known_arc
            table[0] |= 1
            tables.append(table.ravel())
            self.roots.append(base)
            base += states
        self.table = np.concatenate(tables) if tables else np.zeros(0, np.int32)

    def phrases(self, pieces: list[np.ndarray]) -> np.ndarray:
        """Phrases of each piece (row) in each language."""
        sizes = np.array([len(p) for p in pieces])
        blocks = -(-sizes // BLOCK)
        owner = np.repeat(np.arange(len(pieces)), blocks)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        long = np.minimum(BLOCK, sizes[owner] - nth * BLOCK)
        order = np.argsort(-long, kind="stable")
        # one row a place in the block, so that each step reads a row
        kinds = self.kind[np.concatenate([np.pad(p, (0, int(n) * BLOCK - len(p))) for p, n in zip(pieces, blocks, strict=True)])]
        kinds = np.ascontiguousarray(kinds.reshape(-1, BLOCK)[order].T)
        active = np.searchsorted(-long[order], -np.arange(BLOCK), side="left")
        counts = np.zeros((len(self.names), len(owner)), np.int32)
        for k, root in enumerate(self.roots):
            state, count = np.full(len(owner), root, np.intp), counts[k]
            for place in range(BLOCK):
                n = active[place]
                if not n:
                    break
                found = self.table[state[:n] * self.width + kinds[place, :n]]
                count[:n] += found & 1
                state[:n] = found >> 1
        out = np.zeros((len(pieces), len(self.names)), np.int64)
        np.add.at(out, owner[order], counts.T)
        return out

    def judge(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        phrases, waiting, owners, held = np.zeros((len(texts), len(self.names)), np.int64), [], [], 0
        lettered = [bool(self.names) and text is not None and any(map(str.isalpha, text)) for text in texts]
        for i, text in enumerate(texts):
            for at in range(0, len(text) if lettered[i] else 0, SLICE):
                waiting.append(folded(text[at : at + SLICE]))
                owners.append(i)
                held += len(waiting[-1])
                if held >= AT_ONCE:
                    np.add.at(phrases, owners, self.phrases(waiting))
                    waiting, owners, held = [], [], 0
        if waiting:
            np.add.at(phrases, owners, self.phrases(waiting))
        if not self.names:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts)
        cost = phrases * self.bits
        best = cost.argmin(axis=1)
        share = 1 / np.exp2(-np.minimum(cost - cost.min(axis=1, keepdims=True), 1000.0)).sum(axis=1)
        return [self.names[b] if ok else UNDETERMINED for b, ok in zip(best, lettered, strict=True)], np.where(lettered, share, 0.0).tolist()


def fit(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text", per_language: int = PER_LANGUAGE, in_all: int = IN_ALL) -> list[tuple[str, int, bytes]]:
    """(language, bytes learned from, automaton) by name, from a bounded choice of the labelled texts."""
    rows = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).filter(F.col("lang").isNotNull() & F.col("text").rlike(LETTER))
    rows = rows.select("lang", "text", F.xxhash64("text").alias("hash"), F.least(F.length("text"), F.lit(PASSAGE)).cast("long").alias("size"))
    sizes = rows.groupBy("lang").agg(F.sum("size").alias("there"))
    counted = sizes.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    limit = max(1, min(per_language, in_all // max(1, counted)))
    # twice the wanted, as copies count once and white space is dropped
    # written, so that its size is known: it goes to the tasks where it is small, instead of all texts to it
    share = common.written(sizes.select("lang", (F.lit(2.0 * limit) / F.col("there")).alias("share")), "languages")
    start = F.pmod(F.xxhash64("hash"), F.length("text") - F.col("size") + 1).cast("int") + 1
    drawn = F.shiftrightunsigned("hash", 1).cast("double") / 2.0**63
    chosen = rows.join(share, "lang").filter(drawn < F.col("share")).select("lang", F.substring("text", start, F.lit(PASSAGE)).alias("passage")).distinct()

    def learn(passages: pd.DataFrame) -> pd.DataFrame:
        keyed = sorted((hashlib.blake2b(p.encode(), digest_size=8).digest(), p) for p in passages["passage"])
        text, size = [], 0
        for _, passage in keyed:
            if size >= limit:
                break
            text.append(folded(passage).tobytes()[: limit - size])
            size += len(text[-1])
        out = io.BytesIO()
        of, byte, to = automaton(b"\0".join(text))  # no text has the byte 0, so no phrase goes over a border
        np.savez_compressed(out, of=of, byte=byte, to=to)
        return pd.DataFrame({"lang": [passages["lang"].iloc[0]], "size": [size], "model": [out.getvalue()]})

    found = chosen.groupBy("lang").applyInPandas(learn, "lang string, size long, model binary").collect()
    return sorted((r["lang"], r["size"], bytes(r["model"])) for r in found)


#: The tables of the last model that a worker used.
_HELD: dict[int, Parser] = {}


def predict(docs: DataFrame, model: list[tuple[str, int, bytes]], id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """id, ``lang_pred``, ``score`` and any columns to ``keep``, one row per row of ``docs``."""
    common.text_session(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    key = int.from_bytes(hashlib.blake2b(repr(model).encode(), digest_size=8).digest(), "big")

    def run(batches):
        if key not in _HELD:
            _HELD.clear()
            _HELD[key] = Parser(sent.value)
        for batch in batches:
            names, scores = _HELD[key].judge(common.column(batch, "__text").to_pylist())
            rest = [(n, common.column(batch, n)) for n in batch.schema.names if n != "__text"]
            yield pa.RecordBatch.from_arrays([*(c for _, c in rest), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*(n for n, _ in rest), "lang_pred", "score"])

    source = docs.select(id_col, *keep, F.col(text_col).alias("__text"))
    kinds = ", ".join(f"`{n}` {source.schema[n].dataType.simpleString()}" for n in (id_col, *keep))
    return source.mapInArrow(run, f"{kinds}, lang_pred string, score double")
