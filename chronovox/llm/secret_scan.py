"""Secret scans over whole texts.

An Aho-Corasick automaton over lower-cased text finds keyword hits in one
pass.  A kind's anchored regular expression is then tried only at its hits;
credential formats that embed a checksum count only if it validates.  Bare
hexadecimal strings have no keyword, so their runs are found directly.

Defined cases: a null text is the empty text and has no secrets; offsets are
code points, end exclusive; matches of a kind never overlap (leftmost first),
matches of different kinds may; a text is scanned whole, however long.
Columns other than the id and text are not read by ``find_secrets`` and pass
unchanged through ``redact``.
"""

from __future__ import annotations

import functools
import hashlib
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: The formats.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
GITHUB = r"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])"
NPM = r"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])"
XPRV = r"[xt]prv[1-9A-HJ-NP-Za-km-z]{107}(?![1-9A-HJ-NP-Za-km-z])"
AGE = r"(AGE-SECRET-KEY-)1([QPZRY9X8GF2TVDW0S3JN54KHCE6MUA7L]{58})(?![A-Za-z0-9])"
NSEC = r"(nsec)1([qpzry9x8gf2tvdw0s3jn54khce6mua7l]{58})(?![A-Za-z0-9])"
KINDS = ("assign", "access", "hex", "github", "npm", "xprv", "age", "nsec")
BASE_KINDS = KINDS[:3]
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 12, 18, 16
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "api_key", "apikey"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
    "xprv": ("xprv", "tprv"),
    "age": ("age-secret-key-1",),
    "nsec": ("nsec1",),
}
BASE58 = "123456789ABCDEFGHJKLMNPQRSTUVWXYZabcdefghijkmnopqrstuvwxyz"
BECH32, BECH32_PARTS = "qpzry9x8gf2tvdw0s3jn54khce6mua7l", (0x3B6A57B2, 0x26508E6D, 0x1EA119FA, 0x3D4233DD, 0x2A1462B3)
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

FOUND = "array<struct<kind:string,start:int,end:int,value:string>>"


def checksummed(body: str) -> bool:
    """Whether the last six characters are the base-62 CRC-32 of those before them."""
    want, rest = "", zlib.crc32(body[:-6].encode())
    for _ in range(6):
        rest, digit = divmod(rest, 62)
        want = BASE62[digit] + want
    return body[-6:] == want


def base58_checked(text: str) -> bool:
    """Whether the last four bytes are the start of the twofold SHA-256 of those before them (82 bytes, as of an extended private key)."""
    number = 0
    for c in text:
        number = number * 58 + BASE58.index(c)
    if number.bit_length() > 8 * 82:
        return False
    raw = number.to_bytes(82, "big")
    return hashlib.sha256(hashlib.sha256(raw[:-4]).digest()).digest()[:4] == raw[-4:]


def bech32_checked(prefix: str, body: str) -> bool:
    """Whether prefix and body are a code word: their polynomial over GF(32) leaves 1."""
    prefix = prefix.lower()
    rest = 1
    for value in [*(ord(c) >> 5 for c in prefix), 0, *(ord(c) & 31 for c in prefix), *map(BECH32.index, body.lower())]:
        top, rest = rest >> 25, (rest & 0x1FFFFFF) << 5 ^ value
        for i, part in enumerate(BECH32_PARTS):
            rest ^= part * (top >> i & 1)
    return rest == 1


#: Per kind: pattern tried at a hit, and the test that a match must pass to count.
TESTS = {
    "assign": (re.compile(ASSIGN, re.ASCII), lambda m: len(m[1]) >= ASSIGN_LENGTH),
    "access": (re.compile(ACCESS), lambda m: len(m[0]) >= ACCESS_LENGTH),
    "github": (re.compile(GITHUB), lambda m: checksummed(m[1])),
    "npm": (re.compile(NPM), lambda m: checksummed(m[1])),
    "xprv": (re.compile(XPRV), lambda m: base58_checked(m[0])),
    "age": (re.compile(AGE), lambda m: bech32_checked(m[1], m[2])),
    "nsec": (re.compile(NSEC), lambda m: bech32_checked(m[1], m[2])),
}
LONG_HEX = re.compile(f"[0-9a-f]{{{HEX_LENGTH},}}")


@functools.cache
def automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for kind, words in KEYWORDS.items():
        for word in words:
            a.add_word(word, (kind, len(word)))
    a.make_automaton()
    return a


def lowered(text: str) -> str:
    """Lower case with every character in its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join([x if len(x := c.lower()) == 1 else c for c in text])


def secrets_in(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of every secret, in order."""
    found = []
    until = dict.fromkeys(KEYWORDS, 0)
    for start, kind in sorted((last - n + 1, kind) for last, (kind, n) in automaton().iter(lowered(text))):
        if start >= until[kind]:
            pattern, counts = TESTS[kind]
            if m := pattern.match(text, start):
                until[kind] = m.end()
                if counts(m):
                    found.append((start, KINDS.index(kind), m.end()))
    # A run of hexadecimal digits is maximal, so runs that are long enough are just those of the unbounded pattern.
    found += [(m.start(), 2, m.end()) for m in LONG_HEX.finditer(text)]
    return sorted(found)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id and ``secrets``, an array of (kind, start, end, value)."""
    common.text_session(docs.sparkSession)
    one = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())])

    def scan(batches):
        for batch in batches:
            rows = [[{"kind": KINDS[k], "start": a, "end": b, "value": t[a:b]} for a, k, b in secrets_in(t)] for t in common.texts(batch, "text")]
            yield pa.RecordBatch.from_arrays([common.column(batch, "id"), pa.array(rows, pa.list_(one))], names=["id", "secrets"])

    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(scan, f"id {kind}, secrets {FOUND}").withColumnRenamed("id", id_col)


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The same rows and columns, with each secret's value replaced by ``[kind]``; overlapping secrets become one mark.

    A null text stays null.
    """
    common.text_session(docs.sparkSession)
    place = docs.columns.index(text_col)

    def clean(text: str | None) -> str | None:
        if text is None:
            return None
        out, at = [], 0
        for a, k, b in secrets_in(text):
            if a >= at:
                out += [text[at:a], f"[{KINDS[k]}]"]
            at = max(at, b)
        return "".join([*out, text[at:]]) if out else text

    def scan(batches):
        for batch in batches:
            field = batch.schema.field(place)
            yield pa.RecordBatch.from_arrays([pa.array([clean(t) for t in c.to_pylist()], field.type) if i == place else c for i, c in enumerate(batch.columns)], schema=batch.schema)

    return docs.mapInArrow(scan, docs.schema)
