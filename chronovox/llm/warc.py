"""WARC archives: writing, segmentation, deduplication and reassembly.

A record's block is an HTTP response whose body is in chunked transfer
framing.  Blocks over ``segment`` bytes are cut into a first record and
continuations, which name the first as their origin; the last also gives the
total length.  Equal payloads are stored once, as the response of the largest
page id; the others are revisit records that name its record.

Every record is a gzip member of its own, so that a reader can begin at any
record.  A file holds records up to FILE_BYTES and is one row of Spark's text
writer, whose separator is an empty gzip member, so archives reach any store
that Spark writes to.  They are read as binary files, inflated and parsed in
a stream.  Whole records are decoded at once; only segments are shuffled,
grouped by origin, ordered by number, checked against the total length, and
decoded.

Rows are numbered and written before anything else: a record's name is its
page's id and number, and so a revisit can give the name of a record that
another task writes.

Defined cases: a null html is the empty payload; a null page id is never
another record's target and sorts below all others, so copies refer to a row
with an id if there is one, and copies without any id are all responses; rows
with the same id and payload are all responses, of which the others refer to
the one numbered last; a payload may be of any length that a string column
holds; further columns are passed over.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Largest block of one record, and of one chunk, in bytes.
SEGMENT, CHUNK = 8192, 4096
#: Line ends and the profile of a revisit.
END = b"\r\n"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: An empty gzip member (header, no data, sum and length of 0).
NOTHING = bytes.fromhex("1f8b08000000000000ff0300") + bytes(8)
#: Bytes of a file, about, and compressed bytes taken from one at once.
FILE_BYTES, READ_AT_ONCE = 32 << 20, 1 << 16
RESULT = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int) -> bytes:
    """Chunked transfer framing."""
    parts = [payload[i : i + size] for i in range(0, len(payload), size)]
    return b"".join([b"%x\r\n%s\r\n" % (len(p), p) for p in parts]) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; trailers are passed over, anything else that is out of form raises."""
    out, at = [], 0
    while True:
        stop = body.index(END, at)
        size = int(body[at:stop].split(b";")[0], 16)
        at = stop + 2
        if not size:
            break
        out.append(body[at : at + size])
        if len(out[-1]) != size or body[at + size : at + size + 2] != END:
            raise ValueError("a chunk does not end where its size says")
        at += size + 2
    while (stop := body.index(END, at)) != at:
        at = stop + 2
    return b"".join(out)


def payload_of(block: bytes) -> tuple[dict[str, str], bytes]:
    """HTTP header fields and decoded payload of a response's block."""
    head, _, body = block.partition(END + END)
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode("latin-1").split("\r\n")[1:])}
    return fields, unchunked(body) if fields.get("transfer-encoding") == "chunked" else body


def record(kind: str, name: str, block: bytes, **fields: str) -> bytes:
    """A record without the two line ends that close it."""
    head = {"WARC-Type": kind, "WARC-Record-ID": f"<{name}>", "WARC-Date": "1970-01-01T00:00:00Z", **{k.replace("_", "-"): v for k, v in fields.items()}, "Content-Length": str(len(block))}
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()).encode() + END + block


def one_line(text: str | None) -> str:
    """A header value: control characters and blanks as in a URI."""
    return "".join([c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in text or ""])


def name_of(page_id: int | None, row: int) -> str:
    return f"urn:page:{'' if page_id is None else page_id}:{row}"


def records_of(name: str, url: str | None, payload: bytes, refers_to: str | None = None, segment: int = SEGMENT, chunk: int = CHUNK) -> list[bytes]:
    """One page's records; ``refers_to`` names the response that has the payload already."""
    at = {"WARC_Target_URI": one_line(url)}
    same = {**at, "Content_Type": "application/http;msgtype=response", "WARC_Payload_Digest": f"sha1:{digest(payload)}"}
    if refers_to is not None:
        head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
        return [record("revisit", name, head, WARC_Profile=SAME_PAYLOAD, WARC_Refers_To=f"<{refers_to}>", **same)]
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n" + chunked(payload, chunk)
    if len(block) <= segment:
        return [record("response", name, block, **same)]
    parts = [block[i : i + segment] for i in range(0, len(block), segment)]
    out = [record("response", name, parts[0], WARC_Segment_Number="1", **same)]
    for k, part in enumerate(parts[1:], 2):
        total = {"WARC_Segment_Total_Length": str(len(block))} if k == len(parts) else {}
        out.append(record("continuation", f"{name}:{k}", part, **at, WARC_Segment_Origin_ID=f"<{name}>", WARC_Segment_Number=str(k), **total))
    return out


def member(data: bytes) -> bytes:
    """A gzip member."""
    out = zlib.compressobj(6, zlib.DEFLATED, 31)
    return out.compress(data) + out.flush()


def parsed(pieces):
    """(header fields, block) of each record in a stream of inflated bytes."""
    held, at = bytearray(), 0
    more = iter(pieces)

    def need(n):
        while len(held) - at < n:
            if not (x := next(more, b"")):
                return False
            held.extend(x)
        return True

    while need(1):
        stop = held.find(END + END, at)
        while stop < 0:
            if not need(len(held) - at + 1):
                raise ValueError("a record's header does not end")
            stop = held.find(END + END, at)
        lines = bytes(held[at:stop]).decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("no record where one should begin")
        fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        size = int(fields["content-length"])
        at = stop + 4
        if not need(size + 4) or held[at + size : at + size + 4] != END + END:
            raise ValueError("a record is cut short")
        yield fields, bytes(held[at : at + size])
        at += size + 4
        if at > READ_AT_ONCE:
            del held[:at]
            at = 0


def inflated(raw: bytes):
    """The bytes of a file of gzip members, in pieces of bounded size, none of them empty."""
    out, view = zlib.decompressobj(31), memoryview(raw)
    for i in range(0, len(raw), READ_AT_ONCE):
        rest = view[i : i + READ_AT_ONCE]
        while len(rest):
            if out.eof:
                out = zlib.decompressobj(31)
            if piece := out.decompress(rest, 64 * READ_AT_ONCE):
                yield piece
            rest = out.unused_data if out.eof else out.unconsumed_tail
    if not out.eof and len(raw):
        raise ValueError("a file is cut short")


def page_of(name: str) -> int | None:
    number = name.strip("<>").split(":")[2]
    return int(number) if number else None


def write(pages: DataFrame, folder: str, least_bytes: int = 0, segment: int = SEGMENT, chunk: int = CHUNK, file_bytes: int = FILE_BYTES) -> None:
    """Write one record per row of ``pages`` (page_id, url, html), and its continuations, as WARC files of gzip members."""
    common.text_session(pages.sparkSession)
    html = F.coalesce("html", F.lit(""))
    source = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), html.alias("html"), F.when(F.octet_length(html) >= least_bytes, F.sha1(html)).alias("digest"))
    numbered = common.written(source.withColumn("row", F.monotonically_increasing_id()), "numbered-pages")
    # Only payloads that occur again are looked up, by narrow rows. Written, so that a payload of very many pages is split in the join.
    last = F.max(F.struct("page_id", "row")).alias("last")
    again = numbered.where("digest is not null").select("digest", "page_id", "row").groupBy("digest").agg(last, F.count("*").alias("n")).where("n > 1").select("digest", "last.*")
    again = common.written(again.withColumnsRenamed({"page_id": "target", "row": "target_row"}), "repeated-payloads")
    revisit = ~F.col("page_id").eqNullSafe(F.col("target"))
    marks = numbered.where("digest is not null").select("digest", "page_id", "row").join(again, "digest").where(revisit).select("row", "target", "target_row")
    # Payloads meet their marks by row, which spreads them evenly; where the marks are small, they go to the payloads.
    marks = common.written(marks, "revisits")
    matched = numbered.join(marks, "row", "left").select("page_id", "row", "url", "html", "target", "target_row")

    def run(batches):
        held, size = [], 0
        # the separator that follows is an empty member
        done = lambda: pa.RecordBatch.from_arrays([pa.array([b"".join(held)], pa.binary())], names=["file"])
        for batch in batches:
            page, row, url, target, target_row = (common.column(batch, c).to_pylist() for c in ("page_id", "row", "url", "target", "target_row"))
            for i, payload in enumerate(common.text_bytes(batch, "html")):
                refers_to = None if target[i] is None else name_of(target[i], target_row[i])
                for one in records_of(name_of(page[i], row[i]), url[i], payload, refers_to, segment, chunk):
                    held.append(member(one + END + END))
                    size += len(held[-1])
                    if size >= file_bytes:
                        yield done()
                        held, size = [], 0
        if held:
            yield done()

    files = matched.mapInArrow(run, "file binary").select(F.col("file").cast("string"))
    files.write.option("lineSep", NOTHING.decode("latin-1")).option("encoding", "ISO-8859-1").option("maxRecordsPerFile", 1).text(folder)
    common.dropped(numbered, again, marks)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every page in the archives."""

    def result(page, payload, promised):
        own = digest(payload)
        if promised != f"sha1:{own}":
            raise ValueError(f"page {page}: the payload's digest is not the record's")
        return page, len(payload), own, "response", None

    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    whole = lambda rows: [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]

    def parse(batches):
        for batch in batches:
            for raw in common.column(batch, "content").to_pylist():
                rows, parts, size = [], [], 0

                def taken():
                    return pa.RecordBatch.from_arrays([*whole(rows), *(pa.array([p[i] for p in parts], k) for i, k in enumerate((pa.string(), pa.int32(), pa.int64(), pa.string(), pa.binary())))], names=[*names, "origin", "number", "total", "promised", "block"])

                for head, block in parsed(inflated(raw)):
                    name, promised = head["warc-record-id"], head.get("warc-payload-digest")
                    number, total = head.get("warc-segment-number"), head.get("warc-segment-total-length")
                    if number:
                        rows.append((None,) * 5)
                        parts.append((head.get("warc-segment-origin-id", name), int(number), int(total) if total else None, promised, block))
                        size += len(block)
                    else:
                        if head["warc-type"] == "revisit":
                            http, _ = payload_of(block)
                            rows.append((page_of(name), int(http["content-length"]), promised.removeprefix("sha1:"), "revisit", page_of(head["warc-refers-to"])))
                        else:
                            rows.append(result(page_of(name), payload_of(block)[1], promised))
                        parts.append((None,) * 5)
                    if len(rows) >= 10_000 or size >= 16 << 20:
                        yield taken()
                        rows, parts, size = [], [], 0
                if rows:
                    yield taken()

    files = spark.read.format("binaryFile").load(folder).select("content")
    found = common.written(files.mapInArrow(parse, f"{RESULT}, origin string, number int, total long, promised string, block binary"), "records")
    # A group is one page's segments.
    groups = found.where("origin is not null").groupBy("origin").agg(F.array_sort(F.collect_list(F.struct("number", "block"))).alias("parts"), F.max("total").alias("total"), F.max("promised").alias("promised"))

    def assemble(batches):
        for batch in batches:
            rows = []
            for origin, parts, total, promised in zip(*(common.column(batch, c).to_pylist() for c in ("origin", "parts", "total", "promised"))):
                if [p["number"] for p in parts] != list(range(1, len(parts) + 1)):
                    raise ValueError(f"{origin}: segments are missing or repeated")
                block = b"".join([p["block"] for p in parts])
                if len(block) != total:
                    raise ValueError(f"{origin}: {len(block)} bytes, not {total}")
                rows.append(result(page_of(origin), payload_of(block)[1], promised))
            yield pa.RecordBatch.from_arrays(whole(rows), names=names)

    return found.where("origin is null").select(*names).union(groups.mapInArrow(assemble, RESULT))
