"""WARC archives of web pages: writing them, and reading them with segment reassembly.

`write_archives` makes a record for each page: a response, or a revisit of the response with the
same payload. A record block of more than `segment_bytes` is cut into a first record and
continuations that name it as their origin. Archives are written by Spark's text writer, whose
line separator is what ends a WARC record, so they go to any store that Spark reaches.

`read_archives` reads whole archives, groups continuations by their origin, orders them by
segment number, verifies that none is missing and that the total length is met, and decodes the
chunked transfer framing. A record that fails is kept with a `problem` and without payload.

An archive holds at most RECORDS_PER_FILE records of at most `segment_bytes` and their headers,
which bounds what a reading task holds.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.skew import checked_join
from ..session import cut_lineage

SEGMENT_BYTES = 64 * 1024
CHUNK_BYTES = 16 * 1024
RECORDS_PER_FILE = 256
_END = b"\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode("ascii")


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """`payload` in the chunked transfer framing."""
    parts = []
    for start in range(0, len(payload), size):
        part = payload[start : start + size]
        parts += [b"%x\r\n" % len(part), part, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes:
    """The payload of a body in the chunked framing; extensions and trailers are passed over."""
    parts, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].partition(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(parts)
        part = body[at : at + size]
        if len(part) < size or body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk is cut short")
        parts.append(part)
        at += size + 2


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A record without the two line ends that close it; line ends in values become spaces."""
    fields = [*headers, ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {' '.join(v.splitlines())}\r\n" for k, v in fields)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block


def records_of(
    identity: str, uri: str | None, payload: bytes, refers_to: str | None, segment_bytes: int
) -> list[bytes]:
    """The record of a page, in as many segments as it takes."""
    digest = ("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}")
    kind = [("Content-Type", "application/http; msgtype=response")]
    target = [] if uri is None else [("WARC-Target-URI", uri)]
    date = ("WARC-Date", "1970-01-01T00:00:00Z")
    if refers_to is not None:
        revisit = [("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<{refers_to}>")]
        head = [("WARC-Type", "revisit"), ("WARC-Record-ID", f"<{identity}>"), date, *target, digest, *revisit, *kind]
        return [record(head, _HTTP + b"\r\n")]
    block = _HTTP + b"Transfer-Encoding: chunked" + _END + chunked(payload)
    parts = [block[i : i + segment_bytes] for i in range(0, len(block), segment_bytes)]
    head = [("WARC-Type", "response"), ("WARC-Record-ID", f"<{identity}>"), date, *target, digest, *kind]
    if len(parts) == 1:
        return [record(head, block)]
    out = [record([*head, ("WARC-Segment-Number", "1")], parts[0])]
    for i, part in enumerate(parts[1:], 2):
        head = [
            ("WARC-Type", "continuation"), ("WARC-Record-ID", f"<{identity}:{i}>"), date, *target,
            ("WARC-Segment-Origin-ID", f"<{identity}>"), ("WARC-Segment-Number", str(i)),
        ]
        if i == len(parts):
            head.append(("WARC-Segment-Total-Length", str(len(block))))
        out.append(record(head, part))
    return out


def parsed(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers, by lower-cased name, and block of each record."""
    at = 0
    while at < len(archive):
        end = archive.index(_END, at)
        lines = archive[at:end].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at byte {at}")
        headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        start = end + len(_END)
        stop = start + int(headers["content-length"])
        if archive[stop : stop + len(_END)] != _END:
            raise ValueError(f"the record at byte {at} is cut short")
        yield headers, archive[start:stop]
        at = stop + len(_END)


def write_archives(
    pages: DataFrame,
    path: str,
    segment_bytes: int = SEGMENT_BYTES,
    least_bytes: int = 0,
    key: str = "page_id",
    uri: str = "url",
    html: str = "html",
) -> None:
    """Write the pages as compressed WARC files below `path`.

    The payload is the text in UTF-8, empty for null. Of records with equal payloads of at least
    `least_bytes` the one with the largest key is the response and the others revisit it; of rows
    that repeat that key one is. A null key comes before all others; the record then has no key.
    """
    rows = cut_lineage(
        pages.select(
            F.col(f"`{key}`").cast("string").alias("k"),
            F.col(f"`{key}`").alias("o"),
            F.col(f"`{uri}`").alias("u"),
            F.coalesce(F.encode(F.col(f"`{html}`"), "UTF-8"), F.lit(b"")).alias("p"),
            F.monotonically_increasing_id().alias("row"),
        )
    )
    codes = rows.select("k", "o", "row", F.sha1("p").alias("code"), F.octet_length("p").alias("n"))
    codes = codes.where(F.col("n") >= least_bytes)
    kept = codes.groupBy("code", "n").agg(
        F.max(F.struct("o", "row")).alias("best"), F.count(F.lit(1)).alias("copies")
    ).where("copies > 1")
    identity = F.concat_ws(":", F.lit("urn:page"), F.coalesce(F.col("best.o").cast("string"), F.lit("")), F.col("best.row"))
    shared = cut_lineage(kept.select("code", "n", F.col("best.row").alias("kept"), identity.alias("refers")))
    revisits = checked_join(codes, shared, ["code", "n"], ["row"]).where("row <> kept").select("row", "refers")
    whole = checked_join(rows.drop("o"), cut_lineage(revisits), ["row"], ["row"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 100):
                out: list[bytes] = []
                for k, row, u, p, refers in zip(*(c.to_pylist() for c in batch.slice(start, 100).columns)):
                    out += records_of(f"urn:page:{k or ''}:{row}", u, p, refers, segment_bytes)
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    made = whole.select("k", "row", "u", "p", "refers").mapInArrow(run, "value binary")
    writer = made.select(F.col("value").cast("string")).write.option("lineSep", _END.decode())
    writer.option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


_READ = (
    "record_id string, kind string, uri string, digest string, refers_to string, "
    "number int, origin string, total bigint, block binary"
)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of all archives below `path`, segments as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                data = content.as_py()
                rows = []
                for h, block in parsed(gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data):
                    number, total = h.get("warc-segment-number"), h.get("warc-segment-total-length")
                    rows.append(
                        {
                            "record_id": h.get("warc-record-id", "").strip("<>"),
                            "kind": h.get("warc-type"),
                            "uri": h.get("warc-target-uri"),
                            "digest": h.get("warc-payload-digest"),
                            "refers_to": h["warc-refers-to"].strip("<>") if "warc-refers-to" in h else None,
                            "number": int(number) if number else None,
                            "origin": h["warc-segment-origin-id"].strip("<>") if "warc-segment-origin-id" in h else None,
                            "total": int(total) if total else None,
                            "block": block,
                        }
                    )
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("content").mapInArrow(run, _READ)


_ARROW = pa.schema(
    [("record_id", pa.string()), ("kind", pa.string()), ("uri", pa.string()), ("digest", pa.string()),
     ("refers_to", pa.string()), ("number", pa.int32()), ("origin", pa.string()), ("total", pa.int64()),
     ("block", pa.binary())]
)


def reassembled(records: DataFrame) -> DataFrame:
    """Whole records: continuations joined to their first segment, with `problem` where that fails.

    A segment that occurs twice counts once. Continuations without a first segment give a record
    with a problem.
    """
    whole = records.where("number is null").select(
        "record_id", "kind", "uri", "digest", "refers_to", "block", F.lit(None).cast("string").alias("problem")
    )
    parts = records.where("number is not null").withColumn("of", F.coalesce("origin", "record_id"))
    first = F.col("number") == 1
    joined = parts.groupBy("of").agg(
        *[F.max(F.when(first, F.col(c))).alias(c) for c in ("kind", "uri", "digest", "refers_to")],
        F.sort_array(F.collect_set(F.struct("number", "block"))).alias("s"),
        F.max("total").alias("total"),
    )
    block = F.aggregate("s.block", F.lit(b""), lambda a, b: F.concat(a, b))
    built = joined.withColumn("block", block)
    size = F.size("s")
    in_order = F.aggregate("s.number", F.lit(0), lambda a, x: F.when(x == a + 1, x).otherwise(-1)) == size
    problem = (
        F.when(~in_order, F.lit("a segment is missing"))
        .when(F.col("total").isNull(), F.lit("the last segment is missing"))
        .when(F.col("total") != F.octet_length("block"), F.lit("the total length is not met"))
    )
    out = built.select(F.col("of").alias("record_id"), "kind", "uri", "digest", "refers_to", "block", problem.alias("problem"))
    return whole.unionByName(out)


_PAYLOAD = "record_id string, kind string, uri string, refers_to string, problem string, payload binary, payload_digest string"


def payloads(whole: DataFrame) -> DataFrame:
    """Whole records with their decoded payload and its digest (bare base32 SHA-1).

    A payload that cannot be decoded, or has another digest than the record says, is a problem.
    A revisit has no payload of its own; its digest is the one it names.
    """
    names = [c.split(" ")[0] for c in _PAYLOAD.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 100):
                rows = []
                for r in batch.slice(start, 100).to_pylist():
                    said = (r.pop("digest") or "").removeprefix("sha1:") or None
                    block, r["payload"], r["payload_digest"] = r.pop("block"), None, None
                    if r["kind"] == "revisit":
                        r["payload_digest"] = said
                    elif r["problem"] is None:
                        try:
                            head, _, body = block.partition(_END)
                            framed = b"transfer-encoding: chunked" in head.lower()
                            r["payload"] = dechunked(body) if framed else body
                            r["payload_digest"] = sha1_base32(r["payload"])
                            if said and said != r["payload_digest"]:
                                r["problem"] = "the payload has another digest"
                        except ValueError as error:
                            r["problem"] = f"the framing is broken: {error}"
                    rows.append(r)
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    kinds = {"string": pa.string(), "binary": pa.binary()}
    schema = pa.schema([(c.split(" ")[0], kinds[c.split(" ")[1]]) for c in _PAYLOAD.split(", ")])
    return whole.mapInArrow(run, _PAYLOAD).select(*names)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives below `path`, reassembled and decoded."""
    return payloads(reassembled(read_records(spark, path)))


def page_digests(records: DataFrame) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest, record_type and refers_to.

    A revisit takes its length from the response that it refers to. Ids are those that
    `write_archives` makes.
    """
    narrow = cut_lineage(
        records.select(
            "record_id", "kind", "refers_to", "payload_digest", F.octet_length("payload").cast("bigint").alias("n")
        )
    )
    responses = narrow.where("kind = 'response'").select(F.col("record_id").alias("refers_to"), F.col("n").alias("m"))
    named = narrow.where("kind = 'revisit'").select("refers_to").distinct()
    wanted = checked_join(responses, cut_lineage(named), ["refers_to"], ["refers_to"], "left_semi")
    joined = checked_join(narrow, cut_lineage(wanted), ["refers_to"], ["record_id"], "left")

    def page(identity: str):
        return F.nullif(F.split_part(F.col(identity), F.lit(":"), F.lit(3)), F.lit("")).cast("bigint")

    return joined.select(
        page("record_id").alias("page_id"),
        F.coalesce("n", "m").alias("payload_bytes"),
        "payload_digest",
        F.col("kind").alias("record_type"),
        page("refers_to").alias("refers_to"),
    )
