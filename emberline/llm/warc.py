"""WARC archives: one gzip member per record, written by tasks and read back as a stream.

Writer: digests are computed by Spark, equal payloads are found by grouping digests (payloads stay
where they are), and every task writes one archive into a shared folder. Reader: each archive is
read sequentially in fixed-size blocks through incremental zlib decompression; one gzip member is
one record, framed by its Content-Length, and digests are verified.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import staging_root
from .common import map_batches, query, stage, table

#: Bytes read from an archive at once, and bytes of inflated data handed on at once.
READ_BYTES, INFLATE_BYTES = 1 << 16, 1 << 18
DATE = "2024-01-01T00:00:00Z"


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def base32(hexed: Column) -> Column:
    """Upper-case base32 of a 40-digit hexadecimal SHA-1: four groups of 40 bits, eight letters each."""
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    out = []
    for group in range(4):
        value = F.conv(F.substring(hexed, 1 + 10 * group, 10), 16, 10).cast("long")
        for shift in range(35, -1, -5):
            out.append(F.substring(letters, F.shiftright(value, shift).bitwiseAND(F.lit(31)).cast("int") + 1, F.lit(1)))
    return F.concat(*out)


def payload_digest() -> Column:
    return base32(F.sha1(F.encode(F.coalesce("html", F.lit("")), "UTF-8")))


def record_id(page: object) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page/{page}')}>"


def record(kind: str, page: object, url: str | None, payload: bytes, digest: str, refers: object) -> bytes:
    """A response or revisit record, uncompressed. A revisit has an empty block and the digest of the whole payload."""
    block = b"" if kind == "revisit" else payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {record_id(page)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{sha1_base32(block)}",
        f"X-Page-Id: {'' if page is None else page}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c.isprintable() else "%{:02X}".format(ord(c)) for c in url))
    if kind == "revisit":
        lines += [f"WARC-Refers-To: {record_id(refers)}", f"X-Refers-To-Page: {refers}", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 1) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def members(stream) -> Iterator[Iterator[bytes]]:
    """For each gzip member of a binary stream, its inflated data in bounded parts.

    Each inner iterator must be used up before the next member. A cut or broken member raises.
    """
    state = {"rest": b"", "end": False}

    def more() -> bool:
        if not state["rest"] and not state["end"]:
            state["rest"] = stream.read(READ_BYTES)
            state["end"] = not state["rest"]
        return bool(state["rest"])

    def one() -> Iterator[bytes]:
        inflater = zlib.decompressobj(31)
        while not inflater.eof:
            if not more():
                raise ValueError("the archive ends inside a record")
            part = inflater.decompress(state["rest"], INFLATE_BYTES)
            state["rest"] = inflater.unused_data if inflater.eof else inflater.unconsumed_tail
            if part:
                yield part

    while more():
        yield one()


def read_record(parts: Iterator[bytes]) -> tuple[dict[str, str], int, str, bytearray]:
    """Header fields (lower-case names), block length, block digest and block of one record.

    Raises if the header has no end, the block is shorter or longer than Content-Length, or the
    block digest is wrong.
    """
    head = bytearray()
    for part in parts:
        head += part
        if (at := head.find(b"\r\n\r\n")) >= 0:
            break
    else:
        raise ValueError("a record without the end of its header")
    first, *lines = bytes(head[:at]).decode("utf-8", "surrogatepass").split("\r\n")
    if not first.startswith("WARC/1."):
        raise ValueError(f"not a record: {first[:40]}")
    fields = {name.strip().lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}
    length = int(fields["content-length"])
    block = bytearray(head[at + 4 :])
    for part in parts:
        block += part
        if len(block) > length + 4:
            raise ValueError("a record longer than its Content-Length")
    if len(block) != length + 4 or block[length:] != b"\r\n\r\n":
        raise ValueError("a record that does not match its Content-Length")
    del block[length:]
    digest = sha1_base32(block)
    if fields.get("warc-block-digest", f"sha1:{digest}") != f"sha1:{digest}":
        raise ValueError("a block that does not match its digest")
    return fields, length, digest, block


def marked(pages: DataFrame, least_bytes: int = 0, hot_share: float = 0.001) -> DataFrame:
    """Stored columns page_id, payload_digest, refers_to of the rows whose payload another row holds.

    Of equal payloads of at least ``least_bytes``, the smallest page_id is the response. Rows with
    a null page_id, and repeated rows of the smallest one, are responses. Digests with at least
    ``hot_share`` of all rows (at most 1 / hot_share) are broadcast, the rest is shuffled.
    """
    size = F.octet_length(F.coalesce("html", F.lit("")))
    keys = stage(pages.select("page_id", payload_digest().alias("payload_digest"), size.cast("long").alias("payload_bytes")))
    firsts = stage(
        keys.where(F.col("payload_bytes") >= least_bytes).groupBy("payload_digest", "payload_bytes")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1 AND first IS NOT NULL")
    )
    least = max(2, int(keys.count() * hot_share))
    on = ["payload_digest", "payload_bytes"]
    hot = firsts.where(F.col("n") >= least).select(*on, F.col("first").alias("hot"))
    cold = firsts.where(F.col("n") < least).select(*on, "first").withColumn("side", F.lit(0).cast("long"))
    side = F.when(F.col("hot").isNull(), F.lit(0).cast("long")).otherwise(F.xxhash64("page_id"))
    found = keys.join(F.broadcast(hot), on, "left").withColumn("side", side).join(cold, [*on, "side"], "left")
    first = F.coalesce("hot", "first")
    revisit = first.isNotNull() & F.col("page_id").isNotNull() & (F.col("page_id") != first)
    return stage(found.where(revisit).select("page_id", "payload_digest", first.alias("refers_to")).distinct())


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write one WARC file per task under ``folder``; returns the stored list (path, records).

    Only files in the returned list count: a task that is run again writes a file of another name.
    Null html is an empty payload, a null url gives no target.
    """
    from .common import sized_join

    revisits = marked(pages, least_bytes)
    rows = pages.select("page_id", "url", "html", payload_digest().alias("payload_digest"))
    rows = sized_join(rows, revisits, ["page_id", "payload_digest"], "left").select("page_id", "url", "html", "refers_to")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, count, path = None, 0, f"{folder}/{uuid.uuid4().hex}.warc.gz"
        try:
            for batch in batches:
                for page, url, html, refers in zip(*(batch.column(c) for c in ("page_id", "url", "html", "refers_to")), strict=True):
                    if out is None:
                        store, place = fs.FileSystem.from_uri(path)
                        store.create_dir(place.rpartition("/")[0], recursive=True)
                        out = store.open_output_stream(place, compression=None)
                    payload = (html.as_py() or "").encode("utf-8", "surrogatepass")
                    refers = refers.as_py()
                    out.write(member(record("response" if refers is None else "revisit", page.as_py(), url.as_py(), payload, sha1_base32(payload), refers)))
                    count += 1
        finally:
            if out is not None:
                out.close()
        if count:
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [count]})

    return stage(map_batches(rows, write, "path string, records long"))


READ_SCHEMA = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def read_archives(archives: DataFrame, payloads: bool = False) -> DataFrame:
    """One row per record of the listed archives (column path), with the payload text if asked for.

    Responses are checked against their payload digest and length; a revisit has no payload. A
    damaged archive, or one with another number of records than listed, fails the job.
    """
    schema = READ_SCHEMA + (", html string" if payloads else "")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, records in zip(batch.column("path").to_pylist(), batch.column("records").to_pylist(), strict=True):
                store, place = fs.FileSystem.from_uri(path)
                rows: list[tuple] = []
                seen = size = 0
                with store.open_input_stream(place, compression=None) as stream:
                    for parts in members(stream):
                        fields, length, digest, block = read_record(parts)
                        kind, whole = fields["warc-type"], int(fields["x-payload-length"])
                        named = fields["warc-payload-digest"].removeprefix("sha1:")
                        if kind == "response" and (digest != named or length != whole):
                            raise ValueError(f"{path}: a payload that does not match its digest")
                        page, refers = fields.get("x-page-id"), fields.get("x-refers-to-page")
                        row = (int(page) if page else None, fields.get("warc-target-uri"), whole, named, kind, int(refers) if refers else None)
                        rows.append((*row, block.decode("utf-8", "surrogatepass") if kind == "response" else None) if payloads else row)
                        seen, size = seen + 1, size + length * payloads
                        if len(rows) >= 2000 or size > 8 << 20:
                            yield _rows(rows, payloads)
                            rows, size = [], 0
                if seen != records:
                    raise ValueError(f"{path}: {seen} records, {records} were written")
                if rows:
                    yield _rows(rows, payloads)

    # As many tasks as archives, whatever adaptive execution makes of a short list.
    spread = archives.select("path", "records").repartition(max(1, archives.count()))
    return map_batches(spread, read, schema)


def _rows(rows: list[tuple], payloads: bool) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64()] + [pa.string()] * payloads
    names = [part.split()[0] for part in READ_SCHEMA.split(", ")] + ["html"] * payloads
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def archive_folder(spark: SparkSession) -> str:
    """A new folder below the shared one; as a URI, since tasks open it themselves."""
    root = staging_root(spark).rstrip("/")
    return f"{root if '://' in root or root.startswith('file:') else 'file://' + root}/warc/{uuid.uuid4().hex}"


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS h,
             min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((CAST('0x' || substr(h, CAST(1 + 10 * (i // 8) AS BIGINT), 10) AS BIGINT) >> CAST(35 - 5 * (i % 8) AS BIGINT)) & 31) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""


@query("op8_warc", SQL)
def op8_warc(spark, sf_dir):
    archives = write_archives(table(spark, sf_dir, "pages"), archive_folder(spark))
    return read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
