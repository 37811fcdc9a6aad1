"""WARC archives of pages, written and read in parallel, and the chunked record table.

Writing: every task streams its pages into an archive of its own in the shared folder, one gzip member
per record, and reports where each record lies. The reports are written as a table, so a task that is
run again leaves an archive nobody refers to, and no record is lost or doubled. Of records with equal
payloads that with the smallest page id is the response, the others are revisits without a payload.

Reading: archives are cut at record borders into splits of about equal size. A split is read front to
back in blocks, and a payload becomes rows of one chunk each: record, chunk number, position, bytes,
and the SHA-1 of the payload up to the chunk's end, carried on from chunk to chunk. Neither side builds
a whole record: the writer compresses views of the page's buffer, the reader holds a chunk and a block.
The digest of the last chunk is that of the whole payload.

Defined results: a null page is an empty payload. Payloads below `revisit_bytes` are always responses.
A null page id comes after all others. If rows with the smallest page id are repeated, each is a
response. A null address leaves out the header; control characters in it are percent-encoded. An empty
table gives no archives and an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm.base import query, table
from plumbline.session import pinned, scratch_path

BLOCK = 1 << 20  # bytes that are compressed or decompressed at a time
CHUNK = 1 << 20  # payload bytes of a row
SPLIT = 16 << 20  # archive bytes that one task reads
DATE = "2024-01-01T00:00:00Z"

# Names and forms of the archive format, and the extension fields used here.
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE, REFERS, LENGTH = "X-Page-ID", "X-Refers-To-Page-ID", "X-Payload-Length"

MANIFEST = "archive string, offset bigint, size bigint, page_id bigint"
CHUNKS = (
    "archive string, record string, page_id bigint, record_type string, uri string, refers_to bigint, declared_digest string, "
    "declared_bytes bigint, chunk bigint, start bigint, size bigint, last boolean, digest string, payload binary"
)


def classify(pages: DataFrame, revisit_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, sha1, bytes, refers_to): refers_to is the response's page id for revisits, else null."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url", payload.alias("payload"), F.sha1(payload.cast("binary")).alias("sha1"), F.octet_length(payload).cast("bigint").alias("bytes")
    )
    first = rows.groupBy("sha1").agg(F.min("page_id").alias("first"))
    copy = (F.col("bytes") >= revisit_bytes) & F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(first, "sha1").withColumn("refers_to", F.when(copy, F.col("first"))).drop("first")


def _record_name(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def _head(page_id, url, digest: str, size: int, refers_to, date: str) -> bytes:
    fields = {"WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": _record_name(page_id), "WARC-Date": date}
    if url is not None:
        fields["WARC-Target-URI"] = "".join(c if c > " " else f"%{ord(c):02X}" for c in url)
    fields["WARC-Payload-Digest"] = f"sha1:{digest}"
    if refers_to is not None:
        fields |= {"WARC-Profile": PROFILE, "WARC-Refers-To": _record_name(refers_to), REFERS: refers_to}
    if page_id is not None:
        fields[PAGE] = page_id
    fields |= {LENGTH: size, "Content-Type": "application/http; msgtype=response"}
    fields["Content-Length"] = len(HTTP) + (size if refers_to is None else 0)
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n").encode()


def write_archives(classified: DataFrame, folder: str, level: int = 3, date: str = DATE) -> DataFrame:
    """Write the records below `folder`, an address that all executors reach. Returns the manifest."""

    def write(batches):
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        out, at = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            out = out or fs.open_output_stream(f"{root}/{name}", compression=None)  # the members are compressed one by one
            rows = []
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ("page_id", "url", "sha1", "bytes", "refers_to")]
            payloads = batch.column(batch.schema.get_field_index("payload"))
            for i, (page_id, url, sha1, size, refers_to) in enumerate(zip(*(c.to_pylist() for c in columns))):
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                member, start = zlib.compressobj(level, zlib.DEFLATED, 31), at
                parts = [_head(page_id, url, digest, size, refers_to, date) + HTTP]
                if refers_to is None and size:
                    whole = memoryview(payloads[i].as_buffer())
                    parts += [whole[k : k + BLOCK] for k in range(0, size, BLOCK)]
                for part in (*parts, b"\r\n\r\n"):
                    out.write(member.compress(part))
                out.write(member.flush())
                at = out.tell()
                rows.append((name, start, at - start, page_id))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int64(), pa.int64(), pa.int64()))], ["archive", "offset", "size", "page_id"]
            )
        if out:
            out.close()

    return pinned(classified.mapInArrow(write, MANIFEST), "warc-manifest")


class _Members:
    """The gzip members of a range of a file, each as a stream of blocks."""

    def __init__(self, stream, size: int):
        self.stream, self.left, self.raw = stream, size, b""

    def more(self) -> bool:
        if not self.raw and self.left:
            self.raw = self.stream.read(min(BLOCK, self.left))
            self.left -= len(self.raw)
        return bool(self.raw)

    def blocks(self):
        member = zlib.decompressobj(31)
        while not member.eof and self.more():
            block = member.decompress(self.raw, BLOCK)
            self.raw = member.unused_data if member.eof else member.unconsumed_tail
            if block:
                yield block
        if not member.eof:
            raise ValueError("an archive ends inside a record")


def _until(held: bytearray, blocks, mark: bytes) -> bytes:
    """Take everything up to and with `mark` off the front."""
    while (end := held.find(mark)) < 0:
        held += next(blocks)
    found = bytes(held[: end + len(mark)])
    del held[: end + len(mark)]
    return found


def record_chunks(members: _Members, chunk: int):
    """(fields, chunk number, start, payload bytes, last, digest so far) of one record after another."""
    while members.more():
        blocks = members.blocks()
        held = bytearray()
        head = _until(held, blocks, b"\r\n\r\n").decode().split("\r\n")
        if not head[0].startswith("WARC/"):
            raise ValueError("not a record")
        fields = dict(line.split(": ", 1) for line in head[1:] if line)
        size = int(fields["Content-Length"]) - len(_until(held, blocks, b"\r\n\r\n"))
        state, start, number = hashlib.sha1(), 0, 0
        while True:
            want = min(chunk, size - start)
            while len(held) < want:
                held += next(blocks)
            part = bytes(held[:want])
            del held[:want]
            state.update(part)
            last = start + want == size
            yield fields, number, start, part, last, base64.b32encode(state.digest()).decode()
            start, number = start + want, number + 1
            if last:
                break
        for block in blocks:  # what closes the record
            held += block
        if held != b"\r\n\r\n":
            raise ValueError("a record is longer than it says")


def splits_of(manifest: DataFrame, split: int = SPLIT) -> DataFrame:
    """(archive, offset, size): ranges of whole records of about `split` bytes."""
    part = F.floor(F.col("offset") / split)
    return manifest.groupBy("archive", part.alias("_part")).agg(F.min("offset").alias("offset"), F.sum("size").alias("size")).drop("_part")


def read_chunks(splits: DataFrame, folder: str, chunk: int = CHUNK, payload: bool = True) -> DataFrame:
    """The chunked record table of the archives' ranges. Without `payload` that column is null."""

    def read(batches):
        fs, root = pafs.FileSystem.from_uri(folder)
        number = lambda x: None if x is None else int(x)
        types = pa.schema([(n, {"bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}[t]) for n, t in (c.split() for c in CHUNKS.split(", "))])
        for batch in batches:
            for split in batch.to_pylist():
                rows, held = [], 0
                with fs.open_input_file(f"{root}/{split['archive']}") as stream:
                    stream.seek(split["offset"])
                    for f, k, start, part, last, digest in record_chunks(_Members(stream, split["size"]), chunk):
                        rows.append(
                            (split["archive"], f["WARC-Record-ID"], number(f.get(PAGE)), f["WARC-Type"], f.get("WARC-Target-URI"), number(f.get(REFERS)))
                            + (f["WARC-Payload-Digest"].removeprefix("sha1:"), int(f[LENGTH]), k, start, len(part), last, digest, part if payload else None)
                        )
                        held += len(part) if payload else 100
                        if held > 8 * BLOCK:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types.types)], schema=types)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types.types)], schema=types)

    # rows of splits are tiny: without a number they would be merged into one task that reads all archives
    tasks = max(1, splits.count())
    return splits.select("archive", "offset", "size").repartition(tasks, "archive", "offset").mapInArrow(read, CHUNKS)


def archive(pages: DataFrame, folder: str, revisit_bytes: int = 0) -> DataFrame:
    """Write the pages and return the manifest's ranges to read."""
    return splits_of(write_archives(classify(pages, revisit_bytes), folder))


# Five bytes of the digest make eight characters of base32.
BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(x, {1 + 10 * g}, 10))::bigint >> {35 - 5 * i}) & 31)::int + 1, 1)" for g in range(4) for i in range(8)
)
SQL = f"""with p as (select page_id, sha1(coalesce(html, '')) as x, strlen(coalesce(html, '')) as payload_bytes from pages),
  first as (select x, min(page_id) as f from p group by x)
  select page_id, payload_bytes, {BASE32} as payload_digest, case when page_id = f then 'response' else 'revisit' end as record_type,
    case when page_id <> f then f end as refers_to from p join first using (x)"""


@query("op8_warc", SQL)
def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    where = scratch_path(spark, "warc")
    rows = read_chunks(archive(table(spark, folder, "pages"), where), where, payload=False).where("last")
    revisit = F.col("record_type") == "revisit"
    return rows.select(
        "page_id",
        F.when(revisit, F.col("declared_bytes")).otherwise(F.col("start") + F.col("size")).alias("payload_bytes"),
        F.when(revisit, F.col("declared_digest")).otherwise(F.col("digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
    )
