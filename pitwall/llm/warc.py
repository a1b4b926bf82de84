"""WARC archives: a writer, and a sequential reader that checks what it reads.

One gzip member per record. The reader inflates a member piece by piece, frames the record
by its Content-Length, and checks the digest of the payload it read.

Records with equal payloads: the one with the largest page_id is a ``response`` that holds
the payload; the others are ``revisit`` records that name it and hold none. Payloads below a
least size are all responses. A row that repeats the response in page_id, url and html is a
response too. A null html is an empty payload, a null url an empty target; null page_ids
are lower than any other. Other columns of the input are ignored; an empty table gives no
archives and no rows.
"""

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.llm.tables import stored
from pitwall.llm.taskfiles import attempt_path, opened_for_writing, opened_stream
from pitwall.storage import scratch_folder

DATE = "2024-01-01T00:00:00Z"
READ_BYTES = 1 << 20
COMPRESSION = 3
ROWS_OUT = 1024
_ENTRY = pa.schema(
    [
        ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
    ]
)
_ENTRY_DDL = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "payload binary"
)


def digest(payload: bytes) -> str:
    """Bare upper-case base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, of: str) -> bytes:
    """One record as a gzip member; ``of`` is the digest of the full payload."""
    block = payload if kind == "response" else b""
    fields = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": "".join((url or "").splitlines()),
        "WARC-Payload-Digest": f"sha1:{of}",
        "X-Payload-Length": len(payload),
        "Content-Length": len(block),
    }
    if kind == "revisit":
        fields["WARC-Refers-To"] = f"<urn:page:{'' if refers_to is None else refers_to}>"
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields.items()) + "\r\n"
    packer = zlib.compressobj(COMPRESSION, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def records(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and payload of each record of an archive, in order, holding one record at a time."""
    unread = b""
    while True:
        unread = unread or stream.read(READ_BYTES)
        if not unread:
            return
        inflater = zlib.decompressobj(31)
        data, head_end, length, fields = bytearray(), -1, None, {}
        while not inflater.eof:
            if not unread and not (unread := stream.read(READ_BYTES)):
                raise ValueError("the archive ends within a record")
            data += inflater.decompress(unread)
            unread = inflater.unused_data
            if head_end < 0 and (head_end := data.find(b"\r\n\r\n")) >= 0:
                fields = _fields(bytes(data[:head_end]))
                length = int(fields["Content-Length"])
        if length is None or bytes(data[head_end + 4 + length :]) != b"\r\n\r\n":
            raise ValueError("a record is not framed by its Content-Length")
        block = bytes(data[head_end + 4 : head_end + 4 + length])
        if fields["WARC-Type"] == "response" and f"sha1:{digest(block)}" != fields["WARC-Payload-Digest"]:
            raise ValueError(f"{fields['WARC-Record-ID']}: the payload does not have its digest")
        yield fields, block


def _fields(head: bytes) -> dict[str, str]:
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/1."):
        raise ValueError("a record does not begin with a WARC version")
    return dict(line.split(": ", 1) for line in lines)


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def with_record_types(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, html, and which record each becomes. The pages are shuffled once, by payload digest."""
    page = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    # The digest that decides equality is SHA-256; a row number of its own tells rows of one page_id apart.
    marked = page.withColumn("payload_key", F.sha2("html", 256)).withColumn(
        "row_key", F.struct(F.coalesce("page_id", F.lit(-(2**63))).alias("p"), F.xxhash64("url").alias("u"))
    )
    first = marked.groupBy("payload_key").agg(F.max("row_key").alias("kept_row"), F.count("*").alias("n_equal"))
    shared = first.where("n_equal > 1").drop("n_equal")
    joined = marked.join(shared, "payload_key", "left")
    is_revisit = (
        F.col("kept_row").isNotNull() & (F.octet_length("html") >= least_bytes) & (F.col("kept_row") != F.col("row_key"))
    )
    kept_page = F.when(F.col("kept_row.p") != -(2**63), F.col("kept_row.p"))
    return joined.select(
        "page_id", "url", "html", F.when(is_revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(is_revisit, kept_page).alias("refers_to"),
    )


def write_archives(typed: DataFrame, folder: str) -> DataFrame:
    """An archive per task below folder; their paths and record counts."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, out, n = "", None, 0
        for batch in batches:
            if out is None and batch.num_rows:
                path = attempt_path(folder, ".warc.gz")
                out = opened_for_writing(path)
            for page_id, url, html, kind, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                payload = html.encode()
                out.write(record(kind, page_id, url, payload, refers_to, digest(payload)))
                n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "n_records": [n]})

    columns = typed.select("page_id", "url", "html", "record_type", "refers_to")
    return stored(columns.mapInArrow(write, "path string, n_records long"), "archives")


def read_archives(archives: DataFrame) -> DataFrame:
    """Every record of the archives. The payload of a revisit is null: the response it names has it."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with opened_stream(path) as stream:
                    yield from _entries(stream)

    n_archives = max(1, archives.count())
    return archives.select("path").repartition(n_archives).mapInArrow(read, _ENTRY_DDL)


def _entries(stream) -> Iterator[pa.RecordBatch]:
    rows, held = [], 0
    for fields, block in records(stream):
        response = fields["WARC-Type"] == "response"
        rows.append(
            (
                _page(fields["WARC-Record-ID"]), fields["WARC-Target-URI"], int(fields["X-Payload-Length"]),
                fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"],
                _page(fields.get("WARC-Refers-To")), block if response else None,
            )
        )
        held += len(block)
        if len(rows) == ROWS_OUT or held > 8 * READ_BYTES:
            yield _batch(rows)
            rows, held = [], 0
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ENTRY)], schema=_ENTRY)


def archived(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes the pages to archives in the shared folder and reads every record back."""
    folder = scratch_folder(pages.sparkSession, "warc")
    return read_archives(write_archives(with_record_types(pages, least_bytes), folder))
