"""WARC archives with a Zstandard dictionary: writing from a table, and reading back.

An archive is one file: a skippable frame with the dictionary first, then one frame a record, so that any record
can be decompressed alone. The dictionary is trained on the archive's own records (whole records, spread over the archive, up to
``SAMPLE_BYTES``); an archive too small to train one has none.

Of the pages with equal payloads the one with the largest page_id is a response; the others revisit it and hold the
HTTP header alone. Tasks write under names of their own and return them; only the names of tasks that ended well are
in the stored list, so a repeated task or a lost executor leaves at most a file that nothing reads.

Defined cases: a null payload is empty. A page without an id revisits an equal page that has one, else it is a response. Rows that repeat
the largest id are responses alike. A null URL has no WARC-Target-URI. An empty table gives no archive and no row.
Other columns of the input are ignored. A record is held whole in memory, an archive up to ``ARCHIVE_BYTES`` plus one record.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.llm.common import materialise, small_batches
from zonecast.session import scratch_path

# The magic numbers of the dictionary's skippable frame and of a Zstandard frame.
DICTIONARY_MAGIC, FRAME_MAGIC = 0x184D2A5D, 0xFD2FB528
ARCHIVE_BYTES, SAMPLE_BYTES, DICTIONARY_BYTES = 24 << 20, 3 << 20, 64 << 10
DATE = "1970-01-01T00:00:00Z"  # the tables have no time of capture


def _page_uri(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _page_of(uri: str) -> int | None:
    number = uri.removeprefix("<urn:x-page:").removesuffix(">")
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {_page_uri(page_id)}"]
    lines.append(f"WARC-Date: {DATE}")
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: {_page_uri(refers_to)}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def train(records: list[bytes]) -> bytes | None:
    """A dictionary from records spread over the archive, or None if they are too few or too plain."""
    total = sum(map(len, records))
    step = max(1, -(-total // SAMPLE_BYTES))
    samples = [r for r in records[::step] if r]
    size = DICTIONARY_BYTES
    while size > 1024 and 4 * size > sum(map(len, samples)):  # no larger than what it is learnt from allows
        size //= 4
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return None


def write_archive(path: str, records: list[bytes]) -> None:
    dictionary = train(records)
    options = {"write_checksum": True, "write_content_size": True, "level": 6}
    if dictionary:
        options["dict_data"] = zstandard.ZstdCompressionDict(dictionary)
    compressor = zstandard.ZstdCompressor(**options)
    store, name = fs.FileSystem.from_uri(path)
    store.create_dir(name.rpartition("/")[0], recursive=True)
    with store.open_output_stream(name, compression=None) as out:
        if dictionary:
            packed = zstandard.ZstdCompressor(level=6).compress(dictionary)
            out.write(struct.pack("<II", DICTIONARY_MAGIC, len(packed)) + packed)
        for r in records:
            out.write(compressor.compress(r))


def read_archive(path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record."""
    store, name = fs.FileSystem.from_uri(path)
    with store.open_input_stream(name, compression=None) as source:
        head = source.read(8)
        magic, size = struct.unpack("<II", head) if len(head) == 8 else (0, 0)
        if magic == DICTIONARY_MAGIC:
            dictionary = source.read(size)
            if struct.unpack("<I", dictionary[:4])[0] == FRAME_MAGIC:
                dictionary = zstandard.ZstdDecompressor().decompress(dictionary)
            opened = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
            frames = source
        else:
            opened = zstandard.ZstdDecompressor()
            frames = io.BytesIO(head + source.read())
        stream = io.BufferedReader(opened.stream_reader(frames, read_across_frames=True), 1 << 20)
        while stream.readline():
            fields = {}
            while (line := stream.readline().rstrip(b"\r\n")):
                key, _, value = line.decode().partition(": ")
                fields[key] = value
            block = stream.read(int(fields["Content-Length"]))
            stream.read(4)
            yield fields, block


def plan(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(``page_id``, ``url``, ``html``, ``refers_to``, ``revisit``): which page is stored and which refers to it."""
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn(
        "digest", F.concat_ws("-", F.sha1("html"), F.octet_length("html"))
    )
    heads = rows.groupBy(F.col("digest").alias("__digest")).agg(F.max("page_id").alias("head"))
    joined = rows.join(materialise(heads, "payload-heads"), F.col("digest") == F.col("__digest"))
    revisit = (
        F.col("head").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("head")) & (F.octet_length("html") >= least_bytes)
    )
    return joined.select("page_id", "url", "html", F.when(revisit, F.col("head")).alias("refers_to"), revisit.alias("revisit"))


def write(planned: DataFrame, folder: str) -> DataFrame:
    """Writes the archives and returns their stored list (``path``, ``records``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def close() -> pa.RecordBatch:
            path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
            write_archive(path, held)
            return pa.RecordBatch.from_pydict({"path": [path], "records": pa.array([len(held)], pa.int64())})

        held, size = [], 0
        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "html", "refers_to", "revisit")]
            for page_id, url, html, refers_to, revisit in zip(*columns, strict=True):
                payload = html.as_py().encode("utf-8", "surrogatepass")
                held.append(record(page_id.as_py(), url.as_py(), payload, refers_to.as_py(), revisit.as_py()))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    yield close()
                    held, size = [], 0
        if held:
            yield close()

    return materialise(small_batches(planned).mapInArrow(run, "path string, records long"), "warc-list")


def read_back(archives: DataFrame) -> DataFrame:
    """Every record of the listed archives; digest and size of a response are taken from its payload."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                rows = []
                for fields, block in read_archive(path):
                    header, _, payload = block.partition(b"\r\n\r\n")
                    digest, size = fields["WARC-Payload-Digest"].removeprefix("sha1:"), len(payload)
                    if fields["WARC-Type"] == "revisit":
                        size = int(header.rpartition(b"Content-Length: ")[2])
                    elif base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                        raise ValueError(f"a payload in {path} does not have its digest")
                    refers = fields.get("WARC-Refers-To")
                    rows.append(
                        {
                            "page_id": _page_of(fields["WARC-Record-ID"]),
                            "payload_bytes": size,
                            "payload_digest": digest,
                            "record_type": fields["WARC-Type"],
                            "refers_to": None if refers is None else _page_of(refers),
                        }
                    )
                schema = pa.schema(
                    [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
                    + [("record_type", pa.string()), ("refers_to", pa.int64())]
                )
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    # One task an archive: each holds a bounded number of bytes.
    spread = archives.select("path").repartition(max(1, archives.count()))
    return spread.mapInArrow(
        run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    )


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Writes ``pages`` as archives in the shared folder and returns what reading them gives."""
    folder = scratch_path(pages.sparkSession, "warc")
    return read_back(write(plan(pages, least_bytes), folder))
