"""WARC archives: written whole, normalised to one gzip member per record, read by an index."""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tractwise.llm.tables import Stored
from tractwise.session import replicated_if_small, scratch_path

CHUNK = 1 << 20
#: Payloads below this size are always stored, never referred to.
REVISIT_BYTES = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LENGTH = re.compile(rb"\r\nContent-Length: *(\d+)", re.I)
INDEX = "archive string, offset bigint, length bigint, record_id string"


def _opened(path: str):
    """The file system of a path and the path on it; executors share what it names."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if re.match(r"\w+:/", path) else (fs.LocalFileSystem(), path)


def _record(page: int, url: str, payload: bytes, size: int, digest: str, refers: int | None) -> bytes:
    """One record: headers, an HTTP response, and for a revisit no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    body = http + (payload if refers is None else b"")
    uri = re.sub(r"[\r\n]+", " ", url)
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if refers is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{page}>", f"WARC-Target-URI: {uri}", "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{digest}", f"WARC-Payload-Length: {size}",
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}",
    ]
    if refers is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers}>", f"WARC-Profile: {PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def _written(folder: str):
    def run(batches: Iterator[pa.RecordBatch]):
        system, base = _opened(folder)
        # a repeated task writes a file of its own; only the names returned are read
        name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        pack, out = zlib.compressobj(1, zlib.DEFLATED, 31), None
        for batch in batches:
            for page, url, html, size, digest, refers in zip(*[c.to_pylist() for c in batch.columns]):
                out = out or system.open_output_stream(f"{base}/{name}", compression=None)
                out.write(pack.compress(_record(page, url or "", html or b"", size, digest, refers)))
        if out:
            out.write(pack.flush())
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"])], ["archive"])
    return run


def write_monolithic(records: DataFrame, folder: str) -> DataFrame:
    """One archive per partition, each a single gzip stream; their paths as ``archive``.

    Reads ``page_id``, ``url``, ``html`` (binary), ``payload_bytes``, ``payload_digest``,
    ``refers_to``.
    """
    system, base = _opened(folder)
    system.create_dir(base)
    columns = ("page_id", "url", "html", "payload_bytes", "payload_digest", "refers_to")
    return records.select(*columns).mapInArrow(_written(folder), "archive string")


def _inflated(stream) -> Iterator[bytes]:
    """What a gzip file holds, all its members, in parts."""
    unpack = zlib.decompressobj(31)
    while chunk := stream.read(CHUNK):
        while chunk:
            yield unpack.decompress(chunk)
            chunk = unpack.unused_data
            if unpack.eof:
                unpack = zlib.decompressobj(31)


def _records(stream) -> Iterator[bytes]:
    """The records of an inflated archive, one at a time: header, block and closing lines."""
    held, need, parts = bytearray(), 0, _inflated(stream)
    for part in parts:
        held += part
        while True:
            if not need:
                head = held.find(b"\r\n\r\n")
                if head < 0:
                    break
                need = head + 8 + int(LENGTH.search(bytes(held[: head + 2]))[1])
            if len(held) < need:
                break
            yield bytes(held[:need])
            del held[:need]
            need = 0
    if held:
        raise ValueError(f"an archive ends within a record ({len(held)} bytes left)")


def _normalised(folder: str):
    def run(batches: Iterator[pa.RecordBatch]):
        system, base = _opened(folder)
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                own, path = _opened(archive)
                name = f"{archive.rsplit('/', 1)[-1].removesuffix('.warc.gz')}-{uuid.uuid4().hex}.warc.gz"
                rows, offset = [], 0
                with own.open_input_stream(path, compression=None) as source, \
                        system.open_output_stream(f"{base}/{name}", compression=None) as out:
                    for record in _records(source):
                        pack = zlib.compressobj(6, zlib.DEFLATED, 31)
                        member = pack.compress(record) + pack.flush()
                        out.write(member)
                        found = re.search(rb"WARC-Record-ID: *<([^>]*)>", record)
                        rows.append((f"{folder}/{name}", offset, len(member), found[1].decode() if found else None))
                        offset += len(member)
                with system.open_output_stream(f"{base}/{name}.idx", compression=None) as index:
                    for _, at, length, record_id in rows:
                        index.write(f"{at}\t{length}\t{record_id or ''}\n".encode())
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c) for c in zip(*rows)], ["archive", "offset", "length", "record_id"])
    return run


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Archives (``archive``: any gzip WARC) with every record as a gzip member of its own.

    Each file is inflated once, from begin to end, holding one record at a time; the new
    file gets a sidecar ``.idx`` of offsets and lengths, which is also returned:
    ``archive``, ``offset``, ``length``, ``record_id``. Of a repeated task's files those
    returned count.
    """
    system, base = _opened(folder)
    system.create_dir(base)
    return archives.select("archive").mapInArrow(_normalised(folder), INDEX)


def _page(record_id: str) -> int:
    return int(record_id.strip("<>").rpartition(":")[2])


def _read(batches: Iterator[pa.RecordBatch]):
    last, stream = None, None
    for batch in batches:
        rows = []
        for archive, offset, length, _ in zip(*[c.to_pylist() for c in batch.columns]):
            if archive != last:
                system, path = _opened(archive)
                last, stream = archive, system.open_input_file(path)
            stream.seek(offset)
            record = zlib.decompress(stream.read(length), 31)
            head, _, block = record.partition(b"\r\n\r\n")
            fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in head.decode().split("\r\n"))}
            _, _, payload = block[: int(fields["content-length"])].partition(b"\r\n\r\n")
            stated = (int(fields["warc-payload-length"]), fields["warc-payload-digest"].rpartition(":")[2])
            # what a revisit leaves out is known by its header alone
            full = stated if fields["warc-type"] == "revisit" else (
                len(payload), hashlib.sha256(payload).hexdigest())
            refers = fields.get("warc-refers-to")
            rows.append((
                _page(fields["warc-record-id"]), fields["warc-target-uri"], fields["warc-type"], payload, *full,
                _page(refers) if refers else None, full == stated))
        if rows:
            kinds = (pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64(), pa.bool_())
            names = ("page_id", "url", "record_type", "payload", "payload_bytes", "payload_digest", "refers_to", "sound")
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], list(names))


def read(index: DataFrame) -> DataFrame:
    """The records an index names, each read by its offset: ``page_id``, ``url``,
    ``record_type``, ``payload`` (of a response), ``payload_bytes``, ``payload_digest``,
    ``refers_to`` and ``sound``: whether a response's payload, whose size and digest are
    computed, has those its header states."""
    return index.mapInArrow(
        _read, "page_id bigint, url string, record_type string, payload binary, payload_bytes bigint, "
        "payload_digest string, refers_to bigint, sound boolean")


def archive_pages(
    pages: DataFrame, *, folder: str | None = None, id_column: str = "page_id", url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """Writes ``pages`` to archives, normalises them, and reads them back by their index.

    Of records with equal payloads of at least 100 bytes, the one with the smallest id
    is a response and the others are revisits that refer to it (rows that repeat that id
    and payload are responses alike); smaller ones, NULL among them (empty), are all
    responses. Rows without an id are left out: a record needs a name. ``folder`` is a
    place all executors share, by default under ``spark.checkpoint.dir``. The smallest
    ids are aggregated before the shuffle, and digests are joined with no text beside
    them. An empty table gives an empty result. See ``read`` for the columns.
    """
    spark = pages.sparkSession
    stored = Stored(spark)
    folder = folder or scratch_path(spark, "warc")
    html = F.coalesce(F.col(html_column).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_column).cast("bigint").alias("page_id"), F.col(url_column).cast("string").alias("url"),
                        html.alias("html")).where("page_id is not null").withColumns({
        "payload_bytes": F.octet_length("html").cast("bigint"), "payload_digest": F.sha2("html", 256)})
    firsts = rows.where(F.col("payload_bytes") >= REVISIT_BYTES).groupBy("payload_digest").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    firsts = stored(firsts.select(F.col("payload_digest").alias("digest"), "first"))
    same = (F.col("payload_bytes") >= REVISIT_BYTES) & (F.col("payload_digest") == F.col("digest"))
    typed = rows.join(replicated_if_small(firsts), same, "left").withColumn(
        "refers_to", F.when(F.col("first") != F.col("page_id"), F.col("first")))
    archives = stored(write_monolithic(typed, f"{folder}/whole"))
    # paths and index rows are few bytes for much work, so Spark must not merge their tasks by size
    tasks = max(1, archives.count())
    index = stored(normalise(archives.repartition(tasks), f"{folder}/records"))
    return read(index.repartitionByRange(tasks, "archive", "offset").sortWithinPartitions("archive", "offset"))
