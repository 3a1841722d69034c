"""WARC archives through a chunked record table.

A record is rows of (record_id, chunk, data).  ``chunked`` cuts payloads into such rows where they are scanned, so what is
shuffled, sorted and handed to Python are chunks, never a whole payload; ``write`` streams the rows into archives, a gzip
member for each record, and ``read`` streams archives back into rows.  Writer and reader hold one chunk at a time and carry a
SHA-1 from chunk to chunk, so the last chunk of a record has the digest of the whole payload and no step holds a payload
again to know it.  A payload whose chunks do not give the digest announced in its header is an error on either side.

Equal payloads are written once: the largest record id of each group is the response, the others are revisits of it
without a block.  A group is found by digest and length, reduced before the shuffle, whatever its size; ids and digests
alone are joined for it, and payloads meet the verdict by their own id, so copies of a frequent payload do not meet.

Archives go through ``pyarrow.fs`` into a folder that the driver and executors share.  A task writes one archive under a
name of its own attempt, and only archives named in the manifest (a stored table, which holds finished tasks only) are
read, so a task that runs twice counts once.

Defined cases: a null payload is empty; payloads below ``least_bytes`` are always responses; repeated ids are records of
their own that share an id, and are told apart by a number within it; a null id is written as an empty one and read back as null; an
empty table makes no archive.  Urls are percent-encoded where they hold blanks or control characters, null ones are left out.
"""

from __future__ import annotations

import base64
import hashlib
import re
import urllib.parse
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finlake.session import scratch_path, stored

#: Bytes of payload in a chunk.
CHUNK = 1 << 20
RESPONSE, REVISIT = "response", "revisit"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32(sha1_hex: Column) -> Column:
    """Upper-case base32 of a hexadecimal SHA-1 (40 digits make 32 letters, five bits each)."""
    bits = F.concat(*[F.lpad(F.conv(F.substring(sha1_hex, 1 + 10 * k, 10), 16, 2), 40, "0") for k in range(4)])
    letters = F.split(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), "")
    return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(31)), lambda k: F.element_at(letters, F.conv(F.substring(bits, k * 5 + 1, F.lit(5)), 2, 10).cast("int") + 1)), "")


def _body(payload_col: str) -> Column:
    return F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))


def _digests(pages: DataFrame, id_col: str, payload_col: str) -> DataFrame:
    body = _body(payload_col)
    return pages.select(F.col(id_col).alias("id"), F.sha1(body).alias("sha1"), F.length(body).cast("bigint").alias("payload_bytes"))


def verdicts(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", least_bytes: int = 0) -> DataFrame:
    """(id, sha1, payload_bytes, record_type, refers_to): a row for each different id and payload; no payload is shuffled."""
    seen = _digests(pages, id_col, payload_col).groupBy("sha1", "payload_bytes", "id").agg(F.count("*").alias("rows"))
    first = seen.groupBy("sha1", "payload_bytes").agg(F.max("id").alias("holder"))
    out = seen.join(first, ["sha1", "payload_bytes"])
    again = (F.col("payload_bytes") >= least_bytes) & ~F.col("id").eqNullSafe(F.col("holder"))
    return out.select("id", "sha1", "payload_bytes", F.when(again, REVISIT).otherwise(RESPONSE).alias("record_type"), F.when(again, F.col("holder")).alias("refers_to"))


def chunked(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", url_col: str = "url") -> DataFrame:
    """(id, url, sha1, payload_bytes, row, chunk, data): ``pages`` as chunk rows of at most CHUNK bytes, one at least.

    ``row`` tells records of one id apart.  A chunk is cut out when its row is made, so payloads are not copied as wholes.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), _body(payload_col).alias("body")).withColumns({"sha1": F.sha1("body"), "payload_bytes": F.length("body").cast("bigint"), "row": F.monotonically_increasing_id()})
    rows = rows.select("*", F.explode(F.expr(f"sequence(0L, greatest(payload_bytes - 1, 0) DIV {CHUNK})")).alias("chunk"))
    return rows.select("id", "url", "sha1", "payload_bytes", "row", "chunk", F.expr(f"substring(body, CAST(chunk * {CHUNK} + 1 AS INT), {CHUNK})").alias("data"))


def _header(row: dict, length: int) -> bytes:
    name = lambda i: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'record:{i}')}>"
    lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}", f"WARC-Record-ID: {name(row['id'])}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{row['payload_digest']}", f"X-Record: {'' if row['id'] is None else row['id']}", f"X-Payload-Length: {row['payload_bytes']}", "Content-Type: text/html"]
    if row["url"] is not None:
        lines.append("WARC-Target-URI: " + urllib.parse.quote(row["url"], safe="!#$%&'()*+,/:;=?@[]~-._"))
    if row["record_type"] == REVISIT:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {name(row['refers_to'])}", f"X-Refers-To: {row['refers_to']}"]
    return ("\r\n".join([*lines, f"Content-Length: {length}"]) + "\r\n\r\n").encode()


def write(pages: DataFrame, folder: str, id_col: str = "page_id", payload_col: str = "html", url_col: str = "url", least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives into ``folder``; the manifest (archive, records, bytes), stored."""
    told = verdicts(pages, id_col, payload_col, least_bytes).select(F.col("id").alias("its"), F.col("sha1").alias("its_sha1"), F.col("payload_bytes").alias("its_bytes"), "record_type", "refers_to")
    rows = chunked(pages, id_col, payload_col, url_col)
    # the id and its digest, not the digest alone: copies of one payload go to different tasks
    rows = rows.join(told, rows["id"].eqNullSafe(told["its"]) & (rows["sha1"] == told["its_sha1"]) & (rows["payload_bytes"] == told["its_bytes"]))
    rows = rows.filter(f"record_type = '{RESPONSE}' OR chunk = 0").withColumn("data", F.when(F.col("record_type") == RESPONSE, F.col("data")))
    rows = rows.select("id", "url", "row", "chunk", "data", "payload_bytes", base32(F.col("sha1")).alias("payload_digest"), "record_type", "refers_to").sortWithinPartitions("id", "row", "chunk")

    def archived(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        task = TaskContext.get()
        archive, out, n, left = f"part-{task.partitionId():05d}-{uuid.uuid4().hex}.warc.gz", None, 0, 0
        member, digest = None, hashlib.sha1()
        for batch in batches:
            data = batch.column("data")
            told = batch.drop_columns(["data"]).to_pylist()
            for k, row in enumerate(told):
                piece = memoryview(data[k].as_buffer()) if data[k].is_valid and len(data[k].as_buffer() or b"") else memoryview(b"")
                if row["chunk"] == 0:
                    if left:
                        raise RuntimeError(f"chunks of a record are missing before record {row['id']}")
                    out = out or store.open_output_stream(f"{root}/{archive}", compression=None)
                    left = row["payload_bytes"] if row["record_type"] == RESPONSE else 0
                    member, digest = zlib.compressobj(1, zlib.DEFLATED, 31), hashlib.sha1()
                    out.write(member.compress(_header(row, left)))
                left -= len(piece)
                digest.update(piece)
                out.write(member.compress(piece))
                if not left:
                    if row["record_type"] == RESPONSE and base64.b32encode(digest.digest()).decode() != row["payload_digest"]:
                        raise RuntimeError(f"the chunks of record {row['id']} do not give its digest")
                    out.write(member.compress(b"\r\n\r\n") + member.flush())
                    n += 1
        if left:
            raise RuntimeError("chunks of the last record are missing")
        if out:
            size = out.tell()
            out.close()
            yield pa.record_batch({"archive": pa.array([archive]), "records": pa.array([n], pa.int64()), "bytes": pa.array([size], pa.int64())})

    return stored(rows.mapInArrow(archived, "archive string, records bigint, bytes bigint"))


class _Stream:
    """Bytes of a gzip file with many members, by pieces."""

    def __init__(self, source):
        self.source, self.member, self.have, self.over = source, zlib.decompressobj(31), b"", False

    def more(self) -> bool:
        while not self.over:
            left = self.member.unused_data if self.member.eof else self.member.unconsumed_tail
            if self.member.eof:
                self.member = zlib.decompressobj(31)
            left = left or self.source.read(1 << 18)
            if not left:
                self.over = True
            elif got := self.member.decompress(left, CHUNK):
                self.have += got
                return True
        return False

    def line(self) -> bytes | None:
        """Up to the next line end, without it; None at the end of the file."""
        while b"\r\n" not in self.have:
            if not self.more():
                return None
        line, self.have = self.have.split(b"\r\n", 1)
        return line

    def take(self, n: int) -> bytes:
        while len(self.have) < n:
            if not self.more():
                raise EOFError("an archive ends within a record")
        out, self.have = self.have[:n], self.have[n:]
        return out


def read(manifest: DataFrame, folder: str, with_data: bool = True) -> DataFrame:
    """(record_id, number, chunk, data, digest, size, last, record_type, refers_to, payload_length): the chunked record table.

    ``number`` counts the records of an archive, ``digest`` and ``size`` are those of the payload so far (bare base32).
    Each archive is a task's work.  Without ``with_data`` every byte is still read and digested, but only the last row
    of each record leaves the task, its data null.
    """
    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                with store.open_input_stream(f"{root}/{archive}", compression=None) as source:
                    records = _records(_Stream(source), archive)
                    yield from _batched(records if with_data else (r | {"data": None} for r in records if r["last"]))

    schema = "archive string, number bigint, record_id bigint, chunk bigint, data binary, digest string, size bigint, last boolean, record_type string, refers_to bigint, payload_length bigint, named string"
    # a stated number of partitions stays as it is: rows of the manifest are small, archives are not
    return manifest.select("archive").repartition(max(1, manifest.count())).mapInArrow(streamed, schema)


def _records(stream: _Stream, archive: str) -> Iterator[dict]:
    number = 0
    while (line := stream.line()) is not None:
        if line == b"":
            continue
        if not re.fullmatch(rb"WARC/1\.[01]", line):
            raise ValueError(f"no record begins with {line[:40]!r}")
        head: dict[str, str] = {}
        while line := stream.line():
            key, _, value = line.decode().partition(":")
            head[key.lower()] = value.strip()
        left, chunk, digest, size = int(head["content-length"]), 0, hashlib.sha1(), 0
        same = {"archive": archive, "number": number, "record_id": int(head["x-record"]) if head["x-record"] else None, "record_type": head["warc-type"], "refers_to": int(head["x-refers-to"]) if head.get("x-refers-to") else None,
                "payload_length": int(head["x-payload-length"]), "named": head["warc-payload-digest"].removeprefix("sha1:")}
        while True:
            data = stream.take(min(left, CHUNK))
            left -= len(data)
            size += len(data)
            digest.update(data)
            yield same | {"chunk": chunk, "data": data, "digest": base64.b32encode(digest.copy().digest()).decode(), "size": size, "last": not left}
            if not left:
                break
            chunk += 1
        number += 1


def _batched(rows: Iterator[dict], most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    kinds = {"archive": pa.string(), "number": pa.int64(), "record_id": pa.int64(), "chunk": pa.int64(), "data": pa.binary(), "digest": pa.string(), "size": pa.int64(), "last": pa.bool_(), "record_type": pa.string(), "refers_to": pa.int64(), "payload_length": pa.int64(), "named": pa.string()}
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row["data"] or b"") + 200
        if size >= most:
            yield pa.record_batch({c: pa.array([r[c] for r in held], t) for c, t in kinds.items()})
            held, size = [], 0
    if held:
        yield pa.record_batch({c: pa.array([r[c] for r in held], t) for c, t in kinds.items()})


def payloads(chunks: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) from the record table: the last chunk tells what a payload is.

    A revisit has no block; what its header says of its payload stands.  A response that differs from its header raises an error.
    """
    last = chunks.filter("last")
    again = F.col("record_type") == REVISIT
    wrong = ~again & ((F.col("digest") != F.col("named")) | (F.col("size") != F.col("payload_length")))
    last = last.withColumn("digest", F.when(wrong, F.raise_error(F.concat(F.lit("a payload differs from its digest: record "), F.col("record_id").cast("string")))).otherwise(F.col("digest")))
    return last.select(F.col("record_id").alias("page_id"), F.when(again, F.col("payload_length")).otherwise(F.col("size")).alias("payload_bytes"),
                       F.when(again, F.col("named")).otherwise(F.col("digest")).alias("payload_digest"), "record_type", "refers_to")


def round_trip(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", url_col: str = "url", least_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as archives into the shared folder and read them back: ``payloads`` of the archives."""
    folder = scratch_path(pages.sparkSession, "warc")
    folder = folder if re.match(r"[a-z0-9+.-]+:", folder) else f"file://{folder}"
    manifest = write(pages.select(id_col, payload_col, url_col), folder, id_col, payload_col, url_col, least_bytes)
    return payloads(read(manifest, folder, with_data=False))
