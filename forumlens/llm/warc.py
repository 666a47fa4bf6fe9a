"""Deterministic sharded WARC writer, and the reader of what it wrote.

Records are dealt to shards by ranges of page_id that hold about `shard_bytes` of payload (exact sums over cells of about as
many ids each, cut at ids drawn by their hash, so a run gives the same shards as the last one, and ids may lie far
apart), a task for each shard, sorted there, and written as gzip members.
A file is closed when it has `file_bytes` compressed. Headers, record ids and digests are made anew from the row;
dates are a parameter, so equal tables give equal bytes.

A task writes under a temporary name of its own attempt and reports the file; a second attempt never touches
the first one's files. The reports that Spark commits are the draft; files of the draft get their final names, which a
retry may repeat; then the manifest is written, and only files of the manifest are read. Left-over temporary files go.

Of records with equal payloads (SHA-1 and length) of at least `least` bytes, the one with the largest page_id is the
response and the others revisit it; a revisit holds the HTTP header alone.

Defined cases: null html is the empty payload; a null url writes no target URI; a null page_id sorts first and
is smaller than any other, so it revisits when another has its payload. Rows that share the largest page_id and
the payload are responses. No rows: no files and an empty manifest. Other columns are not written.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.llm.common import utf8_bytes
from forumlens.session import scratch_path, stored

SHARD_BYTES = 16 << 20
FILE_BYTES = 8 << 20
CELLS, IDS_PER_CELL = 1 << 14, 8
MANIFEST = "manifest.parquet"
DATE = "2000-01-01T00:00:00Z"
#: Fixed value: the profile that the WARC standard names for such revisits.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NAMES = uuid.uuid5(uuid.NAMESPACE_URL, "warc-record")


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    if re.match(r"file:/", path) or "://" not in path:
        return fs.LocalFileSystem(), re.sub(r"^file:/+", "/", path)
    return fs.FileSystem.from_uri(path)


def digest32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMES, f'{page_id} {digest}')}>"


def record(kind: str, head: list[tuple[str, str]], block: bytes) -> bytes:
    """One gzip member with one WARC record."""
    lines = [("WARC-Type", kind), *head, ("WARC-Block-Digest", f"sha1:{digest32(block)}"), ("Content-Length", str(len(block)))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)  # a gzip header without time or name
    return packer.compress(text.encode() + block + b"\r\n\r\n") + packer.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, revisits: bool, refers_to: int | None, date: str) -> bytes:
    digest = digest32(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = [("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Date", date)]
    if url is not None:
        head.append(("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=%-._~|\\^`{}<>\"")))
    head += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if page_id is not None:
        head.append(("Page-Id", str(page_id)))
    if not revisits:
        return record("response", head, http + payload)
    head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), ("Refers-To-Page-Id", str(refers_to))]
    return record("revisit", head, http)


def with_notes(pages: DataFrame, least: int) -> DataFrame:
    """The records (page_id, url, html, sha, size), and a note for each revisit: the same key, and the response's page_id.

    Notes are joined on digests alone, so a payload is shuffled only once, to its shard, where its note stands before it.
    """
    body = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    rows = rows.withColumns({"sha": F.sha1(body), "size": utf8_bytes(F.col("html"))})
    repeated = rows.filter(F.col("size") >= least).groupBy("sha", "size").agg(F.count("*").alias("n"), F.max("page_id").alias("response")).filter("n > 1").drop("n")
    # a payload that very many pages share is on one side of the join only, so the adaptive skew join can cut it
    joined = rows.select("page_id", "sha", "size").join(repeated, ["sha", "size"])
    other = F.coalesce(F.col("page_id") < F.col("response"), F.col("response").isNotNull() & F.col("page_id").isNull())
    notes = joined.filter(other).withColumn("is_record", F.lit(False))
    records = rows.withColumns({"is_record": F.lit(True), "tie": F.xxhash64("url")})
    return records.unionByName(notes, allowMissingColumns=True)


def cut_points(pages: DataFrame, cells: int = CELLS) -> np.ndarray:
    """Ids that cut the table into cells of about as many ids each, however these are spread.

    They come from the ids whose hash is divisible by a number that leaves some for each cell: the same for the same rows.
    """
    ids = pages.select(F.col("page_id").cast("long").alias("id")).filter("id is not null")
    every = max(1, ids.count() // (IDS_PER_CELL * cells))
    drawn = ids.filter(F.pmod(F.xxhash64("id"), F.lit(every)) == 0).distinct()
    found = np.sort(np.array([r[0] for r in drawn.toLocalIterator()], np.int64))  # about IDS_PER_CELL x cells numbers
    return found[:: -(-len(found) // cells) or 1]


def cell_of(page_id: Column, cuts: np.ndarray) -> Column:
    """The number of cut points up to an id; 0 for null."""

    @F.arrow_udf("int")
    def number(ids: pa.Array) -> pa.Array:
        known = ids.fill_null(0).to_numpy(zero_copy_only=False)
        cells = np.where(ids.is_valid().to_numpy(zero_copy_only=False), np.searchsorted(cuts, known, "right"), 0)
        return pa.array(cells.astype(np.int32), pa.int32())

    return number(page_id)


def write_warc(pages: DataFrame, folder: str, least: int = 0, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES, date: str = DATE) -> DataFrame:
    """Write `pages` (page_id, url, html) below `folder`; the manifest: name, shard, number, records, bytes, sha1."""
    cell = cell_of(F.col("page_id").cast("long"), cut_points(pages))
    sums = dict(pages.groupBy(cell.alias("cell")).agg(F.sum(utf8_bytes(F.col("html")) + 512)).collect())
    shard_of, filled = [], 0
    for c in sorted(sums):
        shard_of.append((c, filled // shard_bytes))
        filled += sums[c]
    shards = filled // shard_bytes + 1
    spark = pages.sparkSession
    ranges = spark.createDataFrame(shard_of, "cell int, shard int")  # at most CELLS rows
    rows = with_notes(pages, least).withColumn("cell", cell).join(F.broadcast(ranges), "cell")
    order = ["shard", F.asc_nulls_first("page_id"), "sha", "size", "is_record", "tie"]
    sorted_rows = rows.repartitionById(int(shards), F.col("shard")).sortWithinPartitions(*order).select("shard", "page_id", "url", "html", "response", "sha", "is_record")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(folder)
        system.create_dir(f"{base}/_uncommitted", recursive=True)
        attempt, out, shard, state = uuid.uuid4().hex, None, None, {}
        done: list[dict] = []
        note: tuple = ()

        def close() -> None:
            nonlocal out
            if out is not None:
                out.close()
                done.append({**state, "sha1": state["sha1"].hexdigest()})
                out = None

        def put(data: bytes) -> None:
            out.write(data)
            state["bytes"] += len(data)
            state["sha1"].update(data)

        for batch in batches:
            for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3).cast(pa.binary()), batch.column(4).to_pylist(), batch.column(5).to_pylist(), batch.column(6).to_pylist()):
                if not row[6]:
                    note = (row[1], row[5], row[4])
                    continue
                response = note[2] if note[:2] == (row[1], row[5]) else None
                if row[0] != shard or out is None or state["bytes"] >= file_bytes:
                    close()
                    number = state["number"] + 1 if row[0] == shard else 0
                    shard = row[0]
                    name = f"shard-{shard:08d}-{number:05d}.warc.gz"
                    state = {"name": name, "draft": f"{name}.{attempt}", "shard": shard, "number": number, "records": 0, "bytes": 0, "sha1": hashlib.sha1()}
                    out = system.open_output_stream(f"{base}/_uncommitted/{state['draft']}", compression=None)
                    head = [("WARC-Record-ID", record_id(shard, name)), ("WARC-Date", date), ("WARC-Filename", name), ("Content-Type", "application/warc-fields")]
                    put(record("warcinfo", head, b"format: WARC File Format 1.1\r\n"))
                put(page_record(row[1], row[2], row[3].as_py() or b"", response is not None, response, date))
                state["records"] += 1
        close()
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=pa.schema([(k, pa.string() if k in ("name", "draft", "sha1") else pa.int64()) for k in done[0]]))

    schema = "name string, draft string, shard long, number long, records long, bytes long, sha1 string"
    draft = stored(sorted_rows.mapInArrow(write, schema), "warc-draft")

    def commit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(folder)
        for batch in batches:
            for name, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = system.get_file_info(f"{base}/_uncommitted/{own}")
                if found.type != fs.FileType.NotFound:  # else a former try of this task has moved it
                    system.move(found.path, f"{base}/{name}")
            yield batch

    manifest = stored(draft.mapInArrow(commit, schema).drop("draft"), "warc-manifest")
    system, base = file_system(folder)
    if system.get_file_info(f"{base}/_uncommitted").type == fs.FileType.Directory:
        system.delete_dir(f"{base}/_uncommitted")
    manifest.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{MANIFEST}")  # Spark gives it its name when it is whole
    return manifest


def open_archive(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest of an archive, from its folder alone."""
    return spark.read.parquet(f"{folder}/{MANIFEST}")


def read_warc(manifest: DataFrame, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, url, file and payload of each record of the manifest's files.

    Every block digest is checked. The payload of a revisit is null; its length and digest come from its headers.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = file_system(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows: list[tuple] = []
                size = 0
                with system.open_input_stream(f"{base}/{name}", compression=None) as raw, gzip.GzipFile(fileobj=raw) as file:
                    while line := file.readline():
                        if line.strip() != b"WARC/1.1":
                            raise ValueError(f"{name}: no record where one should begin")
                        head = {}
                        while (line := file.readline().rstrip(b"\r\n")):
                            key, _, value = line.decode().partition(": ")
                            head[key] = value
                        block = file.read(int(head["Content-Length"]))
                        file.read(4)
                        if head["WARC-Block-Digest"] != f"sha1:{digest32(block)}":
                            raise ValueError(f"{name}: {head['WARC-Record-ID']} is damaged")
                        if head["WARC-Type"] == "warcinfo":
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n")
                        length = int(re.search(rb"Content-Length: (\d+)", http)[1])
                        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                        whole = head["WARC-Type"] == "response"
                        if whole and (len(payload) != length or digest32(payload) != digest):
                            raise ValueError(f"{name}: payload of {head['WARC-Record-ID']} is damaged")
                        number = lambda key: int(head[key]) if key in head else None  # noqa: B023, E731
                        rows.append((number("Page-Id"), length, digest, head["WARC-Type"], number("Refers-To-Page-Id"), head.get("WARC-Target-URI"), name, payload if whole else None))
                        size += len(block)
                        if size > 16 << 20:
                            yield to_batch(rows)
                            rows, size = [], 0
                if rows:
                    yield to_batch(rows)

    def to_batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=columns)

    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "file", "payload"]
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, file string, payload binary"
    files = manifest.select("name")
    return files.repartition(max(1, min(files.count(), 4096)), "name").mapInArrow(parse, schema)


def scratch_archive(pages: DataFrame, **options) -> tuple[DataFrame, str]:
    """Write to a new folder in the shared one; the manifest and the folder."""
    folder = scratch_path(pages.sparkSession, "warc")
    return write_warc(pages, folder, **options), folder
