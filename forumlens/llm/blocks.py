"""Documents packed into blocks, and what blocks exchange with buckets.

A block is a table row with the texts of some documents, a few MB, so that steps over whole texts can
come back to them by a small number. A step makes, for each block, sorted keys; these are dealt to
buckets, and each bucket sees one compact row per block instead of a row per key and place. Since
a block names each key once, a key that a third of all rows hold costs one entry per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.llm.common import numbered
from forumlens.session import stored

#: Text in a block; a longer document is a block of its own.
BLOCK_BYTES = 4 << 20


def packed(data: bytes, level: int = 3) -> bytes:
    return zstandard.compress(data, level)


def unpacked(data: bytes) -> bytes:
    return zstandard.decompress(data)


def to_ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return packed(sink.getvalue().to_pybytes())


def from_ipc(data: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(unpacked(data)) as reader:
        return reader.read_all().combine_chunks().to_batches(max_chunksize=None)[0]


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows one by one, since a block is large."""
    for batch in batches:
        for i in range(len(batch)):
            yield batch.slice(i, 1).to_pylist()[0]


def pack_documents(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(block, n_bytes, rest, data): the texts of some rows, joined, and all columns and lengths beside."""
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            texts = batch.column(place).cast(pa.binary())
            lengths = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_pylist()
            at = 0
            while at < len(batch):
                stop, size = at, 0
                while stop < len(batch) and (stop == at or size + lengths[stop] <= block_bytes):
                    size += lengths[stop]
                    stop += 1
                data = b"".join([t or b"" for t in texts.slice(at, stop - at).to_pylist()])
                names = [f"c{i}" for i in range(batch.num_columns) if i != place] + ["null", "length"]
                columns = [batch.column(i).slice(at, stop - at) for i in range(batch.num_columns) if i != place]
                columns += [pa.compute.is_null(texts.slice(at, stop - at)), pa.array(lengths[at:stop], pa.int64())]
                rest = to_ipc(pa.RecordBatch.from_arrays(columns, names=names))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([first + made]), pa.array([size]), pa.array([rest], pa.binary()), pa.array([packed(data)], pa.binary())],
                    names=["block", "n_bytes", "rest", "data"],
                )
                made += 1
                at = stop

    return stored(numbered(docs).mapInArrow(run, "block long, n_bytes long, rest binary, data binary"), "blocks")


def with_answers(blocks: DataFrame, answers: DataFrame) -> DataFrame:
    """`blocks` with the list `answers` of the (bucket, answer) that buckets have for each, or null."""
    lists = answers.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("bucket", "answer"))).alias("answers"))
    return blocks.join(lists, "block", "left")
