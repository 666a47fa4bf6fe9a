"""Removal of repeated byte strings by bucket-pointer refinement of sampled suffixes.

All suffixes of 100 TB can't be shuffled, so a sample is sorted that misses no match: of each `length`-byte
window the suffix is taken that starts with the window's least hashed q-gram (q = 16). Equal windows
choose it at the same place. It is the initial bucket of the window.

1. Initial buckets: each block names its q-grams once; buckets that only one document has are final.
2. Refinement: for every other bucket, blocks send the distinct surroundings of its q-gram, which hold all windows
   that chose it. Equal surroundings are one entry with its smallest doc_id. The entries are refined window by
   window: q = 8, so the bucket number of an offset is the 8-gram there, and a bucket is split by
   sorting on the numbers at later offsets; the new number is used for the next split, and buckets of a
   single entry leave. What remains after the last offset is a set of equal windows, byte for byte.
3. Each bucket answers, for each entry, which of its windows also start in a smaller doc_id.

Entries of a q-gram with very many surroundings are dealt by what stands left or right of it, too, so one
frequent phrase does not fill a bucket.

Defined cases: null is the empty text and stays null; texts under `length` bytes stay. A null doc_id is not
smaller than any and has none smaller: its row stays and removes nothing. Rows of one doc_id don't remove each
other's bytes. Other columns are kept. Bytes of a character that is cut in half are dropped from the
text column; `kept` has them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumlens.llm.blocks import BLOCK_BYTES, from_ipc, pack_documents, packed, unpacked, with_answers
from forumlens.llm.common import drop_columns, tasks_for
from forumlens.session import stored

LENGTH = 50
GRAM = 16
#: Text whose keys meet in one bucket.
BUCKET_BYTES = 24 << 20
#: A q-gram with more occurrences is dealt by its surroundings.
FREQUENT = 20_000
#: Windows handled at once.
CHUNK = 1 << 20
NO_ID = np.int64(2**63 - 1)
U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(31))
    x *= U(0x9E3779B97F4A7C15)
    x ^= x >> U(29)
    x *= U(0xBF58476D1CE4E5B9)
    return x ^ (x >> U(32))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the 16 bytes from each place."""
    eight = np.lib.stride_tricks.sliding_window_view(data, 8)
    words = np.ascontiguousarray(eight).view("<u8").ravel()
    return mixed(mixed(words[:-8]) + words[8:])


def anchors(data: np.ndarray, doc: np.ndarray, ends: np.ndarray, length: int = LENGTH) -> dict[str, np.ndarray]:
    """The sampled suffixes of joined texts: place, gram, document, first and last window start.

    `doc` has the text of each byte, `ends` the end of each text.
    """
    found = {k: [] for k in ("at", "gram", "doc", "first", "last")}
    span = length - GRAM + 1
    for begin in range(0, max(0, len(data) - length + 1), CHUNK):
        part = data[begin : begin + CHUNK + length - 1]
        grams = gram_hashes(part)
        places = np.arange(len(grams), dtype=np.uint64)
        least = (grams & ~U((1 << 22) - 1)) | places
        size = 1
        while size < span:
            step = min(size, span - size)
            least = np.minimum(least[: len(least) - step], least[step:])
            size += step
        chosen = (least & U((1 << 22) - 1)).astype(np.int64)
        start = np.arange(len(chosen))
        own = doc[begin : begin + len(chosen)]
        whole = begin + start + length <= ends[own]
        new = np.ones(len(chosen), bool)
        new[1:] = (chosen[1:] != chosen[:-1]) | (own[1:] != own[:-1])
        new &= whole
        stop = np.ones(len(chosen), bool)
        stop[:-1] = new[1:] | ~whole[1:]
        stop &= whole
        first, last = start[new], start[stop]
        found["at"].append(chosen[first] + begin)
        found["gram"].append(grams[chosen[first]])
        found["doc"].append(own[first])
        found["first"].append(first + begin)
        found["last"].append(last + begin)
    empty = {"gram": np.uint64}
    return {k: np.concatenate(v) if v else np.zeros(0, empty.get(k, np.int64)) for k, v in found.items()}


class Block:
    """One block: its bytes, documents and sampled suffixes, ordered by gram."""

    def __init__(self, rest: bytes, data: bytes, id_column: str, length: int):
        self.rest = from_ipc(rest)
        self.data = np.frombuffer(unpacked(data), np.uint8)
        lengths = self.rest.column("length").to_numpy()
        self.ends = np.cumsum(lengths)
        doc = np.repeat(np.arange(len(lengths)), lengths)
        ids = self.rest.column(self.rest.schema.get_field_index(id_column))
        self.no_id = np.asarray(pa.compute.is_null(ids))
        self.ids = np.asarray(pa.compute.fill_null(ids, int(NO_ID)), np.int64)
        a = anchors(self.data, doc, self.ends, length)
        judged = ~self.no_id[a["doc"]]
        order = np.flatnonzero(judged)
        order = order[np.argsort(a["gram"][order], kind="stable")]
        self.at, self.gram, self.first, self.last = (a[k][order] for k in ("at", "gram", "first", "last"))
        self.id = self.ids[a["doc"][order]]

    def surroundings(self, length: int) -> np.ndarray:
        """A row for each suffix: the bytes that its windows cover (else 0), then how far they reach."""
        before, width = length - GRAM, 2 * length - GRAM
        padded = np.concatenate([np.zeros(before, np.uint8), self.data, np.zeros(length, np.uint8)])
        rows = np.zeros((len(self.at), -(-(width + 2) // 8) * 8), np.uint8)
        rows[:, :width] = np.lib.stride_tricks.sliding_window_view(padded, width)[self.at]
        left, right = self.at - self.first, self.last + length - self.at
        column = np.arange(width)
        rows[:, :width] *= (column >= before - left[:, None]) & (column < before + right[:, None])
        rows[:, width], rows[:, width + 1] = left, right
        return rows


def gather(block: Block, keep: np.ndarray) -> None:
    for name in ("at", "gram", "first", "last", "id"):
        setattr(block, name, getattr(block, name)[keep])


def row_hashes(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words = np.ascontiguousarray(rows).view("<u8")
    one, two = np.zeros(len(rows), np.uint64), np.full(len(rows), 7, np.uint64)
    for column in words.T:
        one = mixed(one + column)
        two = mixed((two ^ column) * U(0x94D049BB133111EB) + U(1))
    return one, two


def distinct(gram: np.ndarray, rows: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by (gram, row), number of the distinct row of each place in it, and smallest id of each distinct row."""
    one, two = row_hashes(rows)
    order = np.lexsort((ids, two, one, gram))
    new = np.ones(len(order), bool)
    same = np.ones(max(0, len(order) - 1), bool)
    for x in (gram, one, two):
        y = x[order]
        same &= y[1:] == y[:-1]
    same &= (rows[order[1:]] == rows[order[:-1]]).all(axis=1)
    new[1:] = ~same
    number = np.cumsum(new) - 1
    return order, number, ids[order[new]]


def refine(gram: np.ndarray, rows: np.ndarray, ids: np.ndarray, length: int) -> np.ndarray:
    """For entries in order of `gram`, a bit for each window that an entry with a smaller id of the same gram has."""
    before = length - GRAM
    width = 2 * length - GRAM
    left, right = rows[:, width].astype(np.int64), rows[:, width + 1].astype(np.int64)
    marks = np.zeros(len(rows), np.uint64)
    number = np.cumsum(np.concatenate([[True], gram[1:] != gram[:-1]])[: len(gram)]) - 1
    offsets = [length - 8, *range(0, length - 8, 8)]
    for start in range(before + 1):  # the window's place in the row
        inside = (before - start <= left) & (start + length <= before + right)
        some = np.flatnonzero(inside)
        bucket = number[some]
        some, bucket = pairs_only(some, bucket)
        for offset in offsets:
            if not len(some):
                break
            numbers = np.ascontiguousarray(rows[some, start + offset : start + offset + 8]).view("<u8").ravel()
            order = np.lexsort((numbers, bucket))
            some, bucket, numbers = some[order], bucket[order], numbers[order]
            new = np.ones(len(some), bool)
            new[1:] = (bucket[1:] != bucket[:-1]) | (numbers[1:] != numbers[:-1])
            some, bucket = pairs_only(some, np.cumsum(new))
        if len(some):
            order = np.lexsort((ids[some], bucket))
            some, bucket = some[order], bucket[order]
            new = np.ones(len(some), bool)
            new[1:] = bucket[1:] != bucket[:-1]
            least = ids[some][new][np.cumsum(new) - 1]
            late = some[ids[some] > least]
            marks[late] |= U(1) << U(start)
    return marks


def pairs_only(some: np.ndarray, bucket: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without the entries that are alone in their bucket; `bucket` is sorted."""
    if not len(some):
        return some, bucket
    alike = bucket[1:] == bucket[:-1]
    more = np.concatenate([alike, [False]]) | np.concatenate([[False], alike])
    return some[more], bucket[more]


def dealt(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, indices of the keys in it), in order of bucket."""
    to = (mixed(keys) % U(buckets)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    edges = np.flatnonzero(np.diff(to[order])) + 1
    for some in np.split(order, edges):
        if len(some):
            yield int(to[some[0]]), some


def shared_grams(blocks: DataFrame, id_column: str, buckets: int, length: int) -> DataFrame:
    """(block, bucket, answer): the grams of a block that two documents have, and how often they occur."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row["rest"], row["data"], id_column, length)
                if not len(block.gram):
                    continue
                new = np.ones(len(block.gram), bool)
                new[1:] = block.gram[1:] != block.gram[:-1]
                at = np.flatnonzero(new)
                grams, counts = block.gram[at], np.diff(np.append(at, len(new)))
                several = np.minimum.reduceat(block.id, at) != np.maximum.reduceat(block.id, at)
                sent = [(b, grams[i].tobytes(), (counts[i] * np.where(several[i], -1, 1)).astype(np.int32).tobytes()) for b, i in dealt(grams, buckets)]
                columns = [pa.array([b for b, _, _ in sent], pa.int64()), pa.array([row["block"]] * len(sent), pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    columns + [pa.array([g for _, g, _ in sent], pa.binary()), pa.array([packed(c) for _, _, c in sent], pa.binary())],
                    names=["bucket", "block", "grams", "counts"],
                )

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        sizes = [len(g) // 8 for g in frame["grams"]]
        grams = np.frombuffer(b"".join(frame["grams"]), np.uint64)
        counts = np.frombuffer(b"".join(map(unpacked, frame["counts"])), np.int32)
        order = np.argsort(grams, kind="stable")
        new = np.ones(len(order), bool)
        new[1:] = grams[order][1:] != grams[order][:-1]
        at = np.flatnonzero(new)
        shared = (np.diff(np.append(at, len(new))) > 1) | (np.minimum.reduceat(counts[order], at) < 0)
        often = np.add.reduceat(np.abs(counts[order]).astype(np.int64), at) > FREQUENT
        back = np.empty(len(order), np.int64)
        back[order] = np.cumsum(new) - 1
        answers = []
        for own, mine in zip(np.split(grams, np.cumsum(sizes)[:-1]), np.split(back, np.cumsum(sizes)[:-1])):
            keep = shared[mine]
            answers.append(own[keep].tobytes() + np.packbits(often[mine][keep]).tobytes())
        out = pd.DataFrame({"block": frame["block"], "bucket": frame["bucket"], "answer": answers})
        return out[[len(a) > 0 for a in answers]]

    named = blocks.select("block", "rest", "data").mapInArrow(name, "bucket long, block long, grams binary, counts binary")
    return named.groupBy("bucket").applyInPandas(meet, "block long, bucket long, answer binary")


def read_shared(answers: list | None) -> tuple[np.ndarray, np.ndarray]:
    """The grams of `shared_grams`, sorted, and whether each is frequent."""
    grams, often = [], []
    for one in answers or ():
        data = one["answer"]
        n = len(data) * 8 // 65  # n grams of 8 bytes, then a bit for each
        grams.append(np.frombuffer(data[: 8 * n], np.uint64))
        often.append(np.unpackbits(np.frombuffer(data[8 * n :], np.uint8), count=n).astype(bool))
    if not grams:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    grams, often = np.concatenate(grams), np.concatenate(often)
    order = np.argsort(grams)
    return grams[order], often[order]


class Entries:
    """What a block sends for refinement; the same again when the answers come."""

    def __init__(self, block: Block, answers: list | None, length: int):
        grams, often = read_shared(answers)
        place = np.searchsorted(grams, block.gram)
        place[place == len(grams)] = 0
        keep = grams[place] == block.gram if len(grams) else np.zeros(len(block.gram), bool)
        gather(block, keep)
        frequent = often[place[keep]] if len(grams) else keep[:0]
        self.block, self.length = block, length
        self.rows = block.surroundings(length)
        self.order, self.number, self.ids = distinct(block.gram, self.rows, block.id)
        one = np.ones(len(self.order), bool)
        one[1:] = self.number[1:] != self.number[:-1]
        self.pick = self.order[one]
        self.gram = block.gram[self.pick]
        self.frequent = frequent[self.pick]

    def sent(self, buckets: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(bucket, entries, key of each): by gram, or, for frequent ones, by gram and the bytes left and right of it."""
        before = self.length - GRAM
        half = before // 2
        usual, often = np.flatnonzero(~self.frequent), np.flatnonzero(self.frequent)
        keys, entries = [self.gram[usual]], [usual]
        if len(often):
            rows = self.rows[self.pick[often]]
            wide = np.zeros((2, len(often), -(-half // 8) * 8), np.uint8)
            wide[0, :, :half] = rows[:, before - half : before]
            wide[1, :, :half] = rows[:, before + GRAM : before + GRAM + half]
            for side in range(2):
                keys.append(mixed(self.gram[often] + row_hashes(wide[side])[side]))
                entries.append(often)
        keys, entries = np.concatenate(keys), np.concatenate(entries)
        for bucket, some in dealt(keys, buckets):
            yield bucket, entries[some], keys[some]


def window_answers(blocks: DataFrame, id_column: str, buckets: int, length: int) -> DataFrame:
    """(block, bucket, answer): for each entry that a block sent, the windows that a smaller id has."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                if row["answers"] is None:
                    continue
                entries = Entries(Block(row["rest"], row["data"], id_column, length), row["answers"], length)
                for bucket, some, keys in entries.sent(buckets):
                    content = packed(entries.rows[entries.pick[some]].tobytes())
                    values = [bucket, row["block"], keys.tobytes(), entries.ids[some].tobytes(), content]
                    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=["bucket", "block", "keys", "ids", "rows"])

    width = -(-(2 * length - GRAM + 2) // 8) * 8

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        sizes = np.cumsum([len(k) // 8 for k in frame["keys"]])
        keys = np.frombuffer(b"".join(frame["keys"]), np.uint64)
        ids = np.frombuffer(b"".join(frame["ids"]), np.int64)
        rows = np.frombuffer(b"".join(map(unpacked, frame["rows"])), np.uint8).reshape(-1, width)
        order, number, least = distinct(keys, rows, ids)
        one = np.ones(len(order), bool)
        one[1:] = number[1:] != number[:-1]
        classes = order[one]
        marks = refine(keys[classes], rows[classes], least, length)
        every = np.where(ids[order] > least[number], U(2**64 - 1), marks[number])
        back = np.empty(len(order), np.uint64)
        back[order] = every
        answers = [packed(x.tobytes()) for x in np.split(back, sizes[:-1])]
        return pd.DataFrame({"block": frame["block"], "bucket": frame["bucket"], "answer": answers})

    sent = blocks.select("block", "rest", "data", "answers").mapInArrow(send, "bucket long, block long, keys binary, ids binary, rows binary")
    return sent.groupBy("bucket").applyInPandas(meet, "block long, bucket long, answer binary")


def removed_bytes(block: Block, grams: list | None, answers: list | None, buckets: int, length: int) -> np.ndarray:
    """For each byte of the block, whether a removed window covers it."""
    change = np.zeros(len(block.data) + 1, np.int64)
    if grams:
        entries = Entries(block, grams, length)
        marks = np.zeros(len(entries.pick), np.uint64)
        told = {a["bucket"]: np.frombuffer(unpacked(a["answer"]), np.uint64) for a in answers or ()}
        for bucket, some, _ in entries.sent(buckets):
            np.bitwise_or.at(marks, some, told[bucket])
        order, number = entries.order, entries.number
        late = block.id[order] > entries.ids[number]
        place = marks[number]
        before = length - GRAM
        for start in range(before + 1):
            at = block.at[order] - before + start
            hit = (late | ((place >> U(start)) & U(1)).astype(bool)) & (at >= block.first[order]) & (at <= block.last[order])
            np.add.at(change, at[hit], 1)
            np.add.at(change, at[hit] + length, -1)
    return np.cumsum(change[:-1]) > 0


def remove_repeats(docs: DataFrame, length: int = LENGTH, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """The rows of `docs`, the text cut, with kept (binary), n_bytes, n_removed and n_spans; such input columns are replaced."""
    docs = drop_columns(docs, "kept", "n_bytes", "n_removed", "n_spans")
    if not GRAM + 8 <= length <= 2 * GRAM + 31:
        raise ValueError("length is out of range")
    place = docs.columns.index("text")
    id_column = f"c{docs.columns.index('doc_id')}"
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    blocks = pack_documents(docs, block_bytes)
    total = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    buckets = tasks_for(total, bucket_bytes)
    grams = stored(shared_grams(blocks, id_column, buckets, length), "grams")
    asked = with_answers(blocks, grams)
    windows = stored(window_answers(asked, id_column, buckets, length), "windows")
    answered = with_answers(asked.withColumnRenamed("answers", "grams"), windows)
    more = [T.StructField("kept", T.BinaryType()), *[T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")]]
    out = T.StructType([*docs.schema.fields, *more])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row["rest"], row["data"], id_column, length)
                gone = removed_bytes(block, row["grams"], row["answers"], buckets, length)
                kept, sizes = [], np.zeros((3, len(block.ends)), np.int64)
                begin = 0
                for i, end in enumerate(block.ends):
                    own = gone[begin:end]
                    if own.any():
                        runs = int(own[0]) + int((own[1:] & ~own[:-1]).sum())
                        sizes[:, i] = end - begin, own.sum(), runs
                        kept.append(block.data[begin:end][~own].tobytes())
                    else:
                        sizes[:, i] = end - begin, 0, 0
                        kept.append(block.data[begin:end].tobytes())
                    begin = end
                nulls = block.rest.column("null").to_pylist()
                texts = pa.array([None if n else k.decode(errors="ignore") for k, n in zip(kept, nulls)], pa.string())
                columns = list(block.rest.columns[:-2])
                columns.insert(place, texts)
                columns += [pa.array(kept, pa.binary()), *[pa.array(s) for s in sizes]]
                yield pa.RecordBatch.from_arrays(columns, names=out.names)

    return answered.select("rest", "data", "grams", "answers").mapInArrow(cut, out)
