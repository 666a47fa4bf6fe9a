"""Benchmark decontamination with a broadcast hash set of word windows.

A window is `size` consecutive words of a benchmark item, or all words of a shorter one. The set of
windows is built in slices of at most `slice_bytes` of benchmark text, so what is broadcast has a
bound; one slice after the other scans the documents. In a document, only runs of words that the
slice knows are looked at: their windows are looked up by hash and each hit is verified on the words.

Defined cases: a null or empty text has no words, no hits and is kept. An item without words has no
window. A window of an item without id is hit like any other, but the item is not listed. Rows of the
same item_id are one item. Repeated and null doc_ids are judged row by row. Other columns are kept as they are.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from hashlib import sha256
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumlens.llm.common import drop_columns, fresh, map_batches, quoted, tasks_for, utf8_bytes
from forumlens.session import stored

SIZE = 13
SHARE = 20
SLICE_BYTES = 8 << 20

# lower-cases A-Z; all other ASCII but digits and a-z separates words
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


class Windows:
    """The windows of a slice of the benchmark, by their length in words."""

    def __init__(self, items: Iterable[tuple[str | None, bytes | None]], size: int):
        self.ids: dict[bytes, int] = {}
        self.items: dict[int, dict[tuple, set]] = defaultdict(lambda: defaultdict(set))
        for item, text in items:
            words = (text or b"").translate(LETTERS).split()
            if not words:
                continue
            ids = [self.ids.setdefault(w, len(self.ids)) for w in words]
            n = min(size, len(ids))
            for i in range(len(ids) - n + 1):
                self.items[n][tuple(ids[i : i + n])].add(item)
        self.items = {n: dict(w) for n, w in self.items.items()}
        self.hashes = {n: np.unique(hash_rows(np.array(list(w), np.int64))) for n, w in self.items.items()}

    def scan(self, words: list[bytes], hit: np.ndarray, found: set) -> None:
        """Mark the words of `words` that a window covers, and add the items of these windows."""
        ids = np.fromiter(map(self.ids.get, words, repeat(-1)), np.int64, len(words))
        known = np.concatenate([[0], np.cumsum(ids >= 0)])
        strange = np.concatenate([[-1], np.flatnonzero(ids < 0), [len(ids)]])
        longest = int(np.diff(strange).max()) - 1  # run of known words
        for n, hashes in self.hashes.items():
            if n > longest:
                continue
            at = np.flatnonzero(known[n:] - known[:-n] == n)
            for part in np.array_split(at, len(at) // 65536 + 1):
                rows = ids[part[:, None] + np.arange(n)]
                own = hash_rows(rows)
                near = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
                for i in np.flatnonzero(hashes[near] == own):
                    items = self.items[n].get(tuple(rows[i].tolist()))
                    if items is not None:
                        hit[part[i] : part[i] + n] = True
                        found |= items


def hash_rows(rows: np.ndarray) -> np.ndarray:
    value = np.zeros(len(rows), np.uint64)
    for column in rows.astype(np.uint64).T:
        value = (value ^ column) * np.uint64(0x9E3779B97F4A7C15)
        value ^= value >> np.uint64(29)
    return value


def scan_windows(docs: DataFrame, benchmark: DataFrame, size: int = SIZE, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """`docs` with `hits` (a bit for each word, little-endian) and `items` (sorted ids of items with an occurring window)."""
    docs = drop_columns(docs, "hits", "items")
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), F.encode("text", "utf-8").alias("text")).distinct()
    slices = tasks_for(benchmark.agg(F.sum(utf8_bytes(F.col("text")))).first()[0] or 0, slice_bytes)
    part = F.pmod(F.xxhash64("item", "text"), F.lit(slices))  # copies of a text are dealt by their items
    place = docs.columns.index("text")
    done = docs.withColumns({"hits": F.lit(None).cast("binary"), "items": F.lit(None).cast("array<string>")})
    for k in range(slices):
        rows = items.filter(part == k).collect()  # at most about slice_bytes
        shared = docs.sparkSession.sparkContext.broadcast(Windows(((r[0], None if r[1] is None else bytes(r[1])) for r in rows), size).__dict__)

        def look(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            windows = Windows((), size)
            windows.__dict__ = shared.value
            for batch in batches:
                hits, lists = [], []
                texts = batch.column(place).cast(pa.binary())
                for text, old, known in zip(texts, batch.column(len(batch.columns) - 2), batch.column(len(batch.columns) - 1)):
                    words = (text.as_py() or b"").translate(LETTERS).split()
                    hit = np.zeros(len(words), bool)
                    if old.is_valid:
                        hit = np.unpackbits(np.frombuffer(old.as_py(), np.uint8), count=len(words), bitorder="little").astype(bool)
                    found = set(known.as_py() or ())
                    windows.scan(words, hit, found)
                    hits.append(np.packbits(hit, bitorder="little").tobytes())
                    lists.append(sorted(x for x in found if x is not None))
                columns = batch.columns[:-2] + [pa.array(hits, pa.binary()), pa.array(lists, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

        done = map_batches(done, look, [])
        if k + 1 < slices:
            done = stored(done, "scanned")
    return done


def judged(scanned: DataFrame, share: int = SHARE, text: str = "text") -> DataFrame:
    """Adds n_words, n_hit, n_items, items_sha256 and contaminated to the rows of `scan_windows`.

    A document is contaminated when hits are at least one in `share` of its words.
    """
    scanned = drop_columns(scanned, "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    place = scanned.columns.index(text)
    more = [("n_words", T.LongType()), ("n_hit", T.LongType()), ("n_items", T.LongType()), ("items_sha256", T.StringType()), ("contaminated", T.BooleanType())]
    names = scanned.columns

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [len((t.as_py() or b"").translate(LETTERS).split()) for t in batch.column(place).cast(pa.binary())]
            hit = [int(np.unpackbits(np.frombuffer(h.as_py(), np.uint8)).sum()) for h in batch.column(names.index("hits"))]
            items = batch.column(names.index("items")).to_pylist()
            digest = [sha256(",".join(x).encode()).hexdigest() for x in items]
            bad = [h > 0 and share * h >= w for w, h in zip(words, hit)]
            new = [pa.array(words, pa.int64()), pa.array(hit, pa.int64()), pa.array(map(len, items), pa.int64()), pa.array(digest, pa.string()), pa.array(bad, pa.bool_())]
            yield pa.RecordBatch.from_arrays(batch.columns + new, names=[*names, *[n for n, _ in more]])

    return map_batches(scanned, judge, [T.StructField(n, t) for n, t in more])


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", size: int = SIZE, share: int = SHARE, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """The columns of `docs` without contaminated documents ("documents"), or with all hit words cut out ("spans").

    A cut goes from the first to the last byte of a run of hit words; all other bytes stay.
    """
    scanned = scan_windows(docs, benchmark, size, slice_bytes)
    own = [quoted(c) for c in docs.columns if c in scanned.columns]
    if remove == "documents":
        return judged(scanned, share).filter(~F.col("contaminated")).select(*own)
    if remove != "spans":
        raise ValueError("remove is 'documents' or 'spans'")

    cut = F.udf(cut_spans, "string")
    name = fresh("cut", scanned.columns)
    kept = scanned.withColumn(name, cut("text", "hits"))
    return kept.select(*[F.col(name).alias("text") if c == "`text`" else F.col(c) for c in own])


def cut_spans(text: str | None, hits: bytes) -> str | None:
    if text is None or not any(hits):
        return text
    raw = text.encode()
    places = [m.span() for m in re.finditer(rb"[^ \t\n\r\x0b\x0c]+", raw.translate(LETTERS))]
    hit = np.unpackbits(np.frombuffer(hits, np.uint8), count=len(places), bitorder="little")
    kept, at, i = [], 0, 0
    while i < len(places):
        j = i
        while j < len(places) and hit[j]:
            j += 1
        if j > i:
            kept.append(raw[at : places[i][0]])
            at = places[j - 1][1]
        i = max(j, i + 1)
    kept.append(raw[at:])
    return b"".join(kept).decode()
