"""Cross-tokenizer alignment by diagonal run skipping, and how widely each linked pair of ids is held.

Two tokenizers write the same bytes. The byte offsets where tokens of both end cut them into groups; tokens of a group are linked.

1. The ends of both token lists are two rising arrays. Where they agree one to one, they agree at a constant shift of indices. At
   the current shift the arrays are compared in stretches that double while they are equal and halve when they are not, so a one-to-one
   stretch is jumped in a logarithmic number of comparisons of whole slices. Where they part, the two places are moved forward one
   by one to the next common end; the shift follows.
2. Texts are worked on block by block. A block names each of its linked pairs once, with the number of its texts that hold it; sums by
   pair over all blocks are the corpus-wide counts, and the greatest by first id (at most as many rows as the vocabulary) marks the best.
   The counts come back to each block as one list in the order of its pairs.

Byte-level ids come from tiktoken with the ranks of the tokenizer's file where that gives the same ids, which is several times faster
than its own library; texts with letters on which the two differ, or files whose ids don't follow the merges, go to the latter.

Defined cases: null and empty texts, and those that either tokenizer doesn't give back byte by byte, have no tokens: zeros and an empty hash.
Repeated rows are texts of their own and count each. Special tokens in texts are plain text. A very long text is a block of its own; a
group of very many tokens is counted by distinct ids. Columns with the names of the new ones are replaced; others are kept.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cached_property, lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
import tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumlens.llm.blocks import from_ipc, packed, rows_of, to_ipc, unpacked
from forumlens.llm.bpe_automaton import byte_symbols
from forumlens.llm.common import drop_columns, numbered
from forumlens.session import stored

#: Text of a block and of what is encoded at once, in bytes; a longer text stands alone.
BLOCK_BYTES, PART_BYTES = 16 << 20, 2 << 20
#: Links of a group from which distinct ids are paired in place of tokens.
MANY_LINKS = 4096
#: Bits for an id in a pair.
BITS = 20
#: From here on the two libraries for byte-level ids have letters of different Unicode versions.
LATER = re.compile("[԰-\U0010ffff]")
NEW = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def cut_groups(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token of both lists whether it is the last of its group. Both lists end at the same byte."""
    list_a, list_b = ends_a.tolist(), ends_b.tolist()
    data_a, data_b, width = ends_a.tobytes(), ends_b.tobytes(), ends_a.itemsize
    n_a, n_b = len(list_a), len(list_b)
    last_a, last_b = bytearray(b"\1") * n_a, bytearray(b"\1") * n_b
    i = j = 0
    while i < n_a:
        if list_a[i] == list_b[j]:  # a stretch at this shift: double while equal, then halve
            i, j, probe, grows = i + 1, j + 1, 2, True
            while probe and i < n_a:  # slices that are cut short are equal only where both lists end
                if data_a[i * width : (i + probe) * width] == data_b[j * width : (j + probe) * width]:
                    i, j = i + probe, j + probe
                    probe = probe * 2 if grows else probe // 2
                else:
                    grows, probe = False, probe // 2
            continue
        x, y = i, j
        end_a, end_b = list_a[x], list_b[y]
        while end_a != end_b:
            if end_a < end_b:
                x += 1
                end_a = list_a[x]
            else:
                y += 1
                end_b = list_b[y]
        if x > i:
            last_a[i:x] = bytes(x - i)
        if y > j:
            last_b[j:y] = bytes(y - j)
        i, j = x + 1, y + 1
    return np.frombuffer(last_a, bool), np.frombuffer(last_b, bool)


class ByteLevel:
    """Ids and bytes of the byte-level tokenizer."""

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        byte_of = {s: b for b, s in enumerate(byte_symbols())}
        self.labels = {i: bytes(map(byte_of.__getitem__, t)) for t, i in model["vocab"].items() if all(c in byte_of for c in t)}
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        self.path, self.quick = path, None
        if merged == list(range(256, 256 + len(merged))) and sorted(self.labels[i] for i in range(256)) == [bytes([b]) for b in range(256)]:
            ranks = {self.labels[i]: i for i in range(256 + len(merged))}
            self.quick = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def library(self) -> tokenizers.Tokenizer:
        """Read when a text first needs it, since it takes much memory."""
        library = tokenizers.Tokenizer.from_file(self.path)
        library.encode_special_tokens = True
        return library

    def encode(self, text: str) -> list[int] | None:
        """Ids, None where they don't give the text back."""
        if self.quick is not None and LATER.search(text) is None:
            return self.quick.encode_ordinary(text)  # nothing is normalised, and each character is in some match
        ids = self.library.encode(text, add_special_tokens=False).ids
        return ids if b"".join([self.labels.get(i, b"") for i in ids]) == text.encode() else None


class Pieces:
    """Ids and bytes of the piece tokenizer."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.labels = {}
        for i in range(self.library.get_piece_size()):
            piece = self.library.id_to_piece(i)
            self.labels[i] = bytes([int(piece[3:5], 16)]) if self.library.is_byte(i) else piece.replace("▁", " ").encode()

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1) if texts else []


class Aligner:
    def __init__(self, byte_path: str, piece_path: str, pattern: str):
        self.a, self.b = ByteLevel(byte_path, pattern), Pieces(piece_path)
        self.lengths = []
        self.names: list[str] = []  # of the ids in the list of groups, inside and at the end of a part
        for labels, end in ((self.a.labels, "|"), (self.b.labels, ";")):
            size = max(labels) + 1
            self.lengths.append(np.array([len(labels.get(i, b"")) for i in range(size)], np.int32))
            self.names += [name for i in range(size) for name in (f"{i},", f"{i}{end}")]
        self.shift = 2 * len(self.lengths[0])

    def align(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """Of each text n_a, n_b, n_groups and n_links, and its hash; and (text << 40 | pair), in order, with how many links."""
        counts, hashes = np.zeros((len(texts), 4), np.int64), [""] * len(texts)
        given = [k for k, t in enumerate(texts) if t]
        ids_a, ids_b, used = [], [], []
        for k, of_b in zip(given, self.b.encode_all([texts[k] for k in given])):
            whole = " " + texts[k]
            of_a = self.a.encode(whole) if b"".join(map(self.b.labels.__getitem__, of_b)) == whole.encode() else None
            if of_a is not None:
                ids_a.append(np.array(of_a, np.int32))
                ids_b.append(np.array(of_b, np.int32))
                used.append(k)
        if not used:
            return counts, hashes, np.zeros(0, np.int64), np.zeros(0, np.int64)
        n_a, n_b = (np.fromiter(map(len, x), np.int64, len(used)) for x in (ids_a, ids_b))
        ids_a, ids_b = np.concatenate(ids_a), np.concatenate(ids_b)
        ends_a, ends_b = np.cumsum(self.lengths[0][ids_a], dtype=np.int64), np.cumsum(self.lengths[1][ids_b], dtype=np.int64)
        last_a, last_b = cut_groups(ends_a, ends_b)  # all texts in a row: each ends with a common end
        stop_a, stop_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
        in_a, in_b = np.diff(stop_a, prepend=0), np.diff(stop_b, prepend=0)
        text_stop = np.cumsum(n_a)
        text = np.searchsorted(text_stop, stop_a, "left")  # of each group
        where = np.array(used)
        counts[where, 0], counts[where, 1] = n_a, n_b
        counts[where, 2] = np.bincount(text, minlength=len(used))
        np.add.at(counts[:, 3], where[text], in_a * in_b)
        group_a, group_b = np.repeat(np.arange(len(in_a)), in_a), np.repeat(np.arange(len(in_b)), in_b)
        line = np.empty(len(ids_a) + len(ids_b), np.int64)
        line[np.arange(len(ids_a)) + (stop_b - in_b)[group_a]] = 2 * ids_a + last_a
        line[np.arange(len(ids_b)) + stop_a[group_b]] = self.shift + 2 * ids_b + last_b
        stops = text_stop + np.cumsum(n_b)
        for k, begin, stop in zip(used, [0, *stops[:-1].tolist()], stops.tolist()):
            hashes[k] = sha256("".join(map(self.names.__getitem__, line[begin:stop].tolist()))[:-1].encode()).hexdigest()
        keys, times = linked(ids_a, ids_b, stop_a - in_a, stop_b - in_b, in_a, in_b, where[text])
        return counts, hashes, keys, times


def summed(keys: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and how often each occurs (or the sum of its times)."""
    if times is None:
        keys = np.sort(keys)
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        return keys[first], np.diff(first, append=len(keys))
    order = np.argsort(keys, kind="stable")
    keys, times = keys[order], times[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(times, first) if len(first) else times


def linked(ids_a, ids_b, begin_a, begin_b, in_a, in_b, text) -> tuple[np.ndarray, np.ndarray]:
    """(text << 2 BITS | pair), in order, and the number of its links, from the groups' places and sizes."""
    ids_a, ids_b, text = ids_a.astype(np.int64) << BITS, ids_b.astype(np.int64), text.astype(np.int64) << 2 * BITS
    links = in_a * in_b
    single = np.flatnonzero(links == 1)
    found = [text[single] | ids_a[begin_a[single]] | ids_b[begin_b[single]]]
    some = np.flatnonzero((links > 1) & (links < MANY_LINKS))
    group = np.repeat(some, links[some])
    nth = np.arange(len(group)) - np.repeat(np.cumsum(links[some]) - links[some], links[some])
    found.append(text[group] | ids_a[begin_a[group] + nth // in_b[group]] | ids_b[begin_b[group] + nth % in_b[group]])
    keys, times = summed(np.concatenate(found))
    large = np.flatnonzero(links >= MANY_LINKS)
    if len(large):
        all_keys, all_times = [keys], [times]
        for g in large:
            (of_a, times_a), (of_b, times_b) = (np.unique(x[b[g] : b[g] + n[g]], return_counts=True) for x, b, n in ((ids_a, begin_a, in_a), (ids_b, begin_b, in_b)))
            all_keys.append((text[g] | of_a[:, None] | of_b).ravel())
            all_times.append((times_a[:, None] * times_b).ravel())
        keys, times = summed(np.concatenate(all_keys), np.concatenate(all_times))
    return keys, times


@lru_cache(maxsize=2)
def aligner(byte_path: str, piece_path: str, pattern: str) -> Aligner:
    """Made once in each Python worker."""
    return Aligner(byte_path, piece_path, pattern)


def slices(sizes: np.ndarray, limit: int, at: int, stop: int) -> Iterator[tuple[int, int]]:
    """Neighbouring rows of about `limit` bytes; a larger row alone."""
    total = np.cumsum(sizes)
    while at < stop:
        before = total[at - 1] if at else 0
        to = min(stop, max(at + 1, int(np.searchsorted(total, before + limit, "right"))))
        yield at, to
        at = to


def linked_blocks(docs: DataFrame, byte_path: str, piece_path: str, pattern: str, block_bytes: int) -> DataFrame:
    """(block, rest, pairs, held, n_pairs, places, times): a block's rows with their numbers; its distinct pairs and in how many texts
    each is; of each text the number of its pairs, their places among the block's, and their links."""
    place = docs.columns.index("text")
    names = [f"c{i}" for i in range(len(docs.columns))] + ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    columns = ["block", "rest", "pairs", "held", "n_pairs", "places", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, number = aligner(byte_path, piece_path, pattern), TaskContext.get().partitionId() << 32
        for batch in batches:
            sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(place)), 0), np.int64)
            for at, to in slices(sizes, block_bytes, 0, len(batch)):
                counts, hashes, keys, times = [], [], [], []
                for begin, stop in slices(sizes, PART_BYTES, at, to):
                    c, h, k, t = made.align([x or "" for x in batch.column(place).slice(begin, stop - begin).to_pylist()])
                    counts.append(c)
                    hashes += h
                    keys.append(k + ((begin - at) << 2 * BITS))
                    times.append(t)
                counts, keys, times = np.concatenate(counts), np.concatenate(keys), np.concatenate(times)
                pairs, where, held = np.unique(keys & ((1 << 2 * BITS) - 1), return_inverse=True, return_counts=True)
                n_pairs = np.bincount(keys >> 2 * BITS, minlength=to - at)
                steps = np.diff(where, prepend=0).astype(np.int32)
                rest = [batch.column(i).slice(at, to - at) for i in range(batch.num_columns)] + [pa.array(counts[:, i]) for i in range(4)] + [pa.array(hashes, pa.string())]
                values = [number, to_ipc(pa.RecordBatch.from_arrays(rest, names=names)), packed(np.diff(pairs, prepend=0).tobytes())]
                values += [packed(held.astype(np.int32).tobytes()), packed(n_pairs.astype(np.int64).tobytes()), packed(steps.tobytes()), packed(times.astype(np.int64).tobytes())]
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64() if i == 0 else pa.binary()) for i, v in enumerate(values)], names=columns)
                number += 1

    schema = "block long, " + ", ".join([f"{c} binary" for c in columns[1:]])
    return stored(numbered(docs).mapInArrow(run, schema), "linked")


def block_pairs(blocks: DataFrame) -> DataFrame:
    """(block, pair, held): each block's distinct pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            pairs, held = np.cumsum(np.frombuffer(unpacked(row["pairs"]), np.int64)), np.frombuffer(unpacked(row["held"]), np.int32)
            for at in range(0, len(pairs), 1 << 16):
                some = slice(at, at + (1 << 16))
                block = np.full(len(pairs[some]), row["block"])
                yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(pairs[some]), pa.array(held[some])], names=["block", "pair", "held"])

    return blocks.select("block", "pairs", "held").mapInArrow(run, "block long, pair long, held int")


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(pair, count, best): in how many texts ids are linked, and whether the first id is linked in no more with any other."""
    counts = stored(block_pairs(blocks).groupBy("pair").agg(F.sum("held").alias("count")), "pair-counts")
    first = F.shiftright("pair", BITS)
    most = counts.groupBy(first.alias("first")).agg(F.max("count").alias("most"))  # no more rows than the vocabulary has ids
    return counts.join(F.broadcast(most), first == F.col("first")).select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def answers_of(blocks: DataFrame, counts: DataFrame) -> DataFrame:
    """(block, counts, best): the counts of each block's pairs, in order."""
    met = block_pairs(blocks).select("block", "pair").join(counts, "pair").select("block", "pair", "count", "best")
    placed = met.repartition("block").sortWithinPartitions("block", "pair").drop("pair")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running, parts = None, []

        def answer() -> pa.RecordBatch:
            count, best = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            values = [pa.array([running]), pa.array([packed(count.tobytes())], pa.binary()), pa.array([packed(np.packbits(best).tobytes())], pa.binary())]
            return pa.RecordBatch.from_arrays(values, names=["block", "counts", "best"])

        for batch in batches:
            block, count, best = (np.asarray(batch.column(i).to_numpy(zero_copy_only=False)) for i in range(3))
            edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if parts and block[a] != running:
                    yield answer()
                    parts = []
                running = int(block[a])
                parts.append((count[a:b], best[a:b]))
        if parts:
            yield answer()

    return placed.mapInArrow(run, "block long, counts binary, best binary")


def align_documents(docs: DataFrame, byte_path: str, piece_path: str, pattern: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`docs` with n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256."""
    docs = drop_columns(docs, *NEW)
    blocks = linked_blocks(docs, byte_path, piece_path, pattern, block_bytes)
    answers = stored(answers_of(blocks, pair_counts(blocks)), "pair-answers")
    kinds = [T.StructField(n, T.LongType()) for n in NEW[:-1]] + [T.StructField(NEW[-1], T.StringType())]
    out = [f"c{i}" for i in range(len(docs.columns))] + NEW
    schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(out, [*docs.schema.fields, *kinds])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            rest = from_ipc(row["rest"])
            n_pairs, times = (np.frombuffer(unpacked(row[c]), np.int64) for c in ("n_pairs", "times"))
            n_best = count_sum = np.zeros(len(n_pairs), np.int64)
            if row["counts"] is not None:
                places = np.cumsum(np.frombuffer(unpacked(row["places"]), np.int32), dtype=np.int64)
                counts = np.frombuffer(unpacked(row["counts"]), np.int64)
                best = np.unpackbits(np.frombuffer(unpacked(row["best"]), np.uint8), count=len(counts))
                total = [np.concatenate([[0], np.cumsum(times * x[places])]) for x in (best, counts)]
                stop = np.cumsum(n_pairs)
                n_best, count_sum = (t[stop] - t[stop - n_pairs] for t in total)
            columns = [*rest.columns[:-1], pa.array(n_best), pa.array(count_sum), rest.columns[-1]]
            yield pa.RecordBatch.from_arrays(columns, names=out)

    met = blocks.select("block", "rest", "n_pairs", "places", "times").join(answers, "block", "left")
    return met.mapInArrow(run, schema).toDF(*docs.columns, *NEW)
