"""A hidden Markov language model: trained by Baum-Welch on all training texts, scored exactly.

Each state emits words: P(w | k) = share(w) x ratio(w, k), where share(w) = (c(w) + 0.5) / (n + 0.5 (V + 1)) is the word's share
of the corpus, with one share for all unknown words, and ratio(w, k) = (e(w, k) + 0.5 m(k)) / (m(k) (c(w) + 0.5)), with the expected
counts e and the state's share m of all tokens; a little of the share itself is mixed in. The ratio of an unknown word is 1. So each
word has its own profile of states, and the model grows with the vocabulary. Together that is a distribution over texts: each ends
with one end token.

1. Each text becomes numbers in the dictionary of its block. Blocks name each word once, with its training count;
   buckets of word hashes (128 bits) add them up and answer each block. No table of all words stands in one place.
2. The states are told apart at first by the most frequent words: those that share documents form groups.
3. Baum-Welch: tasks run the scaled forward and backward recursions over their blocks, side by side for many texts; the expected
   counts by word and state go to the buckets of words, which add them up and answer each block for the next round. Only sums by
   state reach the driver. Rounds end when the likelihood gains less than GAIN a token.
4. The scaled forward recursion gives each text's likelihood; the logarithms of the scales add up.

Defined cases: null is the empty text, one end token. A null doc_id counts as a training text (for the query).
Repeated rows are texts of their own. With no training text at all every word is unknown and the states are alike.
Columns with the names of the new ones are replaced; others are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumlens.llm.blocks import from_ipc, packed, rows_of, to_ipc, unpacked
from forumlens.llm.common import drop_columns, fresh, numbered, tasks_for
from forumlens.session import Scope, buckets_for, lifetimes, stored, stored_in_buckets

STATES = 8
#: Places in the order of word hashes; buckets are ranges of them.
CLASSES = 1 << 24
#: The rounds end when a token's mean log likelihood (base e) gains less.
GAIN = 0.005
SEED = 42
ANCHORS = 128
BLOCK_TOKENS = 2_000_000
#: Tokens whose recursions run side by side, about 100 bytes each.
BATCH_TOKENS = 500_000
#: Tokens gathered at a time.
SLICE = 1 << 16
#: Distinct words of blocks that meet in one bucket, about.
BUCKET_WORDS = 1_000_000
#: Share of the corpus-wide distribution in each state's.
BACKGROUND = 0.01
END = b"\n"
PARTS = 8
#: Tasks over the blocks, at least, if there are blocks for them.
TASKS = 6


class Numbering(dict):
    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def word_hashes(words: list[bytes]) -> np.ndarray:
    """Two uint64 for each word."""
    return np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), "<u8").reshape(-1, 2)


def encode_blocks(docs: DataFrame, training: str, block_tokens: int, laid_out: int) -> DataFrame:
    """Blocks of numbered texts: (block, n_words, rest, lengths, train, ids, hashes, counts), laid out by block, so they are never shuffled."""
    place, flag = docs.columns.index("text"), docs.columns.index(training)
    keep = [i for i, c in enumerate(docs.columns) if c != training]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            texts, flags = batch.column(place).cast(pa.binary()), batch.column(flag).to_pylist()
            at = 0
            while at < len(batch):
                begin, number, rows, tokens = at, Numbering({END: 0}), [], 0
                while at < len(batch) and tokens < block_tokens:
                    words = (texts[at].as_py() or b"").lower().split()
                    row = np.zeros(len(words) + 1, np.int32)
                    row[:-1] = np.fromiter(map(number.__getitem__, words), np.int32, len(words))
                    rows.append(row)
                    tokens += len(row)
                    at += 1
                train = np.array(flags[begin:at], bool)
                lengths = np.array([len(r) for r in rows], np.int32)
                hashes = word_hashes(list(number))
                order = np.lexsort((hashes[:, 1], hashes[:, 0], class_of(hashes)))  # words are numbered by class, so buckets are ranges
                renumber = np.empty(len(order), np.int32)
                renumber[order] = np.arange(len(order), dtype=np.int32)
                ids, hashes, n_words = renumber[np.concatenate(rows)], hashes[order], len(number)
                rows, number = [], Numbering()  # their memory goes before the block is packed
                counts = np.bincount(ids[np.repeat(train, lengths)], minlength=n_words).astype(np.int64)
                rest = pa.RecordBatch.from_arrays([batch.column(i).slice(begin, at - begin) for i in keep], names=[f"c{i}" for i in keep])
                values = [first + made, n_words, to_ipc(rest), lengths.tobytes(), train.tobytes(), packed(ids.tobytes())]
                values += [hashes.tobytes(), packed(counts.tobytes())]
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64() if i < 2 else pa.binary()) for i, v in enumerate(values)], names=names)
                made += 1
                del rest, values, ids, hashes, renumber, order, counts
                pa.default_memory_pool().release_unused()

    names = ["block", "n_words", "rest", "lengths", "train", "ids", "hashes", "counts"]
    schema = "block long, n_words long, rest binary, lengths binary, train binary, ids binary, hashes binary, counts binary"
    return stored_in_buckets(numbered(docs).mapInArrow(run, schema), "encoded", "block", laid_out)


def class_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes[:, 1] % np.uint64(CLASSES)).astype(np.int64)


def dealt(classes: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """(bucket, its words), in order: a bucket has the words of some neighbouring classes."""
    to = classes.astype(np.int64) * buckets // CLASSES
    edges = [0, *(np.flatnonzero(np.diff(to)) + 1), len(to)]
    for a, b in zip(edges, edges[1:]):
        yield int(to[a]), slice(a, b)


def distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each hash among the distinct ones, and where each of these is found."""
    order = np.lexsort((hashes[:, 1], hashes[:, 0], class_of(hashes)))
    new = np.ones(len(order), bool)
    new[1:] = (hashes[order][1:] != hashes[order][:-1]).any(axis=1)
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    return place, order[new]


def count_words(blocks: DataFrame, buckets: int) -> DataFrame:
    """(block, bucket, answer, places): training counts of the words that a block sent and their numbers in the bucket; block -1 has tokens, words and the most frequent words."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows_of(batches):
            hashes = np.frombuffer(row["hashes"], np.uint64).reshape(-1, 2)
            counts = np.frombuffer(unpacked(row["counts"]), np.int64)
            for bucket, some in dealt(class_of(hashes), buckets):
                values = [bucket, row["block"], hashes[some].tobytes(), packed(counts[some].tobytes())]
                kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=["bucket", "block", "hashes", "counts"])

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        hashes = np.frombuffer(b"".join(frame["hashes"]), np.uint64).reshape(-1, 2)
        counts = np.frombuffer(b"".join(map(unpacked, frame["counts"])), np.int64)
        place, first = distinct(hashes)
        total = np.bincount(place, weights=counts, minlength=len(first)).astype(np.int64)
        back = total[place]
        sizes = np.cumsum([len(h) // 16 for h in frame["hashes"]])
        answers = [packed(x.tobytes()) for x in np.split(back, sizes[:-1])]
        top = np.argsort(-total, kind="stable")[:ANCHORS]
        stats = np.concatenate([[total.sum(), (total > 0).sum()], total[top], hashes[first[top]].view(np.int64).ravel()]).astype(np.int64)
        blocks_of, buckets_of = [*frame["block"], -1], [*frame["bucket"], frame["bucket"].iloc[0]]
        # a block has its words in the bucket's order: steps from one to the next are small
        places = [packed(np.diff(x, prepend=0).astype(np.int32).tobytes()) for x in np.split(place, sizes[:-1])]
        return pd.DataFrame({"block": blocks_of, "bucket": buckets_of, "answer": [*answers, stats.tobytes()], "places": [*places, b""]})

    sent = blocks.select("block", "hashes", "counts").mapInArrow(send, "bucket long, block long, hashes binary, counts binary")
    return sent.groupBy("bucket").applyInPandas(add, "block long, bucket long, answer binary, places binary")


def with_answers(blocks: DataFrame, answers: DataFrame, laid_out: int) -> DataFrame:
    """`blocks` with the list `answers` of the rows of `answers` for each, by bucket, or null; only the answers move."""
    columns = [c for c in answers.columns if c != "block"]
    lists = answers.repartition(laid_out, "block").groupBy("block").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("answers"))
    return blocks.join(lists.hint("merge"), "block", "left")


class Texts:
    """Texts side by side: step by step, the longest first, without padding."""

    def __init__(self, lengths: np.ndarray):
        self.order = np.argsort(-lengths, kind="stable")
        lengths = lengths[self.order]
        steps = int(lengths[0]) if len(lengths) else 0
        self.active = np.searchsorted(-lengths, -np.arange(steps), side="left")  # texts longer than the step
        self.offset = np.concatenate([[0], np.cumsum(self.active)])
        begin = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        step = np.arange(lengths.sum()) - np.repeat(begin, lengths)
        self.text = np.repeat(np.arange(len(lengths)), lengths)
        self.place = self.offset[step] + self.text
        self.step = step


class Space:
    """Arrays that a task's batches use one after the other."""

    def __init__(self):
        self.held: dict[int, np.ndarray] = {}

    def array(self, which: int, rows: int, columns: int, dtype) -> np.ndarray:
        now = self.held.get(which)
        if now is None or now.shape[0] != rows or now.shape[1] < columns or now.dtype != dtype:
            now = self.held[which] = np.empty((rows, columns), dtype)
        return now[:, :columns]


class Model:
    """start (K), move (K, K), emit (words, K): up to a factor for each word.

    Values of tokens are (K, tokens), in the order of `Texts`: a step is a slice of each state's row.
    """

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray, space: Space | None = None):
        self.start, self.move, self.emit, self.space = start, move, emit, space or Space()

    def emissions(self, seen: np.ndarray) -> np.ndarray:
        values = self.space.array(0, self.emit.shape[1], len(seen), self.emit.dtype)
        for at in range(0, len(seen), SLICE):
            values[:, at : at + SLICE] = self.emit[seen[at : at + SLICE]].T
        return values

    def forward(self, alpha: np.ndarray, texts: Texts) -> np.ndarray:
        """Turns emissions into scaled forward values in place; the scales."""
        scale = np.empty(alpha.shape[1], alpha.dtype)
        turn, before = np.ascontiguousarray(self.move.T), None
        for a, n in zip(texts.offset.tolist(), texts.active.tolist()):
            now = alpha[:, a : a + n]
            now *= self.start[:, None] if before is None else turn @ before[:, :n]
            now /= np.add.reduce(now, axis=0, out=scale[a : a + n])
            before = now
        return scale

    def expect(self, seen: np.ndarray, texts: Texts, sums: dict[str, np.ndarray]) -> None:
        """Add the expected counts of these texts to `sums`."""
        ahead = self.emissions(seen)
        alpha, beta = (self.space.array(i, *ahead.shape, ahead.dtype) for i in (1, 2))
        np.copyto(alpha, ahead)
        scale = self.forward(alpha, texts)
        if "log" in sums:
            sums["log"] += np.log(scale).sum(dtype=np.float64)
        ahead /= scale  # becomes emission x backward value / scale
        beta[:] = 1
        steps = list(zip(texts.offset.tolist(), texts.active.tolist(), [*texts.active[1:].tolist(), 0]))
        for a, n, m in reversed(steps):
            if m:
                np.matmul(self.move, ahead[:, a + n : a + n + m], out=beta[:, a : a + m])
            ahead[:, a : a + n] *= beta[:, a : a + n]
        first = int(texts.active[0])
        ago = np.arange(first, len(seen)) - np.repeat(texts.active[:-1], texts.active[1:])  # the same text, a step before
        moved = np.zeros(self.move.shape)
        for at in range(0, len(ago), SLICE):
            moved += alpha[:, ago[at : at + SLICE]] @ ahead[:, first + at : first + at + SLICE].T
        sums["move"] += self.move * moved
        alpha *= beta
        sums["start"] += alpha[:, :first].sum(axis=1)
        for k, own in enumerate(alpha):
            sums["emit"][:, k] += np.bincount(seen, weights=own, minlength=len(self.emit))


def batches_of(lengths: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """Indices of texts of like length, `limit` tokens at a time (a longer text alone)."""
    order = np.argsort(-lengths, kind="stable")
    group = (np.cumsum(lengths[order]) - 1) // limit
    for some in np.split(order, np.flatnonzero(np.diff(group)) + 1):
        if len(some):
            yield some


def read_texts(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, training flags and word numbers."""
    return np.frombuffer(row["lengths"], np.int32).astype(np.int64), np.frombuffer(row["train"], bool), np.frombuffer(unpacked(row["ids"]), np.int32)


def read_block(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, training flags, word numbers and the hashes of each number."""
    return *read_texts(row), np.frombuffer(row["hashes"], np.uint64).reshape(-1, 2)


def side_by_side(ids: np.ndarray, lengths: np.ndarray, some: np.ndarray) -> tuple[Texts, np.ndarray]:
    """The texts `some` side by side, and their word numbers in that order."""
    texts = Texts(lengths[some])
    begin = np.cumsum(lengths) - lengths
    seen = np.empty(len(texts.place), np.int64)
    seen[texts.place] = ids[np.repeat(begin[some][texts.order], lengths[some][texts.order]) + texts.step]
    return texts, seen


def summed(blocks: DataFrame, tasks: int, work, size: int) -> np.ndarray:
    """The sum of `work(row)`, vectors of `size` numbers, over all blocks: by task, by 64 tasks, in all."""
    edges = np.linspace(0, size, PARTS + 1).astype(int)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for row in rows_of(batches):
            total += work(row)
        level = TaskContext.get().partitionId() // 64
        data = [packed(total[a:b].astype(np.float32).tobytes()) for a, b in zip(edges, edges[1:])]
        yield pa.RecordBatch.from_arrays([pa.array([level] * PARTS, pa.int64()), pa.array(range(PARTS), pa.int64()), pa.array(data, pa.binary())], names=["level", "part", "data"])

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(len(unpacked(frame["data"].iloc[0])) // 4)
        for data in frame["data"]:
            total += np.frombuffer(unpacked(data), np.float32)
        return pd.DataFrame({"level": frame["level"].iloc[:1], "part": frame["part"].iloc[:1], "data": [packed(total.astype(np.float32).tobytes())]})

    schema = "level long, part long, data binary"
    parts = blocks.coalesce(tasks).mapInArrow(partial, schema)
    parts = parts.groupBy("level", "part").applyInPandas(add, schema).groupBy("part").applyInPandas(add, schema)
    found = {r["part"]: np.frombuffer(unpacked(bytes(r["data"])), np.float32) for r in parts.collect()}
    return np.concatenate([found[k] for k in range(PARTS)]).astype(np.float64) if found else np.zeros(size)


def column_of(hashes: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Which of the anchors, in order of their first half, each word is; -1 if none."""
    at = np.minimum(np.searchsorted(anchors[:, 0], hashes[:, 0]), len(anchors) - 1)
    return np.where((anchors[at] == hashes).all(axis=1), at, -1)


def first_groups(blocks: DataFrame, tasks: int, anchors: np.ndarray, states: int) -> np.ndarray:
    """A state for each of the frequent words `anchors`; those that occur in the same documents share it."""
    n = len(anchors)

    def together(row: dict) -> np.ndarray:
        lengths, train, ids, hashes = read_block(row)
        at = column_of(hashes, anchors)[ids]
        text = np.repeat(np.arange(len(lengths)), lengths)
        use = (at >= 0) & train[text]
        has = np.zeros((len(lengths), n), np.float32)
        has[text[use], at[use]] = 1
        return (has.T @ has).ravel().astype(np.float64)

    shared = summed(blocks, tasks, together, n * n).reshape(n, n)
    own = np.maximum(np.diag(shared), 1)
    profile = shared / own[:, None] - own / max(own.max(), 1)
    profile /= np.maximum(np.linalg.norm(profile, axis=1, keepdims=True), 1e-9)
    centres = [int(np.argmax(own))]
    while len(centres) < states:
        far = (1 - profile @ profile[centres].T).min(axis=1)
        centres.append(int(np.argmax(far)))
    centre = profile[centres]
    for _ in range(20):
        group = np.argmax(profile @ centre.T, axis=1)
        for k in range(states):
            if (group == k).any():
                centre[k] = profile[group == k].mean(axis=0)
                centre[k] /= max(np.linalg.norm(centre[k]), 1e-9)
    return group


def first_ratios(hashes: np.ndarray, anchors: np.ndarray, group: np.ndarray, states: int) -> np.ndarray:
    """Nearly 1, by the word's hash, but for the anchors."""
    turns = np.random.default_rng(SEED).integers(0, 2**63, states, np.uint64) | np.uint64(1)
    ratios = 0.95 + 0.1 * ((hashes[:, :1] * turns) >> np.uint64(40)).astype(np.float64) / 2**24
    at = column_of(hashes, anchors)
    some = np.flatnonzero(at >= 0)
    ratios[some] *= np.where(group[at[some]][:, None] == np.arange(states), 4.0, 0.25)
    return ratios


def ratios_of(expected: np.ndarray, mass: np.ndarray, counts: np.ndarray | None = None) -> np.ndarray:
    """P(word | state) / share(word) from the expected counts (words, K) and the states' shares of all tokens."""
    count = expected.sum(axis=1, keepdims=True) if counts is None else counts[:, None]  # a token's states add up to 1
    return (1 - BACKGROUND) * (expected + 0.5 * mass) / (mass * (count + 0.5)) + BACKGROUND


def packed_counts(expected: np.ndarray) -> bytes:
    """Expected counts (words, K) of whole tokens, so a word's total is a whole number; all states but the last in steps of 1/65535 of it, by bytes of like weight."""
    total = np.rint(expected.sum(axis=1)).astype(np.float32)
    steps = np.rint(expected[:, :-1] / np.maximum(total, 1)[:, None] * 65535).T.astype(np.uint16)
    planes = (steps >> 8).astype(np.uint8), (steps & 255).astype(np.uint8)
    return packed(total.tobytes() + planes[0].tobytes() + planes[1].tobytes(), 1)  # a higher level makes it no smaller


def unpacked_counts(data: bytes, states: int) -> np.ndarray:
    data = unpacked(data)
    n = len(data) // (2 + 2 * states)
    high, low = np.frombuffer(data, np.uint8, offset=4 * n).reshape(2, states - 1, n)
    shares = np.empty((states, n), np.float32)
    most = shares[:-1]
    most[:] = high
    most *= 256
    most += low
    most /= 65535
    shares[-1] = np.maximum(1 - most.sum(axis=0), 0)
    shares *= np.frombuffer(data, np.float32, n)
    return np.ascontiguousarray(shares.T)


def expected_of(row: dict, states: int) -> np.ndarray:
    return np.concatenate([unpacked_counts(a["answer"], states) for a in row["answers"]])


def train_round(asked: DataFrame, states: int, start: np.ndarray, move: np.ndarray, ratios) -> DataFrame:
    """(block, bucket, answer, places): expected counts of each block's words by state, in the whole corpus, and their numbers in the bucket.

    Block -1 has sums for the driver: of bucket -1 start, move and log likelihood, of the others the states' tokens.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["bucket", "block", "places", "counts"], [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        total, seen_any, space = np.zeros(states + states * states + 1), False, Space()
        for row in rows_of(batches):
            lengths, training, ids = read_texts(row)
            now = Model(*[x.astype(np.float32) for x in (start, move, ratios(row))], space)
            sums = {"start": np.zeros(states), "move": np.zeros((states, states)), "emit": np.zeros((len(now.emit), states)), "log": np.zeros(1)}
            of_training = np.flatnonzero(training)
            for some in batches_of(lengths[of_training], BATCH_TOKENS):
                texts, seen = side_by_side(ids, lengths, of_training[some])
                now.expect(seen, texts, sums)
            total += np.concatenate([sums["start"], sums["move"].ravel(), sums["log"]])
            at = 0
            seen_any = True
            for part in row["answers"]:  # by bucket, as the words are
                n = len(unpacked(part["places"])) // 4
                values = [part["bucket"], row["block"], part["places"], packed_counts(sums["emit"][at : at + n])]
                at += n
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=names)
            del now, sums, row
            pa.default_memory_pool().release_unused()
        if seen_any:
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip([-1, -1, b"", packed(total.tobytes())], kinds)], names=names)

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        bucket = frame["bucket"].iloc[0]
        if bucket < 0:
            total = sum(np.frombuffer(unpacked(x), np.float64) for x in frame["counts"])
            return pd.DataFrame({"block": [-1], "bucket": [bucket], "answer": [total.tobytes()], "places": [b""]})
        places = [np.cumsum(np.frombuffer(unpacked(x), np.int32)) for x in frame["places"]]
        total = np.zeros((1 + max(int(x[-1]) for x in places), states))
        for place, counts in zip(places, frame["counts"]):
            total[place] += unpacked_counts(counts, states)  # a block names a word once
        answers = [packed_counts(total[place]) for place in places]
        total = unpacked_counts(packed_counts(total), states).astype(np.float64)  # as the blocks will see it
        return pd.DataFrame({"block": [*frame["block"], -1], "bucket": bucket, "answer": [*answers, total.sum(axis=0).tobytes()], "places": [*frame["places"], b""]})

    sent = asked.mapInArrow(work, "bucket long, block long, places binary, counts binary")
    return stored(sent.groupBy("bucket").applyInPandas(add, "block long, bucket long, answer binary, places binary"), "expected")


def train(blocks: DataFrame, answers: DataFrame, laid_out: int, tasks: int, anchors: np.ndarray, n_train: int, states: int, rounds: int | None, commit):
    """Baum-Welch over all training texts, to the end or `rounds` times: start, move, the states' shares, expected counts.

    `answers` tell a block where its words stand in the buckets. `commit` drops the last round's table once the next one stands.
    """
    anchors = anchors[np.argsort(anchors[:, 0], kind="stable")]
    group = first_groups(blocks, tasks, anchors, states)
    start, move = np.full(states, 1 / states), np.full((states, states), 0.1 / states) + 0.9 * np.eye(states)
    texts, hashes = blocks.select("block", "lengths", "train", "ids"), blocks.select("block", "lengths", "train", "ids", "hashes")
    asked, ratios = with_answers(hashes, answers.select("block", "bucket", "places"), laid_out), lambda row: first_ratios(read_block(row)[3], anchors, group, states)
    before, made = -np.inf, 0
    while True:
        expected = train_round(asked, states, start, move, ratios)
        commit(expected)
        found = [(r["bucket"], np.frombuffer(bytes(r["answer"]), np.float64)) for r in expected.filter("block = -1").collect()]
        begun, moved, (log,) = np.split(next(x for b, x in found if b < 0), [states, states + states * states])
        mass = np.maximum(sum(x for b, x in found if b >= 0), 1e-3) / n_train
        start, move = begun + 1, moved.reshape(states, states) + 1
        start, move = start / start.sum(), move / move.sum(axis=1, keepdims=True)
        made += 1
        if made == rounds or log - before < GAIN * n_train:
            return start, move, mass, expected.filter("block >= 0")
        before = log
        asked = with_answers(texts, expected.filter("block >= 0"), laid_out)
        ratios = lambda row, mass=mass.astype(np.float32): ratios_of(expected_of(row, states), mass)


def score_texts(docs: DataFrame, training: Column, states: int = STATES, rounds: int | None = None, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """`docs` with held_out, n_tokens, n_known, train_tokens, base_score and score (log10), the model being trained where `training` holds."""
    new = ["held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    docs = drop_columns(docs, *new)
    with lifetimes(docs.sparkSession) as scope:
        scored = _score_texts(scope, docs, new, training, states, rounds, block_tokens)
        scope.hand_over(scored)
    return scored


def _score_texts(scope: Scope, docs: DataFrame, new: list[str], training: Column, states: int, rounds: int | None, block_tokens: int) -> DataFrame:
    flag = fresh("training", docs.columns)
    laid_out = buckets_for(docs, 4)
    blocks = encode_blocks(docs.withColumn(flag, training), flag, block_tokens, laid_out)
    named, n_blocks = blocks.agg(F.sum("n_words"), F.count("*")).first()
    buckets = min(CLASSES, tasks_for(named or 0, BUCKET_WORDS))
    answers = stored(count_words(blocks, buckets), "counts")
    stats = [np.frombuffer(bytes(r[0]), np.int64) for r in answers.filter("block = -1").select("answer").collect()]  # a few words of each bucket
    n_train, n_distinct = sum(int(x[0]) for x in stats), sum(int(x[1]) for x in stats)
    own = [(len(x) - 2) // 3 for x in stats]
    often = np.concatenate([x[2 : 2 + n] for x, n in zip(stats, own)] or [np.zeros(0, np.int64)])
    words = np.concatenate([x[2 + n :].view(np.uint64).reshape(-1, 2) for x, n in zip(stats, own)] or [np.zeros((0, 2), np.uint64)])
    anchors = words[np.lexsort((words[:, 1], words[:, 0], -often))[:ANCHORS]]
    start, move, mass, expected = np.full(states, 1 / states), np.eye(states), np.full(states, 1 / states), None
    if n_train:
        tasks = min(n_blocks, max(TASKS, tasks_for(named, BUCKET_WORDS // 2)))
        start, move, mass, expected = train(blocks, answers.filter("block >= 0"), laid_out, tasks, anchors, n_train, states, rounds, lambda *read: scope.commit(blocks, answers, *read))
    base = n_train + 0.5 * (n_distinct + 1)
    expected_known = expected is not None
    kinds = [T.BooleanType(), T.LongType(), T.LongType(), T.LongType(), T.DoubleType(), T.DoubleType()]
    out = T.StructType([*docs.schema.fields, *[T.StructField(n, t) for n, t in zip(new, kinds)]])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = Space()
        for row in rows_of(batches):
            lengths, train_flags, ids = read_texts(row)
            counts = np.concatenate([np.frombuffer(unpacked(a["counted"]), np.int64) for a in row["answers"]])  # by bucket, as the words are
            ratios = ratios_of(expected_of(row, states), mass, counts) if expected_known else np.ones((len(counts), states))
            model = Model(start, move, ratios, space)
            text = np.repeat(np.arange(len(lengths)), lengths)
            add_up = lambda x, text=text, n=len(lengths): np.bincount(text, weights=x, minlength=n)
            base_scores = add_up(np.log10((counts + 0.5) / base)[ids])
            scores = base_scores.copy()
            for some in batches_of(lengths, BATCH_TOKENS):
                texts, seen = side_by_side(ids, lengths, some)
                scale = model.forward(model.emissions(seen), texts)
                mine = np.bincount(texts.text, weights=np.log10(scale)[texts.place], minlength=len(some))
                scores[some[texts.order]] += mine
            known = add_up((counts > 0)[ids]).astype(np.int64)
            values = [~train_flags, lengths, known, np.full(len(lengths), n_train), base_scores, scores]
            rest = from_ipc(row["rest"])
            yield pa.RecordBatch.from_arrays([*rest.columns, *map(pa.array, values)], names=out.names)

    counted = answers.filter("block >= 0").select("block", "bucket", F.col("answer").alias("counted"))
    if expected_known:
        counted = counted.join(expected.select("block", "bucket", "answer"), ["block", "bucket"])
    return with_answers(blocks.drop("counts", "hashes", "n_words"), counted, laid_out).mapInArrow(score, out)
