"""Byte-level BPE encoding and decoding by ranks, with a segment tree over byte positions.

A text is split by the tokenizer's pattern; each match is a word. A word's bytes are its first tokens. The leaf of a
byte position holds the rank of the pair that begins there (of the token at this position and the next live one), with the
position below it; an inner node holds the least of its two children. So the root has the leftmost pair of least rank. A merge
writes three leaves: the merged pair's, that of the live neighbour before, and that of the position that died; each is a
point update of logarithmic length. Words are merged until the root is empty.

Words of a batch that are of like length stand side by side in arrays, and one step makes the next merge of each of them.
Longer ones (LONG bytes or more) have a tree of their own, of the same kind, so a text without any break takes n log n steps.

The library's letters and digits are those of its own Unicode version. They are asked from the library once in each worker; texts
with a character on which the splitter here differs are split by a pattern without it.

Defined cases: null is the empty text, which has no tokens. Special tokens in texts are plain text. Repeated rows are encoded
one by one. Columns with the names of the new ones are replaced; others are kept. Very long texts are split block by block.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import sha256
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from forumlens.llm.common import drop_columns, map_batches

#: Words that a Python worker remembers; beyond that it keeps those of the last batch. Results don't depend on it.
REMEMBERED = 300_000
#: Rows and characters that a worker holds the words of at once.
ROWS, CHARS = 1024, 2_000_000
#: Bytes from which a word has a tree of its own.
LONG = 128
#: Words that are merged side by side.
TOGETHER = 50_000
NONE = np.int64(2**62)


class Ranks:
    """Token bytes by id, and the rank of every pair of tokens that can be merged."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.labels = {i: t for t, i in ranks.items()}
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[left, right] = rank
        keys = np.array([(a << 32) | b for a, b in self.pairs], np.int64)
        order = np.argsort(keys)
        self.keys = np.append(keys[order], NONE)
        self.of_key = np.append(np.array(list(self.pairs.values()), np.int64)[order], 0)

    def of_pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of tokens; NONE where they don't merge (a token below 0 is none)."""
        wanted = (left << 32) | right
        at = np.searchsorted(self.keys, wanted)
        return np.where((self.keys[at] == wanted) & (left >= 0) & (right >= 0), self.of_key[at], NONE)


class PairTree:
    """The segment tree of one word."""

    def __init__(self, leaves: list[int]):
        self.size = 1
        while self.size < len(leaves):
            self.size *= 2
        self.nodes = [NONE] * self.size + leaves + [NONE] * (self.size - len(leaves))
        for k in range(self.size - 1, 0, -1):
            self.nodes[k] = min(self.nodes[2 * k], self.nodes[2 * k + 1])

    def update(self, place: int, value: int) -> None:
        nodes, k = self.nodes, self.size + place
        nodes[k] = value
        while k > 1:
            k >>= 1
            least = min(nodes[2 * k], nodes[2 * k + 1])
            if nodes[k] == least:
                return
            nodes[k] = least


def merge_long(word: bytes, ranks: Ranks) -> list[int]:
    """The tokens of one word of any length."""
    n, none = len(word), int(NONE)
    token = [int(i) for i in ranks.byte_ids[list(word)]]
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    pairs, shift = ranks.pairs, n.bit_length()

    def leaf(place: int) -> int:
        right = after[place]
        rank = pairs.get((token[place], token[right])) if right < n else None
        return none if rank is None else (rank << shift) | place

    tree = PairTree([leaf(p) for p in range(n)])
    while (best := tree.nodes[1]) < none:
        place = best & ((1 << shift) - 1)
        gone = after[place]
        token[place], token[gone] = best >> shift, -1
        after[place] = after[gone]
        if after[gone] < n:
            before[after[gone]] = place
        tree.update(gone, none)
        tree.update(place, leaf(place))
        if before[place] >= 0:
            tree.update(before[place], leaf(before[place]))
    return [t for t in token if t >= 0]


def merge_together(words: list[bytes], ranks: Ranks) -> list[bytes]:
    """The tokens of words of at most `size` bytes, the longest's next power of two, as unsigned 32-bit integers."""
    size = 2
    while size < max(map(len, words)):
        size *= 2
    n, bits = len(words), size.bit_length()
    lengths = np.fromiter(map(len, words), np.int64, n)
    token = np.full((n, size + 1), -1, np.int64)  # by byte position; -1 where none begins
    inside = np.arange(size) < lengths[:, None]
    token[:, :size][inside] = ranks.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
    after = np.tile(np.arange(1, size + 2), (n, 1))
    before = np.tile(np.arange(-1, size), (n, 1))
    tree = np.full((n, 2 * size), NONE)
    rank = ranks.of_pairs(token[:, :-1], token[:, 1:])
    tree[:, size:] = np.where(rank < NONE, (rank << bits) | np.arange(size), NONE)
    for k in range(size - 1, 0, -1):
        np.minimum(tree[:, 2 * k], tree[:, 2 * k + 1], out=tree[:, k])
    flat, tokens, next_, previous = tree.ravel(), token.ravel(), after.ravel(), before.ravel()
    live = np.flatnonzero(tree[:, 1] < NONE)
    while len(live):
        best = flat[live * (2 * size) + 1]
        place = best & ((1 << bits) - 1)
        row, roots = live * (size + 1), live * (2 * size)
        gone = next_[row + place]
        then = next_[row + gone]
        ago = previous[row + place]
        merged = best >> bits
        tokens[row + place], tokens[row + gone] = merged, -1
        next_[row + place] = then
        previous[row + np.minimum(then, size)] = place  # the last place of a row is no token's
        first = np.maximum(ago, 0)
        rank = ranks.of_pairs(np.concatenate([merged, np.where(ago >= 0, tokens[row + first], -1)]), np.concatenate([tokens[row + np.minimum(then, size)], merged]))
        where = np.concatenate([place, first])
        fresh = np.where(rank < NONE, (rank << bits) | where, NONE)
        some = np.concatenate([np.ones(len(live), bool), ago >= 0])
        leaves = np.concatenate([np.concatenate([place, first])[some], gone]) + size
        base = np.concatenate([np.concatenate([roots, roots])[some], roots])
        flat[base + leaves] = np.concatenate([fresh[some], np.full(len(live), NONE)])
        for _ in range(bits - 1):
            leaves >>= 1
            children = base + 2 * leaves
            flat[base + leaves] = np.minimum(flat[children], flat[children + 1])
        live = live[flat[roots + 1] < NONE]
    token = token[:, :size]
    data = token[token >= 0].astype("<u4").tobytes()
    ends = np.cumsum((token >= 0).sum(axis=1)) * 4
    return [data[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]


def merge_all(words: Iterable[bytes], ranks: Ranks) -> dict[bytes, bytes]:
    """The token ids of each word, as little-endian unsigned 32-bit integers."""
    found, by_size = {}, {}
    for word in words:
        whole = ranks.ranks.get(word)
        if whole is not None:
            found[word] = whole.to_bytes(4, "little")
        elif len(word) >= LONG:
            found[word] = np.array(merge_long(word, ranks), "<u4").tobytes()
        else:
            by_size.setdefault((len(word) - 1).bit_length(), []).append(word)
    for some in by_size.values():
        for at in range(0, len(some), TOGETHER):
            part = some[at : at + TOGETHER]
            found.update(zip(part, merge_together(part, ranks)))
    return found


def characters(kind: str) -> str:
    """The characters that the tokenizer's library takes for this kind of pattern."""
    bytes_only = {bytes([b]): b for b in range(256)}
    every = "".join([chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000])
    return bytes(tiktoken.Encoding("kind", pat_str=kind, mergeable_ranks=bytes_only, special_tokens={}).encode_ordinary(every)).decode()


def as_class(chars: Iterable[str]) -> str:
    """A character class of runs."""
    codes = np.array(sorted(map(ord, chars)))
    runs = np.split(codes, np.flatnonzero(np.diff(codes) > 1) + 1)
    return "[" + "".join([f"\\U{int(r[0]):08x}-\\U{int(r[-1]):08x}" for r in runs]) + "]"


class Splitter:
    """Matches of the tokenizer's pattern, as its library finds them."""

    def __init__(self, pattern: str):
        self.plain = regex.compile(pattern, regex.V1)
        self.strict, self.odd = self.plain, None
        other = set()
        own = "".join([chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000])
        for kind in (r"\p{L}", r"\p{N}"):
            theirs, ours = set(characters(kind)), set(regex.findall(kind, own))
            if theirs != ours:
                other |= theirs ^ ours
                exact = f"[[{kind}--{as_class(ours - theirs)}]" if ours - theirs else f"[{kind}"
                exact += (as_class(theirs - ours) if theirs - ours else "") + "]"
                pattern = pattern.replace(kind, exact)
        if other:
            self.strict, self.odd = regex.compile(pattern, regex.V1), regex.compile(as_class(other))
            self.late = re.compile(f"[{re.escape(min(other))}-\U0010ffff]")  # much faster, and rare in most texts

    def words(self, text: str) -> Iterator[list[str]]:
        """The matches, block by block."""
        odd = self.odd is not None and not text.isascii() and self.late.search(text) and self.odd.search(text)
        exact = self.strict if odd else self.plain
        if len(text) <= CHARS:
            yield exact.findall(text)
            return
        found = exact.finditer(text)
        while some := [m.group() for m in islice(found, CHARS)]:
            yield some


class Coder:
    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            self.ranks = Ranks({base64.b64decode(a): int(b) for a, b in map(bytes.split, file)})
        self.splitter = Splitter(pattern)
        self.known: dict[str, bytes] = {}

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Token ids of each text, as little-endian unsigned 32-bit integers."""
        split = [list(self.splitter.words(t)) for t in texts]
        wanted = set()
        for blocks in split:
            for words in blocks:
                wanted.update(words)
        known = self.known
        new = [w for w in wanted if w not in known]
        if new:
            data = [w.encode() for w in new]
            coded = merge_all(data, self.ranks)
            known.update(zip(new, map(coded.__getitem__, data)))
        out = [b"".join([b"".join(map(known.__getitem__, words)) for words in blocks]) for blocks in split]
        if len(known) > REMEMBERED:
            self.known = {w: known[w] for w in wanted} if len(wanted) <= REMEMBERED else {}
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.ranks.labels.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> Coder:
    """Made once in each Python worker."""
    return Coder(path, pattern)


def encode_documents(docs: DataFrame, path: str, pattern: str, digests: bool = False) -> DataFrame:
    """`docs` with `token_ids` and `decoded` (bytes); with `digests`, n_tokens, ids_sha256 and decoded_sha256 in their place."""
    if digests:
        more = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    else:
        more = [("token_ids", T.ArrayType(T.IntegerType())), ("decoded", T.BinaryType())]
    docs = drop_columns(docs, *[n for n, _ in more])
    names = [*docs.columns, *[n for n, _ in more]]
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = coder(path, pattern)
        for batch in batches:
            sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(place)), 0))
            at = 0
            while at < len(batch):
                fits = int(np.searchsorted(np.cumsum(sizes[at : at + ROWS]), CHARS, "right"))
                some = batch.slice(at, max(1, fits))
                at += len(some)
                coded = made.encode_all([t or "" for t in some.column(place).to_pylist()])
                decoded = map(made.decode, coded)
                if digests:
                    new = [pa.array([len(c) // 4 for c in coded], pa.int64()), pa.array([sha256(c).hexdigest() for c in coded], pa.string())]
                    new.append(pa.array([sha256(d).hexdigest() for d in decoded], pa.string()))
                else:
                    ends = pa.array(np.cumsum([0, *[len(c) // 4 for c in coded]]).astype(np.int32))
                    new = [pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(coded), "<i4"))), pa.array(list(decoded), pa.binary())]
                yield pa.RecordBatch.from_arrays([*some.columns, *new], names=names)

    return map_batches(docs, run, [T.StructField(n, t) for n, t in more])
