"""SimHash near-duplicates by vantage-point trees.

Fingerprints that differ in at most r bits agree wholly on one of r + 1 blocks of bits (or on `agree`
of r + `agree` blocks). For each choice of blocks there is one vantage-point tree in the Hamming metric
of these bits: a node has a vantage point and a radius; a fingerprint goes to the inner side when it is
nearer than the radius and to the outer side when it is at least the radius less the search distance
away. By the triangle inequality no near pair is parted, and on chosen blocks the search distance is 0,
so no side gets copies. The top of a tree is built on a bounded sample; all fingerprints are routed
through it to shards. Each shard goes on with a local tree, first on its blocks, then on all
bits with overlapping sides, and compares what is left exactly.

Equal fingerprints are one point, so copies cost nothing. A shard returns a spanning forest of its near
pairs, never the pairs; the forests are joined by `components`.

Defined cases: null and empty texts have no words and the fingerprint zero, which links like any other.
A null doc_id is never a component_id unless no document of the component has another. Rows are judged
one by one: repeated doc_ids stay. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumlens.llm.components import components
from forumlens.session import stored

SHINGLE = 4
DISTANCE = 4
SEED = 42
#: Fingerprints that a tree's top is built on, and that a shard should hold.
SAMPLE = 16_384
SHARD = 16_384
#: Fingerprints that are compared without another split.
LEAF = 256
ALL = np.uint64(2**64 - 1)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of the word shingles of a text; 0 without words."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    n = len(words) - shingle + 1
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:n].tolist(), (ends[shingle - 1 :] - 1).tolist())
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 65536):
        rows = hashes[at : at + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id and the fingerprint, as a signed long, of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            prints = np.fromiter((fingerprint(t.as_py() or b"", shingle) for t in texts), np.uint64, len(batch))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "print"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, print long")


def bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).astype(np.int16)


def choices(distance: int, agree: int) -> list[np.uint64]:
    """Masks of `agree` blocks out of `distance` + `agree`, one of which near fingerprints share."""
    blocks = np.array_split(np.arange(64), distance + agree)
    return [np.uint64(sum(1 << int(b) for k in some for b in blocks[k])) for some in combinations(range(len(blocks)), agree)]


def split(points: np.ndarray, mask: np.uint64, reach: int) -> tuple[np.uint64, int, np.ndarray, np.ndarray] | None:
    """Vantage point, radius and the two sides with least overlap and best balance, or None if no split helps."""
    few = points[:: max(1, len(points) // 512)][:512]
    best, found = 0.9 * len(few), None
    for vantage in few[:: max(1, len(few) // 24)]:
        far = np.sort(bits((few ^ vantage) & mask))
        for radius in range(max(1, int(far[0]) + 1), int(far[-1]) + 1):
            inner = np.searchsorted(far, radius)
            outer = len(far) - np.searchsorted(far, radius - reach)
            if max(inner, outer) < best:
                best, found = max(inner, outer), (vantage, radius)
    if found is None:
        return None
    vantage, radius = found
    far = bits((points ^ vantage) & mask)
    return vantage, radius, np.flatnonzero(far < radius), np.flatnonzero(far >= radius - reach)


class VantageTree:
    """The top of a tree, from a sample. `nodes` has (vantage, radius, inner, outer); below 0 is the leaf ~n."""

    def __init__(self, sample: np.ndarray, mask: np.uint64, total: int, shard: int = SHARD, reach: int = 0):
        self.mask, self.reach, self.leaves = mask, reach, 0
        self.nodes: list[tuple[np.uint64, int, int, int] | None] = []
        least = max(32, shard * len(sample) // max(total, 1))
        self.root = self.grow(sample, least)

    def grow(self, points: np.ndarray, least: int) -> int:
        found = split(points, self.mask, self.reach) if len(points) > least else None
        if found is None:
            self.leaves += 1
            return ~(self.leaves - 1)
        vantage, radius, inner, outer = found
        at = len(self.nodes)
        self.nodes.append(None)
        self.nodes[at] = (vantage, radius, self.grow(points[inner], least), self.grow(points[outer], least))
        return at

    def route(self, points: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, indices of the points that it gets)."""
        todo = [(self.root, np.arange(len(points)))]
        while todo:
            at, some = todo.pop()
            if not len(some):
                continue
            if at < 0:
                yield ~at, some
                continue
            vantage, radius, inner, outer = self.nodes[at]
            far = bits((points[some] ^ vantage) & self.mask)
            todo += [(inner, some[far < radius]), (outer, some[far >= radius - self.reach])]


class Forest:
    """Labels that merge: a point's label is the smallest point that it is joined with."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while True:
            x, y = label[a], label[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = label[label]
                if (up == label).all():
                    break
                label[:] = up


def near_links(points: np.ndarray, mask: np.uint64, distance: int = DISTANCE, leaf: int = LEAF) -> np.ndarray:
    """For distinct fingerprints, the index of the representative that each is joined with.

    Joined are those that a chain of pairs links which differ in `distance` bits at most and agree on `mask`.
    """
    forest = Forest(len(points))
    todo = [(np.arange(len(points)), mask, 0)]
    while todo:
        some, bits_of, reach = todo.pop()
        if len(some) < 2:
            continue
        if len(some) > leaf:
            found = split(points[some], bits_of, reach)
            if found is not None:
                todo += [(some[found[2]], bits_of, reach), (some[found[3]], bits_of, reach)]
                continue
            if bits_of != ALL:
                todo.append((some, ALL, distance))
                continue
        block = max(1, (1 << 20) // len(some))
        for at in range(0, len(some), block):
            rows = points[some[at : at + block], None] ^ points[None, some[at:]]
            i, j = np.nonzero(np.bitwise_count(rows) <= distance)
            ahead = j > i
            forest.join(some[at + i[ahead]], some[at + j[ahead]])
    return forest.label


def near_edges(prints: DataFrame, distance: int = DISTANCE, sample: int = SAMPLE, shard: int = SHARD) -> DataFrame:
    """(a, b): spanning forests, tree by tree and shard by shard, of the near pairs of the distinct longs `print`."""
    total = prints.count()
    agree = 1
    while total >> (64 * agree // (distance + agree)) > shard and agree < 4:
        agree += 1
    some = prints.orderBy(F.xxhash64("print"), "print").limit(sample).collect()
    drawn = np.array([r[0] for r in some], np.int64).view(np.uint64)
    trees = [VantageTree(drawn, mask, total, shard) for mask in choices(distance, agree)]
    firsts = np.cumsum([0, *[t.leaves for t in trees]])
    masks = [t.mask for t in trees]

    def route(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            points = frame["print"].to_numpy().view(np.uint64)
            for first, tree in zip(firsts, trees):
                for leaf, found in tree.route(points):
                    yield pd.DataFrame({"shard": first + leaf, "print": points[found].view(np.int64)})

    def link(frame: pd.DataFrame) -> pd.DataFrame:
        mask = masks[int(np.searchsorted(firsts, frame["shard"].iloc[0], "right")) - 1]
        points = np.unique(frame["print"].to_numpy()).view(np.uint64)
        root = near_links(points, mask, distance)
        moved = np.flatnonzero(root != np.arange(len(points)))
        return pd.DataFrame({"a": points[moved].view(np.int64), "b": points[root[moved]].view(np.int64)})

    routed = prints.select("print").mapInPandas(route, "shard long, print long")
    return routed.groupBy("shard").applyInPandas(link, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id reachable) of each row."""
    marked = stored(fingerprints(docs, shingle), "prints")
    points = stored(marked.groupBy("print").agg(F.min("doc_id").alias("first")), "points")
    roots = components(near_edges(points, distance)).select(F.col("node").alias("print"), "root")
    rooted = points.join(roots, "print", "left").withColumn("root", F.coalesce("root", "print"))
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "root").select("print", "component_id")
    hexed = F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint")
    return marked.join(named, "print").select("doc_id", hexed, "component_id")


def first_of_each(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """The rows of `docs` without near-duplicates: of a component, the rows of its smallest doc_id stay.

    Of several rows with that doc_id one stays. Rows without doc_id are not judged and stay.
    """
    return first_of_components(docs, near_duplicates(docs.filter(F.col("doc_id").isNotNull()), shingle, distance))


def first_of_components(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The same for components that are known: `found` has doc_id and component_id."""
    others = found.groupBy("doc_id").agg(F.min("component_id").alias("to")).filter("doc_id <> to").select("doc_id")
    repeated = found.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    kept = docs.join(others, "doc_id", "left_anti")
    alone = kept.join(repeated, "doc_id", "left_anti")
    values = [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]
    one = kept.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(F.struct(*values), F.xxhash64(*values)).alias("row"))
    return alone.select(*values).unionByName(one.select("row.*"))
