"""Sharding by a two-pass external shuffle.

Pass one scatters the records by a seeded hash into buckets that fit in memory (one Spark shuffle).
Pass two shuffles each bucket by Fisher-Yates and writes it. The buckets in order, each in its drawn
order, are a uniform permutation of all records; shards are equal slices of it, so their row counts
differ by one at most. Only one count per bucket reaches the driver.

Defined cases: a null text has no bytes and is a record like any other; null and repeated doc_ids are
records too. The bucket depends on doc_id and text, so the rows of a common id spread. Rows that are
equal in both share a bucket. Input columns called `shard` or `slot` are replaced. An empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumlens.llm.common import drop_columns, fresh, numbered, quoted, tasks_for, utf8_bytes
from forumlens.session import stored

SHARDS = 24
SEED = 42
BUCKET_BYTES = 16 << 20


def fisher_yates(n: int, rng: np.random.Generator) -> np.ndarray:
    """A uniform permutation of 0 .. n-1."""
    order = list(range(n))
    if n > 1:
        picks = rng.integers(0, np.arange(2, n + 1)).tolist()  # the pick for place i is from 0 .. i
        for i in range(n - 1, 0, -1):
            j = picks[i - 1]
            order[i], order[j] = order[j], order[i]
    return np.array(order, np.int64)


def place(position: np.ndarray, total: int, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Shard and slot of positions 0 .. total-1; the first total % shards shards have a row more."""
    small, more = divmod(total, shards)
    edge = more * (small + 1)
    late = (position - edge) // max(small, 1) + more
    shard = np.where(position < edge, position // (small + 1), late)
    start = shard * small + np.minimum(shard, more)
    return shard.astype(np.int32), position - start


def external_shuffle(
    docs: DataFrame, shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES, key: tuple[str, ...] = ("doc_id", "text")
) -> DataFrame:
    """All rows of `docs` with `shard` and `slot`, written in a folder per shard and read from there."""
    docs = drop_columns(docs, "shard", "slot")
    text = F.col("text")
    total = docs.agg(F.sum(utf8_bytes(text) + 8)).first()[0] or 0
    buckets = tasks_for(total, bucket_bytes)
    number, drawn = fresh("bucket", docs.columns), fresh("drawn", docs.columns)
    hashed = F.xxhash64(F.lit(seed), *[F.col(quoted(c)) for c in key])
    dealt = docs.withColumn(drawn, hashed).withColumn(number, F.pmod(F.col(drawn), F.lit(buckets)).cast("int"))
    counts = np.zeros(buckets + 1, np.int64)
    for b, n in dealt.groupBy(number).count().collect():
        counts[b + 1] = n
    starts = np.cumsum(counts)
    rows = int(starts[-1])
    fields = [*docs.schema.fields, T.StructField("shard", T.IntegerType()), T.StructField("slot", T.LongType())]
    kept = [f"c{i}" for i in range(len(docs.columns))]
    out = T.StructType([T.StructField(n, f.dataType) for n, f in zip([*kept, "shard", "slot"], fields)])
    drawn, number = f"c{len(kept)}", f"c{len(kept) + 1}"

    def shuffle_bucket(rows_of: pa.Table) -> pa.Table:
        bucket = rows_of.column(number)[0].as_py()
        # rows arrive in any order; a fixed one makes a second attempt draw the same
        first = np.argsort(rows_of.column(drawn).to_numpy(), kind="stable")
        order = first[fisher_yates(len(rows_of), np.random.default_rng([seed, bucket]))]
        shard, slot = place(starts[bucket] + np.arange(len(order)), rows, shards)
        return rows_of.select(kept).take(pa.array(order)).append_column("shard", pa.array(shard)).append_column("slot", pa.array(slot))

    shuffled = numbered(dealt).repartition(buckets, number).groupBy(number).applyInArrow(shuffle_bucket, out).toDF(*[f.name for f in fields])
    return stored(shuffled.sortWithinPartitions("shard", "slot"), "shards", "shard").select(*[quoted(f.name) for f in fields])
