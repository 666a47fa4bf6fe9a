"""Hashed term counts as a relation: the buckets of `pyspark.ml.feature.HashingTF`, as expressions over UTF-8 bytes.

HashingTF takes the 32-bit Murmur3 hash of a term, of its published form, which is not that of the SQL function `hash` for
lengths that are no multiple of four. The steps are bound one after the other in lambdas, so no expression is written out twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the published hash; the seed is HashingTF's.
SEED = 42
C1, C2 = 0xCC9E2D51, 0x1B873593
ADDED = 0xE6546B64
MIX1, MIX2 = 0x85EBCA6B, 0xC2B2AE35
WORD = 0xFFFFFFFF


def _times(x: Column, factor: int) -> Column:
    """Product of 32 bits, in halves that stay below 64."""
    low = x.bitwiseAND(F.lit(0xFFFF)) * factor
    high = (F.shiftrightunsigned(x, 16) * factor).bitwiseAND(F.lit(0xFFFF)) * 65536
    return (low + high).bitwiseAND(F.lit(WORD))


def _turned(x: Column, by: int) -> Column:
    return F.shiftleft(x, by).bitwiseOR(F.shiftrightunsigned(x, 32 - by)).bitwiseAND(F.lit(WORD))


def _each(values: Column, *steps: Callable[[Column], Column]) -> Column:
    for step in steps:
        values = F.transform(values, step)
    return values


def _mixed(blocks: Column) -> Column:
    return _each(blocks, lambda k: _times(k, C1), lambda k: _turned(k, 15), lambda k: _times(k, C2))


def _number(digits: Column, first: Column, n_bytes: int) -> Column:
    """Bytes from the digit `first` on (from 1), the lowest first; what stands beyond the end is zero."""
    pairs = [F.lpad(F.substr(digits, first + F.lit(2 * i), F.lit(2)), 2, "0") for i in range(n_bytes - 1, -1, -1)]
    return F.conv(F.concat(*pairs), 16, 10).cast("bigint")


def murmur3(word: Column) -> Column:
    """Signed 32-bit hash of a string's UTF-8 bytes."""
    digits, length = F.hex(F.encode(word, "UTF-8")), F.octet_length(word)
    whole = F.floor(length / 4).cast("int")
    at = F.when(whole > 0, F.sequence(F.lit(0), whole - 1)).otherwise(F.array().cast("array<int>"))
    blocks = _mixed(F.transform(at, lambda i: _number(digits, i * 8 + 1, 4)))
    tail = _mixed(F.array(F.when(length % 4 > 0, _number(digits, whole * 8 + 1, 3)).otherwise(F.lit(0).cast("bigint"))))
    state = F.aggregate(
        blocks,
        F.lit(SEED).cast("bigint"),
        lambda h, k: (_turned(h.bitwiseXOR(k), 13) * 5 + ADDED).bitwiseAND(F.lit(WORD)),
        lambda h: h.bitwiseXOR(F.get(tail, F.lit(0))).bitwiseXOR(length.cast("bigint")),
    )
    shifted = lambda by: lambda h: h.bitwiseXOR(F.shiftrightunsigned(h, by))
    steps = [shifted(16), lambda h: _times(h, MIX1), shifted(13), lambda h: _times(h, MIX2), shifted(16)]
    return F.get(_each(F.array(state), *steps, lambda h: F.when(h > 0x7FFFFFFF, h - 0x100000000).otherwise(h)), F.lit(0)).cast("int")


def bucket_of(word: Column, num_features: int) -> Column:
    return F.pmod(murmur3(word), F.lit(num_features))


def hashed_terms(df: DataFrame, id_column: str, words: Column, num_features: int = 1000) -> DataFrame:
    """(id, bucket, tf): HashingTF's vectors, an entry a row; null words are left out.

    Counted inside a text's own row, so nothing is shuffled. Texts have many words, so HashingTF itself hashes them; the
    expression above, many times slower, is for tables with a row for each distinct word.
    """
    listed = F.array_compact(F.coalesce(words, F.array().cast("array<string>")))
    texts = df.select(F.col(id_column).alias("text_id"), listed.alias("listed"))
    vectors = HashingTF(inputCol="listed", outputCol="vector", numFeatures=num_features).transform(texts)
    entries = vectors.select("text_id", F.unwrap_udt("vector").alias("v")).select("text_id", F.inline(F.arrays_zip("v.indices", "v.values")))
    return entries.toDF(id_column, "bucket", "n").select(id_column, "bucket", F.col("n").cast("bigint").alias("tf"))


def bucket_collisions(vocabulary: DataFrame, num_features: int = 1000) -> DataFrame:
    """For each bucket its words, their occurrences, and those of its most frequent word: what the hash mixes with it.

    `vocabulary` has word and total_count; a word is hashed once.
    """
    placed = vocabulary.select(bucket_of(F.col("word"), num_features).alias("bucket"), "total_count")
    return placed.groupBy("bucket").agg(
        F.count("*").alias("words"), F.sum("total_count").alias("total_count"), F.max("total_count").alias("largest")
    )
