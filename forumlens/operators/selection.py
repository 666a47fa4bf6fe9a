"""Score filter, frequent tags, and an exact first-k that never sorts the rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumlens.session import stored

DIGIT_BITS = 16


def score_filter(questions: DataFrame, threshold: int = 10) -> DataFrame:
    """Inclusive; a null score is dropped."""
    return questions.filter(F.col("score") >= threshold)


def tag_counts(tagged: DataFrame) -> DataFrame:
    return tagged.groupBy("tag").agg(F.count("*").alias("count"))


def top_tags(tagged: DataFrame, n: int = 10) -> DataFrame:
    """The n most frequent tags; equal counts in alphabetical order."""
    return tag_counts(tagged).orderBy(F.desc("count"), F.asc("tag")).limit(n)


def frequent_tags(tagged: DataFrame, at_least: int) -> DataFrame:
    return tag_counts(tagged).filter(F.col("count") >= at_least)


def keep_tags(tagged: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows whose tag is wanted; a null tag never is."""
    return tagged.join(wanted.select("tag"), "tag", "left_semi")


@dataclass(frozen=True)
class Cut:
    """The k-th smallest key, and how many rows lie below it and on it."""

    value: int
    below: int
    equal: int


def find_cut(df: DataFrame, key: Column, k: int) -> Cut:
    """Exact k-th smallest of a whole-number key, for 1 <= k <= number of rows.

    Counts rows per leading digits, picks the bucket that holds rank k and counts again inside
    it. A pass aggregates before its shuffle, leaves at most 2^17 buckets and brings one row
    to the driver; four passes cover 64 bits and a narrow range takes one.
    """
    keyed = df.select(key.cast("bigint").alias("key"))
    bounds = keyed.agg(F.min("key").alias("low"), F.max("key").alias("high")).first()
    low, high, below = bounds["low"], bounds["high"], 0
    while True:
        shift = 0
        while (high >> shift) - (low >> shift) >= 1 << DIGIT_BITS:
            shift += 1
        buckets = (
            keyed.filter(F.col("key").between(low, high))
            .groupBy(F.shiftright("key", shift).alias("bucket"))
            .agg(F.count("*").alias("n"))
        )
        running = F.sum("n").over(Window.orderBy("bucket"))
        hit = (
            buckets.withColumn("upto", running)
            .filter(F.col("upto") >= k - below)
            .orderBy("bucket")
            .limit(1)
            .first()
        )
        below += hit["upto"] - hit["n"]
        if shift == 0:
            return Cut(value=hit["bucket"], below=below, equal=hit["n"])
        low = max(low, hit["bucket"] << shift)
        high = min(high, ((hit["bucket"] + 1) << shift) - 1)


def first_k(df: DataFrame, k: int, *keys: Column) -> DataFrame:
    """The first k rows in ascending order of whole-number keys that hold no null.

    Finds the last row's keys and filters by them, so the rows themselves are never shuffled; the
    search reads a stored table of the keys. The keys together must tell the rows at the cut apart.
    """
    if k <= 0:
        return df.limit(0)
    narrow = stored(df.select(*(key.cast("bigint").alias(f"key{i}") for i, key in enumerate(keys))), "keys")
    if narrow.count() <= k:
        return df
    taken, tied, missing = F.lit(False), F.lit(True), k
    for i, key in enumerate(keys):
        cut = find_cut(narrow, F.col(f"key{i}"), missing)
        narrow = narrow.filter(F.col(f"key{i}") == cut.value)
        taken = taken | (tied & (key < cut.value))
        tied = tied & (key == cut.value)
        missing -= cut.below
        if cut.equal == missing:
            return df.filter(taken | tied)
    raise ValueError("the keys do not tell the rows at the cut apart")


def falling_score() -> Column:
    """Key for `first_k` that puts high scores first and a null score last."""
    return F.coalesce(-F.col("score").cast("bigint"), F.lit(1 << 40))


def highest_scores(df: DataFrame, k: int, id_column: str = "id") -> DataFrame:
    """k rows of highest score, equal scores by id."""
    return first_k(df, k, falling_score(), F.col(id_column).cast("bigint"))


def class_sizes(df: DataFrame, label: str = "label") -> dict[int, int]:
    """Sizes of the two classes 0 and 1; raises if one is missing."""
    counts = df.agg(
        F.count_if(F.col(label) == 0).alias("zeros"), F.count_if(F.col(label) == 1).alias("ones")
    ).first()
    sizes = {0: counts["zeros"], 1: counts["ones"]}
    if 0 in sizes.values():
        raise ValueError(f"both classes are needed, found {sizes}")
    return sizes


def balance_classes(df: DataFrame, *keys: Column, label: str = "label") -> DataFrame:
    """Both classes at the size of the smaller one, keeping the first rows by `keys`."""
    sizes = class_sizes(df, label)
    smaller = min(sizes.values())
    parts = [first_k(df.filter(F.col(label) == value), smaller, *keys) for value in sizes]
    return parts[0].unionByName(parts[1])
