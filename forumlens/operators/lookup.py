"""Join many rows to a table with one row per key, when some keys are very frequent.

`skew_safe_lookup` deals the rows of hot keys over several tasks; `frequent_apart_lookup` shuffles only those of rare keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fact rows of one key that a task may take; a key with more is dealt over several.
ROWS_PER_TASK = 1 << 20
#: There are at most so many hot keys, whatever the size: a key with fewer rows than this share is not hot.
HOT_SHARE = 10_000
#: Keys that are broadcast as the frequent ones: so many at most, whatever the size, and none longer than so many bytes.
FREQUENT_KEYS = 100_000
FREQUENT_KEY_BYTES = 256


def hot_keys(table: DataFrame, key: str, weight: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The keys with more rows than a task should take, and the number of tasks for them (`_salts`).

    At most HOT_SHARE keys, each with as many salts as it has times the rows of a task.
    """
    total = table.agg(F.sum(weight)).first()[0] or 0
    limit = max(rows_per_task, -(-int(total) // HOT_SHARE))
    return table.filter(F.col(weight) > limit).select(key, F.ceil(F.col(weight) / limit).cast("int").alias("_salts"))


def skew_safe_lookup(
    facts: DataFrame,
    table: DataFrame,
    key: str,
    weight: str,
    spread_by: Column,
    how: str = "inner",
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """`facts` joined to `table` on `key`; `weight` in the table is the key's number of fact rows.

    The fact rows of a hot key are dealt over its salts by `spread_by`, and its table row is repeated
    for each; rows without a key are dealt freely, since they meet nothing. What is broadcast are the
    hot keys, at most HOT_SHARE of them. `table` is read three times and should be a stored one.
    """
    hot = F.broadcast(hot_keys(table, key, weight, rows_per_task))
    dealt = F.xxhash64(spread_by)
    salt = F.when(F.col(key).isNull(), dealt).otherwise(F.coalesce(F.pmod(dealt, F.col("_salts")), F.lit(0)))
    salted_facts = facts.join(hot, key, "left").withColumn("_salt", salt).drop("_salts")
    copies = F.sequence(F.lit(0).cast("bigint"), F.coalesce("_salts", F.lit(1)).cast("bigint") - 1)
    salted_table = table.join(hot, key, "left").withColumn("_salt", F.explode(copies)).drop("_salts")
    return salted_facts.join(salted_table, [key, "_salt"], how).drop("_salt")


def _level(weight: str) -> Column:
    """Weights in steps of an eighth of their power of two: some 500 levels at most."""
    return F.floor(F.log2(weight) * 8)


def frequent_keys(table: DataFrame, key: str, weight: str, most: int = FREQUENT_KEYS) -> tuple[Column, bool]:
    """Which rows of `table` hold its frequent keys, `most` at most, and whether there are others.

    They are those of the highest weights, cut between two levels; a key without a weight, or a long one, is none.
    """
    short = F.octet_length(F.col(key).cast("string")) <= FREQUENT_KEY_BYTES
    level = F.when(short, _level(weight))
    counts = table.groupBy(level.alias("level")).count().collect()
    cut, found, others = None, 0, any(r["level"] is None for r in counts)
    for r in sorted((r for r in counts if r["level"] is not None), key=lambda r: -r["level"]):
        found += r["count"]
        if found > most:
            others = True
            break
        cut = r["level"]
    return (F.coalesce(level >= cut, F.lit(False)) if cut is not None else F.lit(False)), others


def frequent_apart_lookup(
    facts: DataFrame, table: DataFrame, key: str, weight: str, spread_by: Column, most: int = FREQUENT_KEYS
) -> DataFrame:
    """`skew_safe_lookup` as an inner join that shuffles only the facts of rare keys; the rows of `table` are short.

    The table rows of the frequent keys are broadcast; of words in texts these keys have most of the facts. `facts` are read
    twice, once for the frequent keys and once for the others, so they should be stored ones, like `table`.
    """
    is_frequent, others = frequent_keys(table, key, weight, most)
    frequent = table.filter(is_frequent)
    near = facts.join(F.broadcast(frequent), key)
    if not others:
        return near
    far = facts.join(F.broadcast(frequent.select(key)), key, "left_anti")
    return near.unionByName(skew_safe_lookup(far, table.filter(~is_frequent), key, weight, spread_by))
