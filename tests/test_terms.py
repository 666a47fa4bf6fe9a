import math
from collections import Counter

from pyspark.sql import functions as F

from forumlens.operators import lookup, terms
from forumlens.session import spread, stored

TEXTS = {1: "a b a c", 2: "a", 3: "", 4: "b b b", 5: None}


def frame(spark):
    return spark.createDataFrame(list(TEXTS.items()), "id int, t string")


def counted(spark):
    return terms.term_counts(frame(spark), "id", F.split(F.nullif(F.col("t"), F.lit("")), " "))


def test_term_counts(spark):
    got = {(r["id"], r["word"]): r["n"] for r in counted(spark).collect()}
    want = {(i, w): n for i, t in TEXTS.items() for w, n in Counter((t or "").split()).items()}
    assert got == want


def test_vocabulary_and_weights(spark):
    vocabulary = {r["word"]: (r["total_count"], r["doc_count"]) for r in terms.vocabulary(counted(spark)).collect()}
    assert vocabulary == {"a": (3, 2), "b": (4, 2), "c": (1, 1)}
    weights = {(r["id"], r["word"]): r["tf_idf"] for r in terms.tf_idf(counted(spark), frame(spark), "id").collect()}
    assert math.isclose(weights[(1, "a")], 2 * math.log(6 / 3))
    assert math.isclose(weights[(4, "b")], 3 * math.log(6 / 3))
    assert math.isclose(weights[(1, "c")], math.log(6 / 2))


def test_lookup_with_a_hot_key_equals_a_plain_join(spark):
    facts = spark.range(30000).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 1000 != 1, F.concat(F.lit("w"), F.col("id"))).alias("word")
    )
    table = facts.filter("word is not null").groupBy("word").agg(F.count("*").alias("n")).withColumn("value", F.length("word"))
    assert [tuple(r) for r in lookup.hot_keys(table, "word", "n", 1000).collect()] == [("hot", 10)]
    assert lookup.hot_keys(table, "word", "n").count() == 0
    for how, rows in (("inner", 1000), ("left", 1000), ("left", 1 << 20)):
        plain = facts.join(table, "word", how).agg(F.count("*"), F.sum("value"), F.sum("id")).first()
        safe = lookup.skew_safe_lookup(facts, table, "word", "n", F.col("id"), how, rows)
        assert safe.agg(F.count("*"), F.sum("value"), F.sum("id")).first() == plain
    safe = lookup.skew_safe_lookup(facts, table, "word", "n", F.col("id"))
    assert safe.columns == ["word", "id", "n", "value"]


def test_small_scans_are_spread_and_wide_ones_left_alone(spark):
    narrow = spark.range(100, numPartitions=1)
    wide = spark.range(100, numPartitions=64)
    assert spread(narrow, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert spread(wide, "id") is wide


def test_words_are_counted_text_by_text(spark, monkeypatch):
    """Across the pieces that are counted at a time, with repeated ids, null words and null arrays."""
    monkeypatch.setattr(terms, "CHUNK_WORDS", 5)
    texts = [(i % 4, [f"w{(i * k) % 7}" for k in range(i)]) for i in range(12)]
    texts += [(None, ["a", "a"]), (4, [None, "a", None, "a", "b"]), (5, []), (6, None)]
    df = spark.createDataFrame(texts, "id int, words array<string>").coalesce(1)
    got = Counter(tuple(r) for r in terms.term_counts(df, "id", F.col("words")).collect())
    assert got == Counter((i, w, n) for i, words in texts for w, n in Counter(words or []).items())


def test_only_facts_of_rare_keys_are_shuffled(spark):
    hot = F.concat(F.lit("hot"), F.col("id") % 5)
    long = F.concat(F.repeat(F.lit("x"), 300), F.col("id") % 8)
    word = F.when(F.col("id") % 3 == 0, hot).when(F.col("id") % 4 == 0, long).when(F.col("id") % 100 != 1, F.concat(F.lit("w"), F.col("id") % 9000))
    facts = stored(spark.range(30000).select("id", word.alias("word")), "facts")
    table = stored(facts.filter("word is not null and word <> 'w7'").groupBy("word").agg(F.count("*").alias("n")), "table")
    plain = sorted(tuple(r) for r in facts.join(table, "word").collect())
    for most, frequent, others in ((10, 5, True), (4, 0, True), (1 << 20, table.count() - 2, True)):
        is_frequent, more = lookup.frequent_keys(table, "word", "n", most)
        assert (table.filter(is_frequent).count(), more) == (frequent, others)
        found = lookup.frequent_apart_lookup(facts, table, "word", "n", F.col("id"), most)
        assert found.columns == ["word", "id", "n"]
        assert sorted(tuple(r) for r in found.collect()) == plain
    none = table.filter("n < 0")
    assert lookup.frequent_apart_lookup(facts, none, "word", "n", F.col("id")).count() == 0


def test_terms_of_frequent_words_meet_their_weights_without_a_shuffle(spark):
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        weights = terms.tf_idf(counted(spark), frame(spark), "id")
        assert len(weights.collect()) == 5
        plan = weights._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(limit, before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan
