"""How long stored tables live."""

import os
from multiprocessing.pool import ThreadPool
from urllib.parse import urlsplit

import pytest
from pyspark.sql import functions as F

from forumlens.operators.terms import tf_idf
from forumlens.session import DROP_SHUFFLES, lifetimes, scratch_removed, shared_folder, stored, tables_read


@pytest.fixture
def folders(spark):
    """The stored tables that are there now and were not before."""
    place = urlsplit(shared_folder(spark)).path
    before = set(os.listdir(place))
    return lambda: sorted(name.rsplit("-", 1)[0] for name in set(os.listdir(place)) - before)


def numbers(spark, n=10):
    return spark.range(n).withColumn("k", F.col("id") % 3)


def test_a_loop_of_rounds_holds_two_tables(spark, folders):
    with lifetimes(spark) as scope:
        base = stored(numbers(spark), "base")
        now, seen = base, []
        for n in range(6):
            now = stored(now.join(base.select("id"), "id").withColumn("k", F.col("k") + 1), f"round{n}")
            scope.commit(base, now)
            seen.append(folders())
        assert seen == [["base", f"round{n}"] for n in range(6)]
        assert now.agg(F.sum("k")).first()[0] == base.agg(F.sum("k")).first()[0] + 60
    assert folders() == []


def test_readers_count_through_plans_and_subqueries(spark, folders):
    with lifetimes(spark) as scope:
        a, b, c = (stored(numbers(spark), name) for name in "abc")
        most = b.agg(F.max("id")).scalar()
        lazy = a.filter(F.col("id") < most).groupBy("k").count()
        assert len(tables_read(lazy)) == 2
        scope.commit(lazy)
        assert folders() == ["a", "b"]
        assert sum(r["count"] for r in lazy.collect()) == 9
        with pytest.raises(Exception, match="(?i)exist"):
            c.count()


def test_what_is_handed_over_lives_with_the_caller(spark, folders):
    def query():
        with lifetimes(spark) as scope:
            first = stored(numbers(spark), "first")
            second = stored(first.filter("k = 1"), "second")
            result = second.select("id")
            scope.hand_over(result)
            return result

    with lifetimes(spark):
        result = query()
        assert folders() == ["second"]
        assert sorted(r[0] for r in result.collect()) == [1, 4, 7]
    assert folders() == []


def test_tables_go_after_a_failure(spark, folders):
    with pytest.raises(ZeroDivisionError), lifetimes(spark):
        stored(numbers(spark), "lost")
        1 / 0
    with scratch_removed(spark):
        stored(numbers(spark), "job")
        assert folders() == ["job"]
    assert folders() == []


def test_a_lazy_operator_inside_a_scope(spark, folders):
    docs = spark.createDataFrame([(1,), (2,)], "id int")
    terms = spark.createDataFrame([(1, "a", 2), (2, "a", 1), (2, "b", 1)], "id int, word string, n long")
    with lifetimes(spark):
        weights = tf_idf(terms, docs, "id")
        assert folders() == ["idf", "terms"]
        assert weights.count() == 3
    assert folders() == []


def test_a_write_leaves_no_shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        files = manager.getAllFiles()
        return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}

    before = shuffles()
    stored(numbers(spark, 1000).repartition(4, "k").groupBy("id").count(), "counted")
    assert shuffles() <= before


def test_writes_side_by_side_restore_the_setting(spark):
    before = spark.conf.get(DROP_SHUFFLES, "false")
    with ThreadPool(4) as pool:
        counts = pool.map(lambda n: stored(numbers(spark, 100 + n).groupBy("k").count(), f"n{n}").count(), range(8))
    assert counts == [3] * 8 and spark.conf.get(DROP_SHUFFLES, "false") == before
