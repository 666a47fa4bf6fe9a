from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from forumlens.operators import features, relations, selection
from forumlens.plans.queries import QUERIES
from forumlens.sources import sample_tables as sample

FOLDER = "/root/testdata/sf0.001"
MODELS = {"tag_model_metrics", "top3_tags", "tag_cv_grid", "answer_model_metrics", "answer_cv_grid"}

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


def values(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple("NULL" if row[i] is None else str(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in oracle_sql()])
def test_query_equals_sql(spark, db, name):
    got = queries()[name](spark, FOLDER)
    want = db.sql(oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert values(got.columns, map(tuple, got.collect())) == values(want.columns, want.fetchall())


def test_every_other_query_is_known_to_have_no_sql():
    assert set(QUERIES) - set(oracle_sql()) == MODELS
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).columns == ["tag", "count"]


def plan(df):
    return df._jdf.queryExecution().toString()


def test_cleaning_runs_no_python(spark):
    questions = sample.pages(spark, FOLDER).withColumnRenamed("page_id", "id")
    assert "Python" not in plan(features.clean_corpus(questions))


def test_texts_are_cleaned_once(spark):
    """After the words are stored, no job holds the cleaning expression again."""
    questions = sample.pages(spark, FOLDER).withColumnRenamed("page_id", "id")
    final = plan(features.clean_corpus(questions))
    assert "regexp_replace" not in final and "translate" not in final and "html" not in final


def test_joins_are_semi_and_anti(spark):
    posts, replies = sample.posts(spark, FOLDER), sample.replies(spark, FOLDER)
    assert "LeftSemi" in plan(relations.answered(posts, replies))
    assert "LeftAnti" in plan(relations.unanswered(posts, replies))
    tagged = sample.post_tags(spark, FOLDER)
    kept = plan(selection.keep_tags(tagged, selection.top_tags(tagged)))
    assert "LeftSemi" in kept and "TakeOrderedAndProject" in kept


def test_filter_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["answered_per_month"](spark, FOLDER))
    assert "EqualTo(l_returnflag,R)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in text


def test_term_counts_do_not_shuffle(spark):
    from forumlens.functions.text import split_words
    from forumlens.operators.terms import term_counts
    from pyspark.sql import functions as F

    documents = sample.table(spark, FOLDER, "documents")
    assert "Exchange" not in plan(term_counts(documents, "doc_id", split_words(F.col("text"))))
