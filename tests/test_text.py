import re
import string

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from forumlens.functions import text
from forumlens.functions.stopwords import ENGLISH_STOPWORDS
from forumlens.operators.features import clean_corpus, question_words

ALPHABET = "ab<>/\n\r .,'’ \u0085 \x1c&;y" + "the is don"
TEXTS = st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=1, max_size=60)


def mapped(spark, values, expression):
    df = spark.createDataFrame(list(enumerate(values)), "i int, t string")
    rows = df.select("i", expression(F.col("t")).alias("r")).collect()
    return [row["r"] for row in sorted(rows, key=lambda row: row["i"])]


@settings(max_examples=8, deadline=None)
@given(TEXTS)
def test_steps_equal_plain_python(spark, values):
    assert mapped(spark, values, text.strip_html) == [re.sub("<.*?>", "", v) for v in values]
    drop = str.maketrans("", "", string.punctuation)
    assert mapped(spark, values, text.strip_punctuation) == [v.translate(drop) for v in values]
    assert mapped(spark, values, text.split_words) == [v.split() for v in values]
    kept = [" ".join(w for w in v.split() if w not in ENGLISH_STOPWORDS) for v in values]
    assert mapped(spark, values, text.remove_stopwords) == kept
    composed = mapped(spark, values, lambda c: text.clean_words(c, html=True))
    assert composed == [
        [
            w
            for w in re.sub("<.*?>", "", v.lower()).translate(drop).split()
            if w not in ENGLISH_STOPWORDS
        ]
        for v in values
    ]


@settings(max_examples=5, deadline=None)
@given(TEXTS)
def test_steps_change_nothing_the_second_time(spark, values):
    for step in (text.strip_punctuation, text.remove_stopwords):
        once = mapped(spark, values, step)
        assert mapped(spark, once, step) == once


def test_whitespace_constants_agree(spark):
    assert sorted(text.WHITESPACE) == [chr(i) for i in range(0x110000) if chr(i).isspace()]
    every = "".join(f"a{c}" for c in text.WHITESPACE)
    assert mapped(spark, [every], text.split_words) == [["a"] * len(text.WHITESPACE)]


def test_stopwords_are_sparks(spark):
    assert ENGLISH_STOPWORDS == StopWordsRemover.loadDefaultStopWords("english")


def test_documented_cases(spark):
    assert mapped(spark, ["<p>a</p><p>b</p>"], text.strip_html) == ["ab"]
    assert mapped(spark, ["<p>a</p><p>b</p>"], lambda c: text.strip_html(c, " ")) == [" a  b "]
    assert mapped(spark, ["a<b\nc>d"], text.strip_html) == ["a<b\nc>d"]
    assert mapped(spark, ["<script>x</script>a &amp; b"], text.strip_html) == ["xa &amp; b"]
    assert mapped(spark, ["i’j"], text.strip_punctuation) == ["i’j"]
    words = lambda **o: lambda c: text.clean_words(c, html=False, **o)
    assert mapped(spark, ["Don't go"], words()) == [["dont", "go"]]
    assert mapped(spark, ["Don't go"], words(stripped_stopwords=True)) == [["go"]]
    assert mapped(spark, [None, ""], words()) == [[], []]


def test_clean_corpus_joins_title_and_body_and_takes_null(spark):
    questions = spark.createDataFrame(
        [
            (1, "Running <b>", "<p>The connections</p> are running"),
            (2, None, "bodies"),
            (3, "Titles", None),
            (4, None, None),
            (5, "y" * 100, "x"),
        ],
        "id int, title string, body string",
    )
    got = {r["id"]: r["text"] for r in clean_corpus(questions).collect()}
    assert got == {1: "run b connect run", 2: "bodi", 3: "titl", 4: "", 5: "y" * 99 + "i x"}  # words of any length are stemmed
    plain = {r["id"]: r["words"] for r in question_words(questions, stemmed=False).collect()}
    assert plain[1] == ["running", "b", "connections", "running"]


@pytest.mark.parametrize("stemmed", [False, True])
def test_rows_of_one_id_stay_apart(spark, stemmed):
    rows = [(1, "first title", "alpha beta"), (1, "second title", "gamma delta"), (None, None, "x"), (None, "", None), (2, None, None)]
    cleaned = clean_corpus(spark.createDataFrame(rows, "id int, title string, body string"), stemmed=stemmed)
    title = "titl" if stemmed else "title"
    want = [(1, f"first {title} alpha beta"), (1, f"second {title} gamma delta"), (2, ""), (None, ""), (None, "x")]
    assert sorted((tuple(r) for r in cleaned.collect()), key=str) == sorted(want, key=str)
