from pyspark.sql import functions as F

from forumlens.functions.stemmer import english_stem
from forumlens.operators import stemming
from forumlens.operators.stemming import stem_words

# Word and stem, from the published sample vocabulary and the cases its rules name.
PAIRS = """
consign consign  consigned consign  consigning consign  consignment consign  consist consist
consisted consist  consistency consist  consistent consist  consistently consist
consolation consol  consolatory consolatori  consolidate consolid  consolidating consolid
consolingly consol  consonant conson  conspicuous conspicu  conspiracy conspiraci
conspirators conspir  constable constabl  constancy constanc  constant constant
knack knack  knackeries knackeri  knaves knave  knavish knavish  kneaded knead  kneeling kneel
knees knee  knell knell  knelt knelt  knif knif  knife knife  knightly knight  knights knight
knitted knit  knocker knocker  knockers knocker  knopp knopp  knots knot
skies sky  dying die  ties tie  cries cri  gas gas  this this  gaps gap  kiwis kiwi
hopping hop  hoping hope  generate generat  generally general  generic generic
communication communic  arsenal arsenal  relational relat  conditional condit  rational ration
say say  by by  cry cri  proceeded proceed  innings inning  happy happi  sky sky
agreed agre  feed feed  luxuriated luxuri  falling fall  filing file  formative format
electrical electr  adjustable adjust  adoption adopt  rate rate  controll control  roll roll
user’s user  yyyy yyyi  running run  beautifully beauti  analogies analog
"""
words = PAIRS.split()
CASES = list(zip(words[::2], words[1::2], strict=True))


def test_published_pairs(spark):
    df = spark.createDataFrame(CASES, "word string, want string")
    wrong = df.select("word", "want", english_stem(F.col("word")).alias("stem")).filter("stem <> want")
    assert wrong.collect() == []


def test_odd_words_pass_through(spark):
    odd = ["x2ing", "ab", "a", "", "naïvely2", "http://xs", "html5s"]
    df = spark.createDataFrame([(w,) for w in odd], "word string")
    assert [r[0] for r in df.select(english_stem(F.col("word"))).collect()] == odd


def test_length_and_digits_do_not_matter(spark):
    cases = [("b" + "a" * 37 + "ting", "b" + "a" * 37 + "t"), ("b" + "a" * 38 + "ting", "b" + "a" * 38 + "t")]
    cases += [("mp3players", "mp3player"), ("web2running", "web2run"), ("y" * 100, "y" * 99 + "i")]
    df = spark.createDataFrame(cases, "word string, want string")
    wrong = df.select("word", "want", english_stem(F.col("word")).alias("stem")).filter("stem <> want")
    assert wrong.collect() == []


def test_texts_keep_their_order_and_their_empty_rows(spark):
    rows = [(i, ["running"] * 50 + ["knaves", "ab", "running"]) for i in range(40)] + [(100, []), (101, None)]
    df = spark.createDataFrame(rows, "id int, words array<string>")
    got = {r["id"]: r["words"] for r in stem_words(df, "id", "words").collect()}
    assert got == {i: ["run"] * 50 + ["knave", "ab", "run"] for i in range(40)} | {100: [], 101: []}


def test_texts_share_a_dictionary(spark, monkeypatch):
    """The join takes the distinct words of a chunk of texts, not those of each text; a chunk of any size gives the same."""
    rows = [(i % 30, ["running", None, f"knaves{i % 3}"] * 20) for i in range(40)] + [(None, ["knees"]), (7, [None]), (7, None)]
    df = spark.createDataFrame(rows, "id int, words array<string>").coalesce(1)
    chunk = stemming._word_chunks(df, "id", "words").collect()
    assert len(chunk) == 1 and sorted(chunk[0]["dictionary"]) == ["knaves0", "knaves1", "knaves2", "knees", "running"]
    want = sorted(str((i, [{"running": "run", "knees": "knee"}.get(w, w) for w in words or [] if w])) for i, words in rows)
    for most in (1, 50, 1 << 18):
        monkeypatch.setattr(stemming, "CHUNK_WORDS", most)
        assert sorted(str((r["id"], r["words"])) for r in stem_words(df, "id", "words").collect()) == want
