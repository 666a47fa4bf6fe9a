"""Toxicity by a classifier chain.

The categories are judged in order; each later linear model sees the probabilities of the earlier categories
beside the words. It is trained on out-of-fold probabilities, so it meets them as they will be on unseen texts.

The chain is fitted on at most `sample` labelled rows (those with the smallest hash of the doc_id), as the
bound is a parameter. Its words are those whose document counts differ most between the two sides of any
category; the counts are one grouped aggregation, of which the best `words` for each category reach the driver.
All documents are scored, whole. A category's threshold is the one with the best out-of-fold F1.

Defined cases: a null or empty text has no words and gets the base rate. A label row with a null in any category or
doc_id is not used; of several rows for a doc_id the largest values count. A category that has one value only is
constant. Without any usable label nothing is toxic (probability 0). Repeated and null doc_ids are scored row by
row. Input columns with the names of the new ones are replaced, others stay.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.llm.common import drop_columns, fresh
from forumlens.session import stored

CATEGORIES = ("quality", "toxic")
SAMPLE = 12_000
WORDS = 400
FOLDS = 3
SEED = 42
PENALTY = 2e-4
ROUNDS = 20
#: Tasks over the bounded sample; up to four sum a loss in one stage.
TASKS = 4
#: Fits whose jobs the driver runs side by side.
AT_ONCE = 2


def words_of(text: Column) -> Column:
    """The distinct words of a text, lower case (runs of letters and digits of any script), and their first four letters, marked ^."""
    words = F.array_distinct(F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != ""))
    starts = F.array_distinct(F.transform(F.filter(words, lambda w: F.length(w) > 4), lambda w: F.concat(F.lit("^"), F.substring(w, 1, 4))))
    return F.concat(words, starts)


def labelled_rows(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...], sample: int) -> DataFrame:
    """doc_id, words, fold and a 0/1 column for each category of at most `sample` labelled documents."""
    usable = labels.select(F.col("doc_id"), *[F.col(c).cast("int").alias(f"is_{k}") for k, c in enumerate(categories)]).dropna()
    rated = usable.groupBy("doc_id").agg(*[(F.max(f"is_{k}") > 0).cast("double").alias(f"is_{k}") for k in range(len(categories))])
    drawn = rated.orderBy(F.xxhash64(F.lit(SEED), "doc_id"), "doc_id").limit(sample)
    fold = F.pmod(F.xxhash64(F.lit(SEED + 1), "doc_id"), F.lit(FOLDS)).cast("int")
    texts = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    # at most `sample` rows of a few numbers
    return stored(texts.join(F.broadcast(drawn), "doc_id").withColumn("fold", fold).repartition(TASKS, "doc_id"), "labelled")


def telling_words(rows: DataFrame, n_categories: int, words: int) -> list[str]:
    """For each category the words with the largest chi-square between word and category."""
    sides = rows.agg(F.count("*"), *[F.sum(f"is_{k}") for k in range(n_categories)]).first()
    total = float(sides[0])
    counted = rows.select(F.explode("words").alias("word"), *[f"is_{k}" for k in range(n_categories)])
    counted = stored(counted.groupBy("word").agg(F.count("*").alias("n"), *[F.sum(f"is_{k}").alias(f"n_{k}") for k in range(n_categories)]).filter("n >= 2"), "words")
    chosen = set()
    for k in range(n_categories):
        rate = (sides[k + 1] or 0.0) / max(total, 1.0)
        gap = F.col(f"n_{k}") - F.col("n") * rate
        score = gap * gap / (F.col("n") * F.greatest(F.lit(1.0), total - F.col("n")))
        chosen |= {r[0] for r in counted.orderBy(score.desc(), "word").limit(words).collect()}
    return sorted(chosen)


class Constant:
    """The model of a category with one value."""

    def __init__(self, value: float):
        self.value = value


def fit(rows: DataFrame, features: str, label: str) -> LogisticRegressionModel | Constant:
    n, positive = rows.agg(F.count("*"), F.sum(label)).first()
    if not positive or positive == n:
        return Constant(1.0 if positive else 0.0)
    learner = LogisticRegression(featuresCol=features, labelCol=label, regParam=PENALTY, elasticNetParam=1.0, standardization=False, maxIter=ROUNDS, maxBlockSizeInMB=8.0)
    return learner.fit(rows)


def side_by_side(rows: DataFrame, tasks: list[Callable[[], object]]) -> list:
    """The results of fits on the sample, each of which is a chain of jobs too small to fill a cluster; the driver holds few at once."""
    with ThreadPool(min(AT_ONCE, len(tasks))) as pool:
        return pool.map(lambda task: task(), [inheritable_thread_target(rows.sparkSession)(t) for t in tasks])


def probability(df: DataFrame, model: LogisticRegressionModel | Constant, features: str, name: str) -> DataFrame:
    if isinstance(model, Constant):
        return df.withColumn(name, F.lit(model.value))
    own = {c: fresh(f"{c}_of_{name}", df.columns) for c in ("raw", "probability", "prediction")}
    model = model.copy().setFeaturesCol(features).setRawPredictionCol(own["raw"]).setProbabilityCol(own["probability"]).setPredictionCol(own["prediction"])
    return model.transform(df).withColumn(name, vector_to_array(own["probability"])[1]).drop(*own.values())


class Chain:
    def __init__(self, vocabulary: list[str], models: list, thresholds: list[float]):
        self.vocabulary, self.models, self.thresholds = vocabulary, models, thresholds

    def score(self, df: DataFrame, words: str, names: list[str]) -> DataFrame:
        """`df` with the probability of each category; `words` is the column of distinct words."""
        if not self.vocabulary:
            return df.withColumns({n: F.lit(m.value) for n, m in zip(names, self.models)})
        bag = fresh("bag", [*df.columns, *names])
        df = counter(self.vocabulary, words, bag).transform(df)
        for k, (model, name) in enumerate(zip(self.models, names)):
            seen = fresh("seen", [*df.columns, *names])
            df = VectorAssembler(inputCols=[bag, *names[:k]], outputCol=seen).transform(df)
            df = probability(df, model, seen, name).drop(seen)
        return df.drop(bag)


def counter(vocabulary: list[str], words: str, out: str) -> CountVectorizerModel:
    return CountVectorizerModel.from_vocabulary(vocabulary, inputCol=words, outputCol=out, binary=True)


def best_threshold(rows: DataFrame, score: str, label: str) -> float:
    """The threshold, in steps of 0.01, with the best F1."""
    step = F.floor(F.col(score) * 100).cast("int").alias("step")
    counts = {r[0]: (r[1], r[2]) for r in rows.groupBy(step).agg(F.sum(label), F.count("*")).collect()}
    positive = sum(c[0] for c in counts.values())
    found, best, hit, named = 0.5, 0.0, 0.0, 0
    for s in range(100, 0, -1):
        h, n = counts.get(s, (0.0, 0))
        hit, named = hit + h, named + n
        f1 = 2 * hit / (named + positive) if named else 0.0
        if f1 > best:
            best, found = f1, s / 100
    return found


def fit_chain(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...] = CATEGORIES, sample: int = SAMPLE, words: int = WORDS) -> Chain:
    rows = labelled_rows(docs, labels, categories, sample)
    n = len(categories)
    vocabulary = telling_words(rows, n, words)
    if not vocabulary:
        return Chain([], [Constant(0.0)] * n, [0.5] * n)
    rows = counter(vocabulary, "words", "bag").transform(rows).drop("words")
    models, thresholds = [], []
    for k in range(n):
        rows = VectorAssembler(inputCols=["bag", *[f"p_{j}" for j in range(k)]], outputCol="seen").transform(rows)
        rows = stored(rows.coalesce(TASKS), "folds")
        sides = [rows, *[rows.filter(F.col("fold") != fold) for fold in range(FOLDS)]]
        whole, *others = side_by_side(rows, [partial(fit, side, "seen", f"is_{k}") for side in sides])
        models.append(whole)
        # each part by the model that has not seen it
        parts = [probability(rows.filter(F.col("fold") == fold), other, "seen", f"p_{k}") for fold, other in enumerate(others)]
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        rows = rows.drop("seen")
        thresholds.append(best_threshold(rows, f"p_{k}", f"is_{k}"))
    return Chain(vocabulary, models, thresholds)


def judge(docs: DataFrame, labels: DataFrame, categories: tuple[str, ...] = CATEGORIES, sample: int = SAMPLE) -> DataFrame:
    """`docs` with p_<category>, is_<category> for each category."""
    names = [f"p_{c}" for c in categories]
    docs = drop_columns(docs, *names, *[f"is_{c}" for c in categories])
    chain = fit_chain(docs, labels, categories, sample)
    words = fresh("words", [*docs.columns, *names])
    scored = chain.score(docs.withColumn(words, words_of(F.col("text"))), words, names).drop(words)
    return scored.withColumns({f"is_{c}": F.col(f"p_{c}") >= t for c, t in zip(categories, chain.thresholds)})
