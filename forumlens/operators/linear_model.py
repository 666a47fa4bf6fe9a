"""A linear classifier as tables, scored by joins, and a certificate that a fit is the optimum of its penalised loss.

A model is `coefficients` (feature, class, coefficient; what is not there is zero) and `intercepts` (class, name, intercept; classes are
0, 1, ...). Terms are rows (id, feature, value). The tables have at most features x classes rows, as many numbers as a fitted model
holds on the driver, and as `transform` would send to every executor: that is the bound of what is broadcast here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LinearModel:
    coefficients: DataFrame
    intercepts: DataFrame

    def classes(self) -> list[tuple[int, str, float]]:
        """(class, name, intercept), in order."""
        return sorted(tuple(r) for r in self.intercepts.select("class", "name", "intercept").collect())


def from_fitted(spark: SparkSession, model: LogisticRegressionModel, names: list[str]) -> LinearModel:
    """A fitted model's tables. The binary one has coefficients for class 1 only; class 0 has zeros."""
    matrix, intercepts = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    if model.numClasses == 2 and len(intercepts) == 1:
        rows, first = matrix, 1
        starts = [0.0, float(intercepts[0])]
    else:
        rows, first = matrix, 0
        starts = [float(x) for x in intercepts]
    entries = [(int(f), first + c, float(row[f])) for c, row in enumerate(rows) for f in row.nonzero()[0]]
    names = [*names, *[None] * (len(starts) - len(names))]
    return LinearModel(
        spark.createDataFrame(entries, "feature int, class int, coefficient double"),
        spark.createDataFrame([(c, names[c], x) for c, x in enumerate(starts)], "class int, name string, intercept double"),
    )


def class_means(terms: DataFrame, labels: DataFrame) -> LinearModel:
    """The model whose coefficients are each class's mean values and whose intercepts are the logarithms of the classes' shares.

    `labels` has id and name; classes are numbered by name.
    """
    counts = labels.groupBy("name").agg(F.count("*").alias("rows")).orderBy("name").collect()  # as many as there are classes
    total = sum(r["rows"] for r in counts)
    spark = terms.sparkSession
    known = spark.createDataFrame([(c, r["name"], r["rows"]) for c, r in enumerate(counts)], "class int, name string, rows long")
    named = labels.join(F.broadcast(known), "name").select("id", "class", "rows")
    sums = terms.join(named, "id").groupBy("feature", "class", "rows").agg(F.sum("value").alias("total"))
    intercepts = known.select("class", "name", F.ln(F.col("rows") / F.lit(float(total))).alias("intercept"))
    return LinearModel(sums.select("feature", "class", (F.col("total") / F.col("rows")).alias("coefficient")), intercepts)


def vector_terms(df: DataFrame, id_column: str, vector: str) -> DataFrame:
    """(id, feature, value) of a vector column's entries that are not zero."""
    entries = df.select(F.col(id_column).alias("id"), F.posexplode(vector_to_array(vector)).alias("feature", "value"))
    return entries.filter("value <> 0")


def _by_feature(model: LinearModel, classes: int) -> DataFrame:
    """feature and the coefficients of all classes in one array."""
    each = [F.coalesce(F.sum(F.when(F.col("class") == c, F.col("coefficient"))), F.lit(0.0)) for c in range(classes)]
    return model.coefficients.groupBy("feature").agg(F.array(*each).alias("weights"))


def probabilities(model: LinearModel, terms: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, margins, probabilities) for each row of `ids`; a row without terms has the intercepts alone.

    Terms meet the coefficients by broadcast and are summed before the shuffle, which moves a row for each id and task.
    """
    starts = [x for _, _, x in model.classes()]
    k = len(starts)
    met = terms.join(F.broadcast(_by_feature(model, k)), "feature")
    sums = met.groupBy("id").agg(F.array(*[F.sum(F.col("value") * F.get("weights", F.lit(c))) for c in range(k)]).alias("sums"))
    margins = F.array(*[F.coalesce(F.get("sums", F.lit(c)), F.lit(0.0)) + F.lit(x) for c, x in enumerate(starts)])
    found = ids.select("id").join(sums, "id", "left").select("id", margins.alias("margins"))
    found = found.withColumn("most", F.array_max("margins")).withColumn("weights", F.transform("margins", lambda m: F.exp(m - F.col("most"))))
    found = found.withColumn("total", F.aggregate("weights", F.lit(0.0), lambda a, w: a + w))
    return found.select("id", "margins", F.transform("weights", lambda w: w / F.col("total")).alias("probabilities"))


def _names(model: LinearModel) -> Column:
    return F.array(*[F.lit(name) for _, name, _ in model.classes()])


def scored_classes(model: LinearModel, scored: DataFrame) -> DataFrame:
    """(id, name, probability): a row for each class."""
    rows = scored.select("id", F.posexplode("probabilities").alias("class", "probability"))
    return rows.select("id", F.get(_names(model), F.col("class")).alias("name"), "probability")


def ranked_classes(model: LinearModel, scored: DataFrame, n: int = 3) -> DataFrame:
    """(id, rank, name, probability) of the n most probable classes, ranked inside the row; the lower class first on ties."""
    candidates = F.transform("probabilities", lambda p, i: F.struct((-p).alias("p"), i.alias("class")))
    best = F.slice(F.array_sort(candidates), 1, n)
    rows = scored.select("id", F.posexplode(best).alias("place", "hit"))
    return rows.select("id", (F.col("place") + 1).alias("rank"), F.get(_names(model), F.col("hit.class")).alias("name"), (-F.col("hit.p")).alias("probability"))


# The penalised loss: mean log loss + reg x (alpha |b| + (1 - alpha) / 2 b^2), with b = coefficient x standard deviation of the feature.


@dataclass(frozen=True)
class Penalty:
    reg_param: float
    elastic_net_param: float

    @property
    def l1(self) -> float:
        return self.reg_param * self.elastic_net_param

    @property
    def l2(self) -> float:
        return self.reg_param * (1 - self.elastic_net_param)


def feature_scales(terms: DataFrame, n: int) -> DataFrame:
    """(feature, scale): standard deviation over n rows, those without the feature counting as zero. Constant features go."""
    sums = terms.groupBy("feature").agg(F.sum("value").alias("s"), F.sum(F.col("value") * F.col("value")).alias("q"))
    variance = (F.col("q") - F.col("s") * F.col("s") / n) / max(n - 1, 1)
    return sums.select("feature", F.sqrt(F.greatest(variance, F.lit(0.0))).alias("scale")).filter("scale > 0")


def residuals(model: LinearModel, terms: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, log_loss, rest): the negative logarithm of the own class's probability, and probabilities less the own class.

    `labels` has id and class.
    """
    scored = probabilities(model, terms, labels).join(labels.select("id", "class"), "id")
    most = F.array_max("margins")
    total = F.aggregate(F.transform("margins", lambda m: F.exp(m - most)), F.lit(0.0), lambda a, w: a + w)
    log_loss = F.ln(total) + most - F.get("margins", F.col("class"))  # finite also where a probability is 0
    rest = F.transform("probabilities", lambda p, c: p - F.when(c == F.col("class"), 1.0).otherwise(0.0))
    return scored.select("id", log_loss.alias("log_loss"), rest.alias("rest"))


def penalised_loss(model: LinearModel, terms: DataFrame, labels: DataFrame, penalty: Penalty) -> DataFrame:
    """One row: rows, mean log_loss, penalty and loss (their sum)."""
    mean = residuals(model, terms, labels).agg(F.count("*").alias("rows"), F.avg("log_loss").alias("log_loss"))
    scaled = model.coefficients.join(feature_scales(terms, labels.count()), "feature").withColumn("b", F.col("coefficient") * F.col("scale"))
    costs = scaled.agg(F.coalesce(F.sum(penalty.l1 * F.abs("b") + penalty.l2 / 2 * F.col("b") * F.col("b")), F.lit(0.0)).alias("penalty"))
    return mean.withColumn("penalty", costs.scalar()).withColumn("loss", F.col("log_loss") + F.col("penalty"))


def loss_gradient(model: LinearModel, terms: DataFrame, labels: DataFrame, penalty: Penalty) -> DataFrame:
    """(feature, class, coefficient, gradient): of the smooth part of the loss (all but the absolute values), by the scaled coefficient;
    intercepts have feature -1.

    Residuals are one row for each id; they meet the terms on the id and are summed by feature before the shuffle.
    """
    k, n = len(model.classes()), labels.count()
    left = residuals(model, terms, labels)
    sums = lambda value: F.array(*[F.sum(value * F.get("rest", F.lit(c))) / n for c in range(k)])
    by_feature = terms.join(left, "id").groupBy("feature").agg(sums(F.col("value")).alias("g"))
    rows = by_feature.join(F.broadcast(_by_feature(model, k)), "feature", "left").join(feature_scales(terms, n), "feature")
    rows = rows.select("feature", "scale", F.posexplode("g").alias("class", "g"), "weights")
    coefficient = F.coalesce(F.get("weights", F.col("class")), F.lit(0.0))
    rows = rows.select("feature", "class", coefficient.alias("coefficient"), (F.col("g") / F.col("scale") + penalty.l2 * coefficient * F.col("scale")).alias("gradient"))
    starts = left.agg(sums(F.lit(1.0)).alias("g")).select(F.posexplode("g").alias("class", "gradient"))
    starts = starts.join(F.broadcast(model.intercepts), "class").select(F.lit(-1).alias("feature"), "class", F.col("intercept").alias("coefficient"), "gradient")
    return rows.unionByName(starts)


def optimality_gaps(gradient: DataFrame, penalty: Penalty) -> DataFrame:
    """`gradient` with `gap`: how far zero is from the loss's subgradients at each coefficient; at the optimum all gaps are 0."""
    g, b, l1 = F.col("gradient"), F.col("coefficient"), penalty.l1
    gap = F.when(F.col("feature") < 0, F.abs(g)).when(b == 0, F.greatest(F.abs(g) - l1, F.lit(0.0))).otherwise(F.abs(g + l1 * F.signum(b)))
    return gradient.withColumn("gap", gap)


def certificate(model: LinearModel, terms: DataFrame, labels: DataFrame, penalty: Penalty) -> DataFrame:
    """One row: coefficients looked at, those not zero, the largest and the mean gap. The binary model's class 0 is fixed."""
    gaps = optimality_gaps(loss_gradient(model, terms, labels, penalty), penalty)
    if len(model.classes()) == 2:
        gaps = gaps.filter("class = 1")
    return gaps.agg(
        F.count("*").alias("coefficients"),
        F.count(F.when(F.col("coefficient") != 0, 1)).alias("not_zero"),
        F.max("gap").alias("largest_gap"),
        F.avg("gap").alias("mean_gap"),
    )
