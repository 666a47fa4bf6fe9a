"""What the two classifiers share: features fitted on the training side, fitting, cross validation."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.operators.features import fitted_stages, term_hashing
from forumlens.operators.joint_fits import Descent, joint_areas
from forumlens.operators.splitting import fold, is_train
from forumlens.plans.ledger import POINT, Fit, Ledger, grid_means
from forumlens.session import scratch_path, stored

FOLD = "fold"


@dataclass(frozen=True)
class Settings:
    num_features: int
    train_percent: int
    reg_param: float
    elastic_net_param: float
    max_iter: int = 10
    seed: int = 100


@dataclass(frozen=True)
class Grid:
    reg_param: tuple[float, ...]
    elastic_net_param: tuple[float, ...]
    max_iter: tuple[int, ...]


@dataclass(frozen=True)
class Prepared:
    """Stored features of both sides and the stages that made them.

    `held_out` has all rows of the test side, `test` those whose label the training side knows;
    `skipped_rows` is the number of the others.
    """

    stages: PipelineModel
    train: DataFrame
    test: DataFrame
    held_out: DataFrame
    skipped_rows: int


def prepare(rows: DataFrame, settings: Settings, index_tags: bool) -> Prepared:
    """Hash the words of `rows`, split by id, and fit the other stages on the training side only.

    The term vectors are stored in place of the words and the features after them, so the text
    is cleaned once and no iteration computes a feature.
    """
    hashing = term_hashing(settings.num_features)
    side = is_train("id", settings.train_percent, settings.seed)
    hashed = stored(hashing.transform(rows).drop("words").withColumn("is_train", side), "terms", "is_train")
    fitted = fitted_stages(index_tags).fit(hashed.filter("is_train"))
    label = F.col("label").cast("double").alias("label")
    features = stored(fitted.transform(hashed).select("id", "features", label, "is_train"), "features", "is_train")
    held_out = features.filter("not is_train")
    known = F.col("label") < len(fitted.stages[-1].labels) if index_tags else F.lit(True)
    return Prepared(
        stages=PipelineModel([hashing, *fitted.stages]),
        train=features.filter("is_train"),
        test=held_out.filter(known),
        held_out=held_out,
        skipped_rows=held_out.filter(~known).count(),
    )


def row_counts(prepared: Prepared) -> DataFrame:
    """One row: train_rows, test_rows and skipped_rows."""
    rows = prepared.train.agg(F.count("*").alias("train_rows")).withColumn("test_rows", F.lit(prepared.test.count()).cast("bigint"))
    return rows.withColumn("skipped_rows", F.lit(prepared.skipped_rows).cast("bigint"))


def estimator(settings: Settings) -> LogisticRegression:
    return LogisticRegression(
        maxIter=settings.max_iter, regParam=settings.reg_param, elasticNetParam=settings.elastic_net_param
    )


@dataclass(frozen=True)
class Validated:
    best: LogisticRegressionModel
    grid: DataFrame


def grid_fits(grid: Grid, folds: int) -> list[Fit]:
    """All fits of a grid, point by point, numbered in the order of the parameters."""
    points = product(grid.reg_param, grid.elastic_net_param, grid.max_iter)
    return [Fit(n, float(reg), float(net), int(rounds), fold) for n, (reg, net, rounds) in enumerate(points) for fold in range(folds)]


def open_ledger(train: DataFrame, settings: Settings, folds: int, path: str) -> Ledger:
    """The ledger at `path`; it raises when that belongs to other rows, settings or folds."""
    rows = train.agg(F.count("*").alias("n"), F.sum(F.xxhash64("id", "label").cast("decimal(38,0)")).alias("sum")).first()
    return Ledger(train.sparkSession, path, f"{rows['n']} rows {rows['sum']}, {settings.num_features} features, seed {settings.seed}, {folds} folds")


def storage_memory(spark: SparkSession) -> int:
    """Bytes that the executors keep for cached data whatever else runs: Spark's share for it, of half of which tasks may take none."""
    managers = spark.sparkContext._jsc.sc().getExecutorMemoryStatus()
    each, total = managers.values().iterator(), 0
    while each.hasNext():
        total += each.next()._1()
    n = managers.size()
    return total * max(1, n - 1) // n // 2  # on a cluster one of them is the driver's


def fits_at_once(train: DataFrame, parallelism: int) -> int:
    """How many of `parallelism` fits have room side by side.

    A fit caches its rows and reads them in every iteration. Beyond the memory they would push each other out to disk;
    a fit of a large table keeps all cores busy by itself.
    """
    entries = F.size(F.unwrap_udt("features")["values"]).cast("bigint")
    held = train.agg(F.sum(entries * 12 + 32)).first()[0] or 1  # a number and its place
    return max(1, min(parallelism, storage_memory(train.sparkSession) // held))


def by_area(evaluator: Evaluator) -> bool:
    """Whether the metric is the area under ROC of the usual columns, each row counted once."""
    if not isinstance(evaluator, BinaryClassificationEvaluator) or evaluator.getMetricName() != "areaUnderROC":
        return False
    return evaluator.getRawPredictionCol() == "rawPrediction" and evaluator.getLabelCol() == "label" and not evaluator.isSet("weightCol")


def areas_together(placed: DataFrame, fits: list[Fit]) -> Iterator[dict[Fit, float]]:
    """The areas under ROC of those of `fits` that can share their passes over `placed`, a group of them at a time.

    These are fits of two classes, where both are inside and outside the fold that is left out.
    """
    counts = placed.filter(F.col(FOLD).isNotNull()).groupBy(FOLD).agg(
        F.count("*").alias("rows"), F.count_if(F.col("label") == 0).alias("zeros"), F.count_if(F.col("label") == 1).alias("ones"), F.first("features").alias("sample")
    )
    folds = {r[FOLD]: r for r in counts.collect()}
    if any(r["rows"] != r["zeros"] + r["ones"] for r in folds.values()):
        return

    def whole(left_out: int) -> bool:
        sides = [r for k, r in folds.items() if k != left_out], [folds[left_out]] if left_out in folds else []
        return all(sum(r[label] for r in side) for side in sides for label in ("zeros", "ones"))

    able = {k for k in folds if whole(k)}
    wanted = {(Descent(fit.reg_param, fit.elastic_net_param, fit.fold), fit.max_iter): fit for fit in fits if fit.fold in able}
    if wanted:
        yield from joint_areas(placed.filter(F.col(FOLD).isNotNull()), wanted, len(next(iter(folds.values()))["sample"]))


def cross_validate(
    train: DataFrame,
    settings: Settings,
    grid: Grid,
    evaluator: Evaluator,
    folds: int = 5,
    parallelism: int = 4,
    ledger: str | None = None,
    part: tuple[int, int] = (0, 1),
) -> Validated | None:
    """Every grid point over folds of whole questions; the best one is fitted again on all rows.

    The fold stands in a stored table, so no fit computes it again. Fits of two classes that are measured by the area under ROC
    share their passes over the rows (`operators.joint_fits`). Of others at most `parallelism` run side by side, fewer where
    the memory would not hold their rows. Each fit is one row of the ledger, in a folder that is given or
    in the shared scratch folder; with the same `ledger` a later run makes only what is missing, and jobs that take different
    parts of the grid (`part` k of n) share it. None when other parts are still missing.
    """
    spark = train.sparkSession
    fits = grid_fits(grid, folds)
    book = open_ledger(train, settings, folds, ledger or scratch_path(spark, "ledger"))
    if book.missing(fits):
        placed = stored(train.withColumn(FOLD, fold("id", folds, settings.seed)), "folds")

        def make(fit: Fit) -> float:
            regression = LogisticRegression(maxIter=fit.max_iter, regParam=fit.reg_param, elasticNetParam=fit.elastic_net_param)
            model = regression.fit(placed.filter(F.col(FOLD) != fit.fold))
            return evaluator.evaluate(model.transform(placed.filter(F.col(FOLD) == fit.fold)))

        own = [fit for k, fit in enumerate(fits) if k % part[1] == part[0]]
        for areas in areas_together(placed, book.missing(own)) if by_area(evaluator) else ():
            book.run(list(areas), areas.__getitem__, parallelism)
        if book.missing(own):
            book.run(fits, make, fits_at_once(placed, parallelism), part)
        if book.missing(fits):
            return None
    table = stored(grid_means(book.table(fits), *POINT, folds=folds), "grid-means")
    best = table.filter("best").first()
    if best is None:
        raise ValueError("no point of the grid has a metric in every fold")
    chosen = LogisticRegression(maxIter=best["max_iter"], regParam=best["reg_param"], elasticNetParam=best["elastic_net_param"])
    return Validated(chosen.fit(train), table.select("reg_param", "elastic_net_param", "max_iter", "avg_metric", "best"))


def with_run_facts(metrics: DataFrame, prepared: Prepared, model: LogisticRegressionModel) -> DataFrame:
    """The one-row report with row counts and the parameters of the model."""
    rows = F.count("*")
    return metrics.withColumns(
        {
            "train_rows": prepared.train.agg(rows).scalar(),
            "skipped_rows": F.lit(prepared.skipped_rows).cast("bigint"),
            "reg_param": F.lit(model.getRegParam()),
            "elastic_net_param": F.lit(model.getElasticNetParam()),
            "max_iter": F.lit(model.getMaxIter()),
        }
    )
