"""A ledger of fits: cross validation that goes on where it was stopped, and that several jobs can share.

Each fit of a grid point on all folds but one is one committed row, in a folder of its own, so jobs and threads that write side by side
never meet and a fit that was cut off leaves nothing that can be read. A run makes the fits that are missing. The means and the best
point are sums over the ledger.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from io import BytesIO
from multiprocessing.pool import ThreadPool

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "point int, reg_param double, elastic_net_param double, max_iter int, fold int, metric double"
POINT = ["point", "reg_param", "elastic_net_param", "max_iter"]


@dataclass(frozen=True)
class Fit:
    point: int
    reg_param: float
    elastic_net_param: float
    max_iter: int
    fold: int

    @property
    def name(self) -> str:
        return f"reg={self.reg_param!r}-net={self.elastic_net_param!r}-iter={self.max_iter}-fold={self.fold}"


class Ledger:
    """The fits below `path`, of one training set and one number of folds (`of` tells which)."""

    def __init__(self, spark: SparkSession, path: str, of: str):
        self.spark, self.path, self.java_path = spark, path.rstrip("/"), spark._jvm.org.apache.hadoop.fs.Path
        self.files = self._place("").getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        if self.files.exists(self._place("/of/_SUCCESS")):
            known = spark.read.parquet(f"{self.path}/of").first()["of"]
            if known != of:
                raise ValueError(f"the ledger at {self.path} belongs to other data or folds: {known}, not {of}")
        else:
            spark.createDataFrame([(of,)], "of string").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/of")

    def _place(self, below: str):
        return self.java_path(self.path + below)

    def has(self, fit: Fit) -> bool:
        return self.files.exists(self._place(f"/fits/{fit.name}/_SUCCESS"))

    def missing(self, fits: Iterable[Fit]) -> list[Fit]:
        return [fit for fit in fits if not self.has(fit)]

    def _write(self, below: str, content: bytes) -> None:
        out = self.files.create(self._place(below), True)
        out.write(content)
        out.close()

    def record(self, fit: Fit, metric: float) -> None:
        """One row is no work for a job: the driver writes it, and marks it as committed after that."""
        row = (fit.point, fit.reg_param, fit.elastic_net_param, fit.max_iter, fit.fold, float(metric))
        kinds = [pa.int32() if column.endswith(" int") else pa.float64() for column in SCHEMA.split(", ")]
        cells, held = [pa.array([x], kind) for x, kind in zip(row, kinds)], BytesIO()
        pq.write_table(pa.table(cells, names=[column.split()[0] for column in SCHEMA.split(", ")]), held)
        folder = f"/fits/{fit.name}"
        self.files.delete(self._place(folder), True)  # what a run that was stopped has left
        self._write(f"{folder}/part-0.parquet", held.getvalue())
        self._write(f"{folder}/_SUCCESS", b"")

    def table(self, fits: Iterable[Fit]) -> DataFrame:
        """The rows of those of `fits` that are there, with their numbers in this grid."""
        done = [fit for fit in fits if self.has(fit)]
        if not done:
            return self.spark.createDataFrame([], SCHEMA)
        rows = self.spark.read.schema(SCHEMA).parquet(*[f"{self.path}/fits/{fit.name}" for fit in done]).drop("point")
        numbers = self.spark.createDataFrame([(f.point, f.reg_param, f.elastic_net_param, f.max_iter) for f in done], "point int, reg_param double, elastic_net_param double, max_iter int").distinct()
        return rows.join(F.broadcast(numbers), POINT[1:]).select(*POINT, "fold", "metric")

    def run(self, fits: list[Fit], make: Callable[[Fit], float], parallelism: int = 4, part: tuple[int, int] = (0, 1)) -> int:
        """Make the missing fits that fall to job part[0] of part[1]; how many. All others are made before a failure is raised."""
        own = [fit for k, fit in enumerate(fits) if k % part[1] == part[0]]
        missing = self.missing(own)

        def one(fit: Fit) -> Exception | None:
            try:
                self.record(fit, make(fit))
            except Exception as error:
                return error

        with ThreadPool(max(1, min(parallelism, len(missing)))) as pool:
            failed = [e for e in pool.map(one, missing, chunksize=1) if e is not None]
        if failed:
            raise failed[0]
        return len(missing)


def grid_means(fits: DataFrame, *point: str, folds: int) -> DataFrame:
    """avg_metric of each point over its folds, and which is the best: the highest mean, the first point on ties.

    A point of which a fold is missing has no mean and is not the best. `point` begins with the number of the point.
    """
    whole = F.count_distinct("fold") == folds
    means = fits.groupBy(*point).agg(F.count_distinct("fold").alias("folds"), F.when(whole, F.avg("metric")).alias("avg_metric"))
    first = means.filter("avg_metric is not null").agg(F.max_by(point[0], F.struct(F.col("avg_metric"), -F.col(point[0]))).alias("best"))
    return means.withColumn("best", F.coalesce(F.col(point[0]) == first.scalar(), F.lit(False)))
