"""Session settings, the one place that cuts lineage, and how long what it writes lives."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path
from threading import Lock
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "forumlens", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master is not None:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in spark.checkpoint.dir, which every executor can reach.

    Only a local session that names none gets a temporary folder.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="forumlens-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Spark then drops the shuffle files of a statement when it ends.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_dropping = Lock()
_droppers: list[str] = []  # what the setting was before each of the writes that run now, side by side


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    with _dropping:
        _droppers.append(_droppers[0] if _droppers else spark.conf.get(DROP_SHUFFLES, "false"))
        spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        with _dropping:
            before = _droppers.pop()
            if not _droppers:
                spark.conf.set(DROP_SHUFFLES, before)


def tables_read(df: DataFrame) -> set[str]:
    """Paths of the tables that the plan of `df` reads, subqueries included."""
    plan = df._jdf.queryExecution().analyzed()
    below = plan.subqueriesAll()
    found = set()
    for tree in [plan, *[below.apply(i) for i in range(below.size())]]:
        leaves = tree.collectLeaves()
        for leaf in [leaves.apply(i) for i in range(leaves.size())]:
            if leaf.getClass().getSimpleName() == "LogicalRelation" and leaf.relation().getClass().getSimpleName() == "HadoopFsRelation":
                paths = leaf.relation().location().rootPaths()
                found |= {paths.apply(i).toUri().getPath() for i in range(paths.size())}
    return found


class Scope:
    """Stored tables that live as long as somebody can read them.

    A stored table is whole once it is written, so a table it was made from has no reader left but the frames whose
    plans still name it.
    """

    def __init__(self, spark: SparkSession, around: Scope | None = None):
        self.spark, self.around = spark, around
        self.tables: list[str] = []

    def _drop(self, paths: list[str]) -> None:
        configuration = self.spark._jsparkSession.sessionState().newHadoopConf()
        for path in paths:
            place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(configuration).delete(place, True)
            self.tables.remove(path)

    def _split(self, frames: tuple[DataFrame, ...]) -> tuple[list[str], list[str]]:
        read = set().union(*map(tables_read, frames)) if frames else set()
        is_read = {path: urlsplit(path).path in read for path in self.tables}
        return [p for p in self.tables if is_read[p]], [p for p in self.tables if not is_read[p]]

    def commit(self, *frames: DataFrame) -> None:
        """End a round: of this scope's tables only those stay that the plans of `frames` read."""
        self._drop(self._split(frames)[1])

    def hand_over(self, *frames: DataFrame) -> None:
        """What `frames` read belongs to the scope around from now on; with none around it stays with the session."""
        read, _ = self._split(frames)
        for path in read:
            self.tables.remove(path)
            if self.around is not None:
                self.around.tables.append(path)


_scope: ContextVar[Scope | None] = ContextVar("scope", default=None)


@contextmanager
def lifetimes(spark: SparkSession) -> Iterator[Scope]:
    """Tables that `stored` writes inside the block are deleted when it ends, but for those handed over.

    Blocks nest: a function that returns a lazy frame hands it over, and whoever runs it owns its tables. A block
    belongs to its thread; threads begun inside have none, so their tables stay with the session.
    """
    scope = Scope(spark, _scope.get())
    token = _scope.set(scope)
    try:
        yield scope
    finally:
        _scope.reset(token)
        scope.commit()


def stored(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write `df` as a table in the shared folder and go on from there.

    Cuts the lineage, survives lost executors, and gives later joins the true size. The shuffle files of the write are
    dropped with it; the table lives as the scope says (`lifetimes`), or else as long as the session's folder.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    scope = _scope.get()
    if scope is not None:
        scope.tables.append(path)
    with _shuffles_dropped(spark):
        df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Spark's own limit of buckets, unless the session names another.
MOST_BUCKETS = 100_000


def stored_in_buckets(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """`stored`, laid out in buckets of `key` as it is written, without a shuffle.

    Joins and groupings by `key` with as many partitions as there are buckets do not shuffle the table.
    """
    spark = df.sparkSession
    path, table = scratch_path(spark, name), f"{name}_{uuid.uuid4().hex}"
    scope = _scope.get()
    if scope is not None:
        scope.tables.append(path)
    with _shuffles_dropped(spark):
        df.write.format("parquet").option("path", path).bucketBy(buckets, key).saveAsTable(table)
    found = spark.table(table).select("*")
    found._jdf.queryExecution().analyzed()  # from here on the frame knows its files and its buckets by itself
    spark.sql(f"drop table {table}")
    return found


def buckets_for(df: DataFrame, per_task: int = 8) -> int:
    """Buckets for what the tasks of `df` write, `per_task` tables' parts each: no fewer than a shuffle has partitions."""
    most = int(df.sparkSession.conf.get("spark.sql.sources.bucketing.maxBuckets", str(MOST_BUCKETS)))
    return min(most, max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), per_task * df.rdd.getNumPartitions()))


@contextmanager
def scratch_removed(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that `stored` writes inside the block when it ends.

    Only for jobs whose results are written elsewhere by then.
    """
    with lifetimes(spark):
        yield


def ship(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver has it; elsewhere it comes with --py-files."""
    root = str(Path(__file__).resolve().parents[1])
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, root])


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Shuffle a scan that has fewer tasks than the cluster has cores.

    Such a scan holds less than cores x maxPartitionBytes, so the shuffle is small;
    a scan with a task for every core is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)
