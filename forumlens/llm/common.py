"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumlens.session import ship


def read(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one of the given tables."""
    ship(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


def fresh(name: str, taken: Iterable[str]) -> str:
    """`name`, with underscores added until no column is called so (case does not matter)."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """`df` without the columns of these names, in any case."""
    low = {n.lower() for n in names}
    return df.select(*[F.col(quoted(c)) for c in df.columns if c.lower() not in low])


def quoted(name: str) -> str:
    """A column name as it stands in an expression, dots and backticks included."""
    return "`" + name.replace("`", "``") + "`"


def utf8_bytes(text: Column) -> Column:
    """Length in UTF-8; 0 for null."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def tasks_for(total: int, per_task: int) -> int:
    return max(1, -(-int(total) // per_task))


def numbered(df: DataFrame) -> DataFrame:
    """`df` with the columns c0, c1, ...: names with dots and the like don't reach Python workers."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], added: list[T.StructField]) -> DataFrame:
    """`df` through `run`, whose batches have the columns of `df` and then the added ones."""
    fields = [*df.schema.fields, *added]
    names = [f"c{i}" for i in range(len(fields))]

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches):
            yield pa.RecordBatch.from_arrays(batch.columns, names=names)

    schema = T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, fields)])
    return numbered(df).mapInArrow(renamed, schema).toDF(*[f.name for f in fields])
