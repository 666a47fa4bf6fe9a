"""Forum tables from CSV: declared schema, typed dates, and a table of rejected rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from forumlens.functions.dates import parse_date
from forumlens.sources.schemas import DATE_COLUMNS, MODEL_NAMES
from forumlens.sources.split_csv import is_header, read_records

RAW_RECORD = "raw_record"


@dataclass(frozen=True)
class ForumTable:
    rows: DataFrame
    rejects: DataFrame


def with_raw_record(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(RAW_RECORD, StringType())])


def scan_csv(spark: SparkSession, path: str | list[str], schema: StructType) -> DataFrame:
    """Multi-line CSV with a header and doubled quotes. A field that does not fit its type is null."""
    return (
        spark.read.option("multiLine", True)
        .option("escape", '"')
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RAW_RECORD)
        .schema(with_raw_record(schema))
        .csv(path)
    )


def scan_csv_split(spark: SparkSession, path: str | list[str], schema: StructType) -> DataFrame:
    """The rows of `scan_csv` without its one task per file."""
    options = {
        "escape": '"',
        "multiLine": "true",
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": RAW_RECORD,
    }
    ddl = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in with_raw_record(schema))
    return (
        read_records(spark, path)
        .filter(~is_header() & (F.col("text") != ""))
        .select(F.from_csv("text", ddl, options).alias("row"))
        .select("row.*")
    )


def to_model(raw: DataFrame, schema: StructType) -> ForumTable:
    """Split off the rows without a key and give the others their model names and date type."""
    keys = [field.name for field in schema.fields if not field.nullable]
    keyless = F.greatest(*(F.col(k).isNull() for k in keys)) if len(keys) > 1 else F.col(keys[0]).isNull()
    columns = [
        (parse_date(F.col(name)) if name in DATE_COLUMNS else F.col(name)).alias(MODEL_NAMES[name])
        for name in schema.names
    ]
    missing = F.concat_ws(",", *(F.when(F.col(k).isNull(), F.lit(MODEL_NAMES[k])) for k in keys))
    return ForumTable(
        rows=raw.filter(~keyless).select(*columns),
        rejects=raw.filter(keyless).select(*columns, missing.alias("missing_keys"), F.col(RAW_RECORD)),
    )


def load_table(
    spark: SparkSession, path: str | list[str], schema: StructType, *, split_files: bool = False
) -> ForumTable:
    """`split_files` reads every file with many tasks; it needs quotes inside fields to be doubled."""
    scan = scan_csv_split if split_files else scan_csv
    return to_model(scan(spark, path, schema), schema)


def convert_to_parquet(
    table: ForumTable, rows_path: str, rejects_path: str, partitions: int | None = None, *keys: str
) -> None:
    """Store a CSV table as Parquet once, in `partitions` files of even size where that is given.

    A multi-line CSV file is one scan task whatever its size; the stored copy splits,
    prunes columns and takes filters. `keys` should identify a row, so that no file is hot.
    """
    rows = table.rows if partitions is None else table.rows.repartition(partitions, *keys)
    rows.write.mode("errorifexists").parquet(rows_path)
    table.rejects.write.mode("errorifexists").parquet(rejects_path)
