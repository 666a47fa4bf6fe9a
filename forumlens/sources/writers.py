"""Result sink: folders of parts, or one CSV file joined from ordered parts."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a part that one row of the joining step holds.
PART_ROWS = 20_000


def write_result(
    df: DataFrame,
    base_path: str,
    name: str,
    *,
    file_format: str = "parquet",
    mode: str = "errorifexists",
    header: bool = False,
    single_file: bool = False,
) -> str:
    """Write below `base_path` and return the path. `single_file` makes one part: for Parquet only for small reports, a CSV
    result may be of any size (`write_joined`)."""
    if file_format not in ("parquet", "csv"):
        raise ValueError(f"unknown format {file_format!r}")
    path = f"{base_path.rstrip('/')}/{name}" + (".csv" if file_format == "csv" else "")
    if single_file and file_format == "csv":
        return write_joined(df, path, mode=mode, header=header)
    writer = (df.coalesce(1) if single_file else df).write.mode(mode)
    if file_format == "csv":
        writer = writer.options(**CSV_OPTIONS).option("header", header)
    writer.format(file_format).save(path)
    return path


CSV_OPTIONS = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def _place() -> Column:
    """Order of a part by the numbers of its task and of its file within it."""
    numbers = F.regexp_extract_all("path", F.lit(r"part-(\d+)|-c(\d+)\."), F.lit(0))
    digits = lambda i: F.regexp_extract(F.get(numbers, F.lit(i)), r"(\d+)", 1).cast("bigint")
    return F.struct(digits(0).alias("task"), F.coalesce(digits(1), F.lit(0).cast("bigint")).alias("file"))


def write_joined(df: DataFrame, path: str, *, mode: str = "errorifexists", header: bool = False, part_rows: int = PART_ROWS) -> str:
    """Write `df` as a folder with one CSV file, and in `_manifest` the parts that it was joined from.

    The rows are sorted and written by many tasks, in parts of at most `part_rows` rows whose names follow the order of the
    rows. One task then strings the parts together, holding one at a time; nothing is sorted or collected there but their
    names. All this has a temporary name until the end, and the folder takes its own in one step: an attempt that fails leaves
    nothing that can be read at `path`.
    """
    if mode not in ("errorifexists", "overwrite"):
        raise ValueError(f"unknown mode {mode!r}")
    spark = df.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if files.exists(place) and mode == "errorifexists":
        raise FileExistsError(path)
    parent, name = path.rstrip("/").rsplit("/", 1)
    draft = f"{parent}/.{name}-{uuid.uuid4().hex}"
    at = lambda below: spark._jvm.org.apache.hadoop.fs.Path(f"{draft}/{below}" if below else draft)
    try:
        df.write.options(**CSV_OPTIONS).option("maxRecordsPerFile", part_rows).csv(f"{draft}/parts")
        parts = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{draft}/parts").filter("length > 0")
        listed = parts.select(_place().alias("place"), F.regexp_extract("path", "[^/]+$", 0).alias("part"), F.col("length").alias("bytes"))
        listed.orderBy("place").select("part", "bytes").coalesce(1).write.json(f"{draft}/manifest")
        text = F.regexp_replace(F.decode("content", "UTF-8"), "\n\\z", "")
        lines = parts.select(_place().alias("place"), text.alias("value"))
        if header:
            before_all = F.struct(F.lit(-1).cast("bigint").alias("task"), F.lit(0).cast("bigint").alias("file"))
            lines = lines.unionByName(spark.range(1).select(before_all.alias("place"), F.lit(_header_line(spark, df.columns)).alias("value")))
        lines.repartition(1).sortWithinPartitions("place").select("value").write.text(f"{draft}/joined")
        made = [f.getPath() for f in files.listStatus(at("joined")) if f.getPath().getName().startswith("part-")]
        moves = [(made[0], at("part-00000.csv")), (at("manifest"), at("_manifest"))]
        if not all(files.rename(a, b) for a, b in moves):
            raise OSError(f"could not lay out {draft}")
        for below in ("parts", "joined"):
            files.delete(at(below), True)
        if files.exists(place):
            files.delete(place, True)
        if not files.rename(at(""), place):
            raise OSError(f"could not commit {path}")
    except BaseException:
        files.delete(at(""), True)
        raise
    return path


def _header_line(spark: SparkSession, names: list[str]) -> str:
    """The names as the CSV sink writes them."""
    schema = spark.createDataFrame([tuple(names)], ", ".join(f"c{i} string" for i in range(len(names))))
    return schema.select(F.to_csv(F.struct(*schema.columns), {"escape": '"'})).first()[0]
