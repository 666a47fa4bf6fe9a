"""Multi-line CSV read by many tasks per file.

Spark reads a multi-line CSV file in one task. Here the file is read as plain lines, which splits, in two phases. A quote inside a
field is doubled, so a line break lies inside a field exactly when an odd number of quotes stands before it in the file: the first
phase counts quotes per range, a few numbers each, which tell in which state every range starts. In the second phase each task
runs through the lines of its ranges from their true starts and puts records together as it goes. No line is shuffled or written;
only what stands at the borders of ranges, at most two pieces of a record each, is stored and joined in a small step.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forumlens.session import stored

# A quoted field with what stands before it; quotes inside are doubled.
WELL_QUOTED = '(^|,)"(?:[^"]|"")*+"(?=,|\r?$)'
SPLIT = ["file", "split"]
#: Ranges whose states, some 100 bytes each, are broadcast.
RANGES = 50_000


def _joined(lines: Column) -> Column:
    """Lines of (place, text) structs in order, with the line breaks they had."""
    return F.array_join(F.transform(F.sort_array(lines), lambda line: line["value"]), "\n")


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with their file, the offset of their split and their order in it."""
    return (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("split"),
            F.monotonically_increasing_id().alias("line"),
            (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"),
            "value",
        )
    )


def _split_states(lines: DataFrame) -> DataFrame:
    """One row per split: whether it starts and ends inside a field, and how the file ends its lines."""
    in_file = Window.partitionBy("file").orderBy("split")
    splits = lines.groupBy(*SPLIT).agg(
        (F.sum("quotes") % 2).alias("odd"),
        F.min_by(F.col("value").endswith("\r"), F.col("line")).alias("carriage_return"),
    )
    return splits.select(
        *SPLIT,
        ((F.sum("odd").over(in_file) - F.col("odd")) % 2).alias("starts_open"),
        (F.sum("odd").over(in_file) % 2).alias("ends_open"),
        F.first("carriage_return").over(in_file).alias("carriage_return"),
    )


def _with_states(lines: DataFrame, states: DataFrame) -> DataFrame:
    """Lines in their order with the state of their range. The states of at most RANGES ranges are broadcast, so the scan goes on in
    its order; beyond that the lines are dealt by range and sorted."""
    if states.count() <= RANGES:
        return lines.join(F.broadcast(states), SPLIT, "left")
    tasks = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return lines.repartition(tasks, *SPLIT).join(states, SPLIT, "left").sortWithinPartitions(*SPLIT, "line")


def _pieces(lines: DataFrame, states: DataFrame, cut: bool) -> DataFrame:
    """(file, split, record, text): the whole records of each range, or the pieces of records that its borders cut.

    Record 0 of a range continues one from before; the last one may be continued after it. The function stands alone, so
    workers need nothing of this package.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        at = state = None
        record, inside, buffer, done = 0, 0, [], []

        def end(last: bool) -> None:
            if buffer and cut == (record == 0 or (last and state[1] == 1)):
                done.append((*at, record, "\n".join(buffer)))
            buffer.clear()

        def batch_of():
            values = list(zip(*done)) or [[]] * 4
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=["file", "split", "record", "text"])

        for batch in batches:
            for file, split, value, starts, ends, carriage in zip(*[c.to_pylist() for c in batch.columns]):
                if (file, split) != at:
                    if at is not None:
                        end(last=True)
                    if starts is None:
                        raise ValueError("the scans were split differently")
                    at, state, record, inside = (file, split), (starts, ends), 0, starts
                if not inside:
                    end(last=False)
                    record += 1
                buffer.append(value[:-1] if carriage and value.endswith("\r") else value)
                inside = (inside + value.count('"')) % 2
            if done:
                yield batch_of()
                done.clear()
        if at is not None:
            end(last=True)
        yield batch_of()

    told = _with_states(lines, states).select(*SPLIT, "value", "starts_open", "ends_open", "carriage_return")
    return told.mapInArrow(run, "file string, split long, record long, text string")


def read_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per CSV record, header included: `file`, `split`, `record` (its number there) and `text`.

    Only the two records at the ends of a range can be cut; their pieces are joined in a second, small step. As Spark does, where
    the header line ends with CR LF, that is one line break all through the file.
    """
    lines = _lines(spark, path)
    states = stored(_split_states(lines), "csv-ranges")
    pieces = stored(_pieces(lines, states, cut=True), "csv-borders")
    in_file = Window.partitionBy("file").orderBy("split", "record")
    chains = pieces.select(
        *SPLIT, "record", F.sum((F.col("record") > 0).cast("int")).over(in_file).alias("chain")
    )
    stitched = (
        pieces.join(chains, [*SPLIT, "record"])
        .groupBy("file", "chain")
        .agg(
            F.min(F.struct("split", "record")).alias("at"),
            _joined(F.collect_list(F.struct("split", "record", F.col("text").alias("value")))).alias("text"),
        )
        .select("file", "at.split", "at.record", "text")
    )
    records = _pieces(lines, states, cut=False).unionByName(stitched)
    # Quotes outside well-formed fields would shift all later records, silently.
    left = F.regexp_replace("text", WELL_QUOTED, "$1")
    message = F.concat(F.lit("stray quote or open field, read it with split_files=False: "), F.col("file"))
    return records.withColumn("text", F.when(F.contains(left, F.lit('"')), F.raise_error(message)).otherwise(F.col("text")))


def is_header() -> Column:
    """The first record of a file."""
    return (F.col("split") == 0) & (F.col("record") == 1)
