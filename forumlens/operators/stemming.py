"""Stemming as a vocabulary job: each distinct word is stemmed once and joined back to the texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumlens.functions.stemmer import english_stem
from forumlens.operators.lookup import skew_safe_lookup
from forumlens.session import stored

#: Words that a task of the stemmer takes.
WORDS_PER_TASK = 4096
#: Words of texts that share a dictionary.
CHUNK_WORDS = 1 << 18


def stem_vocabulary(words: DataFrame, words_per_task: int = WORDS_PER_TASK) -> DataFrame:
    """Add `stem` to a table with a row for each `word`.

    The rows are few bytes and much work, so the tasks follow from their number and not from
    the bytes, by which the adaptive merge would go.
    """
    words = stored(words, "words")
    tasks = max(1, -(-words.count() // words_per_task))
    return words.repartition(tasks, "word").withColumn("stem", english_stem(F.col("word")))


def count_words(df: DataFrame, words: str) -> DataFrame:
    """Vocabulary of an array column. The outer explode spares a size filter that would clean the text twice."""
    return (
        df.select(F.explode_outer(words).alias("word"))
        .filter("word is not null")
        .groupBy("word")
        .agg(F.count("*").alias("total_count"))
    )


def _word_chunks(df: DataFrame, id_column: str, words: str) -> DataFrame:
    """Texts in chunks, a row each: `dictionary`, its distinct words, and `texts`, whose words are places in it (`codes`).

    A chunk has CHUNK_WORDS words at most, or is one text. Words that are null are left out; ids may stand twice.
    """
    id_type = df.schema[id_column].dataType
    codes = T.ArrayType(T.IntegerType())
    texts = T.ArrayType(T.StructType([T.StructField("id", id_type), T.StructField("codes", codes)]))
    most = CHUNK_WORDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = np.cumsum(pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False), dtype=np.int64)
            begin = 0
            while begin < len(batch):
                before = ends[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(ends, before + most, "right")))
                part = batch.slice(begin, end - begin)
                coded = part.column(1).flatten().dictionary_encode()
                offsets = pa.array(np.concatenate([[0], ends[begin:end] - before]), pa.int32())
                rows = pa.StructArray.from_arrays([part.column(0), pa.ListArray.from_arrays(offsets, coded.indices)], ["id", "codes"])
                lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (rows, coded.dictionary)]
                yield pa.RecordBatch.from_arrays(lists, ["texts", "dictionary"])
                begin = end

    schema = T.StructType([T.StructField("texts", texts), T.StructField("dictionary", T.ArrayType(T.StringType()))])
    listed = F.array_compact(F.coalesce(F.col(words), F.array().cast("array<string>")))
    return df.select(F.col(id_column).alias("id"), listed.alias("words")).mapInArrow(run, schema)


def stem_words(df: DataFrame, id_column: str, words: str) -> DataFrame:
    """id and its array of stems in text order, under the name `words`, for each row of `df`; an id may have several.

    The cleaned words are stored once, in chunks of texts that share a dictionary. What vocabulary, join and group read are the
    words of the dictionaries, far fewer than those of the texts; texts come in again at the end, a row for each chunk.
    """
    chunks = stored(_word_chunks(df, id_column, words).select(F.monotonically_increasing_id().alias("chunk"), "texts", "dictionary"), "word-chunks")
    entries = chunks.select("chunk", F.posexplode("dictionary").alias("code", "word"))
    counted = entries.groupBy("word").agg(F.count("*").alias("chunk_count"))
    lexicon = stored(stem_vocabulary(counted), "stems")
    stemmed = skew_safe_lookup(entries, lexicon, "word", "chunk_count", F.col("chunk"))
    in_order = F.sort_array(F.collect_list(F.struct("code", "stem")))
    stems = stemmed.groupBy("chunk").agg(in_order.alias("found")).select("chunk", F.col("found.stem").alias("stems"))
    met = chunks.select("chunk", "texts").join(stems, "chunk", "left")  # a chunk of empty texts has no stems
    text = lambda t: F.struct(t["id"].alias("id"), F.transform(t["codes"], lambda code: F.get("stems", code)).alias("words"))
    # A chunk has texts; the outer form spares a size filter that would look the words up twice.
    return met.select(F.inline_outer(F.transform("texts", text))).toDF(id_column, words)
