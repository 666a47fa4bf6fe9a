"""Term counts, vocabulary, IDF and TF-IDF as relations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumlens.operators.lookup import frequent_apart_lookup
from forumlens.session import stored

#: Words that are counted at a time, or those of one text.
CHUNK_WORDS = 1 << 18


def term_counts(df: DataFrame, id_column: str, words: Column) -> DataFrame:
    """One row per id and word with its count `n`; `df` has one row per id.

    Words are counted inside a task, some texts at a time and each text by itself, so nothing is shuffled. A null word is a
    word like any other; a null array has none.
    """
    most = CHUNK_WORDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(lengths)
            begin = 0
            while begin < len(batch):
                before = ends[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(ends, before + most, "right")))
                coded = batch.column(1).slice(begin, end - begin).flatten().dictionary_encode(null_encoding="encode")
                distinct = max(1, len(coded.dictionary))
                terms = np.repeat(np.arange(begin, end), lengths[begin:end]) * distinct + coded.indices.to_numpy()
                terms.sort()
                starts = np.flatnonzero(np.diff(terms, prepend=-1))
                texts, codes = np.divmod(terms[starts], distinct)
                counts = pa.array(np.diff(starts, append=len(terms)), pa.int64())
                columns = [batch.column(0).take(pa.array(texts)), coded.dictionary.take(pa.array(codes)), counts]
                yield pa.RecordBatch.from_arrays(columns, ["id", "word", "n"])
                begin = end

    fields = [("id", df.schema[id_column].dataType), ("word", T.StringType()), ("n", T.LongType())]
    schema = T.StructType([T.StructField(name, kind) for name, kind in fields])
    listed = F.coalesce(words, F.array().cast("array<string>"))
    return df.select(F.col(id_column).alias("id"), listed.alias("words")).mapInArrow(run, schema).toDF(id_column, "word", "n")


def vocabulary(terms: DataFrame) -> DataFrame:
    """Distinct words with total and document counts, combined before the shuffle."""
    return terms.groupBy("word").agg(
        F.sum("n").alias("total_count"), F.count("*").alias("doc_count")
    )


def inverse_document_frequency(terms: DataFrame, documents: DataFrame) -> DataFrame:
    """ln((m + 1) / (df + 1)) per word, with m counting the empty documents too."""
    m = documents.agg(F.count("*")).scalar()
    return (
        terms.groupBy("word")
        .agg(F.count("*").alias("doc_count"))
        .withColumn("idf", F.ln((m + F.lit(1.0)) / (F.col("doc_count") + F.lit(1.0))))
    )


def tf_idf(terms: DataFrame, documents: DataFrame, id_column: str) -> DataFrame:
    """Weight of each term. The terms are stored, since the table of weights and the join both read them.

    Only the terms of rare words are shuffled to meet their weights.
    """
    terms = stored(terms, "terms")
    idf = stored(inverse_document_frequency(terms, documents), "idf")
    return frequent_apart_lookup(terms, idf, "word", "doc_count", F.col(id_column)).select(
        id_column, "word", "n", "idf", (F.col("n") * F.col("idf")).alias("tf_idf")
    )
