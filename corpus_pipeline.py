"""The corpus pipeline: five stages, each on all that the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again
as the next one's docs. Stages 1 to 4 return the columns of documents:

* toxicity: documents that the classifier chain, fitted on `labels`, calls toxic go. Null texts stay.
* near duplicates: of a group of linked SimHash fingerprints (four-word shingles, four bits, as op3) the rows of the
  smallest doc_id stay, one row of them. Rows without doc_id stay.
* repeats: bytes that a document with a smaller doc_id has in a string of 50 bytes are cut from the text. n_chars is
  the new text's length. A text of which nothing is left stays, empty.
* decontamination: documents whose words are, for a twentieth or more, in windows of `benchmark` go.
* tokens: all columns, token_ids and decoded.

An empty table passes through every stage. Other columns than doc_id, text and n_chars are kept as they are, whatever
they are called: the operators see them under names of ours. In the last stage those called token_ids or decoded are replaced.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.llm import bpe_automaton, decontamination, simhash, suffix_dedup, toxicity
from forumlens.llm.common import read, ship
from forumlens.session import lifetimes, stored

TOKENIZER = "word_bpe_49k.json"


def masked(docs: DataFrame) -> DataFrame:
    """`docs` with names for its other columns that no operator uses."""
    return docs.toDF(*[c.lower() if c.lower() in ("doc_id", "text") else f"kept{i}" for i, c in enumerate(docs.columns)])


def unmasked(kept: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of `docs`, under their names."""
    return kept.select(*masked(docs).columns).toDF(*docs.columns)


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = read(spark, sf_dir, "labels", "doc_id", "quality", "toxic")
    return unmasked(toxicity.judge(masked(docs), labels).filter(~F.col("is_toxic")), docs)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return unmasked(simhash.first_of_each(masked(docs)), docs)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    cut = suffix_dedup.remove_repeats(masked(docs))
    for field, name in zip(docs.schema.fields, masked(docs).columns):
        if field.name.lower() == "n_chars":
            cut = cut.withColumn(name, F.when(F.col("n_removed") > 0, F.length("text").cast(field.dataType)).otherwise(F.col(name)))
    return unmasked(cut, docs)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = read(spark, sf_dir, "benchmark", "item_id", "text")
    return unmasked(decontamination.decontaminate(masked(docs), benchmark), docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return bpe_automaton.encode_documents(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("toxicity", remove_toxic),
    ("near duplicates", remove_near_duplicates),
    ("repeated strings", remove_repeats),
    ("decontamination", remove_contaminated),
    ("tokens", encode),
]

#: Neither fitted models nor connected components nor BPE can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    with lifetimes(spark) as scope:
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
        for name, stage in STAGES:
            docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
            scope.commit(docs)
        scope.hand_over(docs)
    return docs
