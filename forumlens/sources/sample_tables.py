"""The given Parquet tables in the shape of the forum model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.session import spread


# The columns used here. A declared schema saves the job that would infer one.
SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_quantity double, l_returnflag string, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_brand string",
    "documents": "doc_id bigint, text string, lang string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, html string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def posts(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as questions."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("owner_user_id"),
        F.col("o_orderdate").alias("creation_date"),
        (F.floor(F.col("o_totalprice") / 10000).cast("int") - 20).alias("score"),
    )


def replies(spark: SparkSession, folder: str) -> DataFrame:
    """Returned line items as answers."""
    return (
        table(spark, folder, "lineitem")
        .filter("l_returnflag = 'R'")
        .select(
            F.col("l_orderkey").alias("parent_id"),
            F.col("l_shipdate").alias("creation_date"),
            F.floor("l_quantity").cast("int").alias("score"),
        )
    )


def post_tags(spark: SparkSession, folder: str) -> DataFrame:
    """Brands of an order's parts as its tags, each once."""
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("tag"))
    return (
        table(spark, folder, "lineitem")
        .join(parts, "l_partkey")
        .select(F.col("l_orderkey").alias("id"), "tag")
        .distinct()
    )


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(table(spark, folder, "documents").select("doc_id", "text", "lang", "n_chars"), "doc_id")


def pages(spark: SparkSession, folder: str) -> DataFrame:
    """Web pages as questions: the title element, the whole page as body, the page language as tag."""
    html = F.col("html")
    return spread(table(spark, folder, "pages").select("page_id", "html"), "page_id").select(
        "page_id",
        F.regexp_extract(html, "<title>([^<]*)</title>", 1).alias("title"),
        html.alias("body"),
        F.regexp_extract(html, '<html lang="([a-z]+)"', 1).alias("tag"),
    )


def labels(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "labels")


def document_questions(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as questions with text; the length stands for the score."""
    return documents(spark, folder).select(
        F.col("doc_id").alias("id"),
        F.lit(None).cast("string").alias("title"),
        F.col("text").alias("body"),
        F.col("n_chars").cast("int").alias("score"),
    )


def document_tags(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("tag"))


def labelled_questions(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that carry a label."""
    rated = labels(spark, folder).select(F.col("doc_id").alias("id"))
    return document_questions(spark, folder).join(rated, "id", "left_semi")


def quality_answers(spark: SparkSession, folder: str) -> DataFrame:
    """An answer for every document of quality 1."""
    return labels(spark, folder).filter("quality = 1").select(F.col("doc_id").alias("parent_id"))
