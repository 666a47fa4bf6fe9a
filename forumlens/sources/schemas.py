"""Declared schemas of the three forum tables, as they stand in the CSV files. Ids have 64 bits."""

from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

QUESTIONS = StructType(
    [
        StructField("Id", LongType(), False),
        StructField("OwnerUserId", LongType(), True),
        StructField("CreationDate", StringType(), True),
        StructField("ClosedDate", StringType(), True),
        StructField("Score", IntegerType(), True),
        StructField("Title", StringType(), True),
        StructField("Body", StringType(), True),
    ]
)

ANSWERS = StructType(
    [
        StructField("Id", LongType(), False),
        StructField("OwnerUserId", LongType(), True),
        StructField("CreationDate", StringType(), True),
        StructField("ParentId", LongType(), False),
        StructField("Score", IntegerType(), True),
        StructField("Body", StringType(), True),
    ]
)

TAGS = StructType(
    [
        StructField("Id", LongType(), False),
        StructField("Tag", StringType(), True),
    ]
)

# Column name in the CSV -> column name in the model.
MODEL_NAMES = {
    "Id": "id",
    "OwnerUserId": "owner_user_id",
    "CreationDate": "creation_date",
    "ClosedDate": "closed_date",
    "ParentId": "parent_id",
    "Score": "score",
    "Title": "title",
    "Body": "body",
    "Tag": "tag",
}

DATE_COLUMNS = ("CreationDate", "ClosedDate")
