import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from forumlens.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def forum(spark):
    """A small forum: question 4 has no answer, 2 has three; 6 has a null tag row; 7 has none."""
    questions = spark.createDataFrame(
        [
            (1, "2008-08-31 23:57:07", 10),
            (2, "2009-01-01 00:00:00", 9),
            (3, "2009-08-01 00:00:00", 12),
            (4, "2010-02-01 00:00:00", 30),
            (5, None, None),
            (6, "2010-02-03 00:00:00", 12),
            (7, "2011-02-03 00:00:00", 0),
        ],
        "id int, creation_date string, score int",
    ).selectExpr("id", "cast(creation_date as timestamp_ntz) as creation_date", "score")
    answers = spark.createDataFrame([(1,), (2,), (2,), (2,), (3,), (6,), (99,)], "parent_id int")
    tags = spark.createDataFrame(
        [
            (1, "java"), (1, "sql"), (2, "java"), (2, "java"), (3, "sql"), (4, "c"), (4, "java"),
            (5, "c"), (6, None), (6, "sql"), (98, "java"),
        ],
        "id int, tag string",
    )
    return questions, answers, tags
