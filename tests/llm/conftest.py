import pytest

from forumlens.llm.common import ship


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    ship(spark)


@pytest.fixture
def documents(spark):
    """Nulls, empties, repeated rows, ties, a long text, and columns with names that the operators use."""
    long = " ".join(f"word{i % 977}" for i in range(30000))
    rows = [
        (1, "The quick brown fox jumps over the lazy dog again and again, they say.", "a", 1, "x"),
        (2, "The quick brown fox jumps over the lazy dog again and again, they say.", "b", 2, None),
        (2, "The quick brown fox jumps over the lazy dog again and again, they say.", "b", 2, None),
        (3, None, None, None, "y"),
        (None, "no number here", "c", 3, "z"),
        (4, "", "", 4, ""),
        (5, long, "d", 5, "z"),
        (6, "¡Él dijo: 日本語! <|endoftext|> \t\n x", "e", 6, "z"),
        (7, "you worthless moron, scum and trash", "e", 7, "z"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, bucket string, shard long, `a.b` string")
