import pytest
from pyspark.sql import functions as F

PROSE = "the house of {} stands on a hill and its owner {} likes quiet evenings by the river {} with tea"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside or return, with values that would spoil them.
CLASHING = (
    "score", "passages", "pieces", "decoded", "key", "node", "component", "class_id", "kept", "h", "bad",
    "sketch", "line", "n_words", "word_length", "symbols", "distance", "bin", "start", "length", "ids",
    "doc_tokens", "sequence_id", "offset", "bucket", "n_lines", "n_dropped", "held_out", "_row", "_key",
)


def prose(i: int, n: int = 60) -> str:
    words = PROSE.format(f"name{i}", f"owner{i * 7}", f"river{i * 13}").split()
    return " ".join(f"{w}{(i * 31 + k) % 17 if k % 3 == 0 else ''}" for k, w in enumerate((words * 9)[:n]))


EDGE = [
    (1, prose(1), "en", "a", 1),
    (1, prose(1), "en", "a", 1),  # a repeated row
    (1, prose(2), "en", "a", 1),  # the same id again
    (2, None, "en", "a", None),
    (3, "", None, "a", 0),
    (4, " \n\t ", "de", None, 4),
    (None, prose(3), "en", "b", 1),
    (None, None, None, None, None),
    (5, "x" * 150_000, "en", "b", 150_000),  # one very long word
    (6, " ".join(prose(i) for i in range(300)), "en", "b", 1),
    (7, "a▁b \U0001f600 é <|endoftext|> <s> {line}\r\n\r\nend", "fr", "c", 1),
    (8, "one two", "fr", "c", 7),
    (9, "one two", "fr", "c", 7),
]


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and long texts, ties, repeated rows and clashing columns."""
    docs = spark.createDataFrame(EDGE, DOCS)
    return docs.select("*", *[F.lit("clash").alias(c) for c in CLASHING])


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")
