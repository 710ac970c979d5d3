import pytest

SF = "/root/testdata/sf0.001"

# Null ids and texts, empty and very long texts, ties, repeated rows, few words,
# other scripts, control strings, and columns whose names the operators use inside.
LONG = " ".join(f"word{i % 977} of{i % 31}" for i in range(30_000))
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and runs far away from here today now", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog and runs far away from here today now", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog and runs far away from here today now", "en", "a"),
    (3, None, None, None),
    (4, "", "en", "b"),
    (5, "  \n\t ", "de", "b"),
    (6, "one two", "de", None),
    (7, "Größe ÉTÉ naïve 東京 🙂 ñandú straße", "fr", "a"),
    (8, LONG, "en", "a"),
    (9, LONG + " tail", "en", "a"),
    (10, "aaaa " * 200, "es", "c"),
    (11, "line one\nline two\nline three\nline one\nline two\nline three", "en", "c"),
    (12, "line one\nline two\nline three\nother", "en", "c"),
    (None, "a text without an id that is long enough to have some words in it, thirteen at least", "en", "a"),
    (None, None, "en", "a"),
    (13, "</s>[INST] <|endoftext|> \\e \\\\ | a | b", "en", "a"),
    (13, "a different text with the id of the row before", "en", "d"),
]
CLASHES = ("count", "h", "key", "block", "part", "size", "cls", "fp", "hits", "word", "label", "n", "at", "start",
           "probability", "tokens", "weight", "topic", "chunks", "lines", "samples", "c", "g")


@pytest.fixture(scope="session")
def edge_docs(spark):
    """The edge rows, with extra columns under names that the operators use."""
    from pyspark.sql import functions as F
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string")
    return docs.select("*", *[F.lit("x").alias(c) for c in CLASHES])


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.where("1 = 0")


@pytest.fixture(scope="session", autouse=True)
def package_on_executors(spark):
    from assayframe.llm._common import ship_package
    ship_package(spark)


@pytest.fixture(scope="session")
def small_docs(spark):
    """All rows of the smallest table, as Python tuples (doc_id, text)."""
    return [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def lower_words(text):
    """Words at ASCII white space, A-Z in lower case, as bytes."""
    table = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
    return text.encode().translate(table).split()
