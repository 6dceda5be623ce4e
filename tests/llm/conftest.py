import pytest
from pyspark.sql import types as T

DOCUMENT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    # Names that the operators use themselves.
    T.StructField("fp", T.StringType()), T.StructField("run", T.StringType()),
    T.StructField("kept_key", T.StringType())])

EN = "the cat sat on the mat and the dog ran after the cat in the garden"
DE = "der hund lief nach der katze und die katze sass auf der matte im garten"

#: Nulls, empty and blank texts, copies, repeated rows, ties, a long text.
ROWS = [
    (5, EN, "en"), (3, EN.replace(" ", "\n\t"), "en"), (9, EN, "en"), (9, EN, "en"), (1, DE, "de"),
    (2, None, "en"), (4, "", None), (6, " \t\n", "de"), (None, EN + " tail", "en"), (None, None, None),
    (7, "!!! 123 ...", "en"), (8, "x", "de"), (10, (EN + " " + DE + " ") * 400, "en"),
    (11, EN + " é ñ 日本 🙂\x00\x1c", "en"), (12, "<|endoftext|> a  b   c", "en"), (13, "y" * 5000, "de"),
    (14, " ".join(f"w{i}" for i in range(300)), "en"), (15, " ".join(f"w{i}" for i in range(301)), "en")]


@pytest.fixture(scope="session")
def docs(spark):
    rows = [(*r, "clash", "clash", "clash") for r in ROWS]
    return spark.createDataFrame(rows, DOCUMENT).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCUMENT)
