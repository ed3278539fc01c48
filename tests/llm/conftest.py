import pytest

CLASH = {
    "found": "1", "candidates": "2", "row": "3", "node": "4", "shard": "5", "slot": "6", "part": "7", "root": "8",
    "k": "9", "block": "10", "lang_pred": "11", "score": "12", "kept": "13", "component_id": "14", "size": "15",
}


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Documents with nulls, empty and long texts, repeats, ties, and columns that operators use themselves."""
    long = " ".join(f"w{i % 977} the" for i in range(40_000))
    rows = [
        (1, "The cat sat on the mat and looked at the old grey dog.", "en", "a"),
        (2, "The cat sat on the mat and looked at the old grey dog.", "en", "a"),
        (2, "The cat sat on the mat and looked at the old grey dog.", "en", "a"),
        (2, "Another text of the same id, with its own words in it.", "en", None),
        (None, "The cat sat on the mat and looked at the old grey dog.", None, "b"),
        (None, None, None, None),
        (None, None, None, None),
        (3, None, "en", "b"), (4, "", "de", "b"), (5, "   \n\t ", "de", "b"), (6, "12345 !!! ...", None, "b"),
        (7, "one two", "en", "c"), (8, "ONE TWO", "en", "c"), (9, long, "en", "c"), (10, long + " end", "en", "c"),
        (11, "Größe über alles: Straße, Ärger und Öl.\x1c\x00 \U0001f600 mail me.at@example.com", "de", "c"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    from pyspark.sql import functions as F

    frame = frame.withColumn("n_chars", F.length("text").cast("long"))
    return frame.select("*", *[F.lit(v).alias(c) for c, v in CLASH.items()]).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")
