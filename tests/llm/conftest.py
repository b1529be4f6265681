import pytest

CLASHES = "row long, n long, key string, words string, h long, score double, lang_pred string, line string, size int"


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, columns with clashing names."""
    long = " ".join(f"word{i % 997} of{i}" for i in range(30_000))
    rows = [
        (1, "the cat sat on the mat and then it went away\nsecond line of some length here", "en"),
        (1, "the cat sat on the mat and then it went away\nsecond line of some length here", "en"),
        (2, None, "en"),
        (3, "", None),
        (4, " \n\t ", "fr"),
        (5, long, "en"),
        (6, long, "en"),
        (None, "a text whose document has no id at all, with words enough", None),
        (None, None, None),
        (7, "été à la plage, où l'eau est bleue\nsecond line of some length here", "fr"),
        (8, "1234 5678", "de"),
        (9, "<|endoftext|> \x1c odd spaces  and\r\nbreaks", "de"),
        (10, "one", "de"),
    ]
    filler = (1, 2, "k", "w", 3, 0.5, "xx", "l", 4)
    return spark.createDataFrame([(*r, *filler) for r in rows], f"doc_id long, text string, lang string, {CLASHES}")


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
