import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Null, empty, blank and long texts, a null id, a repeated row, and columns named as the operators' own."""
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one two three four five six seven. " * 3000), (5, "x"),
            (5, "x"), (None, "loose words without any id at all"), (6, "Ünï cödé ▁ <unk> \x1c <|endoftext|>\x00"),
            (7, "a  b   c "), (8, "one two three four five six seven. " * 3000)]
    return spark.createDataFrame(
        [(i, t, "en", "s", 1, "fp", 3, "ids") for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long, fp string, n long, ids string")


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.where("false")
