import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "word " * 3000 + "\n" + "".join(f"w{i} " for i in range(5000))
ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \t\n\x0b ", "en", "a", 5),
    (4, "One two.", "en", "a", 8),
    (5, "the same words stand here in a row and once more they do", None, None, None),
    (6, "the same words stand here in a row and once more they do", "en", "b", 7),
    (6, "the same words stand here in a row and once more they do", "en", "b", 7),
    (7, "THE SAME words stand here in a row and once more they do", "xx", "b", 7),
    (None, "no id but words that stand in a row and go on for a while", "en", "b", 7),
    (8, LONG, "en", "a", 10),
    (9, "é ü 漢字 😀 á   ı İ ß <|x|> it's\r\n\ttabs", "de", "a", 10),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with every irregularity, and columns whose names clash with those of results."""
    df = spark.createDataFrame(ODD, SCHEMA)
    names = "score kept copies node digest rank size row component_id words part ids length first".split()
    return df.selectExpr("*", *(f"source AS {n}" for n in names))


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(1, 1, 0), (2, None, None), (None, 1, 1), (6, 1, 0), (6, 0, 1), (6, 0, 1), (99, 1, 1), (4, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
