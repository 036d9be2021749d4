import pytest

from demandloom.llm.tables import read
from tests.conftest import FOLDER


@pytest.fixture(scope="session")
def documents(spark):
    return read(spark, FOLDER, "documents")


@pytest.fixture(scope="session")
def texts(documents):
    return {r[0]: r[1] for r in documents.select("doc_id", "text").collect()}


#: Null, empty and repeated rows, a long text, and extra columns whose names the operators use.
ODD = [
    (1, None, "a", "x", 3), (2, "", None, "x", 3), (None, "a b c d e f g h i j k l", "b", "x", 3),
    (4, "xy " * 30_000, "a", "x", 3), (5, "mail z@b.cd now", "a", None, None), (5, "mail z@b.cd now", "a", None, None),
    (6, "mail z@b.cd now", "c", "x", 3), (7, " \n\t ", "c", "x", 3),
]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string, source string, words string, n_words int")
