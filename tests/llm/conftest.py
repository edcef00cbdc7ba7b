import pytest

from retentio.llm.tokenizer_files import tokenizer_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def tokenizer():
    return tokenizer_path()


@pytest.fixture()
def docs(spark):
    """doc_id, text and columns whose names clash with the operators' own."""
    def make(rows):
        return spark.createDataFrame(
            [(i, t, "a", "b", 1, 2, "x") for i, t in rows],
            "doc_id long, text string, lang string, source string, _k1 int, fp int, label string")
    return make
