import pytest

from ledgerline.llm import base


@pytest.fixture(autouse=True)
def prepared(spark):
    base.prepare(spark)


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(rows, extra=""):
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long" + extra)
    return make
