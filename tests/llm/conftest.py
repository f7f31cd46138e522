import pytest


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    return spark.conf.get("spark.checkpoint.dir")


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of the given texts, with ids from 0 on unless (id, text) pairs are given."""

    def make(texts, parts=2):
        rows = [(t if isinstance(t, tuple) else (k, t)) for k, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)

    return make
