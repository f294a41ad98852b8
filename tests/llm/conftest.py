import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from florin.llm.shipping import ship_package  # noqa: E402
from florin.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("checkpoints"))
    session = build_session(
        "florin-llm-tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.checkpoint.dir": folder,
        },
    )
    session.sparkContext.setLogLevel("OFF")
    ship_package(session)
    yield session
    session.stop()


DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture
def make_documents(spark):
    """Documents from (doc_id, text) or longer tuples."""

    def make(rows):
        full = [tuple(r) + (None,) * (5 - len(r)) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return make
