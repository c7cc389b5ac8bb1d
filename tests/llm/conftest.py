import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from freshet.session import tune  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session", autouse=True)
def prepared(spark):
    return tune(spark)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}
