import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from freshet.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = local_session(4, "tests", 4, **{"spark.checkpoint.dir": str(shared / "checkpoints"), "spark.sql.warehouse.dir": str(shared / "tables")})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted(tuple(r) for r in picked.collect())
