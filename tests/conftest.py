import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyframe.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("star-schema tables not present")
    return path


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def rows(df, *columns):
    """Rows as plain tuples, in an order that does not depend on partitioning."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, str(v)) for v in r])


def exchanges(df) -> int:
    """Shuffles in the plan as it was before anything ran."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    return plan.count("Exchange hashpartitioning")
