import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from quernel.session import get_spark

    session = get_spark(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.default.parallelism": "3",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def small():
    return SMALL


def rows(df, *columns):
    """Rows as sorted tuples."""
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def plan_of(df, mode="formatted"):
    """Text of ``df.explain``."""
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()
