import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from martwright.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        4, "4g", **{"spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))}
    )
    yield session
    session.stop()


def rows(df, *columns):
    """Rows as tuples in a stable order."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple(map(str, r)))


def same(left, right):
    columns = sorted(left.columns)
    assert columns == sorted(right.columns)
    assert rows(left, *columns) == rows(right, *columns)
