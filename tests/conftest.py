import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

from dunlin.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("shared")
    session = build_session("dunlin-tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(root / "checkpoint"), "spark.sql.warehouse.dir": str(root / "warehouse")})
    session.sparkContext.setLogLevel("OFF")
    return session


@pytest.fixture(scope="session")
def data_dir():
    folder = Path("/root/testdata/sf0.01")
    if not folder.exists():
        pytest.skip("test tables are not present")
    return str(folder)


def values(df, *columns):
    """Rows as a sorted list of tuples."""
    names = columns or df.columns
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)
