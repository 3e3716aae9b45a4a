import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tickstone.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.checkpoint.dir": str(root / "shared"),
            "spark.sql.warehouse.dir": str(root / "warehouse"),
            "spark.driver.extraJavaOptions": f"-Dderby.system.home={root / 'derby'}",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def rows(df, *columns):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)
