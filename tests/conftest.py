import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from hanok.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = build_session(
        "tests",
        "local[8]",
        spark_sql_shuffle_partitions="8",
        spark_ui_showConsoleProgress="false",
        spark_sql_warehouse_dir=f"file:{warehouse}",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=lambda r: tuple((v is None, str(v)) for v in r))
