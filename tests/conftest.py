"""One local session for all tests, with its own folders."""

import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from footfall.schema import EVENT_SCHEMA  # noqa: E402
from footfall.session import build_session  # noqa: E402

EVENT_COLUMNS = f"{EVENT_SCHEMA}, event_ts TIMESTAMP, dt DATE, hour INT"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session(
        "footfall-tests",
        **{
            "spark.master": "local[4]",
            "spark.driver.memory": "4g",
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(folder / "checkpoint"),
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def events(spark):
    """Build an events frame from partial rows; times are HH:MM:SS on 2026-05-22."""

    names = [part.split()[0] for part in EVENT_COLUMNS.replace("\n", " ").split(",")]

    def build(*rows):
        full = []
        for i, row in enumerate(rows):
            row = {"event_id": f"E{i}", "event_type": "page_view", "user_id": "U1",
                   "session_id": "S1", "at": "10:00:00", **row}
            at = row.pop("at")
            if at is not None:
                stamp = at if " " in at else f"2026-05-22 {at}"
                when = datetime.fromisoformat(stamp + "+00:00")
                row |= {"event_ts": when, "dt": when.date(), "hour": when.hour}
            full.append([row.get(n) for n in names])
        return spark.createDataFrame(full, EVENT_COLUMNS)

    return build


def as_dicts(df):
    return [row.asDict(recursive=True) for row in df.collect()]
