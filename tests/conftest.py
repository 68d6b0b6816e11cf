import sys
from datetime import datetime
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

from wayfare import schema as S  # noqa: E402
from wayfare.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "wayfare-tests",
        "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.sql.maxMetadataStringLength": "100000"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def ws(spark, sf_dir):
    from wayfare.plans.workspace import workspace

    return workspace(spark, sf_dir)


def moment(text: str) -> datetime:
    return datetime.fromisoformat(text)


@pytest.fixture(scope="session")
def sample_trips(spark):
    """Five valid trips: morning rush, afternoon, after midnight, New Year's Eve, holiday noon. Fixed values."""
    rows = [
        ("2025-01-15 08:00", "2025-01-15 08:25", 132, 236, 2.5, 12.5, 16.0, 1.0, 1.0, 1.0, "N"),
        ("2025-03-20 14:30", "2025-03-20 14:52", 161, 170, 3.1, 15.0, 19.5, 2.0, 1.0, 1.0, "N"),
        ("2025-06-01 00:15", "2025-06-01 00:30", 237, 161, 1.2, 7.5, 10.0, 1.0, 2.0, 1.0, "N"),
        ("2025-12-31 17:45", "2025-12-31 18:20", 48, 113, 8.7, 35.0, 42.0, 3.0, 1.0, 2.0, "N"),
        ("2025-07-04 12:00", "2025-07-04 12:45", 138, 264, 15.0, 55.0, 65.0, 1.0, 1.0, 2.0, "Y"),
    ]
    return spark.createDataFrame([(moment(a), moment(b), *rest) for a, b, *rest in rows], S.TRIP_SCHEMA)


@pytest.fixture
def one_trip(spark):
    """One valid trip of 15 minutes with fields replaced as given."""

    def make(minutes: float = 15.0, **changes):
        values = {
            S.PICKUP: moment("2025-01-15 08:00"),
            S.DROPOFF: moment("2025-01-15 08:00"),
            S.PU: 132,
            S.DO: 236,
            S.DISTANCE: 2.5,
            S.FARE: 12.5,
            S.TOTAL: 16.0,
            S.PASSENGERS: 1.0,
            S.PAYMENT: 1.0,
            S.RATE: 1.0,
            S.FLAG: "N",
            **changes,
        }
        from datetime import timedelta

        values[S.DROPOFF] = values[S.PICKUP] + timedelta(minutes=minutes)
        return spark.createDataFrame([tuple(values[c] for c in S.TRIP_COLUMNS)], S.TRIP_SCHEMA)

    return make


def executed_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
