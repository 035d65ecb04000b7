import os
import sys
from datetime import datetime, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import types as T  # noqa: E402

from vantrail.schema import TELEMETRY  # noqa: E402
from vantrail.session import local_session  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8)
    yield session
    session.stop()


def at(text: str) -> datetime:
    moment = datetime.fromisoformat(text if "T" in text else f"2025-01-01T{text}")
    return moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)


OBSERVED = T.StructType([T.StructField(f.name, f.dataType) for f in TELEMETRY.fields]).add("seq", T.LongType())
DEFAULTS = dict(origin_country="GB", position_source="ADSB", lat=51.5, lon=-0.1, on_ground=False, spi=False)


@pytest.fixture
def observations(spark):
    """DataFrame of observations from dicts; arrival order is the list order."""

    def make(*rows):
        filled = []
        for i, row in enumerate(rows):
            row = {**DEFAULTS, "event_id": f"e{i}", "icao24": "abc123", "observed_at": at("10:00:00"), "seq": i, **row}
            filled.append(tuple(row.get(c) for c in OBSERVED.fieldNames()))
        return spark.createDataFrame(filled, OBSERVED)

    return make
