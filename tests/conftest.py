import os
import sys
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickloom.schema import TICK_SCHEMA  # noqa: E402
from tickloom.session import build_session  # noqa: E402

NOON = datetime(2026, 5, 29, 12, tzinfo=timezone.utc)


@pytest.fixture(scope="session")
def spark():
    os.environ["TZ"] = "UTC"
    session = build_session("local[4]", 4, **{"spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_ticks(spark):
    """Ticks from dicts that name only what differs from a plain tick; `at` is seconds after noon."""

    def make(rows):
        schema = TICK_SCHEMA.jsonValue()["fields"]
        ddl = ", ".join(f"{f['name']} {f['type']}" for f in schema).replace("short", "smallint")
        ddl = ddl.replace("long", "bigint") + ", arrival_seq bigint"
        data = []
        for seq, row in enumerate(rows):
            data.append(
                (
                    row.get("exchange", 1),
                    row.get("symbol", "BTCUSDT"),
                    Decimal(row.get("price", "50000.25")),
                    Decimal(row.get("volume", "0.5")),
                    row.get("exchange_ts", NOON),
                    row.get("source_id", 1),
                    NOON + timedelta(seconds=row.get("at", 0)),
                    row.get("arrival_seq", seq),
                )
            )
        return spark.createDataFrame(data, ddl)

    return make
