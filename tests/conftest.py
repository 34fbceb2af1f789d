import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))


@pytest.fixture(scope="session")
def spark():
    from tickloom.session import drop_scratch, local_session

    session = local_session(os.environ.get("TEST_CPUS", "8"), shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def ticks(spark, sf_dir):
    from tickloom.sources.ticks import read_ticks

    return read_ticks(spark, sf_dir)


TICK_SCHEMA = (
    "id long, symbol string, event_type string, price double, quantity double, event_time_ms long, "
    "ingest_time_ms long, trade_id long, is_buyer_maker boolean"
)


@pytest.fixture
def tape(spark):
    """Build ticks from (time offset ms, price[, quantity[, symbol]]) rows; ids follow the order given."""

    def build(rows, start=1_704_067_200_000, first_id=1):
        data = []
        for i, row in enumerate(rows):
            offset, price, quantity, symbol = (*row, *(1.0, "BTCUSDT")[len(row) - 2:])
            t = start + offset
            data.append((first_id + i, symbol, "trade", float(price), float(quantity), t, t + 5, first_id + i, False))
        return spark.createDataFrame(data, TICK_SCHEMA)

    return build
