import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tapelake.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores=8, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def market(spark):
    from tapelake.sources.views import Market

    return Market(spark, SMALL)


@pytest.fixture
def rows():
    """Collect a DataFrame as sorted tuples of the named columns."""

    def collect(df, *columns):
        got = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
        return sorted(got, key=lambda r: tuple((x is None, str(type(x)), x) if x is not None else (True, "", 0) for x in r))

    return collect


TRADE_SCHEMA = (
    "trade_id string, symbol string, price double, quantity int, is_aggressive_buy boolean, timestamp timestamp, "
    "buyer_agent_id string, seller_agent_id string, company_name string, sector string"
)


@pytest.fixture
def make_trades(spark):
    """Trades from (symbol, seconds after 2024-01-02 10:00, price, quantity[, buy]) tuples."""
    from datetime import datetime, timedelta

    def make(items):
        data = []
        for i, (symbol, seconds, price, quantity, *rest) in enumerate(items):
            at = datetime(2024, 1, 2, 10) + timedelta(seconds=seconds)
            buy = rest[0] if rest else i % 2 == 0
            data.append(
                (f"T{i:06d}", symbol, float(price), quantity, buy, at, f"B{i % 5}", f"S{i % 3}", symbol + " Inc", "Tech")
            )
        return spark.createDataFrame(data, TRADE_SCHEMA)

    return make
