from datetime import date, datetime
from decimal import Decimal

import pytest

from checks.compare import local_session
from nightledger import schemas


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def moment(text):
    return datetime.fromisoformat(text)


def version(bkg_num=1, load="2025-03-01", arrival="2025-03-10", departure="2025-03-12", status=0, room_typ=1,
            rate="100.00", other_rate="80.00", hotel_id=7, price_group=5, rooms=1):
    """A reservation version; by default a two-night stay that counts."""
    return (
        bkg_num, moment(load), date.fromisoformat(arrival), date.fromisoformat(departure), status, room_typ,
        rate and Decimal(rate), other_rate and Decimal(other_rate), hotel_id, price_group, rooms,
    )


@pytest.fixture
def tables(spark):
    """Builds the four ROB tables from a few rows."""

    def build(versions, hotels=((7, "H7", 40, "Owned"),), bridge=((1, 3),), segments=((3, "Web", "Leisure"),)):
        return (
            spark.createDataFrame(list(versions), schemas.RESERVATIONS),
            spark.createDataFrame(list(hotels), schemas.HOTELS),
            spark.createDataFrame(list(bridge), schemas.BRIDGE),
            spark.createDataFrame(list(segments), schemas.SEGMENTS),
        )

    return build
