import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from assetweave.session import session

    settings = {
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "6g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    }
    spark = session("tests", "local[4]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def make_bars(spark):
    """Bars of one or more assets from lists of closes; days count up from 2020-01-01."""
    import datetime as dt

    from assetweave import schemas

    def make(closes: dict, opens=None, volumes=None):
        rows = []
        for ticker, values in closes.items():
            for i, close in enumerate(values):
                day = dt.date(2020, 1, 1) + dt.timedelta(days=i)
                open_ = opens[ticker][i] if opens else close
                volume = volumes[ticker][i] if volumes else 100.0
                rows.append((ticker, "C", day, open_, close, close, close, volume, 0.0))
        return spark.createDataFrame(rows, schemas.BARS)

    return make
