from __future__ import annotations

import sys
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from barwright.schemas import BARS, BRONZE  # noqa: E402
from barwright.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"
START = datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "barwright-tests", "6g")
    session.conf.set("spark.sql.shuffle.partitions", "4")
    yield session
    session.stop()


def at(hour: float) -> datetime:
    return START + timedelta(hours=hour)


@pytest.fixture(scope="session")
def make_bars(spark):
    """Bars from dicts: hour (from START) or datetime, close; the rest defaults."""

    def make(rows, versioned: bool = False):
        data = []
        for r in rows:
            close = r.get("close")
            base = 0.0 if close is None else float(close)
            row = (
                r.get("symbol", "a"),
                r.get("datetime") or at(r["hour"]),
                float(r.get("open", base)),
                float(r.get("high", base)),
                float(r.get("low", base)),
                None if close is None else float(close),
                r.get("volume", 1),
            )
            data.append(row + ((r.get("seq", 1),) if versioned else ()))
        return spark.createDataFrame(data, BRONZE if versioned else BARS)

    return make


def series(closes, volumes=None, symbol="a", hours=None):
    hours = hours or range(len(closes))
    volumes = volumes or [1] * len(closes)
    return [
        {"symbol": symbol, "hour": h, "close": c, "volume": v} for h, c, v in zip(hours, closes, volumes)
    ]


def column(df, name):
    return [r[name] for r in df.orderBy("symbol", "datetime").collect()]


def same_rows(a, b):
    """Equal as bags of rows, columns matched by name."""
    assert sorted(a.columns) == sorted(b.columns)
    signed = a.withColumn("_n", F.lit(1)).unionByName(b.withColumn("_n", F.lit(-1)))
    return signed.groupBy(*a.columns).agg(F.sum("_n").alias("_n")).filter("_n <> 0").isEmpty()
