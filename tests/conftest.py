from __future__ import annotations

import datetime as dt
import os
import sys
from decimal import Decimal

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from storepulse import metrics as M  # noqa: E402
from storepulse import schemas  # noqa: E402
from storepulse.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = local_session("*", app="storepulse-tests", extra={
        "spark.sql.shuffle.partitions": "8",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    yield s
    s.stop()


def d(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def base_row(report_date: str, store: str = "S1", **values) -> dict:
    """One store-day row: keys from the arguments, every measure 0 unless given."""
    day = d(report_date)
    row = {
        "report_date": day,
        "ly_date": day - dt.timedelta(days=M.LY_SHIFT_DAYS),
        "app_key": 1,
        "profit_center": "101",
        "custom_key": f"{day};{store}",
        "filter_level": "Store",
        "segment": store,
        "store_name": store,
        "region": "East",
        "market": "M1",
    }
    for c in M.ADDITIVE_MEASURES:
        row[c] = 0 if c in M.COUNT_MEASURES else Decimal("0.00")
    for k, v in values.items():
        if k in M.ADDITIVE_MEASURES and k not in M.COUNT_MEASURES and v is not None:
            v = Decimal(str(v))
        row[k] = v
    return row


@pytest.fixture
def make_base(spark):
    def make(rows):
        data = [tuple(r[f.name] for f in schemas.REPORT_BASE.fields) for r in rows]
        return spark.createDataFrame(data, schemas.REPORT_BASE)
    return make


@pytest.fixture
def make_lookup(spark):
    def make(rows):
        return spark.createDataFrame(rows, schemas.STORE_LOOKUP)
    return make


@pytest.fixture(autouse=True)
def no_views_left(request):
    """Views of a test are dropped after it: the session is shared, and a catalog lists them with every database's tables."""
    yield
    if "spark" in request.fixturenames:
        session = request.getfixturevalue("spark")
        for t in session.catalog.listTables():
            if t.isTemporary:
                session.catalog.dropTempView(t.name)
