from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marketframe.schemas import TABLES  # noqa: E402
from marketframe.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, app="tests", memory="6g")
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """Rows of a stored table from dicts; absent columns are NULL, ISO text becomes dates."""

    def build(name: str, *rows: dict):
        schema = TABLES[name].schema

        def value(row: dict, field):
            v = row.get(field.name)
            if isinstance(v, str) and field.dataType.typeName() == "date":
                return dt.date.fromisoformat(v)
            return v

        return spark.createDataFrame([tuple(value(r, f) for f in schema) for r in rows], schema)

    return build


@pytest.fixture
def calendar(table):
    def build(*days: str, closed: tuple[str, ...] = ()):
        return table(
            "trade_cal", *[{"cal_date": d, "is_open": 1} for d in days], *[{"cal_date": d, "is_open": 0} for d in closed]
        )

    return build


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def rows(df, *order: str) -> list[tuple]:
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
