import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyloom.session import local_session  # noqa: E402
from tallyloom.spec import TELCO  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", "4")
    yield session
    session.stop()


@pytest.fixture
def account():
    """One valid telecom record: the last value of each domain, the middle of each range."""
    middle = {c: (low + high) // 2 for c, (low, high) in TELCO.raw_bounds.items()}
    total = middle["tenure"] * middle["MonthlyCharges"]
    numbers = {**middle, "TotalCharges": total, **{c: 1 for c in TELCO.flags}}
    record = {"customerID": "TEST-0001", **{c: v[-1] for c, v in TELCO.domains.items()}, **numbers}
    return {c: str(v) for c, v in record.items()}


@pytest.fixture
def accounts(spark, account):
    """Builds a table from the valid record with overrides, all columns text."""

    def build(*overrides):
        rows = [
            {**account, "customerID": f"TEST-{i:04d}", **o} for i, o in enumerate(overrides)
        ]
        schema = ", ".join(f"`{c}` string" for c in account)
        return spark.createDataFrame([tuple(r[c] for c in account) for r in rows], schema)

    return build
