import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from contractgate.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=8, app="contractgate-tests")
    yield s
    s.stop()


GOOD_CUSTOMERS = {
    "customer_id": ["CUST_00000001", "CUST_00000002"],
    "first_name": ["Ada", "Grace"],
    "last_name": ["Lovelace", "Hopper"],
    "age": [36, 45],
    "annual_income": [80000.0, 95000.0],
    "credit_score": [720, 780],
    "dti": [0.25, 0.18],
    "segment": ["mass", "affluent"],
    "join_date": ["2020-01-15", "2019-06-30"],
    "home_branch_id": ["BR_00000001", "BR_00000002"],
}


@pytest.fixture
def good_customers():
    import pandas as pd
    return pd.DataFrame(GOOD_CUSTOMERS)
