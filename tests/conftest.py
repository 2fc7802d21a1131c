import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from provisio.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def scored(spark):
    """Scores that carry signal, with ties, one hot score and some missing values."""
    n = 4000
    return spark.sql(f"""
        select id as sk_id_curr, case when id % 3 = 0 then 0.25 else ((id * 7919) % 499) / 499e0 end as pred_prob,
          case when (id * 104729) % 1000 < 1000 * (0.05 + 0.6 * (case when id % 3 = 0 then 0.25 else ((id * 7919) % 499) / 499e0 end)) then 1 else 0 end as target,
          case when id % 41 = 0 then null else 1000e0 + id end as amt_credit
        from range({n})""")
