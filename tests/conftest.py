import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="6g",
        spark__ui__enabled="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def log(spark):
    """300 rows of 6 users and 12 items; user u0 holds a third, seconds tie, some ratings are NULL."""
    import random

    random.seed(3)
    rows = []
    for i in range(300):
        user = "u0" if i % 3 == 0 else f"u{random.randint(1, 5)}"
        rating = None if i % 17 == 0 else float(random.randint(1, 5))
        rows.append((user, f"i{random.randint(0, 11)}", rating, 1_600_000_000 + random.randint(0, 60) * 43_200))
    df = spark.createDataFrame(rows, "user_id string, parent_asin string, rating double, sec bigint")
    return df.selectExpr("user_id", "parent_asin", "rating", "timestamp_seconds(sec) as timestamp")
