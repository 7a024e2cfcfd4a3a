import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = oracle.session(cores=4, codegen=False)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def duck():
    return oracle.connect(SF)


@pytest.fixture(scope="session")
def small(spark):
    """A little table with every kind of column: numeric, nominal, boolean, missing values, two classes, times."""
    import random

    rng = random.Random(7)
    rows = []
    for i in range(240):
        a, b = rng.randint(0, 20) / 2, rng.random()
        color, flag = rng.choice(["red", "green", "blue", None]), rng.random() < 0.4
        if i % 17 == 0:
            a = None
        if i % 23 == 0:
            b = float("nan")
        y = "yes" if (a or 0) > 4 and color != "red" or rng.random() < 0.1 else "no"
        value = 3.0 * (a or 0) + (5 if color == "blue" else 0) + rng.gauss(0, 1)
        days = float(rng.randint(1, 60) if y == "yes" else rng.randint(20, 120))
        rows.append((i, a, b, color, flag, y, value, days, int(rng.random() < 0.7)))
    schema = "id long, a double, b double, color string, flag boolean, y string, value double, days double, died int"
    return spark.createDataFrame(rows, schema).repartition(3).cache()
