import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

@pytest.fixture(scope="session")
def spark():
    from tools.check import session

    return session()


@pytest.fixture(scope="session")
def tables(spark):
    from catalogue.base import Tables
    from tools.check import SMALL_SF

    return Tables(spark, SMALL_SF)


@pytest.fixture(scope="session")
def near(tables):
    """The 15 nearest neighbours of the vector table, computed once."""
    from tallyweave.operators.neighbors import knn

    return knn(tables.emb, 15)


@pytest.fixture(scope="session")
def edges(near):
    from tallyweave.operators.neighbors import snn
    from tallyweave.operators.scale import materialise

    return materialise(snn(near, k=10))
