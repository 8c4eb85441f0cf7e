import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from revlens.session import get_spark  # noqa: E402

SMOKE_SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[4]", 8, app="revlens-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def demo(spark):
    """The 12-row flat demo input (region, category, value, target, source)."""
    rows = [
        ("North", "A", 100, "B", "North"), ("North", "B", 150, "C", "North"),
        ("North", "C", 120, "A", "South"), ("South", "A", 200, "B", "South"),
        ("South", "B", 180, "C", "East"), ("South", "C", 190, "A", "East"),
        ("East", "A", 210, "B", "West"), ("East", "B", 240, "C", "West"),
        ("East", "C", 220, "A", "North"), ("West", "A", 270, "B", "North"),
        ("West", "B", 300, "C", "South"), ("West", "C", 280, "A", "South"),
    ]
    return spark.createDataFrame(rows, "region string, category string, value long, target string, source string")


@pytest.fixture(scope="session")
def demo_links(spark):
    """The 3-row demo input with links (a cycle A -> B -> C -> A)."""
    rows = [("A", 10, "A", "B", 5, "A"), ("B", 20, "B", "C", 15, "B"), ("C", 30, "C", "A", 25, "C")]
    return spark.createDataFrame(
        rows, "category string, value long, source string, target string, linkValue long, nodeId string")
