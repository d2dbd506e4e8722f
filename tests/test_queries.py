import pytest

import __spark_entry__ as entry_points
from oracle import connect, duck_rows, normal, spark_rows

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", [q.__name__ for q in entry_points._QUERIES])
def test_query_matches_its_twin(spark, duck, name):
    got = normal(*spark_rows(entry_points.queries()[name](spark, SF)))
    want = normal(*duck_rows(duck, entry_points.oracle_sql()[name]))
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
    assert got[1]


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() > 0


def test_stores_go_to_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert entry_points._scratch(spark).startswith(shared + "/")
