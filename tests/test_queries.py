import pytest

import oracle_check
from __spark_entry__ import entry, oracle_sql, queries
from lexitab.plans import fixtures

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return oracle_check.connect(SF)


@pytest.mark.filterwarnings("ignore:index size mismatch")
@pytest.mark.parametrize("name", queries())
def test_query_equals_its_sql(spark, duck, name):
    frame = queries()[name](spark, SF)
    got = frame.toPandas()
    assert len(got) > 0
    if name in oracle_sql():
        twin = duck.execute(oracle_sql()[name])
        assert oracle_check.type_difference(frame.dtypes, twin.description) is None
        assert oracle_check.difference(got, twin.fetch_df()) is None


def test_range_lookup_makes_its_inputs_once(spark, monkeypatch):
    made, table = [], fixtures.dictionary_table
    monkeypatch.setattr(fixtures, "dictionary_table", lambda *a: made.append(a) or table(*a))
    assert queries()["range_lookup"](spark, SF).columns == ["request_id", "key", "found", "value"]
    assert len(made) == 1


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).columns == ["title", "status", "byte_offset", "byte_length"]
