import __spark_entry__ as entry_module
from workload.oracles import ORACLES
from workload.queries import QUERIES


def test_entry(spark):
    got = entry_module.entry(spark)
    assert got.columns == ["series_id", "year", "summed_value"]
    assert got.count() > 0


def test_contract():
    assert entry_module.oracle_sql().keys() <= entry_module.queries().keys()
    assert set(QUERIES) <= set(ORACLES) & set(entry_module.queries())
    assert not any(" " in name for name in entry_module.queries())
