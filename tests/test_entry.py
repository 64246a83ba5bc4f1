import __spark_entry__ as entry
from pagewright.plans import oracle
from pagewright.plans.queries import CATALOGUE


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_queries_and_sql_go_together():
    assert set(oracle.SQL) <= set(CATALOGUE) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
