import pytest

from lakelayer.llm.queries import ORACLE_SQL, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_its_sql(spark, sf_small, name):
    from tools.compare import compare, duck

    found = compare(spark, duck(sf_small), name, QUERIES[name], ORACLE_SQL[name], sf_small)
    assert found["ok"], found["note"]


def test_every_operator_is_registered():
    import __spark_entry__ as entry

    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
