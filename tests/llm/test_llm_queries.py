import pytest

from checks.compare import connect, rows_of
from vitrine.llm.oracles import ORACLES
from vitrine.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_its_sql(spark, name):
    df = QUERIES[name](spark, SF)
    mine = rows_of(df.columns, df.collect())
    if name in ORACLES:
        found = connect(SF).execute(ORACLES[name])
        columns = [c[0] for c in found.description]
        assert sorted(columns) == sorted(df.columns) and mine == rows_of(columns, found.fetchall())
    assert mine
