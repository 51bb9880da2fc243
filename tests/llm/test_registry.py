import pytest

import __spark_entry__ as contract

TINY = "/root/testdata/sf0.001"
TABLES = {"op1": "documents", "op2": "pages", "op4": "documents", "op5": "documents", "op7": "documents",
          "op8": "documents", "op9": "documents", "op10": "documents"}
NAMES = sorted(n for n in contract.queries() if n.startswith("op"))


def test_thirteen_operators_and_the_pipeline_are_registered():
    assert [n.split("_")[0] for n in sorted(NAMES, key=lambda n: int(n[2:].split("_")[0]))] == [
        f"op{i}" for i in range(1, 14)]
    assert "pipeline" in contract.queries()


@pytest.mark.parametrize("name", NAMES)
def test_queries_return_a_row_for_each_row_of_their_table(spark, name):
    rows = contract.queries()[name](spark, TINY)
    table = TABLES.get(name.split("_")[0])
    if table:
        assert rows.count() == spark.read.parquet(f"{TINY}/{table}.parquet").count()
    else:
        assert rows.count() > 0
