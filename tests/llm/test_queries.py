"""Every query on odd rows and on empty tables; those with SQL against their SQL."""

import pytest

from keyline.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_on_odd_rows(spark, odd, oracle, result, name):
    assert result(QUERIES[name](spark, odd)) == oracle(ORACLES[name], odd)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty, name):
    assert QUERIES[name](spark, empty).collect() == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op8_decontamination", "op9_warc", "op11_whitening"}))
def test_one_row_per_document(spark, odd, name):
    from helpers import odd_rows

    got = sorted((r["doc_id"] for r in QUERIES[name](spark, odd).collect()), key=repr)
    assert got == sorted((r[0] for r in odd_rows()), key=repr)
