from pathlib import Path

import duckdb
import pytest

from wordloom.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, name):
    db = duckdb.connect()
    for file in Path(sf).glob("*.parquet"):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    got = QUERIES[name](spark, sf)
    result = db.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(got.columns)
    want = [tuple(row[names.index(c)] for c in got.columns) for row in result.fetchall()]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
