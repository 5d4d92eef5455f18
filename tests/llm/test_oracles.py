"""The corpus queries that SQL can say, against DuckDB on the same tables."""

import pytest

from overflight.llm.oracles import ORACLES
from overflight.llm.queries import QUERIES
from tests.test_oracle import SF_DIR, duck  # noqa: F401


def plain(rows):
    """Sorted tuples, numbers without their type and rounded to what sums in another order agree on."""
    return sorted(
        (tuple(round(v, 9) if isinstance(v, float) else v for v in row) for row in rows),
        key=lambda row: tuple((v is None, str(v)) for v in row))


def test_the_queries():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):  # noqa: F811
    got = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(ORACLES[name])
    names = [column[0] for column in expected.description]
    assert sorted(got.columns) == sorted(names)
    rows, wanted = plain(got.select(*names).collect()), plain(expected.fetchall())
    assert len(rows) == len(wanted) > 0
    assert rows == wanted
