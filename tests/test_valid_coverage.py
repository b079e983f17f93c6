from tests.test_queries import DATA, duck, plain, pytestmark  # noqa: F401
from tickloom.plans import q_books


def test_coverage_follows_the_continuity_rule(spark, duck):  # noqa: F811
    windows = q_books.ORACLES["e19_valid_coverage"].split("\nn AS", 1)[1]
    sql = f"WITH {q_books._valid_sql('e4a_link')}, a AS (SELECT instrument_key, time_ns, arg_max(valid, seq) AS valid FROM val GROUP BY 1, 2), n AS{windows}"
    want = duck.sql(sql)
    got = q_books.e19_valid_coverage(spark, DATA).select(*want.columns).collect()
    assert sorted(tuple(map(plain, r)) for r in got) == sorted(tuple(map(plain, r)) for r in want.fetchall())
