"""Property tests: Spark operators against small pure-Python models."""

import datetime as dt

from hypothesis import HealthCheck, given, settings, strategies as st

from ratingsmith.operators import clean

ROW = st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.integers(0, 3),
                st.one_of(st.none(), st.sampled_from([0.0, 0.5, 2.0, 4.5, 5.0, 5.5, 9.0])),
                st.one_of(st.none(), st.integers(0, 200_000)))


def _model(rows):
    best = {}
    for u, m, r, t in rows:
        if u is None or r is None or t is None or not (0.5 <= r <= 5.0):
            continue
        k = (u, m)
        if k not in best or (t, r) > best[k]:
            best[k] = (t, r)
    out = set()
    for (u, m), (t, r) in best.items():
        d = dt.date(1970, 1, 1) + dt.timedelta(days=t // 86400)
        out.add((u, m, r, t, d, d.year))
    return out


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(ROW, max_size=30))
def test_clean_ratings_matches_model(spark, rows):
    df = spark.createDataFrame(rows, "userId int, movieId int, rating double, timestamp long")
    got = {tuple(r) for r in clean.clean_ratings(df).collect()}
    assert got == _model(rows)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 2), st.sampled_from(["b (1999)", "a", "c (2001) x (2002)"]),
                          st.sampled_from(["A|B", "A|", "(no genres listed)"])), max_size=12))
def test_clean_items_one_row_per_id_least_title(spark, rows):
    df = spark.createDataFrame(rows, "movieId int, title string, genres string")
    got = {r.movieId: r.title for r in clean.clean_items(df).collect()}
    want = {}
    for i, t, g in rows:
        if g == "(no genres listed)":
            continue
        if i not in want or (t, g) < want[i]:
            want[i] = (t, g)
    assert got == {i: tg[0] for i, tg in want.items()}
