"""Queries against their SQL on small tables of what the smallest test tables lack and larger ones hold."""

from collections import Counter

import duckdb
import pytest

from kinetrail.plans import catalog


@pytest.fixture
def compared(spark, tmp_path):
    """Whether a query's rows on a made table of events are those of its SQL; one thread, so that the SQL breaks ties in one way."""

    def run(name: str, events: str) -> list[tuple]:
        con = duckdb.connect(config={"threads": 1})
        con.execute(f"CREATE TABLE events AS SELECT event_id::BIGINT AS event_id, ts::TIMESTAMP AS ts, user_id::BIGINT AS user_id, event_type::VARCHAR AS event_type, value::DOUBLE AS value, props::VARCHAR AS props FROM ({events})")
        con.execute(f"COPY events TO '{tmp_path}/events.parquet' (FORMAT parquet)")
        df = catalog.QUERIES[name](spark, str(tmp_path))
        cursor = con.execute(catalog.ORACLE_SQL[name])
        names = [d[0] for d in cursor.description]
        got, want = [tuple(r) for r in df.select(*names).collect()], cursor.fetchall()
        assert Counter(got) == Counter(want)
        return got

    return run


def test_canonical_rows_of_slow_clocks(compared):
    """Steps of days are still seconds: the clock of a user with few events is not read as nanoseconds."""
    got = compared("canonical_rows", "SELECT i AS event_id, TIMESTAMP '2024-01-01' + INTERVAL (i * 30) HOUR AS ts, 7 AS user_id, 'view' AS event_type, i * 1.5 AS value, NULL AS props FROM range(0, 5) r(i)")
    assert len(got) == 433


def test_canonical_rows_just_after_a_frame(compared):
    """A row begins a frame up to one microsecond after it, not ten."""
    compared("canonical_rows", "SELECT i AS event_id, TIMESTAMP '2024-01-01' + INTERVAL (i * 1000000000 + [0, 4, 1, 9, 40, -4, -1, -40][i % 8 + 1]) MICROSECOND AS ts, u AS user_id, 'view' AS event_type, i * 1.5 AS value, NULL AS props FROM range(0, 12) r(i), range(0, 9) s(u)")


def test_quantiles_of_large_groups_are_exact(spark):
    """A group above the bound, of distinct values, of few values or of one, a small one, a tiny one and one without a key: as sorted values say."""
    import random

    from kinetrail.operators import stats

    rng = random.Random(5)
    groups = {
        "many": [rng.gauss(0, 50) for _ in range(30_000)],
        "few": [float(rng.randrange(-3, 40)) for _ in range(20_000)],
        "one": [2.5] * 12_000,
        None: [rng.expovariate(1) for _ in range(15_000)],
        "small": [rng.random() for _ in range(400)],
        "tiny": [3.0, -1.0],
    }
    rows = spark.createDataFrame([(k, [v, -v]) for k, values in groups.items() for v in values], "k string, v array<double>").repartition(7)
    got = {(r.k, r.dim): r for r in stats.column_stats(rows, ["k"], "v", exact_rows=10_000).collect()}
    assert len(got) == 2 * len(groups)
    for (k, dim), r in got.items():
        values = sorted(v if dim == 0 else -v for v in groups[k])
        for q, x in ((0.01, r.q01), (0.99, r.q99)):
            at = q * (len(values) - 1)
            low, high = values[int(at)], values[min(int(at) + 1, len(values) - 1)]
            assert x == pytest.approx(low + (high - low) * (at - int(at)), abs=1e-12), (k, dim, q)
        assert r["count"] == len(values)
    whole = stats.column_stats(rows, ["k"], "v", approximate=False).collect()
    assert all(got[r.k, r.dim].q99 == pytest.approx(r.q99, abs=1e-12) and got[r.k, r.dim].q01 == pytest.approx(r.q01, abs=1e-12) for r in whole)


def test_quantiles_with_bounds_that_miss_stop(spark):
    from kinetrail.operators import stats

    each = spark.range(1000).selectExpr("1 AS k", "CAST(id AS double) AS value")
    bounds = spark.createDataFrame([(1, [500.0, 600.0])], "k int, near array<double>")
    with pytest.raises(Exception, match="bounds miss a rank"):
        stats.quantiles(each, ["k"], "value", [0.01], bounds).collect()


def test_relative_action_stats_beyond_the_sketch(compared, monkeypatch):
    """With groups of few values counting as large, the quantiles are those of the SQL."""
    from kinetrail.operators import stats

    kept = stats.column_stats
    monkeypatch.setattr(stats, "column_stats", lambda *a, **b: kept(*a, **b, exact_rows=10_000))
    compared("relative_action_stats", "SELECT i AS event_id, TIMESTAMP '2024-01-01' + INTERVAL (i * 7) SECOND AS ts, i % 45 AS user_id, 'view' AS event_type, round((i * 7919 % 100003) ** 1.3 / 1000, 2) AS value, NULL AS props FROM range(0, 30000) r(i)")


def test_interval_coalesce_of_odd_events(compared):
    """Days before 1970, negative, fractional and missing numbers, users and types without a name, repeated spans."""
    kinds = """['{"k": 5}', '{"k": -4}', '{"k": 2.5}', '{"k": null}', '{"j": 1}', NULL, '{"k": "7"}', '{"k": -2}', '{"k": -2.5}', '{"k": 1e2}'][i % 10 + 1]"""
    compared("interval_coalesce", f"SELECT i AS event_id, CASE WHEN i % 41 = 0 THEN NULL ELSE TIMESTAMP '1969-12-20' + INTERVAL (i * 5 % 600) HOUR END AS ts, CASE WHEN i % 7 < 6 THEN i % 7 END AS user_id, CASE WHEN i % 3 < 2 THEN 'view' END AS event_type, 0.0 AS value, {kinds} AS props FROM range(0, 600) r(i)")


def test_interval_coalesce_of_repeated_spans(spark):
    """Copies of a span that opens a group stay in it: no interval of the result touches another one."""
    from kinetrail.operators import intervals as iv

    rows = spark.createDataFrame([(k, a, a + 1 + a % 3) for k in range(40) for a in range(0, 400, 5) for _ in range(6)], "k int, start bigint, stop bigint").repartition(5)
    got = iv.coalesce(rows, ["k"]).collect()
    assert Counter((r.k, r.start, r.stop) for r in got) == Counter((k, a, a + 1 + a % 3) for k in range(40) for a in range(0, 400, 5))
