import random
from datetime import date

from pyspark.sql import functions as F

from vulnlake.functions import checks, hashing, nested, risk, times


def _values(spark, values, ddl, expr):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {ddl}")
    return [r[0] for r in rows.orderBy("i").select(expr(F.col("v"))).collect()]


def test_round_binary_equals_exact_rounding(spark):
    random.seed(7)
    values = [i * 5 / 1000 for i in range(2101)] + [random.uniform(0, 100) for _ in range(2000)]
    assert _values(spark, values, "double", lambda v: risk.round_binary(v, 2)) == [round(v, 2) for v in values]
    assert _values(spark, values, "double", lambda v: risk.round_binary(v, 1)) == [round(v, 1) for v in values]


def test_percentile_and_priority(spark):
    cuts = [float(i) for i in range(101)]
    scores = [-1.0, 0.0, 0.5, 14.0, 99.5, 100.0, 200.0] + [float(i) for i in range(101)]
    rows = spark.createDataFrame([(i, s, cuts) for i, s in enumerate(scores)], "i int, s double, c array<double>")
    got = rows.orderBy("i").select(risk.percentile_of(F.col("s"), F.col("c")).alias("p")).select(
        "p", risk.priority(F.col("p"))
    )
    for score, (p, q) in zip(scores, got.collect()):
        want = round(100.0 * sum(c <= score for c in cuts) / 101, 2)
        assert (p, q) == (want, round(want / 10.0, 2))
    empty = spark.createDataFrame([(1.0, [])], "s double, c array<double>")
    assert empty.select(risk.percentile_of(F.col("s"), F.col("c"))).first()[0] == 0.0


def test_within_horizon(spark):
    got = _values(spark, [None, -1, 0, 1, 7, 8], "int", lambda v: risk.within_horizon(v, 7))
    assert got == [0, None, None, 1, 1, 0]


def test_blended_score_without_cvss_has_no_cvss_term(spark):
    row = spark.createDataFrame([(None, 0.5, 0.25)], "c double, p double, q double")
    assert row.select(risk.blended_score(F.col("c"), F.col("p"), F.col("q"), 0.2, 0.3, 0.5)).first()[0] == 2.75


def test_parse_ts(spark):
    good = [
        "2024-01-02T03:04:05.123456Z", "2024-01-02T03:04:05.123+02:00", "2024-01-02T03:04:05Z",
        "2024-01-02T03:04:05.123456", "2024-01-02T03:04:05.123", "2024-01-02T03:04:05",
    ]
    bad = ["2024-01-02", "2024-01-02T03:04:05.123456789Z", "", None, "x", "2024-13-02T03:04:05Z"]
    got = _values(spark, good + bad, "string", lambda v: times.parse_ts(v).cast("string"))
    assert got[0] == "2024-01-02 03:04:05.123456" and got[1] == "2024-01-02 01:04:05.123"
    assert all(g is not None for g in got[:6]) and got[6:] == [None] * 6


def test_parse_rfc3339(spark):
    texts = [
        "2024-01-02T03:04:05.987654321Z", " 2024-01-02T03:04:05Z ", "2024-01-02T03:04:05.5+05:30",
        "2024-01-02T03:04:05", "2024-01-02", "2024", "T03:04", "2024-02-30T00:00:00Z", None,
    ]
    got = _values(spark, texts, "string", lambda v: times.millisecond_text(times.parse_rfc3339(v)))
    assert got == [
        "2024-01-02T03:04:05.987", "2024-01-02T03:04:05.000", "2024-01-01T21:34:05.500",
        "2024-01-02T03:04:05.000", "2024-01-02T00:00:00.000", None, None, None, None,
    ]


def test_parse_date(spark):
    got = _values(spark, ["2024-06-01T00:00:00+0000", "2024-13-40", "2024-6-1", None, ""], "string", times.parse_date)
    assert got == [date(2024, 6, 1), None, None, None, None]


def test_checks(spark):
    ids = ["CVE-2024-0001", "CVE-2024-123456", "CVE-24-1", "CVE-2024-001", "cve-2024-0001", None, ""]
    assert _values(spark, ids, "string", checks.bad_id) == [False, False, True, True, True, True, True]
    got = _values(spark, [0.0, 10.0, 10.1, -0.1, None], "double", lambda v: checks.out_of_range(v, 0.0, 10.0))
    assert got == [False, False, True, True, False]
    rules = lambda v: checks.first_reason([("a", v > 2), ("b", v > 1)])
    assert _values(spark, [3, 2, 1, None], "int", rules) == ["a", "b", None, None]


def test_hash_ignores_run_and_column_order_but_not_content(spark):
    def ids(rows, ddl, run):
        df = spark.createDataFrame([(r,) for r in rows], f"payload struct<{ddl}>")
        out = hashing.wrap(
            df, source="kev", record_id=F.lit("r"), effective_date=F.lit("2024-01-01").cast("date"),
            payload="payload", run_id=run, fetched_at=F.lit("t"),
        ).collect()
        return [(r["event_id"], r["payload_sha256"]) for r in out]

    a = ids([{"x": "1", "y": None}], "x:string,y:string", "run1")
    b = ids([{"y": None, "x": "1"}], "y:string,x:string", "run2")
    c = ids([{"x": "1", "y": "2"}], "x:string,y:string", "run1")
    assert a == b and a != c


def test_nested(spark):
    rows = spark.createDataFrame(
        [(1, [("a", "1"), ("p", "2"), ("p", "3")]), (2, [("a", "1")]), (3, []), (4, None)],
        "i int, xs array<struct<t:string,v:string>>",
    )
    p = lambda x: x["t"] == "p"
    got = rows.orderBy("i").select(
        nested.best_of(F.col("xs"), p)["v"], nested.last_of(F.col("xs"), p)["v"], nested.length_of(F.col("xs"))
    )
    assert [tuple(r) for r in got.collect()] == [("2", "3", 3), ("1", None, 1), (None, None, 0), (None, None, 0)]
