"""Small inputs with known results: the semantic traps. Inputs and results here are fixed values that must match."""

import datetime

import pytest
from pyspark.sql import functions as F

from larkframe.functions import dates as dt
from larkframe.functions import tails
from larkframe.functions import text as tx
from larkframe.operators import reshape as rs
from larkframe.operators.grouping import attach, match_join
from larkframe.operators.ordering import positions, running
from larkframe.operators.quantiles import quantiles, value_table
from larkframe.operators.verbs import cut, factor, if_else
from larkframe.plans.aggregates import guarded_corr
from larkframe.sources import readers as rd


def one(df):
    return [tuple(r) for r in df.collect()]


def col1(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def test_if_else_null(spark):
    d = col1(spark, [1, 5, None], "int").select(if_else(F.col("x") > 3, "a", "b"))
    assert one(d) == [("b",), ("a",), (None,)]


def test_null_keys_match(spark):
    a = spark.createDataFrame([("k", 1), (None, 2)], "k string, a int")
    b = spark.createDataFrame([("k", 3), (None, 4)], "k string, b int")
    assert sorted(one(match_join(a, b, ["k"])), key=str) == [("k", 1, 3), (None, 2, 4)]


def test_six_joins(spark):
    c = spark.createDataFrame([(i,) for i in range(1, 6)], "id int")
    o = spark.createDataFrame([(i, n) for n, i in enumerate([1, 1, 2, 3, 4, 5, 5, 6])], "id int, n int")
    sizes = {how: c.join(o, "id", how).count() for how in ("inner", "left", "right", "full", "left_semi", "left_anti")}
    assert sizes == {"inner": 7, "left": 7, "right": 8, "full": 8, "left_semi": 5, "left_anti": 0}


def test_quantile_type7(spark):
    q = quantiles(col1(spark, [1.0, 2.0, 4.0, 10.0, None], "double"), [], "x", {"a": 0.25, "b": 0.5, "c": 1.0}).first()
    assert (q["a"], q["b"], q["c"]) == (1.75, 3.0, 10.0)


def test_weighted_quantile(spark):
    d = spark.createDataFrame([(1.0, 3), (5.0, 1)], "x double, w int")
    assert quantiles(d, [], "x", {"m": 0.5}, weight=F.col("w")).first()["m"] == 1.0


def test_cut_is_right_closed(spark):
    d = col1(spark, [0.0, 1.0, 1.5, 2.0, 3.0, None], "double")
    assert [r[0] for r in one(d.select(cut(F.col("x"), [0, 1, 2], ["a", "b"])))] == [None, "a", "b", "b", None, None]
    assert [r[0] for r in one(d.select(cut(F.col("x"), [0, 1, 2], ["a", "b"], include_lowest=True)))][0] == "a"


def test_factor_unknown_is_null(spark):
    assert one(col1(spark, ["a", "z"]).select(factor(F.col("x"), ["a", "b"]))) == [(1,), (None,)]


def test_constant_correlation_is_null(spark):
    d = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert d.agg(guarded_corr("x", "y")).first()[0] is None


def test_running_and_fill(spark):
    d = spark.createDataFrame([(i, i if i in (2, 5) else None, 1) for i in range(1, 8)], "i int, v int, n int")
    out = running(d, [], ["i"], s=("sum", "v"), f=("last", "v"), c=("count", "n")).orderBy("i")
    assert [r["f"] for r in out.collect()] == [None, 2, 2, 2, 5, 5, 5]
    assert [r["c"] for r in out.collect()] == [1, 2, 3, 4, 5, 6, 7]
    assert [r["s"] for r in out.collect()] == [None, 2, 2, 2, 7, 7, 7]


def test_dense_numbers_descend(spark):
    t = value_table(col1(spark, [3, 1, 3, 2], "int"), [], "x", descending=True).orderBy("dense")
    assert [(r["v"], r["n"], r["cum"], r["dense"]) for r in t.collect()] == [(3, 2, 2, 1), (2, 1, 3, 2), (1, 1, 4, 3)]


def test_separate_past_the_end(spark):
    p = F.split("x", "/")
    assert one(col1(spark, ["745/19987071", "3"]).select(F.get(p, F.lit(0)).try_cast("int"), F.get(p, F.lit(1)).try_cast("int"))) == [(745, 19987071), (3, None)]


def test_complete(spark):
    d = spark.createDataFrame([("A", "X", 1), ("A", "Y", 2), ("B", "X", 3)], "s string, p string, n int")
    assert sorted(one(rs.complete(d, ["s", "p"], {"n": 0}))) == [("A", "X", 1), ("A", "Y", 2), ("B", "X", 3), ("B", "Y", 0)]


def test_company_longer(spark):
    d = spark.createDataFrame([("a", 1, 2, 3, 4)], "company string, revenue_q1 int, costs_q1 int, revenue_q2 int, costs_q2 int")
    out = rs.longer_values(d, ["company"], {q: {"revenue": f"revenue_{q}", "costs": f"costs_{q}"} for q in ("q1", "q2")}, "quarter")
    assert sorted(one(out)) == [("a", "q1", 1, 2), ("a", "q2", 3, 4)]


def test_sensor_text(spark):
    d = col1(spark, ["temp:22.5;humidity:60"]).select(F.explode(F.split("x", ";")).alias("kv"))
    assert one(d.select(F.split("kv", ":")[0], F.split("kv", ":")[1].try_cast("double"))) == [("temp", 22.5), ("humidity", 60.0)]


def test_text(spark):
    d = col1(spark, ["  anne-marie  o'neil "])
    assert d.select(tx.title(tx.squish(F.col("x")))).first()[0] == "Anne-Marie O'neil"
    assert col1(spark, ["bANANA"]).select(tx.sentence(F.col("x"))).first()[0] == "Banana"
    assert col1(spark, ["a1b1"]).select(tx.replace_first(F.col("x"), "1", "-")).first()[0] == "a-b1"
    assert col1(spark, ["none"]).select(tx.extract(F.col("x"), "[0-9]+")).first()[0] is None
    assert col1(spark, ["+1 (555) 123-4567", "555.123.4567"]).select(tx.phone(F.col("x"))).collect()[0][0] == "(555) 123-4567"


def test_parse_number(spark):
    d = col1(spark, ["$50,000", "about 12.5 kg", "none", None]).select(rd.parse_number(F.col("x")))
    assert [r[0] for r in one(d)] == [50000.0, 12.5, None, None]


def test_na_tokens(spark):
    d = rd.cast_columns(rd.na_to_null(col1(spark, ["100", "200", "NA", "missing", "300"]), ["NA", "missing"]), {"x": "double"})
    assert [r[0] for r in one(d)] == [100.0, 200.0, None, None, 300.0]


def test_unknown_extension(spark):
    with pytest.raises(ValueError):
        rd.read_any(spark, "table.xyz")


def test_four_date_spellings(spark):
    d = col1(spark, ["2023-01-15", "01/15/2023", "15.01.2023", "Jan 15, 2023", "soon"])
    out = d.select(dt.first_format(F.col("x"), ["yyyy-MM-dd", "MM/dd/yyyy", "dd.MM.yyyy", "MMM d, yyyy"]))
    assert [str(r[0]) for r in one(out)] == ["2023-01-15"] * 4 + ["None"]


def day(spark, text):
    return col1(spark, [text]).select(F.col("x").cast("date").alias("x"))


def test_dates(spark):
    d = day(spark, "2023-06-15")
    x = F.col("x")
    got = d.select(F.date_add(x, 30), F.add_months(x, 2), F.add_months(x, 12), dt.ceiling(x, "week"), F.last_day(x), dt.floor(x, "year")).first()
    assert [str(v) for v in got] == ["2023-07-15", "2023-08-15", "2024-06-15", "2023-06-18", "2023-06-30", "2023-01-01"]
    assert str(day(spark, "2023-01-31").select(F.add_months(x, 1)).first()[0]) == "2023-02-28"
    assert day(spark, "2023-01-01").select(dt.week(x)).first()[0] == 1
    assert str(day(spark, "2023-06-18").select(dt.ceiling(x, "week")).first()[0]) == "2023-06-25"


def test_business_days(spark):
    x = F.col("x")
    start = day(spark, "2023-07-03")
    # a five-day task that starts on Monday ends on Friday: four business days later
    assert str(start.select(dt.add_business_days(x, F.lit(4))).first()[0]) == "2023-07-07"
    assert str(start.select(dt.add_business_days(x, F.lit(14))).first()[0]) == "2023-07-21"
    assert str(day(spark, "2023-07-08").select(dt.add_business_days(x, F.lit(0))).first()[0]) == "2023-07-08"
    for first in range(3, 10):
        for n in range(0, 13):
            d = datetime.date(2023, 7, first)
            want, left = d, n
            while left:
                want += datetime.timedelta(1)
                left -= want.weekday() < 5
            assert day(spark, str(d)).select(dt.add_business_days(x, F.lit(n))).first()[0] == want, (d, n)


def test_overlap_touching(spark):
    lit = lambda s: F.lit(s).cast("date")
    d = spark.range(1).select(dt.overlaps(lit("2023-01-01"), lit("2023-06-30"), lit("2023-06-30"), lit("2023-12-31")))
    assert d.first()[0] is True


def test_accumulate(spark):
    d = spark.range(5).select((F.col("id") + 1).alias("x"))
    assert [r["s"] for r in running(d, [], ["x"], s=("sum", "x")).orderBy("x").collect()] == [1, 3, 6, 10, 15]


def test_attach_whole_table(spark):
    assert {r["m"] for r in attach(col1(spark, [1.0, 3.0], "double"), [], m=F.avg("x")).collect()} == {2.0}


def test_positions_per_group(spark):
    d = spark.createDataFrame([("a", 3), ("a", 1), ("b", 2)], "g string, x int")
    assert sorted(one(positions(d, ["g"], ["x"]))) == [("a", 1, 1), ("a", 3, 2), ("b", 2, 1)]


def test_tails():
    assert abs(tails.t_two_sided(2.0, 10) - 0.07338803) < 1e-7
    assert abs(tails.f_upper(3.0, 2, 10) - 0.0953674316) < 1e-8  # (1 + 2 * 3 / 10) ** -5
    assert abs(tails.chisq_upper(3.841458820694124, 1) - 0.05) < 1e-9
    assert abs(tails.chisq_upper(30.0, 4) - (1 + 15) * 2.718281828459045**-15) < 1e-12
    assert abs(tails.t_quantile(0.975, 10) - 2.228138852) < 1e-7
    assert tails.ks_upper(0.0, 10, 10) == 1.0
    assert abs(tails.ks_upper(0.3, 50, 50) - 0.02221) < 1e-4


def test_constant_columns_are_no_division_by_zero(spark):
    from larkframe.learning import features as fe

    d = spark.createDataFrame([(i, 1.0, float(i), None if i == 4 else float(i)) for i in range(12)], "key long, c double, x double, gap double")
    scaled = {(r.c, r.x) for r in fe.min_max(["c", "x"])(d)(d).collect()}
    assert {c for c, _ in scaled} == {0.0} and max(x for _, x in scaled) == 1.0
    filled = fe.impute_knn("key", "gap", ["c", "x"], k=2)(d)(d).where("key = 4").first().gap
    assert filled == 4.0


def test_smote_of_a_small_class_gives_every_row(spark):
    from larkframe.learning import features as fe

    for few in (1, 3):
        d = spark.createDataFrame([(i, float(i), int(i >= few)) for i in range(20)], "key long, x double, y int")
        assert fe.smote(d, "key", "y", 0, ["x"]).count() == 20 - 2 * few


def test_stream_without_files_is_empty(spark, tmp_path):
    from larkframe.streaming import jobs

    rows = jobs.stream(spark, str(tmp_path), "a long, b string")
    assert jobs.run(rows, "append", "none").count() == 0


def test_streams_count_a_long_history(spark):
    """Half a year of events in files that each hold old and new rows: no query may drop a row as late."""
    from types import SimpleNamespace

    from larkframe import plans

    start = datetime.datetime(2024, 1, 1)
    data = [(i, start + datetime.timedelta(hours=12 * (i // 2), minutes=i % 2), i // 2 % 5, "ab"[i // 2 % 2], 1.0, "{}") for i in range(720)]
    events = spark.createDataFrame(data, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string").repartition(12)
    t = SimpleNamespace(spark=spark, events=events)
    got = {n: plans.QUERIES[n](t).collect() for n in ("st_event_counts", "st_monitor", "st_drift", "st_dedup_requests", "st_rate_limit_state")}
    assert sum(r.n for r in got["st_event_counts"]) == 720
    assert sum(r.requests for r in got["st_monitor"]) == 720 and len(got["st_monitor"]) == 180
    assert sum(r.n for r in got["st_drift"]) == 720
    assert sorted(r.event_id for r in got["st_dedup_requests"]) == list(range(720))
    assert len(got["st_rate_limit_state"]) == 360 and {r.calls for r in got["st_rate_limit_state"]} == {2}
    none = SimpleNamespace(spark=spark, events=events.limit(0))
    assert plans.QUERIES["st_event_counts"](none).count() == 0
