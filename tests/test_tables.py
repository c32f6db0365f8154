"""Sources, cleaning, quantiles, windows and joins on small tables with known results."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from harborline.operators import aggregates, cleaning, columns, joins, ordering, profiling, quantiles, windows
from harborline.operators.cash import allocate_half_days, morning_shares, redistribute, require_coverage
from harborline.sources import readers, writers


def test_text_documents(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "leave.txt").write_text("  Employees may take leave.\nAsk first. \n")
    (tmp_path / "sub" / "Notes.MD").write_text("# Notes")
    (tmp_path / "empty.txt").write_text(" \n ")
    (tmp_path / "data.csv").write_text("a,b")
    found = {(r.source, r.text, r.page) for r in readers.read_text_documents(spark, str(tmp_path)).collect()}
    assert found == {("leave.txt", "Employees may take leave.\nAsk first.", None), ("Notes.MD", "# Notes", None)}


def test_require_columns(spark):
    df = spark.range(1)
    assert readers.require_columns(df, ["id"]) is df
    with pytest.raises(ValueError, match="txn_hour"):
        readers.require_columns(df, ["id", "txn_hour"])


def test_upsert_replaces_and_adds(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "id string, v int")
    new = spark.createDataFrame([("b", 20), ("c", 30)], "id string, v int")
    once = writers.upsert(old, new, "id")
    twice = writers.upsert(once, new, "id")
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == [("a", 1), ("b", 20), ("c", 30)]


def test_upsert_takes_the_last_of_repeated_keys(spark):
    old = spark.createDataFrame([("a", 1, 0), ("b", 2, 0)], "id string, v int, at int")
    new = spark.createDataFrame([("b", 9, 1), ("b", 3, 2), ("c", 4, 1), ("c", 4, 1)], "id string, v int, at int")
    assert sorted(map(tuple, writers.upsert(old, new, "id", "at").collect())) == [("a", 1, 0), ("b", 3, 2), ("c", 4, 1)]
    assert writers.upsert(old, new, "id").where("id = 'b'").first().v == 9


@pytest.mark.parametrize("seed", range(4))
def test_quantiles_equal_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    values = np.concatenate([rng.normal(0, 10 ** rng.integers(0, 6), 400), np.repeat(rng.normal(size=3), 200), -rng.exponential(size=50)])
    pdf = pd.DataFrame({"g": rng.choice(["hot", "hot", "hot", "b"], len(values)), "v": values})
    pdf.loc[::37, "v"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.95, 1.0]
    found = {(r.g, r.prob): r.quantile for r in quantiles.exact_quantiles(df, ["v"], probs, ["g"]).collect()}
    for g, rows in pdf.dropna().groupby("g"):
        for p in probs:
            assert found[g, p] == pytest.approx(np.quantile(rows.v, p), rel=1e-12, abs=1e-12)


def test_quantile_of_one_value_and_of_none(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", None)], "g string, v double")
    rows = quantiles.quantile_columns(df, ["v"], {"q1": 0.25, "q3": 0.75}, ["g"]).collect()
    assert [(r.g, r.q1, r.q3) for r in rows] == [("a", 3.0, 3.0)]


def test_running_total_with_a_hot_group(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": ["hot"] * 600 + ["x"] * 50, "k": np.arange(650), "v": rng.integers(1, 9, 650)})
    found = windows.running_total(spark.createDataFrame(pdf), ["g"], ["k"], F.floor(F.col("k") / 40), {"total": "v"}).toPandas()
    expected = pdf.sort_values("k").assign(total=lambda d: d.groupby("g").v.cumsum())
    assert found.sort_values("k").total.tolist() == expected.total.tolist()


def test_running_total_without_groups_and_with_null_key(spark):
    df = spark.createDataFrame([(None, 1, 5), (None, 2, 6), ("a", 1, 7)], "g string, k int, v int")
    assert sorted((r.k, r.t) for r in windows.running_total(df, ["g"], ["k"], F.col("k"), {"t": "v"}).where("g is null").collect()) == [(1, 5), (2, 11)]
    assert sorted(r.t for r in windows.running_total(df.where("g is null"), [], ["k"], F.col("k"), {"t": "v"}).collect()) == [5, 11]


ODD = [-math.inf, -1e308, -1e9, -3.5, -3.4, -1.0, -1e-6, -5e-324, 0.0, 5e-324, 1e-310, 1e-6, 0.5, 1.0, 2.0, 2.1, 1e12, 1.7976931348623157e308, math.inf]


def test_value_slots_keep_the_order_of_any_number(spark):
    rng = np.random.default_rng(6)
    steps = [np.nextafter(2.0**k, side * np.inf) for k in (-1022, -40, -1, 0, 1, 10, 52, 1000) for side in (-1, 1)]
    values = sorted([*ODD, *steps, *(2.0 ** np.arange(-30, 30)), *rng.normal(size=500), *(10.0 ** rng.uniform(-300, 300, 500))])
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    coarse, fine = windows.value_slots(F.col("v"))
    got = [(r.v, (r.c, r.f)) for r in df.select("v", coarse.alias("c"), fine.alias("f")).collect()]
    got.sort()
    assert [slots for _, slots in got] == sorted(slots for _, slots in got)
    nothing = spark.createDataFrame([(None,), (float("nan"),)], "v double").select(coarse.alias("c")).collect()
    assert nothing[0].c is None and nothing[1].c > max(slots[0] for _, slots in got)


@pytest.mark.parametrize("low,step", [(1.7e9, 60.0), (0.0, 1e-9), (-5e8, 1e3), (1.0, 0.5)])
def test_value_slots_part_whatever_the_data(spark, low, step):
    df = spark.range(5000).select((F.col("id") * step + low).alias("v"))
    slots = F.struct(*windows.value_slots(F.col("v")))
    got = [r.b for r in df.select("v", slots.alias("b")).orderBy("v").collect()]
    assert got == sorted(got) and len(set(got)) > 1000


def test_small_values_beside_an_outlier_spread_over_slots(spark):
    small = spark.range(1_000_000).select((F.rand(3) * 0.001).alias("v")).unionByName(spark.createDataFrame([(1e6,)], "v double"))
    coarse, _ = windows.value_slots(F.col("v"))
    sizes = small.groupBy(coarse.alias("c")).count().agg(F.count("*").alias("slots"), F.max("count").alias("largest")).first()
    assert sizes.slots > 1000 and sizes.largest < 2_000
    found = quantiles.exact_quantiles(small, ["v"], [0.25, 0.5, 1.0]).collect()
    values = np.array([r.v for r in small.collect()])
    assert {r.prob: r.quantile for r in found} == {p: pytest.approx(np.quantile(values, p), rel=1e-12) for p in (0.25, 0.5, 1.0)}


def test_quantiles_of_odd_numbers_and_ties(spark):
    rows = [("a", v) for v in ODD] + [("b", 7.0)] * 50 + [("b", -7.0)] * 49 + [(None, 1.0), (None, 4.0), ("c", None), ("c", math.nan)]
    df = spark.createDataFrame(rows, "g string, v double")
    found = {r.g: (r.low, r.mid, r.high) for r in quantiles.quantile_columns(df, ["v"], {"low": 0.0, "mid": 0.5, "high": 1.0}, ["g"]).collect()}
    assert found["a"][1] == 5e-324 and found["b"] == (-7.0, 7.0, 7.0) and found[None] == (1.0, 2.5, 4.0) and "c" not in found


def test_quantile_plan_has_no_pass_for_the_ends(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("v"))
    plan = quantiles.medians(df, ["v"])._jdf.queryExecution().optimizedPlan().toString()
    assert "min(" not in plan and "scalar-subquery" not in plan


def test_global_position(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("k"))
    rows = ordering.global_position(df, ["k"], "n").collect()
    assert len(rows) == 1000 and all(r.n == r.k + 1 for r in rows)


def test_global_position_of_descending_struct(spark):
    df = spark.createDataFrame([("b", 2), ("a", 1), ("a", 0)], "x string, y int")
    rows = ordering.global_position(df, ["x", "y"], "n").collect()
    assert {(r.x, r.y): r.n for r in rows} == {("a", 0): 1, ("a", 1): 2, ("b", 2): 3}


def test_outer_joins_equal_plain_ones(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "n")], "k int, l string")
    right = spark.createDataFrame([(1, "x"), (3, "y"), (3, "z"), (None, "m")], "k int, r string")
    rows = lambda df: sorted(map(tuple, df.select("k", "l", "r").collect()), key=str)
    assert rows(joins.right_join(left, right, ["k"])) == rows(left.join(right, "k", "right"))
    assert rows(joins.full_join(left, right, ["k"])) == rows(left.join(right, "k", "full"))
    counts = {r.how: r.rows for r in joins.join_counts(left, right, ["k"]).collect()}
    assert counts == {h: left.join(right, "k", h).count() for h in ("inner", "left", "right", "outer")}


def test_full_join_deals_a_hot_key_of_either_side(spark):
    rng = np.random.default_rng(3)
    hot = [(int(k), f"h{i}") for i, k in enumerate(rng.choice([7, 8, 9, 11], 900, p=[0.5, 0.3, 0.1, 0.1]))]
    few = [(7, "a"), (7, "b"), (9, "c"), (12, "d"), (None, "n"), (None, "n")]
    big = spark.createDataFrame(hot + [(None, f"x{i}") for i in range(300)] + [(7, "h0")] * 3, "k int, l string")
    small = spark.createDataFrame(few, "k int, r string")
    rows = lambda df: sorted(map(tuple, df.select("k", "l", "r").collect()), key=str)
    want = rows(big.join(small, "k", "full"))
    assert rows(joins.full_join(big, small, ["k"], hot=20)) == want
    assert rows(joins.full_join(small, big, ["k"], hot=20)) == want
    assert rows(joins.full_join(big, small.limit(0), ["k"], hot=20)) == rows(big.join(small.limit(0), "k", "full"))


def test_full_join_leaves_no_large_task(spark):
    n = 40_000
    left = spark.range(n).select((F.col("id") % 997).alias("k"), F.col("id").alias("l"))
    right = spark.range(n).select(F.when(F.col("id") % 2 == 0, 1_000_000).otherwise(F.col("id") % 997).alias("k"), F.col("id").alias("r"))
    joined = joins.full_join(left.repartition(4), right.repartition(4), ["k"], hot=500)
    kept = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = sorted(r["count"] for r in joined.where("r is not null").select("r", F.spark_partition_id().alias("p")).distinct().groupBy("p").count().collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", kept["spark.sql.adaptive.enabled"])
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == n and sizes[-1] <= 5 * sizes[len(sizes) // 2]


@pytest.mark.parametrize("size", [2, 3, 7])
def test_rolling_rows_across_slices_equal_one_window(spark, size):
    rng = np.random.default_rng(size)
    rows = [("a" if k % 5 else None, int(k), None if v < 0.2 else float(int(v * 100))) for k, v in enumerate(rng.random(400))]
    df = spark.createDataFrame(rows, "g string, t int, v double")
    plain = {(r.g, r.t): r.s for r in windows.rolling_rows(df, ["g"], ["t"], "v", size, "s").collect()}
    for bucket in (F.floor(F.col("t") / 40), [F.floor(F.col("t") / 40), F.col("t")]):
        got = windows.rolling_rows(df, ["g"], ["t"], "v", size, "s", bucket).collect()
        assert len(got) == len(rows) and {(r.g, r.t): r.s for r in got} == plain
    whole = df.select("g", "t", F.col("v").cast("decimal(10,2)").alias("v"))
    sums = lambda x: {(r.g, r.t): r.s for r in x.collect()}
    assert sums(windows.rolling_rows(whole, ["g"], ["t"], "v", size, "s", F.floor(F.col("t") / 40))) == sums(windows.rolling_rows(whole, ["g"], ["t"], "v", size, "s"))
    assert windows.rolling_rows(df.limit(0), ["g"], ["t"], "v", size, "s", F.col("t")).count() == 0


def test_dictionary_of_features(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1), 2.0, "x"), (1, dt.date(2024, 1, 2), None, "x"), (2, dt.date(2024, 1, 1), 5.0, None)], "tran_br_code int, start_date date, v_lag double, note string")
    got = {r.column: r for r in profiling.feature_dictionary(df, ["tran_br_code", "start_date"]).collect()}
    assert list(got) and set(got) == set(df.columns)
    lag, day, note = got["v_lag"], got["start_date"], got["note"]
    assert (lag.category, lag.type, lag.distinct, lag.missing, lag.missing_pct, lag.min, lag.mean, lag.samples) == ("lag", "double", 2, 1, 33.33, 2.0, 3.5, "2.0, null, 5.0")
    assert (day.category, day.type, day.distinct, day.min, day.samples) == ("key", "date", 2, None, "2024-01-01, 2024-01-02, 2024-01-01")
    assert (note.type, note.distinct, note.non_null, note.max) == ("string", 1, 2, None)
    empty = {r.column: r for r in profiling.feature_dictionary(df.limit(0), ["start_date"]).collect()}
    assert empty["note"].distinct == 0 and empty["note"].missing_pct is None


def test_distinct_counts_of_odd_values(spark):
    df = spark.createDataFrame([(0.0, "", [1]), (-0.0, None, [1]), (float("nan"), "", None), (float("nan"), "a", [1, 2])], "d double, s string, a array<int>")
    assert {r.column: r.distinct for r in profiling.distinct_counts(df).collect()} == {"d": 2, "s": 2, "a": 2}
    plan = profiling.distinct_counts(df)._jdf.queryExecution().executedPlan().toString()
    assert "string" not in plan.split("Exchange")[1].split("\n")[0]


def test_rows_of_groups(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "g string, v int")
    assert aggregates.rows_of_groups(df, ["g"], F.count(F.lit(1)) > 1).count() == 2


def test_mode_takes_the_smallest_on_a_tie(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",)], "s string")
    assert aggregates.modal_value(df, "s").first().mode == "a"


def test_histogram_covers_constant_and_edge_values(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (10.0,)], "v double")
    assert [r.n for r in aggregates.histogram(df, "v", 5).orderBy("bin").collect()] == [2, 0, 0, 0, 1]
    same = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert sum(r.n for r in aggregates.histogram(same, "v", 4).collect()) == 2


def test_bins_are_closed_on_the_right(spark):
    df = spark.createDataFrame([(0.0,), (50.0,), (50.5,), (1000.0,), (1000.1,)], "v double")
    got = [r[0] for r in df.select(columns.right_closed_bins(F.col("v"), [0, 50, 100, 1000])).collect()]
    assert got == [None, "0-50", "50-100", "100-1000", None]


def test_dates_read_day_first(spark):
    df = spark.createDataFrame([("03/04/2024",), ("04/23/2024",), ("2024-05-06",), ("soon",)], "s string")
    got = [r[0] for r in df.select(F.to_date(cleaning.coerce_date(F.col("s")))).collect()]
    assert got == [dt.date(2024, 4, 3), dt.date(2024, 4, 23), dt.date(2024, 5, 6), None]


def test_cash_columns_by_whole_words(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0)], "address_id int, total_dr double, cash_balance double")
    assert cleaning.cash_columns(df) == ["total_dr", "cash_balance"]
    assert "address_id" in cleaning.cash_columns(df, substrings=True)


def test_clip_keeps_nulls_and_counts(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 100)] + [(None,)], "cash double")
    rows = cleaning.iqr_clip(df).collect()
    assert sum(r.cash_capped for r in rows) == 1 and max(r.cash for r in rows if r.cash is not None) == 7.0
    assert sum(r.cash is None for r in rows) == 1


def test_numeric_text(spark):
    df = spark.createDataFrame([(" 1,234 ",), ("-",), ("x",), (None,)], "s string")
    assert [r[0] for r in df.select(cleaning.clean_numeric_text(F.col("s"))).collect()] == [1234.0, 0.0, None, None]


def test_duplicates(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a"), (1, None)], "a int, b string")
    assert cleaning.keep_unrepeated(df).count() == 1
    assert cleaning.duplicate_count(df).first().duplicates == 2


def test_describe_equals_pandas(spark):
    pdf = pd.DataFrame({"v": [1.0, 2.0, 2.0, 9.0, 4.5]})
    row = profiling.describe(spark.createDataFrame(pdf), ["v"]).first()
    expected = pdf.v.describe()
    assert [row["count"], row["mean"], row["std"], row["min"], row["q25"], row["q50"], row["q75"], row["max"]] == pytest.approx(expected.tolist())


def test_transfers_balance(spark):
    df = spark.createDataFrame([("d", 1, 50.0), ("d", 2, -30.0), ("d", 3, -40.0), ("d", 4, 5.0)], "day string, b int, net double")
    rows = sorted((r.from_branch, r.to_branch, r.transfer) for r in redistribute(df, ["day"], "b", "net").collect())
    assert rows == [(1, 2, 30.0), (1, 3, 20.0), (4, 3, 5.0)]


def test_half_days_add_up(spark):
    past = spark.createDataFrame([(1, 9, 10.0), (1, 15, 20.0)], "b int, hour int, v double")
    days = spark.createDataFrame([(1, 100.01), (2, 7.0)], "b int, v double")
    rows = allocate_half_days(days, morning_shares(past, ["b"], "hour", "v"), ["b"], "v").collect()
    assert all(round(r.am + r.pm, 2) == r.v for r in rows) and {r.b: r.am for r in rows} == {1: 33.34, 2: 3.5}


def test_event_calendar_must_cover_the_horizon(spark):
    calendar = readers.rows(spark, [(dt.date(2024, 1, 1), "x"), (dt.date(2024, 1, 2), None)], "event_date date, event_name string")
    assert require_coverage(calendar, "event_date", dt.date(2024, 1, 1), dt.date(2024, 1, 2)) is calendar
    with pytest.raises(ValueError, match="2 of 3"):
        require_coverage(calendar, "event_date", dt.date(2024, 1, 1), dt.date(2024, 1, 3))
