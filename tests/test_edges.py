"""Edge rows: boundaries, malformed sizes, missing sides, constants, ties and empty input."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

import tapeglass as tg
from tapeglass.functions.mbo import with_mbo_size
from tapeglass.operators.correlation import matrix_record
from tapeglass.operators.ordering import cut_by_time, last_n
from tapeglass.schema import GREEKS
from tests.rows import column, flow_of


def at(hour, minute, second=0, micro=0):
    return datetime(2025, 4, 14, hour, minute, second, micro)


def gex_rows(spark, *rows):
    return spark.createDataFrame(
        rows, "spx_strike int, spx_price double, long_gex double, short_gex double, net_gex double"
    )


@pytest.fixture(scope="module")
def empty(spark):
    return flow_of(spark, {}).where("1 = 0")


def test_session_bounds_are_inclusive_to_the_microsecond(spark):
    times = [at(9, 29, 59, 999999), at(9, 30), at(16, 15), at(16, 15, 0, 1), at(12, 0)]
    flow = flow_of(spark, *[{"timestamp": t} for t in times])
    assert sorted(column(tg.apply_filters(flow), "timestamp")) == [times[1], times[4], times[2]]
    assert tg.apply_filters(flow, tg.ALL_ROWS).count() == 5


def test_size_forms(spark):
    texts = ["[]", None, "[1.0,null,2.0]", "7.0", "[1,", "", '["a"]', "[4.0]"]
    flow = flow_of(spark, *[{"MBO": t, "spx_strike": i} for i, t in enumerate(texts)])
    sizes = column(with_mbo_size(flow).orderBy("spx_strike"), "mbo_size")
    assert sizes == [None, None, 3.0, None, None, None, None, 4.0]
    report = {(r.column, r.check): r.n_bad for r in tg.validation_report(flow, raw=False).collect()}
    assert report == {("MBO", "bad_json"): 4}


def test_bounds_are_inclusive_and_unknown_side_is_ignored(spark):
    flow = flow_of(
        spark,
        {"spx_strike": 10, "t": 0.25, "Side": "Bid"},
        {"spx_strike": 11, "t": 0.5, "Side": "Ask"},
        {"spx_strike": 12, "t": 0.75, "Side": None},
    )

    def strikes(**bounds):
        return sorted(column(tg.apply_filters(flow, tg.FlowFilter(**bounds)), "spx_strike"))

    assert strikes(strike_min=10, strike_max=11) == [10, 11]
    assert strikes(strike_min=10.5, strike_max=11.5) == [11]
    assert strikes(t_min=0.5) == [11, 12]
    assert strikes(t_max=0.5) == [10, 11]
    assert strikes(side="Ask") == [11]
    assert strikes(side="Both") == [10, 11, 12]
    assert strikes(start="2025-04-14T10:00", end="2025-04-14 10:00:00") == [10, 11, 12]
    assert strikes(start="2025-04-14T14:00:00+00:00") == [10, 11, 12]
    assert strikes(end="2025-04-14T09:59:59") == []


def test_null_and_unknown_sides_count_against_net_only(spark):
    flow = flow_of(
        spark, *[{"Side": s, "call_gamma": 2.0, "MBO": "[3.0]"} for s in ("Bid", "Ask", "Mid", None)]
    )
    row = tg.gex(flow).first()
    assert (row.long_gex, row.short_gex, row.net_gex) == (6.0, 6.0, 6.0 - 18.0)


def test_buckets_start_from_the_first_monday_of_2000(spark):
    flow = flow_of(spark, {"timestamp": datetime(2000, 1, 3, 9, 41)})
    every = tg.FlowFilter(market_hours=False)
    assert column(tg.basis(flow, every, 7), "time_bucket") == [datetime(2000, 1, 3, 9, 41)]
    assert column(tg.basis(flow, every, 45), "time_bucket") == [datetime(2000, 1, 3, 9, 0)]
    seconds = tg.basis(flow, every, bucket_seconds=5)
    assert column(seconds, "time_bucket") == [datetime(2000, 1, 3, 9, 41)]


def test_one_sided_bucket_has_no_spread(spark):
    flow = flow_of(
        spark,
        {"timestamp": at(10, 0), "Side": "Ask", "future_strike": 7.0, "spx_price": 3.0},
        {"timestamp": at(10, 0), "Side": "Bid", "future_strike": 5.0, "spx_price": 9.0},
        {"timestamp": at(11, 0), "Side": "Ask"},
        {"timestamp": at(12, 0), "Side": None},
    )
    assert [tuple(r) for r in tg.spread(flow).collect()] == [(at(10, 0), 2.0, 3.0)]


def test_constant_greek_correlates_with_nothing(spark):
    rows = [{"call_rho": 0.1, "call_vega": float(i), "put_vega": -float(i)} for i in range(50)]
    cells = {(r.greek_i, r.greek_j): r.r for r in tg.correlation(flow_of(spark, *rows)).collect()}
    assert len(cells) == 256
    assert all(cells[g, g] == 1.0 for g in GREEKS)
    assert all(cells["call_rho", g] == 0.0 for g in GREEKS if g != "call_rho")
    assert cells["call_vega", "put_vega"] == -1.0
    assert all(cells[a, b] == cells[b, a] for a, b in cells)


def test_null_greeks_count_as_zero(spark):
    rows = [{"call_vega": v, "put_vega": w} for v, w in ((None, 0.0), (0.0, None), (4.0, 4.0))]
    cells = {(r.greek_i, r.greek_j): r.r for r in tg.correlation(flow_of(spark, *rows)).collect()}
    assert cells["call_vega", "put_vega"] == 1.0


def test_non_finite_greeks_count_as_zero_and_large_means_do_no_harm(spark):
    odd = [float("nan"), float("inf"), float("-inf"), 0.0, 4.0]
    rows = [{"call_vega": v, "put_vega": w} for v, w in zip(odd, [0.0, 0.0, 0.0, None, 4.0])]
    cells = {(r.greek_i, r.greek_j): r.r for r in tg.correlation(flow_of(spark, *rows)).collect()}
    assert cells["call_vega", "put_vega"] == 1.0
    rows = [{"call_vega": 1e6 + i, "put_vega": float(i % 2)} for i in range(100)]
    cells = {(r.greek_i, r.greek_j): r.r for r in tg.correlation(flow_of(spark, *rows)).collect()}
    assert cells["call_vega", "put_vega"] == 0.0173


def test_matrix_shapes(spark, empty):
    long_df = tg.correlation(flow_of(spark, {}, {"call_vega": 3.0}))
    lower = tg.correlation_matrix(long_df, lower_only=True).collect()
    assert [r.greek_i for r in lower] == GREEKS
    assert lower[0].call_delta is None and lower[1].call_charm is not None
    record = matrix_record(long_df).first()
    assert record.columns == GREEKS
    assert [len(line) for line in record.matrix] == [16] * 16
    assert [record.matrix[i][i] for i in range(16)] == [1.0] * 16
    assert matrix_record(tg.correlation(empty)).first().matrix == []


def test_flip_and_pin(spark):
    gex = gex_rows(
        spark, (100, 90.0, 0.0, 1.0, -1.0), (101, 92.0, 2.0, 0.0, 2.0), (102, None, 3.0, 0.0, 3.0)
    )
    row = tg.gex_levels(gex).first()
    assert (row.flip_point, row.pin_strike, row.long_wall, row.short_wall) == (100.5, 102, 102, 100)
    assert row.total_net_gex == 4.0 and row.regime == "LONG GAMMA"
    assert row.price == pytest.approx(182 / 3) and row.above_flip is False


def test_level_ties_and_nulls(spark):
    gex = gex_rows(
        spark, (100, 1.0, 5.0, None, -4.0), (103, 1.0, None, None, None), (105, 1.0, 5.0, None, 4.0)
    )
    row = tg.gex_levels(gex).first()
    assert (row.pin_strike, row.long_wall, row.short_wall) == (100, 100, 100)
    assert row.flip_point == 104.0
    assert row.regime == "SHORT GAMMA"
    assert tg.gex_flip(gex.where("spx_strike = 100")).first().flip_point is None


def test_profile_band_and_flag(spark):
    gex = gex_rows(spark, *[(s, 100.0, 0.0, 0.0, 0.0) for s in (91, 92, 98, 101, 103, 108, 109)])
    profile = tg.gex_profile(gex).collect()
    assert [(r.spx_strike, r.near_price) for r in profile] == [
        (92, False), (98, True), (101, True), (103, False), (108, False)
    ]
    joined = tg.gex_profile(gex, tg.gex_levels(gex)).collect()
    assert [r.spx_strike for r in joined] == [r.spx_strike for r in profile]


def test_empty_input(spark, empty):
    row = tg.kpi(empty).first()
    assert row.total_events == 0 and row.unique_strikes == 0 and row.total_ps_events is None
    assert row.start_date is None and row.avg_spx_price is None
    assert tg.gex_levels(tg.gex(empty)).collect() == []
    assert tg.correlation(empty).collect() == []
    assert tg.histogram_bins(empty).collect() == []
    assert tg.heatmap(empty).collect() == [] and tg.spread(empty).collect() == []


def test_histogram_keeps_empty_bins_and_the_largest_size(spark):
    flow = flow_of(spark, {"MBO": "[1.0, 80.0, -3.0, 0.0]"}, {"MBO": "[3.0]"})
    bins = tg.histogram_bins(flow).collect()
    assert [r.bin for r in bins] == list(range(40))
    assert {r.bin: r["count"] for r in bins if r["count"]} == {0: 1, 1: 1, 39: 1}
    assert bins[3].lower_edge == 6.0 and bins[3].range == "6"


def test_depth_ladder_keeps_the_largest_strikes(spark):
    rows = [{"future_strike": float(s), "Side": side, "MBO": f"[{s}.0]"} for s in range(1, 51) for side in ("Bid", "Ask")]
    ladder = tg.depth_ladder(tg.depth(flow_of(spark, *rows))).collect()
    assert [r.strike for r in ladder] == [float(s) for s in range(11, 51)]
    assert (ladder[0].bid, ladder[0].ask) == (11.0, -11.0)
    lone = tg.depth_ladder(tg.depth(flow_of(spark, {"Side": "Mid"}))).first()
    assert (lone.bid, lone.ask) == (0.0, 0.0)


def test_expiry_rounding(spark):
    times = [0.03125, -0.03125, 0.00004, 0.00006, 0.0827, 0.0, 12.34565, None, float("inf"), float("nan")]
    flow = flow_of(spark, *[{"t": t, "spx_strike": i} for i, t in enumerate(times)])
    rounded = column(tg.surface(flow).orderBy("spx_strike"), "t")
    expected = [0.0313, -0.0313, 0.0, 0.0001, 0.0827, 0.0, 12.3456, None, None, None]
    assert [None if t is None else round(t, 6) for t in rounded] == expected


def test_non_finite_results_become_null(spark):
    flow = flow_of(spark, {"call_vega": float("nan")}, {"spx_strike": 1, "call_vega": float("inf")})
    assert column(tg.surface(flow, "call_vega"), "greek_value") == [None, None]


def test_arguments_out_of_range(spark, empty):
    for call in (
        lambda: tg.heatmap(empty, limit=0),
        lambda: tg.heatmap(empty, limit=50001),
        lambda: tg.basis(empty, bucket_minutes=61),
        lambda: tg.basis(empty, bucket_minutes=0),
        lambda: tg.gex(empty, limit=5001),
        lambda: tg.surface(empty, "call_speed"),
        lambda: tg.vanna_charm(empty, "gamma"),
        lambda: tg.pulling_stacking(empty, limit=100001),
        lambda: tg.histogram_bins(empty, bins=4),
    ):
        with pytest.raises(ValueError):
            call()


def test_pulling_stacking_order_and_marks(spark):
    flow = flow_of(
        spark,
        {"timestamp": at(10, 2), "MBO_pulling_stacking": -1, "spx_price": 1.0},
        {"timestamp": at(10, 1), "MBO_pulling_stacking": 2, "spx_price": 2.0},
        {"timestamp": at(10, 3), "MBO_pulling_stacking": 0, "spx_price": 3.0},
    )
    split = tg.ps_split(tg.pulling_stacking(flow, limit=2)).collect()
    assert [(r.pulling, r.stacking) for r in split] == [(None, 2.0), (1.0, None)]
    assert tg.pulling_stacking(flow, only_events=True).count() == 2
    assert column(tg.recent_pulling_stacking(flow, n=2), "spx_price") == [1.0, 3.0]


@pytest.mark.parametrize("n", [1, 7, 100, 399, 400, 5000])
@pytest.mark.parametrize("last", [False, True])
@pytest.mark.parametrize("dated", [False, True])
def test_cut_by_time_keeps_the_edge_and_little_else(spark, n, last, dated):
    # 400 rows: one hot millisecond holds half of them, eight rows share each microsecond.
    hot = f"timestamp_micros(1744624800000000 + CASE WHEN id < 200 THEN 61500000 + id div 8 ELSE id * 977777777 END)"
    flow = spark.range(400).selectExpr("id", f"CAST({hot} AS TIMESTAMP_NTZ) AS timestamp")
    if dated:
        flow = flow.withColumn("date", F.to_date("timestamp"))
    cut = cut_by_time(flow, n, last)
    order = ["timestamp", "id"]
    expected = last_n(flow, n, order).collect()
    if not last:
        expected = flow.orderBy(*order).limit(n).collect()
        assert cut.orderBy(*order).limit(n).collect() == expected
    else:
        assert last_n(cut, n, order).collect() == expected
    assert cut.count() <= min(n, 400) + 200


def test_first_and_last_events_run_no_job_while_they_are_built(spark):
    from tapeglass.sources.events_view import load_flow

    flow = load_flow(spark, "/root/testdata/sf0.001").withColumn("date", F.to_date("timestamp"))
    spark.sparkContext.setJobGroup("building", "plans only")
    edges = [tg.pulling_stacking(flow, limit=50), tg.recent_pulling_stacking(flow, n=50)]
    assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("building")) == []
    spark.sparkContext.setJobGroup("running", "results")
    rows = tg.apply_filters(flow).orderBy("timestamp", "Side", "future_strike")
    order = ["timestamp", "spx_price", "MBO_pulling_stacking"]
    assert edges[0].collect() == rows.limit(50).select(order).collect()
    assert edges[1].collect() == rows.select(order).collect()[-50:]


def test_rows_without_a_time_keep_a_bucket(spark):
    flow = flow_of(spark, {"timestamp": None, "MBO": "[2.0]"}, {"timestamp": at(10, 0), "MBO": "[3.0]"})
    cells = tg.heatmap(flow, tg.ALL_ROWS).collect()
    assert [(r.time_bucket, r.total_size) for r in cells] == [(at(10, 0), 3.0), (None, 2.0)]


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Kolkata"])
def test_wall_clock_does_not_depend_on_the_session_zone(spark, zone):
    from tapeglass.functions.time import wall_clock
    from tapeglass.session import session_conf

    # Before and after both changes of the clock, 2025-11-02T09:30Z among them.
    micros = [1741503600000000, 1741507200000000, 1762061400000000, 1762075800000000, 1744624800123456]
    with session_conf(spark, {"spark.sql.session.timeZone": zone}):
        instants = spark.createDataFrame([(m,) for m in micros], "m long").select(F.timestamp_micros("m").alias("at"))
        found = column(instants.select(wall_clock(F.col("at")).alias("wall")), "wall")
    assert found == [
        datetime(2025, 3, 9, 3, 0), datetime(2025, 3, 9, 4, 0), datetime(2025, 11, 2, 1, 30),
        datetime(2025, 11, 2, 4, 30), datetime(2025, 4, 14, 6, 0, 0, 123456),
    ]


def test_invariants_on_benchmark_rows(spark):
    from tapeglass.sources.events_view import load_flow

    flow = load_flow(spark, "/root/testdata/sf0.001")

    def total(df, name):
        return df.selectExpr(f"sum({name})").first()[0]

    size = total(tg.heatmap(flow, limit=None), "total_size")
    assert size == total(tg.depth(flow, limit=None), "total_size")
    assert size == total(tg.volume_over_time(tg.heatmap(flow, limit=None)), "total_size")
    gex = tg.gex(flow, limit=None)
    sided = tg.gex(flow.where("Side IS NOT NULL"))
    assert total(sided, "net_gex") == total(sided, "long_gex") - total(sided, "short_gex")
    assert total(gex, "net_gex") == total(tg.gex_intraday(flow, limit=None), "net_gex")
    events = tg.kpi(flow).first()
    assert events.total_events == total(tg.scatter(flow, limit=None), "mbo_count")
    assert events.unique_strikes == tg.scatter(flow, limit=None).count()
    flows = tg.net_flow(flow, limit=None)
    assert total(flows, "net_delta") == total(flows, "call_delta_flow + put_delta_flow")
