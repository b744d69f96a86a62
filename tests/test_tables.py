"""Stored tables: one-shuffle merging, side tables by file, packing of files, samples and moments."""

from __future__ import annotations

from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

import tapeglass as tg
from tapeglass.operators import dedup
from tapeglass.operators.moments import correlation_from_moments, merged_moments, moments
from tapeglass.schema import FLOW_COLUMNS, GREEKS, KEY
from tapeglass.sources import side_tables
from tapeglass.sources.flow_table import STORED_SCHEMA, SUMMARIES
from tapeglass.sources.key_filters import bloom, files_with_keys, may_hold
from tests.rows import column, flow_of

AT = datetime(2025, 4, 14, 10, 0)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def rows_at(spark, start: datetime, n: int, step: float = 1.0, **values):
    """Rows every `step` seconds, with instants."""
    rows = flow_of(spark, *[{"timestamp": start + timedelta(seconds=step * i), "future_strike": 5300.0 + i % 7, **values} for i in range(n)])
    return rows.withColumn("timestamp", F.expr("CAST(timestamp AS TIMESTAMP)"))


def test_merge_has_one_shuffle_and_keeps_the_first(spark):
    existing = flow_of(spark, {"future_strike": 1.0}).withColumn("date", F.to_date("timestamp"))
    new = flow_of(spark, *[{"future_strike": float(s), "spx_strike": i} for i, s in enumerate([1, 2, 2, 3, -0.0, 0.0])])
    new = new.withColumn("date", F.to_date("timestamp"))
    merged = dedup.merge_in_ranges(existing.select("date", *KEY), new, ["spx_strike"], ["date", "timestamp", "Side"])
    plan = plan_of(merged)
    assert plan.count("Exchange") == 1 and "rangepartitioning" in plan
    assert sorted((r.future_strike, r.spx_strike) for r in merged.collect()) == [(0.0, 4), (2.0, 1), (3.0, 3)]


def test_copies_of_a_hot_key_are_folded_before_the_one_shuffle(spark):
    hot = flow_of(spark, {"future_strike": 9.0}).drop("spx_strike").crossJoin(spark.range(30_000).select(F.col("id").cast("int").alias("spx_strike")))
    cold = rows_at(spark, AT, 500).withColumn("timestamp", F.expr("CAST(timestamp AS TIMESTAMP_NTZ)"))
    new = hot.select(cold.columns).unionByName(cold).withColumn("date", F.to_date("timestamp"))
    none = new.where("1 = 0").select("date", *KEY)
    assert dedup.hot_groups(new).count() == 1 and dedup.hot_groups(new, known_rows=100) is None
    merged = dedup.merge_in_ranges(none, new, ["spx_strike"], ["date", "timestamp", "Side"])
    assert merged.count() == 501 and merged.where("future_strike = 9").first().spx_strike == 0
    assert plan_of(merged).count("partial_min_by") >= 2


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """Two days of rows, refreshed; a third append that is not."""
    path = str(tmp_path_factory.mktemp("table") / "flow")
    tg.append_flow(rows_at(spark, AT, 600), path, side_tables=SUMMARIES)
    tg.append_flow(rows_at(spark, AT + timedelta(days=1), 600), path, side_tables=SUMMARIES)
    tg.append_flow(rows_at(spark, AT + timedelta(hours=1), 50, Side="Ask"), path)
    return path


def test_reading_summarises_what_was_not_refreshed(spark, table):
    cells = tg.side_table(spark, table, "rollup")
    assert cells.agg(F.sum("events")).first()[0] == 1250
    files = side_tables.stored_files(spark, table).count()
    held = spark.read.parquet(f"{table}_rollup/register").count()
    assert 0 < held < files
    heat = tg.rollup_heatmap(cells, tg.ALL_ROWS, 45).collect()
    assert heat == tg.heatmap(tg.read_flow(spark, table), tg.ALL_ROWS, 45).collect()


def test_rows_of_a_refresh_that_died_do_not_count(spark, tmp_path):
    path = str(tmp_path / "flow")
    tg.append_flow(rows_at(spark, AT, 100), path)
    lost = side_tables.rows_of(spark, path, STORED_SCHEMA, None)
    SUMMARIES["rollup"](lost).write.parquet(f"{path}_rollup/batch=dead")
    assert tg.side_table(spark, path, "rollup").agg(F.sum("events")).first()[0] == 100
    assert tg.refresh_side_tables(spark, path, ["rollup"])["rollup"] > 0
    assert tg.refresh_side_tables(spark, path, ["rollup"]) == {"rollup": 0}
    assert tg.side_table(spark, path, "rollup").agg(F.sum("events")).first()[0] == 100


def test_rollup_refuses_what_it_cannot_answer(spark, table):
    cells = tg.side_table(spark, table, "rollup")
    for bad in ({"strike_min": 1.0}, {"t_max": 1.0}, {"start": "2025-04-14T10:00:01"}, {"end": "2025-04-14T10:00:00"}):
        with pytest.raises(ValueError):
            tg.rollup_basis(cells, tg.FlowFilter(**bad))
    with pytest.raises(ValueError):
        tg.rollup_basis(cells, bucket_seconds=7)
    day = tg.FlowFilter(start="2025-04-15T00:00", end="2025-04-15T23:59:59.999999", side="Bid", market_hours=False)
    assert tg.rollup_depth(cells, day).collect() == tg.depth(tg.read_flow(spark, table), day).collect()


def test_the_closing_instant_and_what_follows_it_are_told_apart(spark, tmp_path):
    path = str(tmp_path / "flow")
    # 16:15 in New York is 20:15 UTC.
    tg.append_flow(rows_at(spark, datetime(2025, 4, 14, 20, 14, 59), 5, 0.5), path, side_tables=["rollup"])
    cells = tg.side_table(spark, path, "rollup")
    flow = tg.read_flow(spark, path)
    assert tg.rollup_depth(cells).agg(F.sum("event_count")).first()[0] == 3
    assert tg.rollup_heatmap(cells).collect() == tg.heatmap(flow).collect()


def test_an_append_opens_only_files_that_may_hold_its_keys(spark, table):
    segments = tg.side_table(spark, table, "keys")

    def opened(rows):
        dated = rows.withColumn("date", F.to_date(F.convert_timezone(F.lit("UTC"), F.lit("America/New_York"), F.expr("CAST(timestamp AS TIMESTAMP_NTZ)"))))
        return {r.file for r in files_with_keys(segments, dated).collect()}

    every = {r.file for r in side_tables.stored_files(spark, table).collect()}
    stored = rows_at(spark, AT, 600)
    assert opened(stored.limit(1)) < every and len(opened(stored.limit(1))) >= 1
    assert opened(rows_at(spark, AT + timedelta(days=9), 20)) == set()
    # Times that files cover, but no key in them.
    assert opened(rows_at(spark, AT + timedelta(milliseconds=500), 20)) == set()
    whole = opened(stored)
    assert all(file.startswith("date=2025-04-14") for file in whole) and whole


def test_bloom_filters_have_no_false_negatives():
    rng = np.random.default_rng(0)
    one, two = (rng.integers(-(2**63), 2**63 - 1, 5000, dtype=np.int64) for _ in "ab")
    packed = bloom(one[:2500], two[:2500])
    held = may_hold(packed, one, two)
    assert held[:2500].all() and held[2500:].mean() < 0.01


def test_undated_rows_look_into_undated_files(spark, tmp_path):
    path = str(tmp_path / "flow")
    undated = rows_at(spark, AT, 5).withColumn("timestamp", F.lit(None).cast("timestamp"))
    tg.append_flow(undated, path, side_tables=["keys"])
    assert tg.append_flow(undated, path, side_tables=["keys"])["appended"] == 0
    assert tg.read_flow(spark, path).count() == 5


def test_first_and_last_events_by_counts_per_minute(spark, table):
    flow, minutes = tg.read_flow(spark, table), tg.side_table(spark, table, "minutes")
    first = tg.pulling_stacking(flow, tg.ALL_ROWS, limit=100, minutes=minutes)
    assert first.collect() == tg.pulling_stacking(flow, tg.ALL_ROWS, limit=100).collect()
    last = tg.recent_pulling_stacking(flow, tg.ALL_ROWS, 100, minutes=minutes)
    assert last.collect() == tg.recent_pulling_stacking(flow, tg.ALL_ROWS, 100).collect()
    with pytest.raises(ValueError):
        tg.pulling_stacking(flow, tg.FlowFilter(side="Bid"), limit=5, minutes=minutes)


def test_moments_merge_in_any_grouping(spark):
    rng = np.random.default_rng(1)
    values = rng.normal(1e6, 1.0, (400, len(GREEKS)))
    values[:, 1] = -2 * values[:, 0]
    values[:, 2] = 7.1
    rows = spark.createDataFrame([(int(i % 5), *map(float, v)) for i, v in enumerate(values)], "part int, " + ", ".join(f"{g} double" for g in GREEKS))
    expected = np.corrcoef(values.T)
    for parts in (moments(rows, []), moments(rows.repartition(7), ["part"]), merged_moments(moments(rows, ["part"]), ["part"])):
        found = {(r.greek_i, r.greek_j): r.r for r in correlation_from_moments(parts).collect()}
        assert len(found) == 256
        for i, a in enumerate(GREEKS):
            for j, b in enumerate(GREEKS):
                r = 1.0 if i == j else 0.0 if 2 in (i, j) else expected[i, j]
                assert abs(found[a, b] - r) < 1e-3
    assert correlation_from_moments(moments(rows.where("1 = 0"), [])).collect() == []


def test_samples_do_not_depend_on_the_partitioning(spark):
    rows = rows_at(spark, AT, 3000).select(*KEY, "spx_price")
    picked = {tuple(r) for r in tg.exact_sample(rows.repartition(3), 500, KEY).collect()}
    assert picked == {tuple(r) for r in tg.exact_sample(rows.repartition(11, "Side"), 500, KEY).collect()}
    assert len(picked) == 500
    assert picked != {tuple(r) for r in tg.exact_sample(rows, 500, KEY, seed=7).collect()}
    assert tg.exact_sample(rows, 5000, KEY).count() == 3000
    assert tg.exact_sample(rows.where("1 = 0"), 5, KEY).count() == 0
    copies = rows.limit(1).crossJoin(spark.range(50)).drop("id")
    assert tg.exact_sample(copies, 20, KEY).count() == 20
    with pytest.raises(ValueError):
        tg.exact_sample(rows, 0, KEY)


def test_packing_leaves_rows_and_few_files(spark, tmp_path):
    path = str(tmp_path / "flow")
    for i in range(4):
        tg.append_flow(rows_at(spark, AT + timedelta(seconds=0.1 * i), 50, 40.0), path, side_tables=["rollup"])
    tg.append_flow(rows_at(spark, AT, 3).withColumn("timestamp", F.lit(None).cast("timestamp")), path)
    before = sorted(map(str, tg.read_flow(spark, path).select(FLOW_COLUMNS).collect()))
    counts = tg.compact(spark, path)
    assert counts["after"] < counts["before"] and counts["after"] <= 2 * counts["dates"]
    assert sorted(map(str, tg.read_flow(spark, path).select(FLOW_COLUMNS).collect())) == before
    assert tg.side_table(spark, path, "rollup").agg(F.sum("events")).first()[0] == len(before)
    assert tg.compact(spark, path, 1)["dates"] == 0


def test_gap_intervals(spark):
    gaps = spark.createDataFrame([("2025-04-14", m) for m in ("0959", "1000", "1001", "1100")] + [("2025-04-15", "0959")], "d string, minute string")
    found = tg.gap_intervals(gaps.select(F.to_date("d").alias("date"), "minute")).orderBy("date", "from").collect()
    assert [(r["from"], r["to"], r["count"]) for r in found] == [("0959", "1001", 3), ("1100", "1100", 1), ("0959", "0959", 1)]
    assert column(tg.gap_intervals(gaps.select(F.to_date("d").alias("date"), "minute").where("1 = 0")), "from") == []
