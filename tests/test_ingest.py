"""Ingest: CSV and minute files, keep-first merging, ledger, quarantine, restart and snapshot export."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

import tapeglass as tg
from tapeglass.operators.dedup import dedup_first
from tapeglass.schema import FLOW_COLUMNS, FLOW_SCHEMA, GREEKS, KEY
from tapeglass.sources.csv_files import scan_csv
from tapeglass.sources.flow_table import STORED_COLUMNS
from tapeglass.sources.listing import list_files, read_ledger
from tests.compare import spark_table
from tests.rows import CSV_COLUMNS, column, csv_line, flow_of, write_csv


def stored(spark, out):
    return spark.read.parquet(str(out))


SAMPLE = [
    csv_line(Side="Ask"),
    csv_line(Side="Bid"),
    csv_line(timestamp="2025-04-22T15:48:00.000000-04:00", MBO='"[3.0, 6.0]"', MBO_pulling_stacking="1"),
]


def test_csv_table_has_the_declared_types(spark, tmp_path):
    src = write_csv(tmp_path / "a.csv", *SAMPLE)
    counts = tg.ingest_csv(spark, src, str(tmp_path / "flow"), validate=True)
    assert (counts["files"], counts["read"], counts["appended"], counts["report"]) == (1, 3, 3, [])
    table = stored(spark, tmp_path / "flow")
    assert set(STORED_COLUMNS) == set(table.columns)
    assert all(table.schema[f.name].dataType == f.dataType for f in FLOW_SCHEMA.fields)
    assert all(table.schema[g].dataType.simpleString() == "float" for g in GREEKS)
    assert set(column(table, "Side")) <= {"Bid", "Ask"}
    assert sorted(column(table, "mbo_size")) == [4.0, 4.0, 9.0]
    walls = column(tg.apply_filters(table), "timestamp")
    assert sorted(t.isoformat() for t in walls) == [
        "2025-04-22T15:47:00.237904", "2025-04-22T15:47:00.237904", "2025-04-22T15:48:00"
    ]
    assert tg.validation_report(table.select(FLOW_COLUMNS), raw=False).collect() == []


def test_first_row_wins_and_existing_rows_beat_new_ones(spark, tmp_path):
    out = str(tmp_path / "flow")
    write_csv(tmp_path / "a.csv", csv_line(call_vega="1.5"), csv_line(call_vega="2.5"))
    write_csv(tmp_path / "b.csv", csv_line(call_vega="3.5"), csv_line(Side="Bid", call_vega="4.5"))
    assert tg.ingest_csv(spark, str(tmp_path / "*.csv"), out)["appended"] == 2
    assert sorted(column(stored(spark, out), "call_vega")) == [1.5, 4.5]
    write_csv(tmp_path / "c.csv", csv_line(call_vega="9.0"), csv_line(future_strike="1.0", call_vega="8.0"))
    counts = tg.ingest_csv(spark, str(tmp_path / "*.csv"), out)
    assert (counts["files"], counts["read"], counts["appended"]) == (1, 2, 1)
    assert sorted(column(stored(spark, out), "call_vega")) == [1.5, 4.5, 8.0]


def test_ingest_twice_equals_once(spark, tmp_path):
    out = str(tmp_path / "flow")
    src = write_csv(tmp_path / "a.csv", *SAMPLE)
    tg.ingest_csv(spark, src, out)
    first = spark_table(stored(spark, out))
    assert tg.ingest_csv(spark, src, out)["files"] == 0
    again = tg.ingest_csv(spark, src, out, skip_processed=False)
    assert (again["files"], again["appended"]) == (1, 0)
    assert spark_table(stored(spark, out)) == first


def test_null_key_parts_are_equal(spark, tmp_path):
    out = str(tmp_path / "flow")
    write_csv(tmp_path / "a.csv", csv_line(Side=""), csv_line(Side="", call_vega="7.0"))
    assert tg.ingest_csv(spark, str(tmp_path / "a.csv"), out)["appended"] == 1
    write_csv(tmp_path / "b.csv", csv_line(Side=""), csv_line(timestamp="", Side="Bid"))
    assert tg.ingest_csv(spark, str(tmp_path / "b.csv"), out)["appended"] == 1
    write_csv(tmp_path / "c.csv", csv_line(timestamp="", Side="Bid"), csv_line(timestamp=""))
    assert tg.ingest_csv(spark, str(tmp_path / "c.csv"), out)["appended"] == 1
    assert stored(spark, out).count() == 3


def test_bad_values_abort_before_anything_is_written(spark, tmp_path):
    out = tmp_path / "flow"
    write_csv(tmp_path / "a.csv", csv_line(), csv_line(Side="Bid", t="soon"))
    with pytest.raises(tg.ValidationError, match="t: bad_cast x1"):
        tg.ingest_csv(spark, str(tmp_path / "a.csv"), str(out))
    assert not out.exists() and not (tmp_path / "flow_ledger").exists()


def test_validate_rejects_unknown_sides(spark, tmp_path):
    src = write_csv(tmp_path / "a.csv", csv_line(), csv_line(Side="Mid"), csv_line(Side="", MBO='"[1,"'))
    with pytest.raises(tg.ValidationError, match="Side: side_domain x1"):
        tg.ingest_csv(spark, src, str(tmp_path / "flow"), validate=True)
    counts = tg.ingest_csv(spark, src, str(tmp_path / "flow"))
    assert counts["appended"] == 3
    assert {(c, k): n for c, k, n, _ in counts["report"]} == {
        ("Side", "side_domain"): 1, ("Side", "null_key"): 1, ("MBO", "bad_json"): 1
    }


@pytest.mark.parametrize("text", ["10:00", "2025", "2025-04-22 15:47:00", "2025-04-22T15:47:00.237904", "soon"])
def test_timestamps_of_another_form_are_refused(spark, tmp_path, text):
    src = write_csv(tmp_path / "a.csv", csv_line(), csv_line(Side="Bid", timestamp=text))
    with pytest.raises(tg.ValidationError, match="timestamp: bad_cast x1"):
        tg.ingest_csv(spark, src, str(tmp_path / "flow"))


def test_validate_refuses_rows_without_a_key(spark, tmp_path):
    src = write_csv(tmp_path / "a.csv", csv_line(), csv_line(timestamp=""))
    with pytest.raises(tg.ValidationError, match="timestamp: null_key x1"):
        tg.ingest_csv(spark, src, str(tmp_path / "flow"), validate=True)
    assert tg.ingest_csv(spark, src, str(tmp_path / "flow"))["appended"] == 2


def test_missing_column_and_differing_headers(spark, tmp_path):
    short = [c for c in CSV_COLUMNS if c != "t"]
    src = write_csv(tmp_path / "a.csv", header=",".join(short))
    with pytest.raises(tg.ValidationError, match="t"):
        tg.ingest_csv(spark, src, str(tmp_path / "flow"))
    write_csv(tmp_path / "b1.csv", csv_line())
    write_csv(tmp_path / "b2.csv", csv_line(), header=",".join(reversed(CSV_COLUMNS)))
    with pytest.raises(Exception, match="(?i)header"):
        tg.ingest_csv(spark, str(tmp_path / "b*.csv"), str(tmp_path / "flow"))


def test_columns_are_read_by_name(spark, tmp_path):
    header = ",".join(reversed(CSV_COLUMNS))
    line = ",".join(reversed(csv_line(MBO="[4.0]", t="0.5").split(",")))
    src = write_csv(tmp_path / "a.csv", line, header=header)
    tg.ingest_csv(spark, src, str(tmp_path / "flow"))
    row = stored(spark, tmp_path / "flow").first()
    assert (row.Side, row.t, row.mbo_size) == ("Ask", 0.5, 4.0)


def test_listing_warns_and_ledger_records(spark, tmp_path, caplog):
    write_csv(tmp_path / "a.csv", csv_line())
    pattern = [str(tmp_path / "*.csv"), str(tmp_path / "a.csv"), str(tmp_path / "none*.csv")]
    assert list_files(spark, pattern).count() == 1
    assert "No files matched" in caplog.text
    assert tg.ingest_csv(spark, str(tmp_path / "none*.csv"), str(tmp_path / "flow"))["files"] == 0
    tg.ingest_csv(spark, pattern, str(tmp_path / "flow"))
    ledger = column(read_ledger(spark, str(tmp_path / "flow_ledger")), "path")
    assert len(ledger) == 1 and ledger[0].endswith("a.csv")


def test_listing_looks_into_folders_after_two_stars(spark, tmp_path):
    for folder in ("x", "x/y"):
        (tmp_path / folder).mkdir()
        write_csv(tmp_path / folder / "a.csv", csv_line())
        write_csv(tmp_path / folder / "a.txt", csv_line())
    assert list_files(spark, str(tmp_path / "**" / "*.csv")).count() == 2
    assert list_files(spark, str(tmp_path / "**")).count() == 4
    assert list_files(spark, str(tmp_path / "**" / "y" / "*.csv")).count() == 1
    assert list_files(spark, str(tmp_path / "**" / "x" / "**" / "*.csv")).count() == 2


def test_time_filters_reach_the_stored_table_scan(spark, tmp_path):
    out = str(tmp_path / "flow")
    lines = [csv_line(timestamp=f"2025-04-{d}T12:00:00.000000-04:00") for d in (21, 22, 23)]
    tg.ingest_csv(spark, write_csv(tmp_path / "a.csv", *lines), out)
    bounds = tg.FlowFilter(start="2025-04-22T09:00", end="2025-04-22T13:00")
    kept = tg.apply_filters(tg.read_flow(spark, out), bounds)
    assert [t.isoformat() for t in column(kept, "timestamp")] == ["2025-04-22T12:00:00"]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "GreaterThanOrEqual(timestamp" in scan and "PartitionFilters: [isnotnull(date" in scan


def test_create_flow_is_deduplicated(spark, tmp_path):
    rows = flow_of(spark, {"call_vega": 1.0}, {"call_vega": 2.0}).selectExpr(
        "*", "row_number() OVER (ORDER BY call_vega) AS at"
    )
    tg.create_flow(rows, str(tmp_path / "flow.parquet"), ["at"])
    assert column(tg.read_flow(spark, str(tmp_path / "flow.parquet")), "call_vega") == [1.0]


def test_hot_key_is_folded_before_the_shuffle(spark):
    flow = flow_of(spark, {}).drop("call_vega").crossJoin(spark.range(20000).withColumnRenamed("id", "call_vega"))
    firsts = dedup_first(flow, ["call_vega"])
    assert column(firsts, "call_vega") == [0]
    plan = firsts._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_min_by") > plan.index("Exchange")


def record(**values):
    row = {name: 1.0 for name in CSV_COLUMNS} | {
        "timestamp": "2025-04-14T09:31:00.000001-04:00", "Side": "Ask", "MBO": [4.0], "spx_strike": 5300
    }
    return row | values


def pack(path, body: str, times: int = 2):
    data = body.encode()
    for _ in range(times):
        data = gzip.compress(data)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data)


def quoted(body: str) -> str:
    return '"' + body.replace('"', '\\"') + '"'


def minute_name(minute: str) -> str:
    return f"loaded_lob_20250414__20250414_{minute}.csv.gz"


@pytest.fixture()
def landing(tmp_path):
    """Two good files (plain, quoted) and nine bad ones, in a day folder."""
    day = tmp_path / "raw" / "20250414"
    pack(day / minute_name("0931"), json.dumps([record(), record(Side="Bid", MBO=None, MBO_pulling_stacking=1)]))
    pack(day / minute_name("0932"), quoted(json.dumps([record(future_strike="7.5", MBO=[1, 2.5])])))
    pack(day / minute_name("0933"), "junk")
    (day / minute_name("0934")).write_bytes(b"no gzip at all")
    pack(day / minute_name("0935"), json.dumps([record()]), times=1)
    pack(day / minute_name("0936"), json.dumps([{k: v for k, v in record().items() if k != "put_rho"}]))
    pack(day / minute_name("0937"), json.dumps([record(), record(timestamp="noon")]))
    pack(day / minute_name("0941"), json.dumps([record(), record(spx_strike="abc")]))
    pack(day / minute_name("0942"), json.dumps([record(timestamp="2025-04-14T09:31:00")]))
    pack(day / minute_name("0943"), json.dumps([record(MBO="four")]))
    pack(day / minute_name("0944"), json.dumps([record(), {"put_rho": "call_rho"}]))
    return tmp_path / "raw"


def test_minute_files_decode_or_are_refused_whole(spark, landing):
    rows = tg.scan_minute_files(spark, str(landing / "*"))
    good = rows.where("_error IS NULL").orderBy("_file", "_row").collect()
    assert [(r.Side, r.MBO, r.future_strike) for r in good] == [
        ("Ask", "[4.0]", 1.0), ("Bid", "[]", 1.0), ("Ask", "[1,2.5]", 7.5)
    ]
    reasons = {r._file[-11:-7]: r._error for r in rows.where("_error IS NOT NULL").collect()}
    assert sorted(reasons) == ["0933", "0934", "0935", "0936", "0937", "0941", "0942", "0943", "0944"]
    assert "BadGzipFile" in reasons["0934"] and "BadGzipFile" in reasons["0935"]
    assert reasons["0933"] == "not a JSON array of records" and reasons["0936"] == "missing columns: put_rho"
    assert reasons["0937"] == reasons["0942"] == "unreadable timestamp"
    assert (reasons["0941"], reasons["0943"]) == ("unreadable spx_strike", "unreadable MBO")
    assert "missing columns" in reasons["0944"] and "call_rho" in reasons["0944"]


def test_truncated_json_is_refused(spark, tmp_path):
    body = json.dumps([record(), record(Side="Bid")])
    pack(tmp_path / "raw" / minute_name("0931"), body[:-20])
    rows = tg.scan_minute_files(spark, str(tmp_path / "raw")).collect()
    assert [r._error for r in rows] == ["not a JSON array of records"]


def test_stream_ingests_in_batches_and_restarts(spark, landing, tmp_path):
    out, checkpoint = str(tmp_path / "flow"), str(tmp_path / "checkpoint")
    query = tg.start_minute_stream(spark, str(landing), out, checkpoint, files_per_batch=2)
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"]]) == 6
    table = stored(spark, out)
    assert table.count() == 3
    assert sorted(column(table, "mbo_size"), key=str) == [3.5, 4.0, None]
    assert column(table.select("date").distinct(), "date")[0].isoformat() == "2025-04-14"
    refused = spark.read.parquet(f"{out}_quarantine")
    assert refused.count() == 9 and {"path", "error"} <= set(refused.columns)
    # A late file brings one known key and one new key; only the new file is read.
    late = [record(call_vega=9.0), record(spx_price=2.0, future_strike=3.0)]
    pack(landing / "20250414" / minute_name("0938"), json.dumps(late))
    again = tg.start_minute_stream(spark, str(landing), out, checkpoint, files_per_batch=2)
    again.awaitTermination()
    assert sum(p["numInputRows"] for p in again.recentProgress) == 1
    assert stored(spark, out).count() == 4
    assert 9.0 not in column(stored(spark, out), "call_vega")


def test_append_does_not_list_the_other_dates(spark, tmp_path):
    out, context = str(tmp_path / "flow"), spark.sparkContext
    days = [csv_line(timestamp=f"2025-{m:02d}-{d:02d}T10:00:00-04:00") for m in (4, 5) for d in range(1, 29)]
    tg.ingest_csv(spark, write_csv(tmp_path / "a.csv", *days), out)
    again = [days[0], days[40], csv_line(Side="Bid"), csv_line(timestamp="2025-04-02T10:00:00-04:00", Side="Bid")]
    for case, lines in enumerate((again[:1], again[2:3], again[:2], again)):
        rows = scan_csv(spark, write_csv(tmp_path / f"{case}.csv", *lines))
        context.setJobGroup(f"append {case}", "")
        counts = tg.append_flow(rows, out)
        jobs = [context.statusTracker().getJobInfo(j) for j in context.statusTracker().getJobIdsForGroup(f"append {case}")]
        stages = [context.statusTracker().getStageInfo(s) for job in jobs for s in job.stageIds]
        assert jobs and max(s.numTasks for s in stages if s) < len(days)
        assert counts["appended"] == (0, 1, 0, 1)[case]
    context.setLocalProperty("spark.jobGroup.id", None)
    assert stored(spark, out).count() == len(days) + 2


def test_keys_of_rows_without_a_time_are_found(spark, tmp_path):
    out = str(tmp_path / "flow")
    for case, (times, added) in enumerate((((None,), 1), ((None, "2025-04-22T15:47:00-04:00"), 1), ((None,), 0))):
        lines = [csv_line(timestamp=t or "") for t in times]
        assert tg.append_flow(scan_csv(spark, write_csv(tmp_path / f"{case}.csv", *lines)), out)["appended"] == added


def test_quarantine_is_there_without_refused_files_and_replaced(spark, tmp_path):
    out, bad = str(tmp_path / "flow"), tmp_path / "bad"
    pack(bad / minute_name("0931"), "no JSON")
    tg.ingest_minute_stream(spark, str(bad), out, str(tmp_path / "one"))
    assert spark.read.parquet(f"{out}_quarantine").count() == 1
    pack(tmp_path / "good" / minute_name("0931"), json.dumps([record()]))
    tg.ingest_minute_stream(spark, str(tmp_path / "good"), out, str(tmp_path / "two"))
    assert spark.read.parquet(f"{out}_quarantine").count() == 0
    tg.ingest_minute_stream(spark, str(tmp_path / "good"), f"{out}2", str(tmp_path / "three"))
    assert spark.read.parquet(f"{out}2_quarantine").count() == 0 and stored(spark, f"{out}2").count() == 1


def test_replayed_batch_adds_nothing(spark, landing, tmp_path):
    out = str(tmp_path / "flow")
    tg.ingest_minute_stream(spark, str(landing), out, str(tmp_path / "one"))
    before = spark_table(stored(spark, out))
    tg.ingest_minute_stream(spark, str(landing), out, str(tmp_path / "two"))
    assert spark_table(stored(spark, out)) == before


def test_coverage_gaps(spark, tmp_path):
    for minute in ("0921", "0922", "0924"):
        pack(tmp_path / "20250414" / minute_name(minute), "[]")
    expected = tg.expected_minutes(tg.dates_frame(spark, ["20250414"]), "0921", "0924")
    assert column(expected.orderBy("minute"), "minute") == ["0921", "0922", "0923", "0924"]
    landed = list_files(spark, str(tmp_path), recursive=True)
    gaps = tg.coverage_gaps(expected, landed).collect()
    assert [(r.minute, r.file_name) for r in gaps] == [("0923", minute_name("0923"))]
    assert tg.expected_minutes(tg.dates_frame(spark, ["20250414", "20250415"])).count() == 800
    assert tg.expected_minutes(tg.dates_frame(spark, ["20250414"]), "1000", "0900").count() == 0


def test_validation_report_on_missing_and_mistyped_columns(spark):
    flow = flow_of(spark, {}).drop("put_rho").withColumn("t", F.lit("x"))
    found = {(r.column, r.check) for r in tg.validation_report(flow, raw=False).collect()}
    assert found == {("put_rho", "missing_column"), ("t", "type_mismatch")}


def test_snapshot_export(spark, tmp_path):
    flow = flow_of(
        spark,
        {"MBO": "[2.0, 3.0]", "MBO_pulling_stacking": 1},
        {"Side": "Ask", "spx_strike": 5301, "call_vega": float("nan")},
    )
    manifest = tg.export_snapshot(flow, str(tmp_path / "out")).collect()
    assert len(manifest) == 23
    records = {r.name: r.records for r in manifest}
    assert records["kpi"] == 1 and records["scatter"] == 2 and records["histogram"] == 3
    assert all(r.bytes > 0 for r in manifest)

    def lines(name):
        parts = sorted((tmp_path / "out" / name).glob("part-*"))
        return [json.loads(line) for part in parts for line in part.read_text().splitlines()]

    assert lines("kpi")[0]["total_events"] == 2 and lines("kpi")[0]["total_ps_events"] == 1
    matrix = lines("correlation")[0]
    assert matrix["columns"] == GREEKS and len(matrix["matrix"]) == 16
    assert [r["call_vega"] for r in lines("scatter")] == [1.0, None]


def test_extract_formats(spark, tmp_path):
    flow = flow_of(spark, {"Side": "Bid"}, {"Side": "Ask"})
    tg.write_extract(flow, str(tmp_path / "j"), tg.FlowFilter(side="Ask"))
    tg.write_extract(flow, str(tmp_path / "c"), fmt="csv")
    assert spark.read.json(str(tmp_path / "j")).count() == 1
    csv = spark.read.option("header", True).csv(str(tmp_path / "c"))
    assert csv.count() == 2 and csv.columns == ["timestamp", "spx_price", "MBO_pulling_stacking"]
    with pytest.raises(ValueError):
        tg.write_extract(flow, str(tmp_path / "x"), fmt="xml")


def test_key_columns():
    assert KEY == ["timestamp", "Side", "future_strike"]
