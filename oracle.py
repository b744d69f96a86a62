"""Independent SQL for the registered queries, over the same Parquet tables registered as views.

Every statement starts from the flow columns derived from `events`; the query logic below them is written
in plain SQL and shares nothing with the Spark operators.
"""

from __future__ import annotations

from tapeglass.schema import CALL_GREEKS, GREEKS
from tapeglass.sources.events_view import flow_expressions
from tapeglass.sources.minute_calendar import FIRST_MINUTE, LAST_MINUTE

FLOW = f"SELECT event_id, event_type, {', '.join(flow_expressions())} FROM events"
SIZES = "from_json(CASE WHEN json_valid(MBO) THEN MBO END, '[\"DOUBLE\"]')"
BASE = f"""
WITH flow AS ({FLOW}),
live AS (
  SELECT * FROM flow WHERE CAST(timestamp AS TIME) BETWEEN TIME '09:30:00' AND TIME '16:15:00'
),
sized AS (SELECT *, list_sum({SIZES}) AS mbo_size FROM live),
whole AS (SELECT *, list_sum({SIZES}) AS mbo_size FROM flow)
"""

KPI = """
SELECT count(*) AS total_events, count(DISTINCT spx_strike) AS unique_strikes,
  min(timestamp) AS start_date, max(timestamp) AS end_date,
  count(DISTINCT future_strike) AS unique_es_strikes, avg(spx_price) AS avg_spx_price,
  CAST(sum(CASE WHEN MBO_pulling_stacking <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS total_ps_events
FROM {src}"""

BASIS = """
SELECT time_bucket(INTERVAL '{width}', timestamp) AS time_bucket,
  round(avg(CAST(current_es_price / 100 AS FLOAT)), 6) AS es_price, avg(spx_price) AS spx_price,
  round(avg(CAST(CAST(current_es_price / 100 AS FLOAT) - spx_price AS FLOAT)), 6) AS basis
FROM {src} GROUP BY 1"""

NET_FLOW = """
SELECT time_bucket(INTERVAL '{width}', timestamp) AS time_bucket,
  sum(call_delta * mbo_size) AS call_delta_flow, sum(-put_delta * mbo_size) AS put_delta_flow,
  sum((call_delta - put_delta) * mbo_size) AS net_delta
FROM {src} GROUP BY 1"""

HEATMAP = """
SELECT time_bucket(INTERVAL '{width}', timestamp) AS time_bucket, future_strike, sum(mbo_size) AS total_size
FROM {src} GROUP BY 1, 2"""

SPREAD = """
SELECT a.tb AS time_bucket, a.strike - b.strike AS spread, a.price AS spx_price
FROM (SELECT time_bucket(INTERVAL '{width}', timestamp) AS tb, avg(future_strike) AS strike,
        avg(spx_price) AS price FROM {src} WHERE Side = 'Ask' GROUP BY 1) a
JOIN (SELECT time_bucket(INTERVAL '{width}', timestamp) AS tb, avg(future_strike) AS strike
        FROM {src} WHERE Side = 'Bid' GROUP BY 1) b ON a.tb = b.tb"""

DEPTH = """
SELECT future_strike, Side, count(*) AS event_count, sum(mbo_size) AS total_size
FROM {src} GROUP BY 1, 2"""

EXPOSURE = """avg(spx_price) AS spx_price,
  sum(call_gamma * mbo_size * CASE WHEN Side = 'Bid' THEN 1 ELSE 0 END) AS long_gex,
  sum(call_gamma * mbo_size * CASE WHEN Side = 'Ask' THEN 1 ELSE 0 END) AS short_gex,
  sum(call_gamma * mbo_size * CASE WHEN Side = 'Bid' THEN 1 ELSE -1 END) AS net_gex"""

GEX = "SELECT spx_strike, " + EXPOSURE + " FROM {src} GROUP BY 1"
GEX_INTRADAY = (
    "SELECT time_bucket(INTERVAL '{width}', timestamp) AS time_bucket, " + EXPOSURE + " FROM {src} GROUP BY 1"
)

def _finite(value: str) -> str:
    return f"CASE WHEN isfinite({value}) THEN {value} END"


# Infinite and missing expiries are groups of their own; both are shown as NULL.
EXPIRY = "CASE WHEN isfinite(t) THEN round(t, 4) ELSE t END"
SURFACE = f"""
SELECT spx_strike, {_finite('e')} AS t, {_finite('avg({greek})')} AS greek_value
FROM (SELECT *, {EXPIRY} AS e FROM {{src}}) GROUP BY spx_strike, e"""

STRIKE_MEANS = """
SELECT spx_strike, avg(call_{metric}) AS call_value, avg(put_{metric}) AS put_value FROM {src} GROUP BY 1"""

THETA = f"""
SELECT spx_strike, {_finite('e')} AS t, avg(call_theta) AS call_theta, avg(put_theta) AS put_theta
FROM (SELECT *, {EXPIRY} AS e FROM {{src}}) GROUP BY spx_strike, e"""

SCATTER = f"""
SELECT spx_strike, avg(call_vega) AS call_vega, {_finite('avg(call_vomma)')} AS call_vomma, count(*) AS mbo_count
FROM {{src}} GROUP BY 1"""

# NULL, NaN and infinity count as 0; corr() is NULL or NaN on a constant column, which counts as 0 as well.
def _correlation(src: str) -> str:
    def r(a: str, b: str) -> str:
        return f"CASE WHEN isfinite(corr({a}, {b})) THEN round(corr({a}, {b}), 4) ELSE CAST(0 AS DOUBLE) END"

    zeroed = ", ".join(f"CAST(CASE WHEN isfinite({g}) THEN {g} ELSE 0 END AS DOUBLE) AS {g}" for g in GREEKS)
    wide = ", ".join(f"{r(a, b)} AS {a}__{b}" for a in GREEKS for b in GREEKS if a != b)
    cells = " UNION ALL ".join(
        f"SELECT '{a}' AS greek_i, '{b}' AS greek_j, "
        + ("CAST(1 AS DOUBLE)" if a == b else f"{a}__{b}")
        + " AS r FROM wide"
        for a in GREEKS
        for b in GREEKS
    )
    return f""", z AS (SELECT {zeroed} FROM {src}), wide AS MATERIALIZED (SELECT {wide} FROM z), long AS ({cells})"""


LABELS = """
SELECT greek_i, greek_j, r,
  CASE WHEN greek_i LIKE 'call%' THEN 'C' ELSE 'P' END AS leg_i, substr(greek_i, strpos(greek_i, '_') + 1) AS name_i,
  CASE WHEN greek_j LIKE 'call%' THEN 'C' ELSE 'P' END AS leg_j, substr(greek_j, strpos(greek_j, '_') + 1) AS name_j,
  substr(greek_i, strpos(greek_i, '_')) = substr(greek_j, strpos(greek_j, '_')) AS same_greek,
  substr(greek_i, 1, 1) <> substr(greek_j, 1, 1) AS cross_leg,
  CASE WHEN abs(r) > 0.9 THEN 'near-perfect' WHEN abs(r) > 0.7 THEN 'strong' WHEN abs(r) > 0.5 THEN 'moderate'
       WHEN abs(r) > 0.3 THEN 'weak' ELSE 'near-zero' END AS strength,
  CASE WHEN r > 0 THEN 'positive' ELSE 'negative' END AS direction,
  CASE WHEN abs(r) > 0.85 THEN 'very strong' WHEN abs(r) > 0.6 THEN 'moderate-to-strong'
       WHEN abs(r) > 0.3 THEN 'weak' ELSE 'near-zero' END AS drill_band,
  CASE WHEN r < 0 THEN 'opposite' ELSE 'together' END AS drill_direction
FROM long"""


def _matrix() -> str:
    place = "list_position([" + ", ".join(f"'{g}'" for g in GREEKS) + "], {})"
    kept = f"{place.format('greek_j')} <= {place.format('greek_i')}"
    columns = ", ".join(
        f"max(CASE WHEN greek_j = '{g}' AND {kept} THEN r END) AS {g}" for g in GREEKS
    )
    return f"SELECT greek_i, {columns} FROM long GROUP BY greek_i"


SIZE_VALUES = "SELECT unnest({sizes}) AS mbo_value FROM {src}"

HISTOGRAM = """, v AS (SELECT unnest({sizes}) AS x FROM {src}), p AS (SELECT x FROM v WHERE x > 0),
m AS (SELECT max(x) AS hi, max(x) / {bins} AS step FROM p),
b AS (SELECT CAST(least(floor(x / step), {bins} - 1) AS INTEGER) AS bin, count(*) AS n FROM p, m GROUP BY 1)
SELECT CAST(i AS INTEGER) AS bin, i * step AS lower_edge,
  CAST(CAST(round(i * step, 0) AS BIGINT) AS VARCHAR) AS range, coalesce(n, 0) AS count
FROM range({bins}) g(i) CROSS JOIN m LEFT JOIN b ON b.bin = g.i WHERE hi IS NOT NULL"""

LADDER = """
SELECT future_strike AS strike, coalesce(sum(CASE WHEN Side = 'Bid' THEN mbo_size END), 0) AS bid,
  0 - coalesce(sum(CASE WHEN Side = 'Ask' THEN mbo_size END), 0) AS ask
FROM sized GROUP BY 1 ORDER BY abs(bid) + abs(ask) DESC, strike LIMIT 40"""

LEVELS_CTE = (
    ", g AS ("
    + GEX.format(src="sized")
    + """), n AS (SELECT *, coalesce(net_gex, 0) AS net, lag(coalesce(net_gex, 0)) OVER w AS above_net,
    lag(spx_strike) OVER w AS above FROM g WINDOW w AS (ORDER BY spx_strike DESC)),
flip AS (SELECT (above + spx_strike) / CAST(2 AS DOUBLE) AS flip_point FROM n
  WHERE above_net > 0 AND net <= 0 ORDER BY spx_strike DESC LIMIT 1),
tops AS (SELECT avg(coalesce(spx_price, 0)) AS price, sum(net) AS total FROM n)"""
)

LEVELS = (
    LEVELS_CTE
    + """
SELECT round(price, 6) AS price, total AS total_net_gex,
  (SELECT spx_strike FROM n ORDER BY abs(net) DESC, spx_strike LIMIT 1) AS pin_strike,
  (SELECT spx_strike FROM n ORDER BY coalesce(long_gex, 0) DESC, spx_strike LIMIT 1) AS long_wall,
  (SELECT spx_strike FROM n ORDER BY coalesce(short_gex, 0) DESC, spx_strike LIMIT 1) AS short_wall,
  (SELECT flip_point FROM flip) AS flip_point,
  CASE WHEN total > 0 THEN 'LONG GAMMA' ELSE 'SHORT GAMMA' END AS regime,
  coalesce(price > (SELECT flip_point FROM flip), false) AS above_flip
FROM tops"""
)

PROFILE = (
    LEVELS_CTE
    + """
SELECT spx_strike, spx_price, long_gex, short_gex, net_gex, round(price, 6) AS price,
  abs(spx_strike - price) <= 2 AS near_price
FROM g, tops WHERE spx_strike >= price * (1 - {band}) AND spx_strike <= price * (1 + {band})"""
)

PS = "SELECT timestamp, spx_price, MBO_pulling_stacking FROM live"
PS_ORDER = "ORDER BY timestamp{d}, Side{d}, future_strike{d}"

COARSE = """, coarse AS (
  SELECT event_id, event_type, CAST(CAST(timestamp AS DATE) AS TIMESTAMP) AS timestamp, Side, future_strike,
    MBO, MBO_pulling_stacking, current_es_price, spx_strike, t, spx_price, {greeks} FROM flow)
SELECT * EXCLUDE (event_id, event_type) FROM coarse
QUALIFY row_number() OVER (PARTITION BY timestamp, Side, future_strike ORDER BY {rank}event_id) = 1"""

DAYS = """, days AS (SELECT DISTINCT CAST(timestamp AS DATE) AS date FROM flow WHERE timestamp IS NOT NULL),
expected AS (SELECT date, i AS clock FROM days, range({first}, {last} + 1) r(i)),
calendar AS (SELECT date, printf('%02d%02d', CAST(floor(clock / 60) AS BIGINT), clock % 60) AS minute,
  printf('loaded_lob_%s__%s_%02d%02d.csv.gz', strftime(date, '%Y%m%d'), strftime(date, '%Y%m%d'),
    CAST(floor(clock / 60) AS BIGINT), clock % 60) AS file_name FROM expected)"""

GAPS = """
SELECT * FROM calendar WHERE (date, minute) NOT IN
  (SELECT (CAST(timestamp AS DATE), strftime(timestamp, '%H%M')) FROM flow WHERE timestamp IS NOT NULL)"""

# Text as it would stand in a file, with faults that depend on the event type; see raw_text in the entry module.
RAW_TEXT = {
    "timestamp": (
        "CASE event_type WHEN 'error' THEN concat('at ', CAST(event_id AS VARCHAR(20)))"
        " ELSE CASE event_id % 7 WHEN 1 THEN '10:00' WHEN 2 THEN '2025' WHEN 3 THEN CAST(timestamp AS VARCHAR(40))"
        " WHEN 4 THEN NULL ELSE CASE WHEN timestamp IS NOT NULL"
        " THEN concat(replace(CAST(timestamp AS VARCHAR(40)), ' ', 'T'), '-05:00') END END END"
    ),
    "Side": "CASE event_type WHEN 'signup' THEN 'Mid' WHEN 'view' THEN NULL ELSE Side END",
    "future_strike": (
        "CASE event_type WHEN 'purchase' THEN concat('s', CAST(spx_strike AS VARCHAR(20)))"
        " ELSE CAST(spx_strike AS VARCHAR(20)) END"
    ),
    "MBO": "CASE event_type WHEN 'click' THEN concat('[', CAST(spx_strike AS VARCHAR(20)), ',') ELSE MBO END",
}

REPORT = f""", raw AS (SELECT {", ".join(f"{e} AS {n}" for n, e in RAW_TEXT.items())} FROM flow),
found AS (
  SELECT 'timestamp' AS "column", 'bad_cast' AS "check", timestamp AS v FROM raw
    WHERE NOT regexp_full_match(timestamp, '\\d{{4}}-\\d\\d-\\d\\dT\\d\\d:\\d\\d:\\d\\d([.]\\d+)?[+-]\\d\\d:?\\d\\d')
  UNION ALL SELECT 'future_strike', 'bad_cast', future_strike FROM raw
    WHERE future_strike IS NOT NULL AND TRY_CAST(future_strike AS FLOAT) IS NULL
  UNION ALL SELECT 'timestamp', 'null_key', NULL FROM raw WHERE timestamp IS NULL
  UNION ALL SELECT 'Side', 'null_key', NULL FROM raw WHERE Side IS NULL
  UNION ALL SELECT 'future_strike', 'null_key', NULL FROM raw WHERE future_strike IS NULL
  UNION ALL SELECT 'Side', 'side_domain', Side FROM raw WHERE Side NOT IN ('Bid', 'Ask')
  UNION ALL SELECT 'MBO', 'bad_json', MBO FROM raw WHERE NOT json_valid(MBO))
SELECT "column", "check", count(*) AS n_bad, min(v) AS sample FROM found GROUP BY 1, 2"""

BAD_SIDES = f""", raw AS (SELECT {RAW_TEXT["Side"]} AS Side FROM flow)
SELECT Side, count(*) AS n_bad FROM raw WHERE Side NOT IN ('Bid', 'Ask') GROUP BY 1"""

INGESTED_COLUMNS = [
    "timestamp", "Side", "future_strike", "MBO_pulling_stacking", "current_es_price", "spx_strike", "t", "spx_price",
    *GREEKS, "mbo_size",
]
# Non-finite values are compared as NULL.
INGESTED = ", ".join(f"{_finite(c)} AS {c}" if c in ("t", *GREEKS) else c for c in INGESTED_COLUMNS)
# Events in a file of the quarantine check.
QUARANTINE_FILE_EVENTS = 500
FIRST_PER_KEY = (
    " QUALIFY row_number() OVER (PARTITION BY timestamp, Side, future_strike ORDER BY event_id) = 1"
)


# A table of several appends: the first one that has a key wins, and the first row in it.
APPENDED = """, stored AS (SELECT *, CAST(timestamp AS TIME) BETWEEN TIME '09:30:00' AND TIME '16:15:00' AS inside FROM whole
  QUALIFY row_number() OVER (PARTITION BY timestamp, Side, future_strike ORDER BY event_id % {appends}, event_id) = 1),
stored_live AS (SELECT * FROM stored WHERE inside)"""


def _rollup_buckets() -> str:
    series = {
        "basis": (BASIS, ["es_price", "spx_price", "basis"]),
        "net_flow": (NET_FLOW, ["call_delta_flow", "put_delta_flow", "net_delta"]),
        "spread": (SPREAD, ["spread", "spx_price"]),
        "gex": (GEX_INTRADAY, ["long_gex", "short_gex", "net_gex"]),
    }
    made = []
    for width in ("5 seconds", "1 minute", "5 minutes", "45 minutes"):
        for name, (text, values) in series.items():
            rounded = [f"round({v}, 6) AS {c}" for c, v in zip("abc", values)] + [f"NULL AS {c}" for c in "abc"[len(values) :]]
            rows = text.format(width=width, src="stored_live")
            made.append(f"SELECT '{name}' AS series, '{width}' AS width, time_bucket, {', '.join(rounded)} FROM ({rows})")
    return APPENDED.format(appends=3) + " " + " UNION ALL ".join(made)


def _sampled(rows: str, n: int) -> str:
    """The rows of the smallest hashes of their key."""
    texts = ["strftime(timestamp, '%Y%m%d%H%M%S%f')", "Side", "CAST(future_strike AS VARCHAR)"]
    key = " || '|' || ".join(["'42'", *(f"coalesce({text}, '-')" for text in texts)])
    return f"SELECT * FROM {rows} ORDER BY substr(md5({key}), 1, 15), timestamp NULLS FIRST, Side NULLS FIRST, future_strike, {{rest}} LIMIT {n}"


def oracle_queries() -> dict[str, str]:
    minutes = {
        name: int(at[:2]) * 60 + int(at[2:]) for name, at in (("first", FIRST_MINUTE), ("last", LAST_MINUTE))
    }
    days = DAYS.format(**minutes)
    greeks = ", ".join(GREEKS)
    existing_first = "CASE WHEN event_type IN ('view', 'signup') THEN 0 ELSE 1 END, "
    basis_1m = BASIS.format(width="1 minute", src="live")
    sql = {
        "kpi": KPI.format(src="live"),
        "basis": basis_1m,
        "basis_45m": BASIS.format(width="45 minutes", src="live"),
        "last_basis": f"SELECT * FROM ({basis_1m}) ORDER BY time_bucket DESC LIMIT 120",
        "net_flow": NET_FLOW.format(width="1 minute", src="sized"),
        "heatmap": HEATMAP.format(width="1 minute", src="sized"),
        "heatmap_bid": HEATMAP.format(width="15 minutes", src="sized WHERE Side = 'Bid'"),
        "volume_over_time": (
            "SELECT time_bucket(INTERVAL '1 minute', timestamp) AS time_bucket,"
            " coalesce(sum(mbo_size), 0) AS total_size FROM sized GROUP BY 1"
        ),
        "spread": SPREAD.format(width="60 minutes", src="live"),
        "depth": DEPTH.format(src="sized"),
        "depth_ladder": LADDER,
        "histogram_values": SIZE_VALUES.format(sizes=SIZES, src="live"),
        "size_counts": (
            f"SELECT mbo_value, count(*) AS occurrences FROM ({SIZE_VALUES.format(sizes=SIZES, src='live')}) GROUP BY 1"
        ),
        "histogram_bins": HISTOGRAM.format(sizes=SIZES, src="live", bins=40),
        "surface": SURFACE.format(greek="call_vega", src="live"),
        "surface_all": (
            f"SELECT spx_strike, {_finite('e')} AS t, "
            + ", ".join(f"{_finite(f'avg({g})')} AS {g}" for g in GREEKS)
            + f" FROM (SELECT *, {EXPIRY} AS e FROM live) GROUP BY spx_strike, e"
        ),
        "vanna": STRIKE_MEANS.format(metric="vanna", src="live"),
        "charm": STRIKE_MEANS.format(metric="charm", src="live"),
        "theta": THETA.format(src="live"),
        "scatter": SCATTER.format(src="live"),
        "gex": GEX.format(src="sized"),
        "gex_intraday": GEX_INTRADAY.format(width="5 minutes", src="sized"),
        "gex_levels": LEVELS,
        "gex_flip": LEVELS_CTE + " SELECT (SELECT flip_point FROM flip) AS flip_point",
        "gex_profile": PROFILE.format(band=0.08),
        "gex_profile_narrow": PROFILE.format(band=0.005),
        "correlation_long": _correlation("live") + " SELECT * FROM long",
        "correlation_matrix": _correlation("live") + " " + _matrix(),
        "correlation_labels": _correlation("live") + LABELS,
        "pulling_stacking": PS,
        "first_events": f"{PS} {PS_ORDER.format(d='')} LIMIT 1000",
        "ps_events": f"{PS} WHERE MBO_pulling_stacking <> 0",
        "ps_split": (
            "SELECT timestamp, spx_price, MBO_pulling_stacking,"
            " CASE WHEN MBO_pulling_stacking < 0 THEN spx_price END AS pulling,"
            " CASE WHEN MBO_pulling_stacking > 0 THEN spx_price END AS stacking FROM live"
        ),
        "last_ps": f"{PS} {PS_ORDER.format(d=' DESC')} LIMIT 500",
        "extract": (
            "SELECT timestamp, spx_price, MBO_pulling_stacking FROM live WHERE Side = 'Bid'"
            " AND timestamp >= TIMESTAMP '2024-01-05 10:00:00' AND timestamp <= TIMESTAMP '2024-01-25 15:00:00'"
            " AND spx_strike BETWEEN 5240.5 AND 5310 AND t BETWEEN 0.005 AND 0.025"
        ),
        "dedup_first": COARSE.format(greeks=greeks, rank=""),
        "dedup_merge": COARSE.format(greeks=greeks, rank=existing_first),
        "minute_calendar": days + " SELECT * FROM calendar",
        "coverage_gaps": days + GAPS,
        "validation_report": REPORT,
        "bad_sides": BAD_SIDES,
        "minute_decode": f"SELECT {INGESTED} FROM whole",
        "csv_ingest": f"SELECT {INGESTED} FROM whole{FIRST_PER_KEY}",
        "snapshot_kpi": KPI.format(src="flow"),
        "snapshot_basis": BASIS.format(width="5 seconds", src="flow"),
        "snapshot_net_flow": NET_FLOW.format(width="5 seconds", src="whole"),
        "snapshot_spread": SPREAD.format(width="5 seconds", src="flow"),
        "snapshot_heatmap": (
            HEATMAP.format(width="5 seconds", src="whole")
        ),
        "snapshot_depth": DEPTH.format(src="whole"),
        "snapshot_theta": THETA.format(src="flow"),
        "snapshot_scatter": SCATTER.format(src="flow"),
        "snapshot_gex": GEX.format(src="whole"),
        "snapshot_gex_intraday": (
            GEX_INTRADAY.format(width="5 seconds", src="whole")
        ),
        "snapshot_vanna": STRIKE_MEANS.format(metric="vanna", src="flow"),
        "snapshot_charm": STRIKE_MEANS.format(metric="charm", src="flow"),
        "snapshot_pulling_stacking": "SELECT timestamp, spx_price, MBO_pulling_stacking FROM flow",
    }
    sql |= {f"snapshot_surface_{g}": SURFACE.format(greek=g, src="flow") for g in CALL_GREEKS}
    values = SIZE_VALUES.format(sizes=SIZES, src="flow")
    sql["snapshot_histogram"] = f"SELECT mbo_value, count(*) AS occurrences FROM ({values}) GROUP BY 1"
    counted = ["SELECT 'correlation' AS name, CAST(1 AS BIGINT) AS records"]
    for short in [n.removeprefix("snapshot_") for n in sql if n.startswith("snapshot_")]:
        name = f"vanna_charm_{short}" if short in ("vanna", "charm") else short
        rows = f"({sql[f'snapshot_{short}']})"
        counted.append(f"SELECT '{name}', count(*) FROM {rows}")
    sql["snapshot_export"] = " UNION ALL ".join(counted)
    kept = ", ".join(f"{_finite(c)} AS {c}" if c in ("t", *GREEKS) else c for c in INGESTED_COLUMNS[:-1])
    firsts = COARSE.format(greeks=greeks, rank="")
    first, rest = firsts.split("SELECT * EXCLUDE (event_id, event_type)")
    merged = COARSE.format(greeks=greeks, rank=existing_first).split("SELECT * EXCLUDE (event_id, event_type)")[1]
    long = _correlation("live")
    sql |= {
        "append_existing": f"{first} SELECT {kept} {merged}",
        "create_flow": f"{first} SELECT {kept} {rest}",
        "ledger_rerun": (
            f", kept AS (SELECT DISTINCT CAST(timestamp AS DATE), Side, future_strike FROM flow),"
            " n AS (SELECT (SELECT count(*) FROM flow) AS whole, (SELECT count(*) FROM kept) AS firsts)"
            " SELECT 0 AS run, true AS every_file, false AS no_file, whole AS read, firsts AS appended FROM n"
            " UNION ALL SELECT 1, false, true, 0, 0 UNION ALL SELECT 2, true, false, whole, 0 FROM n"
        ),
        "list_files": " SELECT DISTINCT 'Side=Bid' AS folder, true AS every_file FROM flow WHERE Side = 'Bid'",
        "snapshot_files": GEX.format(src="whole"),
        "matrix_record": long + " SELECT greek_i, greek_j, r FROM long",
        "write_extract": (
            f"SELECT *, 'json' AS format FROM ({PS} WHERE Side = 'Ask')"
            f" UNION ALL SELECT *, 'csv' FROM ({PS} WHERE Side = 'Ask')"
        ),
        "schema_issues": """
SELECT 'put_rho' AS "column", 'missing_column' AS "check", CAST(1 AS BIGINT) AS n_bad, NULL AS sample
UNION ALL SELECT 't', 'type_mismatch', 1, 'string'
UNION ALL SELECT 'timestamp', 'null_key', count(*), NULL FROM flow WHERE timestamp IS NULL
UNION ALL SELECT 'Side', 'null_key', count(*), NULL FROM flow WHERE Side IS NULL
UNION ALL SELECT 'MBO', 'bad_json', count(*), min(MBO) FROM flow WHERE NOT json_valid(MBO)""",
        "non_finite": f"SELECT event_id, {_finite('t')} AS t, {_finite('call_vomma')} AS call_vomma FROM flow",
        "validation_abort": (
            "SELECT 'future_strike: bad_cast x' || count(*) || ' (''s'')' AS message, false AS written"
            " FROM flow WHERE event_type = 'error'"
        ),
        "minute_quarantine": f"""
SELECT CAST(file AS VARCHAR) AS path, CASE file % 6 WHEN 1 THEN 'unreadable spx_price' WHEN 2 THEN 'unreadable MBO'
  WHEN 3 THEN 'unreadable timestamp' WHEN 4 THEN 'missing columns: put_rho' END AS error
FROM (SELECT event_id // {QUARANTINE_FILE_EVENTS} AS file FROM flow
  WHERE timestamp IS NOT NULL AND event_id % {QUARANTINE_FILE_EVENTS} = 123) WHERE file % 6 BETWEEN 1 AND 4""",
        "minute_stream": f"SELECT {kept} FROM whole{FIRST_PER_KEY}",
    }
    appended, moments = APPENDED.format(appends=3), _correlation("stored_live")
    shown = "SELECT timestamp, Side, future_strike, spx_price, MBO_pulling_stacking"
    sampled = _sampled("live", 1000).format(rest="spx_price, MBO_pulling_stacking")
    greeks_first = ", ".join(f"{g} NULLS FIRST" for g in GREEKS)
    sql |= {
        "rollup_buckets": _rollup_buckets(),
        "rollup_strikes": appended
        + " SELECT time_bucket, future_strike, 'Bid' AS Side, total_size, NULL AS event_count FROM ("
        + HEATMAP.format(width="15 minutes", src="stored_live WHERE Side = 'Bid'")
        + ") UNION ALL SELECT NULL, future_strike, Side, total_size, event_count FROM ("
        + DEPTH.format(src="stored")
        + ")",
        "moments_correlation": appended + moments + " SELECT * FROM long",
        "one_scan_correlation": _correlation("live") + " SELECT * FROM long",
        "indexed_events": appended
        + " (SELECT timestamp, spx_price, MBO_pulling_stacking, 'first' AS part FROM stored_live WHERE MBO_pulling_stacking <> 0"
        f" {PS_ORDER.format(d='')} LIMIT 700) UNION ALL (SELECT timestamp, spx_price, MBO_pulling_stacking, 'last'"
        f" FROM stored_live {PS_ORDER.format(d=' DESC')} LIMIT 500)",
        "filtered_append": f"{appended} SELECT {kept} FROM stored",
        "compacted": f"{APPENDED.format(appends=10)} SELECT {kept} FROM stored",
        "gap_intervals": days
        + f", gaps AS ({GAPS}), numbered AS (SELECT date, minute, CAST(minute[:2] AS INT) * 60 + CAST(minute[3:] AS INT)"
        " - row_number() OVER (PARTITION BY date ORDER BY minute) AS run FROM gaps)"
        ' SELECT date, min(minute) AS "from", max(minute) AS "to", count(*) AS count FROM numbered GROUP BY date, run',
        "sample_events": f"{shown} FROM ({sampled})",
        "sample_correlation": ", picked AS ("
        + _sampled("flow", 50_000).format(rest=greeks_first)
        + ")"
        + _correlation("picked")
        + " SELECT * FROM long",
        "sample_sizes": ", picked AS (" + _sampled("flow", 10_000).format(rest="MBO NULLS FIRST") + ") " + SIZE_VALUES.format(sizes=SIZES, src="picked"),
    }
    return {name: BASE + text for name, text in sql.items()}
