"""Order-book and option-greeks analytics as Spark DataFrame operators."""

from tapeglass.operators.correlation import (
    correlation,
    correlation_matrix,
    label_correlation,
    matrix_record,
)
from tapeglass.operators.dedup import dedup_first, merge_new, merged_table
from tapeglass.operators.filters import ALL_ROWS, FlowFilter, apply_filters
from tapeglass.operators.greeks import (
    gex,
    gex_cells,
    gex_intraday,
    scatter,
    surface,
    surface_all,
    theta,
    vanna_charm,
)
from tapeglass.operators.levels import gex_flip, gex_levels, gex_profile
from tapeglass.operators.moments import correlation_from_moments, merged_moments, moments
from tapeglass.operators.ordering import first_events, last_events, last_n
from tapeglass.operators.rollup import (
    rollup_basis,
    rollup_depth,
    rollup_gex_intraday,
    rollup_heatmap,
    rollup_net_flow,
    rollup_spread,
)
from tapeglass.operators.sampling import exact_sample
from tapeglass.operators.signals import (
    basis,
    kpi,
    net_flow,
    ps_split,
    pulling_stacking,
    recent_pulling_stacking,
)
from tapeglass.operators.validation import ValidationError, bad_sides, schema_issues, validation_report
from tapeglass.operators.volume import (
    depth,
    depth_cells,
    depth_ladder,
    heatmap,
    heatmap_cells,
    histogram_bins,
    histogram_values,
    size_counts,
    spread,
    volume_over_time,
)
from tapeglass.plans.extract import extract, write_extract
from tapeglass.plans.snapshot import SMALL_LIMITS, export_snapshot, snapshot_queries
from tapeglass.session import build_session
from tapeglass.sources.compaction import compact
from tapeglass.sources.csv_files import ingest_csv, scan_csv
from tapeglass.sources.flow_table import append_flow, create_flow, read_flow, refresh_side_tables, side_table
from tapeglass.sources.listing import list_files
from tapeglass.sources.minute_calendar import coverage_gaps, dates_frame, expected_minutes, gap_intervals
from tapeglass.sources.minute_files import decode_minute_files, scan_minute_files
from tapeglass.streaming.minute_stream import ingest_minute_stream, start_minute_stream
