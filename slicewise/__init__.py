"""Data-distribution and data-quality work on date-partitioned tables, as plain Spark jobs."""

from .operators.checks import Check, custom_query, dq_checks, in_range, in_set, matches, not_null, unique
from .operators.histograms import bounded_histogram, range_histogram
from .operators.history import (
    Run,
    current_stats,
    history_average,
    newest_runs,
    past_stats,
    read_rows,
    stats_of_all_slices,
    to_stats,
    write_rows,
    write_table,
)
from .operators.manifest import manifest, read_manifest, runs_in_state
from .operators.nested import flatten, nested_record_count
from .operators.parity import (
    parity_status,
    query_parity,
    result_json,
    result_set_parity,
    shape_parity,
    side_shapes,
    slice_sides,
)
from .operators.profiles import column_profile, gated_profile, multi_column_profile, value_profile
from .operators.requests import request_profile
from .operators.row_index import key_index, row_index
from .operators.side_by_side import (
    column_profile_vs_prior,
    gated_profile_pair,
    histogram_vs_prior,
    value_profile_vs_prior,
)
from .operators.trends import column_trend, column_value_trend, table_trend, threshold_suggest, zero_slices
from .operators.verdicts import (
    rule_status,
    run_status,
    run_verdict,
    scenario_status,
    trend_compare,
    with_point_gap,
    with_trend_gaps,
    with_trend_status,
)
from .plans.cross_side import result_validation, run_parity, run_parity_requests, shape_validation
from .plans.distribution import compare_with_prior, judge_slice, run_distribution, run_distribution_tables
from .sources.files import file_profile, json_field_profile, line_consistency, merge_files, merge_frames, read_json
from .sources.slices import (
    latest_slice_count,
    latest_slice_date,
    prior_slice_date,
    query_dataset,
    slice_count,
    slice_exists,
    slice_probe,
    slice_scan,
    table_count,
)
