"""Explicit schemas of the documents and tables the engine reads and keeps."""

from __future__ import annotations

# Score report. Its metrics are read member by member (``METRIC``), so one misshapen member costs no other; the
# execution summary keeps its JSON text.
REPORT = """
  schema_version bigint, name string, dataset_name string, dataset_pretty_name string, model_name string,
  metrics array<string>,
  primary_metric_identity struct<name:string,aggregation:string,dimensions:string>,
  execution_summary string, perf_metrics string
"""

# One metric of a report. Scores and counts are read as text so that NULL, 0, text and non-finite values stay apart;
# ``damaged`` holds the text of a member that does not have this shape.
METRIC = """struct<
  identity:struct<name:string,aggregation:string,dimensions:string>,
  legacy_name:string, num:string, score:string, macro_score:string,
  categories:array<struct<name:array<string>, num:string, score:string, macro_score:string,
    subsets:array<struct<name:string, score:string, num:string, is_aggregate:boolean>>>>,
  semantics:struct<kind:string, direction:string, raw_unit:string, display_kind:string, display_unit:string>,
  damaged:string>
"""

# Prediction and review lines. Ids and usage members are variants: a member that
# is null must stay apart from one that is missing, a number from a text.
EVIDENCE_LINE = """struct<
  sample_id:variant, index:variant, repeat_id:variant, repeat:variant, sample_score:struct<sample_id:string>,
  model_output:struct<choices:array<struct<stop_reason:string>>, usage:map<string,variant>>,
  agent_trace:struct<events:array<struct<type:string, payload:struct<stop_reason:string>>>, total_usage:map<string,variant>>,
  metadata:struct<docker_image:string>>
"""

RUN_MANIFEST = """
  attempt_id string, run_group string, suite string, profile string, dataset string, model_alias string,
  model_id string, report_id string, api_url string, created_at string, model_config_identity string,
  protocol_identity string, sample_manifest_identity string,
  sample_manifest array<struct<subset:string, selected:bigint, sample_ids:array<string>, question_digest:string,
    media_digest:string, input_digest:string, media_evidence:boolean>>,
  sample_manifest_detail string, task_config string, baseline_swe_images array<string>,
  output_dir string, git_commit string
"""

MANIFEST_DETAIL = """
  map<string, array<struct<id:string, question_digest:string, media_digest:string, input_digest:string,
    media_evidence:boolean>>>
"""

RUNS = """
  run_id string, run_group string, model_alias string, model_id string, api_url string,
  model_config_identity string, suite string, profile string, dataset string, execution_status string,
  validity_status string, status_reason string, phase string, comparability string, started_at timestamp,
  finished_at timestamp, num_requested bigint, num_succeeded bigint, num_errored bigint, incomplete boolean,
  harness_version string, tool_version string, git_commit string, output_dir string, report_path string,
  config_json string, protocol_identity string, sample_manifest_identity string, primary_metric_json string,
  diagnostics_json string, perf_json string, error string, imported_at timestamp
"""

METRICS = """
  run_id string, metric_key string, metric_name string, aggregation string, dimensions_json string,
  category_key string, category_json string, subset string, num bigint, score double, macro_score double,
  semantics_kind string, display_kind string, direction string, unit string, is_primary boolean
"""

SAMPLE_MANIFEST = """
  run_id string, subset string, selected bigint, predicted bigint, reviewed bigint, sample_ids_json string,
  question_digest string, media_digest string, input_digest string, media_evidence boolean,
  predicted_missing bigint, predicted_extra bigint, predicted_duplicates bigint,
  reviewed_missing bigint, reviewed_extra bigint, reviewed_duplicates bigint, evidence_scoped boolean
"""
