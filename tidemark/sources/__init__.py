from tidemark.sources.artifacts import (
    artifacts_exist, load_latest, require_same_version, run_stamp, save_artifacts)
from tidemark.sources.delimited import (
    files_by_stem, read_delimited, read_wide_csv, with_file_key)
from tidemark.sources.json_arrays import (
    dataset_id, page_audit, read_json_array, read_pages, route_datasets)
from tidemark.sources.publication import publish, read_published
from tidemark.sources.reports import (
    clean_export, export_audit, number_lines, read_report, split_lines)
from tidemark.sources.tables import (
    ensure_database, existing_table, literal_rows, mirror, read_partitioned, register_table,
    sql_sample, with_gold_audit, with_silver_audit, write_gold, write_scores, write_silver)

__all__ = [
    "artifacts_exist", "clean_export", "dataset_id", "ensure_database", "existing_table",
    "export_audit", "files_by_stem", "literal_rows", "load_latest", "mirror", "number_lines", "page_audit",
    "publish", "read_delimited", "read_json_array", "read_pages", "read_partitioned",
    "read_published", "read_report", "read_wide_csv", "register_table", "require_same_version",
    "route_datasets", "run_stamp", "save_artifacts", "split_lines", "sql_sample", "with_file_key",
    "with_gold_audit", "with_silver_audit", "write_gold", "write_scores", "write_silver",
]
