"""sluice: batch table preparation on Spark.

Sources (catalog, JDBC, CSV, JSON arrays, SQL dumps), schema alignment and drift reports,
global row numbers, positional zip and survey ids, partitioned writes with explicit modes,
views, and a deterministic table generator -- all as DataFrame/SQL plans.
"""

from .functions.joins import bounded_broadcast
from .operators.castloss import align_with_quarantine, cast_loss
from .operators.numbering import with_row_number, zip_by_position
from .operators.schema import align_to, drift, drift_report
from .operators.skewjoin import hot_keys, skew_join
from .operators.stored import with_stored_number, zip_stored
from .operators.survey import run_selection_job, run_summary, select_survey, survey_id, survey_selection
from .operators.synth import synth_table
from .sinks.files import write_csv, write_json_array, write_sql_dump
from .sinks.jdbc import write_jdbc
from .sinks.staged import append_run, recover_load, recover_run, run_ledger, staged_load
from .sinks.tables import write_table
from .sinks.views import create_view
from .sources.catalog import read_table, table_schema
from .sources.files import csv_types, read_csv, read_json_array
from .sources.jdbc import read_jdbc
from .sources.sqldump import read_sql_dump
from .streaming.dump_ingest import dump_stream, start_dump_ingest

__version__ = "0.1.0"

__all__ = [
    "align_to", "align_with_quarantine", "append_run", "bounded_broadcast", "cast_loss", "create_view", "csv_types",
    "drift", "drift_report", "dump_stream", "hot_keys", "read_csv", "read_jdbc", "read_json_array", "read_sql_dump",
    "read_table", "recover_load", "recover_run", "run_ledger", "run_selection_job", "run_summary", "select_survey",
    "skew_join", "staged_load", "start_dump_ingest", "survey_id", "survey_selection", "synth_table", "table_schema",
    "with_row_number", "with_stored_number", "write_csv", "write_jdbc", "write_json_array", "write_sql_dump",
    "write_table", "zip_by_position", "zip_stored",
]
