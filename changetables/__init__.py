"""Change-log replay on Spark: current tables, history, progress and checks."""

from changetables.functions.types import declared_fields, source_type
from changetables.operators.apply import apply_to_table
from changetables.operators.ddl_effects import apply_ddl_epochs, ddl_effects, evolve_by_log, evolve_images, evolve_schema
from changetables.operators.exact import (
    expand_copies,
    net_copies,
    replay,
    replay_append_delete,
    unmatched_changes,
)
from changetables.operators.filters import TableFilter
from changetables.operators.images import bind_columns, decode_rows, explode_rows, pair_updates, typed_changes
from changetables.operators.keyed import (
    conflicts,
    fold_partial,
    halt_at_first_conflict,
    history,
    latest_by_key,
    split_key_updates,
)
from changetables.operators.metrics import alerts, metrics_snapshot
from changetables.operators.progress import checkpoints, resume_log, resume_plan, running_position
from changetables.operators.reconcile import compare_counts, diff_tables, duplicates, missing_columns, missing_tables
from changetables.operators.transactions import with_txn_id
from changetables.operators.validate import check_types, split_valid, validate
from changetables.schema import EVENT_SCHEMA, LEDGER_SCHEMA, LOG_SCHEMA, METRICS_SCHEMA
from changetables.sources.catalogue import schema_asof, schema_history, table_columns
from changetables.sources.changelog import after_gtid_set, from_position, read_changelog, resume_after
from changetables.sources.gtid import gtid_set_asof, gtid_set_text, gtid_set_total
from changetables.sources.ledger import checkpoints_to_json, load_checkpoint, load_ledger, save_checkpoint
from changetables.sources.versions import read_table, write_table
from changetables.streaming.apply import (
    TableSet,
    Target,
    clean,
    compact,
    drain,
    read_current,
    read_current_table,
    start_apply,
    start_apply_tables,
)

__all__ = [name for name in dir() if not name.startswith("_")]
