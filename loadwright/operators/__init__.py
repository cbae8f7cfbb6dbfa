from loadwright.operators.keys import (
    anti_by_key, assert_unique, duplicate_keys, key_profile, matched_by_key, pk_violations,
)
from loadwright.operators.modes import (
    apply_deliveries, apply_mode, load_full, load_insert, load_update, merge_deliveries,
)
from loadwright.operators.rejects import gate_table, reject_gate, rejected_lines, rejected_rows
from loadwright.operators.transform import (
    apply_steps, choose, column_at, first_rows, project, split_target, stamp_audit, where_equal,
)

__all__ = [
    "anti_by_key", "assert_unique", "duplicate_keys", "key_profile", "matched_by_key",
    "pk_violations", "apply_deliveries", "apply_mode", "load_full", "load_insert",
    "load_update", "merge_deliveries", "gate_table", "reject_gate", "rejected_lines",
    "rejected_rows", "apply_steps", "choose", "column_at", "first_rows", "project",
    "split_target", "stamp_audit", "where_equal",
]
