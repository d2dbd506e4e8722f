from tablemirror.operators.diff import change_summary, diff
from tablemirror.operators.folders import folder_summary
from tablemirror.operators.keys import check_keys, duplicate_keys, null_keys
from tablemirror.operators.membership import key_filter, without_keys
from tablemirror.operators.merge import mirror, upsert
from tablemirror.operators.patch import apply_patch, compose_patches, make_patch
from tablemirror.operators.required import missing_required, select_required
from tablemirror.operators.scope import in_scope, out_of_scope, scope_of
from tablemirror.operators.summary import scope_digest

__all__ = [
    "apply_patch",
    "change_summary",
    "check_keys",
    "compose_patches",
    "diff",
    "duplicate_keys",
    "folder_summary",
    "in_scope",
    "key_filter",
    "make_patch",
    "mirror",
    "missing_required",
    "null_keys",
    "out_of_scope",
    "scope_digest",
    "scope_of",
    "select_required",
    "upsert",
    "without_keys",
]
