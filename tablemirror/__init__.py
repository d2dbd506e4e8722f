"""Keep one keyed table in step with another, as Spark jobs."""

from tablemirror import errors
from tablemirror.functions import row_digest
from tablemirror.operators import (
    apply_patch,
    change_summary,
    check_keys,
    compose_patches,
    diff,
    duplicate_keys,
    folder_summary,
    in_scope,
    key_filter,
    make_patch,
    mirror,
    missing_required,
    null_keys,
    out_of_scope,
    scope_digest,
    scope_of,
    select_required,
    upsert,
    without_keys,
)
from tablemirror.plans import Rule, load_rules, run_plan
from tablemirror.sources import (
    diff_latest,
    diff_versions,
    history,
    latest_version,
    publish,
    publish_patch,
    publish_ranged,
    read_latest,
    release_claim,
    scan_files,
)

__all__ = [
    "Rule",
    "apply_patch",
    "change_summary",
    "check_keys",
    "compose_patches",
    "diff",
    "diff_latest",
    "diff_versions",
    "duplicate_keys",
    "errors",
    "folder_summary",
    "history",
    "in_scope",
    "key_filter",
    "latest_version",
    "load_rules",
    "make_patch",
    "mirror",
    "missing_required",
    "null_keys",
    "out_of_scope",
    "publish",
    "publish_patch",
    "publish_ranged",
    "read_latest",
    "release_claim",
    "row_digest",
    "run_plan",
    "scan_files",
    "scope_digest",
    "scope_of",
    "select_required",
    "upsert",
    "without_keys",
]
