from tablemirror.sources.files import scan_files
from tablemirror.sources.ranged import diff_latest, diff_versions, publish_patch, publish_ranged
from tablemirror.sources.store import history, latest_version, publish, read_latest
from tablemirror.sources.versions import release_claim

__all__ = [
    "diff_latest",
    "diff_versions",
    "history",
    "latest_version",
    "publish",
    "publish_patch",
    "publish_ranged",
    "read_latest",
    "release_claim",
    "scan_files",
]
