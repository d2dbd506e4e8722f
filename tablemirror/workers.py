"""Hand this package to the executors' Python workers."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def ship(spark: SparkSession) -> None:
    """Add the package to the session's Python files, once per Spark context."""
    context = spark.sparkContext
    if getattr(context, "_tablemirror_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="tablemirror-")) / "tablemirror_package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._tablemirror_shipped = True
