"""Counts for every folder of a tree of paths, whatever its depth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablemirror.errors import SchemaError
from tablemirror.operators.scope import check_scope_column
from tablemirror.schemas import require_columns


def folder_summary(
    changes: DataFrame, column: str = "path", by: str = "change", depth: int | None = None
) -> DataFrame:
    """``folder``, ``by`` and ``n``: the rows anywhere below each folder, by ``change``.

    A folder is named as a prefix, ``reports/2024/``, so that it can be handed to ``in_scope``;
    the whole tree is the empty name. Folders that hold nothing but folders have rows too. Rows
    with a null path lie in no folder: they are counted under a null one, and not in the whole.

    Rows are counted once, for the folder that they lie in. Then counts move up in doubling
    steps: after step k each folder has what lies less than 2^k levels below it, and hands that
    to the folder 2^k levels above. A tree of depth d takes log2(d) steps, each of which
    shuffles at most two rows per folder and change, however many files there are; they combine
    before the shuffle, so the whole tree's own row is no hot key.

    The depth of the deepest path is measured by a job. ``depth`` spares it; a deeper path is
    then an error in any job that reads the result.
    """
    check_scope_column(changes, column)
    require_columns(changes, [by])
    if by in ("folder", "n", "__depth"):
        raise SchemaError(f"a folder summary cannot be by a column named {by}")
    path = F.col(column)
    steps = F.length(path) - F.length(F.replace(path, F.lit("/"), F.lit("")))
    if depth is None:
        depth = changes.agg(F.max(steps)).first()[0] or 0
        steps_in = steps
    else:
        too_deep = F.raise_error(F.concat(F.lit(f"deeper than {depth} folders: "), path))
        steps_in = F.when(steps > depth, too_deep.cast("int")).otherwise(steps)
    counts = (
        changes.select(path.alias("__path"), steps_in.alias("__depth"), by)
        .groupBy("__depth", _head("__path", "__depth").alias("folder"), by)
        .agg(F.count("*").alias("n"))
    )
    reach = 1
    while reach <= depth:
        above = F.col("__depth") - reach
        here = F.struct("__depth", "folder")
        there = F.struct(above.alias("__depth"), _head("folder", above).alias("folder"))
        places = F.when(above >= 0, F.array(here, there)).otherwise(F.array(here))
        counts = (
            counts.select(F.explode(places).alias("__at"), by, "n")
            .groupBy("__at.__depth", "__at.folder", by)
            .agg(F.sum("n").alias("n"))
        )
        reach *= 2
    name = F.when(F.col("__depth") > 0, F.concat("folder", F.lit("/"))).otherwise(F.col("folder"))
    return counts.select(name.alias("folder"), by, "n")


def _head(path: str, steps: str | Column) -> Column:
    """The first ``steps`` steps of a path, without the slash behind them."""
    count = F.col(steps) if isinstance(steps, str) else steps
    return F.call_function("substring_index", F.col(path), F.lit("/"), count)
