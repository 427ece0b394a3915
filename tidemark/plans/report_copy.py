"""Report copy (E4) as a plan table: listing → domains and their children →
workspaces → tagged reports → update-or-clone per report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import copy_plan, domain_workspaces, resolve_unique, tagged_reports, with_children
from ..session import work_root

ORDER = ("root_pos", "level", "domain_pos", "ws_pos", "report_pos")


def resolve_workspace(workspaces: DataFrame, value: str) -> str:
    """J6 for one caller value: the id itself, or the id of the one workspace
    of that name. No such name, or several, is an error."""
    asked = workspaces.sparkSession.createDataFrame([(value,)], "value string")
    row = resolve_unique(asked, workspaces).first()
    if row["error"] is not None:
        raise ValueError(f"workspace {value!r}: {row['error']} ({row['match_count']} by that name)")
    return row["resolved_id"]


def report_copy_plan(domains: DataFrame, workspaces: DataFrame, reports: DataFrame, target: DataFrame,
                     roots, tags, *, target_workspace: str | None = None, materialize: bool = True) -> DataFrame:
    """One row per report to copy, in run order, with its action.

    `target` holds the reports that are there already. With `target_workspace`
    (an id or a name) it is a listing of any workspaces' reports, of which
    those with that `workspace_id` count, and the plan names the workspace as
    `target_workspace_id`.

    The copy plan reads the tagged reports twice (a per-name aggregate and
    the join back). With `materialize`, they are checkpointed once to the
    shared checkpoint folder, so the listing joins are not computed twice and
    the lineage is cut (a lost executor does not recompute the listings)."""
    target_id = None
    if target_workspace is not None:
        target_id = resolve_workspace(workspaces, target_workspace)
        target = target.where(F.col("workspace_id") == target_id)
    expanded = with_children(domains, roots)
    ws = domain_workspaces(expanded, workspaces)
    tagged = tagged_reports(ws, reports, tags).withColumnRenamed("id", "report_id")
    if materialize:
        work_root(tagged.sparkSession)  # makes sure a checkpoint folder is set
        tagged = tagged.checkpoint(eager=True)
    plan = copy_plan(tagged, target, order_cols=ORDER)
    return plan if target_id is None else plan.withColumn("target_workspace_id", F.lit(target_id))
