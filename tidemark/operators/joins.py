"""Equality joins: change rows (J1 + row marker P5), column-source fallback
(J2), hierarchy expansion (J3), workspace and report expansion (J4, J5),
unique-name lookup (J6) and the copy plan (J7).

Hot keys: every per-key aggregate is a hash aggregate with a map-side
partial step, so a key holding a third of the rows collapses before the
shuffle; joins are written as inner / semi / anti joins where AQE can split
skewed partitions, and only frames with a proven size bound are broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixed import MARKER_GONE, MARKER_PRESENT, ROW_MARKER_COL
from ..functions.text import is_guid
from .filters import mark_range, typed_lit, with_any_tag

MARK = "__mark"
# Keys that one task compares when it looks for keys that are gone (32 bytes
# each and as much again where they are sorted).
KEYS_PER_TASK = 500_000


def delta_key_bounds(delta: DataFrame, *, delta_key: str, mark: str, low=None, high=None):
    """(upper mark, smallest key, largest key) of the delta requests in
    `(low, high]` in one small aggregate over the delta side; the upper mark
    is `high` when given, else the largest mark above `low`."""
    row = delta.where(mark_range(delta[mark], low, high, delta.schema[mark].dataType)).agg(
        F.max(mark).alias("hi"), F.min(delta_key).alias("kmin"), F.max(delta_key).alias("kmax")).first()
    return (high if high is not None else row["hi"]), row["kmin"], row["kmax"]


def change_rows(delta: DataFrame, snapshot: DataFrame, *, delta_key: str, snap_key: str, mark: str,
                low=None, high=None, latest_only: bool = False, keep_mark: bool = False,
                strategy: str = "split", snap_bounds: tuple | None = None, salt: int | None = None,
                stage: str | None = None) -> DataFrame:
    """J1 + P5: change rows for delta requests with `low < mark <= high`.

    Each delta row fans out to every snapshot row with its key (marker 4);
    a key with no snapshot row gives one row marked 2 whose key comes from
    the delta side and whose other columns are null. The same key in several
    delta rows repeats (`latest_only=True` keeps its highest mark only).

    `strategy="split"` (default) computes present rows with an inner join
    and gone rows as those that join none of the snapshot keys that were hit:
    the inner join can broadcast a small delta (the snapshot then streams
    without a shuffle) and can have skewed partitions split by AQE, which a
    left outer join cannot do for its right side. `strategy="outer"` is the
    literal left outer join.

    `stage` names a fresh folder (on storage that all executors share). The
    present rows are then written there once and the keys that were hit are
    read back from them, one column of a change set, so the snapshot is
    scanned, and where the delta is large shuffled, exactly once. What is
    returned reads the staged rows alone: sampling it for a sort costs no
    join, and a lost executor repeats none. The caller deletes the folder
    when done. Without `stage` the result is lazy and scans the snapshot's
    key column a second time; only the rows are counted at once, as their
    number says how many tasks compare keys.

    `snap_bounds=(smallest, largest)` delta key (see `delta_key_bounds`)
    limits the snapshot to that key range with literal predicates, which
    reach the Parquet scan: on a snapshot clustered by key, row groups
    outside the range are skipped, so a run reads the part of the snapshot
    its requests can touch rather than all of it.

    `salt=S` splits hot keys without relying on AQE: each snapshot row gets
    a salt in [0, S) from a hash of the row, each delta request is repeated
    once per salt, and the present rows join on (key, salt), so one key's
    snapshot rows spread over S tasks. The output is the same; the delta
    side grows by the bounded factor S.
    Output: marker, key, the other snapshot columns (and `__mark` when
    `keep_mark`, for ordering by (mark, key)).
    """
    if snap_bounds is not None:
        lo, hi = snap_bounds
        key = snapshot[snap_key]
        kt = snapshot.schema[snap_key].dataType
        as_lit = (lambda v: typed_lit(v, kt)) if isinstance(kt, T.TimestampNTZType) else F.lit
        snapshot = snapshot.where(key.between(as_lit(lo), as_lit(hi)) if lo is not None else F.lit(False))
    d = delta.where(mark_range(delta[mark], low, high, delta.schema[mark].dataType)).select(
        delta[mark].alias(MARK), delta[delta_key].alias("__dkey"))
    if latest_only:
        d = d.groupBy("__dkey").agg(F.max(MARK).alias(MARK))
    others = [c for c in snapshot.columns if c != snap_key]
    s = snapshot.select(snapshot[snap_key].alias("__skey"), *[snapshot[f"`{c}`"] for c in others])

    if strategy == "outer":
        j = d.join(s, F.col("__dkey") == F.col("__skey"), "left")
        out = j.select(
            F.when(F.col("__skey").isNull(), F.lit(MARKER_GONE)).otherwise(F.lit(MARKER_PRESENT)).alias(ROW_MARKER_COL),
            F.col("__dkey").alias(snap_key), *[F.col(f"`{c}`") for c in others], F.col(MARK))
    elif strategy == "split":
        if salt and salt > 1:
            salted_s = s.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in s.columns]), F.lit(salt)))
            salted_d = d.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salt - 1).cast("long"))))
            joined = salted_s.join(salted_d, (F.col("__skey") == F.col("__dkey")) &
                                   (salted_s["__salt"] == salted_d["__salt"]), "inner")
        else:
            joined = s.join(d, F.col("__skey") == F.col("__dkey"), "inner")
        present = joined.select(F.col("__dkey").alias(snap_key), *[F.col(f"`{c}`") for c in others], F.col(MARK))
        if stage is not None:
            present = _staged(present, f"{stage}/present")
            asked = _by_key(d, "__dkey", 2 * d.count())
            hit = present.select(F.col(snap_key).alias("__skey")).distinct()
        else:
            asked = _by_key(d, "__dkey", 2 * d.count() + s.count())
            wanted = asked.select(F.col("__dkey").alias("__wkey")).distinct()
            hit = (s.select("__skey").join(wanted, F.col("__skey") == F.col("__wkey"), "left_semi")
                   .distinct())
        present = present.select(F.lit(MARKER_PRESENT).alias(ROW_MARKER_COL), "*")
        types = dict(snapshot.dtypes)
        # Not an anti join: Spark would move it in front of the dealing by key.
        absent = asked.join(hit, F.col("__dkey") == F.col("__skey"), "left").where(F.col("__skey").isNull()).drop("__skey")
        if stage is not None:
            absent = _staged(absent, f"{stage}/gone")
        gone = absent.select(
            F.lit(MARKER_GONE).alias(ROW_MARKER_COL), F.col("__dkey").alias(snap_key),
            *[F.lit(None).cast(types[c]).alias(c) for c in others], F.col(MARK))
        out = present.unionByName(gone)
    else:
        raise ValueError("strategy must be split or outer")
    return out if keep_mark else out.drop(MARK)


def _by_key(df: DataFrame, key: str, rows: int) -> DataFrame:
    """The frame dealt by key where its join compares more rows than a task
    should. AQE packs shuffled partitions by their bytes, and rows of a key
    alone compress to so few that one task would get tens of millions; a
    number of partitions that is given is left as it is, on both sides."""
    if rows <= KEYS_PER_TASK:
        return df
    conf = df.sparkSession.conf
    width = int(conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) or conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(width, -(-rows // KEYS_PER_TASK)), key)


def _staged(df: DataFrame, path: str) -> DataFrame:
    """The rows, written as a table and read back."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


TIE = "__tie"


def change_order(rows: DataFrame, snap_key: str) -> tuple[DataFrame, list[str]]:
    """Global (mark, key) order for change rows, refined by a hash of the
    whole row. Ties in (mark, key) have no required order; the hash lets the
    range partitioner split a key that holds a large share of the rows
    instead of sending all of them to one task. Returns the frame with the
    helper column and the sort keys (drop `TIE` after sorting)."""
    cols = [F.col(f"`{c}`") for c in rows.columns if c != MARK]
    return rows.withColumn(TIE, F.xxhash64(*cols)), [MARK, snap_key, TIE]


def columns_of(table_cols: DataFrame, view_cols: DataFrame, keys=("SCHEMA_NAME", "OBJECT_NAME")) -> DataFrame:
    """An object's table columns; only objects with none take their view
    columns. Adds `col_source` ('table' / 'view')."""
    keys = list(keys)
    have = table_cols.select(*keys).distinct()
    fallback = view_cols.join(have, keys, "left_anti").withColumn("col_source", F.lit("view"))
    return table_cols.withColumn("col_source", F.lit("table")).unionByName(fallback, allowMissingColumns=True)


def with_children(nodes: DataFrame, roots, *, id_col: str = "id", name_col: str = "displayName",
                  parent_col: str = "parentId", pos_col: str = "pos") -> DataFrame:
    """For each root (matched by id or displayName, first hit in listing
    order), the root itself (level 0) then the nodes whose parent is the root
    (level 1); grandchildren are not followed. Duplicates across overlapping
    roots are kept. A root that matches nothing is an error.

    Each node offers its id and its name as match keys (one equi-join, one
    pass); the matched roots - at most one row per root the caller names -
    are collected, checked, and joined back as a broadcast side of that
    proven size. The nodes are read twice in all.
    """
    spark = nodes.sparkSession
    roots = list(roots)
    node_cols = nodes.columns
    asked = spark.createDataFrame([(i, r) for i, r in enumerate(roots)], "root_pos int, root string")
    keyed = nodes.select(F.explode(F.array_distinct(F.array(F.col(id_col).cast("string"),
                                                            F.col(name_col).cast("string")))).alias("__match"),
                         *[F.col(f"`{c}`") for c in node_cols])
    hits = asked.join(keyed, asked["root"] == F.col("__match"))
    first = hits.groupBy("root_pos", "root").agg(
        F.min_by(F.struct(*[F.col(f"`{c}`") for c in node_cols]), F.col(pos_col)).alias("n"))
    found = first.select("root_pos", "root", *[F.col("n")[c].alias(c) for c in node_cols])
    rows = found.collect()
    seen = {r["root_pos"] for r in rows}
    missing = [r for i, r in enumerate(roots) if i not in seen]
    if missing:
        raise ValueError(f"{len(missing)} of {len(roots)} roots match no node by id or name: {missing}")
    top = spark.createDataFrame(rows, found.schema)
    link = F.broadcast(top.select("root_pos", "root", F.col(id_col).alias("__root_id")))
    children = nodes.join(link, nodes[parent_col] == F.col("__root_id")).drop("__root_id")
    return (top.withColumn("level", F.lit(0))
            .unionByName(children.withColumn("level", F.lit(1))))


def domain_workspaces(domains: DataFrame, workspaces: DataFrame, *, domain_id: str = "id",
                      ws_domain: str = "domain_id") -> DataFrame:
    """All workspaces of each domain in the set (bag semantics: a
    workspace reached through two roots appears twice)."""
    d = domains.select(*[F.col(c) for c in ("root_pos", "root", "level", "pos") if c in domains.columns],
                       F.col(domain_id).alias("__did"))
    d = d.withColumnRenamed("pos", "domain_pos")
    return workspaces.join(d, workspaces[ws_domain] == F.col("__did")).drop("__did")


def tagged_reports(workspaces: DataFrame, reports: DataFrame, candidates, *, ws_id: str = "id",
                   report_ws: str = "workspace_id", tags_col: str = "tags") -> DataFrame:
    """The reports of each workspace carrying any candidate tag; the tag
    filter runs before the join, and workspaces without any drop out."""
    w = workspaces.withColumnRenamed(ws_id, "__wid")
    if "displayName" in w.columns:
        w = w.withColumnRenamed("displayName", "workspace_name")
    r = with_any_tag(reports, candidates, tags_col)
    return r.join(w, r[report_ws] == F.col("__wid")).drop("__wid")


def resolve_unique(inputs: DataFrame, dim: DataFrame, *, value_col: str = "value",
                   dim_name: str = "displayName", dim_id: str = "id") -> DataFrame:
    """Values that already are ids pass through; names must match exactly
    one row of `dim`. Adds `is_id`, `match_count`, `resolved_id` and `error`
    ('no match' / 'ambiguous'), so failures are rows, not job aborts.
    """
    per_name = dim.groupBy(F.col(dim_name).alias("__name")).agg(
        F.count(F.lit(1)).alias("__n"), F.min(dim_id).alias("__id"))
    v = F.col(value_col)
    j = inputs.join(per_name, v == F.col("__name"), "left")
    idv = is_guid(v)
    n = F.coalesce(F.col("__n"), F.lit(0))
    return j.select(
        *[F.col(f"`{c}`") for c in inputs.columns],
        idv.alias("is_id"),
        F.when(idv, F.lit(None)).otherwise(n).cast("long").alias("match_count"),
        F.when(idv, v).when(n == 1, F.col("__id").cast("string")).alias("resolved_id"),
        F.when(idv, F.lit(None)).when(n == 0, F.lit("no match")).when(n > 1, F.lit("ambiguous"))
        .alias("error"),
    )


def copy_plan(reports: DataFrame, target: DataFrame, *, order_cols=("root_pos", "ws_pos", "report_pos"),
              name_col: str = "displayName", target_name: str = "name", target_id: str = "id",
              target_pos: str = "pos") -> DataFrame:
    """Per report, in run order, 'update' when the target already has a
    report of that name (first in listing order) or an earlier report of this
    run made one, else 'clone'. `target_report_id` is the id to update (null
    when updating a copy made earlier in the same run).

    One grouped aggregate per name (map-side partial, so a hot name is cheap)
    replaces per-report lookups, and the plan joins back on the name.
    """
    # Reports at equal positions are told apart by their content, then by
    # their place, so only one of them comes first.
    ties = (F.xxhash64(*[F.col(f"`{c}`") for c in reports.columns]), F.monotonically_increasing_id())
    wanted = reports.columns
    reports = reports.withColumn("__tie", F.struct(*ties))
    order = F.struct(*[F.col(c) for c in order_cols], F.col("__tie"))
    t = target.select(F.col(target_name).alias("__name"), F.col(target_id).cast("string").alias("__tid"),
                      F.col(target_pos).alias("__tpos"), F.lit(None).cast(reports.select(order.alias("o")).schema["o"].dataType).alias("__order"))
    r = reports.select(F.col(name_col).alias("__name"), F.lit(None).cast("string").alias("__tid"),
                       F.lit(None).cast(target.schema[target_pos].dataType).alias("__tpos"), order.alias("__order"))
    per_name = t.unionByName(r).groupBy("__name").agg(
        F.min_by("__tid", "__tpos").alias("__existing"), F.min("__order").alias("__first"))
    j = reports.join(per_name, reports[name_col] == F.col("__name"), "left")
    here = F.struct(*[j[c] for c in order_cols], j["__tie"])
    action = F.when(F.col("__existing").isNotNull() | (here > F.col("__first")), F.lit("update")).otherwise(F.lit("clone"))
    return j.select(*[j[f"`{c}`"] for c in wanted], action.alias("action"),
                    F.col("__existing").alias("target_report_id"))
