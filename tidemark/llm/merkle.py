"""A Merkle manifest of a dataset, built by rolling up nested structs.

Rows are leaves. Within a tree, leaves are numbered in order, and the digits of
that number in base ``RUN`` say which runs they fall into. Grouping the digit
columns away one after the other, last digit first, nests the structs of a run
into their node. After ``LEVELS`` digits a block of bounded size is one row; the
blocks' digests are the leaves of the next round, until one block is left. Going
down again, a block meets the path above it by one more grouping, and a
transform and an explode give every leaf its proof. No step joins proofs, and no
row or group is larger than a block, whatever a source holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RUN = 3
LEVELS = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<before:string,after:string>>"


def sha(*parts: Column) -> Column:
    """Lowercase hex sha256 of texts, concatenated."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value."""
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def _number(spark: SparkSession, rows: DataFrame, order: list[str], base: str) -> DataFrame:
    """``rows`` with ``rank`` (from 0, in each ``tree``) and ``size`` (rows of the
    tree). Ranges of the whole order are numbered by themselves and start after
    the rows of the ranges before them, so no task sorts a whole tree."""
    names = rows.columns
    rows = rows.withColumn("tie", F.monotonically_increasing_id())  # splits rows that are all equal
    keys = ["tree", *order, "tie"]
    rows.repartitionByRange(*keys).withColumn("part", F.spark_partition_id()).write.parquet(f"{base}/ranges")
    rows = spark.read.schema(rows.withColumn("part", F.lit(0)).schema).parquet(f"{base}/ranges")
    tree = Window.partitionBy("tree")
    before = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("tree", "part").agg(F.count("*").alias("n")).select(
        "tree", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), F.sum("n").over(tree).alias("size"))
    at = F.row_number().over(Window.partitionBy("tree", "part").orderBy(*order, "tie")) - 1
    return rows.withColumn("at", at).join(starts, ["tree", "part"]).select(*names, (F.col("start") + F.col("at")).alias("rank"), "size")


def _height(size: int) -> int:
    """Levels above the leaves of a tree."""
    h = 0
    while RUN ** h < size:
        h += 1
    return h


def _roll_up(nodes: DataFrame, levels: int) -> DataFrame:
    """Blocks of ``tree, height, rank, node`` (a struct that starts with ``h``):
    ``tree, height, block, h, kids``. ``height`` is what is left of the tree's
    height; above it a node has one child and takes its digest."""
    digits = [f"d{i}" for i in range(levels)]
    rows = nodes.select("tree", "height", F.floor(F.col("rank") / RUN ** levels).cast("long").alias("block"),
                        *[(F.floor(F.col("rank") / RUN ** i) % RUN).cast("int").alias(d) for i, d in enumerate(digits)], "node")
    rows = rows.repartition("tree", "block")
    for i in range(levels):
        kids = F.transform(F.array_sort(F.collect_list(F.struct(F.col(digits[i]).alias("d"), "node"))), lambda x: x["node"])
        rows = rows.groupBy("tree", "height", "block", *digits[i + 1:]).agg(kids.alias("kids"))
        h = F.when(F.col("height") > i, sha(F.array_join(F.col("kids")["h"], ""))).otherwise(F.col("kids")[0]["h"])
        rows = rows.select("tree", "height", "block", *digits[i + 1:], F.struct(h.alias("h"), "kids").alias("node"))
    return rows.select("tree", "height", "block", F.col("node.h").alias("h"), F.col("node.kids").alias("kids"))


def _grow(spark: SparkSession, leaves: DataFrame, levels: int, base: str) -> tuple[DataFrame, list[DataFrame]]:
    """Roots (``tree, h``) of ranked ``tree, rank, size, node`` and the blocks
    of every round, each written as a table."""
    power, height = 0, F.lit(0)
    most = leaves.agg(F.max("size")).first()[0] or 0
    top = _height(most)
    for power in range(top):
        height = F.when(F.col("size") > RUN ** power, F.lit(power + 1)).otherwise(height)
    nodes = leaves.select("tree", height.alias("height"), "rank", "node")
    rounds: list[DataFrame] = []
    while not rounds or len(rounds) * levels < top:
        blocks = _roll_up(nodes, levels)
        path = f"{base}/round-{len(rounds)}"
        blocks.write.parquet(path)
        blocks = spark.read.schema(blocks.schema).parquet(path)
        rounds.append(blocks)
        nodes = blocks.select("tree", F.greatest(F.col("height") - levels, F.lit(0)).alias("height"), F.col("block").alias("rank"),
                              F.struct("h").alias("node"))
    return rounds[-1].select("tree", "h"), rounds


def _proofs(block: DataFrame, levels: int) -> DataFrame:
    """``tree, rank, node, above, path`` of every leaf of blocks with ``above``
    and the ``path`` above them: at each level what stands before and after the
    own digest in its run, from the leaf up."""
    state = F.array(F.struct(F.col("block").alias("at"), "kids", "path"))

    def down(level: int):
        def each(x):
            hs = x["kids"]["h"]

            def kid(k, i):
                step = F.struct(F.array_join(F.slice(hs, 1, i), "").alias("before"),
                                F.array_join(F.slice(hs, i + 2, RUN), "").alias("after"))
                path = F.when(F.col("height") >= level, F.concat(F.array(step), x["path"])).otherwise(x["path"])
                at = (x["at"] * RUN + i).alias("at")
                below = F.struct(at, k["kids"].alias("kids"), path.alias("path")) if level > 1 else \
                    F.struct(at, k.alias("node"), path.alias("path"))
                return below
            return F.transform(x["kids"], kid)
        return each

    for level in range(levels, 0, -1):
        state = F.flatten(F.transform(state, down(level)))
    return (block.select("tree", "above", F.explode(state).alias("x"))
            .select("tree", "above", F.col("x.at").alias("rank"), F.col("x.node").alias("node"), F.col("x.path").alias("path")))


def _descend(rounds: list[DataFrame], tops: DataFrame, levels: int) -> DataFrame:
    """Proofs of all leaves; ``tops`` has ``tree, above, path`` of every tree."""
    paths = tops.select("tree", F.lit(0).cast("long").alias("block"), "above", "path")
    for k, blocks in enumerate(reversed(rounds)):
        names = ["height", "kids", "above", "path"]
        none = [F.lit(None).cast(paths.schema[c].dataType).alias(c) for c in ("above", "path")]
        down = paths.select("tree", "block", *[F.lit(None).cast(blocks.schema[c].dataType).alias(c) for c in names[:2]], "above", "path")
        both = blocks.select("tree", "block", *names[:2], *none).unionByName(down)
        met = both.groupBy("tree", "block").agg(*[F.first(c, ignorenulls=True).alias(c) for c in names])
        found = _proofs(met, levels)
        paths = found.select("tree", F.col("rank").alias("block"), "above", "path") if k < len(rounds) - 1 else found
    return paths


def manifest(spark: SparkSession, docs: DataFrame, base: str, *, retext: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """``doc_id, source, leaf, other, subroot, root, path`` of every row.

    ``leaf`` is the digest of the row's ``FIELDS``; ``other`` the same with the
    text ``retext`` (by default the text itself). ``path`` goes from the leaf
    to the root, through the source's subtree and then the tree of the
    sources; at every level it has the digests before and after the own one in
    its run. Leaves of a source are ordered by id (null first), rows of one id
    by their digest; sources by their bytes, null first. Null fields, empty
    and very long texts, repeated rows and other columns of any name are fine;
    an empty table has no rows and no root. Steps are tables below ``base``.
    """
    values = {c: F.col(c) for c in FIELDS}
    leaf = sha(*[field(v) for v in values.values()])
    other = leaf if retext is None else F.when(retext.eqNullSafe(F.col("text")), leaf).otherwise(
        sha(*[field(retext if c == "text" else v) for c, v in values.items()]))
    # A null source is a tree of its own, before all others and apart from ''.
    rows = docs.select(F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("tree"), F.col("doc_id"),
                       leaf.alias("leaf"), other.alias("other"))
    rows.write.parquet(f"{base}/leaves")
    rows = spark.read.schema(rows.schema).parquet(f"{base}/leaves")
    ranked = _number(spark, rows, ["doc_id", "leaf"], base)
    node = F.struct(F.col("leaf").alias("h"), "doc_id", "other").alias("node")
    subroots, rounds = _grow(spark, ranked.select("tree", "rank", "size", node), levels, f"{base}/rows")
    sources = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("source"), "h")
    ranked = _number(spark, sources, ["source"], f"{base}/sources")
    roots, above = _grow(spark, ranked.select("tree", "rank", "size", F.struct("h", "source").alias("node")), levels, f"{base}/sources")
    top = roots.select("tree", F.col("h").alias("above"), F.array().cast(_PATH).alias("path"))
    tops = _descend(above, top, levels).select(
        F.col("node.source").alias("tree"), F.struct(F.col("node.h").alias("subroot"), F.col("above").alias("root")).alias("above"), "path")
    found = _descend(rounds, tops, levels)
    return found.select("node.doc_id", F.when(F.col("tree") != "", F.expr("substr(tree, 2)")).alias("source"), F.col("node.h").alias("leaf"),
                        "node.other", "above.subroot", "above.root", "path")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a path lead to."""
    return F.aggregate(path, leaf, lambda h, step: sha(step["before"], h, step["after"]))


def without_newlines(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """The text, of rows whose id has an even crc32 without its newlines. A
    null id leaves it as it is."""
    even = F.crc32(F.col(id_col).cast("string").cast("binary")) % 2 == 0
    return F.when(even, F.replace(F.col(text_col), F.lit("\n"), F.lit(""))).otherwise(F.col(text_col))


def tamper_report(spark: SparkSession, docs: DataFrame, base: str, *, retext: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` of
    every row: the manifest of the rows, and whether rows whose text became
    ``retext`` (see ``without_newlines``) still lead to its root."""
    found = manifest(spark, docs, base, retext=without_newlines() if retext is None else retext, levels=levels)
    proof = F.array_join(F.transform("path", lambda s: F.concat(s["before"], s["after"])), "")
    return (found.select("doc_id", "leaf", "subroot", "root", sha(proof).alias("proof_sha256"), fold(F.col("other"), F.col("path")).alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))
