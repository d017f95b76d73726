"""A Merkle manifest of a table, and proofs of its rows by a recursive query.

Rows are leaves. The leaves of a group (a language) form a tree of eight children a
node; the roots of the groups form the tree above. Levels are built one after another,
each from the one below, and are kept as parent-linked node rows. A recursive query then
climbs from every leaf: a step joins a leaf to the node above it, notes the siblings and
folds the leaf's digest, as tampered with, into the node's.

Positions come from a range partitioning and counts of its parts, so no task sees a whole
group. High nodes lie above very many leaves: their rows are repeated for each block
of leaves below, and a step joins on the block as well, so a join key has at most
``BLOCK`` leaves. The repeats are one row a block and high level.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.llm.blocks import CLEANUP, written

#: Children of a node, as a power of two. Fixed by the manifest's format.
SHIFT = 3
ARITY = 1 << SHIFT
#: Levels whose nodes lie above one block of leaves alone, and the leaves of a block.
LOW_LEVELS = 3
BLOCK = ARITY**LOW_LEVELS
#: Trees above and of the groups: the tree above is number 0, the group of rank r is r + 1.
TOP = 0
PLACE_BITS = 33  # of a row number within its part, as monotonically_increasing_id makes them


def digest(text: Column) -> Column:
    """sha256 of the UTF-8 bytes, as 32 bytes."""
    return F.unhex(F.sha2(text, 256))


def as_hex(value: Column) -> Column:
    return F.lower(F.hex(value))


def of_children(children: Column) -> Column:
    """A node's digest: of its children's digests as hex text, one after another."""
    return digest(F.array_join(F.transform(children, as_hex), ""))


def leaf_text(*values: Column) -> Column:
    """What a leaf hashes: each value as byte count, colon and value; a dash where it is null."""
    parts = []
    for value in values:
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.concat(*parts)


@dataclass
class Manifest:
    """Written tables of a manifest, and the root's digest as hex (null without rows)."""

    leaves: DataFrame  # rid, doc_id, tree, rank, width (leaves of the tree), block, place, leaf, shown
    groups: DataFrame  # tree, rank, name, width, subroot
    blocks: DataFrame  # tree, rank, block, subroot
    nodes: DataFrame  # tree, level, idx, digest, children, up_tree, up_level, up_idx, slot (among the parent's children)
    paths: DataFrame  # home, block, and a node's place, children and parent: once for each block of leaves below it
    n_groups: int
    root: str | None


def numbered(rows: DataFrame, group: str, order: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """The rows, written with a number of their own (``rid``), and the runs that give their places.

    Rows are dealt into ranges of (group, order), nulls first. A run is what one range holds of
    one group: (part, run_group, n, ahead), ``ahead`` being what to add to a rid of the run for the
    row's place in its group, from 0. A group has at most as many runs as there are ranges.
    """
    keys = [F.col(group).asc_nulls_first(), *(F.col(c).asc_nulls_first() for c in order)]
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
    ranged = written(ranged.withColumn("rid", F.monotonically_increasing_id()), name)
    runs = ranged.groupBy(F.shiftright("rid", PLACE_BITS).alias("part"), F.col(group).alias("run_group")).agg(
        F.min("rid").alias("head"), F.count("*").alias("n"))
    earlier = Window.partitionBy("run_group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("head")
    return ranged, written(runs.select("part", "run_group", "n", ahead.alias("ahead")), f"{name}-runs")


def with_places(ranged: DataFrame, group: str, runs: DataFrame) -> DataFrame:
    """The rows with the columns of their run and ``place``, their position in the group."""
    same = (F.shiftright("rid", PLACE_BITS) == F.col("part")) & F.col(group).eqNullSafe(F.col("run_group"))
    return ranged.join(runs, same).withColumn("place", F.col("rid") + F.col("ahead")).drop("part", "run_group", "ahead")


def _levels(below: DataFrame, widest: int, name: str) -> list[DataFrame]:
    """Node rows of the levels above (tree, width, idx, digest), each written; ``width`` is the number of a tree's nodes on
    the level, and a tree goes on while it has more than one."""
    out = []
    while widest > 1:
        group = below.where("width > 1").groupBy("tree", "width", F.shiftright("idx", SHIFT).alias("i"))
        own = group.agg(F.sort_array(F.collect_list(F.struct("idx", "digest"))).alias("own"))  # at most ARITY rows
        made = own.select(
            "tree", F.lit(len(out) + 1).alias("level"), F.col("i").alias("idx"),
            F.shiftright(F.col("width") + (ARITY - 1), SHIFT).alias("width"), F.transform("own", lambda c: c["digest"]).alias("children"))
        made = written(made.withColumn("digest", of_children(F.col("children"))), f"{name}-{len(out) + 1}")
        out.append(made)
        below, widest = made, -(-widest // ARITY)
    return out


def _above(width: Column, idx: Column, tree: Column, level: Column, rank: Column, n_groups: int) -> list[Column]:
    """Where the parent of a node is, and which of its children the node is: in the same tree, from a group's root in
    the tree above, from the root of all nowhere (null)."""
    to_top = (tree != TOP) & F.lit(n_groups > 1)
    inner = width > 1
    return [
        F.when(inner, tree).when(to_top, F.lit(TOP).cast("long")).alias("up_tree"),
        F.when(inner, level + 1).when(to_top, F.lit(1)).alias("up_level"),
        F.when(inner, F.shiftright(idx, SHIFT)).when(to_top, F.shiftright(rank, SHIFT)).alias("up_idx"),
        F.when(inner, idx.bitwiseAND(ARITY - 1)).when(to_top, rank.bitwiseAND(ARITY - 1)).cast("int").alias("slot"),
    ]


NODE = "tree long, level int, idx long, width long, children array<binary>, digest binary"


def build(rows: DataFrame, group: str = "lang", order: str = "doc_id") -> Manifest:
    """The manifest of (order, group, leaf, shown): ``leaf`` the digest of a row, ``shown`` that of the row as it is now.

    Groups are ordered by name, null first, and a group's leaves by ``order``, null first, ties
    by digest, so that repeated rows are leaves of their own. An empty table has no root.
    """
    spark = rows.sparkSession
    named = rows.select(F.col(order).alias("doc_id"), F.col(group).alias("name"), "leaf", "shown")
    ranged, runs = numbered(named, "name", ["doc_id", "leaf", "shown"], "merkle-rows")
    sizes = runs.groupBy(F.col("run_group").alias("name")).agg(F.sum("n").alias("n")).withColumn("all", F.lit(0))
    listed, parts = numbered(sizes, "all", ["name"], "merkle-names")
    ranks = with_places(listed, "all", parts.drop("n")).select((F.col("place") + 1).alias("tree"), F.col("place").alias("rank"), "name", F.col("n").alias("width"))
    ranks = written(ranks, "merkle-ranks")
    counts = ranks.agg(F.count("*").alias("groups"), F.max("width").alias("widest")).first()
    n_groups, widest = counts["groups"], counts["widest"] or 0

    trees = runs.drop("n").join(ranks, F.col("run_group").eqNullSafe(F.col("name"))).drop("name")
    leaves = written(with_places(ranged, "name", trees).select(
        "rid", "doc_id", "tree", "rank", "width", F.shiftright("place", LOW_LEVELS * SHIFT).alias("block"), "place", "leaf", "shown"), "merkle-leaves")
    level0 = leaves.select("tree", "width", F.col("place").alias("idx"), F.col("leaf").alias("digest"))
    own = _levels(level0, widest, "merkle-level")
    roots = level0.where("width = 1")
    for level in own:
        roots = roots.unionByName(level.where("width = 1").select(*level0.columns))
    groups = written(ranks.join(roots.select("tree", F.col("digest").alias("subroot")), "tree"), "merkle-groups")
    tops = groups.select(F.lit(TOP).cast("long").alias("tree"), F.lit(n_groups).cast("long").alias("width"), F.col("rank").alias("idx"), F.col("subroot").alias("digest"))
    above = _levels(tops, n_groups, "merkle-top")
    last = (above[-1] if above else tops).first()
    root = bytes(last["digest"]).hex() if last else None

    nodes = spark.createDataFrame([], NODE)
    for level in [*own, *above]:
        nodes = nodes.unionByName(level)
    linked = nodes.join(groups.select("tree", "rank"), "tree", "left").select(
        "tree", "level", "idx", "digest", "children", *_above(*map(F.col, ("width", "idx", "tree", "level", "rank")), n_groups))
    nodes = written(linked, "merkle-nodes")

    # low nodes belong to one block; higher ones are repeated for each block of leaves below them
    ups = ["children", "up_tree", "up_level", "up_idx", "slot"]
    low = nodes.where((F.col("tree") != TOP) & (F.col("level") <= LOW_LEVELS)).select(
        F.col("tree").alias("home"), F.expr(f"shiftright(idx, {SHIFT} * ({LOW_LEVELS} - level))").alias("block"), "tree", "level", "idx", *ups)
    last_block = F.shiftright(F.col("width") - 1, LOW_LEVELS * SHIFT)
    blocks = written(groups.select("tree", "rank", "subroot", F.explode(F.sequence(F.lit(0).cast("long"), last_block)).alias("block")), "merkle-blocks")
    steps = [F.struct(F.col("tree"), F.lit(level).alias("level"), F.shiftright("block", SHIFT * (level - LOW_LEVELS)).alias("idx"))
             for level in range(LOW_LEVELS + 1, len(own) + 1)]
    steps += [F.struct(F.lit(TOP).cast("long").alias("tree"), F.lit(level).alias("level"), F.shiftright("rank", SHIFT * level).alias("idx"))
              for level in range(1, len(above) + 1)]
    path = low
    if steps:
        wanted = blocks.select(F.col("tree").alias("home"), "block", F.explode(F.array(*steps)).alias("s")).select("home", "block", "s.tree", "s.level", "s.idx")
        path = path.unionByName(wanted.join(nodes, ["tree", "level", "idx"]).select(*low.columns))
    return Manifest(leaves, groups, blocks, nodes, written(path, "merkle-paths"), n_groups, root)


@contextmanager
def _recursion(spark: SparkSession):
    """No bound on the rows of a recursive query, and its shuffles kept until it ends."""
    wanted = {"spark.sql.cteRecursionRowLimit": "-1", CLEANUP: "false"}
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


#: A step up: the join finds the node above, its children but for the leaf's own are the siblings, and the digest
#: with the leaf's own folded in goes on. Names in braces are those of the views.
CLIMB = """
WITH RECURSIVE climb(rid, home, block, step, tree, level, idx, slot, digest, siblings) AS (
  SELECT rid, home, block, 0, up_tree, up_level, up_idx, slot, shown, X'' FROM {starts}
  UNION ALL
  SELECT c.rid, c.home, c.block, c.step + 1, n.up_tree, n.up_level, n.up_idx, n.slot,
         unhex(sha2(array_join(transform(n.children, (x, i) -> lower(hex(CASE WHEN i = c.slot THEN c.digest ELSE x END))), ''), 256)),
         aggregate(n.children, struct(X'' AS all, 0 AS i),
                   (a, x) -> struct(CASE WHEN a.i = c.slot THEN a.all ELSE concat(a.all, x) END AS all, a.i + 1 AS i), a -> a.all)
  FROM climb c JOIN {nodes} n
    ON c.home = n.home AND c.block = n.block AND c.tree = n.tree AND c.level = n.level AND c.idx = n.idx)
SELECT rid, step, digest, siblings FROM climb
"""


def climb(manifest: Manifest, with_siblings: bool = False) -> DataFrame:
    """(rid, proof, folded): the digest of each leaf's siblings from its own level to the root, and the root that its ``shown`` digest
    folds into; also ``siblings``, 32 bytes each, if asked for, which are many times as large as the rest."""
    spark = manifest.leaves.sparkSession
    ups = _above(F.col("width"), F.col("place"), F.col("tree"), F.lit(0), F.col("rank"), manifest.n_groups)
    starts = manifest.leaves.select("rid", F.col("tree").alias("home"), "block", "shown", *ups)
    names = {name: f"merkle_{name}_{uuid.uuid4().hex}" for name in ("starts", "nodes")}
    starts.createOrReplaceTempView(names["starts"])
    manifest.paths.createOrReplaceTempView(names["nodes"])
    try:
        with _recursion(spark):
            steps = spark.sql(CLIMB.format(**names))
            listed = F.sort_array(F.collect_list(F.struct("step", "siblings", "digest")))
            paths = steps.groupBy("rid").agg(listed.alias("p")).select(
                "rid",
                F.aggregate("p", F.lit(b""), lambda a, s: F.concat(a, s["siblings"])).alias("siblings"),
                F.element_at("p", -1)["digest"].alias("folded"),
            )
            paths = paths.withColumn("proof", digest(as_hex(F.col("siblings"))))
            return written(paths if with_siblings else paths.drop("siblings"), "merkle-proofs")
    finally:
        for name in names.values():
            spark.catalog.dropTempView(name)


def verified(rows: DataFrame, group: str = "lang", order: str = "doc_id", with_siblings: bool = False) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for every row, and ``siblings`` if asked for.

    ``rows`` has ``order``, ``group``, ``leaf`` and ``shown`` as for ``build``. ``siblings`` holds the
    sibling digests of a proof, 32 bytes each; digests in the other columns are hex. A row
    without siblings has the digest of nothing as its proof. A row is verified if its shown
    digest folds into the root.
    """
    manifest = build(rows, group, order)
    paths = climb(manifest, with_siblings)
    root = F.lit(manifest.root).cast("string")
    found = manifest.leaves.join(paths, "rid").join(manifest.blocks.select("tree", "block", "subroot"), ["tree", "block"])
    return found.select(
        "doc_id", as_hex(F.col("leaf")).alias("leaf"), as_hex(F.col("subroot")).alias("subroot"), root.alias("root"),
        as_hex(F.col("proof")).alias("proof_sha256"), as_hex(F.col("folded")).alias("folded_root"),
        (as_hex(F.col("folded")) == root).alias("verified"), *(["siblings"] if with_siblings else []),
    )


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def document_leaves(docs: DataFrame, tampered: Column, text_col: str = "text") -> DataFrame:
    """(doc_id, lang, leaf, shown) of documents; where ``tampered``, what is shown has A-Z in its text in lower case."""
    fields = [F.col(text_col if name == "text" else name) for name in FIELDS]
    lowered = F.translate(fields[-1], "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    leaf = digest(leaf_text(*fields))
    shown = F.when(F.coalesce(tampered, F.lit(False)), digest(leaf_text(*fields[:-1], lowered))).otherwise(leaf)
    return docs.select("doc_id", "lang", leaf.alias("leaf"), shown.alias("shown"))
