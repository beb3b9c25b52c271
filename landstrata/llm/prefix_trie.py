"""The trie of conversations' shared beginnings, found block by block.

A path is a sequence of turns. Its turns are hashed in blocks of a fixed number of turns, and a
block's digest is chained to what lies before it, so that equal digests mean equal beginnings. Paths
are grouped by these digests first. Where one block only follows a beginning, all its turn boundaries
have the block's members; where several blocks follow, and only there, their distinct blocks (not the
conversations) are cut at turns and grouped again.

Sums over subtrees need no walk over the tree. Of all members of a node the smallest one is its owner.
What a conversation owns is an end of its path, so a path of W bytes before its first own node adds
W less the bytes before a node to that node's saving, and the leaves below a node are those members
that own a childless node. Both are plain sums over the members of a block.

Turns are told apart by SHA-256, paths by 128 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landstrata.operators.ordering import with_position
from landstrata.session import materialise, ship

# Turns of a block.
BLOCK = 4
# Blocks of a path over which digests are chained in one window; longer paths chain these stretches.
STRETCH = 256
# Ids of one piece of the text that a node's digest is taken of.
PIECE = 50_000

NODE = ["depth", "x", "y"]
NODES = "depth long, x long, y long, conv_id long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


class Trie(NamedTuple):
    nodes: DataFrame  # one row a node, named by (depth, x, y): see NODES
    ends: DataFrame  # (depth, x, y, conv_id): the node at which each conversation ends


def turns(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, at, x, y, bytes): every turn's place in its conversation from 0, its digest, and its text's UTF-8 bytes.

    Turns are ordered by `turn`, null first; turns of one number by the SHA-256 of role and text, so a
    repeated row is a turn of its own. Null roles and texts are empty. Rows without a conversation are
    left out. A conversation may hold any share of the rows: places come from a range sort.
    """
    said = F.coalesce(F.col(text), F.lit(""))
    by = F.coalesce(F.col(role).cast("string"), F.lit(""))
    mark = F.sha2(F.concat(F.octet_length(by).cast("string"), F.lit(":"), by, said), 256)
    rows = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("bigint").alias("conv_id"), F.col(turn).alias("turn"), mark.alias("mark"), F.octet_length(said).cast("bigint").alias("bytes")
    )
    placed = with_position(rows, ["conv_id"], [F.col("conv_id").asc(), F.col("turn").asc_nulls_first(), F.col("mark").asc()])
    lanes = (F.xxhash64("mark").alias("x"), F.xxhash64(F.lit("second"), "mark").alias("y"))
    return placed.select("conv_id", F.col("position").cast("bigint").alias("at"), *lanes, "bytes")


def rebuilt(placed: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """Turns of conversations that begin like another one, as `turns` gives them.

    A conversation c begins with the first h turns of c - c % group (all if it has fewer, none if it is
    not there), with h the unsigned CRC-32 of c's digits modulo `most`; its own turns from the h-th on follow.
    """
    leader = F.col("conv_id") - F.col("conv_id") % group
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    follows = F.col("conv_id") % group != 0
    heads = placed.where(~follows & (F.col("at") < most - 1)).withColumnRenamed("conv_id", "leader")
    taking = placed.where(follows & (h > 0)).select("conv_id").distinct().select("conv_id", leader.alias("leader"), h.alias("h"))
    begun = taking.join(heads, "leader").where("at < h").select("conv_id", "at", "x", "y", "bytes")
    # Where the leader is shorter than h, later turns move up.
    held = heads.groupBy("leader").agg(F.count(F.lit(1)).alias("held"))
    moved = taking.join(held, "leader", "left").select("conv_id", (F.col("h") - F.least("h", F.coalesce("held", F.lit(0)))).alias("moved"))
    own = placed.where(~follows | (F.col("at") >= h)).join(moved.where("moved > 0"), "conv_id", "left")
    own = own.select("conv_id", (F.col("at") - F.coalesce("moved", F.lit(0))).alias("at"), "x", "y", "bytes")
    return begun.unionByName(own)


def trie(placed: DataFrame, members: DataFrame, block: int = BLOCK) -> Trie:
    """The trie of the paths in `placed` (see `turns`) of all conversations in `members` (conv_id).

    A node is a distinct sequence of the first `depth` turns; its members are the conversations that
    begin with it, also those without turns for the root. `conv_id` is the smallest member.
    `saved_tokens` sums, over a node's subtree, what keeping each node's last text once saves.
    Without members there is no node, not even the root.
    """
    spark = placed.sparkSession
    paths = materialise(_paths(placed, block))
    whole = paths.groupBy("conv_id").agg(F.sum("n").alias("depth"), F.expr("bit_xor(ex)").alias("x"), F.expr("bit_xor(ey)").alias("y"), F.sum("eb").alias("total"))
    members = members.where("conv_id is not null").select("conv_id").distinct().join(whole, "conv_id", "left")
    members = materialise(members.select("conv_id", *(F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in (*NODE, "total"))))
    ends = members.select(*NODE, "conv_id")
    root = members.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).first()
    if not root.n_convs:
        return Trie(spark.createDataFrame([], NODES), ends)

    groups = materialise(_with_siblings(_grouped(paths)))
    top = spark.createDataFrame([(0, 0, 0, None, None, 0, 0, root.n_convs, root.conv_id)], "depth long, x long, y long, ux long, uy long, bytes long, before long, n_convs long, conv_id long")
    found = materialise(_nodes(groups, block, (F.sum("n_convs"), F.min("conv_id")), ("n_convs", "conv_id")).unionByName(top))
    below = found.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("ux").alias("x"), F.col("uy").alias("y")).agg(F.count(F.lit(1)).alias("n_children"))
    found = found.join(below, NODE, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("bigint")))

    # What lies before the first node that a conversation owns, and whether it owns a childless one.
    owned = found.groupBy("conv_id").agg(F.min("before").alias("shared"), F.max((F.col("n_children") == 0).cast("bigint")).alias("leaf"))
    owned = members.join(owned, "conv_id", "left")
    owned = materialise(owned.select("conv_id", F.coalesce("shared", "total").alias("shared"), F.coalesce("leaf", F.lit(0).cast("bigint")).alias("leaf")))
    at = ["k", "bx", "by", "ex", "ey"]
    sums = paths.join(owned, "conv_id").groupBy(*at).agg(F.sum("leaf").alias("n_leaves"), F.sum("shared").alias("shared"), F.min_by("shared", "conv_id").alias("least"))
    others = F.col("shared") - F.col("least") - (F.col("n_convs") - 1) * F.col("before")
    saved = others + F.greatest(F.col("least") - F.col("before"), F.lit(0).cast("bigint"))
    below = _nodes(groups.join(sums, at), block, (F.sum("n_leaves"), F.sum("saved_tokens")), ("n_leaves", "saved_tokens"), saved)
    all_in = owned.agg(F.lit(0).cast("bigint").alias("depth"), F.lit(0).cast("bigint").alias("x"), F.lit(0).cast("bigint").alias("y"), F.sum("leaf").alias("n_leaves"), F.sum("shared").alias("saved_tokens"))
    found = found.join(below.select(*NODE, "n_leaves", "saved_tokens").unionByName(all_in), NODE)

    parents = found.where("depth > 0").select((F.col("depth") + 1).alias("depth"), F.col("x").alias("ux"), F.col("y").alias("uy"), F.col("conv_id").alias("parent_conv_id"))
    deep = found.where("depth > 1").join(parents, ["depth", "ux", "uy"])
    near = found.where("depth <= 1").withColumn("parent_conv_id", F.when(F.col("depth") == 1, F.lit(root.conv_id)))
    columns = [part.split()[0] for part in NODES.split(", ")]
    return Trie(deep.select(*columns).unionByName(near.select(*columns)), ends)


def end_digests(ends: DataFrame) -> DataFrame:
    """(depth, x, y, ends_sha256): the SHA-256 of the comma-joined ids, ascending, that end at each node.

    A digest is sequential by definition: ids are sorted and joined to pieces by all tasks, and one
    running hash a node reads its pieces, so the task of a node at which a third of all conversations
    end holds one piece at a time.
    """
    ship(ends.sparkSession)
    order = ["x", "y", "depth", "conv_id"]
    pieces = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_joined, "depth long, x long, y long, first long, ids string")
    pieces = pieces.repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return pieces.mapInArrow(_hashed, "depth long, x long, y long, ends_sha256 string")


# ---- blocks --------------------------------------------------------------------------------------


def _paths(placed: DataFrame, block: int) -> DataFrame:
    """One row a block of a path: its place k, turns n, the digest (bx, by) and bytes (bb) before it, its
    own (ex, ey, eb), and the turns' digests and bytes (x0, y0, b0, x1, ...)."""
    at = F.col("at") % block
    rows = placed.select("conv_id", (F.col("at") / block).cast("bigint").alias("k"), at.alias("j"), F.xxhash64("at", "x", "y").alias("x"), F.xxhash64("y", "x", "at").alias("y"), "bytes")
    one = [F.max(F.when(F.col("j") == j, F.col(c))).alias(f"{name}{j}") for j in range(block) for c, name in (("x", "x"), ("y", "y"), ("bytes", "b"))]
    per = rows.groupBy("conv_id", "k").agg(F.count(F.lit(1)).alias("n"), F.expr("bit_xor(x)").alias("ex"), F.expr("bit_xor(y)").alias("ey"), F.sum("bytes").alias("eb"), *one)
    per = per.withColumn("stretch", (F.col("k") / STRETCH).cast("bigint"))

    def before(over, *names: str) -> list[Column]:
        pairs = zip(("bit_xor(ex)", "bit_xor(ey)", "sum(eb)"), names)
        return [F.coalesce(F.expr(e).over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("bigint")).alias(n) for e, n in pairs]

    near = Window.partitionBy("conv_id", "stretch").orderBy("k")
    far = Window.partitionBy("conv_id").orderBy("stretch")  # one row for STRETCH * block turns
    stretches = per.groupBy("conv_id", "stretch").agg(*(F.expr(f"{e}({c})").alias(c) for e, c in (("bit_xor", "ex"), ("bit_xor", "ey"), ("sum", "eb"))))
    stretches = stretches.select("conv_id", "stretch", *before(far, "fx", "fy", "fb")).where("stretch > 0")
    per = per.select("*", *before(near, "nx", "ny", "nb")).join(stretches, ["conv_id", "stretch"], "left")
    zero = F.lit(0).cast("bigint")
    chained = [F.coalesce("fx", zero).bitwiseXOR(F.col("nx")).alias("bx"), F.coalesce("fy", zero).bitwiseXOR(F.col("ny")).alias("by"), (F.coalesce("fb", zero) + F.col("nb")).alias("bb")]
    return per.select("conv_id", "k", "n", *chained, "ex", "ey", "eb", *(f"{c}{j}" for j in range(block) for c in "xyb"))


def _grouped(paths: DataFrame) -> DataFrame:
    """Paths by chained block digests: one row a distinct block, whose other columns all its paths share."""
    at = ["k", "bx", "by", "ex", "ey"]
    same = [F.max(c).alias(c) for c in paths.columns if c not in (*at, "conv_id", "eb")]
    return paths.groupBy(*at).agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("conv_id"), *same)


def _with_siblings(groups: DataFrame) -> DataFrame:
    """Adds `diverges`: whether another block follows the same beginning. First blocks are taken to."""
    later = groups.where("k > 0")
    several = later.groupBy("k", "bx", "by").agg(F.count(F.lit(1)).alias("blocks")).where("blocks > 1").drop("blocks")
    marked = later.join(several.withColumn("diverges", F.lit(True)), ["k", "bx", "by"], "left").withColumn("diverges", F.coalesce("diverges", F.lit(False)))
    return groups.where("k = 0").withColumn("diverges", F.lit(True)).unionByName(marked.select(*groups.columns, "diverges"))


def _nodes(groups: DataFrame, block: int, sums: tuple[Column, ...], names: tuple[str, ...], saved: Column | None = None) -> DataFrame:
    """One row a node of depth 1 or more, with its parent (ux, uy), its last text's bytes and those before it,
    and the columns `names`, which `sums` make of the rows of the blocks a node lies in."""
    x, y, before, boundaries = F.col("bx"), F.col("by"), F.col("bb"), []
    for j in range(block):
        ux, uy, x, y = x, y, x.bitwiseXOR(F.col(f"x{j}")), y.bitwiseXOR(F.col(f"y{j}"))
        depth = F.col("k") * block + j + 1
        boundaries.append(F.struct(depth.alias("depth"), x.alias("x"), y.alias("y"), ux.alias("ux"), uy.alias("uy"), F.col(f"b{j}").alias("bytes"), before.alias("before")))
        before = before + F.col(f"b{j}")
    cut = groups.select("*", F.explode(F.slice(F.array(*boundaries), F.lit(1), F.col("n").cast("int"))).alias("v")).select("*", "v.*")
    if saved is not None:
        cut = cut.withColumn("saved_tokens", saved)
    columns = [*NODE, "ux", "uy", "bytes", "before"]
    refined = cut.where("diverges").groupBy(*NODE).agg(*(F.max(c).alias(c) for c in columns[3:]), *(s.alias(n) for s, n in zip(sums, names)))
    return cut.where("not diverges").select(*columns, *names).unionByName(refined.select(*columns, *names))


# ---- inside a task -------------------------------------------------------------------------------


def _runs(batches: Iterator[pa.RecordBatch], value: str) -> Iterator[tuple[tuple, list]]:
    """(node, values) of neighbouring rows of one node, within a batch."""
    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in NODE)))
        values = batch.column(value).to_pylist()
        began = 0
        for k in range(1, len(keys) + 1):
            if k == len(keys) or keys[k] != keys[began]:
                yield keys[began], values[began:k]
                began = k


def _rows(rows: list[tuple], names: tuple[str, str]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 3 + [pa.int64() if n == "first" else pa.string() for n in names if n]
    columns = zip(*rows) if rows else [[] for _ in kinds]
    return pa.RecordBatch.from_arrays([pa.array(list(c), type=t) for c, t in zip(columns, kinds)], [*NODE, *(n for n in names if n)])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = []
    for node, ids in _runs(batches, "conv_id"):
        for a in range(0, len(ids), PIECE):
            out.append((*node, ids[a], ",".join(map(str, ids[a : a + PIECE]))))
        if len(out) >= 10_000:
            yield _rows(out, ("first", "ids"))
            out = []
    yield _rows(out, ("first", "ids"))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    node, running, out = None, None, []
    for now, pieces in _runs(batches, "ids"):
        if now != node:
            if running:
                out.append((*node, running.hexdigest()))
            node, running = now, hashlib.sha256(pieces.pop(0).encode())
        for piece in pieces:
            running.update(b"," + piece.encode())
        if len(out) >= 10_000:
            yield _rows(out, ("ends_sha256", ""))
            out = []
    if running:
        out.append((*node, running.hexdigest()))
    yield _rows(out, ("ends_sha256", ""))
