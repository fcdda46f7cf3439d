"""Merkle manifest of a dataset: a tree per source, a tree over the sources, and a proof for every row by pointer jumping.

Leaves are numbered within their source; six levels of a tree are hashed at once, in groups of consecutive nodes whose size is fixed.
Every node then holds a pointer to its parent and the segment of siblings that lies between. A self-join replaces the pointer by the
pointed node's own and appends that node's segment to the node's; each round doubles the distance, so a tree of n rows takes about log2(log3 n) rounds.
A node has at most ``arity ** distance`` others that point to it, so no pointer is hot: a round whose pointed nodes are few is joined by broadcast, which is
decided by their count.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalog_star.operators.keys import number_rows
from catalog_star.staging import stage

#: Levels hashed by one grouping.
LEVELS = 6
#: Nodes that are broadcast at most: each holds at most some 2 kB of siblings.
MOST_BROADCAST = 2048
#: The tree over the sources.
TOP = -1


def encoded(column: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value as text."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(text: Column) -> Column:
    """SHA-256 as bytes; they are written as hexadecimal text wherever they are hashed again."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def written(digests: Column) -> Column:
    """Bytes of one digest or several as lower-case hexadecimal text."""
    return F.lower(F.hex(digests))


def leaf_digest(columns: dict[str, Column]) -> Column:
    return digest(F.concat(*[encoded(c) for c in columns.values()]))


def _bytes(digests: Column) -> Column:
    """Some digests one after the other."""
    return F.aggregate(digests, F.lit(b"").cast("binary"), lambda a, x: F.concat(a, x))


def _depth(n: Column, arity: int) -> Column:
    """Levels above the leaves of a tree of n leaves."""
    return sum(F.when(n > F.lit(arity**k), 1).otherwise(0) for k in range(64) if arity**k < 2**63)


@dataclass(frozen=True)
class Forest:
    """Trees hashed in blocks of ``arity ** LEVELS`` nodes. ``blocks`` has a table for every LEVELS levels; their arrays ``row0`` to ``row6`` are a block's nodes by level."""

    blocks: list[DataFrame]
    roots: DataFrame
    arity: int

    def nodes(self, level: int) -> DataFrame:
        """Nodes that have a parent: (tree, depth, place, digest, left, right), and at level 0 what came with the leaves.

        ``left`` and ``right`` are the digests of the siblings on either side, one after the other.
        """
        of, k = divmod(level, LEVELS)
        rows = self.blocks[of].where(F.col("depth") > level)
        around = _with_siblings(f"row{k}", self.arity)
        if level == 0:
            around = F.zip_with(around, "carried", lambda x, c: F.struct(x["digest"].alias("digest"), x["left"].alias("left"), x["right"].alias("right"), c.alias("carried")))
        each = rows.select("tree", "depth", "block", F.posexplode(around).alias("i", "x"))
        return each.select("tree", "depth", (F.col("block") * self.arity ** (LEVELS - k) + F.col("i")).alias("place"), "x.*")

    def levels(self) -> range:
        return range(LEVELS * len(self.blocks))


def grow(leaves: DataFrame, arity: int, label: str) -> Forest:
    """Hash trees of (tree, n, place, digest, carried): n leaves a tree with places from 0, and what is kept beside a leaf."""
    below, blocks, roots = leaves.withColumn("depth", _depth(F.col("n"), arity)), [], []
    while True:
        level = LEVELS * len(blocks)
        roots.append(below.where(F.col("depth") == level).select("tree", "digest"))
        open_ = below.where(F.col("depth") > level)
        if blocks and open_.isEmpty():
            return Forest(blocks, _union(roots), arity)
        item = F.struct("place", "digest", *([] if blocks else ["carried"]))
        rows = open_.groupBy("tree", "depth", F.floor(F.col("place") / arity**LEVELS).alias("block")).agg(F.sort_array(F.collect_list(item)).alias("items"))
        rows = rows.select("tree", "depth", "block", F.col("items.digest").alias("row0"), *([] if blocks else [F.col("items.carried").alias("carried")]))
        for k in range(LEVELS):  # a last node without neighbours has a parent of its own
            parents = F.transform(F.sequence(F.lit(0), F.floor((F.size(f"row{k}") - 1) / arity).cast("int")), _parent(f"row{k}", arity))
            rows = rows.withColumn(f"row{k + 1}", F.when(F.col("depth") > level + k, parents))
        rows = stage(rows, f"{label}-{level}")
        blocks.append(rows)
        roots += [rows.where(F.col("depth") == level + k).select("tree", F.get(f"row{k}", F.lit(0)).alias("digest")) for k in range(1, LEVELS)]
        below = rows.where(F.col("depth") >= level + LEVELS).select("tree", "depth", F.col("block").alias("place"), F.get(f"row{LEVELS}", F.lit(0)).alias("digest"))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _parent(row: str, arity: int):
    return lambda i: digest(written(_bytes(F.slice(F.col(row), i * arity + 1, F.lit(arity)))))


def _with_siblings(row: str, arity: int) -> Column:
    def around(x: Column, i: Column) -> Column:
        first = F.floor(i / arity).cast("int") * arity
        left = _bytes(F.slice(F.col(row), first + 1, i - first))
        right = _bytes(F.slice(F.col(row), i + 2, first + arity - 1 - i))
        return F.struct(x.alias("digest"), left.alias("left"), right.alias("right"))

    return F.transform(F.col(row), around)


def _node(tree: Column, level: Column, place: Column) -> Column:
    return F.struct(tree.cast("bigint").alias("tree"), level.cast("int").alias("level"), place.cast("bigint").alias("place"))


def jumped(nodes: DataFrame, label: str) -> DataFrame:
    """Every node's whole way to the root: (node, siblings, subroot), siblings an array of (left, right) from the node upwards.

    ``nodes`` are (node, parent, siblings, subroot), from level 1 on: the pointer is null at the root's children, the subroot is known at the
    leaves of the upper tree and found on the way. Each round is a self-join that doubles the distance between a node and the one it points to.
    """
    done, distance = stage(nodes, f"{label}-1"), 1
    while not (open_ := done.where("parent is not null")).isEmpty():
        # what lies below cannot be pointed to at this distance
        pointed = done.where((F.col("node.level") > distance) | (F.col("node.tree") == TOP))
        few = pointed.count() <= MOST_BROADCAST
        pointed = pointed.select(F.col("node").alias("parent"), F.col("parent").alias("__next"), F.col("siblings").alias("__more"), F.col("subroot").alias("__subroot"))
        joined = open_.join(F.broadcast(pointed) if few else pointed, "parent")
        further = joined.select("node", F.col("__next").alias("parent"), F.concat("siblings", "__more").alias("siblings"), F.coalesce("subroot", "__subroot").alias("subroot"))
        distance *= 2
        done = stage(done.where("parent is null").unionByName(further), f"{label}-{distance}")
    return done.select("node", "siblings", "subroot")


def folded(leaf: Column, siblings: Column) -> Column:
    """The root that a leaf and the siblings on its way make."""
    return F.aggregate(siblings, leaf, lambda a, s: digest(written(F.concat(s["left"], a, s["right"]))))


def prove(
    docs: DataFrame, columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), id: str = "doc_id", group: str = "source",
    altered: dict[str, Column] | None = None, arity: int = 3,
) -> DataFrame:
    """A row per row of ``docs``: id, leaf, subroot, root, siblings, claimed. Digests are bytes.

    A leaf is the digest of ``columns``; leaves of a group ascend by id, nulls first, then by digest; groups ascend, null first. ``siblings`` are the
    (left, right) digests on the way to the root, the lone node's empty. ``claimed`` is the leaf as made of ``altered`` expressions in place of
    the columns they are named after, and the leaf itself without them. Equal rows are leaves of their own. No other column is read; an empty
    table has no root and gives an empty result.
    """
    own = {c: F.col(f"`{c}`") for c in columns}
    leaf = leaf_digest(own)
    claimed = leaf_digest({**own, **altered}) if altered else leaf
    thin = docs.select(own[id].alias("id"), own[group].cast("string").alias("group"), leaf.alias("digest"), claimed.alias("claimed"))
    thin = stage(thin.withColumn("row", F.monotonically_increasing_id()), "leaves")
    placed = number_rows(thin, ["group", "id", "digest", "row"], "number", start=0, label="leaves_numbered")
    groups = placed.groupBy("group").agg(F.min("number").alias("first"), F.count("*").alias("n"))
    groups = number_rows(groups, "group", "tree", start=0, label="groups").select("tree", F.col("group").alias("__group"), "first", "n")
    total = groups.count()
    sized = placed.join(F.broadcast(groups) if total <= MOST_BROADCAST else groups, F.col("group").eqNullSafe(F.col("__group")))
    forest = grow(sized.select("tree", "n", (F.col("number") - F.col("first")).alias("place"), "digest", F.struct("id", "claimed").alias("carried")), arity, "blocks")
    nothing = F.struct(F.lit(None).cast(thin.schema["id"].dataType).alias("id"), F.lit(None).cast("binary").alias("claimed"))
    tops = grow(forest.roots.select(F.lit(TOP).cast("bigint").alias("tree"), F.lit(total).cast("bigint").alias("n"), F.col("tree").alias("place"), "digest", nothing.alias("carried")), arity, "tops")
    root = tops.roots.first()
    if root is None:
        root = (None, None)

    above = _node(F.lit(TOP), F.lit(0), F.col("tree")) if total > 1 else F.lit(None).cast("struct<tree:bigint,level:int,place:bigint>")
    siblings = F.array(F.struct("left", "right"))
    unknown = F.lit(None).cast("binary")
    up = lambda level: _node(F.col("tree"), F.lit(level + 1), F.floor(F.col("place") / arity))
    ways = []
    for level in forest.levels()[1:]:
        rows = forest.nodes(level)
        parent = F.when(F.col("depth") == level + 1, above).otherwise(up(level))
        ways.append(rows.select(_node(F.col("tree"), F.lit(level), F.col("place")).alias("node"), parent.alias("parent"), siblings.alias("siblings"), unknown.alias("subroot")))
    for level in tops.levels():
        rows = tops.nodes(level)
        parent = F.when(F.col("depth") > level + 1, up(level))
        known = F.col("digest") if level == 0 else unknown
        ways.append(rows.select(_node(F.col("tree"), F.lit(level), F.col("place")).alias("node"), parent.alias("parent"), siblings.alias("siblings"), known.alias("subroot")))
    ways = jumped(_union(ways), "ways")

    leaves = forest.nodes(0).select("digest", "carried", siblings.alias("own"), F.when(F.col("depth") == 1, above).otherwise(up(0)).alias("node"))
    lone = sized.where("n = 1").select("digest", F.struct("id", "claimed").alias("carried"), F.slice(F.array(F.struct(F.lit(b"").alias("left"), F.lit(b"").alias("right"))), 1, 0).alias("own"), above.alias("node"))
    found = leaves.unionByName(lone).join(ways, "node", "left")
    top = F.lit(bytes(root[1])) if root[1] is not None else unknown
    whole = F.when(F.col("siblings").isNull(), F.col("own")).otherwise(F.concat("own", "siblings"))
    # Without a way there is no upper tree: the group's root is the root.
    return found.select(
        F.col("carried.id").alias(id), F.col("digest").alias("leaf"), F.coalesce("subroot", top).alias("subroot"), top.alias("root"), whole.alias("siblings"), F.col("carried.claimed").alias("claimed")
    )


def comparison_sql(documents: str) -> str:
    """DuckDB SQL for ``op11``: trees and ways level by level, tampering by the CRC-32 of the id."""
    encode = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = lambda text: "sha256(" + " || ".join(encode(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    tree = lambda name, leaves: f"""
{name}(tree, level, place, n, digest) AS (
  SELECT tree, 0, place, n, digest FROM {leaves}
  UNION ALL
  SELECT tree, any_value(level) + 1, place // 3, any_value((n + 2) // 3), sha256(string_agg(digest, '' ORDER BY place)) FROM {name} WHERE n > 1 GROUP BY tree, place // 3)"""  # noqa: E731
    return f"""
WITH RECURSIVE crc AS (
  SELECT DISTINCT doc_id, list_reduce(list_prepend(4294967295::UBIGINT, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
    lambda c: [ascii(c)::UBIGINT, 999, 999, 999, 999, 999, 999, 999, 999]))),
    lambda a, x: CASE WHEN x < 999 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384::UBIGINT) ELSE a >> 1 END) AS c FROM {documents} WHERE doc_id IS NOT NULL),
d AS (SELECT doc_id, source, {leaf("text")} AS digest,
  CASE WHEN c % 2 = 1 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf("text")} END AS claimed FROM {documents} LEFT JOIN crc USING (doc_id)),
leaves AS (SELECT doc_id, digest, claimed, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, digest) - 1 AS place, count(*) OVER (PARTITION BY source) AS n FROM d),
{tree("lower_", "leaves")},
subroots AS (SELECT -1 AS tree, tree AS place, digest, count(*) OVER () AS n FROM lower_ WHERE n = 1),
{tree("upper_", "subroots")},
nodes AS (SELECT tree, level, place, n, digest, n = 1 AS top FROM lower_ UNION ALL SELECT -1, level, place, n, digest, n = 1 FROM upper_),
runs AS (SELECT *, coalesce(string_agg(digest, '' ORDER BY place) OVER (PARTITION BY tree, level, place // 3 ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(digest, '' ORDER BY place) OVER (PARTITION BY tree, level, place // 3 ORDER BY place ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM nodes),
walk(leaf_tree, leaf_place, tree, level, place, proof, folded, ended) AS (
  SELECT tree, place, tree, 0, place, '', claimed, false FROM leaves
  UNION ALL
  SELECT leaf_tree, leaf_place, CASE WHEN top THEN -1 ELSE w.tree END, CASE WHEN top THEN 0 ELSE w.level + 1 END, CASE WHEN top THEN w.tree ELSE w.place // 3 END,
    CASE WHEN top THEN proof ELSE proof || l || r END, CASE WHEN top THEN folded ELSE sha256(l || folded || r) END, w.tree = -1 AND top
  FROM walk w JOIN runs USING (tree, level, place) WHERE NOT ended)
SELECT doc_id, a.digest AS leaf, s.digest AS subroot, t.digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = t.digest AS verified
FROM walk w JOIN leaves a ON a.tree = leaf_tree AND a.place = leaf_place JOIN subroots s ON s.place = leaf_tree, upper_ t WHERE ended AND t.n = 1
"""
