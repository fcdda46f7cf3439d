"""SimHash near-duplicates: fingerprints of word shingles, linked exactly through vantage-point trees.

A tree of vantage points, built on a bounded sample of fingerprints, parts all of them: those within a node's radius
of its vantage point go inside, the others outside, and the leaves are shards. A fingerprint is at home in one
leaf and asks in every leaf that its ball reaches: by the triangle inequality only these can hold a neighbour. Within a leaf
another tree of the same kind, built on all its fingerprints, prunes the comparisons.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_star.llm.components import components, roots
from catalog_star.llm.sampling import smallest_hashes
from catalog_star.llm.texts import Texts, map_texts
from catalog_star.staging import stage

_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def fingerprints_of(texts: Texts, shingle: int = 3, seed: int = 42) -> np.ndarray:
    """64-bit SimHash of each text: a bit is set if it is in over half of the shingles' hashes; without words it is 0."""
    starts, ends, first = texts.words()
    data = _LOWER[texts.data].tobytes()
    joined = b" ".join([data[a:b] for a, b in zip(starts.tolist(), ends.tolist())])
    length = ends - starts + 1
    end = np.cumsum(length) - 1
    start = end - length + 1
    n_words = np.diff(first)
    n_shingles = np.where(n_words >= shingle, n_words - shingle + 1, np.minimum(n_words, 1))
    at = np.append(0, np.cumsum(n_shingles))
    owner = np.repeat(np.arange(len(texts)), n_shingles)
    head = first[owner] + np.arange(at[-1]) - at[owner]
    tail = head + np.minimum(shingle, n_words[owner]) - 1
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in zip(start[head].tolist(), end[tail].tolist())], np.uint64)
    found = np.zeros(len(texts), np.uint64)
    full = np.flatnonzero(n_shingles)
    step = 1 << 14  # shingles whose bits are unpacked at once
    for group in np.split(full, np.flatnonzero(np.diff(at[full] // step)) + 1) if len(full) else []:
        low, high = at[group[0]], at[group[-1] + 1]
        counts = np.zeros((len(group), 64), np.int64)
        for piece in range(low, high, step):  # a very long text spans several
            some = hashes[piece : min(high, piece + step)]
            bits = np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            begin = np.clip(at[group] - piece, 0, len(some))
            end = np.clip(at[group + 1] - piece, 0, len(some))
            here = np.flatnonzero(begin < end)
            counts[here] += np.add.reduceat(bits, begin[here], axis=0, dtype=np.int64)
        set_bits = (2 * counts > n_shingles[group][:, None]).astype(np.uint8)
        found[group] = np.packbits(set_bits, axis=1, bitorder="little").view(np.uint64).ravel()
    return found


def distance(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int16)


def vantage(points: np.ndarray, radius: int, tries: int = 24) -> tuple[np.uint64, int]:
    """The vantage point whose sphere parts the points most evenly with the fewest near its surface."""
    best, chosen = None, (points[0], 0)
    some = points[:: max(1, len(points) // 4096)]
    for point in points[:: max(1, len(points) // tries)]:
        counts = np.bincount(distance(some, point), minlength=65)
        inside = np.cumsum(counts)
        for mu in range(64):
            share = inside[mu] / len(some)
            if not 0.2 <= share <= 0.8:
                continue
            near = inside[min(64, mu + radius)] - (inside[mu - radius] if mu >= radius else 0)
            cost = near / len(some) / -(share * np.log2(share) + (1 - share) * np.log2(1 - share))
            if best is None or cost < best:
                best, chosen = cost, (point, mu)
    if best is None:  # few different distances
        d = distance(points, points[0])
        chosen = (points[0], int(np.median(d)) if (d > np.median(d)).any() else int(d.max()) - 1)
    return chosen


@dataclass
class Tree:
    """Vantage points, radii and children (inside, outside) of the nodes; a child below 0 is leaf ``-child - 1``."""

    points: np.ndarray
    radii: np.ndarray
    children: np.ndarray

    @property
    def leaves(self) -> int:
        return len(self.points) + 1

    @classmethod
    def build(cls, sample: np.ndarray, leaf_size: int, radius: int) -> Tree:
        points, radii, children = [], [], []
        leaves = 0

        def grow(own: np.ndarray) -> int:
            nonlocal leaves
            if len(own) > leaf_size and len(own) > 1:
                point, mu = vantage(own, radius)
                inside = distance(own, point) <= mu
                if inside.any() and not inside.all():
                    node = len(points)
                    points.append(point), radii.append(mu), children.append([0, 0])
                    children[node][0] = grow(own[inside])
                    children[node][1] = grow(own[~inside])
                    return node
            leaves += 1
            return -leaves

        grow(sample)
        return cls(np.array(points, np.uint64), np.array(radii, np.int16), np.array(children, np.int64).reshape(-1, 2))

    def route(self, values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """All leaves that a ball about each value reaches: index of the value, leaf. Radius 0 gives the home."""
        found: list[tuple[np.ndarray, int]] = []
        todo = [(0 if len(self.points) else -1, np.arange(len(values)))]
        while todo:
            node, index = todo.pop()
            if not len(index):
                continue
            if node < 0:
                found.append((index, -node - 1))
                continue
            d, mu = distance(values[index], self.points[node]), self.radii[node]
            todo.append((self.children[node][0], index[d - radius <= mu]))
            todo.append((self.children[node][1], index[d + radius > mu]))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([x for x, _ in found]), np.repeat([leaf for _, leaf in found], [len(x) for x, _ in found])


def close_pairs(homes: np.ndarray, guests: np.ndarray, radius: int, bucket: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Indexes of all pairs (home, guest) within the radius, bucket by bucket of a local tree."""
    todo = [(np.arange(len(homes)), np.arange(len(guests)))]
    while todo:
        h, g = todo.pop()
        if not len(h) or not len(g):
            continue
        if len(h) > bucket:
            point, mu = vantage(homes[h], radius, tries=6)
            d, e = distance(homes[h], point), distance(guests[g], point)
            if (d <= mu).any() and (d > mu).any():
                todo.append((h[d <= mu], g[e - radius <= mu]))
                todo.append((h[d > mu], g[e + radius > mu]))
                continue
        for i in range(0, len(h), bucket):
            for j in range(0, len(g), 4096):
                x, y = np.nonzero(np.bitwise_count(homes[h[i : i + bucket], None] ^ guests[None, g[j : j + 4096]]) <= radius)
                if len(x):
                    yield h[i + x], g[j + y]


def near_links(values: DataFrame, column: str, radius: int = 3, leaf_scale: int = 32, sample_size: int = 32_768) -> DataFrame:
    """Links (a, b) that connect all distinct 64-bit values within ``radius`` bits as if all pairs were there.

    The tree is built on the ``sample_size`` values of smallest hash. A leaf is meant to hold ``leaf_scale`` times the square root of
    the number of values: each level of this tree copies about half of the guests, each level of a leaf's own tree copies
    nothing, so shards grow in size as well as in number. A leaf of more values is parted
    into blocks by hash, as are its guests if there are 16 times as many; all pairs of blocks are searched. Within a block only links along a spanning forest are returned.
    """
    spark = values.sparkSession
    values = stage(values.select(F.col(column).cast("long").alias("value")).where("value is not null").distinct(), "fingerprints")
    count = values.count()
    leaf_size = max(256, int(leaf_scale * count**0.5))
    sample = np.array([r[0] for r in smallest_hashes(values, ["value"], sample_size).collect()], np.int64).view(np.uint64)
    tree = Tree.build(sample, max(8, leaf_size * len(sample) // max(1, count)), radius)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy().view(np.uint64)
            home = np.zeros(len(own), np.int64)
            at, leaf = tree.route(own, 0)
            home[at] = leaf
            for part in range(0, len(own), 4096):
                some = own[part : part + 4096]
                at, leaf = tree.route(some, radius)
                yield pa.RecordBatch.from_arrays([pa.array(leaf), pa.array(some[at].view(np.int64)), pa.array(home[part + at] == leaf)], names=["leaf", "value", "home"])

    routed = stage(values.mapInArrow(route, "leaf long, value long, home boolean"), "routed")
    sizes = routed.groupBy("leaf").agg(F.sum(F.col("home").cast("int")), F.count("*")).collect()  # a row per leaf of the tree
    home_blocks = {leaf: -(-homes // leaf_size) for leaf, homes, _ in sizes}
    guest_blocks = {leaf: -(-guests // (16 * leaf_size)) for leaf, _, guests in sizes}

    def spread(blocks: dict[int, int], seed: int):
        """Number of blocks of a row's leaf, and the row's own block."""
        wide = [F.lit(x) for pair in blocks.items() if pair[1] > 1 for x in pair]
        number = F.coalesce(F.create_map(*wide)[F.col("leaf")] if wide else F.lit(None).cast("int"), F.lit(1))
        return F.sequence(F.lit(0), (number - 1).cast("int")), F.pmod(F.xxhash64("value", F.lit(seed)), number).cast("int")

    all_homes, own_home = spread(home_blocks, 7)
    all_guests, own_guest = spread(guest_blocks, 8)
    placed = (
        routed.where("home").select("leaf", "value", "home", own_home.alias("block"), F.explode(all_guests).alias("part"))
    ).unionByName(routed.select("leaf", "value", F.lit(False).alias("home"), F.explode(all_homes).alias("block"), own_guest.alias("part")))
    total = sum(max(1, n) * guest_blocks[leaf] for leaf, n in home_blocks.items()) or 1
    parts = max(1, min(total, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))

    def search(table: pa.Table) -> pa.Table:
        value = table.column("value").to_numpy().view(np.uint64)
        home = table.column("home").to_numpy()
        homes, guests = np.unique(value[home]), np.unique(value)
        left, right = [], []
        label = np.arange(len(guests))
        place = np.searchsorted(guests, homes)
        for x, y in close_pairs(homes, guests, radius):
            left.append(place[x]), right.append(y)
            if sum(map(len, left)) > 1 << 20:  # keep only what connects
                label = roots(len(guests), np.concatenate([*left, np.arange(len(label))]), np.concatenate([*right, label]))
                left, right = [], []
        label = roots(len(guests), np.concatenate([*left, np.arange(len(label))]), np.concatenate([*right, label]))
        tied = np.flatnonzero(label != np.arange(len(label)))
        return pa.table({"a": guests[tied].view(np.int64), "b": guests[label[tied]].view(np.int64)})

    return placed.repartition(parts, "leaf", "block", "part").groupBy("leaf", "block", "part").applyInArrow(search, "a long, b long")


def simhash_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3) -> DataFrame:
    """A row per document: id, fingerprint (16 hexadecimal digits) and component_id, the smallest id reachable by links.

    Fingerprints link at ``radius`` or fewer differing bits. Equal ones are one node, so copies add no links. A text that is
    null or has no word has the fingerprint 0, which links like any other. Repeated rows stay; a null id
    joins its group, whose component_id is null only if all its ids are. Other columns are not read; an empty table gives an empty result.
    """

    marked = stage(map_texts(docs, text, {"__id": id}, {"__value": "long"}, _fingerprints(shingle)), "simhash")
    nodes = marked.groupBy("__value").agg(F.min("__id").alias("__least"))
    named = _components_of(nodes, radius)
    least = named.groupBy("__component").agg(F.min("__least").alias("component_id"))
    by_value = stage(named.join(least, "__component").select("__value", "component_id"), "simhash_groups")
    return marked.join(by_value, "__value").select(F.col("__id").alias(id), F.lower(F.lpad(F.hex("__value"), 16, "0")).alias("fingerprint"), "component_id")


def _fingerprints(shingle: int):
    return lambda texts: {"__value": fingerprints_of(texts, shingle).view(np.int64)}


def _components_of(nodes: DataFrame, radius: int) -> DataFrame:
    """``nodes`` (fingerprints ``__value`` and what goes with them) with the component of each, staged."""
    tied = components(near_links(nodes, "__value", radius), "a", "b")
    named = nodes.join(tied, nodes["__value"] == tied["node"], "left")
    return stage(named.select(*nodes.columns, F.coalesce("component", "__value").alias("__component")), "simhash_nodes")


def first_of_groups(docs: DataFrame, id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 3) -> DataFrame:
    """One row of each group that ``simhash_groups`` finds: that of the smallest id, of equal ids any one; a null id only where there is no other.

    All texts without words are one group. Other columns are kept as they are, and may have any names but those that begin with two underscores. An empty
    table gives an empty result.
    """
    names = {f"__c{i}": c for i, c in enumerate(docs.columns)}
    made = map_texts(docs, text, names, {"__value": "long"}, _fingerprints(shingle))
    marked = stage(made.withColumn("__row", F.monotonically_increasing_id()), "simhash_rows")
    own = next(new for new, old in names.items() if old == id)
    rank = F.struct(F.col(own).isNull().alias("none"), F.col(own).alias("id"), F.col("__row").alias("row"))
    named = _components_of(marked.groupBy("__value").agg(F.min(rank).alias("__least")), radius)
    kept = stage(named.groupBy("__component").agg(F.min("__least").alias("first")).select(F.col("first.row").alias("__kept")), "simhash_first")
    return marked.join(kept, F.col("__row") == F.col("__kept"), "left_semi").select(*[F.col(new).alias(old) for new, old in names.items()])
