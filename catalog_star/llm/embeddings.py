"""Near-duplicate vectors through a pivot-permutation index.

Reference points (pivots) are drawn from the vectors. A vector is described by its nearest pivots in order. There is an inverted list
for every pair of pivots, with the vectors that have both among their nearest: whoever meets there shares two
pivots at least. Pairs that share fewer than ``least_shared`` are passed over, the others verified by cosine in double
precision, each in the first list that it shares. Equal vectors are one node with a count, so copies make no pairs;
a list gives the links of each node as a number and a spanning forest, so its output is as long as the list.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_star.llm.components import components, roots
from catalog_star.llm.sampling import smallest_hashes
from catalog_star.staging import stage


def pivot_order(vectors: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    """The ``nearest`` pivots of each unit vector, nearest first; of equally near ones the earlier."""
    nearest = min(nearest, len(pivots))
    close = -(vectors @ pivots.T)
    some = np.argpartition(close, nearest - 1, axis=1)[:, :nearest]
    some.sort(axis=1)
    return np.take_along_axis(some, np.argsort(np.take_along_axis(close, some, 1), axis=1, kind="stable"), 1)


def units(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length 1; scaled first, so that squares neither overflow nor vanish."""
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def spread(vectors: np.ndarray, threshold: float) -> np.ndarray:
    """Vectors, in order, of which no two are as near as twice the angle of the threshold.

    Pivots inside a cluster of near copies would come in as many orders as it has members, which then share few.
    """
    least = math.cos(min(math.pi, 2 * math.acos(min(1.0, threshold))))
    kept: list[int] = []
    for i, row in enumerate(vectors @ vectors.T):
        if not kept or row[kept].max() < least:
            kept.append(i)
    return vectors[kept]


def shared_first_pair(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How many pivots two descriptions share, and the two smallest of these (-1 if there are fewer)."""
    a = np.sort(a, axis=1)
    both = (a[:, :, None] == b[:, None, :]).any(2)
    count = both.sum(1)
    first = both.argmax(1)
    rest = both.copy()
    rest[np.arange(len(a)), first] = False
    second = rest.argmax(1)
    rows = np.arange(len(a))
    return count, np.where(count > 0, a[rows, first], -1), np.where(count > 1, a[rows, second], -1)


class ListSearch:
    """Links within inverted lists: each a run of rows with the same key."""

    def __init__(self, threshold: float, least_shared: int):
        self.threshold, self.least_shared = threshold, least_shared

    def links(self, vectors: np.ndarray, order: np.ndarray, low: int, high: int, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of rows at the threshold whose first shared list is (low, high); between sides 1 and 2 if there are two."""
        left, right = [], []
        least = min(self.least_shared, order.shape[1])  # where there is one pivot, all share it in the list (0, 0)
        step = max(1, (1 << 22) // max(1, len(vectors)))
        for i in range(0, len(vectors), step):
            x, y = np.nonzero(vectors[i : i + step] @ vectors.T >= self.threshold)
            x += i
            ok = (x < y) & ((side[x] != side[y]) | (side[x] == 0))
            x, y = x[ok], y[ok]
            for j in range(0, len(x), 1 << 16):
                a, b = x[j : j + (1 << 16)], y[j : j + (1 << 16)]
                count, first, second = shared_first_pair(order[a], order[b])
                own = (count >= least) & (first == low) & (np.where(count > 1, second, first) == high)
                left.append(a[own]), right.append(b[own])
        return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _described(nodes: DataFrame, pivots: dict[int, np.ndarray], nearest: int) -> DataFrame:
    """A row per node and pair of its nearest pivots: label, dim, low, high, node, order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                rows = batch.filter(pa.array(dims == dim))
                for part in range(0, rows.num_rows, 1024):
                    some = rows.slice(part, 1024)
                    vectors = units(some.column("vector").flatten().to_numpy().reshape(-1, dim))
                    order = pivot_order(vectors, pivots[int(dim)], nearest).astype(np.int32)
                    pairs = list(combinations(range(order.shape[1]), 2)) or [(0, 0)]
                    a, b = (order[:, [p[k] for p in pairs]] for k in (0, 1))
                    who = pa.array(np.repeat(np.arange(len(order)), len(pairs)))
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, order.size + 1, order.shape[1], dtype=np.int32)), pa.array(order.ravel()))
                    yield pa.RecordBatch.from_arrays(
                        [some.column("label").take(who), some.column("dim").take(who), pa.array(np.minimum(a, b).ravel()), pa.array(np.maximum(a, b).ravel()), some.column("node").take(who), lists.take(who)],
                        names=["label", "dim", "low", "high", "node", "order"],
                    )

    return nodes.select("label", "dim", "node", "vector").mapInArrow(run, "label string, dim int, low int, high int, node string, order array<int>")


def pivot_links(nodes: DataFrame, threshold: float = 0.98, nearest: int = 6, least_shared: int = 2, most_pivots: int = 4096, block: int = 1024) -> DataFrame:
    """Rows (node, root, links) over (node, label, dim, vector, copies): each list's links of a node, counted in
    copies, and the root of its tree there.

    There are about four times the square root of the number of nodes pivots, ``most_pivots`` at most: then lists stay as
    long however many nodes there are. A list of more than ``block`` nodes is cut into blocks by hash, and all pairs
    of blocks are searched.
    """
    spark = nodes.sparkSession
    counts = {r[0]: r[1] for r in nodes.groupBy("dim").count().collect()}
    wanted = {dim: max(2 * nearest, min(most_pivots, int(4 * math.sqrt(n)))) for dim, n in counts.items()}
    pivots = {}
    for dim, n in wanted.items():
        drawn = smallest_hashes(nodes.where(F.col("dim") == dim).select("node", "vector"), ["node"], n).select("vector").collect()
        pivots[dim] = spread(units(np.array([r[0] for r in drawn], np.float64)), threshold)
    postings = stage(_described(nodes, pivots, nearest), "postings")
    key = ["label", "dim", "low", "high"]
    sizes = postings.groupBy(*key).agg(F.count("*").alias("size")).where("size > 1")
    met = postings.join(sizes, key).withColumn("blocks", F.ceil(F.col("size") / block).cast("int"))
    own = F.pmod(F.xxhash64("node", "low", "high"), F.col("blocks")).cast("int")
    met = met.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select(*key, F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), F.when(F.col("own") == F.col("other"), 0).when(F.col("own") < F.col("other"), 1).otherwise(2).alias("side"), "node", "order")
    rows = met.join(nodes.select("node", "vector", "copies"), "node")
    key += ["i", "j"]
    parts = max(1, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.repartition(parts, *key).sortWithinPartitions(*key, "node").select(F.xxhash64(*key).alias("key"), "dim", "low", "high", "side", "node", "order", "vector", "copies", F.struct(*key).alias("full"))
    search = ListSearch(threshold, least_shared)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            cuts = _runs(table)
            yield from _search_runs(table, cuts[:-1], search)
            rest = table.slice(cuts[-2]) if len(cuts) > 1 else table
            rest = rest.combine_chunks()
        if rest is not None and rest.num_rows:
            yield from _search_runs(rest, _runs(rest), search)

    return rows.mapInArrow(run, "node string, root string, links long")


def _runs(table: pa.Table) -> np.ndarray:
    """Where runs of equal keys begin, and the end."""
    full = table.column("full").combine_chunks()
    full = full.chunk(0) if isinstance(full, pa.ChunkedArray) else full
    change = np.zeros(table.num_rows, bool)
    change[:1] = True
    for field in full.flatten():
        if pa.types.is_string(field.type):
            field = field.dictionary_encode().indices
        values = field.fill_null(-1).to_numpy(zero_copy_only=False)
        change[1:] |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(change), table.num_rows)


def _search_runs(table: pa.Table, cuts: np.ndarray, search: ListSearch) -> Iterator[pa.RecordBatch]:
    if len(cuts) < 2:
        return
    column = lambda name: table.column(name).combine_chunks()
    get = lambda name: column(name).to_numpy(zero_copy_only=False)
    dims, low, high, side, copies = (get(x) for x in ("dim", "low", "high", "side", "copies"))
    node = column("node")
    vector, order = table.column("vector"), table.column("order")
    names, tops, links = [], [], []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if b - a < 2:
            continue
        rows = units(vector.slice(a, b - a).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(b - a, dims[a]))
        described = order.slice(a, b - a).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(b - a, -1)
        x, y = search.links(rows, described, low[a], high[a], side[a:b])
        if not len(x):
            continue
        number = np.zeros(b - a, np.int64)
        np.add.at(number, x, copies[a + y])
        np.add.at(number, y, copies[a + x])
        root = roots(b - a, x, y)
        hit = np.flatnonzero(number)
        names.append(a + hit), tops.append(a + root[hit]), links.append(number[hit])
    if names:
        names, tops, links = map(np.concatenate, (names, tops, links))
        yield pa.RecordBatch.from_arrays([node.take(pa.array(names)), node.take(pa.array(tops)), pa.array(links)], names=["node", "root", "links"])


def near_vectors(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = 0.98, **index) -> DataFrame:
    """A row per vector: id, n_links, component_id and kept.

    Vectors link if labels are equal and not null, lengths are equal and the cosine is at least ``threshold``. A vector that is null or
    empty, has a component that is null or not finite, or is zero, links with nothing: it is its own component. Repeated rows are copies that
    link with each other; a null id takes part, and a component's name is its smallest id that is not null. Other columns are not
    read; an empty table gives an empty result.
    """
    values = F.col(f"`{vector}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id}`").alias("__id"), F.col(f"`{label}`").cast("string").alias("label"), values.alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    sound = F.col("label").isNotNull() & F.col("vector").isNotNull() & finite & F.exists("vector", lambda x: x != 0)
    node = F.when(F.coalesce(sound, F.lit(False)), F.md5(F.concat_ws("|", "label", F.col("vector").cast("string"))))
    rows = rows.withColumn("node", node)
    nodes = rows.where("node is not null").groupBy("node").agg(
        F.first("label").alias("label"), F.first("vector").alias("vector"), F.count("*").alias("copies"), F.min("__id").alias("least")
    )
    nodes = stage(nodes.withColumn("dim", F.size("vector")), "vectors")
    found = stage(pivot_links(nodes, threshold, **index), "vector_links")
    linked = found.groupBy("node").agg(F.sum("links").alias("links"))
    tied = components(found, "node", "root")
    plain = nodes.select("node", "copies", "least")
    named = plain.join(linked, "node", "left").join(tied, "node", "left")
    named = stage(named.select("node", "least", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component", "node").alias("component")), "vector_nodes")
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    answer = named.join(smallest, "component").select("node", "n_links", "component_id")
    sound_rows = rows.where("node is not null").select("__id", "node").join(answer, "node").select("__id", "n_links", "component_id")
    odd_rows = rows.where("node is null").select("__id", F.lit(0).cast("long").alias("n_links"), F.col("__id").alias("component_id"))
    both = sound_rows.unionByName(odd_rows)
    return both.select(F.col("__id").alias(id), "n_links", "component_id", F.col("__id").eqNullSafe(F.col("component_id")).alias("kept"))
