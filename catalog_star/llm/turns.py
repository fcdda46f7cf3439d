"""Repair of conversations: the cheapest edits that make the roles alternate, and of equally cheap ones the least in writing.

A conversation's rows are the steps of a graph whose nodes are (rows read, state), the state being the role written last. Edits are its
arcs: keep, rerole, delete and insert. Rows are numbered over all conversations and cut into blocks of fixed size by number, so a
conversation of any length is a chain of bounded segments. A segment is a matrix of costs from entry to exit state; matrices of a chain are multiplied by
self-joins that double their reach, which gives every segment the costs that lie behind it. Within a segment, a dynamic programme then
finds the arcs of cheapest paths. Nodes on them are ranked by the audits, one letter an edit, that lead on from them: first by one
letter, then by two, four and so on, each time by pairs of ranks, while pointers double their distance. The arc of least rank is
followed, and the path is read off the doubled pointers. Between segments, exit states are chained by doubling in the same way.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalog_star.operators.keys import number_rows
from catalog_star.staging import stage

#: Rows of a block.
BLOCK = 2048
#: States: nothing written, then system, user or assistant written last. Roles by initial have the same numbers, others 0.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("", "system", "user", "assistant")
#: What a kept role leads to, by role and state; -1 where it cannot follow.
KEEP = np.full((4, 4), -1)
KEEP[SYSTEM, NOTHING] = SYSTEM
KEEP[USER, [NOTHING, SYSTEM, ASSISTANT]] = USER
KEEP[ASSISTANT, USER] = ASSISTANT
#: The role that an inserted or reroled row gets in each state.
NEXT = np.array([USER, USER, ASSISTANT, USER])
#: Costs of edits, and what an undeleted truncated row adds.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Letters of edits in the order of their codes from 1 on; 0 is the end.
LETTERS = b"\0DIKR"
#: Cost from each state to the end of a conversation, insertions included.
ENDING = (0, 2 * INSERT, INSERT, 0)
_FAR = 1 << 40


def chain_costs(symbols: np.ndarray, first: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Cost from each node to the end behind its segment. Segment k has the symbols ``first[k]`` to ``first[k + 1]`` and the costs ``ends[k]`` behind it.

    A symbol is a role plus 4 if the row is truncated and plus 8 if it must go. Nodes are counted by segment, rows read and state.
    """
    length = np.diff(first)
    base = first[:-1] + np.arange(len(length))  # a segment has a node more than rows
    best = np.zeros((first[-1] + len(length), 4), np.int64)
    best[base + length] = ends
    longest = np.argsort(-length, kind="stable")
    counts = np.searchsorted(-length[longest], -np.arange(1, length.max(initial=0) + 1), "right")
    for t, n in enumerate(counts, 1):
        some = longest[:n]
        i = length[some] - t
        drop, keep, rerole, _ = _row_arcs(symbols[first[some] + i], best[base[some] + i + 1])
        direct = np.minimum(np.minimum(drop, keep), rerole)
        user, assistant = direct[:, USER] + INSERT, direct[:, ASSISTANT] + INSERT
        best[base[some] + i] = np.stack(
            [np.minimum(np.minimum(direct[:, q], user), assistant + INSERT) for q in (NOTHING, SYSTEM)] + [np.minimum(direct[:, USER], assistant), np.minimum(direct[:, ASSISTANT], user)], 1
        )
    return best


def _row_arcs(symbols: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Costs of deleting, keeping and reroling rows by state, and the state that keeping leads to."""
    extra = np.where(symbols & 4, TRUNCATED, 0)[:, None]
    must_go = (symbols >= 8)[:, None]
    to = KEEP[symbols & 3]
    keep = np.where(must_go | (to < 0), _FAR, extra + np.take_along_axis(after, np.maximum(to, 0), 1))
    rerole = np.where(must_go, _FAR, REROLE + extra + after[:, NEXT])
    return DELETE + after, keep, rerole, to


@dataclass
class Paths:
    """Least cheapest paths: the letter of each node's arc, and where 1, 2, 4, ... arcs lead."""

    letter: np.ndarray
    pointers: list[np.ndarray]
    steps: np.ndarray

    def audits(self, start: np.ndarray) -> list[bytes]:
        """The letters on the paths from some nodes, read through the doubled pointers."""
        n = self.steps[start]
        total = np.append(0, np.cumsum(n))
        at = np.arange(total[-1]) - np.repeat(total[:-1], n)
        node = np.repeat(start, n)
        for k, pointer in enumerate(self.pointers):
            node = np.where(at >> k & 1, pointer[node], node)
        data = np.frombuffer(LETTERS, np.uint8)[self.letter[node]].tobytes()
        return [data[a:b] for a, b in zip(total[:-1].tolist(), total[1:].tolist())]

    def ends(self, start: np.ndarray) -> np.ndarray:
        return self.pointers[-1][start]


def least_paths(symbols: np.ndarray, first: np.ndarray, best: np.ndarray, closing: np.ndarray) -> Paths:
    """Rank the nodes of cheapest arcs by audits of doubled length and follow the least. ``closing`` tells which segments end a conversation."""
    length = np.diff(first)
    base = first[:-1] + np.arange(len(length))
    nodes = np.arange(best.size).reshape(best.shape)
    last = np.zeros(len(best), bool)
    last[base + length] = True
    row = np.flatnonzero(~last)
    drop, keep, rerole, to = _row_arcs(symbols, best[row + 1])
    open_end = last.copy()
    open_end[(base + length)[~closing.astype(bool)]] = False
    insert = np.where((~last | open_end)[:, None], INSERT + best[:, NEXT], _FAR)
    arcs = np.full((5, *best.shape), -1)  # by letter: the node an optimal arc leads to
    arcs[2] = np.where(insert == best, nodes[:, NEXT], -1)
    after = nodes[row + 1]
    arcs[1][row] = np.where(drop == best[row], after, -1)
    arcs[3][row] = np.where(keep == best[row], np.take_along_axis(after, np.maximum(to, 0), 1), -1)
    arcs[4][row] = np.where(rerole == best[row], after[:, NEXT], -1)
    arcs = arcs.reshape(5, -1)
    # Letters of a node's arcs differ, so audits of one letter already tell its arcs apart.
    letter = (arcs >= 0).argmax(0)
    pointer = np.where(letter > 0, np.take_along_axis(arcs, letter[None], 0)[0], nodes.ravel())
    rank, steps, pointers = letter.astype(np.int64), (letter > 0).astype(np.int64), [pointer]
    while (letter[pointer] > 0).any():
        rank = np.unique(rank * (rank.max() + 1) + rank[pointer], return_inverse=True)[1]
        steps = steps + steps[pointer]
        pointer = pointer[pointer]
        pointers.append(pointer)
    chosen = np.where(arcs >= 0, np.arange(5)[:, None] * (rank.max(initial=0) + 1) + rank[arcs], np.iinfo(np.int64).max)
    return Paths(np.where(letter > 0, chosen.argmin(0), 0), pointers, steps)


def _segments_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    column = batch.column("symbols")
    first = np.append(0, np.cumsum(np.diff(column.offsets.to_numpy())))
    return column.flatten().to_numpy().astype(np.int64), first


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Costs from each entry to each exit state, row by row, of segments with an open end."""
    for batch in batches:
        symbols, first = _segments_of(batch)
        base = first[:-1] + np.arange(len(first) - 1)
        exits = []
        for q in range(4):
            ends = np.full((len(base), 4), _FAR)
            ends[:, q] = 0
            exits.append(chain_costs(symbols, first, ends)[base])
        flat = np.minimum(np.stack(exits, 2), _FAR).reshape(len(base), 16)
        yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("block"), pa.array(list(flat), pa.list_(pa.int64()))], names=["conv", "block", "matrix"])


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each entry state of a segment: cost to the end, audit and exit state; and the pairs of neighbouring roles that cannot stand."""
    for batch in batches:
        if not (n := batch.num_rows):
            continue
        symbols, first = _segments_of(batch)
        ends = batch.column("ends").flatten().to_numpy().reshape(n, 4)
        closing = batch.column("closing").to_numpy(zero_copy_only=False)
        best = chain_costs(symbols, first, ends)
        paths = least_paths(symbols, first, best, closing)
        base = first[:-1] + np.arange(n)
        start = (4 * base[:, None] + np.arange(4)).ravel()
        audits = [a.decode() for a in paths.audits(start)]
        role = symbols & 3
        wrong = np.append(0, np.cumsum(np.append(False, KEEP[role[1:], role[:-1]] < 0) | (np.append(0, role[:-1]) == NOTHING)))
        inside = wrong[first[1:]] - wrong[np.minimum(first[:-1] + 1, first[1:])]
        before = batch.column("before").fill_null(-1).to_numpy()
        joint = (before >= 0) & ((KEEP[role[first[:-1]], np.maximum(before, 0)] < 0) | (before == NOTHING))
        made = [
            pa.array(list(best[base]), pa.list_(pa.int64())), pa.array([audits[i : i + 4] for i in range(0, 4 * n, 4)], pa.list_(pa.string())),
            pa.array(list((paths.ends(start) % 4).reshape(n, 4)), pa.list_(pa.int64())), pa.array(inside + joint, pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("block"), *made], names=["conv", "block", "costs", "audits", "exits", "illegal"])


def _product(a: Column, b: Column) -> Column:
    """Of two 4 x 4 matrices of costs: the cheapest way through both."""
    cell = lambda i: F.array_min(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda k: F.get(a, F.floor(i / 4).cast("int") * 4 + k) + F.get(b, k * 4 + i % 4)))
    return F.transform(F.sequence(F.lit(0), F.lit(15)), lambda i: F.least(cell(i), F.lit(_FAR)))


def _doubled(chains: DataFrame, value: str, longest: int, towards: int, combine, label: str) -> DataFrame:
    """(conv, block, value): the values of a chain from each block to its end (``towards`` 1) or its beginning (-1), combined by doubling self-joins."""
    reach = 1
    while reach < longest:
        other = chains.select(F.col("conv").alias("__conv"), (F.col("block") - towards * reach).alias("__block"), F.col(value).alias("__value"))
        met = chains.join(other, F.col("conv").eqNullSafe(F.col("__conv")) & (F.col("block") == F.col("__block")), "left")
        both = F.when(F.col("__value").isNull(), F.col(value)).otherwise(combine(F.col(value), F.col("__value")))
        chains = stage(met.select("conv", "block", both.alias(value)), label)
        reach *= 2
    return chains


def _beside(rows: DataFrame, other: DataFrame, shift: int) -> DataFrame:
    """``rows`` with the columns of the block ``shift`` further in the same conversation."""
    other = other.withColumnRenamed("conv", "__conv").withColumn("__block", F.col("block") - shift).drop("block")
    return rows.join(other, F.col("conv").eqNullSafe(F.col("__conv")) & (F.col("block") == F.col("__block")), "left").drop("__conv", "__block")


@dataclass(frozen=True)
class Repair:
    """``report``: a row per conversation. ``lines``: the repaired rows (conversation, place, role, text), a conversation's together and in order."""

    report: DataFrame
    lines: DataFrame


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repair:
    """Repair conversations whose rows are in order of turn (null first), then role, then a digest of role and text.

    A null role or text is read as one blank, rows of null conversation are one conversation. The report counts a row's first fault: blank, duplicate (role
    and text seen before in the conversation) or truncated; ``illegal`` pairs of neighbouring roles; ``gaps`` in the turns; and has the cost and the audit of the edits.
    Equal rows are duplicates of each other, in any order. Roles count by their first letter. Other columns are not read; an empty table gives
    empty results. Lines pass through one task a conversation, as a stream.
    """
    role_, text_ = F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(" ")), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(" "))
    source = rows.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("bigint").alias("turn"), role_.alias("role"), text_.alias("text"))
    source = source.withColumn("digest", F.unhex(F.sha2(F.concat_ws(":", F.octet_length("role").cast("string"), "role", "text"), 256)))
    bare = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    initial = F.substring("role", 1, 1)
    number = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(NOTHING)
    thin = source.select("conv", "turn", "role", "digest", number.alias("initial"), (bare == "").alias("blank"), (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut"))
    thin = thin.withColumn("row", F.monotonically_increasing_id())  # spreads equal rows
    placed = number_rows(thin, ["conv", "turn", "role", "digest", "row"], "number", start=0, label="turns")
    seen = placed.groupBy("conv", "digest").agg(F.min("number").alias("__number")).select("__number")
    marked = placed.join(seen, F.col("number") == F.col("__number"), "left").withColumn("again", F.col("__number").isNull() & ~F.col("blank"))
    marked = marked.withColumn("cut", F.col("cut") & ~F.col("blank") & ~F.col("again"))
    symbol = F.col("initial") + F.when(F.col("blank") | F.col("again"), 8).when(F.col("cut"), 4).otherwise(0)
    block = F.floor(F.col("number") / BLOCK)
    counted = [F.count_if(c).alias(name) for c, name in (("blank", "blank"), ("again", "duplicate"), ("cut", "truncated"))]
    segments = marked.groupBy("conv", block.alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("number", symbol.alias("symbol")))).alias("rows"), *counted, F.min_by(F.struct("turn", "role", "digest"), "number").alias("head")
    )
    segments = stage(segments.select("conv", "block", F.transform("rows", lambda x: x["symbol"].cast("tinyint")).alias("symbols"), "blank", "duplicate", "truncated", "head"), "segments")

    # Chains of several segments, at most one for every end of a block.
    chains = segments.groupBy("conv").agg(F.count("*").alias("n")).where("n > 1")
    chains = stage(chains.select(F.col("conv").alias("__conv"), "n"), "chains")
    parts = segments.join(chains, F.col("conv").eqNullSafe(F.col("__conv"))).select("conv", "block", "symbols", "n")
    parts = stage(parts, "chained")
    longest = parts.agg(F.max("n")).first()[0] or 0
    kind = rows.select(F.col(f"`{conv}`")).schema[0].dataType.simpleString()
    matrices = stage(parts.select("conv", "block", "symbols").mapInArrow(_matrices, f"conv {kind}, block long, matrix array<bigint>"), "matrices")
    behind = _doubled(matrices, "matrix", longest, 1, _product, "matrices")
    ending = F.array(*[F.lit(x).cast("bigint") for x in ENDING])
    vector = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda q: F.array_min(F.zip_with(F.slice("matrix", q * 4 + 1, 4), ending, lambda a, b: a + b)))
    ends = behind.select("conv", "block", vector.alias("ends"))
    lasts = parts.select("conv", "block", F.element_at("symbols", -1).cast("int").bitwiseAND(F.lit(3)).cast("bigint").alias("before"))
    around = _beside(_beside(parts.select("conv", "block"), ends, 1), lasts, -1)
    around = stage(around, "around").withColumn("__there", F.lit(True))

    whole = _beside(segments.select("conv", "block", "symbols"), around, 0)
    whole = whole.select("conv", "block", "symbols", F.coalesce("ends", ending).alias("ends"), F.col("ends").isNull().alias("closing"), "before")
    schema = f"conv {kind}, block long, costs array<bigint>, audits array<string>, exits array<bigint>, illegal long"
    paths = stage(whole.mapInArrow(_audits, schema), "audits")

    exits = _beside(parts.select("conv", "block"), paths.select("conv", "block", "exits"), 0)
    after = _doubled(stage(exits, "exits"), "exits", longest, -1, lambda late, early: F.transform(early, lambda q: F.get(late, q.cast("int"))), "exits")
    entries = _beside(parts.select("conv", "block"), after.select("conv", "block", F.get("exits", F.lit(0)).alias("entry")), -1)
    entries = stage(entries, "entries")
    pieces = _beside(_beside(segments.drop("symbols"), paths, 0), entries, 0)
    entry = F.coalesce("entry", F.lit(0)).cast("int")
    pieces = pieces.select("conv", "block", "blank", "duplicate", "truncated", "head", "illegal", F.get("costs", entry).alias("cost"), F.get("audits", entry).alias("audit"))
    pieces = stage(pieces, "pieces")

    turns = placed.groupBy("conv", "turn").agg(F.lit(1).alias("one")).groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count("turn")).alias("gaps"))
    faults = pieces.groupBy("conv").agg(
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")], F.min_by("cost", "block").alias("cost"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "audit"))), lambda x: x["audit"]), "").alias("audit"),
    )
    turns = turns.withColumnRenamed("conv", "__conv")
    report = faults.join(turns, F.col("conv").eqNullSafe(F.col("__conv")), "left").withColumn("gaps", F.coalesce("gaps", F.lit(0)).cast("bigint"))
    report = report.select(F.col("conv").alias(conv), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return Repair(report, _lines(source, pieces, kind, conv, role, text))


def _lines(source: DataFrame, pieces: DataFrame, kind: str, conv: str, role: str, text: str) -> DataFrame:
    """Texts meet the pieces of the audits in one sorted stream: a piece comes before the first of its rows, or before rows equal to that."""
    audits = pieces.select("conv", F.col("head.turn").alias("turn"), F.col("head.role").alias("role"), F.col("head.digest").alias("digest"), F.lit(0).alias("kind"), "block", F.col("audit").alias("text"))
    texts = source.select("conv", "turn", "role", "digest", F.lit(1).alias("kind"), F.lit(0).cast("bigint").alias("block"), "text")
    ordered = audits.unionByName(texts).repartition("conv").sortWithinPartitions("conv", "turn", "role", "digest", "kind", "block").select("conv", "role", "kind", "text")

    def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, current, state, place = ([], [], [], []), None, NOTHING, 0
        letters: deque[str] = deque()
        at = 0

        def put(role_: str, text_: str) -> None:
            nonlocal place
            for column, value in zip(made, (current[0], place, role_, text_)):
                column.append(value)
            place += 1

        def letter() -> str | None:
            nonlocal at
            while letters and at == len(letters[0]):
                letters.popleft()
                at = 0
            return letters[0][at] if letters else None

        def insertions() -> None:
            nonlocal at, state
            while letter() == "I":
                state = int(NEXT[state])
                put(ROLES[state], "")
                at += 1

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(made[0], key), pa.array(made[1], pa.int64()), pa.array(made[2], pa.string()), pa.array(made[3], pa.string())], names=names)
            for column in made:
                column.clear()
            return batch

        key = None
        for batch in batches:
            key = batch.schema.field("conv").type
            for c, r, is_text, t in zip(batch.column("conv").to_pylist(), batch.column("role").to_pylist(), batch.column("kind").to_pylist(), batch.column("text").to_pylist()):
                if current is None or current[0] != c:
                    if current is not None:
                        insertions()
                    current, state, place, at = (c,), NOTHING, 0, 0
                    letters.clear()
                if not is_text:
                    letters.append(t)
                    continue
                insertions()
                edit = letter()
                at += 1
                if edit == "K":
                    state = int(KEEP["sua".find(r[:1]) + 1 if r else 0, state])
                    put(r, t)
                elif edit == "R":
                    state = int(NEXT[state])
                    put(ROLES[state], t)
            if made[0]:
                yield out()
        if current is not None:
            insertions()
            if made[0]:
                yield out()

    names = [conv, "place", role, text]
    return ordered.mapInArrow(replay, f"`{conv}` {kind}, place long, `{role}` string, `{text}` string")


def line_digests(lines: DataFrame, conv: str = "conv_id", role: str = "role", text: str = "text") -> DataFrame:
    """SHA-256 of each conversation's ``role:text`` lines, joined by line feeds: (conv, repaired_sha256).

    Takes the lines of ``repair`` as they stand, a conversation's together and in order; a digest is one state that a stream of them updates.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state, key = None, None, None
        for batch in batches:
            key, found = batch.schema.field(0).type, ([], [])
            for c, r, t in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                if current is None or current[0] != c:
                    if current is not None:
                        found[0].append(current[0]), found[1].append(state.hexdigest())
                    current, state = (c,), hashlib.sha256()
                else:
                    state.update(b"\n")
                state.update(f"{r}:{t}".encode())
            if found[0]:
                yield pa.RecordBatch.from_arrays([pa.array(found[0], key), pa.array(found[1])], names=["conv", "repaired_sha256"])
        if current is not None:
            yield pa.RecordBatch.from_arrays([pa.array([current[0]], key), pa.array([state.hexdigest()])], names=["conv", "repaired_sha256"])

    kind = lines.schema[conv].dataType.simpleString()
    return lines.select(conv, role, text).mapInArrow(run, f"conv {kind}, repaired_sha256 string").withColumnRenamed("conv", conv)
