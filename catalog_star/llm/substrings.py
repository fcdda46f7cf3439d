"""Passages that repeat across documents, exactly or nearly: seeds, collinear chains, alignment.

Seeds are the minimizers of word k-mers: the least hash of every window of neighbouring k-mers, so two texts that share
``window + k - 1`` words in a row share a seed. The documents that have a seed are put in order, and each occurrence is matched to the document before: that makes
as many matches as occurrences, however common a passage is. Occurrences in one stretch of the input are matched where they are read, and only the
first document of a stretch goes on, so a common seed sends one document a stretch over the network. A match by itself counts if another, whoever its partner, is
near. The matches of two documents are chained in order of both by a tree of maxima over gap-adjusted scores. It is a segment tree rather than a Fenwick tree, as
matches out of reach must leave it. Chains are aligned word by word between their seeds and beyond their ends; only the blocks of text that a chain touches are brought together for that.

A seed's holder need not be the document that shares the passage around it. Exact passages are therefore found by themselves: every
run of ``least_words`` words that another document has is matched to a document that has the whole of it.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_star.llm.texts import WORD_PATTERN, Texts, map_texts, mixed, text_chunks, windows
from catalog_star.staging import stage, stage_path, stage_scope


def minimizers(hashes: np.ndarray, owner_first: np.ndarray, window: int) -> np.ndarray:
    """Places of the items that are least in some window of their text; a text shorter than a window is one."""
    n, texts = len(hashes), len(owner_first) - 1
    count = np.diff(owner_first)
    pad = window - 1
    place = np.arange(n) + np.repeat(np.arange(texts) * pad, count)
    padded = np.full(n + texts * pad + pad, np.iinfo(np.uint64).max, np.uint64)
    padded[place] = hashes
    least = _sliding(padded, window, np.minimum)
    valid = np.zeros(len(padded) + 1, np.int32)
    first = owner_first[:-1] + np.arange(texts) * pad
    some = count > 0
    valid[first[some]] += 1
    valid[(first + np.maximum(count - pad, 1))[some]] -= 1
    least = np.where(np.cumsum(valid[:-1]) > 0, least, np.uint64(0))
    most = _sliding(least[::-1], window, np.maximum)[::-1]
    return np.flatnonzero(most[place] == hashes)


def _sliding(values: np.ndarray, window: int, best: np.ufunc) -> np.ndarray:
    """best of values[i : i + window], fewer at the end."""
    out, reach = values.copy(), 1
    while reach < window:
        step = min(reach, window - reach)
        after = out.copy()
        after[:-step] = best(out[:-step], out[step:])
        out, reach = after, reach + step
    return out


def seeds_of(texts: Texts, k: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text and word of every seed."""
    _, _, first = texts.words()
    hashes, place = windows(texts.word_hashes(), first, k)
    of_text = np.searchsorted(place, first)
    picked = minimizers(hashes, of_text, window)
    owner = np.searchsorted(first, place[picked], "right") - 1
    return hashes[picked], owner, place[picked] - first[owner]


def chain(x: np.ndarray, y: np.ndarray, k: int, gap_cost: float, most_gap: int) -> list[np.ndarray]:
    """Chains of matches (x, y) that rise in both; indexes of each, in order. Matches come sorted by x, y.

    A match adds ``k``; a step costs ``gap_cost`` for every word of either text between. A tree of maxima over the ranks of y holds
    the greatest score plus the cost of getting there, so a step's cost is a difference. Only matches of the last ``most_gap`` words of x
    are in the tree, and ranks within ``most_gap`` of y are asked, so a far match never hides a near one.
    """
    n = len(x)
    if n == 1:
        return [np.zeros(1, np.int64)]
    if (np.diff(x) > 0).all() and (np.diff(y) > 0).all():
        # each match best follows the one before: a way past it costs as much and scores less
        scores, begins = [float(k)], [0]
        for i, (dx, dy) in enumerate(zip(np.diff(x).tolist(), np.diff(y).tolist()), 1):
            gain = scores[-1] - gap_cost * (dx + dy) if max(dx, dy) <= most_gap else 0.0
            if gain <= 0:
                begins.append(i)
            scores.append(k + max(gain, 0.0))
        chains = []
        for begin, end in zip(begins, [*begins[1:], n]):
            while begin < end:  # the best end takes all before it
                best = begin + int(np.argmax(scores[begin:end]))
                chains.append(np.arange(begin, best + 1))
                begin = best + 1
        return chains
    different, ranks = np.unique(y, return_inverse=True)
    lowest = np.searchsorted(different, y - most_gap).tolist()
    size = len(different)
    top = [(-1.0, -1)] * (2 * size)  # value and item; the leaf of rank r is at size + r
    live = [deque() for _ in range(size)]  # matches of a rank within reach, values falling
    score, back = [0.0] * n, [-1] * n
    xs, ys, rs = x.tolist(), y.tolist(), ranks.tolist()

    def renew(r: int) -> None:
        node = size + r
        top[node] = live[r][0] if live[r] else (-1.0, -1)
        while node > 1:
            node >>= 1
            top[node] = max(top[2 * node], top[2 * node + 1])

    i = left = 0
    while i < n:
        while xs[left] < xs[i] - most_gap:  # out of reach from here on
            own = live[rs[left]]
            if own and own[0][1] == left:
                own.popleft()
                renew(rs[left])
            left += 1
        same = i
        while same < n and xs[same] == xs[i]:  # equal x: none may follow another
            best, low, high = (-1.0, -1), size + lowest[same], size + rs[same]
            while low < high:
                if low & 1:
                    best = max(best, top[low])
                    low += 1
                if high & 1:
                    high -= 1
                    best = max(best, top[high])
                low, high = low >> 1, high >> 1
            gain = best[0] - gap_cost * (xs[same] + ys[same])
            if best[1] >= 0 and gain > 0:
                score[same], back[same] = gain + k, best[1]
            else:
                score[same] = float(k)
            same += 1
        for j in range(i, same):
            value, own = score[j] + gap_cost * (xs[j] + ys[j]), live[rs[j]]
            while own and own[-1][0] <= value:
                own.pop()
            own.append((value, j))
            renew(rs[j])
        i = same
    used = [False] * n
    chains = []
    for end in sorted(range(n), key=lambda j: (-score[j], j)):
        if used[end]:
            continue
        own, j = [], end
        while j >= 0 and not used[j]:
            used[j] = True
            own.append(j)
            j = back[j]
        chains.append(np.array(own[::-1]))
    return chains


def matched_words(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence of two short runs of words."""
    if not len(a) or not len(b):
        return 0
    if len(a) == len(b) and (a == b).all():
        return len(a)
    row = np.zeros(len(b) + 1, np.int64)
    equal = a[:, None] == b[None, :]
    for i in range(len(a)):
        best = np.where(equal[i], row[:-1] + 1, row[1:])
        row[1:] = np.maximum.accumulate(np.maximum(best, row[1:]))
    return int(row[-1])


def extend(a: np.ndarray, b: np.ndarray, drop: int = 6) -> tuple[int, int]:
    """How far two runs agree from their begin, word against word: +1 for equal, -2 for other words, until the score
    is ``drop`` below its best. Returns the length and the equal words in it."""
    n = min(len(a), len(b))
    if not n:
        return 0, 0
    same = a[:n] == b[:n]
    if same.all():
        return n, n
    score = np.cumsum(np.where(same, 1, -2))
    best = np.maximum.accumulate(np.maximum(score, 0))
    stop = np.flatnonzero(score < best - drop)
    upto = int(stop[0]) if len(stop) else n
    if upto == 0 or score[:upto].max(initial=0) <= 0:
        return 0, 0
    end = int(np.argmax(score[:upto])) + 1
    return end, int(same[:end].sum())


def align(a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray, k: int, similarity: float) -> list[tuple[int, int, int, int, int]]:
    """Aligned pieces of two runs of words along a chain of seeds at x and y: from and to in each, and equal words.

    A gap between seeds in which less than half of the words agree parts the chain. Pieces below the similarity are left out.
    """
    pieces, x, y = [], x.tolist(), y.tolist()

    def close(piece: list[int], until_a: int, until_b: int) -> None:
        a0, a1, b0, b1, equal = piece
        more, hit = extend(a[a1:until_a], b[b1:until_b])
        a1, b1, equal = a1 + more, b1 + more, equal + hit
        pieces.append((a0, a1, b0, b1, equal))

    piece = None
    for i, (p, q) in enumerate(zip(x, y)):
        if piece is None:
            back, hit = extend(a[: p][::-1], b[: q][::-1])
            piece = [p - back, p + k, q - back, q + k, k + hit]
            continue
        a1, b1 = piece[1], piece[3]
        over = min(p - a1, q - b1)
        if over < 0:  # the seed overlaps the last one; on another diagonal it would count words twice
            if p - a1 == q - b1:
                piece = [piece[0], p + k, piece[2], q + k, piece[4] + p + k - a1]
            continue
        equal = matched_words(a[a1:p], b[b1:q])
        if max(p - a1, q - b1) > 8 and 2 * equal < max(p - a1, q - b1):
            close(piece, p, q)
            back, hit = extend(a[a1:p][::-1], b[b1:q][::-1])
            piece = [p - back, p + k, q - back, q + k, k + hit]
        else:
            piece = [piece[0], p + k, piece[2], q + k, piece[4] + equal + k]
    close(piece, len(a), len(b))
    return [p for p in pieces if p[4] >= similarity * max(p[1] - p[0], p[3] - p[2])]


def linked(rows: DataFrame, items, stretch: int = 2_000_000, keep: bool = False) -> DataFrame:
    """Match every item of a text to the same item of the document before: (key, holder, word, other_word).

    ``rows`` has key and text first. ``items`` gives, for some texts and their batch of rows, hash, text and place of each item. Documents that have an item are
    ordered by key; a place in one of them is matched to the first place in the one before. Documents are first matched within stretches of about so many items. Items are made twice, or else
    staged, with ``keep``.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            row, keys = 0, batch.column(0).to_numpy()
            for texts in text_chunks(batch.column(1)):
                hashes, owner, place = items(texts, batch.slice(row, len(texts)))
                held.append((hashes.view(np.int64), keys[row : row + len(texts)][owner], place.astype(np.int32)))
                row, count = row + len(texts), count + len(hashes)
                if count >= stretch:
                    yield from matched(held)
                    held, count = [], 0
        if held:
            yield from matched(held)

    def matched(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        seed, key, word = _in_order(*(np.concatenate([h[i] for h in held]) for i in range(3)))
        before = _document_before(seed, key)
        nothing = np.full(len(seed), -1)
        first = before < 0
        for some, holder in ((first, nothing), (~first, before)):
            at = np.flatnonzero(some)
            other = holder[at]
            none = pa.nulls(len(at), pa.int64()) if some is first else pa.array(key[other])
            yield pa.RecordBatch.from_arrays(
                [pa.array(seed[at]), pa.array(key[at]), pa.array(word[at]), none, pa.nulls(len(at), pa.int32()) if some is first else pa.array(word[other])], names=["seed", "key", "word", "holder", "other_word"]
            )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, ["seed"]):
            seed, key, word = (c.to_numpy() for c in table.columns)
            several = _repeated(seed)
            seed, key, word = _in_order(seed[several], key[several], word[several])
            before = _document_before(seed, key)
            at = np.flatnonzero(before >= 0)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (key[at], key[before[at]], word[at], word[before[at]])], names=["key", "holder", "word", "other_word"])

    found = rows.mapInArrow(read, "seed long, key long, word int, holder long, other_word int")
    if keep:
        found = _settled(found, "items")
    firsts = found.where("holder is null").select("seed", "key", "word")
    parts = max(1, 2 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    across = firsts.repartition(parts, "seed").sortWithinPartitions("seed").mapInArrow(meet, "key long, holder long, word int, other_word int")
    return found.where("holder is not null").select("key", "holder", "word", "other_word").unionByName(across)


def _in_order(seed: np.ndarray, key: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Items by seed, document and place, each once."""
    order = np.arange(len(seed)) if (seed[1:] >= seed[:-1]).all() else np.argsort(seed, kind="stable")
    seed, key, word = seed[order], key[order], word[order]
    several = np.flatnonzero(_repeated(seed))  # few: only these need be put in order
    inner = several[np.lexsort((word[several], key[several], seed[several]))]
    key[several], word[several] = key[inner], word[inner]
    new = np.ones(len(seed), bool)
    new[1:] = (seed[1:] != seed[:-1]) | (key[1:] != key[:-1]) | (word[1:] != word[:-1])
    return seed[new], key[new], word[new]


def _repeated(seed: np.ndarray) -> np.ndarray:
    """Which of some sorted numbers occur more than once."""
    same = seed[1:] == seed[:-1]
    return np.append(False, same) | np.append(same, False) if len(seed) else np.zeros(0, bool)


def _document_before(seed: np.ndarray, key: np.ndarray) -> np.ndarray:
    """For each item in order, the first place of the same item in the document before; -1 in the first document."""
    if not len(seed):
        return np.zeros(0, np.int64)
    same = np.append(False, seed[1:] == seed[:-1])
    begins = np.flatnonzero(~(same & np.append(False, key[1:] == key[:-1])))  # of a document's items of one seed
    which = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(seed))))
    found = np.where(same[begins], np.append(0, begins[:-1]), -1)
    return found[which]


def exact_runs(rows: DataFrame, least_words: int) -> DataFrame:
    """Pieces of ``least_words`` equal words or more of a text that one of smaller key has too, over (key, text).

    A run of ``least_words`` words contains the least hash of its half-length windows, which is the same in every document; so
    runs are hashed whole only about half-length windows that several documents have, and text that does not repeat makes few rows.
    """
    half = -(-least_words // 2)
    rest = least_words - half
    rows = rows.select("key", "text")

    def hashed(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        _, _, first = texts.words()
        hashes, place = windows(texts.word_hashes(), first, half)
        return hashes, place, first

    def halves(texts: Texts, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        hashes, place, first = hashed(texts)
        picked = minimizers(hashes, np.searchsorted(place, first), rest + 1)
        owner = np.searchsorted(first, place[picked], "right") - 1
        return hashes[picked], owner, place[picked] - first[owner]

    shared = _settled(linked(rows, halves, keep=True), "shared_halves")
    marks = shared.select("key", "word").unionByName(shared.select(F.col("holder").alias("key"), F.col("other_word").alias("word")))
    marks = marks.groupBy("key").agg(F.sort_array(F.collect_set("word")).alias("marks"))
    marked = rows.join(stage(marks, "marks"), "key").select("key", "text", "marks")

    def whole(texts: Texts, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        hashes, place, first = hashed(texts)
        at = np.full(len(hashes) and int(place[-1]) + 1, -1)
        at[place] = np.arange(len(place))
        some = batch.column(2)
        marks = some.flatten().to_numpy() + np.repeat(first[:-1], np.diff(some.offsets.to_numpy()))
        # runs of which a mark is one of the half-length windows
        wanted = np.zeros(len(at) + 1, np.int64)
        np.add.at(wanted, np.maximum(marks - rest, 0), 1)
        np.add.at(wanted, marks + 1, -1)
        begin = np.flatnonzero(np.cumsum(wanted[:-1]) > 0)
        begin = begin[begin + rest < len(at)]
        owner = np.searchsorted(first, begin, "right") - 1
        ok = (begin + least_words <= first[owner + 1]) & (at[begin] >= 0)
        begin, owner = begin[ok], owner[ok]
        with np.errstate(over="ignore"):
            value = mixed(hashes[at[begin]] * np.uint64(0x9E3779B97F4A7C15) + hashes[at[begin + rest]])
        return value, owner, begin - first[owner]

    met = linked(marked, whole)
    parts = max(1, 2 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, ["key"]):
            key, holder, word, other = (c.to_numpy() for c in table.columns)
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (holder[1:] != holder[:-1]) | (np.diff(word) > 1) | (np.diff(other) != np.diff(word))
            a = np.flatnonzero(new)
            b = np.append(a[1:], len(key)) - 1
            columns = [key[a], holder[a], word[a].astype(np.int64), word[b].astype(np.int64) + least_words, other[a].astype(np.int64), other[b].astype(np.int64) + least_words, np.ones(len(a))]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "holder", "piece_start", "piece_end", "other_start", "other_end", "similarity"])

    return met.repartition(parts, "key").sortWithinPartitions("key", "holder", "word", "other_word").mapInArrow(
        merge, "key long, holder long, piece_start long, piece_end long, other_start long, other_end long, similarity double"
    )


def repeated_passages(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    least_words: int = 50,
    similarity: float = 0.8,
    k: int = 5,
    window: int = 16,
    most_gap: int = 48,
    gap_cost: float = 0.1,
    join_gap: int = 4,
    block: int = 128,
    margin: int = 64,
) -> DataFrame:
    """Passages of at least ``least_words`` words of a document that an earlier one holds too, a row per aligned piece.

    Returns id, key, start_word, end_word (the passage), piece_start, piece_end, other_id, other_start, other_end, similarity.
    Words count from 0, ends are exclusive. Documents are ordered by key, a hash of id and text: rows equal in
    both are one document; ids may repeat or be null. The first holder of a passage is never reported for it, so cutting all reported passages
    leaves one copy. Pieces that touch up to ``join_gap`` words apart form a passage, whichever documents they were found in. Null, empty and
    short texts have no passage; other columns are not read; an empty table gives an empty result.
    """
    rows = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text")).where("text is not null")
    rows = rows.withColumn("key", F.xxhash64("id", "text"))

    target = stage_path(docs.sparkSession, "passages")
    with stage_scope(docs.sparkSession) as own:
        exact = _settled(exact_runs(rows, least_words), "exact_pieces")
        near = _near_pieces(rows, exact, similarity, k, window, most_gap, gap_cost, block, margin)
        passages = _passages(near.unionByName(exact), least_words, join_gap, target)
        own.drop()  # what only the passages were made of
    names = rows.select("key", "id").distinct()
    found = passages.join(names, "key").join(names.select(F.col("key").alias("holder"), F.col("id").alias("other_id")), "holder")
    return found.select(F.col("id").alias(id), "key", "start_word", "end_word", "piece_start", "piece_end", "other_id", "other_start", "other_end", "similarity")


def _settled(df: DataFrame, label: str) -> DataFrame:
    """``df``, staged. The shuffles behind it are garbage then; Spark deletes their files once the driver's JVM has collected what refers to them."""
    staged = stage(df, label)
    df.sparkSession.sparkContext._jvm.System.gc()
    return staged


def _covered(key: np.ndarray, start: np.ndarray, end: np.ndarray, at_key: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Which places ``at`` to ``at + size`` of texts lie within one of the pieces, which are sorted by text and start."""
    group = np.unique(np.concatenate([key, at_key]), return_inverse=True)[1].astype(np.int64) << 32
    own, asked = group[: len(key)], group[len(key) :] + at
    if not len(key):
        return np.zeros(len(at), bool)
    last = np.searchsorted(own + start, asked, "right") - 1
    return (last >= 0) & (np.maximum.accumulate(own + end)[np.maximum(last, 0)] >= asked + size)


def _near_pieces(rows: DataFrame, exact: DataFrame, similarity: float, k: int, window: int, most_gap: int, gap_cost: float, block: int, margin: int) -> DataFrame:
    """Aligned pieces of chained seeds: (key, holder, piece_start, piece_end, other_start, other_end, similarity).

    Seeds within a piece that is known to be ``exact`` would find it once more and are left out.
    """
    links = linked(rows.select("key", "text"), lambda texts, batch: seeds_of(texts, k, window)).withColumn("kind", F.lit(1))
    whole = exact.select("key", F.lit(0).cast("long").alias("holder"), F.col("piece_start").cast("int").alias("word"), F.col("piece_end").cast("int").alias("other_word"), F.lit(0).alias("kind"))
    parts = max(1, 2 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    chains_schema = "key long, holder long, words array<int>, other_words array<int>"

    def find_chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, ["key"]):
            key, holder, word, other, kind = (c.to_numpy() for c in table.select(["key", "holder", "word", "other_word", "kind"]).columns)
            known, seeds = kind == 0, kind == 1
            order = np.lexsort((word[known], key[known]))
            seeds[seeds] = ~_covered(key[known][order], word[known][order], other[known][order], key[seeds], word[seeds], k)
            key, holder, word, other = key[seeds], holder[seeds], word[seeds], other[seeds]
            if not len(key):
                continue
            cuts = np.append(np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (holder[1:] != holder[:-1]))), len(key))
            order = np.lexsort((word, key))
            near = (key[order][1:] == key[order][:-1]) & (np.diff(word[order]) <= 2 * window)
            supported = np.zeros(len(key), bool)
            supported[order] = np.append(near, False) | np.append(False, near)
            found = []
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if b - a == 1 and not supported[a]:
                    continue
                x, y = word[a:b], other[a:b]
                found += [(int(key[a]), int(holder[a]), x[c], y[c]) for c in chain(x, y, k, gap_cost, most_gap) if len(c) > 1 or supported[a + c[0]]]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())))], names=["key", "holder", "words", "other_words"])

    dealt = links.unionByName(whole).repartition(parts, "key").sortWithinPartitions("key", "holder", "word", "other_word")
    chains = _settled(dealt.mapInArrow(find_chains, chains_schema), "chains").withColumn("chain", F.xxhash64("key", "holder", "words", "other_words"))

    # the blocks of words that chains touch, on either side
    def sides(key: str, words: str, side: int) -> DataFrame:
        low = F.greatest(F.element_at(words, 1) - margin, F.lit(0))
        high = F.element_at(words, -1) + k + margin
        wanted = chains.select("chain", F.col(key).alias("key"), F.lit(side).alias("side"), low.alias("low"), high.alias("high"))
        return wanted.withColumn("block", F.explode(F.sequence(F.expr(f"low div {block}"), F.expr(f"(high - 1) div {block}"))))

    def cut_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, keys = 0, batch.column(0).to_numpy()
            for texts in text_chunks(batch.column(1)):
                _, _, first = texts.words()
                data = texts.word_hashes().astype("<u4").tobytes()
                n = -(-np.diff(first) // block)
                owner = np.repeat(np.arange(len(texts)), n)
                number = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
                begin = first[owner] + number * block
                end = np.minimum(begin + block, first[owner + 1])
                pieces = [data[4 * a : 4 * b] for a, b in zip(begin.tolist(), end.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(keys[row : row + len(texts)][owner]), pa.array(number), pa.array(pieces, pa.binary())], names=["key", "block", "data"])
                row += len(texts)

    blocks = rows.select("key", "text").mapInArrow(cut_blocks, "key long, block long, data binary")
    wanted = sides("key", "words", 0).unionByName(sides("holder", "other_words", 1))
    brought = wanted.join(blocks, ["key", "block"]).select("chain", "side", "block", "low", "high", "data")
    whole = chains.select("chain", F.lit(-1).alias("side"), F.lit(0).cast("long").alias("block"), F.lit(0).alias("low"), F.lit(0).alias("high"), F.lit(None).cast("binary").alias("data"), "key", "holder", "words", "other_words")
    both = whole.unionByName(brought, allowMissingColumns=True)

    def find_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, ["chain"]):
            found, runs, head = [], [[], []], None
            names = table.column_names
            columns = {name: table.column(name) for name in names}
            ids, side_of, block_of = (columns[n].to_numpy() for n in ("chain", "side", "block"))
            for i in range(table.num_rows):
                if side_of[i] < 0:
                    if head is not None and ids[head] == ids[i]:
                        continue  # equal rows of documents made equal chains
                    head, runs = i, [{}, {}]
                else:
                    runs[side_of[i]][int(block_of[i])] = (columns["low"][i].as_py(), columns["high"][i].as_py(), columns["data"][i].as_py())
                if i + 1 == table.num_rows or ids[i + 1] != ids[i]:
                    if head is None or not runs[0] or not runs[1]:
                        continue
                    (a, a0), (b, b0) = (_assembled(r, block) for r in runs)
                    x, y = (np.array(columns[n][head].as_py()) for n in ("words", "other_words"))
                    for p0, p1, q0, q1, equal in align(a, b, x - a0, y - b0, k, similarity):
                        found.append((columns["key"][head].as_py(), columns["holder"][head].as_py(), p0 + a0, p1 + a0, q0 + b0, q1 + b0, equal / max(p1 - p0, q1 - q0)))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*found)], names=["key", "holder", "piece_start", "piece_end", "other_start", "other_end", "similarity"])

    return both.repartition(parts, "chain").sortWithinPartitions("chain", "side", "block").mapInArrow(
        find_pieces, "key long, holder long, piece_start long, piece_end long, other_start long, other_end long, similarity double"
    )


def _passages(pieces: DataFrame, least_words: int, join_gap: int, target: str) -> DataFrame:
    """Pieces that make up passages of ``least_words``, with these, staged."""

    def find_passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, ["key"]):
            key, start, end = (table.column(n).to_numpy() for n in ("key", "piece_start", "piece_end"))
            reach = np.zeros(len(key), np.int64)
            begins = np.zeros(len(key), bool)
            for i in range(len(key)):
                if i == 0 or key[i] != key[i - 1] or start[i] > reach[i - 1] + join_gap:
                    begins[i], reach[i] = True, end[i]
                else:
                    reach[i] = max(reach[i - 1], end[i])
            group = np.cumsum(begins) - 1
            first = start[begins]
            last = np.maximum.reduceat(end, np.flatnonzero(begins)) if len(key) else end
            ok = (last - first >= least_words)[group]
            marked = table.append_column("start_word", pa.array(first[group])).append_column("end_word", pa.array(last[group])).filter(pa.array(ok))
            yield from marked.select([*table.column_names, "start_word", "end_word"]).to_batches()

    kinds = "key long, holder long, piece_start long, piece_end long, other_start long, other_end long, similarity double, start_word long, end_word long"
    order = ["key", "piece_start", "piece_end", "holder", "other_start", "other_end", "similarity"]
    parts = max(1, 2 * int(pieces.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return stage(pieces.repartition(parts, "key").sortWithinPartitions(*order).mapInArrow(find_passages, kinds), "passages", target)


def _assembled(blocks: dict[int, tuple], block: int) -> tuple[np.ndarray, int]:
    """The wanted words of some neighbouring blocks, and the place of the first."""
    low, high, _ = next(iter(blocks.values()))
    numbers = sorted(blocks)
    words = np.frombuffer(b"".join(blocks[n][2] for n in numbers), "<u4")
    begin = numbers[0] * block
    return words[max(0, low - begin) : high - begin], max(low, begin)


def _whole_groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[pa.Table]:
    """Batches of sorted rows regrouped so that rows equal in ``by`` come together."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        same = np.ones(table.num_rows, bool)
        for name in by:
            values = table.column(name).to_numpy()
            same &= values == values[-1] if len(values) else same
        cut = int(np.flatnonzero(~same)[-1]) + 1 if (~same).any() else 0
        if cut:
            yield table.slice(0, cut).combine_chunks()
        rest = table.slice(cut)
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks()


def without_passages(docs: DataFrame, passages: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with reported passages cut out of their texts; a document of which nothing is left goes.

    A text without passages stays as it is, null included.
    """
    key = F.xxhash64(f"`{id}`", F.col(f"`{text}`").cast("string"))
    spans = passages.groupBy(F.col("key").alias("__passage_key")).agg(F.collect_set(F.struct("start_word", "end_word")).alias("__spans"))
    marked = docs.withColumn("__key", key).join(spans, F.col("__key") == F.col("__passage_key"), "left")
    words = F.regexp_extract_all(F.col(f"`{text}`").cast("string"), F.lit(WORD_PATTERN + r"[\x20\x09-\x0D]*"), F.lit(0))
    kept = F.filter(words, lambda w, i: ~F.exists("__spans", lambda s: (i >= s["start_word"]) & (i < s["end_word"])))
    cut = marked.withColumn(text, F.when(F.col("__spans").isNull(), F.col(f"`{text}`")).otherwise(F.concat_ws("", kept)))
    return cut.where(f"__spans is null or length(`{text}`) > 0").drop("__key", "__spans", "__passage_key")
