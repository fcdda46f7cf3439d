"""Best-fit packing of tokenized documents into sequences of fixed length, improved by a grouping genetic algorithm.

Pieces shorter than a sequence are dealt into problems of bounded size. Each problem is evolved on several islands: an
individual is a set of bins; crossover injects whole well-filled bins of one parent into the other, drops the bins that
hold a piece twice, and best-fits the pieces so displaced; mutation dissolves the emptiest bins. Between epochs the best
individual of an island moves to the next one. Bins that are nearly full then stay; the pieces of the others are dealt
into fewer problems for the next round, so what is lost at the edges of problems vanishes with the number of rounds. A problem ends
as soon as it needs no more bins than its tokens do.
"""

from __future__ import annotations

import string
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog_star.llm.texts import Texts, text_chunks
from catalog_star.llm.wordcache import WordCache, number_words
from catalog_star.staging import stage


class _Runs:
    """Runs of ids by number, in two arrays that grow."""

    def __init__(self):
        self._ids, self._ends, self._count = np.zeros(1 << 16, np.uint32), np.zeros(1 << 12, np.int64), 0

    def __len__(self) -> int:
        return self._count

    def add(self, ids: np.ndarray, lengths: np.ndarray) -> None:
        used = int(self._ends[self._count])
        self._ids = self._room(self._ids, used + len(ids))
        self._ids[used : used + len(ids)] = ids
        self._ends = self._room(self._ends, self._count + len(lengths) + 1)
        self._ends[self._count + 1 : self._count + 1 + len(lengths)] = used + np.cumsum(lengths)
        self._count += len(lengths)

    @staticmethod
    def _room(array: np.ndarray, size: int) -> np.ndarray:
        return array if size <= len(array) else np.concatenate([array, np.zeros(max(size - len(array), len(array) // 2), array.dtype)])

    def take(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of some runs one after the other, and the runs' lengths."""
        begin = self._ends[numbers]
        length = self._ends[numbers + 1] - begin
        total = np.append(0, np.cumsum(length))
        return self._ids[np.repeat(begin - total[:-1], length) + np.arange(total[-1])], length


class WordTokenizer:
    """Token ids of words under a tokenizer that never joins tokens across white space; each word is encoded once.

    A word of letters with punctuation behind it is made of two parts that the tokenizer splits anyway, and small letters give the
    same ids; so "The," needs nothing new once "the" and "," are known. New parts are encoded together, as one text: each is one
    pre-token, whose last token alone bears the mark of a word's end. Other words are encoded by themselves. ``most_words`` bounds what
    is kept between texts and has no influence on results.
    """

    def __init__(self, path: str, most_words: int):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        vocabulary = self._tokenizer.get_vocab()
        suffix = self._tokenizer.model.end_of_word_suffix
        self._closes = np.zeros(max(vocabulary.values()) + 1, bool)
        if suffix:
            self._closes[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
        self._most_parts = most_words // 4
        self._cache = WordCache(most_words)
        self._clear()

    def _clear(self) -> None:
        self._cache.clear()
        self._words = _Runs()
        self._clear_parts()

    def _clear_parts(self) -> None:
        self._number_of: dict[str, int] = {"": 0}
        self._parts = _Runs()
        self._parts.add(np.zeros(0, np.uint32), np.zeros(1, np.int64))

    def _learn(self, parts: list[str], odd: list[str]) -> None:
        """Encode new parts as one text, and other words one by one."""
        for i in range(0, len(parts), 20_000):
            some = parts[i : i + 20_000]
            ids = np.array(self._tokenizer.encode(" ".join(some), add_special_tokens=False).ids, np.uint32)
            ends = np.flatnonzero(self._closes[ids]) + 1
            if len(ends) == len(some):
                self._number_of.update(zip(some, range(len(self._parts), len(self._parts) + len(some))))
                self._parts.add(ids, np.diff(ends, prepend=0))
            else:  # a tokenizer without marks
                odd = odd + some
        for word, found in zip(odd, self._tokenizer.encode_batch(odd, add_special_tokens=False)):
            self._number_of[word] = len(self._parts)
            self._parts.add(np.array(found.ids, np.uint32), np.array([len(found.ids)]))

    def _encode(self, words: list[bytes]) -> np.ndarray:
        heads, tails, odd, punctuation = [], [], [], string.punctuation
        for data in words:
            word = data.decode("utf-8", "replace")
            letters = word.rstrip(punctuation)
            if letters.isalpha():
                small = letters.lower()
                # beyond ASCII, not every letter has a small form that reads alike wherever it stands
                if letters.isascii() or "\u03a3" not in letters and small.isalpha() and unicodedata.is_normalized("NFC", letters):
                    heads.append(small)
                    tails.append(word[len(letters) :])
                    continue
            heads.append(word)
            tails.append("")
            odd.append(word)
        if len(self._number_of) > self._most_parts:
            self._clear_parts()
        known = self._number_of.keys()
        odd = set(odd) - known
        self._learn(sorted((set(heads) | set(tails)) - odd - known), sorted(odd))
        number = np.empty((len(words), 2), np.int64)
        number[:, 0] = [self._number_of[x] for x in heads]
        number[:, 1] = [self._number_of[x] for x in tails]
        ids, length = self._parts.take(number.ravel())
        first = len(self._words)
        self._words.add(ids, length.reshape(-1, 2).sum(1))
        return np.arange(first, first + len(words))

    def ids(self, texts: Texts, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each closed by ``end_id``, and where each begins (one more at the end)."""
        if self._cache.full:
            self._clear()
        number = number_words(texts, self._cache, self._encode)
        _, _, first = texts.words()
        tokens, length = self._words.take(number)
        ends = np.append(0, np.cumsum(length))[first[1:]]
        return np.insert(tokens, ends, np.uint32(end_id)), np.append(0, ends + np.arange(1, len(texts) + 1))


_tokenizers: dict[tuple, WordTokenizer] = {}


def tokenized_pieces(
    docs: DataFrame, tokenizer: str, id: str, text: str, capacity: int, end_id: int, most_words: int = 2_000_000, with_ids: bool = False
) -> DataFrame:
    """A row per piece: id, piece, start, length, ids_crc32 (and ids, if asked for). Only documents above ``capacity`` are cut."""
    rows = docs.select(F.col(f"`{id}`").alias("__id"), F.col(f"`{text}`").cast("string").alias("__text"))
    kind = rows.schema[0].dataType.simpleString()
    names = ["__id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (tokenizer, most_words)
        if key not in _tokenizers:
            _tokenizers[key] = WordTokenizer(tokenizer, most_words)
        for batch in batches:
            row = 0
            for texts in text_chunks(batch.column(1)):
                tokens, begin = _tokenizers[key].ids(texts, end_id)
                size = np.diff(begin)
                pieces = -(-size // capacity)
                owner = np.repeat(np.arange(len(texts)), pieces)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(capacity, size[owner] - start)
                data, at = memoryview(tokens.astype("<u4")).cast("B"), (begin[owner] + start).tolist()
                spans = [data[4 * a : 4 * (a + n)] for a, n in zip(at, length.tolist())]
                columns = [
                    batch.column(0).slice(row, len(texts)).take(pa.array(owner)),
                    pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array([zlib.crc32(x) for x in spans], pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in spans], pa.list_(pa.int32())))
                row += len(texts)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"__id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    return rows.mapInArrow(run, schema)


class Bins:
    """Bins of one capacity with the room left in each, searchable for the tightest fit."""

    def __init__(self, length: list[int], capacity: int):
        self.length, self.capacity = length, capacity
        self.bins: list[list[int]] = []
        self.room: list[int] = []
        self._by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
        self._rooms = 0  # bit r: some bin has room r

    def open(self, items: list[int]) -> None:
        self.bins.append(items)
        room = self.capacity - sum(self.length[i] for i in items)
        self.room.append(room)
        self._file(len(self.bins) - 1, room)

    def _file(self, bin: int, room: int) -> None:
        self._by_room[room].append(bin)
        self._rooms |= 1 << room

    def fit(self, item: int) -> None:
        """Put an item where it leaves the least room, or open a bin."""
        n = self.length[item]
        rooms = self._rooms >> n
        if not rooms:
            self.open([item])
            return
        room = n + (rooms & -rooms).bit_length() - 1
        same = self._by_room[room]
        bin = same.pop()
        if not same:
            self._rooms &= ~(1 << room)
        self.bins[bin].append(item)
        self.room[bin] = room - n
        self._file(bin, room - n)


def fitness(bins: list[list[int]], length: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins are better; of as many, the more unequal filling. Smaller is better."""
    return len(bins), -sum((sum(length[i] for i in b) / capacity) ** 2 for b in bins)


def best_fit(order: list[int], length: list[int], capacity: int, bins: list[list[int]] = ()) -> list[list[int]]:
    packed = Bins(length, capacity)
    for b in bins:
        packed.open(list(b))
    for item in order:
        packed.fit(item)
    return packed.bins


def crossover(mother: list[list[int]], father: list[list[int]], length: list[int], capacity: int, rng: np.random.Generator) -> list[list[int]]:
    """The mother with some of the father's best-filled bins."""
    full = sorted(father, key=lambda b: -sum(length[i] for i in b))
    count = max(1, int(len(full) * rng.uniform(0.1, 0.5)))
    begin = int(rng.integers(0, max(1, len(full) // 2)))
    injected = full[begin : begin + count]
    taken = {i for b in injected for i in b}
    kept = [b for b in mother if taken.isdisjoint(b)]
    displaced = [i for b in mother if not taken.isdisjoint(b) for i in b if i not in taken]
    return best_fit(sorted(displaced, key=lambda i: -length[i]), length, capacity, [*injected, *kept])


def mutate(bins: list[list[int]], length: list[int], capacity: int, rng: np.random.Generator) -> list[list[int]]:
    """Dissolve the emptiest bins and some others, and fit their pieces in a new order."""
    order = sorted(range(len(bins)), key=lambda b: sum(length[i] for i in bins[b]))
    count = max(2, len(bins) // 20)
    gone = set(order[: count // 2 + 1]) | set(rng.choice(len(bins), min(len(bins), count), replace=False).tolist())
    loose = [i for b in gone for i in bins[b]]
    noise = rng.uniform(0.8, 1.25, len(loose))
    loose = [i for _, i in sorted(zip([-length[i] * x for i, x in zip(loose, noise)], loose))]
    return best_fit(loose, length, capacity, [b for k, b in enumerate(bins) if k not in gone])


def evolve(length: list[int], capacity: int, founders: list[list[list[int]]], seed: int, population: int, generations: int) -> list[list[int]]:
    """The best individual of one island's epoch. The first founder, if there is none, is best-fit decreasing."""
    least = -(-sum(length) // capacity)
    down = sorted(range(len(length)), key=lambda i: (-length[i], i))
    rated = lambda b: (fitness(b, length, capacity), b)
    people = [rated(b) for b in founders or [best_fit(down, length, capacity)]]
    by_fitness = lambda x: x[0]
    best = min(people, key=by_fitness)[1]
    if len(best) <= least:
        return best
    rng = np.random.Generator(np.random.PCG64(seed))
    while len(people) < population:
        noise = rng.uniform(0.9, 1.1, len(length))
        people.append(rated(best_fit(sorted(down, key=lambda i: -length[i] * noise[i]), length, capacity)))
    for _ in range(generations):
        ranked = sorted(people, key=by_fitness)
        if len(ranked[0][1]) <= least:
            break
        parents = ranked[: max(2, population // 2)]
        children = []
        for _ in range(population - len(parents)):
            a, b = rng.choice(len(parents), 2, replace=False)
            child = crossover(parents[a][1], parents[b][1], length, capacity, rng)
            children.append(rated(mutate(child, length, capacity, rng) if rng.random() < 0.5 else child))
        people = parents + children
    return min(people, key=by_fitness)[1]


_ITEMS = "items array<struct<length: bigint, uid: bigint>>"


def _lists(column: pa.Array) -> list[list[int] | None]:
    """Whole numbers of a list column, list by list."""
    values, at = column.flatten().to_pylist(), np.append(0, np.cumsum(pa.compute.fill_null(pa.compute.list_value_length(column), 0).to_numpy())).tolist()
    return [values[a:b] if ok else None for a, b, ok in zip(at[:-1], at[1:], column.is_valid().to_pylist())]


def _lengths(items: pa.Array) -> list[list[int]]:
    at = items.offsets.to_numpy() - items.offsets[0].as_py()
    values = items.flatten().field("length").to_pylist()
    return [values[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def _solved(batch: pa.RecordBatch, keep: list[str], solutions: list[tuple[list[list[int]], list[int]]], capacity: int) -> pa.RecordBatch:
    """The kept columns with each problem's bins: elite (the bin of every item), bins, least (how many the lengths need) and cost."""
    elites, counts, least, costs = [], [], [], []
    for bins, length in solutions:
        elite = [0] * len(length)
        for k, b in enumerate(bins):
            for i in b:
                elite[i] = k
        count, cost = fitness(bins, length, capacity)
        elites.append(elite), counts.append(count), least.append(-(-sum(length) // capacity)), costs.append(cost)
    made = [pa.array(elites, pa.list_(pa.int32())), pa.array(counts, pa.int64()), pa.array(least, pa.int64()), pa.array(costs, pa.float64())]
    return pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *made], names=[*keep, "elite", "bins", "least", "cost"])


def _founded(problems: DataFrame, capacity: int) -> DataFrame:
    """Best-fit decreasing, once a problem: (problem, items) with elite, bins, least and cost."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = _lengths(batch.column("items"))
            solutions = [(best_fit(sorted(range(len(n)), key=lambda i: (-n[i], i)), n, capacity), n) for n in lengths]
            yield _solved(batch, ["problem", "items"], solutions, capacity)

    return problems.mapInArrow(run, f"problem long, {_ITEMS}, elite array<int>, bins long, least long, cost double")


def _evolved(islands: DataFrame, capacity: int, population: int, generations: int, epoch: int) -> DataFrame:
    """One epoch on every island: (problem, island, items, elite, guest) to the same with a new elite, its bins and its fitness."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = _lengths(batch.column("items"))
            founders = [[_bins(x) for x in pair if x is not None] for pair in zip(_lists(batch.column("elite")), _lists(batch.column("guest")))]
            names = zip(batch.column("problem").to_pylist(), batch.column("island").to_pylist())
            seeds = [zlib.crc32(f"{problem}|{island}|{epoch}".encode()) for problem, island in names]
            solutions = [(evolve(n, capacity, f, seed, population, generations), n) for n, f, seed in zip(lengths, founders, seeds)]
            yield _solved(batch, ["problem", "island", "items"], solutions, capacity)

    return islands.mapInArrow(run, f"problem long, island int, {_ITEMS}, elite array<int>, bins long, least long, cost double")


def _bins(elite: list[int]) -> list[list[int]]:
    bins: dict[int, list[int]] = {}
    for item, bin in enumerate(elite):
        bins.setdefault(bin, []).append(item)
    return list(bins.values())


def genetic_packing(
    items: DataFrame, capacity: int, problem_size: int = 2048, islands: int = 3, epochs: int = 2, population: int = 6, generations: int = 6, full_share: float = 0.995, most_rounds: int = 6
) -> DataFrame:
    """Bins for (uid, length): uid, sequence_id, offset. Lengths are 1 to ``capacity``; uids are unique."""
    done: DataFrame | None = None
    for round_ in range(most_rounds):
        count = items.count()
        problems = max(1, -(-count // problem_size))
        last = problems == 1 or round_ == most_rounds - 1
        problem = F.pmod(F.xxhash64("uid", F.lit(round_)), F.lit(problems))
        grouped = items.groupBy(problem.alias("problem")).agg(F.sort_array(F.collect_list(F.struct("length", "uid")), asc=False).alias("items"))
        founded = stage(_founded(grouped.repartition(min(4096, -(-problems // 4)), "problem"), capacity), "founded")
        best = founded.where("bins <= least").select("problem", F.struct("items", "elite").alias("x"))
        open_ = founded.where("bins > least")
        if unsolved := open_.select("problem").count():  # only what best-fit decreasing leaves open is evolved
            spread = min(4096, unsolved * islands)
            state = open_.select("problem", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), "items", "elite", F.lit(None).cast("array<int>").alias("guest"))
            state = state.repartition(spread, "problem", "island")
            for epoch in range(epochs):
                state = stage(_evolved(state, capacity, population, generations, epoch * most_rounds + round_), "islands")
                if epoch < epochs - 1:  # the elite of the island before comes over
                    ring = Window.partitionBy("problem").orderBy("island")
                    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
                    state = state.withColumn("guest", F.coalesce(F.lag("elite").over(ring), F.last("elite").over(whole))).repartition(spread, "problem", "island")
            best = best.unionByName(state.groupBy("problem").agg(F.min_by(F.struct("items", "elite"), F.struct("bins", "cost", "island")).alias("x")))
        flat = best.select("problem", F.explode(F.arrays_zip(F.col("x.items").alias("item"), F.col("x.elite").alias("bin"))).alias("p"))
        flat = flat.select("problem", F.col("p.bin").alias("bin"), F.col("p.item.uid").alias("uid"), F.col("p.item.length").alias("length"))
        inside = Window.partitionBy("problem", "bin")
        before = inside.orderBy(F.desc("length"), "uid").rowsBetween(Window.unboundedPreceding, -1)
        packed = flat.select(
            "uid", "length",
            ((F.lit(round_).cast("long") * (1 << 54)) + F.col("problem") * (1 << 16) + F.col("bin")).alias("sequence_id"),
            F.coalesce(F.sum("length").over(before), F.lit(0)).alias("offset"),
            F.sum("length").over(inside).alias("__fill"),
        )
        packed = stage(packed, "packed")
        kept = packed if last else packed.where(F.col("__fill") >= full_share * capacity)
        kept = kept.select("uid", "sequence_id", "offset")
        done = kept if done is None else done.unionByName(kept)
        if last:
            return done
        items = packed.where(F.col("__fill") < full_share * capacity).select("uid", "length")


def pack_documents(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", capacity: int = 4096, end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """A row per piece of every document: id, piece, start, length, ids_crc32, sequence_id, offset (and ids, if asked for).

    A null text is empty: its document is the end id alone. Only documents above ``capacity`` are cut; a piece of full
    length is a sequence by itself. Repeated rows and null ids are packed like any others. Other columns are not read; an empty
    table gives an empty result.
    """
    pieces = tokenized_pieces(docs, tokenizer, id, text, capacity, end_id, with_ids=with_ids)
    pieces = stage(pieces.withColumn("__uid", F.monotonically_increasing_id()), "pieces")
    small = pieces.where(F.col("length") < capacity)
    placed = genetic_packing(small.select(F.col("__uid").alias("uid"), "length"), capacity)
    found = small.join(placed, small["__uid"] == placed["uid"]).drop("uid")
    alone = pieces.where(F.col("length") == capacity).withColumn("sequence_id", -1 - F.col("__uid")).withColumn("offset", F.lit(0).cast("long"))
    return found.unionByName(alone).drop("__uid").withColumnRenamed("__id", id)
