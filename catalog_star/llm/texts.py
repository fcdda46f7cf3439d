"""Whole texts as arrays: word bounds and hashes of a batch of texts, computed with numpy inside tasks.

A word is a longest run of bytes other than blank, tab, line feed, vertical tab, form feed and
carriage return. All of these are ASCII, so bytes of a UTF-8 text can be judged one by one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The white space that separates words.
WHITE_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
#: The same as a pattern for Spark and DuckDB.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

#: Bytes of text handled at once; a longer text is handled by itself.
CHUNK_BYTES = 2 << 20

_IS_WORD = np.ones(256, bool)
_IS_WORD[list(WHITE_SPACE)] = False
_BYTE_VALUES = np.random.Generator(np.random.PCG64(20)).integers(1, 2**63, 256, dtype=np.uint64) * 2 + 1
_FACTOR = 0x9E3779B97F4A7C15
_INVERSE = pow(_FACTOR, -1, 2**64)
_powers: dict[str, np.ndarray] = {}


def _geometric(factor: int, n: int) -> np.ndarray:
    """factor**0 .. factor**(n-1) modulo 2**64; kept, as every chunk needs the same ones."""
    found = _powers.get(str(factor))
    if found is None or len(found) < n:
        with np.errstate(over="ignore"):
            step = np.full(n, factor, np.uint64)
            step[0] = 1
            found = np.multiply.accumulate(step)
        if n <= 2 * CHUNK_BYTES:
            _powers[str(factor)] = found
    return found[:n]


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    with np.errstate(over="ignore"):
        values = values ^ (values >> np.uint64(30))
        values = values * np.uint64(0xBF58476D1CE4E5B9)
        values ^= values >> np.uint64(27)
        values = values * np.uint64(0x94D049BB133111EB)
        values ^= values >> np.uint64(31)
    return values


class Texts:
    """Some whole texts in one buffer: text i is ``data[offsets[i]:offsets[i + 1]]``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = data
        self.offsets = offsets
        self._prefix: np.ndarray | None = None
        self._words: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None

    def __len__(self) -> int:
        return len(self.offsets) - 1

    @classmethod
    def of(cls, texts: list[str | None]) -> Texts:
        return next(text_chunks(pa.array(texts, pa.string()), limit=1 << 62))

    def bytes(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()

    def sums(self, per_byte: np.ndarray) -> np.ndarray:
        """Sum of a value per byte over each text."""
        total = np.zeros(len(self.data) + 1, np.int64)
        np.cumsum(per_byte, out=total[1:])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start and end of each word in the buffer, and the first word of each text (one more at the end)."""
        if self._words is None:
            inside = _IS_WORD[self.data]
            opens, closes = inside.copy(), inside.copy()
            if len(inside):
                opens[1:] &= ~inside[:-1]
                closes[:-1] &= ~inside[1:]
                begins = self.offsets[:-1][self.offsets[:-1] < self.offsets[1:]]
                ends = self.offsets[1:][self.offsets[:-1] < self.offsets[1:]] - 1
                opens[begins] |= inside[begins]
                closes[ends] |= inside[ends]
            starts, stops = np.flatnonzero(opens), np.flatnonzero(closes) + 1
            self._words = starts, stops, np.searchsorted(starts, self.offsets)
        return self._words

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each ``data[start:end]``; equal bytes have equal hashes in every batch."""
        with np.errstate(over="ignore"):
            if self._prefix is None:
                self._prefix = np.zeros(len(self.data) + 1, np.uint64)
                np.cumsum(_BYTE_VALUES[self.data] * _geometric(_FACTOR, max(1, len(self.data)))[: len(self.data)], out=self._prefix[1:])
            value = self._prefix[ends] - self._prefix[starts]
            value *= _geometric(_INVERSE, len(self.data) + 1)[starts]
            return mixed(value + (ends - starts).astype(np.uint64) * np.uint64(_FACTOR))

    def word_hashes(self) -> np.ndarray:
        starts, ends, _ = self.words()
        return self.hashes(starts, ends)

    def owner(self, first: np.ndarray) -> np.ndarray:
        """The text of each item, given the first item of each text."""
        return np.repeat(np.arange(len(self)), np.diff(first))


def windows(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` neighbouring items of one text, and the place of each window's first item."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        value = np.zeros(n, np.uint64)
        for i in range(size):
            value = value * np.uint64(_FACTOR) + hashes[i : n + i]
    last = np.repeat(first[1:], np.diff(first))[:n]
    place = np.flatnonzero(np.arange(n) + size <= last)
    return mixed(value[place]), place


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Texts]:
    """Cut a column into runs of whole texts of about ``limit`` bytes; a null counts as an empty text."""
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield Texts(data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row])
        row = end


def map_texts(
    docs: DataFrame, text: str, keep: dict[str, str], fields: dict[str, str], compute: Callable[[Texts], dict]
) -> DataFrame:
    """Columns computed from whole texts, in one pass without a shuffle.

    ``keep`` renames columns that are passed through (new name: old name); no other column is
    read, so those of clashing names do no harm. ``fields`` gives name and type of the columns that
    ``compute`` returns for some texts. A null text is an empty one.
    """
    if clash := set(keep) & set(fields):
        raise ValueError(f"columns {sorted(clash)} would appear twice")
    kept_columns = [F.col(f"`{old}`").alias(new) for new, old in keep.items()]
    where = list(keep.values()).index(text) if text in keep.values() else len(keep)  # a text that is kept crosses once
    rows = docs.select(*kept_columns, *([] if where < len(keep) else [F.col(f"`{text}`").cast("string").alias("__text")]))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields[: len(keep)]}
    schema = ", ".join(f"`{name}` {kind}" for name, kind in {**kinds, **fields}.items())
    names = list(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = 0
            for texts in text_chunks(batch.column(where)):
                made = compute(texts)
                kept = batch.slice(row, len(texts))
                row += len(texts)
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns[: len(keep)], *[made[x] if isinstance(made[x], pa.Array) else pa.array(made[x]) for x in names]],
                    names=[*keep, *names],
                )

    return rows.mapInArrow(run, schema)
