"""Quality rules: word statistics and compression bands.

A text is refused if too short or too repetitive by its words. Of the rest, zstandard
ratios decide: compressed bytes over bytes, of the whole text and of fixed chunks. A ratio
below its band means repetition, one above it means text that no language compresses to.
Short texts compress badly for want of context, so the band depends on length.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame

from catalog_star.llm.texts import Texts, map_texts, windows

#: The symbols that are counted.
SYMBOLS = b"#*$%&|<>"
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True


@dataclass(frozen=True)
class Bands:
    """Allowed ratios by length. Each band: least bytes, lowest and highest ratio.

    A text is refused if its own ratio leaves its band, or if more than ``bad_share`` of
    its bytes lie in chunks whose ratio leaves theirs. The last chunk takes the rest if that is
    shorter than half a chunk.

    The limits stand outside what running text of each length compresses to at level 3 (from 256 bytes on 0.53 to 0.78, from
    1 KB on 0.45 to 0.6, from 4 KB on 0.36 to 0.5): a text below repeats itself, one above is encoded or random. Texts of few words have room downwards. Below 64
    bytes ratios tell nothing.
    """

    bands: tuple[tuple[int, float, float], ...] = (
        (0, 0.0, 9.0),
        (64, 0.45, 1.15),
        (256, 0.40, 0.88),
        (512, 0.36, 0.75),
        (1024, 0.30, 0.68),
        (2048, 0.25, 0.62),
        (4096, 0.20, 0.58),
        (32768, 0.17, 0.54),
    )
    chunk_bytes: int = 2048
    bad_share: float = 0.34
    level: int = 3

    def outside(self, size: int, packed: int) -> bool:
        low, high = next((low, high) for least, low, high in reversed(self.bands) if size >= least)
        return not low * size <= packed <= high * size


def word_statistics(texts: Texts) -> dict[str, np.ndarray]:
    """Counts per text: words, their code points, symbols, repeated lines, words in repeated five-word windows."""
    starts, ends, first = texts.words()
    n_words = np.diff(first)
    inside = np.zeros(len(texts.data) + 1, np.int8)
    inside[starts] += 1
    inside[ends] -= 1
    inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
    chars = texts.sums(inside & ((texts.data & 0xC0) != 0x80))
    symbols = texts.sums(_IS_SYMBOL[texts.data])

    feeds = np.flatnonzero(texts.data == 0x0A)
    line_start = np.sort(np.concatenate([texts.offsets[:-1], feeds + 1]), kind="stable")
    line_end = np.sort(np.concatenate([texts.offsets[1:], feeds]), kind="stable")
    first_line = np.arange(len(texts) + 1) + np.searchsorted(feeds, texts.offsets)
    full = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    line_owner = texts.owner(first_line)
    _, later = _repeats(texts.hashes(line_start[full], line_end[full]), line_owner[full])
    dup_lines = np.bincount(line_owner[full][later], minlength=len(texts))

    window, place = windows(texts.hashes(starts, ends), first, 5)
    owner = texts.owner(first)
    every, _ = _repeats(window, owner[place])
    edge = np.zeros(len(starts) + 1, np.int64)
    np.add.at(edge, place[every], 1)
    np.add.at(edge, place[every] + 5, -1)
    repeated = np.bincount(owner[np.cumsum(edge[:-1]) > 0], minlength=len(texts))
    return {"n_words": n_words, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup_lines, "n_repeat_words": repeated}


def _repeats(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all items that occur twice or more within their owner, and of those that are not the first."""
    order = np.lexsort((hashes, owner))
    same = (hashes[order][1:] == hashes[order][:-1]) & (owner[order][1:] == owner[order][:-1])
    later = np.append(False, same) if len(order) else np.zeros(0, bool)
    every = later | (np.append(same, False) if len(order) else later)
    return order[every], order[later]


def compression_verdict(text: bytes, bands: Bands, packer: zstandard.ZstdCompressor) -> tuple[float, float, bool]:
    """Ratio of the whole text, share of its bytes in chunks outside their band, and whether both may pass."""
    size = len(text)
    if not size:
        return 0.0, 0.0, True
    packed = len(packer.compress(text))
    bad, at = 0, 0
    while at < size and size > bands.chunk_bytes:
        end = at + bands.chunk_bytes
        end = size if size - end < bands.chunk_bytes // 2 else end
        if bands.outside(end - at, len(packer.compress(text[at:end]))):
            bad += end - at
        at = end
    return packed / size, bad / size, not bands.outside(size, packed) and bad <= bands.bad_share * size


def quality_rules(docs: DataFrame, id: str = "doc_id", text: str = "text", bands: Bands = Bands()) -> DataFrame:
    """Word statistics and verdict of every text, in one pass without a shuffle.

    Returns id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ratio, bad_share,
    base_failed and kept. A null or empty text has no words, hence fails; every row of a repeated or null id is
    judged by itself; other columns are not read; an empty table gives an empty result.
    """
    packers: dict[int, zstandard.ZstdCompressor] = {}

    def compute(texts: Texts) -> dict:
        if bands.level not in packers:
            packers[bands.level] = zstandard.ZstdCompressor(level=bands.level, write_content_size=False, write_checksum=False)
        made = word_statistics(texts)
        failed = (made["n_words"] < 10) | (100 * made["n_repeat_words"] > 20 * made["n_words"])
        found = [compression_verdict(texts.bytes(i), bands, packers[bands.level]) for i in range(len(texts))]
        ratio, bad, passed = (np.array([x[k] for x in found]) for k in range(3))
        return made | {"ratio": ratio, "bad_share": bad, "base_failed": failed, "kept": passed & ~failed}

    fields = {x: "long" for x in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
    fields |= {"ratio": "double", "bad_share": "double", "base_failed": "boolean", "kept": "boolean"}
    return map_texts(docs, text, {id: id}, fields, compute)
