"""Toxicity by compression distance: a zstandard dictionary trained on toxic text, another on ordinary text, window by window.

Both dictionaries are made by zstandard's trainer from pieces of labelled texts. The ordinary one is trained on windows of ordinary texts. The
toxic one is trained on the surroundings of runs of bytes that are denser in toxic texts by ``least_ratio`` and met in ``least_support`` different
surroundings, so that copies of a text teach nothing; of what the trainer keeps, bytes outside such runs are blanked, as ordinary texts hold them too. The
toxic dictionary goes before the ordinary one and is compared with blanks before it: a window's distance is its compressed length without the toxic dictionary less that with it.
Matches count in it, literals hardly do: the fast strategy leaves literals as they are. A window begins with a run of bytes that both dictionaries
hold, for zstandard would store a window raw that it can hardly shorten. A logistic curve over a text's largest and mean distance and the share of
windows that differ, fitted to labelled texts that the dictionaries have not seen, is the calibrated threshold.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalog_star.llm.sampling import smallest_hashes
from catalog_star.llm.texts import Texts, map_texts

#: Bytes of a run: what the fast strategy can match at least.
RUN = 5
_ANCHOR = bytes(range(128, 208))
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_MARGIN = 8  # bytes on either side that tell surroundings apart


def plain(text: str) -> bytes:
    """The whole text in lower case with one blank between words, and one at either end."""
    return f" {' '.join(text.lower().split())} ".encode("utf-8", "replace")


def word_windows(text: str, size: int) -> list[bytes]:
    """The whole text in lower case, cut at blanks into windows of at most ``size`` bytes; each begins and ends with a blank."""
    data = plain(text)
    found, at = [], 0
    while at < len(data) - 1:
        end = min(len(data), at + size)
        blank = data.rfind(b" ", at + size // 2, end) if end < len(data) else -1
        end = blank + 1 if blank > 0 else end
        found.append(data[at:end])
        at = blank if blank > 0 else end
    return found


def runs_of(data: np.ndarray) -> np.ndarray:
    """Every run of RUN bytes as a number; runs over a byte 0 are 0."""
    n = max(0, len(data) - RUN + 1)
    value, whole = np.zeros(n, np.uint64), np.ones(n, bool)
    for i in range(RUN):
        value <<= np.uint64(8)
        value |= data[i : i + n]
        whole &= data[i : i + n] != 0
    value[~whole] = 0
    return value


def surroundings(texts: list[str], parts: int = 8) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """The texts in one buffer, and the runs of bytes and their places in it, each run once for every different surroundings; in parts by run, to save memory."""
    gap = bytes(_MARGIN + RUN)
    buffer = gap + gap.join(plain(t) for t in texts) + gap
    data = np.frombuffer(buffer, np.uint8)
    every = runs_of(data)
    for part in range(parts):
        place = np.flatnonzero((every > 0) & (every % np.uint64(parts) == part))
        around = np.zeros(len(place), np.uint64)
        with np.errstate(over="ignore"):
            for i in [*range(-_MARGIN, 0), *range(RUN, RUN + _MARGIN)]:
                around = around * _FACTOR + data[place + i] + np.uint64(1)
        order = np.lexsort((around, every[place]))
        run, around, place = every[place][order], around[order], place[order]
        new = np.ones(len(run), bool)
        new[1:] = (run[1:] != run[:-1]) | (around[1:] != around[:-1])
        yield buffer, run[new], place[new]


def _counted(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Runs, rising, and in how many different surroundings each is met."""
    parts = [np.unique(run, return_counts=True) for _, run, _ in surroundings(texts)]
    run, count = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    order = np.argsort(run)
    return run[order], count[order]


def marking_runs(toxic: list[str], ordinary: list[str], least_ratio: float, least_support: int) -> dict[int, float]:
    """Runs that are denser in toxic texts, with their weights: surroundings times the logarithm of the ratio of densities."""
    (run, count), (other, times) = _counted(toxic), _counted(ordinary)
    if not len(run) or not len(other):
        return {}
    at = np.minimum(np.searchsorted(other, run), len(other) - 1)
    ratio = (count / count.sum()) / ((np.where(other[at] == run, times[at], 0) + 0.5) / times.sum())
    ok = (ratio >= least_ratio) & (count >= least_support)
    return dict(zip(run[ok].tolist(), (count[ok] * np.log(ratio[ok])).tolist()))


def trained(samples: list[bytes], size: int, segment: int, unit: int) -> bytes:
    """The content of a dictionary that zstandard's trainer makes of the samples; of too few for it, the last ones as they are."""
    samples = [s for s in samples if len(s) >= 8]
    try:
        return zstandard.train_dictionary(size, samples, k=segment, d=unit).as_bytes()[-size:]
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def toxic_dictionary(toxic: list[str], ordinary: list[str], size: int, least_ratio: float, least_support: int) -> bytes:
    marks = marking_runs(toxic, ordinary, least_ratio, least_support)
    if not marks:
        return b""
    known, samples = np.fromiter(marks, np.uint64), set()
    for buffer, run, place in surroundings(toxic):
        chosen = np.isin(run, known)
        samples |= {(marks[r], r, buffer[p - 4 : p + RUN + 10].strip(b"\0")) for r, p in zip(run[chosen].tolist(), place[chosen].tolist())}
    # The trainer picks the best segments of consecutive stretches, so pieces about one run lie together; the heaviest come last, nearest to the window.
    samples = sorted(samples)
    content = trained([s for _, _, s in samples], size, segment=16, unit=6)
    data = np.frombuffer(content, np.uint8)
    hit = np.isin(runs_of(data), known)
    inside = np.zeros(len(data), bool)
    for i in range(RUN):
        inside[i : i + len(hit)] |= hit
    return re.sub(rb"\0+", b"\0", np.where(inside, data, 0).astype(np.uint8).tobytes())


@dataclass(frozen=True)
class ToxicityModel:
    """Two dictionaries and a logistic curve. A model without a curve gives every text the score 0."""

    toxic: bytes
    ordinary: bytes
    weights: tuple[float, ...]
    window_bytes: int

    def packers(self) -> list[zstandard.ZstdCompressor]:
        settings = zstandard.ZstdCompressionParameters(
            strategy=zstandard.STRATEGY_FAST, min_match=RUN, target_length=1, hash_log=15, window_log=17, write_content_size=False, write_checksum=False, write_dict_id=False
        )
        contents = (_ANCHOR + bytes(len(self.toxic)) + self.ordinary, _ANCHOR + self.toxic + self.ordinary)
        return [zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(x, dict_type=zstandard.DICT_TYPE_RAWCONTENT), compression_params=settings) for x in contents]

    def features(self, text: str, packers: list[zstandard.ZstdCompressor]) -> tuple[float, float, float]:
        """Largest and mean distance of a text's windows, and the share of windows nearer to the toxic dictionary."""
        ordinary, toxic = packers
        windows = word_windows(text, self.window_bytes)
        if not windows:
            return 0.0, 0.0, 0.0
        distance = [len(ordinary.compress(_ANCHOR + x)) - len(toxic.compress(_ANCHOR + x)) for x in windows]
        return float(max(distance)), sum(distance) / len(distance), sum(x > 1 for x in distance) / len(distance)

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_design(features) @ np.array(self.weights), -30, 30)))


def _design(features: np.ndarray) -> np.ndarray:
    return np.c_[np.ones(len(features)), np.clip(features[:, 0], -10, 12) / 5, np.clip(features[:, 1], -3, 10) / 3, features[:, 2]]


def fit(
    texts: list[tuple[str, int]], size: int = 8192, common: int = 4096, window_bytes: int = 192, least_ratio: float = 10.0, least_support: int = 8, held_share: int = 4, toxic_weight: float = 2.0
) -> ToxicityModel:
    """A model of labelled texts (text, 1 if toxic); one of ``held_share`` texts of each class makes the curve, the others the dictionaries.

    Where the curve lies, an error on a toxic text counts ``toxic_weight`` times. Null texts are none; without texts of both classes on either side there is no curve. The same texts in the same order give the same model.
    """
    classes = [[t for t, label in texts if label == k and t is not None] for k in (0, 1)]
    seen, held = ([[t for i, t in enumerate(own) if (i % held_share == 0) == last] for own in classes] for last in (False, True))
    if not all(map(len, (*seen, *held))):
        return ToxicityModel(b"", b"", (), window_bytes)
    ordinary, toxic = seen
    windows = list(dict.fromkeys(w for t in ordinary[::3] for w in word_windows(t, window_bytes)))
    model = ToxicityModel(toxic_dictionary(toxic, ordinary, size, least_ratio, least_support), trained(windows, common, segment=64, unit=8), (), window_bytes)
    packers = model.packers()
    design = _design(np.array([model.features(t, packers) for own in held for t in own]))
    label = np.repeat([0.0, 1.0], [len(own) for own in held])
    counted = np.where(label > 0, toxic_weight, 1.0)
    weights = np.zeros(design.shape[1])
    ridge = np.diag([0.0] + [0.05] * (len(weights) - 1))
    for _ in range(60):  # Newton's method; the ridge keeps it convergent
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        bend = (design * (counted * p * (1 - p))[:, None]).T @ design + ridge + 1e-6 * np.eye(len(weights))
        step = np.linalg.solve(bend, design.T @ (counted * (p - label)) + ridge @ weights)
        weights -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return ToxicityModel(model.toxic, model.ordinary, tuple(weights.tolist()), window_bytes)


def draw_labelled(
    docs: DataFrame, labels: DataFrame, id: str, text: str, label: str, most_toxic: int, most_ordinary: int, most_chars: int = 16_384
) -> list[tuple[str, int]]:
    """At most so many labelled texts of either class, those whose ids have the smallest hashes; one text an id.

    Of a text of more than ``most_chars`` characters, 32 pieces spread evenly over the whole of it are
    taken. An id with several labels takes the largest, with several texts the least. The ids drawn are the only thing that is broadcast.
    """
    thin = labels.select(F.col(f"`{id}`").alias("__id"), F.col(f"`{label}`").cast("int").alias("__label")).where("__id is not null and __label in (0, 1)")
    thin = thin.groupBy("__id").agg(F.max("__label").alias("__label"))
    drawn = smallest_hashes(thin.where("__label = 1"), ["__id"], most_toxic).union(smallest_hashes(thin.where("__label = 0"), ["__id"], most_ordinary))
    size = F.length("__text")
    pieces = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.substring("__text", F.floor(i * size / 32).cast("int") + 1, F.lit(most_chars // 32))), " ")
    texts = docs.select(F.col(f"`{id}`").alias("__id"), F.col(f"`{text}`").cast("string").alias("__text")).where("__text is not null")
    met = texts.join(F.broadcast(drawn), "__id").select("__id", "__label", F.when(size > most_chars, pieces).otherwise(F.col("__text")).alias("text"))
    rows = met.groupBy("__id", "__label").agg(F.min("text").alias("text")).collect()
    return [(r["text"], r["__label"]) for r in sorted(rows, key=lambda r: (r["__label"], zlib.crc32(str(r["__id"]).encode()), r["text"]))]


def score_texts(docs: DataFrame, model: ToxicityModel, keep: dict[str, str], text: str = "text") -> DataFrame:
    """``keep`` columns and score of every whole text, in one pass without a shuffle.

    A null or blank text is scored like any other: it has no window, hence distance 0. Repeated rows and
    null ids are scored by themselves; columns outside ``keep`` are not read; an empty table gives an empty result.
    """
    packers: list = []

    def compute(texts: Texts) -> dict:
        if not model.weights:
            return {"score": np.zeros(len(texts))}
        if not packers:
            packers.extend(model.packers())
        found = np.array([model.features(texts.bytes(i).decode("utf-8", "replace"), packers) for i in range(len(texts))])
        return {"score": model.score(found)}

    return map_texts(docs, text, keep, {"score": "double"}, compute)
