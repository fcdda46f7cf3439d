"""Language identification by a convolutional network over bytes.

A window of fixed length becomes a row of byte vectors; filters of several widths run over it, the maximum of
each filter over the window goes through softmax. The network is trained in numpy, by Adam, on windows
of labelled texts. A text's windows cover all of it; their log probabilities are averaged, weighted by
how many bytes each holds.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalog_star.llm.sampling import hash_below
from catalog_star.llm.texts import Texts, map_texts

#: The language of a text that is null or has no letter.
UNDETERMINED = "und"
#: Capital letters A to Z are read as small ones.
_FOLDED = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


@dataclass
class ByteNetwork:
    """Byte vectors, filters by width (width x vector, filters) and the output layer. Byte 0 pads, its vector is zero."""

    languages: list[str]
    window: int
    vectors: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray
    widths: tuple[int, ...] = field(default=(2, 3, 4))

    @classmethod
    def start(cls, languages: list[str], window: int, size: int, filters: int, widths: tuple[int, ...], seed: int) -> ByteNetwork:
        rng = np.random.Generator(np.random.PCG64(seed))
        draw = lambda *shape, scale: (rng.standard_normal(shape) * scale).astype(np.float32)
        vectors = draw(256, size, scale=0.5)
        vectors[0] = 0
        return cls(
            languages, window, vectors,
            [draw(w * size, filters, scale=(w * size) ** -0.5) for w in widths], [np.zeros(filters, np.float32) for _ in widths],
            draw(filters * len(widths), len(languages), scale=0.1), np.zeros(len(languages), np.float32), widths,
        )

    def parameters(self) -> list[np.ndarray]:
        return [self.vectors, *self.filters, *self.biases, self.out, self.out_bias]

    def _slides(self, rows: np.ndarray, width: int) -> np.ndarray:
        """All runs of ``width`` byte vectors, side by side."""
        n, length, size = rows.shape
        step = rows.strides
        view = np.lib.stride_tricks.as_strided(rows, (n, length - width + 1, width * size), (step[0], step[1], step[2]))
        return view.reshape(-1, width * size)

    def forward(self, windows: np.ndarray):
        """Log probabilities, and what training needs: byte vectors, pooled values and where they were found."""
        rows = np.ascontiguousarray(self.vectors[windows])
        pooled, where = [], []
        for width, filters, bias in zip(self.widths, self.filters, self.biases):
            value = (self._slides(rows, width) @ filters).reshape(len(windows), -1, filters.shape[1])
            at = value.argmax(1)
            where.append(at)
            pooled.append(np.maximum(np.take_along_axis(value, at[:, None], 1)[:, 0] + bias, 0))
        pool = np.concatenate(pooled, 1)
        logits = pool @ self.out + self.out_bias
        logits = logits - logits.max(1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(1, keepdims=True)), rows, pool, where

    def log_probabilities(self, windows: np.ndarray, batch: int = 128) -> np.ndarray:
        """Of many windows, in batches of one size."""
        found = np.zeros((len(windows), len(self.languages)), np.float32)
        for i in range(0, len(windows), batch):
            rows = self.vectors[windows[i : i + batch]]
            pooled = []
            for width, filters, bias in zip(self.widths, self.filters, self.biases):
                value = (self._slides(rows, width) @ filters).reshape(len(rows), -1, filters.shape[1])
                pooled.append(np.maximum(value.max(1) + bias, 0))
            logits = np.concatenate(pooled, 1) @ self.out + self.out_bias
            logits -= logits.max(1, keepdims=True)
            found[i : i + batch] = logits - np.log(np.exp(logits).sum(1, keepdims=True))
        return found

    def gradients(self, windows: np.ndarray, target: np.ndarray) -> list[np.ndarray]:
        log_p, rows, pool, where = self.forward(windows)
        n, size = len(windows), self.vectors.shape[1]
        delta = np.exp(log_p)
        delta[np.arange(n), target] -= 1
        delta /= n
        by_pool = (delta @ self.out.T) * (pool > 0)
        d_filters, d_biases, d_rows, at = [], [], np.zeros_like(rows), 0
        for width, filters, places in zip(self.widths, self.filters, where):
            d = by_pool[:, at : at + filters.shape[1]]
            at += filters.shape[1]
            spot = places[:, None, :] + np.arange(width)[None, :, None]  # text, offset, filter
            text = np.arange(n)[:, None, None]
            seen = rows[text, spot]  # text, offset, filter, vector
            d_filters.append(np.einsum("tofv,tf->ovf", seen, d).reshape(filters.shape))
            d_biases.append(d.sum(0))
            np.add.at(d_rows, (text, spot), np.einsum("tf,ovf->tofv", d, filters.reshape(width, size, -1)))
        d_vectors = np.zeros_like(self.vectors)
        np.add.at(d_vectors, windows.ravel(), d_rows.reshape(-1, size))
        d_vectors[0] = 0
        return [d_vectors, *d_filters, *d_biases, pool.T @ delta, delta.sum(0)]

    def train(self, windows: np.ndarray, target: np.ndarray, epochs: int, batch: int, rate: float, seed: int) -> None:
        """Adam, with windows dealt anew each epoch; the same input gives the same network."""
        rng = np.random.Generator(np.random.PCG64(seed))
        first, second = ([np.zeros_like(p) for p in self.parameters()] for _ in range(2))
        step = 0
        for epoch in range(epochs):
            order = rng.permutation(len(windows))
            for i in range(0, len(order), batch):
                pick = order[i : i + batch]
                step += 1
                pace = rate * (1 - epoch / epochs) * (1 - 0.999**step) ** 0.5 / (1 - 0.9**step)
                for p, g, a, b in zip(self.parameters(), self.gradients(windows[pick], target[pick]), first, second):
                    a += 0.1 * (g - a)
                    b += 0.001 * (g * g - b)
                    p -= (pace * a / (np.sqrt(b) + 1e-8)).astype(np.float32)


def cut_windows(texts: Texts, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows that cover all bytes of the texts, the bytes each holds, and each text's first window (one more at the end)."""
    length = np.diff(texts.offsets)
    first = np.append(0, np.cumsum(-(-length // size)))
    owner = np.repeat(np.arange(len(texts)), np.diff(first))
    begin = texts.offsets[owner] + (np.arange(first[-1]) - first[owner]) * size
    held = np.minimum(size, texts.offsets[owner + 1] - begin)
    place = begin[:, None] + np.arange(size)
    inside = np.arange(size) < held[:, None]
    data = _FOLDED[np.append(texts.data, np.uint8(0))]
    return np.where(inside, data[np.minimum(place, len(texts.data))], 0), held, first


def fit(
    texts: list[tuple[str, str]],
    window: int = 128,
    windows_per_text: int = 4,
    size: int = 8,
    filters: int = 24,
    widths: tuple[int, ...] = (2, 3, 4),
    epochs: int = 12,
    seed: int = 4,
) -> ByteNetwork | None:
    """A network for the languages of (text, language) pairs; None if there are none. Of long texts, evenly spread windows are learnt."""
    languages = sorted({x for _, x in texts})
    if not languages:
        return None
    rows, target = [], []
    for text, language in texts:
        found, held, _ = cut_windows(Texts.of([text]), window)
        pick = np.unique(np.linspace(0, len(found) - 1, min(len(found), windows_per_text)).round().astype(int)) if len(found) else []
        for i in pick:
            if held[i] >= 4:
                rows.append(found[i])
                target.append(languages.index(language))
                if held[i] > 48:  # short texts are judged as well
                    rows.append(np.where(np.arange(window) < 24, np.roll(found[i], -(len(rows) % 24)), 0).astype(np.uint8))
                    target.append(target[-1])
    network = ByteNetwork.start(languages, window, size, filters, widths, seed)
    if rows:
        network.train(np.array(rows), np.array(target), epochs, 64, 0.006, seed)
    return network


def draw_labelled(docs: DataFrame, id: str, text: str, language: str, rows_per_language: int, most_chars: int = 2048) -> list[tuple[str, str]]:
    """At most ``rows_per_language`` labelled texts of each language, those whose ids have the smallest hashes.

    Of a text of more than ``most_chars`` characters, eight pieces spread evenly over the whole of it are
    taken. Ids and languages alone are ranked; the languages are taken to be few, at most 1,000.
    """
    size = F.length("__text")
    pieces = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.substring("__text", F.floor(i * size / 8).cast("int") + 1, F.lit(most_chars // 8))), "")
    rows = docs.select(
        F.col(f"`{id}`").cast("string").alias("__id"), F.col(f"`{language}`").cast("string").alias("__lang"), F.col(f"`{text}`").cast("string").alias("__text")
    ).where("__lang is not null and __text rlike '\\\\p{L}'")
    # far more rows than wanted are left out by hash first, so that ranking does not grow with the number of partitions
    counts = {r[0]: r[1] for r in docs.select(F.col(f"`{language}`").cast("string").alias("x")).where("x is not null").groupBy("x").count().collect()}
    if not counts:
        return []
    share = F.create_map(*[F.lit(x) for name, n in counts.items() for x in (name, 8.0 * rows_per_language / n)])[F.col("__lang")]
    rows = rows.where(hash_below(F.xxhash64("__id"), share))
    short = rows.select("__lang", F.xxhash64("__id").alias("__h"), "__id", F.when(size > most_chars, pieces).otherwise(F.col("__text")).alias("__text"))
    order = Window.partitionBy("__lang").orderBy("__h", "__id", "__text")
    drawn = short.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= rows_per_language).collect()
    return [(r["__text"], r["__lang"]) for r in sorted(drawn, key=lambda r: (zlib.crc32(r["__id"].encode()) if r["__id"] else 0, r["__lang"], r["__text"]))]


def identify(docs: DataFrame, network: ByteNetwork | None, keep: dict[str, str], text: str = "text") -> DataFrame:
    """``keep`` columns, lang_pred and score of every whole text, in one pass without a shuffle.

    The score is the probability of the predicted language. A text that is null or has no
    letter is ``und`` with score 0, as is every text if there is no network. Repeated rows and null ids are
    judged by themselves; columns outside ``keep`` are not read; an empty table gives an empty result.
    """

    def compute(texts: Texts) -> dict:
        if network is None:
            return {"lang_pred": [UNDETERMINED] * len(texts), "score": np.zeros(len(texts))}
        windows, held, first = cut_windows(texts, network.window)
        weighted = network.log_probabilities(windows) * held[:, None]
        total = np.append(np.zeros((1, weighted.shape[1])), np.cumsum(weighted, 0, dtype=np.float64), 0)
        length = np.maximum(np.diff(texts.offsets), 1)
        mean = (total[first[1:]] - total[first[:-1]]) / length[:, None]
        mean -= mean.max(1, keepdims=True)
        p = np.exp(mean)
        p /= p.sum(1, keepdims=True)
        letters = [any(map(str.isalpha, texts.bytes(i).decode("utf-8", "replace"))) for i in range(len(texts))]
        best = p.argmax(1)
        return {
            "lang_pred": [network.languages[k] if ok else UNDETERMINED for k, ok in zip(best, letters)],
            "score": np.where(letters, p[np.arange(len(p)), best], 0.0),
        }

    return map_texts(docs, text, keep, {"lang_pred": "string", "score": "double"}, compute)
