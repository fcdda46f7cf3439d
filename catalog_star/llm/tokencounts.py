"""Token counts by a unigram model, with forward scores shared along a trie of pre-tokens.

A pre-token is a word with the mark of a word's begin before it. A trie over distinct
pre-tokens holds, at each node, the best score of any segmentation of the prefix that leads there, how
many tokens that has, and which vocabulary pieces are still open. A prefix that many words
share is scored once. At the end of a pre-token the count stays; texts add up counts.

The public vocabulary file has ranks, not probabilities: Zipf's law, log p = -log(rank + 1) up to a
constant, turns one into the other. Of equal scores the one of fewer tokens counts. A
character that is no piece falls back to its UTF-8 bytes, each with the score of the last rank.
"""

from __future__ import annotations

import math
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame

from catalog_star.llm.texts import Texts, map_texts
from catalog_star.llm.wordcache import WordCache, number_words

WORD_BEGIN = "▁"


class Pieces:
    """A vocabulary with log probabilities as a trie: a state maps characters to states, and "" to its score."""

    def __init__(self, scores: dict[str, float], byte_score: float):
        self.root: dict = {}
        self.byte_score = byte_score
        self.characters = {x for x in scores if len(x) == 1}
        for piece, score in scores.items():
            state = self.root
            for character in piece:
                state = state.setdefault(character, {})
            state[""] = score

    @classmethod
    def from_sentencepiece(cls, path: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        scale = math.log(sum(1 / (rank + 1) for rank in range(size)))
        normal = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        ranked = sorted(normal, key=lambda i: (-model.get_score(i), i))
        return cls({model.id_to_piece(i): -math.log(rank + 1) - scale for rank, i in enumerate(ranked)}, -math.log(size) - scale)


class Node:
    """A prefix: its best score, that segmentation's tokens, and the vocabulary states still open at its end."""

    __slots__ = ("child", "score", "count", "open", "terminal")

    def __init__(self, score: float, count: int, still_open: list[tuple[dict, float, int]]):
        self.child: dict[str, Node] = {}
        self.score = score
        self.count = count
        self.open = still_open
        self.terminal: int | None = None


class PretokenTrie:
    """Distinct pre-tokens with forward scores at their nodes; restarted when it has ``most_nodes``.

    What lies deeper than ``most_depth`` hardly any pre-tokens share: from there on scores are carried along without nodes.
    """

    def __init__(self, pieces: Pieces, most_nodes: int, most_depth: int = 64):
        self.pieces = pieces
        self.most_nodes = most_nodes
        self.most_depth = most_depth
        self.clear()

    def clear(self) -> None:
        self.size = 0
        self.root = Node(0.0, 0, [])

    def insert(self, pretoken: str) -> int:
        """Add a pre-token; the number of tokens of its best segmentation."""
        if self.size > self.most_nodes:
            self.clear()
        node = self.root
        for character in pretoken[: self.most_depth]:
            node = node.child.get(character) or self._grow(node, character)
        if len(pretoken) > self.most_depth:
            prefix = node.score, node.count, node.open
            for character in islice(pretoken, self.most_depth, None):
                prefix = self._longer(*prefix, character)
            return prefix[1]
        node.terminal = node.count
        return node.count

    def _grow(self, parent: Node, character: str) -> Node:
        node = parent.child[character] = Node(*self._longer(parent.score, parent.count, parent.open, character))
        self.size += 1
        return node

    def _longer(self, at_score: float, at_count: int, was_open: list, character: str) -> tuple[float, int, list]:
        """Score, tokens and open states of a prefix with one character more. States are open for as long as a piece is, so they are few."""
        still_open, best, fewest = [], -math.inf, 0
        for state, score, count in (*was_open, (self.pieces.root, at_score, at_count)):
            after = state.get(character)
            if after is None:
                continue
            if len(after) > 1 or "" not in after:
                still_open.append((after, score, count))
            piece = after.get("")
            if piece is not None:
                score += piece
                if score > best or score == best and count + 1 < fewest:
                    best, fewest = score, count + 1
        if character not in self.pieces.characters:
            n = len(character.encode("utf-8", "replace"))
            score = at_score + n * self.pieces.byte_score
            if score > best or score == best and at_count + n < fewest:
                best, fewest = score, at_count + n
        return best, fewest, still_open


_tries: dict[tuple, tuple[PretokenTrie, WordCache]] = {}


def token_counts(
    docs: DataFrame,
    vocabulary: str,
    id: str = "doc_id",
    text: str = "text",
    most_nodes: int = 20_000,
    most_words: int = 2_000_000,
) -> DataFrame:
    """Pre-tokens and tokens of every whole text: id, n_pretokens, n_tokens.

    ``vocabulary`` is the path of a sentencepiece file that every executor has. ``most_nodes`` and
    ``most_words`` bound what a task keeps between texts and have no influence on results; a pre-token of any length
    takes no more than a short one beside its own characters. A null or blank text has no tokens; every row of a repeated or null id is counted by itself; other
    columns are not read; an empty table gives an empty result.
    """

    def compute(texts: Texts) -> dict:
        key = (vocabulary, most_nodes, most_words)
        if key not in _tries:
            _tries[key] = PretokenTrie(Pieces.from_sentencepiece(vocabulary), most_nodes), WordCache(most_words)
        trie, cache = _tries[key]
        if cache.full:
            cache.clear()

        def make(words: list[bytes]) -> np.ndarray:
            found = np.zeros(len(words), np.int64)
            for i in sorted(range(len(words)), key=words.__getitem__):  # neighbours share most of their nodes
                found[i] = trie.insert(WORD_BEGIN + words[i].decode("utf-8", "replace"))
            return found

        counts = number_words(texts, cache, make)
        _, _, first = texts.words()
        total = np.append(0, np.cumsum(counts))
        return {"n_pretokens": np.diff(first), "n_tokens": total[first[1:]] - total[first[:-1]]}

    return map_texts(docs, text, {id: id}, {"n_pretokens": "long", "n_tokens": "long"}, compute)
