"""Unigram token counts: one forward pass per shared prefix of a trie of pre-tokens."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType

from cellhours.llm.common import with_fields

MARK = "▁"  # what stands for the white space before a word in the vocabulary
MAX_NODES = 400_000


@cache
def unigram_scores(file: str) -> tuple[dict[str, float], int]:
    """Log-probability of each piece of a public vocabulary, and the longest piece.

    The file ranks its pieces and holds no probabilities, so they get those of Zipf's law by rank.
    Control pieces and the pieces for single bytes are left out; a character that no piece covers
    is written as its UTF-8 bytes, each a token with the score of the last rank.
    """
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=public_tokenizers.path(file))
    size = model.get_piece_size()
    total = math.log(math.fsum(1.0 / (rank + 1) for rank in range(size)))
    scores = {
        model.id_to_piece(i): -math.log(i + 1.0) - total
        for i in range(size)
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    }
    return scores, max(map(len, scores))


class PieceTrie:
    """Trie of pre-tokens. Every node holds the forward scores of its prefix.

    best[node] is the score of the best segmentation of the prefix that ends there, count[node]
    its number of tokens. Both only depend on the prefix, so words that begin alike share them.
    Of two segmentations with one score the one with the longer last piece wins.
    """

    def __init__(self, scores: dict[str, float], longest: int) -> None:
        self.scores, self.longest = scores, longest
        self.byte_score = min(scores.values(), default=-10.0) - 1.0
        self.clear()

    def clear(self) -> None:
        self.child: dict[tuple[int, str], int] = {}
        self.best, self.count = [0.0], [0]
        self.terminal: dict[str, int] = {}

    def insert(self, word: str) -> int:
        """Add a pre-token if it is new; its token count."""
        known = self.terminal.get(word)
        if known is not None:
            return known
        path, node = [0], 0
        for end, letter in enumerate(word, 1):
            edge = (node, letter)
            node = self.child.get(edge, -1)
            if node < 0:
                node = self.child[edge] = len(self.best)
                best, count = -math.inf, 0
                for start in range(max(0, end - self.longest), end):
                    score = self.scores.get(word[start:end])
                    if score is not None and self.best[path[start]] + score > best:
                        best = self.best[path[start]] + score
                        count = self.count[path[start]] + 1
                if best == -math.inf or letter not in self.scores:
                    size = len(letter.encode("utf-8", "surrogatepass"))
                    raw = self.best[path[-1]] + size * self.byte_score
                    if raw > best:
                        best, count = raw, self.count[path[-1]] + size
                self.best.append(best)
                self.count.append(count)
            path.append(node)
        self.terminal[word] = self.count[node]
        return self.count[node]


def token_counts(
    docs: DataFrame,
    text: str = "text",
    file: str = "piece_bpe_32k.model",
    max_nodes: int = MAX_NODES,
) -> DataFrame:
    """Every row of `docs` without its text, plus `n_pretokens` and `n_tokens` (BIGINT).

    Pre-tokens are the parts of the whole text between white space, each with the vocabulary's
    word mark in front; a token count is that of the best unigram segmentation. NULL and blank
    texts have no tokens. No shuffle: each task keeps one trie, and starts a new one when it has
    `max_nodes` nodes, which bounds its memory and changes no count. A single word of any length
    is one path of the trie. Repeated rows are counted again from the stored terminals. Input
    columns called like the two new ones are replaced.
    """
    new = ["n_pretokens", "n_tokens"]
    others = [c for c in docs.columns if c != text and c.lower() not in new]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = PieceTrie(*unigram_scores(file))
        for part in parts:
            words_of, tokens_of = [], []
            for body in part.column(0).to_pylist():
                words = [MARK + w for w in (body or "").split()]
                for word in [w for w in set(words) if w not in trie.terminal]:
                    if len(trie.best) > max_nodes:
                        trie.clear()
                    trie.insert(word)
                known = trie.terminal
                words_of.append(len(words))
                try:
                    tokens_of.append(sum(map(known.__getitem__, words)))
                except KeyError:  # the trie was started anew within this text
                    tokens_of.append(sum(_insert_all(trie, words, max_nodes)))
            yield pa.RecordBatch.from_arrays(
                [*part.columns[1:], pa.array(words_of, pa.int64()), pa.array(tokens_of, pa.int64())],
                [*others, *new],
            )

    schema = with_fields(docs, others, **dict.fromkeys(new, LongType()))
    return docs.select(text, *others).mapInArrow(batches, schema)


def _insert_all(trie: PieceTrie, words: list[str], max_nodes: int) -> Iterator[int]:
    for word in words:
        if len(trie.best) > max_nodes:
            trie.clear()
        yield trie.insert(word)
