"""Token counts under a unigram vocabulary by dynamic programming over a trie of pre-tokens.

The best segmentation of a string is found from the best segmentations of its prefixes, and those depend on
the prefix alone. So the distinct pre-tokens of a batch are put into a trie and every node, that is every
shared prefix, gets its forward score and token count once; what ends at a node keeps its count there.
Documents then add up the counts of their pre-tokens.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import per_batch, text_bytes

VOCABULARY = "piece_bpe_32k.model"
MARK = "▁"                    # stands before every pre-token
# a character without a piece costs this much more than the rarest piece
UNKNOWN_PENALTY = 10.0
NO_PIECE = 1.0                    # no log probability
# pre-tokens whose counts a task remembers between batches
CACHE = 300_000


@dataclass
class Vocabulary:
    """Pieces with their unigram log probabilities."""

    scores: dict[str, float]
    unknown: float
    longest: int

    def __post_init__(self):
        # every ending of a piece -> the piece's score, None if it is no piece itself
        self.endings: dict[str, float | None] = {p[i:]: None for p in self.scores for i in range(len(p))}
        self.endings.update(self.scores)

    @staticmethod
    def ranked(pieces: list[str]) -> Vocabulary:
        """A vocabulary in order of frequency: piece ``r`` gets Zipf's probability, in proportion to 1 / (r + 1)."""
        total = math.log(sum(1 / (r + 1) for r in range(len(pieces)))) if pieces else 0.0
        scores = {p: -math.log(r + 1) - total for r, p in enumerate(pieces)}
        least = min(scores.values(), default=0.0)
        return Vocabulary(scores, least - UNKNOWN_PENALTY, max(map(len, pieces), default=1))

    @staticmethod
    @lru_cache(maxsize=4)
    def load(path: str) -> Vocabulary:
        """The ordinary pieces of a sentencepiece model in the order of their scores (bytes and control pieces
        are left out; a character without a piece counts as one unknown token for each UTF-8 byte)."""
        import sentencepiece
        m = sentencepiece.SentencePieceProcessor(model_file=path)
        rows = [(-m.get_score(i), i, m.id_to_piece(i)) for i in range(m.get_piece_size())
                if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]
        return Vocabulary.ranked([p for _, _, p in sorted(rows)])


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def trie_counts(words: list[str], vocabulary: Vocabulary) -> dict[str, tuple[int, float]]:
    """Distinct words -> (tokens, log probability) of the best segmentation; of equal scores the one whose
    last piece is shortest, at every prefix.

    The words are walked in sorted order, which visits the nodes of their trie depth first: the stack holds
    the path to the current node with its forward states, and a word reuses the states of the prefix it
    shares with the word before.
    """
    ending = vocabulary.endings.get
    best: list[float] = [0.0]                 # forward score of each prefix on the path
    count: list[int] = [0]
    out: dict[str, tuple[int, float]] = {}
    before = ""
    for word in sorted(words):
        shared, most = 0, min(len(before), len(word))
        while shared < most and before[shared] == word[shared]:
            shared += 1
        del best[shared + 1:], count[shared + 1:]
        for end in range(shared + 1, len(word) + 1):
            top, n, alone = -math.inf, 0, None
            for begin in range(end - 1, -1, -1):
                score = ending(word[begin:end], NO_PIECE)
                if score is NO_PIECE:                   # nor does any longer piece end like this
                    break
                if score is not None:
                    if begin == end - 1:
                        alone = score
                    if best[begin] + score > top:
                        top, n = best[begin] + score, count[begin] + 1
            if alone is None:
                byte = len(word[end - 1].encode("utf-8", "replace"))
                if best[end - 1] + byte * vocabulary.unknown > top:
                    top, n = best[end - 1] + byte * vocabulary.unknown, count[end - 1] + byte
            best.append(top)
            count.append(n)
        out[word] = (count[-1], best[-1])
        before = word
    return out


def counted(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row a document: doc_id, n_pretokens, n_tokens, log_prob (of the best segmentations).

    Pre-tokens are the words ``[^\\x20\\x09-\\x0D]+`` with a mark in front. Null and empty texts have none;
    repeated rows each get their row; an empty table gives none. Nothing is shuffled; a task holds the trie
    path of one word and the counts of at most ``CACHE`` pre-tokens besides those of one batch.
    """
    kind = pa.struct([("n_pretokens", pa.int64()), ("n_tokens", pa.int64()), ("log_prob", pa.float64())])
    path = path or vocabulary_path()

    def start():
        vocabulary = Vocabulary.load(path)
        known: dict[bytes, tuple[int, float]] = {}

        def step(batch):
            texts = [Counter(t.split()) for t in batch.to_pylist()]
            if len(known) > CACHE:
                known.clear()
            new = {MARK + w.decode("utf-8", "replace"): w for t in texts for w in t if w not in known}
            for marked, r in trie_counts(list(new), vocabulary).items():
                known[new[marked]] = r
            rows = []
            for t in texts:
                got = [(k, *known[w]) for w, k in t.items()]
                rows.append((sum(k for k, _, _ in got), sum(k * n for k, n, _ in got), math.fsum(k * s for k, _, s in got)))
            a = np.array(rows, np.float64).reshape(-1, 3)
            return pa.StructArray.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
                                               pa.array(a[:, 2])], fields=list(kind))
        return step

    count = per_batch(start, "n_pretokens long, n_tokens long, log_prob double")
    return docs.select("doc_id", count(text_bytes("text")).alias("c")).select("doc_id", "c.*")
