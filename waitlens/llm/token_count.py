"""Greedy word-piece lengths by a linear longest-match automaton.

The vocabulary becomes a byte trie. Every node has a failure link and the number of pieces that
greedy longest match has settled ("popped") when the link is taken, so a word's piece count is a
sum of precomputed numbers over one pass of its bytes; no piece is ever built.

The vocabulary is a sentencepiece model whose pieces start a word with U+2581; its 256 byte
pieces make every byte a piece, so each word has a segmentation. Words are split at ASCII white
space and keep their case.

Defined cases: null and empty texts have no words and no tokens; a word of any length costs time
in proportion to its bytes; repeated words are counted from a bounded memo; repeated rows each
give a row; columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

WORD_START = "▁".encode()
MEMO_WORDS = 400_000


class LongestMatch:
    """Trie with failure links over ``pieces``; every single byte must be a piece."""

    def __init__(self, pieces: list[bytes]):
        child: dict[int, int] = {}  # node * 256 + byte -> node; node 0 is the root
        final, parent, order = [False], [(0, 0)], []
        for piece in pieces:
            at = 0
            for byte in piece:
                at, above = child.get(at << 8 | byte, 0), at
                if not at:
                    at = child[above << 8 | byte] = len(final)
                    final.append(False)
                    parent.append((above, byte))
            final[at] = True
        if not all(final[child.get(b, 0)] for b in range(256)):
            raise ValueError("every byte has to be a piece")
        depth = [0] * len(final)
        for node in range(1, len(final)):  # parents come before their children
            depth[node] = depth[parent[node][0]] + 1
        order = sorted(range(1, len(final)), key=depth.__getitem__)
        link, popped = [0] * len(final), [0] * len(final)
        for node in order:
            if final[node]:  # the whole string is one piece, nothing remains
                popped[node] = 1
                continue
            above, byte = parent[node]
            at, n = link[above], popped[above]
            while (at << 8 | byte) not in child:
                n += popped[at]
                at = link[at]
            link[node], popped[node] = child[at << 8 | byte], n
        self.child, self.link, self.popped = child, link, popped

    def count(self, word: bytes) -> int:
        """Number of pieces of greedy longest match over ``word``."""
        child, link, popped = self.child, self.link, self.popped
        at = n = 0
        for byte in word:
            to = child.get(at << 8 | byte)
            while to is None:
                n += popped[at]
                at = link[at]
                to = child.get(at << 8 | byte)
            at = to
        while at:
            n += popped[at]
            at = link[at]
        return n


class _Memo(dict):
    """Piece counts of words seen by this worker; emptied when it holds MEMO_WORDS."""

    def __init__(self, automaton: LongestMatch):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        n = self[word] = self.automaton.count(WORD_START + word)
        return n


def vocabulary(path: str) -> list[bytes]:
    """Pieces of a sentencepiece model: control pieces out, byte pieces as their byte."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [model.id_to_piece(i).encode() for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return pieces + [bytes([b]) for b in range(256)]


@lru_cache(maxsize=2)  # once per Python worker, which Spark reuses between tasks
def _memo(path: str) -> _Memo:
    return _Memo(LongestMatch(vocabulary(path)))


def token_counts(documents: DataFrame, vocabulary_path: str) -> DataFrame:
    """doc_id, n_words, n_tokens, longest_word_tokens of every row of ``documents``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _memo(vocabulary_path)
        for batch in batches:
            words, tokens, most = [], [], []
            for text in batch.column(1):
                found = [memo[w] for w in text.as_py().encode().split()] if text.is_valid else []
                words.append(len(found))
                tokens.append(sum(found))
                most.append(max(found, default=0))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (words, tokens, most))],
                ["doc_id", "n_words", "n_tokens", "longest_word_tokens"])

    rows = documents.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(count, f"doc_id {kind}, n_words long, n_tokens long, longest_word_tokens long")
