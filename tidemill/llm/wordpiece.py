"""Counts of greedy word pieces by a longest-match automaton, without building the pieces.

The vocabulary is a trie with failure links. When no child takes the next character, the pieces
that greedy matching would cut off are popped: their number was counted when the automaton was
built, and the failure link leads to the state of what is left. Each character is read once
and each link drops at least one popped piece, so that a word takes linear time.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COUNTS = "doc_id long, n_words long, n_pieces long, n_unknown long"
NONE = -1


class Automaton:
    """Trie, failure links and popped counts of a vocabulary with one root."""

    def __init__(self, pieces: list[str]):
        self.child: list[dict[str, int]] = [{}]
        final = [False]
        for piece in pieces:
            at = 0
            for c in piece:
                if c not in self.child[at]:
                    self.child[at][c] = len(self.child)
                    self.child.append({})
                    final.append(False)
                at = self.child[at][c]
            final[at] = at != 0
        self.fail, self.popped = [NONE] * len(final), [0] * len(final)
        ready = deque([0])
        while ready:
            at = ready.popleft()
            for c, to in self.child[at].items():
                ready.append(to)
                if final[to]:  # the whole state is a piece
                    self.fail[to], self.popped[to] = 0, 1
                    continue
                count, back = self.popped[at], self.fail[at]
                while back != NONE and c not in self.child[back]:
                    count += self.popped[back]
                    back = self.fail[back]
                if back != NONE:
                    self.fail[to], self.popped[to] = self.child[back][c], count

    def count(self, word: str) -> int:
        """Pieces of a word; -1 if greedy matching gets stuck."""
        child, fail, popped = self.child, self.fail, self.popped
        at = total = 0
        for c in word:
            while c not in child[at]:
                if at == 0 or fail[at] == NONE:
                    return NONE
                total += popped[at]
                at = fail[at]
            at = child[at][c]
        while at:
            if fail[at] == NONE:
                return NONE
            total += popped[at]
            at = fail[at]
        return total


class Counter(dict):
    """Piece counts of words, remembered up to ``most`` words of ``longest`` characters."""

    def __init__(self, automaton: Automaton, start: str, most: int = 500_000, longest: int = 40):
        self.automaton, self.start, self.most, self.longest = automaton, start, most, longest

    def __missing__(self, word: str) -> int:
        count = self.automaton.count(self.start + word)
        if len(word) <= self.longest:
            self[word] = count
        return count


@lru_cache(maxsize=2)
def counter(path: str, start: str) -> Counter:
    """The vocabulary of a sentencepiece model; control and byte pieces aren't matched."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [
        model.id_to_piece(i) for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    return Counter(Automaton(pieces), start)


WHITE = str.maketrans("\t\n\x0b\f\r", " " * 5)


def count_pieces(
    docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text",
    *, start: str = "▁",
) -> DataFrame:
    """Per document: n_words, n_pieces and n_unknown of the whole text.

    Words are parted by the six ASCII white-space characters; ``start`` is put before each, as in
    the vocabulary. A word that greedy matching can't cover is one unknown piece, as in word-piece
    tokenizers. Null and empty texts count 0; every row gives a row, with its id, null or
    repeated; other columns are ignored.
    """

    def counts(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counter(vocabulary, start)
        for frame in frames:
            words, pieces, unknown = [], [], []
            for text in frame.column(1):
                cut = (text.as_py() or "").translate(WHITE).split(" ")
                found = list(map(known.__getitem__, filter(None, cut)))
                stuck = found.count(NONE)
                words.append(len(found))
                unknown.append(stuck)
                pieces.append(sum(found) + 2 * stuck)  # -1 becomes 1
                if len(known) > known.most:
                    known.clear()
            yield pa.RecordBatch.from_arrays(
                [frame.column(0), *(pa.array(c, pa.int64()) for c in (words, pieces, unknown))],
                ["doc_id", "n_words", "n_pieces", "n_unknown"],
            )

    return docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text")).mapInArrow(counts, COUNTS)
