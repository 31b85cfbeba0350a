"""Count-only Viterbi: how many tokens a unigram vocabulary cuts each text into.

A text is split at spaces as the ``Metaspace`` step does (each space starts a word and is its first
character; the text itself starts one too).  Within a word an Aho-Corasick automaton enumerates the
vocabulary's matches by their ends, and dynamic programming carries for each end the best score
and the number of pieces that reach it; no piece list is built.  Of equal scores the earliest start
wins, a character without a piece of its own costs the lowest score less ten, and a run of such
characters is one piece, or one piece per byte where the vocabulary falls back to bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import batch, id_and_text, strings

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
MEMO_WORDS, MEMO_LENGTH = 600_000, 48
_ARROW = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("n_tokens", pa.int64())])


def load_pieces(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model file, by id."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class UnigramCounter:
    """Token counts under a unigram vocabulary of ``(piece, score)``."""

    def __init__(self, pieces: list[tuple[str, float]], byte_fallback: bool = True):
        self.scores: dict[str, float] = {}
        for piece, score in pieces:
            if piece:
                self.scores[piece] = score
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN_PENALTY
        self.bytes = byte_fallback and all(f"<0x{b:02X}>" in self.scores for b in range(256))
        self.automaton = ahocorasick.Automaton()
        for piece, score in self.scores.items():
            self.automaton.add_word(piece, (len(piece), score))
        if self.scores:
            self.automaton.make_automaton()
        self.singles = {p for p in self.scores if len(p) == 1}
        self.memo: dict[str, int] = {}

    def _unknown_tokens(self, run: str) -> int:
        return 1 if run in self.scores or not self.bytes else len(run.encode())

    def word(self, word: str) -> int:
        """Pieces of one word; linear in its length for a vocabulary of bounded pieces."""
        if self.singles.issuperset(word):
            return self._plain(word)
        size = len(word)
        # For each end: best score, pieces before the open run of unknowns, start of that run.
        best: list[float] = [0.0] + [0.0] * size
        known = [True] + [False] * size
        count, run = [0] * (size + 1), [-1] * (size + 1)
        matches = iter(self.automaton.iter(word)) if self.scores else iter(())
        at, found = next(matches, (size, None))
        for end in range(1, size + 1):
            single = False
            while at == end - 1 and found is not None:
                length, score = found
                start = end - length
                score += best[start]
                single |= length == 1
                if not known[end] or score > best[end]:
                    known[end], best[end], run[end] = True, score, -1
                    count[end] = 1 + self._closed(word, start, count, run)
                at, found = next(matches, (size, None))
            if not single:
                score = self.unknown + best[end - 1]
                if not known[end] or score > best[end]:
                    known[end], best[end] = True, score
                    count[end] = count[end - 1]
                    run[end] = end - 1 if run[end - 1] < 0 else run[end - 1]
        return self._closed(word, size, count, run)

    def _plain(self, word: str) -> int:
        """The same for a word whose characters all have pieces: no unknowns to keep apart."""
        best = [0.0] + [float("-inf")] * len(word)
        count = [0] * len(best)
        for at, (length, score) in self.automaton.iter(word):
            at += 1
            start = at - length
            score += best[start]
            if score > best[at]:
                best[at] = score
                count[at] = count[start] + 1
        return count[-1]

    def _closed(self, word: str, end: int, count: list[int], run: list[int]) -> int:
        """Pieces up to ``end``, an open run of unknown characters included."""
        if run[end] < 0:
            return count[end]
        return count[end] + self._unknown_tokens(word[run[end] : end])

    def count(self, text: str) -> int:
        if not text:
            return 0
        text = text.replace(" ", SPACE)
        words = text.split(SPACE)
        if text[0] == SPACE:
            words = words[1:]
        memo, total = self.memo, 0
        for word in words:
            n = memo.get(word)
            if n is None:
                n = self.word(SPACE + word)
                if len(word) <= MEMO_LENGTH:
                    if len(memo) >= MEMO_WORDS:
                        memo.clear()
                    memo[word] = n
            total += n
        return total


def count_tokens(
    df: DataFrame,
    vocabulary_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    byte_fallback: bool = True,
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_chars`` (code points) and ``n_tokens``.

    A null or empty text has no tokens; a null id is kept.  Rows with equal ids or texts are
    counted each on their own, an empty table yields no rows, very long texts take time in
    proportion to their length, and other columns are ignored.  Nothing is shuffled: a worker
    loads the vocabulary once and remembers the counts of at most ``MEMO_WORDS`` short words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = UnigramCounter(load_pieces(vocabulary_path), byte_fallback)
        for rows in batches:
            texts = strings(rows[1])
            yield batch(
                _ARROW,
                (rows[0].to_pylist(), [len(t) for t in texts], [counter.count(t) for t in texts]),
            )

    return id_and_text(df, id_col, text_col).mapInArrow(
        run, "doc_id long, n_chars long, n_tokens long"
    )
