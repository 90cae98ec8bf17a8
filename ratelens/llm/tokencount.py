"""Token counts by a count-only Viterbi search over a unigram vocabulary.

An Aho-Corasick automaton lists the pieces that end at each character; dynamic programming keeps the best score and the number of pieces
up to there. Tie rules are those of the tokenizers library: at equal scores the piece that starts first stays, and a character
without a piece of its own costs the least score less ``UNKNOWN_PENALTY`` and, with byte fallback, counts one token per
byte. As there, the text gets a word mark in front, every blank becomes one, each mark starts a new word, and words are searched on their own.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ratelens.llm.frames import with_arrow_columns

MARK = "▁"
UNKNOWN_PENALTY = 10.0
KEPT_WORDS = 400_000
KEPT_LENGTH = 48
#: No piece holds a line break, so a word may be cut there.
_WORD = re.compile(f"{MARK}[^{MARK}\n]*|\n|[^{MARK}\n]+")


def unigram_vocabulary(model_file: str) -> list[tuple[str, float]]:
    """Ordinary pieces of a sentencepiece file with their scores; a word mark may only come first in a piece."""
    library = sentencepiece.SentencePieceProcessor(model_file=model_file)
    found = []
    for i in range(library.vocab_size()):
        piece = library.id_to_piece(i)
        special = library.IsControl(i) or library.IsByte(i) or library.IsUnknown(i) or library.IsUnused(i)
        if not special and MARK not in piece[1:] and "\n" not in piece:
            found.append((piece, library.get_score(i)))
    return found


class PieceCounter(dict):
    """(score, pieces) of a word; a dictionary of the words met lately, with an older generation behind it."""

    def __init__(self, vocabulary: list[tuple[str, float]]) -> None:
        super().__init__()
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.automaton.add_word(piece, (len(piece), score))
        if vocabulary:
            self.automaton.make_automaton()
        self.usable = bool(vocabulary)
        self.single = {piece for piece, _ in vocabulary if len(piece) == 1}
        self.unknown = min((score for _, score in vocabulary), default=0.0) - UNKNOWN_PENALTY
        self.older: dict[str, tuple[float, int]] = {}

    def __missing__(self, word: str) -> tuple[float, int]:
        found = self.older.get(word) or self.search(word)
        if len(word) <= KEPT_LENGTH:
            self[word] = found
        return found

    def search(self, word: str) -> tuple[float, int]:
        scores, pieces = [0.0], [0]
        matches = self.automaton.iter(word) if self.usable else iter(())
        ahead = next(matches, None)
        for end, character in enumerate(word):
            best, count = float("-inf"), 0
            while ahead is not None and ahead[0] == end:  # longest piece first
                length, score = ahead[1]
                candidate = scores[end + 1 - length] + score
                if candidate > best:
                    best, count = candidate, pieces[end + 1 - length] + 1
                ahead = next(matches, None)
            if character not in self.single and scores[end] + self.unknown > best:
                best, count = scores[end] + self.unknown, pieces[end] + len(character.encode())
            scores.append(best)
            pieces.append(count)
        return scores[-1], pieces[-1]

    def count(self, text: str) -> tuple[float, int]:
        """Best score and number of tokens of a whole text."""
        if not text:
            return 0.0, 0
        if len(self) > KEPT_WORDS:
            self.older = dict(self)
            self.clear()
        text = text.replace(" ", MARK)
        words = _WORD.findall(text if text[0] == MARK else MARK + text)
        scores, pieces = zip(*map(self.__getitem__, words))
        return sum(scores), sum(pieces)


@lru_cache(maxsize=2)
def counter(model_file: str) -> PieceCounter:
    """One counter per Python worker and vocabulary."""
    return PieceCounter(unigram_vocabulary(model_file))


def token_counts(
    df: DataFrame, model_file: str, *, text: str = "text", n_tokens: str = "n_tokens", score: str = "token_score"
) -> DataFrame:
    """Adds the number of tokens of every whole text and the score of the best segmentation.

    A null or empty text has 0 tokens and score 0. Equal texts get equal rows, an empty table gives an empty one and columns of
    these names are replaced. ``model_file`` must exist on every executor.
    """
    added = T.StructType([T.StructField(n_tokens, T.LongType()), T.StructField(score, T.DoubleType())])

    def compute():
        pieces = counter(model_file)

        def slice_(texts: pa.Array) -> list[pa.Array]:
            found = [pieces.count(t or "") for t in texts.to_pylist()]
            return [pa.array([n for _, n in found], pa.int64()), pa.array([s for s, _ in found], pa.float64())]

        return slice_

    return with_arrow_columns(df, [text], added, compute)
