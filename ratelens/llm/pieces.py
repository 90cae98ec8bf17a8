"""SentencePiece encoding and decoding with a merge-type (BPE) vocabulary.

Adjacent symbols are merged in the order of an agenda: highest score first, leftmost first among equal scores, until
no adjacent pair forms a piece. No piece of the vocabulary holds a word mark after another character or a line
break, so a text falls into chunks (word marks and what follows, or line breaks) that never merge with one another;
the agenda runs once per distinct chunk and its ids are kept in a bounded cache. Every Arrow slice checks the chunks that it met
first against the sentencepiece library and fails on a difference.
"""

from __future__ import annotations

import heapq
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ratelens.llm.frames import with_arrow_columns

MARK = "▁"
#: A blank stands for a word mark here: texts without other signs than ASCII then take a byte per character.
_CHUNK = re.compile(" +[^ \n]*|\n|[^ \n]+")
#: With two generations of these a Python worker, which lives beside the heap of its executor, grew by 216 MB (by 288 MB with 400,000).
KEPT_CHUNKS = 300_000
KEPT_LENGTH = 48


class PieceEncoder(dict):
    """Ids of a chunk by the agenda, as 32-bit numbers in bytes; a dictionary of the chunks met lately.

    When it is full it becomes the older generation, which keeps the chunks that come again.
    """

    def __init__(self, model_file: str) -> None:
        super().__init__()
        self.library = library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.rank, self.ids = {}, {}
        for i in range(library.vocab_size()):
            if not (library.IsControl(i) or library.IsByte(i) or library.IsUnknown(i) or library.IsUnused(i)):
                piece = library.id_to_piece(i)
                if "\n" in piece or re.search(f"[^{MARK}]{MARK}", piece):
                    raise ValueError(f"piece {piece!r} crosses words: this vocabulary cannot be cut at word marks")
                self.ids[piece], self.rank[piece] = i, -library.get_score(i)
        self.byte_ids = [library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(map(library.IsByte, self.byte_ids)):
            raise ValueError("the vocabulary has no byte pieces")
        self.end = array("i", [library.eos_id()]).tobytes()
        self.fresh: list[str] = []
        self.older: dict[str, bytes] = {}

    def __missing__(self, chunk: str) -> bytes:
        found = self.older.get(chunk)
        if found is None:
            found = array("i", self.merge(chunk.replace(" ", MARK))).tobytes()
            self.fresh.append(chunk)
        if len(chunk) <= KEPT_LENGTH:
            self[chunk] = found
        return found

    def merge(self, chunk: str) -> list[int]:
        """Ids of one chunk with word marks."""
        symbols: list[str] = list(chunk)
        last = len(symbols) - 1
        before, after = list(range(-1, last)), list(range(1, last + 2))
        rank, agenda = self.rank, []
        for i in range(last):
            order = rank.get(symbols[i] + symbols[i + 1])
            if order is not None:
                agenda.append((order, i, 2))
        heapq.heapify(agenda)
        while agenda:
            _, left, size = heapq.heappop(agenda)
            right = after[left]
            if not symbols[left] or right > last or len(symbols[left]) + len(symbols[right]) != size:
                continue
            symbols[left] += symbols[right]
            symbols[right] = ""
            after[left] = following = after[right]
            if following <= last:
                before[following] = left
            for a, b in ((before[left], left), (left, following)):
                if a >= 0 and b <= last:
                    order = rank.get(symbols[a] + symbols[b])
                    if order is not None:
                        heapq.heappush(agenda, (order, a, len(symbols[a]) + len(symbols[b])))
        out: list[int] = []
        for symbol in filter(None, symbols):
            i = self.ids.get(symbol)
            out += [self.byte_ids[b] for b in symbol.encode()] if i is None else (i,)
        return out

    def encoded(self, text: str) -> bytes:
        """Ids of a whole text, the end id last, as 32-bit numbers."""
        if len(self) > KEPT_CHUNKS:
            self.check()
            self.older = dict(self)
            self.clear()
        chunks = _CHUNK.findall(" " + text.replace(MARK, " ")) if text else []
        return b"".join(map(self.__getitem__, chunks)) + self.end

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text, the end id last."""
        return ids_of(self.encoded(text))

    def check(self) -> None:
        """Hold the chunks met since the last check against the library; it puts one word mark before each text."""
        marked = [c[0] == " " for c in self.fresh]
        texts = [c[1:] if m else f"\n{c}" for c, m in zip(self.fresh, marked)]
        head = self.library.encode("\n")
        for chunk, m, ids in zip(self.fresh, marked, self.library.encode(texts, num_threads=1)):
            if chunk == " ":
                ids = ids or [self.ids[MARK]]
            elif not m:
                ids = ids[len(head) :]
            found = self.get(chunk) or self.older.get(chunk)
            mine = ids_of(found) if found else self.merge(chunk.replace(" ", MARK))
            if mine != ids:
                raise ValueError(f"other ids than the library's for {chunk!r}: {mine} and {ids}")
        self.fresh.clear()


def ids_of(numbers: bytes) -> list[int]:
    return np.frombuffer(numbers, dtype=np.int32).tolist()


@lru_cache(maxsize=2)
def encoder(model_file: str) -> PieceEncoder:
    """One encoder per Python worker and vocabulary."""
    return PieceEncoder(model_file)


def int_lists(numbers: list[bytes]) -> pa.Array:
    sizes = np.fromiter(map(len, numbers), dtype=np.int64, count=len(numbers)) // 4
    values = np.frombuffer(b"".join(numbers), dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(values))


def piece_encode(
    df: DataFrame, model_file: str, *, text: str = "text", ids: str = "ids", decoded: str | None = None
) -> DataFrame:
    """Adds ``ids`` (array of int), the pieces of the whole text and the end id, no start id, no sampling.

    With ``decoded`` also the text that the library's decode makes of the ids (see ``piece_decode``).
    A null text counts as empty and gives the end id alone; the number and order of the rows do not matter and equal
    rows get equal ids; an empty table gives an empty table. Columns of these names are replaced, others stay.
    ``model_file`` must exist on every executor. Memory per task: one Arrow batch and a cache of
    two generations of ``KEPT_CHUNKS`` chunks.
    """
    added = [T.StructField(ids, T.ArrayType(T.IntegerType(), False))]
    if decoded:
        added.append(T.StructField(decoded, T.StringType()))

    def compute():
        pieces = encoder(model_file)

        def slice_(texts: pa.Array) -> list[pa.Array]:
            found = [pieces.encoded(t or "") for t in texts.to_pylist()]
            pieces.check()
            out = [int_lists(found)]
            if decoded:
                out.append(pa.array([pieces.library.decode(ids_of(i)) for i in found], pa.string()))
            return out

        return slice_

    return with_arrow_columns(df, [text], T.StructType(added), compute, rows=200)


def piece_decode(df: DataFrame, model_file: str, *, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Adds ``decoded``, the text of the ids by the library's decode; null or empty ids give an empty text."""

    def compute():
        library = encoder(model_file).library
        return lambda column: [pa.array([library.decode(i or []) for i in column.to_pylist()], pa.string())]

    return with_arrow_columns(df, [ids], T.StructType([T.StructField(decoded, T.StringType())]), compute, rows=200)
