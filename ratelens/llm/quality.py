"""Quality rules on whole texts, with zstandard compression bands.

Repetitive text compresses to very little, random text hardly at all. Each text is compressed as a whole and in fixed chunks
of ``CHUNK`` bytes; its ratio is compressed over plain size. A short text cannot reach the ratio of a long one, so the limits depend on
the number of bytes. The chunks catch a repetitive or random part inside a longer text; the last one ends where the text ends, so that no byte is left out.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ratelens.llm.frames import utf8, with_arrow_columns

CHUNK = 4096
LEVEL = 3


class Band(NamedTuple):
    """Limits of the ratio for texts of at least ``size`` bytes."""

    size: int
    low: float
    high: float


#: The prose of the given tables, in four languages, lies well inside these limits (see the README); random letters and digits
#: come to 0.76 from 1,024 bytes on.
BANDS = (
    Band(0, 0.0, 9.0),
    Band(256, 0.25, 0.95),
    Band(1024, 0.20, 0.75),
    Band(4096, 0.14, 0.70),
    Band(16384, 0.10, 0.70),
)
#: Chunks of good documents come to 0.44 to 0.48, random letters to 0.60 and more, copied sentences to 0.1 and less.
CHUNK_BAND = Band(CHUNK, 0.20, 0.59)
#: A text fails if more than this share of its chunks is out of the band on one side.
MAX_BAD_CHUNKS = 0.2
MIN_WORDS = 50
MAX_REPEATED = 50

_SYMBOLS = re.compile(rb"[#*$%&|<>]")
_SPACES = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])
_IS_CONTINUATION = bytes(range(0x80, 0xC0))


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of three that occur at least twice in the text, the first occurrence included."""
    if len(words) < 4:
        return 0
    numbers: dict[bytes, int] = {}
    number = numbers.setdefault
    ids = np.fromiter((number(w, len(numbers)) for w in words), dtype=np.int64, count=len(words))
    pairs = np.unique(ids[:-1] * len(numbers) + ids[1:], return_inverse=True)[1]
    windows = pairs[:-1] * len(numbers) + ids[2:]
    _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    twice = counts[inverse] > 1
    inside = np.zeros(len(words), dtype=bool)
    for i in range(3):
        inside[i : len(words) - 2 + i] |= twice
    return int(inside.sum())


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip(_SPACES)]
    return len(lines) - len(set(lines))


def limits(size: int) -> Band:
    return next(b for b in reversed(BANDS) if size >= b.size)


class Compression:
    """Ratios of one text; holds the compressor, so make one per task."""

    def __init__(self) -> None:
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)

    def ratio(self, data: bytes) -> float:
        return len(self.compressor.compress(data)) / len(data) if data else 1.0

    def verdict(self, text: bytes) -> tuple[float, int, int, str]:
        """Ratio of the whole, number of chunks, chunks out of their band, and the verdict; texts below ``CHUNK`` bytes have no chunks."""
        whole = self.ratio(text)
        band = limits(len(text))
        starts = list(range(0, len(text) - CHUNK + 1, CHUNK))
        if starts and len(text) % CHUNK:
            starts.append(len(text) - CHUNK)
        chunks = [self.ratio(text[i : i + CHUNK]) for i in starts]
        low = sum(r < CHUNK_BAND.low for r in chunks)
        high = sum(r > CHUNK_BAND.high for r in chunks)
        if whole < band.low or low > MAX_BAD_CHUNKS * len(chunks):
            word = "repetitive"
        elif whole > band.high or high > MAX_BAD_CHUNKS * len(chunks):
            word = "incompressible"
        else:
            word = "ok"
        return whole, len(chunks), low + high, word


ADDED = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [
        T.StructField("zstd_ratio", T.DoubleType()),
        T.StructField("n_chunks", T.LongType()),
        T.StructField("n_bad_chunks", T.LongType()),
        T.StructField("zstd_verdict", T.StringType()),
        T.StructField("base_failed", T.BooleanType()),
        T.StructField("kept", T.BooleanType()),
    ]
)


def quality_rules(df: DataFrame, *, text: str = "text") -> DataFrame:
    """Adds counts, compression ratios and the verdict of every whole text.

    ``n_words`` words ``[^\\x20\\x09-\\x0D]+``, ``word_chars`` code points in them, ``n_symbols`` characters of
    ``#*$%&|<>``, ``n_dup_lines`` and ``n_repeat_words`` (see the functions above); ``zstd_verdict`` is ok, repetitive or
    incompressible; ``base_failed`` under 50 words or more than half of them repeated; ``kept`` where neither rejects.
    A null or empty text has zero counts, ratio 1, verdict ok and fails the base rule. Equal texts get equal rows, an
    empty table gives an empty one, and columns with these names are replaced. Long texts are read whole.
    """

    def compute():
        compression = Compression()

        def slice_(texts: pa.Array) -> list[pa.Array]:
            rows = []
            for data in utf8(texts):
                data = data or b""
                words = data.split()
                n_words, n_repeat = len(words), repeated_words(words)
                joined = b"".join(words)
                chars = len(joined.translate(None, _IS_CONTINUATION))
                ratio, chunks, bad, verdict = compression.verdict(data)
                failed = n_words < MIN_WORDS or 100 * n_repeat > MAX_REPEATED * n_words
                rows.append(
                    (n_words, chars, len(_SYMBOLS.findall(joined)), repeated_lines(data), n_repeat)
                    + (ratio, chunks, bad, verdict, failed, not failed and verdict == "ok")
                )
            columns = list(zip(*rows)) or [()] * len(ADDED)
            kinds = [pa.int64()] * 5 + [pa.float64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_()]
            return [pa.array(c, k) for c, k in zip(columns, kinds)]

        return slice_

    return with_arrow_columns(df, [text], ADDED, compute)
