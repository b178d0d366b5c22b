"""Sum-of-squares online packing of tokenised documents into windows.

Each task keeps a level array N: N[h] windows are filled to h. A document gives as many full windows as it can; its rest
goes, as it comes, to the fill level that makes the sum of N[h] ** 2 over partly filled windows least, an empty window
being one of the choices. Windows that are full leave at once. What is still open at the end of a task (or when more
than ``open_limit`` windows are open, which bounds memory) is cut anew: its tokens fill windows without a gap, and the
last ones get lengths that are powers of two, which need no padding.

The vocabulary file is a parameter, read once per Python worker. A word cache keeps the token ids of each word: this
tokenizer treats words between white space apart, so the ids of a text are those of its words.

Defined cases: NULL or empty text is the end token alone. Repeated rows and ids are packed as often as they occur. An
empty table gives no rows. A document of any length is taken in one pass and given out in windows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

WINDOW, END_ID, OPEN_LIMIT = 2048, 1, 4096
CACHE_WORDS, CACHE_PARTS = 400_000, 1_000_000
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "sequence_tokens long")


class WordIds(dict):
    """Word (bytes) -> its token ids as little-endian unsigned 32-bit.

    Two bounded caches: words as they stand, and, below it, lower-case letters and runs of punctuation. The tokenizer
    lower-cases and cuts a word between letters and other signs, so for plain Latin letters with punctuation after them
    the ids are those of both parts. Any other word goes to the tokenizer whole.
    """

    PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,;:!?*#%()|-]*)")

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.parts = Tokenizer.from_file(vocabulary), {}

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        plain = self.PLAIN.fullmatch(text)
        if plain:
            letters, signs = plain.groups()
            value = self._part(letters.lower()) + (self._part(signs) if signs else b"")
        else:
            value = self._ids(text)
        if len(self) >= CACHE_WORDS:
            self.clear()
        if len(word) <= 256:
            self[word] = value
        return value

    def _part(self, text: str) -> bytes:
        value = self.parts.get(text)
        if value is None:
            if len(self.parts) >= CACHE_PARTS:
                self.parts.clear()
            value = self._ids(text)
            if len(text) <= 256:
                self.parts[text] = value
        return value

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def text(self, text: str | None) -> bytes:
        return b"".join(map(self.__getitem__, (text or "").encode("utf-8", "replace").split()))


def word_ids(vocabulary: str) -> WordIds:
    """The caches of this Python process: a worker keeps them from task to task."""
    import sys
    import types

    kept = sys.modules.setdefault("plumbline_word_ids", types.ModuleType("plumbline_word_ids"))
    if not hasattr(kept, "by_file"):
        kept.by_file = {}
    if vocabulary not in kept.by_file:
        kept.by_file[vocabulary] = WordIds(vocabulary)
    return kept.by_file[vocabulary]


@dataclass
class Packer:
    """Packs items (key, token ids as bytes) one by one and calls ``emit`` for every placed piece."""

    emit: Callable[..., None]  # key, start, ids, document length, sequence, offset, sequence length
    first_id: int = 0
    window: int = WINDOW
    open_limit: int = OPEN_LIMIT
    level: np.ndarray = field(init=False)

    def __post_init__(self):
        self.level = np.zeros(self.window + 1, np.int64)
        self.at: dict[int, list[list]] = {}  # fill -> open windows, each a list of pieces
        self.next_id, self.open = self.first_id, 0

    def add(self, key, ids: bytes) -> None:
        total, width = len(ids) // 4, self.window
        for start in range(0, total - width + 1, width):
            self._close([(key, start, ids[4 * start:4 * (start + width)], total)])
        start = total - total % width
        if start < total:
            self._place((key, start, ids[4 * start:], total), total - start)

    def best_level(self, size: int) -> int:
        """Fill level (0: an empty window) whose use leaves the least sum of squares; the fuller one on ties."""
        reach, level = self.window - size, self.level
        after = 2 * level[size:size + reach + 1] + 1
        after[reach] = 0  # a full window is no longer counted
        change = after - 2 * level[:reach + 1] + 1
        change[0] = after[0]
        change[1:][level[1:reach + 1] == 0] = np.iinfo(np.int64).max
        return reach - int(np.argmin(change[::-1]))

    def _place(self, piece: tuple, size: int) -> None:
        fill = self.best_level(size)
        if fill:
            pieces = self.at[fill].pop()
            self.level[fill] -= 1
            self.open -= 1
        else:
            pieces = []
        pieces.append(piece)
        if fill + size == self.window:
            self._close(pieces)
            return
        self.at.setdefault(fill + size, []).append(pieces)
        self.level[fill + size] += 1
        self.open += 1
        if self.open > self.open_limit:
            self.drain(finish=False)

    def _close(self, pieces: list[tuple]) -> None:
        offset, length = 0, sum(len(p[2]) // 4 for p in pieces)
        for key, start, ids, total in pieces:
            self.emit(key, start, ids, total, self.next_id, offset, length)
            offset += len(ids) // 4
        self.next_id += 1

    def drain(self, finish: bool = True) -> None:
        """Cut what is open into full windows; at the end also the rest, into lengths that are powers of two."""
        left = [p for fill in sorted(self.at, reverse=True) for pieces in self.at[fill] for p in pieces]
        self.level[:] = 0
        self.at, self.open = {}, 0
        tokens, i, within = sum(len(p[2]) // 4 for p in left), 0, 0
        while tokens:
            if tokens < self.window and not finish:
                rest = [self._cut(left[i], within, None), *left[i + 1:]]
                self.at, self.open = {tokens: [rest]}, 1
                self.level[tokens] = 1
                return
            size = self.window if tokens >= self.window else 1 << (tokens.bit_length() - 1)
            tokens -= size
            pieces = []
            while size:
                have = len(left[i][2]) // 4 - within
                taken = min(have, size)
                pieces.append(self._cut(left[i], within, taken))
                size -= taken
                i, within = (i + 1, 0) if taken == have else (i, within + taken)
            self._close(pieces)

    @staticmethod
    def _cut(piece: tuple, within: int, length: int | None) -> tuple:
        key, start, ids, total = piece
        return key, start + within, ids[4 * within:None if length is None else 4 * (within + length)], total


def _pack_partition(vocabulary: str, window: int, open_limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        words, end = word_ids(vocabulary), np.array([END_ID], "<u4").tobytes()
        packer = Packer(lambda key, start, ids, total, seq, offset, length: rows.append(
            (key, start, len(ids) // 4, zlib.crc32(ids), total, seq, offset, length)),
            TaskContext.get().partitionId() << 40, window, open_limit)
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                packer.add(key, words.text(text.as_py()) + end)
                if len(rows) >= 50_000:
                    yield _batch(rows)
        packer.drain()
        yield _batch(rows)
    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [p.split()[0] for p in PIECES.split(", ")]
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    batch = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)
    rows.clear()
    return batch


def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW, open_limit: int = OPEN_LIMIT) -> DataFrame:
    """One row per piece of the documents (doc_id, text); a sequence lies in one task."""
    return docs.select("doc_id", "text").mapInArrow(_pack_partition(vocabulary, window, open_limit), PIECES)
