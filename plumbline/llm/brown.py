"""Brown class-based bigram model: P(w | previous) = P(class of w | class of previous) * P(w | class of w).

Exchange clustering gives the ``clustered`` most frequent words their classes: word after word moves to the class that
raises the mutual information of adjacent classes most, until a pass moves nothing or ``passes`` are done. The next
words, up to ``assigned``, get one exchange step each from their neighbours among those. All other words of the training
texts get the same step from their neighbours among the assigned: what stands next to a word is a distributed table, so
this grows with the vocabulary. Only words that were never seen share a few classes by their form.

Texts are tokenised once, into blocks of some hundred thousand tokens: numbers into a dictionary of the block's words, which
is stored beside them as one value. Each later pass looks up the words of a block, not its tokens, in Arrow; the rest is array
arithmetic. Counts of cells leave a task packed, so that Spark moves a few rows in place of one for every cell.

All counts (words, word pairs, neighbours, class pairs) are taken over all training texts. The vocabulary grows with the
corpus and stays a distributed table; only the most frequent words (``head`` at most, of at most 64 bytes) are
broadcast. A class has two halves, its words of the head and its rarer ones. Rarer words of a block go through one join that
brings their class and count.

Smoothing: class transitions back off to class frequencies with weight ``backoff``. A rarer word that occurs once counts
a second time as a word of its form, since it would be unseen without that text. A class by form spreads over the rarer
words of the form, counted one more than seen, and one share for the unseen; only that share is used.

Defined cases: NULL text counts as empty, which is the end token alone. Without training texts every word is unseen.
Repeated rows are scored each on their own; NULL ids count as the empty text in the split.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import LARGE_ROWS, small_batches, stored

END = b""  # no word is empty
FORMS = 8
LONGEST = 64  # bytes of a broadcast word
CHUNK = 1_000_000  # tokens whose pairs are counted at once
HELD = 2_000_000  # tokens of the blocks a task holds before it gives out their neighbour counts
HELD_WORDS = 1_500_000  # words in the dictionaries of the blocks that are counted or looked up at once
BLOCK_TOKENS, BLOCK_WORDS = 1 << 19, 60_000  # a block is closed after the document that reaches one of them
SPLIT = 1_000  # documents whose texts are split at once
TOTALS = b" "  # no word is a space


@dataclass(frozen=True)
class Settings:
    head: int = 262_144
    assigned: int = 16_384
    clustered: int = 1_024
    classes: int = 64
    passes: int = 8
    backoff: float = 20.0


def tokens(text: str | None) -> list[bytes]:
    """The words of a text, A-Z in lower case, and the end token."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    words.append(END)
    return words


def form(word: bytes) -> int:
    """One of FORMS classes by the look of a word."""
    last = word[-1:]
    if last in (b".", b"!", b"?"):
        return 0
    if last in (b",", b";", b":"):
        return 1
    if any(48 <= b <= 57 for b in word):
        return 2
    if max(word, default=0) > 127:
        return 3
    if not word.isalpha():
        return 4
    return 5 if len(word) <= 4 else 6 if len(word) <= 8 else 7


# What a byte says about its word: a digit, above ASCII, no letter.
LOOKS = np.array([(48 <= b <= 57) | (b > 127) << 1 | (not bytes([b]).isalpha()) << 2 for b in range(256)], np.uint8)
LAST = np.full(256, FORMS)
LAST[list(b".!?")], LAST[list(b",;:")] = 0, 1


def forms(words: pa.Array) -> np.ndarray:
    """``form`` of many words."""
    found = np.full(len(words), 4, np.int32)  # that of the empty word
    if not len(words):
        return found
    offsets = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1]
    filled = np.flatnonzero(np.diff(offsets))
    if not len(filled):
        return found
    data = np.frombuffer(words.buffers()[2], np.uint8)[:offsets[-1]]
    starts, ends = offsets[filled], offsets[filled + 1]
    look, last, size = np.bitwise_or.reduceat(LOOKS[data], starts), LAST[data[ends - 1]], ends - starts
    found[filled] = np.select([last < FORMS, look & 1 > 0, look & 2 > 0, look & 4 > 0, size <= 4, size <= 8],
                              [last, 2, 3, 4, 5, 6], 7)
    return found


# Tokens --------------------------------------------------------------------------------------------------------------

def split(texts: pa.Array) -> pa.ListArray:
    """``tokens`` of many texts."""
    texts = pc.ascii_trim_whitespace(pc.ascii_lower(texts.fill_null("")))
    # The space splits off an empty word, which is the end token; an empty text is that already.
    return pc.ascii_split_whitespace(pc.if_else(pc.equal(texts, ""), "", pc.binary_join_element_wise(texts, "", " ")))


def packed(numbers: np.ndarray) -> bytes:
    """Numbers from 0 on, in the fewest bytes that hold each; the last byte says how many."""
    kind = np.min_scalar_type(numbers.max(initial=0))
    return numbers.astype(kind).tobytes() + bytes([kind.itemsize])


def unpacked(value: pa.BinaryScalar) -> np.ndarray:
    raw = np.frombuffer(value.as_buffer(), np.uint8)
    return raw[:-1].view(f"u{raw[-1]}")


# ``sizes`` and ``counts`` are of the block's words, whose bytes stand in ``words`` without gaps.
BLOCKS = pa.schema([("block", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("train", pa.list_(pa.bool_())),
                    ("lengths", pa.list_(pa.int32())), ("ids", pa.binary()), ("words", pa.binary()), ("sizes", pa.binary()),
                    ("counts", pa.binary())])
BLOCKS_DDL = ("block long, doc_ids array<long>, train array<boolean>, lengths array<int>, ids binary, words binary, "
              "sizes binary, counts binary")


def _tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    block, guess, first = TaskContext.get().partitionId() << 32, 4 * BLOCK_WORDS, pa.array([END.decode()])

    def given(rows: pa.Table, last: bool) -> Iterator[pa.RecordBatch]:
        """The blocks of these documents (doc_id, train, words); returns what the next batch may go on with."""
        nonlocal block, guess
        doc_ids, train, lists = (c.chunk(0) if c.num_chunks == 1 else pa.concat_arrays(c.chunks) for c in rows.columns)
        at, many, bounds, learn = 0, len(lists), lists.offsets.to_numpy().astype(np.int64), train.to_numpy(zero_copy_only=False)
        while at < many:
            while True:
                to = min(max(int(np.searchsorted(bounds, bounds[at] + guess, "right")) - 1, at + 1), many)
                words = pa.concat_arrays([first, lists.values[bounds[at]:bounds[to]]]).dictionary_encode()
                ids, ends = words.indices.to_numpy(), bounds[at + 1:to + 1] - bounds[at]
                # Numbers are in order of appearance.
                distinct = np.maximum.accumulate(ids)[ends] + 1
                full = np.flatnonzero((ends >= BLOCK_TOKENS) | (distinct >= BLOCK_WORDS))
                if len(full) or to == many:
                    break
                guess *= 2
            if not len(full) and not last:
                break
            n = int(full[0]) + 1 if len(full) else to - at
            ids, kinds, lengths = ids[1:ends[n - 1] + 1], words.dictionary[:distinct[n - 1]], np.diff(ends[:n], prepend=0)
            counts = np.bincount(ids[np.repeat(learn[at:at + n], lengths)], minlength=len(kinds))
            offsets = np.frombuffer(kinds.buffers()[1], np.int32)[:len(kinds) + 1]
            bytes_ = b"".join([kinds.buffers()[2][:offsets[-1]]]) if offsets[-1] else b""
            row = [block, doc_ids[at:at + n].to_pylist(), learn[at:at + n], lengths, packed(ids), bytes_,
                   packed(np.diff(offsets)), packed(counts)]
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, BLOCKS)], schema=BLOCKS)
            at, block, guess = at + n, block + 1, len(ids) * 5 // 4
        return rows.slice(at)

    rest = None
    for batch in batches:
        for i in range(0, batch.num_rows, SPLIT):
            some = batch.slice(i, SPLIT)
            rows = pa.table([some.column(0), some.column(2), split(some.column(1))], names=["doc_id", "train", "words"])
            rest = yield from given(rows if rest is None else pa.concat_tables([rest, rows]), False)
    if rest is not None and rest.num_rows:
        yield from given(rest, True)
    pa.default_memory_pool().release_unused()  # the worker goes on with other tasks


def tokenise(docs: DataFrame) -> DataFrame:
    """Blocks of documents (doc_id, text, train), written to the shared folder since all passes read them. ``counts`` are
    those of the training documents."""
    small_batches(docs.sparkSession)
    return stored(docs.select(F.col("doc_id").cast("long"), "text", F.coalesce("train", F.lit(False)))
                  .mapInArrow(_tokenise, BLOCKS_DDL), "blocks", **LARGE_ROWS)


@dataclass
class Block:
    """A row of a frame of blocks, as far as it has these columns."""

    row: dict

    @classmethod
    def each(cls, batches: Iterator[pa.RecordBatch]) -> Iterator["Block"]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield cls({name: batch.column(name)[i] for name in batch.schema.names})

    @classmethod
    def grouped(cls, batches: Iterator[pa.RecordBatch]) -> Iterator[list["Block"]]:
        """Blocks whose dictionaries have HELD_WORDS words together, whatever batches they come in."""
        held, many = [], 0
        for block in cls.each(batches):
            held.append(block)
            many += len(unpacked(block.row["sizes"]))
            if many >= HELD_WORDS:
                yield held
                held, many = [], 0
        if held:
            yield held

    def array(self, name: str) -> np.ndarray:
        return self.row[name].values.to_numpy(zero_copy_only=False)

    @property
    def ids(self) -> np.ndarray:
        return unpacked(self.row["ids"])

    @property
    def words(self) -> pa.Array:
        sizes = unpacked(self.row["sizes"])
        offsets = np.zeros(len(sizes) + 1, np.int32)
        np.cumsum(sizes, out=offsets[1:])
        return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), self.row["words"].as_buffer()])

    def learned(self) -> np.ndarray:
        """Places of the words of training documents."""
        return np.flatnonzero(unpacked(self.row["counts"]))

    def adjacent(self) -> tuple[np.ndarray, np.ndarray]:
        """Places of the words of adjacent tokens of the training documents: (previous, this). Before a text is the end
        token, which is at 0."""
        train, lengths = self.array("train"), self.array("lengths")
        now = self.ids[np.repeat(train, lengths)].astype(np.intp)
        before = np.roll(now, 1)
        before[np.cumsum(lengths[train]) - lengths[train]] = 0
        return before, now


LEARN = ("train", "lengths", "ids", "words", "sizes", "counts")


def places(words: list[pa.Array], listed: pa.Array) -> list[np.ndarray]:
    """For each of several arrays of words their places in ``listed``, -1 if not there."""
    found = pc.index_in(pa.chunked_array(words, pa.binary()), value_set=listed).fill_null(-1).to_numpy()
    return np.split(found, np.cumsum([len(w) for w in words])[:-1])


def together(blocks: list[Block]) -> tuple[pa.Array, list[np.ndarray], list[np.ndarray]]:
    """The distinct words that training documents of these blocks have, and for each block the places of its own among them
    and in its dictionary."""
    at = [block.learned() for block in blocks]
    words = pa.chunked_array([block.words.take(pa.array(a)) for block, a in zip(blocks, at)], pa.binary())
    parts = words.dictionary_encode().unify_dictionaries().chunks
    numbers = np.concatenate([part.indices.to_numpy() for part in parts])
    return parts[0].dictionary, np.split(numbers, np.cumsum([len(a) for a in at])[:-1]), at


# Counting ------------------------------------------------------------------------------------------------------------

def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for blocks in Block.grouped(batches):
        words, numbers, at = together(blocks)
        total = np.zeros(len(words), np.int64)
        for block, number, used in zip(blocks, numbers, at):
            total[number] += unpacked(block.row["counts"])[used].astype(np.int64)
        for i in range(0, len(words), 50_000):
            yield pa.RecordBatch.from_arrays([words[i:i + 50_000], pa.array(total[i:i + 50_000])], names=["word", "c"])


def vocabulary(blocks: DataFrame) -> DataFrame:
    """(word, c) of all training texts, written to the shared folder since several jobs read it."""
    rows = blocks.select("words", "sizes", "counts").mapInArrow(_counted, "word binary, c long")
    return stored(rows.groupBy("word").agg(F.sum("c").alias("c")), "vocabulary")


PART = 16  # bits of a cell's number within its part
SUMS = np.dtype([("cell", "<u2"), ("n", "<i8")])


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (part, SUMS records) of whole parts to one row per part, with a sum for each of its cells."""
    sums = {}
    for batch in batches:
        for part, records in zip(batch.column(0).to_pylist(), batch.column(1)):
            found = np.frombuffer(records.as_buffer(), SUMS)
            sums.setdefault(part, np.zeros(1 << PART, np.int64))[found["cell"]] += found["n"]
    for part, total in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                                         names=["part", "cells"])


def count_cells(blocks: DataFrame, words: bytes, size: int, cells: int,
                terms: Callable[[np.ndarray], list[tuple[np.ndarray, np.ndarray]]]) -> np.ndarray:
    """Counts of cells over all adjacent tokens of the training texts.

    ``terms`` gets the numbers of a block's words among the first ``size`` (else -1) and gives pairs of arrays (x, y): a word
    after another counts in cell x[previous] + y[this], unless that is ``cells`` or more. Each task adds up a dense array and
    gives out what is not zero, packed; the total is bounded by ``cells``.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, total, kept = pa.array(words.split(b"\n")[:size], pa.binary()), np.zeros(cells, np.int64), []

        def add() -> None:
            if kept:
                total[:] += np.bincount(np.concatenate(kept), minlength=cells)[:cells]
                kept.clear()

        for block in Block.each(batches):
            before, now = block.adjacent()
            for x, y in terms(places([block.words], listed)[0]):
                kept.append(x[before] + y[now])
            if sum(map(len, kept)) >= CHUNK:
                add()
        add()
        hit = np.flatnonzero(total)
        part = hit >> PART
        for number, at in zip(*np.unique(part, return_index=True)):
            some = hit[at:np.searchsorted(part, number, "right")]
            records = np.empty(len(some), SUMS)
            records["cell"], records["n"] = some & ((1 << PART) - 1), total[some]
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), pa.array([records.tobytes()], pa.binary())],
                                             names=["part", "cells"])

    kind = "part int, cells binary"
    rows = blocks.select(*LEARN).mapInArrow(run, kind).repartition("part").mapInArrow(_added, kind).toArrow()
    sums = np.zeros((-(-cells >> PART), 1 << PART), np.int64)
    for part, found in zip(rows.column(0).to_pylist(), rows.column(1)):
        sums[part] = np.frombuffer(found.as_buffer(), np.int64)
    return sums.reshape(-1)[:cells]


# Clustering ----------------------------------------------------------------------------------------------------------

def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1.0))


def _gain(pairs: np.ndarray, right: np.ndarray, left: np.ndarray, own: float) -> np.ndarray:
    """Change of the clustering objective when a word with these neighbour counts joins each class."""
    now = _xlogx(pairs)
    rows, columns = _xlogx(pairs + right[None, :]) - now, _xlogx(pairs + left[:, None]) - now
    same = np.diagonal(pairs)
    change = (rows.sum(1) - np.diagonal(rows)) + (columns.sum(0) - np.diagonal(columns))
    change += _xlogx(same + right + left + own) - _xlogx(same)
    # The word's neighbours add to the totals of their own classes wherever it goes.
    out, into = pairs.sum(1) + left, pairs.sum(0) + right
    change -= _xlogx(out + right.sum() + own) - _xlogx(out)
    return change - (_xlogx(into + left.sum() + own) - _xlogx(into))


def exchange(counts: np.ndarray, start: np.ndarray, free: int, classes: int, passes: int) -> np.ndarray:
    """Classes of the words 0 .. free - 1 by exchange; the others keep theirs. ``counts[a, b]``: b follows a."""
    group = start.copy()
    total = int(group.max()) + 1
    member = np.zeros((len(group), total))
    member[np.arange(len(group)), group] = 1.0
    after, before = counts @ member, counts.T @ member  # per word: tokens of each class after and before it
    pairs = member.T @ after
    for _ in range(passes):
        moved = 0
        for word in range(free):
            old, own = group[word], counts[word, word]
            right, left = after[word].copy(), before[word].copy()
            right[old] -= own
            left[old] -= own
            pairs[old, :] -= right
            pairs[:, old] -= left
            pairs[old, old] -= own
            gain = _gain(pairs, right, left, own)[:classes]
            new = int(np.argmax(gain))
            if gain[new] <= gain[old] + 1e-9:
                new = old
            pairs[new, :] += right
            pairs[:, new] += left
            pairs[new, new] += own
            if new != old:
                moved += 1
                group[word] = new
                after[:, old] -= counts[:, word]
                after[:, new] += counts[:, word]
                before[:, old] -= counts[word, :]
                before[:, new] += counts[word, :]
        if not moved:
            break
    return group


# Rarer words ---------------------------------------------------------------------------------------------------------

CELL = np.dtype([("cell", "<i2"), ("n", "<u4")])  # counts of one task


def heads(values: np.ndarray) -> np.ndarray:
    """The first place of each distinct one of sorted values."""
    return np.flatnonzero(np.concatenate([np.ones(min(len(values), 1), bool), values[1:] != values[:-1]]))


def _neighbours(words: bytes, near: np.ndarray, wide: int):
    """Blocks to (word, cells): per word without a class, how often each class comes after it (cell: the class) and
    before it (cell: ``wide`` + the class), as CELL records. ``near`` has the classes of ``words``, and last that of all
    others. The row of TOTALS has the pairs of classes."""
    names = ["word", "cells"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = pa.array(words.split(b"\n"), pa.binary())
        total = np.zeros(wide * wide, np.int64)

        def given(blocks: list[Block]) -> Iterator[pa.RecordBatch]:
            found, numbers, used = together(blocks)
            place = places([found], listed)[0].astype(np.int64)
            others, class_of = place < 0, near[place]  # that of all others is the last
            # A word's cells: after it, the class; before it, ``wide`` + the class.
            own, kept = np.arange(len(found)) * 2 * wide, []
            for block, number, at in zip(blocks, numbers, used):
                word = np.zeros(int(at[-1]) + 1 if len(at) else 0, np.int32)
                word[at] = number
                before, now = (word[x] for x in block.adjacent())
                one, two = class_of[before], class_of[now]
                total[:] += np.bincount(one * wide + two, minlength=wide * wide)
                a, b = np.flatnonzero(others[before]), np.flatnonzero(others[now])
                kept += [own[before[a]] + two[a], own[now[b]] + wide + one[b]]
            codes = np.concatenate(kept)
            kept.clear()
            codes.sort()  # in place: this is the largest array of the task
            first = heads(codes)
            records = np.empty(len(first), CELL)
            records["n"] = np.diff(first, append=len(codes))
            word, records["cell"] = np.divmod(codes[first], 2 * wide)
            del codes, first
            starts = heads(word)
            word, ends = word[starts], np.append(starts, len(records))
            for i in range(0, len(word), 50_000):
                part = slice(ends[i], ends[min(i + 50_000, len(word))])
                offsets = (ends[i:i + 50_001] - ends[i]).astype(np.int32) * CELL.itemsize
                cells = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(
                    records[part].tobytes())])
                yield pa.RecordBatch.from_arrays([found.take(pa.array(word[i:i + 50_000])), cells], names=names)

        held, many = [], 0
        for block in Block.each(batches):
            held.append(block)
            many += int(block.array("lengths").sum(dtype=np.int64))
            if many >= HELD:
                yield from given(held)
                held, many = [], 0
        if held:
            yield from given(held)
        hit = np.flatnonzero(total)
        records = np.empty(len(hit), CELL)
        records["cell"], records["n"] = hit, total[hit]
        yield pa.RecordBatch.from_arrays([pa.array([TOTALS], pa.binary()), pa.array([records.tobytes()], pa.binary())],
                                         names=names)
    return run


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        records = np.frombuffer(b"".join(batch.column(0).to_pylist()), CELL)
        yield pa.RecordBatch.from_arrays([pa.array(records["cell"].astype(np.int32)), pa.array(records["n"].astype(np.int64))],
                                         names=["cell", "n"])


SMALL = 16  # neighbour counts whose part of the gain is worked out once


def _steps(pairs: np.ndarray, classes: int, n: np.ndarray) -> np.ndarray:
    """Per count and cell what that count changes in the neighbour's class, for each class that the word may join."""
    both = np.concatenate([pairs[:classes, :], pairs[:, :classes].T], 1).T  # a row per cell
    return _xlogx(both + n[:, None, None]) - _xlogx(both)


def best_classes(pairs: np.ndarray, word: np.ndarray, cell: np.ndarray, n: np.ndarray, classes: int,
                 steps: np.ndarray | None = None) -> np.ndarray:
    """The class with the largest ``_gain`` for each of the words 0, 1, ..., from the neighbour counts that are not zero.

    ``cell[i]`` is a class after the word, or ``len(pairs)`` + a class before it; ``word`` ascends. ``steps`` are those of the
    whole counts below SMALL, if they are at hand.
    """
    wide, many = len(pairs), int(word[-1]) + 1 if len(word) else 0
    dense = np.zeros((many, 2 * wide))
    np.add.at(dense, (word, cell), n)
    word, cell = np.nonzero(dense)
    n = dense[word, cell]
    right, left = dense[:, :wide], dense[:, wide:]
    # Change of what is in the class of the neighbour, without the diagonal.
    both = np.concatenate([pairs[:classes, :], pairs[:, :classes].T], 1).T  # a row per cell
    if steps is None:
        part = _xlogx(both[cell] + n[:, None]) - _xlogx(both)[cell]
    else:
        part = steps[np.where(n < SMALL, n, 0).astype(np.intp), cell]
        large = np.flatnonzero(n >= SMALL)
        part[large] = _xlogx(both[cell[large]] + n[large, None]) - _xlogx(both)[cell[large]]
    own = cell % wide
    inside = np.flatnonzero(own < classes)
    part[inside, own[inside]] = 0.0
    gain = np.add.reduceat(part, np.searchsorted(word, np.arange(many)), 0) if many else np.zeros((0, classes))
    same = np.diagonal(pairs)[:classes]
    gain += _xlogx(same + right[:, :classes] + left[:, :classes]) - _xlogx(same)
    out, into = pairs.sum(1)[:classes] + left[:, :classes], pairs.sum(0)[:classes] + right[:, :classes]
    gain -= _xlogx(out + right.sum(1, keepdims=True)) - _xlogx(out)
    gain -= _xlogx(into + left.sum(1, keepdims=True)) - _xlogx(into)
    return np.argmax(gain, 1)


def _assign(pairs: np.ndarray, classes: int):
    """Rows (word, cells) in order of the word to (word, c, class, form)."""
    wide = len(pairs)
    steps = _steps(pairs, classes, np.arange(SMALL))

    def judged(rows: pa.Table) -> pa.RecordBatch:
        words = rows.column(0).combine_chunks()
        new = np.append(True, pc.not_equal(words[1:], words[:-1]).to_numpy(zero_copy_only=False))
        cells = rows.column(1).combine_chunks()
        records = np.frombuffer(b"".join(cells.to_pylist()), CELL)
        word = np.repeat(np.cumsum(new) - 1, pc.binary_length(cells).to_numpy(zero_copy_only=False) // CELL.itemsize)
        cell, n = records["cell"].astype(np.int64), records["n"].astype(np.int64)
        kinds = words.filter(pa.array(new))
        counts = np.bincount(word, weights=n * (cell < wide), minlength=len(kinds)).astype(np.int64)
        # Words that occur once with the same neighbours are one case.
        alone = np.bincount(word, weights=np.where(cell < wide, cell * wide, cell - wide), minlength=len(kinds)).astype(np.int64)
        key = np.where(counts == 1, alone, wide * wide + np.arange(len(kinds)))
        _, first, case = np.unique(key, return_index=True, return_inverse=True)
        found = np.zeros(len(kinds), np.int64)
        chosen = np.sort(first)
        place = np.full(len(kinds), -1)
        for i in range(0, len(chosen), 2_000):
            some = chosen[i:i + 2_000]
            place[:] = -1
            place[some] = np.arange(len(some))
            take = place[word] >= 0
            found[some] = best_classes(pairs, place[word[take]], cell[take], n[take], classes, steps)
        return pa.RecordBatch.from_arrays([kinds, pa.array(counts), pa.array(found[first][case].astype(np.int32)),
                                           pa.array(forms(kinds))], names=["word", "c", "class", "form"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch])
            # The last word may go on in the next batch.
            same = pc.equal(rows.column(0), rows.column(0)[-1]).to_numpy()
            at = int(np.argmax(same))
            if at:
                yield judged(rows.slice(0, at))
            held = rows.slice(at)
        if held is not None:
            yield judged(held)
    return run


# The model -----------------------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Model:
    words: bytes  # the head, most frequent first, one per line
    counts: np.ndarray  # of the head words
    # Their classes. Class ``end`` is the end token's; then come FORMS classes by form, then the rarer halves of the others.
    group: np.ndarray
    end: int
    emission: np.ndarray  # log10, of the head words
    rare_total: np.ndarray  # log10 of the tokens of the rarer half of each class
    form_total: np.ndarray  # log10 of what counts in a class by form are divided by
    train_tokens: int
    train_words: int  # distinct
    backoff: float
    transition: np.ndarray | None = None  # log10

    @property
    def rare(self) -> int:
        """The first class of rarer words."""
        return self.end + 1 + FORMS


def train(texts: DataFrame, settings: Settings = Settings()) -> tuple[Model, DataFrame]:
    """The model of a one-column frame of texts, and the words that are not in its head: (word, c, class, form)."""
    blocks = tokenise(texts.select(F.lit(None).cast("long").alias("doc_id"), F.col(texts.columns[0]).alias("text"),
                                   F.lit(True).alias("train")))
    model, rarer = cluster(blocks, settings)
    return with_transitions(model, encode(blocks, model, rarer)), rarer


def cluster(blocks: DataFrame, settings: Settings = Settings()) -> tuple[Model, DataFrame]:
    """The model of the training documents, without transitions, and the words that are not in its head: (word, c, class,
    form)."""
    if 2 * settings.classes + 1 + FORMS > 255:
        raise ValueError("a class must fit a byte")
    vocab = vocabulary(blocks)
    total, distinct = vocab.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    short = (F.octet_length("word") <= LONGEST) & (F.octet_length("word") > 0)
    top, _ = most_frequent(vocab.where(short), settings.assigned - 1)
    ends = vocab.where(F.octet_length("word") == 0).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    # The end token is word 0.
    words = [END, *top["word"].to_pylist()]
    listed = b"\n".join(words)
    k, end = settings.classes, settings.classes
    clustered, assigned = min(settings.clustered, len(words)), len(words)

    # Pairs of the clustered words; the last number stands for all other words.
    side = clustered + 1

    def follows(number: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        number = np.where(number < 0, clustered, number)
        return [(number * side, number)]

    pairs = count_cells(blocks, listed, clustered, side * side, follows).reshape(side, side).astype(float)
    order = [*range(1, clustered), 0, clustered]  # the free words first
    start = np.array([i % k for i in range(clustered - 1)] + [k, k + 1])
    group_of = np.zeros(side, np.int64)
    group_of[order] = exchange(pairs[np.ix_(order, order)], start, clustered - 1, k, settings.passes)

    # Neighbour classes of the next words: k classes, the end, and all others.
    wide = k + 2
    near = np.full(assigned + 1, k + 1)
    near[:clustered] = group_of[:clustered]

    cells = assigned * 2 * wide

    def neighbours(number: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        own, class_of = np.where(number < 0, cells, number * 2 * wide), near[number]
        return [(own, class_of), (wide + class_of, own)]

    profile = count_cells(blocks, listed, assigned, cells, neighbours).reshape(assigned, 2, wide)
    member = np.zeros((side, wide))
    member[np.arange(side), group_of] = 1.0
    classes_now = member.T @ pairs @ member
    known = near.copy()
    for word in range(clustered, assigned):
        right, left = profile[word].astype(float)
        known[word] = int(np.argmax(_gain(classes_now, right, left, 0.0)[:k]))

    # All other words, from their neighbours among these.
    rows = stored(blocks.select(*LEARN).mapInArrow(_neighbours(listed, known, wide), "word binary, cells binary"), "neighbours")
    classes_now = np.zeros(wide * wide)
    for cell, n in (rows.where(F.col("word") == F.lit(TOTALS)).select("cells").mapInArrow(_unpacked, "cell int, n long")
                    .groupBy("cell").agg(F.sum("n").alias("n")).collect()):
        classes_now[cell] = n
    others = stored(rows.where(F.col("word") != F.lit(TOTALS)).repartition("word").sortWithinPartitions("word").mapInArrow(
        _assign(classes_now.reshape(wide, wide), k), "word binary, c long, class int, form int"), "classes")
    more, least = most_frequent(others.where(short), settings.head - assigned, "class")
    rarer = others.where(~(short & (F.col("c") >= least))) if least is not None else others

    words += more["word"].to_pylist()
    counts = np.concatenate([[ends], top["c"].to_numpy(), more["c"].to_numpy()]).astype(np.int64)
    group = np.concatenate([known[:assigned], more["class"].to_numpy()]).astype(np.int64)
    group[0] = end
    in_cluster = np.bincount(group, weights=counts, minlength=end + 1)
    emission = np.log10(np.maximum(counts, 1)) - np.log10(np.maximum(in_cluster[group], 1))
    rare, by_form = np.ones(k), np.ones(FORMS)
    for class_, form_, c, n in rarer.groupBy("class", "form").agg(F.sum("c"), F.count(F.lit(1))).collect():
        rare[class_] += c
        by_form[form_] += c + n
    return Model(b"\n".join(words), counts, group, end, emission, np.log10(np.maximum(rare - 1, 1)), np.log10(by_form),
                 int(total), int(distinct), settings.backoff), rarer


def with_transitions(model: Model, coded: DataFrame) -> Model:
    """The model with the class pairs of the training texts, as ``encode`` gives them."""
    many, end = model.rare + model.end, model.end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(many * many, np.int64)
        for batch in batches:
            for classes, unseen in zip(batch.column(0), batch.column(1)):
                now, other = (np.frombuffer(x.as_buffer(), np.uint8).astype(np.int64) for x in (classes, unseen))
                pairs = [(a[:-1] * many + b[1:])[(a[:-1] < 255) & (b[1:] < 255)]
                         for a in (np.append(end, now), np.append(255, other))
                         for b in (np.append(end, now), np.append(255, other))]
                total += np.bincount(np.concatenate(pairs), minlength=many * many)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit.astype(np.int32)), pa.array(total[hit])], names=["cell", "n"])

    moves = np.zeros(many * many)
    for cell, n in (coded.select("classes", "unseen").mapInArrow(run, "cell int, n long").groupBy("cell")
                    .agg(F.sum("n").alias("n")).collect()):
        moves[cell] = n
    moves = moves.reshape(many, many)
    share = (moves.sum(0) + 1) / (moves.sum() + many)
    transition = np.log10((moves + model.backoff * share) / (moves.sum(1, keepdims=True) + model.backoff))
    return replace(model, transition=transition)


def most_frequent(vocab: DataFrame, size: int, *more: str) -> tuple[pa.Table, int | None]:
    """At most ``size`` words with their counts, most frequent first, and the least of these counts.

    All words down to the least count with which they still fit: that count comes from a histogram of the counts, so
    that no task has to sort or send more than its share of the words.
    """
    falling = Window.orderBy(F.desc("c")).rowsBetween(Window.unboundedPreceding, 0)  # one row per distinct count
    histogram = vocab.groupBy("c").agg(F.count(F.lit(1)).alias("n")).withColumn("words", F.sum("n").over(falling))
    least = histogram.where(F.col("words") <= size).agg(F.min("c")).first()[0]
    found = vocab.where(F.col("c") >= least) if least is not None else vocab.limit(0)
    return found.select("word", "c", *more).toArrow().sort_by([("c", "descending"), ("word", "ascending")]), least


def _outside(model: Model):
    """Blocks to the words outside the head: (block, word, place in the block's dictionary)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = pa.array(model.words.split(b"\n"), pa.binary())
        for blocks in Block.grouped(batches):
            words = [block.words for block in blocks]
            for block, listed, number in zip(blocks, words, places(words, head)):
                outside = np.flatnonzero(number < 0).astype(np.int32)
                for at in range(0, len(outside), 100_000):
                    part = pa.array(outside[at:at + 100_000])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), block.row["block"].as_py())),
                                                      listed.take(part), part], names=["block", "word", "at"])
    return run


NUMBERED = "block long, doc_ids array<long>, train array<boolean>, lengths array<int>, ids binary, numbers binary"


def _numbered(model: Model):
    """Blocks with numbers in place of their words: those of the head, else -1 - form."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = pa.array(model.words.split(b"\n"), pa.binary())
        names = [c.split()[0] for c in NUMBERED.split(", ")]
        for blocks in Block.grouped(batches):
            words = [block.words for block in blocks]
            for block, listed, number in zip(blocks, words, places(words, head)):
                found = np.where(number < 0, -1 - forms(listed), number)
                same = [pa.array([block.row[n].as_py()], BLOCKS.field(n).type) for n in names[:-1]]
                yield pa.RecordBatch.from_arrays([*same, pa.array([found.tobytes()], pa.binary())], names=names)
    return run


CODED = ("doc_id long, train boolean, n_tokens long, n_known long, base double, model double, classes binary, unseen binary")


def _placed(model: Model):
    """Blocks with what is known of their rarer words to documents with the classes of their tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.binary()]
        for block in Block.each(batches):
            number = np.frombuffer(block.row["numbers"].as_buffer(), np.int32)
            inside, look = np.flatnonzero(number >= 0), np.maximum(-1 - number, 0)
            # Unseen, unless one of the next two says otherwise.
            group, emission = (model.end + 1 + look).astype(np.uint8), -model.form_total[look]
            base, known = np.zeros(len(number)), np.zeros(len(number), np.int64)
            unseen = np.full(len(number), 255, np.uint8)
            number = number[inside]
            group[inside], emission[inside] = model.group[number], model.emission[number]
            base[inside], known[inside] = np.log10(model.counts[number] + 1.0), model.counts[number] > 0
            if block.row["rarer"].is_valid:
                at, class_, c = (block.row["rarer"].values.field(i).to_numpy(zero_copy_only=False) for i in range(3))
                group[at], emission[at] = model.rare + class_, np.log10(c) - model.rare_total[class_]
                base[at], known[at] = np.log10(c + 1.0), 1
                once = at[c == 1]
                unseen[once] = model.end + 1 + look[once]
            ids, lengths = block.ids, block.array("lengths")
            ends = np.cumsum(lengths)
            starts = ends - lengths
            sums = [np.add.reduceat(x[ids], starts) for x in (known, base, emission)]
            classes, other = group[ids].tobytes(), unseen[ids].tobytes()
            cut = lambda whole: [whole[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
            columns = [block.row["doc_ids"].values, block.row["train"].values, lengths.astype(np.int64), *sums, cut(classes),
                       cut(other)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) if not isinstance(c, pa.Array) else c for c, t in zip(
                columns, types)], names=[c.split()[0] for c in CODED.split(", ")])
    return run


def encode(blocks: DataFrame, model: Model, rarer: DataFrame) -> DataFrame:
    """A row for every document of the blocks: its counts, the part of its score within classes, the class of each token,
    and for words that occur once in training the class they would have unseen (255: none). Stored."""
    outside = blocks.select("block", "words", "sizes").mapInArrow(_outside(model), "block long, word binary, at int")
    found = (outside.join(rarer.select("word", F.col("class"), "c"), "word").groupBy("block")
             .agg(F.collect_list(F.struct("at", "class", "c")).alias("rarer")))  # at most the words of a block
    whole = (blocks.select("block", "doc_ids", "train", "lengths", "ids", "words", "sizes").mapInArrow(_numbered(model), NUMBERED)
             .join(found, "block", "left"))
    return stored(whole.mapInArrow(_placed(model), CODED), "coded")


def score(docs: DataFrame, model: Model, rarer: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score, perplexity) for every row of documents (doc_id, text)."""
    return score_coded(encode(tokenise(docs.select("doc_id", "text", F.lit(False).alias("train"))), model, rarer), model)


def score_coded(coded: DataFrame, model: Model) -> DataFrame:
    """``score`` of encoded documents."""
    transition, end = model.transition, model.end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            moved = []
            for classes in batch.column("classes"):
                now = np.frombuffer(classes.as_buffer(), np.uint8)
                moved.append(float(transition[np.append(end, now[:-1]), now].sum()))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "n_tokens", "n_known", "base")), pa.array(
                np.array(moved) + batch.column("model").to_numpy())], names=["doc_id", "n_tokens", "n_known", "base", "score"])

    base_total = float(np.log10(model.train_tokens + model.train_words + 1))
    return (coded.select("doc_id", "n_tokens", "n_known", "base", "model", "classes")
            .mapInArrow(run, "doc_id long, n_tokens long, n_known long, base double, score double").select(
        "doc_id", "n_tokens", "n_known", F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (F.col("base") - F.col("n_tokens") * F.lit(base_total)).alias("base_score"), "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity")))
