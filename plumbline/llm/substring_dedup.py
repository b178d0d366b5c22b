"""Removal of repeated passages: a word goes if a window of ``length`` words around it also starts in an earlier document.

Seed and extend. Hashes of ``gram`` consecutive words are winnowed: each window selects the smallest of its hashes, the
rightmost on ties. What a window selects depends on its words alone, so two equal windows select the same anchor at the
same place, and a repeat of ``length`` words cannot be missed. Documents are joined on their anchors. An anchor is then
extended both ways, over all windows that select it:

* occurrences with the same whole extension repeat each other, and only the earliest document keeps it;
* where an anchor has several different extensions, one of each is cut into its windows, and equal windows meet.

Nothing is compared in pairs. A passage that very many documents share is combined on the map side to one row per task
with its smallest id, and goes back to its occurrences in a join with two plain sides, of which adaptive execution splits
a hot one. Covered windows that touch are one maximal repeat, a span of words.

Hashes of word sequences are polynomials over their bytes modulo 2 ** 64, taken from prefix sums; sequences are held
equal if two of them, with different bases, agree (128 bits). Texts are read three times and shuffled twice: to cut
extensions into windows (only texts that have some) and to take the spans out. Long texts go through in blocks.

Defined cases: NULL text has no words; a NULL id is later than all others, and such rows take nothing from each other;
rows of one id take nothing from each other; a text of fewer than ``length`` words stays whole, as do rows equal in id and
text; an empty table gives no rows. Other columns are not read, and clash with none of the temporary ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import stored

LENGTH, GRAM = 50, 12
BLOCK = 1 << 18  # windows looked at together
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd
MIX = np.uint64(0xFF51AFD7ED558CCD)
PLACE_BITS = 20
NO_ID = (1 << 63) - 1


class Powers:
    """Powers of a base and of its inverse modulo 2 ** 64, as far as they were asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        while len(self.up) < n:
            size = len(self.up)
            self.up = np.concatenate([self.up, self.up * np.uint64(pow(self.base, size, 1 << 64))])
            self.down = np.concatenate([self.down, self.down * np.uint64(pow(self.inverse, size, 1 << 64))])
        return self.up[:n], self.down[:n]


class Words:
    """Hashes of word sequences of a part of a text."""

    def __init__(self, words: list[bytes], powers: list[Powers]):
        joined = np.frombuffer(b" ".join(words), np.uint8)
        gaps = np.flatnonzero(joined == 32)
        self.begin, self.end = np.append(0, gaps + 1), np.append(gaps, len(joined))
        value = joined.astype(np.uint64) + np.uint64(1)
        self.sums, self.down = [], []
        for p in powers:
            up, down = p.upto(len(joined) + 1)
            sums = np.zeros(len(joined) + 1, np.uint64)
            np.cumsum(value * up[:-1], out=sums[1:])
            self.sums.append(sums)
            self.down.append(down)

    def hashes(self, first, last, which: int) -> np.ndarray:
        """Of the words first .. last, both inclusive."""
        a = self.begin[first]
        return (self.sums[which][self.end[last]] - self.sums[which][a]) * self.down[which][a]


def winnowed(words: Words, many: int, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first, last): for the windows 0 .. many - 1, the runs that select the same anchor."""
    reach = length - gram + 1
    at = np.arange(many + reach - 1)
    raw = words.hashes(at, at + gram - 1, 0)
    mixed = (raw ^ (raw >> np.uint64(32))) * MIX
    mask = np.uint64((1 << PLACE_BITS) - 1)
    least = (mixed & ~mask) | (mask - at.astype(np.uint64))  # of equal hashes the rightmost is smallest
    size = 1
    while 2 * size <= reach:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < reach:
        least = np.minimum(least[:many], least[reach - size:reach - size + many])
    place = (mask - (least[:many] & mask)).astype(np.int64)
    last = np.append(np.flatnonzero(np.diff(place)), many - 1)
    return raw[place[last]], np.append(0, last[:-1] + 1), last


def blocks(text: str | None, length: int) -> Iterator[tuple[int, int, list[bytes]]]:
    """(first window, windows, words) of the parts of a text; nothing for a short one."""
    words = (text or "").encode("utf-8", "replace").split()
    windows = len(words) - length + 1
    for first in range(0, windows, BLOCK):
        many = min(BLOCK, windows - first)
        yield first, many, words[first:first + many + length - 1]


def _batches(columns: list[list[np.ndarray]], names: list[str], types: list) -> pa.RecordBatch:
    whole = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in columns]
    for c in columns:
        c.clear()
    return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64) if c.dtype == np.uint64 else c).cast(t)
                                       for c, t in zip(whole, types)], names=names)


SEEDS = "t1 long, t2 long, doc long, anchor long, x1 long, x2 long, lo long, hi long"


def _seeds(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, names = [Powers(b) for b in BASES], [c.split()[0] for c in SEEDS.split(", ")]
        out: list[list[np.ndarray]] = [[] for _ in names]
        held = 0
        for batch in batches:
            for t1, t2, doc, text in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3)):
                for first, many, part in blocks(text.as_py(), length):
                    words = Words(part, powers)
                    anchor, lo, hi = winnowed(words, many, length, gram)
                    same = [np.full(len(lo), v, np.int64) for v in (t1, t2, doc)]
                    for column, value in zip(out, (*same, anchor, words.hashes(lo, hi + length - 1, 0),
                                                   words.hashes(lo, hi + length - 1, 1), lo + first, hi + first)):
                        column.append(value)
                    held += len(lo)
                    if held >= 200_000:
                        held = 0
                        yield _batches(out, names, [pa.int64()] * len(names))
        yield _batches(out, names, [pa.int64()] * len(names))
    return run


WINDOWS = "t1 long, t2 long, doc long, w1 long, w2 long, at long"


def _windows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, names = [Powers(b) for b in BASES], [c.split()[0] for c in WINDOWS.split(", ")]
        out: list[list[np.ndarray]] = [[] for _ in names]
        held = 0
        for batch in batches:
            for t1, t2, doc, text, runs in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3),
                                               batch.column(4)):
                ends = [runs.values.field(i).to_numpy() for i in range(2)]
                for first, many, part in blocks(text.as_py(), length):
                    here = (ends[0] >= first) & (ends[0] < first + many)  # a run lies in one block
                    if not here.any():
                        continue
                    words = Words(part, powers)
                    lo, size = ends[0][here] - first, ends[1][here] - ends[0][here] + 1
                    at = np.repeat(lo - np.cumsum(size) + size, size) + np.arange(size.sum())
                    same = [np.full(len(at), v, np.int64) for v in (t1, t2, doc)]
                    for column, value in zip(out, (*same, words.hashes(at, at + length - 1, 0),
                                                   words.hashes(at, at + length - 1, 1), at + first)):
                        column.append(value)
                    held += len(at)
                    if held >= 200_000:
                        held = 0
                        yield _batches(out, names, [pa.int64()] * len(names))
        yield _batches(out, names, [pa.int64()] * len(names))
    return run


def merged(lo: np.ndarray, hi: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal spans of words (end exclusive) covered by the windows lo .. hi of each range."""
    order = np.argsort(lo, kind="stable")
    begin, end = lo[order], np.maximum.accumulate(hi[order] + length)
    new = np.append(True, begin[1:] > end[:-1])
    return begin[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]


KEPT = "doc_id long, n_words long, n_removed long, text string, spans array<struct<first: int, stop: int>>"


def _kept(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first", pa.int32()), ("stop", pa.int32())]))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), kind]
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                rows = []
                part = batch.slice(at, 200)
                for doc_id, text, runs in zip(part.column(0).to_pylist(), part.column(1), part.column(2)):
                    words, spans, kept, done = (text.as_py() or "").encode("utf-8", "replace").split(), [], [], 0
                    if runs.is_valid:
                        spans = list(zip(*(x.tolist() for x in merged(*(runs.values.field(i).to_numpy() for i in range(2)),
                                                                      length))))
                    for first, stop in spans:
                        kept += words[done:first]
                        done = stop
                    kept += words[done:]
                    rows.append((doc_id, len(words), len(words) - len(kept), b" ".join(kept).decode("utf-8", "replace"),
                                 [{"first": a, "stop": b} for a, b in spans]))
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)],
                                                 names=[c.split()[0] for c in KEPT.split(", ", 4)])
    return run


def covered(texts: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(t1, t2, doc, lo, hi): ranges of windows that also start in an earlier document. ``texts`` has (t1, t2, doc, text):
    a 128-bit hash of the text, and the id by which documents are ordered."""
    if not 0 < gram <= length or BLOCK + length >= 1 << PLACE_BITS:
        raise ValueError("a gram must fit the window, and a block the bits of a place")
    seeds = stored(texts.select("t1", "t2", "doc", "text").mapInArrow(_seeds(length, gram), SEEDS), "seeds")
    anchors = stored(seeds.groupBy("anchor").agg(F.min("doc").alias("a"), F.max("doc").alias("b"), F.min("x1").alias("x"),
                                                 F.max("x1").alias("y"), F.min("x2").alias("u"), F.max("x2").alias("v"))
                     .where("a < b").selectExpr("anchor", "x <> y or u <> v as several"), "anchors")
    near = stored(seeds.join(anchors, "anchor"), "near")
    owners = stored(near.groupBy("anchor", "x1", "x2").agg(F.min("doc").alias("owner")), "owners")
    placed = stored(near.join(owners, ["anchor", "x1", "x2"]).where("doc > owner or several")
                    .selectExpr("t1", "t2", "doc", "lo", "hi", "doc > owner as whole"), "placed")
    # One of each extension of an anchor with several; repeated rows once.
    runs = (placed.where("not whole").groupBy("t1", "t2", "doc")
            .agg(F.array_sort(F.collect_set(F.struct("lo", "hi"))).alias("runs")))
    windows = stored(texts.join(stored(runs, "runs"), ["t1", "t2", "doc"]).select("t1", "t2", "doc", "text", "runs")
                     .mapInArrow(_windows(length), WINDOWS), "windows")
    earliest = stored(windows.groupBy("w1", "w2").agg(F.min("doc").alias("owner"), F.max("doc").alias("b"))
                      .where("owner < b").drop("b"), "earliest")
    cut = windows.join(earliest, ["w1", "w2"]).where("doc > owner")
    return placed.where("whole").select("t1", "t2", "doc", "lo", "hi").unionByName(
        cut.select("t1", "t2", "doc", F.col("at").alias("lo"), F.col("at").alias("hi")))


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Documents (doc_id, text) as (doc_id, n_words, n_removed, text, spans): ``text`` has the kept words with one space
    between, ``spans`` the removed ones."""
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))
    texts = docs.select(F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"), order.alias("doc"),
                        F.col("doc_id").cast("long").alias("doc_id"), "text")
    ranges = covered(texts, length, gram)
    spans = stored(ranges.groupBy("t1", "t2", "doc").agg(F.collect_set(F.struct("lo", "hi")).alias("runs")), "spans")
    return (texts.join(spans, ["t1", "t2", "doc"], "left").select("doc_id", "text", "runs")
            .mapInArrow(_kept(length), KEPT))
