"""Toxicity as multiple-instance learning: a document is a bag of sentences, labels exist for documents only.

A sentence has p = sigmoid(bias + sum of its word weights), or 0 without a weighted word, so that length alone never
makes a text toxic; a document combines its sentences by noisy-or, P = 1 - prod(1 - p) = 1 - exp(-sum softplus(z)).
The weights are fitted to document labels through that formula; the sentence probabilities then point at the offending
sentences.

Training takes a bounded sample of labelled rows (``sample_rows``, by hash of the id; texts over ``sample_words`` words
do not take part in the fit). Words, and beginnings of words, that occur more in its toxic documents than chance
allows get a weight; of all other words the driver sees nothing. Scoring reads every whole text and broadcasts the few
words with a weight.

Defined cases: NULL or empty text has no sentence and scores 0.0. A label row with NULL label or NULL id is ignored;
several labels of one id count as their maximum, and of several texts of
one id the one with the smallest hash is trained on. Without both classes among the training rows every score is 0.0.
Repeated rows are scored alike. Other columns are untouched; an existing column with the name of the result is replaced.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import small_batches
from plumbline.session import durable

STRIP = " \t\n\r.,;:!?\"'()[]{}<>*#%&|…«»„“”’‘-"
CLOSING = "\"')]»”’"
ENDS = (".", "!", "?", "…")
PREFIXES = (4, 6)
FEATURES = 1 + len(PREFIXES)
TOKEN = re.compile(r"\S+")


@dataclass(frozen=True)
class Settings:
    bits: int = 18  # features are word hashes of so many bits
    sentence_words: int = 40  # a longer sentence is cut into instances of this length
    sample_rows: int = 20_000  # labelled documents to learn from, at most
    sample_words: int = 50_000  # longer documents are not learned from
    min_documents: int = 3  # a word must occur in so many documents of the sample
    evidence: float = 10.0  # least likelihood ratio (G squared) of a word with the toxic label to get a weight
    epochs: int = 200
    l2: float = 3e-6
    rate: float = 0.1
    threshold: float = 0.7


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # float32, one per feature
    bias: float
    settings: Settings = Settings()


class _Words(dict):
    """Raw word -> 4 * number + (2 if it has a weight) + (1 if it ends a sentence).

    ``features[number]`` has the word's FEATURES hashes: of the word without the punctuation around it, and of its first
    letters, which inflected forms share; 0 stands for none. With weights (feature -> weight), ``weight[number]`` is
    their sum and the features are not kept.
    """

    def __init__(self, bits: int, weights: dict[int, float] | None = None, limit: int = 400_000):
        super().__init__()
        self.mask, self.weights, self.limit = (1 << bits) - 1, weights, limit
        self.features: list[tuple[int, ...]] = []
        self.weight: list[float] = []

    def __missing__(self, raw: str) -> int:
        word = raw.strip(STRIP).lower()
        hashes = [1 + zlib.crc32(word.encode("utf-8", "replace")) % self.mask if word else 0]
        for n in PREFIXES:
            hashes.append(1 + zlib.crc32(f"{word[:n]}-".encode("utf-8", "replace")) % self.mask if len(word) >= n else 0)
        end = raw.endswith(ENDS) or raw.rstrip(CLOSING).endswith(ENDS)
        if self.weights is None:
            value = 4 * len(self.features) + end
            self.features.append(tuple(hashes))
        elif any(h in self.weights for h in hashes):
            value = 4 * len(self.weight) + 2 + end
            self.weight.append(sum(self.weights.get(h, 0.0) for h in hashes))
        else:
            value = int(end)
        self[raw] = value
        return value

    def between_texts(self) -> None:
        """Bounds the memory."""
        if len(self) >= self.limit:
            self.clear()
            self.features, self.weight = [], []


def bag(text: str | None, words: _Words, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all words, and the position at which each sentence starts. A line break ends a sentence too."""
    words.between_texts()
    codes: list[int] = []
    cuts = [0]
    for line in (text or "").split("\n"):
        codes.extend(map(words.__getitem__, line.split()))
        cuts.append(len(codes))
    if not codes:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = np.array(codes, dtype=np.int64)
    starts = np.unique(np.concatenate([np.array(cuts, np.int64), np.flatnonzero(code & 1) + 1]))
    starts = starts[starts < len(code)]
    lengths = np.diff(np.append(starts, len(code)))
    if lengths.max() > longest:
        parts = -(-lengths // longest)
        within = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        starts = np.repeat(starts, parts) + within * longest
    return code, starts


def noisy_or(logits: np.ndarray) -> float:
    return float(-np.expm1(-np.logaddexp(0.0, logits).sum())) if len(logits) else 0.0


def _document_counts(settings: Settings):
    """(text, label) to (feature, documents with it, toxic documents with it), summed within the task."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Words(settings.bits)
        spread, inside = np.zeros(1 << settings.bits, np.int64), np.zeros(1 << settings.bits, np.int64)
        for batch in batches:
            for text, label in zip(batch["text"], batch["label"]):
                features = _features(np.unique(bag(text, known, settings.sentence_words)[0] >> 2), known)
                spread[features] += 1
                inside[features] += int(label)
        hit = np.flatnonzero(spread)
        yield pd.DataFrame({"feature": hit, "spread": spread[hit], "inside": inside[hit]})
    return run


def _features(words: np.ndarray, known: _Words) -> np.ndarray:
    found = np.array([known.features[w] for w in words.tolist()], np.int64).reshape(-1)
    return np.unique(found[found > 0])


def _cells(kept: np.ndarray, settings: Settings):
    """(text, label) to (label, sentences, cells), a cell being sentence * len(kept) + column of a kept feature."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        column = np.full(1 << settings.bits, -1, np.int64)
        column[kept] = np.arange(len(kept))
        known = _Words(settings.bits)
        for batch in batches:
            rows = []
            for text, label in zip(batch["text"], batch["label"]):
                words, starts = bag(text, known, settings.sentence_words)
                if not 0 < len(words) <= settings.sample_words:
                    continue
                found = column[np.array([known.features[w] for w in (words >> 2).tolist()], np.int64)]
                at, which = np.nonzero(found >= 0)
                sentence = np.searchsorted(starts, at, side="right") - 1
                cells = np.unique(sentence * len(kept) + found[at, which])  # a feature counts once per sentence
                rows.append((int(label), len(starts), cells.astype("<i8").tobytes()))
            yield pd.DataFrame(rows, columns=["label", "sentences", "cells"])
    return run


def _threshold(ids: int, wanted: int) -> int:
    """A hash that somewhat more than ``wanted`` of so many ids stay below, so that only those are sorted, whatever the
    number of tasks. Uniform hashes leave fewer with odds below one in a million."""
    share = (1.1 * wanted + 1000) / max(ids, 1)
    return (1 << 63) - 1 if share >= 1 else int(share * 2 ** 64) - (1 << 63)


def train(docs: DataFrame, labels: DataFrame, allowed: Column | None = None, settings: Settings = Settings()) -> Model:
    """Fit on documents (doc_id, text) whose id has a label (doc_id, label) and satisfies ``allowed`` on the label row."""
    small_batches(docs.sparkSession)
    known = labels.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
    known = known.where(allowed) if allowed is not None else known
    labelled_ids = durable(known.groupBy("doc_id").agg(F.max("label").alias("label")))
    sample = (labelled_ids.where(F.xxhash64("doc_id") <= _threshold(labelled_ids.count(), settings.sample_rows))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.sample_rows))
    # One text of each sampled id, so sample_rows bounds the rows as well; stored, since three jobs read it.
    labelled = durable(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id").agg(
        F.min_by("text", F.xxhash64("text")).alias("text"), F.first("label").alias("label")).select("text", "label"))
    toxic, total = labelled.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count(F.lit(1))).first()
    counts = (labelled.mapInPandas(_document_counts(settings), "feature long, spread long, inside long")
              .groupBy("feature").agg(F.sum("spread").alias("spread"), F.sum("inside").alias("inside"))
              .where((F.col("spread") >= settings.min_documents)
                     & (F.col("inside") * total > F.col("spread") * toxic)).toPandas())
    kept = select_features(counts["feature"].to_numpy(np.int64), counts["spread"].to_numpy(float),
                           counts["inside"].to_numpy(float), toxic, total, settings)
    rows = labelled.mapInPandas(_cells(kept, settings), "label int, sentences int, cells binary").toPandas()
    return fit(rows["label"].to_numpy(np.int64), rows["sentences"].to_numpy(np.int64),
               [np.frombuffer(c, "<i8") for c in rows["cells"]], kept, settings)


def select_features(feature: np.ndarray, spread: np.ndarray, inside: np.ndarray, toxic: int, total: int,
                    settings: Settings) -> np.ndarray:
    if not 0 < toxic < total:
        return np.zeros(0, np.int64)
    g2 = _evidence(inside, spread, toxic, total)
    return np.sort(feature[(spread >= settings.min_documents) & (g2 >= settings.evidence)])


def fit(labels: np.ndarray, sentences: np.ndarray, cells: list[np.ndarray], kept: np.ndarray,
        settings: Settings) -> Model:
    """Adam on the noisy-or likelihood of the document labels, all documents in each step."""
    weights = np.zeros(1 << settings.bits, np.float32)
    if not len(labels) or labels.min() == labels.max():
        return Model(weights, 0.0, settings)
    m, first_sentence = len(kept), np.cumsum(sentences) - sentences
    at = np.concatenate([c // max(m, 1) + f for c, f in zip(cells, first_sentence)]).astype(np.int64)
    col = np.concatenate([c % max(m, 1) for c in cells]).astype(np.int64)
    used, row = np.unique(at, return_inverse=True)  # sentences without evidence take no part
    document, n = np.repeat(np.arange(len(labels)), sentences)[used], len(used)
    w = np.zeros(m + 1)  # the last one is the bias
    w[m] = -4.0
    first, second = np.zeros(m + 1), np.zeros(m + 1)
    toxic = labels == 1
    for step in range(1, settings.epochs + 1):
        z = np.bincount(row, weights=w[col], minlength=n) + w[m]
        total = np.bincount(document, weights=np.logaddexp(0, z), minlength=len(labels))
        # d loss / d total: 1 for a clean document, -1 / (exp(total) - 1) for a toxic one
        slope = np.where(toxic, -1 / np.expm1(np.clip(total, 1e-9, 500)), 1.0)
        gz = slope[document] / (1 + np.exp(-np.clip(z, -500, 500))) / len(labels)
        grad = np.append(np.bincount(col, weights=gz[row], minlength=m) + settings.l2 * w[:m], gz.sum())
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad * grad
        w -= settings.rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
    weights[kept] = w[:m]
    return Model(weights, float(w[m]), settings)


def _evidence(inside: np.ndarray, spread: np.ndarray, toxic: int, total: int) -> np.ndarray:
    """G squared of document counts: word against label; 0 where the word is not more frequent in toxic documents."""
    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-12) / np.maximum(expected, 1e-12)), 0.0)

    share = toxic / total
    g2 = 2 * (part(inside, spread * share) + part(spread - inside, spread * (1 - share))
              + part(toxic - inside, (total - spread) * share)
              + part(total - toxic - spread + inside, (total - spread) * (1 - share)))
    return np.where(inside > spread * share, g2, 0.0)


SCORED = "score double, sentences int, offending_start array<int>, offending_end array<int>"


def scorer(model: Model):
    """A column function: text -> (score, number of sentences, code point spans of sentences with p >= 0.5)."""
    heavy = np.flatnonzero(model.weights)
    given = dict(zip(heavy.tolist(), model.weights[heavy].tolist())), model.bias, model.settings

    @F.pandas_udf(SCORED)
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        weights, bias, settings = given
        known = _Words(settings.bits, weights)
        for texts in batches:
            rows = []
            for text in texts:
                words, starts = bag(text, known, settings.sentence_words)
                z = logits(words, starts, known.weight, bias)
                hit = np.flatnonzero(z >= 0)
                spans = _spans(text, starts, len(words), hit) if len(hit) else ([], [])
                rows.append((noisy_or(z), len(starts), *spans))
            yield pd.DataFrame(rows, columns=["score", "sentences", "offending_start", "offending_end"])
    return score


def logits(words: np.ndarray, starts: np.ndarray, weight: list[float], bias: float) -> np.ndarray:
    """One logit per sentence, minus infinity without a weighted word; a repeated word of a sentence counts once."""
    if not len(words):
        return np.zeros(0)
    heavy = np.flatnonzero(words & 2)
    sentence = np.searchsorted(starts, heavy, side="right") - 1
    cell = np.unique(sentence * (1 << 32) + (words[heavy] >> 2))
    weights = [weight[w] for w in (cell & 0xFFFFFFFF).tolist()]
    z = np.bincount(cell >> 32, weights=weights, minlength=len(starts)) + bias
    z[np.bincount(cell >> 32, minlength=len(starts)) == 0] = -np.inf
    return z


def _spans(text: str, starts: np.ndarray, n: int, hit: np.ndarray) -> tuple[list[int], list[int]]:
    """First and last code point (exclusive) of the sentences ``hit``."""
    ends = np.append(starts[1:], n) - 1
    first, last = set(starts[hit].tolist()), set(ends[hit].tolist())
    begin, stop = [], []
    for i, m in enumerate(TOKEN.finditer(text)):
        if i in first:
            begin.append(m.start())
        if i in last:
            stop.append(m.end())
    return begin, stop


def score_documents(docs: DataFrame, model: Model, name: str = "toxicity") -> DataFrame:
    """The documents with one struct column (score, sentences, offending_start, offending_end)."""
    small_batches(docs.sparkSession)
    return docs.withColumn(name, scorer(model)(F.col("text")))


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The documents below the threshold, in their own columns, whatever their names."""
    rows = docs.select("text", F.struct("*").alias("__row__"))
    return (score_documents(rows, model, "__toxicity__")
            .where(F.col("__toxicity__")["score"] < model.settings.threshold).select("__row__.*"))
