"""Spelling variants: words that differ by one inserted, deleted or replaced code point, by a trie-node pair dictionary.

The nodes of the trie of all words are numbered, and those of the trie of all reversed words. A word of m code points is
then two arrays of integers: the nodes of its prefixes and of its suffixes. At every place the word gives two pairs
(prefix node, suffix node): one that skips the code point there, and one for a code point inserted there. Two words with
the same skipping pair differ by a replacement at that place; a word whose inserting pair is another's skipping pair lacks
that code point. All of this is exact: a node number stands for one prefix or suffix. A code point that follows itself can
be left out at several places with the same result; the last of them counts.

The words of one pair differ in one code point (or lack it), so a pair has at most as many words as the alphabet has
letters, and one more. Each of them learns how many others there are and which is the most frequent; pairs of words are
never listed.

Numbering: words are sorted by range and scanned once. A word shares the nodes of its common prefix with the word before
it and opens new ones after it. Only prefixes of a task's first word can have been opened by an earlier task; they are
matched with the last word of the task before it, by one row per task (its first and last word) on the driver. As words
are scanned in order, the number of a word's last node also stands for its place in code-point order.

Defined cases: NULL text has no words and a NULL id counts as the empty text; ties go to the smaller word; repeated rows
are counted as often as they occur; an empty table gives no rows. Other columns are not read. Words of any length are
taken; of a long one only integers are repeated.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import stored

# Fixed values of the contract.
RUN = "[a-zÀ-ÿ]+"  # of a text whose A-Z are in lower case
LETTERS, TIMES, DROP, RATIO = 7, 2, 31, 10
FLUSH = 600_000  # distinct words a task holds before it gives them out
TASK_SHIFT = 40  # of a node's number; below it the count within its task


# Words ---------------------------------------------------------------------------------------------------------------

def dropped(run: str, prefix: bytes, drop: int) -> str:
    """The run, without one code point where ``drop`` divides the crc32 of prefix and run."""
    h = zlib.crc32(prefix + run.encode())
    if h % drop:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _count(letters: int, drop: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, counts = re.compile(RUN).findall, Counter()

        def given() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()),
                                                pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                prefix = f"{'' if doc_id is None else doc_id}:".encode()
                lower = (text.as_py() or "").encode("utf-8", "replace").lower().decode()  # bytes: A-Z only
                for found, n in Counter(find(lower)).items():
                    if len(found) >= letters:
                        word = dropped(found, prefix, drop)
                        if len(word) >= letters:
                            counts[word] += n
                if len(counts) >= FLUSH:
                    yield given()
        yield given()
    return run


def words(docs: DataFrame, letters: int = LETTERS, times: int = TIMES, drop: int = DROP) -> DataFrame:
    """(word, n) of documents (doc_id, text): runs of letters, some with a code point dropped; at least ``letters`` code
    points and ``times`` occurrences."""
    counted = docs.select(F.col("doc_id").cast("string"), "text").mapInArrow(_count(letters, drop), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times)


# Numbering -----------------------------------------------------------------------------------------------------------

def common(a: str, b: str) -> int:
    """Length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle - 1
    return low


NODES = "text string, task int, nodes array<long>"


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted words with the nodes of their prefixes, from the empty one on. The first word's are 0, 1, ..."""
    task = TaskContext.get().partitionId()
    free, before, nodes = task << TASK_SHIFT, None, []
    for batch in batches:
        texts, lists = batch.column(0).to_pylist(), []
        for text in texts:
            old = 0 if before is None else common(before, text) + 1
            new = len(text) + 1 - old
            nodes = nodes[:old] + list(range(free, free + new))
            free, before = free + new, text
            lists.append(nodes)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([task] * len(texts), pa.int32()),
                                          pa.array(lists, pa.list_(pa.int64()))], names=["text", "task", "nodes"])


def trie(texts: DataFrame) -> DataFrame:
    """(text, nodes): the trie nodes of the prefixes of each text, from the empty one to the whole. ``texts`` is one
    column ``text`` of distinct values."""
    found = stored(texts.select("text").repartitionByRange("text").sortWithinPartitions("text").mapInArrow(_number, NODES),
                   "nodes")
    # One row per task, in order: what its first word shares with the last one before it has a number already.
    ends = found.groupBy("task").agg(F.min("text").alias("first"), F.max("text").alias("last"),
                                     F.max_by("nodes", "text").alias("nodes")).orderBy("task").collect()
    known, rows, nodes = "", [], []
    for r in ends:
        shared = nodes[:common(known, r["first"]) + 1]
        rows.append((r["task"], shared))
        base = r["task"] << TASK_SHIFT
        nodes = [shared[i] if i < len(shared) and x == base + i else x for i, x in enumerate(r["nodes"])]
        known = r["last"]
    shared = texts.sparkSession.createDataFrame(rows, "task int, shared array<long>")
    base = F.shiftleft(F.col("task").cast("long"), TASK_SHIFT)
    own = F.transform("nodes", lambda x, i: F.when((i < F.size("shared")) & (x == base + i), F.get("shared", i)).otherwise(x))
    return found.join(F.broadcast(shared), "task").select("text", own.alias("nodes"))


# Neighbours ----------------------------------------------------------------------------------------------------------

def numbered(counted: DataFrame) -> DataFrame:
    """(id, word, n, prefixes, suffixes) of distinct words (word, n). ``id`` ascends with the word; ``suffixes[j]`` is the
    node of the last j code points."""
    forward = trie(counted.select(F.col("word").alias("text"))).select(F.col("text").alias("word"),
                                                                      F.col("nodes").alias("prefixes"))
    backward = trie(counted.select(F.reverse("word").alias("text"))).select(F.reverse("text").alias("word"),
                                                                           F.col("nodes").alias("suffixes"))
    return counted.join(forward, "word").join(backward, "word").select(
        F.element_at("prefixes", -1).alias("id"), "word", "n", "prefixes", "suffixes")


def pairs(known: DataFrame) -> DataFrame:
    """(a, b, skip, last, less, id): the node pairs of each word. ``less`` is the negative count; ``last``: the code point
    skipped is the last of a run of equal ones."""
    length = F.size("prefixes") - 1
    one = known.select("id", (-F.col("n")).alias("less"), "prefixes", "suffixes", length.alias("m"),
                       F.split("word", "").alias("letters"))

    def pair(i: Column, skip: bool) -> Column:
        ends = F.lit(True) if not skip else ~F.get("letters", i).eqNullSafe(F.get("letters", i + 1))
        return F.struct(F.get("prefixes", i).alias("a"), F.get("suffixes", F.col("m") - i - int(skip)).alias("b"),
                        F.lit(skip).alias("skip"), ends.alias("last"))

    every = F.concat(F.transform(F.sequence(F.lit(0), F.col("m") - 1), lambda i: pair(i, True)),
                     F.transform(F.sequence(F.lit(0), F.col("m")), lambda i: pair(i, False)))
    return one.where("m > 0").select("id", "less", F.explode(every).alias("p")).select("p.*", "less", "id")


def neighbours(known: DataFrame) -> DataFrame:
    """(id, n_near, best): for each word with near words, their number and the most frequent, best.less and best.id."""
    groups = (pairs(known).groupBy("a", "b").agg(F.collect_list(F.struct("less", "id", "skip", "last")).alias("all"))
              .where(F.size("all") > 1)
              .select(F.array_sort(F.filter("all", lambda x: x["skip"])).alias("skips"),
                      F.filter("all", lambda x: ~x["skip"]).alias("whole"))
              .withColumn("ends", F.filter("skips", lambda x: x["last"])))

    def best(x: Column) -> Column:
        return F.when(x.isNotNull(), F.struct(x["less"].alias("less"), x["id"].alias("id")))

    first, second = best(F.get("skips", F.lit(0))), best(F.get("skips", F.lit(1)))
    shorter, longer = best(F.get("whole", F.lit(0))), best(F.get("ends", F.lit(0)))
    of_skips = F.transform("skips", lambda x: F.struct(
        x["id"].alias("id"), (F.size("skips") - 1 + F.when(x["last"], F.size("whole")).otherwise(0)).alias("n"),
        F.least(F.when(first["id"] == x["id"], second).otherwise(first), F.when(x["last"], shorter)).alias("best")))
    of_whole = F.transform("whole", lambda x: F.struct(x["id"].alias("id"), F.size("ends").alias("n"), longer.alias("best")))
    return (groups.select(F.explode(F.concat(of_skips, of_whole)).alias("x")).where("x.n > 0")
            .groupBy("x.id").agg(F.sum("x.n").alias("n_near"), F.min("x.best").alias("best")))


def roots(links: DataFrame) -> DataFrame:
    """(id, root): the end of the chain from each id of links (id, form). Counts grow along a chain by a factor, so it is
    short; each round doubles what is followed."""
    now = links.select("id", F.col("form").alias("root"))
    while True:
        then = stored(now.join(now.select(F.col("id").alias("root"), F.col("root").alias("next")), "root", "left").select(
            "id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if not then.where("moved").take(1):
            return then.select("id", "root")
        now = then.select("id", "root")


def variants(counted: DataFrame, ratio: int = RATIO) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for distinct words (word, n): the most frequent near word, if it occurs at
    least ``ratio`` times as often, and the end of that chain."""
    if ratio < 2:
        raise ValueError("forms would go round in circles")
    known = stored(numbered(counted), "numbered")
    listed = known.select("id", "word", "n")
    judged = stored(listed.join(neighbours(known), "id", "left"), "near")
    links = stored(judged.where(-F.col("best.less") >= F.col("n") * ratio).select("id", F.col("best.id").alias("form")), "links")
    named = listed.select("id", "word")
    chains = (links.join(roots(links), "id")
              .join(listed.select(F.col("id").alias("form"), F.col("word").alias("form_word"), F.col("n").alias("form_n")), "form")
              .join(named.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root")
              .select("id", "form_word", "form_n", "root_word"))
    return judged.join(chains, "id", "left").select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n")
