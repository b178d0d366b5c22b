"""Merkle manifest of a data set: a content-addressed DAG, and membership proofs by descent from its root.

Every row is a leaf, the digest of its fields. The rows of a group ascend by id; runs of ``fanout`` neighbours become
one node until a single one remains, the group's subroot; the subroots, ordered by group, are the leaves of one more
tree, whose root names the data set. A node's digest is the SHA-256 of its children's digests as hex text.

The DAG is stored as records, digest to children, in packs: a pack holds the records of one subtree of up to ``LEAVES``
nodes and is found by the digest of its top, so equal subtrees are stored once. Proofs are made top down. A request is a
position below a digest; the requests of a pack go down together, at each record by the next digit of their rank, and
what was not selected is put before the path so far, which so ends up in order from the leaf to the root. Upper packs
hand their requests on to the packs below them; only the lowest meet the rows, once.

No task holds more than one pack and its requests. Positions come from one sort by range: equal ids and very large groups
are dealt over tasks, and one row per task tells how many rows are before it. Records and positions are written to the
shared folder, so a lost executor costs its own tasks only.

Defined cases: a NULL field counts as "-"; NULL groups and NULL ids come first; rows equal in id are in order of their
leaf's digest, rows equal in all fields are leaves of their own; an empty text is a field of 0 bytes; an empty table has
no root and gives no rows. Other columns are not read. A NULL id is never in the set of claims that ``claim`` changes.
"""

from __future__ import annotations

from binascii import hexlify
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import join_lookup, null_safe_key, ranked, stored

FANOUT = 2
LEAVES = 1024  # of a pack
DIGEST = 32  # bytes
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


# Digests -------------------------------------------------------------------------------------------------------------

def field(value: Column) -> Column:
    """Its UTF-8 length, a colon and the value; "-" for NULL. No two lists of fields give the same text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(fields: Sequence[Column]) -> Column:
    """The digest of a row's fields, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*map(field, fields)).cast("binary"), 256))


def node(children: bytes) -> bytes:
    """The digest of a node, given its children's digests one after another."""
    return sha256(hexlify(children)).digest()


def height(n: int, fanout: int) -> int:
    """Levels above n leaves until one node remains."""
    levels = 0
    while n > 1:
        n, levels = -(-n // fanout), levels + 1
    return levels


def pack_levels(fanout: int) -> int:
    """Levels of a pack: as many as keep it within LEAVES leaves."""
    if not 2 <= fanout <= 128:
        raise ValueError("the fanout must be 2 to 128")
    levels = 1
    while fanout ** (levels + 1) <= LEAVES:
        levels += 1
    return levels


# Building ------------------------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Forest:
    """Trees of one fanout: (tree, n, digest) of their roots, and the packs of each round, lowest first."""

    roots: DataFrame
    packs: list[DataFrame]
    fanout: int


def records(leaves: bytes, levels: int, fanout: int) -> tuple[bytes, list[bytes], list[bytes]]:
    """The top of a subtree, and the digests and children of its records."""
    digests, children, now = [], [], leaves
    for _ in range(levels):
        runs = [now[i:i + DIGEST * fanout] for i in range(0, len(now), DIGEST * fanout)]
        made = [node(r) for r in runs]
        digests += made
        children += runs
        now = b"".join(made)
    return now, digests, children


PACKS = "tree string, n long, block long, pack binary, digests array<binary>, children array<binary>"


def _pack(turn: int, fanout: int):
    most = pack_levels(fanout)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.binary())
        for batch in batches:
            rows = []
            for tree, n, block, nodes in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3)):
                left = -(-n // fanout ** (most * turn))  # nodes of the tree on this round's lowest level
                given = b"".join(nodes.values.field(1).to_pylist())
                rows.append((tree, n, block, *records(given, min(most, height(left, fanout)), fanout)))
            columns = list(zip(*rows)) if rows else [()] * 6
            types = [pa.string(), pa.int64(), pa.int64(), pa.binary(), kind, kind]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)],
                                             names=[c.split()[0] for c in PACKS.split(", ")])
    return run


def build(nodes: DataFrame, fanout: int = FANOUT) -> Forest:
    """The forest over leaves (tree, n, rank, digest): ``n`` leaves a tree, ranks 0 to n - 1."""
    width = fanout ** pack_levels(fanout)
    roots, packs = nodes.where("n = 1").select("tree", "n", "digest"), []
    largest = nodes.agg(F.max("n")).first()[0] or 0
    turn, left = 0, largest
    nodes = nodes.where("n > 1")
    while left > 1:
        grouped = (nodes.groupBy("tree", "n", F.floor(F.col("rank") / width).alias("block"))
                   .agg(F.array_sort(F.collect_list(F.struct("rank", "digest"))).alias("nodes")))
        made = stored(grouped.mapInArrow(_pack(turn, fanout), PACKS), "packs")
        packs.append(made)
        turn, left = turn + 1, -(-left // width)
        done = F.col("n") <= F.lit(width ** turn)
        roots = roots.unionByName(made.where(done).select("tree", "n", F.col("pack").alias("digest")))
        nodes = made.where(~done).select("tree", "n", F.col("block").alias("rank"), F.col("pack").alias("digest"))
    return Forest(roots, packs, fanout)


# Descending ----------------------------------------------------------------------------------------------------------

def step(children: bytes, digit: int) -> bytes:
    """One step of a path: how many siblings are left and right of the selected child, and their digests."""
    at = digit * DIGEST
    left, right = children[:at], children[at + DIGEST:]
    return bytes((len(left) // DIGEST, len(right) // DIGEST)) + left + right


def descend(store: dict[bytes, bytes], top: bytes, ranks: Sequence[int], levels: int, fanout: int,
            path: bytes = b"") -> Iterator[tuple[int, bytes, bytes]]:
    """(rank, digest, path) below ``top`` for ascending ranks, counted from its leftmost position. The path starts at the
    lowest step."""
    front = [(top, 0, 0, len(ranks), path)]
    for level in range(levels - 1, -1, -1):
        width, below = fanout ** level, []
        for digest, base, lo, hi, above in front:
            children = store[digest]
            for digit in range(len(children) // DIGEST):
                end = bisect_left(ranks, base + (digit + 1) * width, lo, hi)
                if end > lo:
                    below.append((children[digit * DIGEST:(digit + 1) * DIGEST], base + digit * width, lo, end,
                                  step(children, digit) + above))
                    lo = end
        front = below
    for digest, _, lo, hi, steps in front:
        for at in range(lo, hi):
            yield ranks[at], digest, steps


def steps_of(path: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(left siblings, right siblings) of each step, from the leaf up."""
    at = 0
    while at < len(path):
        middle = at + 2 + path[at] * DIGEST
        end = middle + path[at + 1] * DIGEST
        yield path[at + 2:middle], path[middle:end]
        at = end


def fold(digest: bytes, path: bytes) -> bytes:
    """The root that a leaf and its path lead to."""
    for left, right in steps_of(path):
        digest = node(left + digest + right)
    return digest


def proof_digest(path: bytes) -> str:
    """SHA-256 of all siblings as hex text, from the leaf up, left before right."""
    return sha256(hexlify(b"".join(a + b for a, b in steps_of(path)))).hexdigest()


def one_by_one(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch, so that only one pack at a time becomes Python values."""
    for at in range(batch.num_rows):
        yield batch.slice(at, 1).to_pylist()[0]


REQUESTS = "tree string, n long, block long, digest binary, path binary"


def _hand_on(turn: int, fanout: int):
    """Requests of one pack each to those of all positions below it."""
    most = pack_levels(fanout)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for r in one_by_one(batch):
                wide = fanout ** (most * turn)
                left = -(-r["n"] // wide)
                levels = min(most, height(left, fanout))
                base = r["block"] * fanout ** most
                ranks = range(min(fanout ** levels, left - base))
                for rank, digest, path in descend(dict(zip(r["digests"], r["children"])), r["digest"], ranks, levels, fanout,
                                                  r["path"]):
                    for column, value in zip(out, (r["tree"], r["n"], base + rank, digest, path)):
                        column.append(value)
            types = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)],
                                             names=[c.split()[0] for c in REQUESTS.split(", ")])
    return run


def _with_records(requests: DataFrame, packs: DataFrame) -> DataFrame:
    """Requests with the records of their pack, which is found by its digest alone."""
    found = packs.select("pack", "digests", "children").dropDuplicates(["pack"])
    return requests.join(found, F.col("digest") == F.col("pack"), "left").drop("pack")


def down_to(forest: Forest, roots: DataFrame, last: int) -> DataFrame:
    """From requests at the roots (tree, n, digest, path) to those at the packs of round ``last``, or at the leaves if it
    is -1: (tree, n, block, digest, path). Trees that have fewer rounds stay at their root."""
    width, fanout = forest.fanout ** pack_levels(forest.fanout), forest.fanout
    top = roots.withColumn("block", F.lit(0).cast("long")).select("tree", "n", "block", "digest", "path")
    requests = None
    for turn in range(len(forest.packs) - 1, last, -1):
        # Those of trees whose topmost packs are of this round join those that come from above.
        starting = top.where(F.col("n") > F.lit(width ** turn))
        if turn < len(forest.packs) - 1:
            starting = starting.where(F.col("n") <= F.lit(width ** (turn + 1)))
        requests = starting if requests is None else requests.unionByName(starting)
        requests = stored(_with_records(requests, forest.packs[turn]).mapInArrow(_hand_on(turn, fanout), REQUESTS), "requests")
    rest = top if requests is None else top.where(F.col("n") <= F.lit(width ** (last + 1)))
    return rest if requests is None else requests.unionByName(rest)


PROOFS = "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string"


def _prove(fanout: int):
    most = pack_levels(fanout)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for r in one_by_one(batch):
                claims = r["claims"]
                ranks = [c["rank"] - r["block"] * fanout ** most for c in claims]
                store = dict(zip(r["digests"] or (), r["children"] or ()))
                levels = min(most, height(r["n"], fanout))
                for claim, (_, digest, path) in zip(claims, descend(store, r["digest"], ranks, levels, fanout, r["path"])):
                    folded = fold(claim["claimed"] or digest, path).hex()
                    for column, value in zip(out, (claim["doc_id"], digest.hex(), r["subroot"].hex(), proof_digest(path),
                                                   folded)):
                        column.append(value)
            types = [pa.int64()] + [pa.string()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)],
                                             names=[c.split()[0] for c in PROOFS.split(", ")])
    return run


# The manifest --------------------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Manifest:
    """``leaves``: (tree, n, rank, doc_id, digest, claimed); ``groups``: (tree, n, digest, path) with the subroots and
    their paths to ``root``; ``forest``: the records below the subroots."""

    leaves: DataFrame
    groups: DataFrame
    forest: Forest
    root: str | None


def manifest(docs: DataFrame, group: str = "lang", key: str = "doc_id", fields: Sequence[str] = FIELDS,
             claim: tuple[Column, dict[str, Column]] | None = None, fanout: int = FANOUT) -> Manifest:
    """The manifest of a table. ``claim`` is a condition and new values of fields: rows that meet it claim a leaf of those
    values, which their proof is then held against."""
    own = leaf([F.col(c) for c in fields])
    claimed = F.lit(None).cast("binary")
    if claim is not None:
        condition, values = claim
        claimed = F.when(condition, leaf([values.get(c, F.col(c)) for c in fields]))
    rows = docs.select(null_safe_key(F.col(group)).alias("tree"), F.col(group).alias("group"),
                       F.col(key).cast("long").alias("doc_id"), own.alias("digest"), claimed.alias("claimed"))
    placed = ranked(rows, "group", "doc_id", "digest")
    trees = stored(placed.groupBy("tree", "group").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")), "trees")
    many = trees.count()
    leaves = stored(join_lookup(placed, trees.select("tree", "first", "n"), ["tree"], many, "inner").select(
        "tree", "n", (F.col("at") - F.col("first")).alias("rank"), "doc_id", "digest", "claimed"), "leaves")
    forest = build(leaves.select("tree", "n", "rank", "digest"), fanout)
    subroots = ranked(forest.roots.join(trees.select("tree", "group"), "tree").select("tree", "group", "n", "digest"), "group")
    upper = build(subroots.select(F.lit("").alias("tree"), F.lit(many).cast("long").alias("n"), F.col("at").alias("rank"),
                                  "digest"), fanout)
    top = upper.roots.first()
    paths = down_to(upper, upper.roots.withColumn("path", F.lit(b"")), -1).select(F.col("block").alias("at"), "path")
    groups = stored(subroots.join(paths, "at").select("tree", "n", "digest", "path"), "groups")
    return Manifest(leaves, groups, forest, top["digest"].hex() if top else None)


def proofs(found: Manifest) -> DataFrame:
    """Per leaf: doc_id, its digest, its group's subroot, the digest of its siblings up to the root, and the root that the
    claimed leaf (else its own) and these siblings lead to."""
    forest = found.forest
    width = forest.fanout ** pack_levels(forest.fanout)
    blocks = down_to(forest, found.groups, 0).join(
        found.groups.select("tree", F.col("digest").alias("subroot")), "tree")
    claims = (found.leaves.groupBy("tree", F.floor(F.col("rank") / width).alias("block"))
              .agg(F.array_sort(F.collect_list(F.struct("rank", "doc_id", "claimed"))).alias("claims")))
    requests = blocks.join(claims, ["tree", "block"])
    if forest.packs:
        whole = _with_records(requests, forest.packs[0])
    else:
        none = F.lit(None).cast("array<binary>")
        whole = requests.withColumns({"digests": none, "children": none})
    return whole.mapInArrow(_prove(forest.fanout), PROOFS).withColumn("root", F.lit(found.root).cast("string"))
