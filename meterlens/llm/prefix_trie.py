"""The trie of conversation prefixes, with count-min screening of prefix digests.

1. Every turn becomes two 64-bit hashes of its role and text; texts don't move. Turns are
   laid out by range in the order of their conversations, and a turn's place is its rank
   there less that of its conversation's first, so a conversation may span many tasks.
2. The digest of a prefix is the exclusive or of its turns' hashes with their places, so
   it is summed up by blocks of ``BLOCK`` turns.
3. A count-min sketch of all prefix digests is summed up by tasks and merged by chunks.
   Its estimates are never too low: an estimate of one proves that a prefix belongs to one
   conversation. Such prefixes are nodes of their own right where they are.
4. Only prefixes that may be shared are shuffled, to be grouped exactly.
5. Sums over subtrees need no walk. A conversation owns the nodes of which it is the
   smallest member: its prefixes from some depth on. A node's saved bytes are those that
   its members have in the subtree at depths they don't own; its leaves are the childless
   ends that members own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlens.llm import textbytes
from meterlens.llm.hot_keys import join_groups
from meterlens.llm.store import stored

BLOCK = 4096
#: Rows of the sketch, and the most cells in one. A cell has two bits (seen, seen again), so the sketch has at most 4 MB.
ROWS, MOST_CELLS = 4, 1 << 22
_CHUNK = 1 << 13  # bytes of a bit plane that are merged together
_LOCAL = (1 << 33) - 1  # the part of monotonically_increasing_id below the partition's number
_KEY = ["k1", "k2"]
_EMPTY = hashlib.sha256(b"").hexdigest()


@dataclass(frozen=True)
class Turns:
    """``items``: conv, depth (from 1), h1, h2, bytes and the number of turns of each turn; ``members``: conv and n of each conversation."""

    items: DataFrame
    members: DataFrame


def turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Turns:
    """The turns of conversations as hashes, numbered in their order.

    A null turn comes first; a null role or text is empty. Rows of one conversation and
    turn come in the order of a hash of role and text, and repeated rows are turns of their
    own. Rows without a conversation take no part. Other columns, whatever their names,
    are ignored.
    """
    both = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    rows = df.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"),
        F.col(turn).alias("turn"),
        F.xxhash64(F.lit(1), *both).alias("h1"),
        F.xxhash64(F.lit(2), *both).alias("h2"),
        F.octet_length(both[1]).cast("long").alias("bytes"),
    )
    hashed = stored(rows.withColumn("row", F.monotonically_increasing_id()), "turns")
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("h1"), F.col("h2"), F.col("row")]
    laid = hashed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    laid = stored(laid.drop("turn", "row"), "turns-in-order")
    parts = laid.groupBy(F.shiftright("at", 33).alias("part")).agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = parts.select("part", F.coalesce(before, F.lit(0)).alias("before"))  # a row for each task that wrote
    ranked = laid.withColumn("part", F.shiftright("at", 33)).join(F.broadcast(offsets), "part")
    ranked = ranked.select("conv", "h1", "h2", "bytes", (F.col("before") + F.col("at").bitwiseAND(F.lit(_LOCAL))).alias("rank"))
    firsts = stored(ranked.groupBy("conv").agg(F.min("rank").alias("first"), F.count("*").alias("n")), "conversations")
    items = join_groups(ranked, firsts, ["conv"], "n")
    items = items.select("conv", (F.col("rank") - F.col("first") + 1).alias("depth"), "h1", "h2", "bytes", "n")
    return Turns(items, firsts.select("conv", "n"))


def _prefixes(items: DataFrame) -> DataFrame:
    """Each turn's prefix: key, key of the prefix before (``q1, q2``), bytes of the turn, and ``run``, the bytes up to it."""
    at = [F.col("h1"), F.col("h2"), F.col("depth")]
    rows = items.withColumns(
        {"x1": F.xxhash64(F.lit(3), *at), "x2": F.xxhash64(F.lit(4), *at), "block": F.floor((F.col("depth") - 1) / BLOCK)}
    )
    in_block = Window.partitionBy("conv", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.select(
        "conv", "block", "depth", "bytes", "n", "x1", "x2",
        F.bit_xor("x1").over(in_block).alias("y1"), F.bit_xor("x2").over(in_block).alias("y2"), F.sum("bytes").over(in_block).alias("y3"),
    )
    # Only a block's last row counts for the blocks after it.
    ends = rows.where((F.col("depth") % BLOCK == 0) & (F.col("depth") < F.col("n"))).select("conv", "block", "y1", "y2", "y3")
    so_far = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = ends.select(
        "conv", (F.col("block") + 1).alias("block"),
        F.bit_xor("y1").over(so_far).alias("z1"), F.bit_xor("y2").over(so_far).alias("z2"), F.sum("y3").over(so_far).alias("z3"),
    )
    rows = rows.join(before, ["conv", "block"], "left")
    keys = {f"k{i}": F.col(f"y{i}").bitwiseXOR(F.coalesce(f"z{i}", F.lit(0))) for i in (1, 2)}
    rows = rows.withColumns(keys | {"run": F.col("y3") + F.coalesce("z3", F.lit(0))})
    parents = [F.col(f"k{i}").bitwiseXOR(F.col(f"x{i}")).alias(f"q{i}") for i in (1, 2)]
    return rows.select("conv", "depth", "n", "bytes", "run", *_KEY, *parents)


def _cells(k1: np.ndarray, k2: np.ndarray, width: int) -> np.ndarray:
    """The cell of each key in each row of the sketch."""
    a, b = k1.view(np.uint64), k2.view(np.uint64) | np.uint64(1)
    return np.stack([textbytes.mix(a + np.uint64(i) * b) % np.uint64(width) + np.uint64(i * width) for i in range(ROWS)]).astype(np.int64)


def _sketched(width: int):
    """The sketch of a task's keys, as chunks of its two bit planes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(ROWS * width, np.uint8)
        for b in batches:
            cells, n = np.unique(_cells(b.column(0).to_numpy(), b.column(1).to_numpy(), width), return_counts=True)
            counts[cells] = np.minimum(counts[cells] + np.minimum(n, 2), 2)
        seen, again = np.packbits(counts > 0), np.packbits(counts > 1)
        chunks = [k for k in range(0, len(seen), _CHUNK) if seen[k : k + _CHUNK].any()]
        planes = ([x[k : k + _CHUNK].tobytes() for k in chunks] for x in (seen, again))
        yield pa.RecordBatch.from_arrays([pa.array([k // _CHUNK for k in chunks], pa.int32()), *(pa.array(p, pa.binary()) for p in planes)], ["chunk", "seen", "again"])

    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each chunk; what two tasks have seen was seen again."""
    chunks: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for b in batches:
        for chunk, *planes in zip(*(c.to_pylist() for c in b.columns), strict=True):
            seen, again = (np.frombuffer(p, np.uint8) for p in planes)
            if chunk in chunks:
                old = chunks[chunk]
                again = again | old[1] | (seen & old[0])
                seen = seen | old[0]
            chunks[chunk] = seen, again
    columns = [pa.array(list(chunks), pa.int32()), pa.array([a.tobytes() for _, a in chunks.values()], pa.binary())]
    yield pa.RecordBatch.from_arrays(columns, ["chunk", "again"])


def sketch(keys: DataFrame, most_cells: int = MOST_CELLS) -> np.ndarray:
    """The cells of a count-min sketch that hold more than one: the bits, by rows.

    A row has twice as many cells as there are keys, as a power of two, up to
    ``most_cells``; with more keys fewer are proved alone, and the others are grouped.
    """
    width = min(most_cells, max(1 << 10, 1 << (2 * keys.count()).bit_length()))
    tasks = keys.select(*_KEY).mapInArrow(_sketched(width), "chunk int, seen binary, again binary")
    again = np.zeros(ROWS * width // 8, np.uint8)
    for row in tasks.repartition("chunk").mapInArrow(_merged, "chunk int, again binary").collect():
        part = np.frombuffer(row["again"], np.uint8)
        again[row["chunk"] * _CHUNK : row["chunk"] * _CHUNK + len(part)] = part
    return again


def _screened(prefixes: DataFrame, most_cells: int) -> DataFrame:
    """``prefixes`` with whether the estimates prove a prefix, and the one before it, to belong to one conversation."""
    spark: SparkSession = prefixes.sparkSession
    shared = spark.sparkContext.broadcast(sketch(prefixes, most_cells))
    names = prefixes.columns
    at = [names.index(c) for c in (*_KEY, "q1", "q2", "depth")]

    def alone(k1: pa.Array, k2: pa.Array) -> np.ndarray:
        again = shared.value
        cells = _cells(k1.to_numpy(), k2.to_numpy(), len(again) * 8 // ROWS)
        return ~((again[cells >> 3] >> (7 - (cells & 7)).astype(np.uint8)) & 1).astype(bool).all(axis=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k1, k2, q1, q2, depth = (b.column(i) for i in at)
            above = alone(q1, q2) & (depth.to_numpy() > 1)  # the root isn't in the sketch
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(alone(k1, k2)), pa.array(above)], [*names, "alone", "above"])

    schema = prefixes.withColumns({"alone": F.lit(True), "above": F.lit(True)}).schema
    return stored(prefixes.mapInArrow(run, schema), "screened-prefixes")


def _end_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each key's conversations; rows come by key and conversation, and only the state of one digest is held."""
    key, state = None, None
    for b in batches:
        k1, k2, conv = (c.to_numpy() for c in b.columns)
        rows: list[tuple] = []
        cuts = np.flatnonzero((k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])) + 1
        for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(k1)], strict=True):
            if i == j:
                continue
            listed = ",".join(map(str, conv[i:j].tolist())).encode()
            if key == (int(k1[i]), int(k2[i])):
                state.update(b"," + listed)
            else:
                if key is not None:
                    rows.append((*key, state.hexdigest()))
                key, state = (int(k1[i]), int(k2[i])), hashlib.sha256(listed)
        yield _end_rows(rows)
    if key is not None:
        yield _end_rows([(*key, state.hexdigest())])


def _end_rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(3)], [*_KEY, "ends_sha256"])


def _yes(condition: Column) -> Column:
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("long")


def nodes(given: Turns, most_cells: int = MOST_CELLS) -> DataFrame:
    """One row for each distinct prefix of the conversations: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    ``conv_id`` is the smallest member, ``parent_conv_id`` that of the parent (null for
    the root, the empty prefix that all conversations share). Leaves and saved tokens (UTF-8
    bytes of the last text for each member but one) are summed over the subtree;
    ``ends_sha256`` is the digest of the members that end there, ascending and comma-joined.
    Members without turns end at the root; without conversations there is no node.
    """
    prefixes = stored(_prefixes(given.items), "prefixes")
    screened = _screened(prefixes, most_cells)
    tails, open_rows = screened.where("alone"), screened.where("not alone").drop("alone")
    root = given.members.select(
        "conv", F.lit(0).cast("long").alias("depth"), "n", *(F.lit(0).cast("long").alias(c) for c in ("bytes", "run", *_KEY)),
        *(F.lit(None).cast("long").alias(c) for c in ("q1", "q2")), F.lit(False).alias("above"),
    )
    rows = stored(open_rows.unionByName(root), "open-prefixes")

    # The exact groups, and the children of each: open ones, and tails that begin below it.
    groups = rows.groupBy(*_KEY).agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), *(F.min(c).alias(c) for c in ("depth", "q1", "q2")), F.bool_and("above").alias("above"))
    groups = stored(groups, "prefix-groups")
    heads = tails.where("not above").select("conv", "depth", "n", "q1", "q2")
    below = groups.where("not above and depth > 0").select("q1", "q2").unionByName(heads.select("q1", "q2"))
    children = below.groupBy(F.col("q1").alias("k1"), F.col("q2").alias("k2")).agg(F.count("*").alias("n_children"))
    groups = stored(groups.join(children, _KEY, "left").fillna(0, ["n_children"]), "prefix-groups-with-children")

    # What each conversation doesn't own, and whether it owns a childless end.
    own = F.col("conv") == F.col("conv_id")
    placed = join_groups(rows.withColumn("ends", F.col("depth") == F.col("n")).drop("above", "q1", "q2", "depth", "n"), groups.select(*_KEY, "conv_id", "n_convs", "n_children"), _KEY, "n_convs")
    placed = stored(placed.withColumn("own", own).drop("conv_id"), "placed-prefixes")
    leaf = _yes(F.col("own") & F.col("ends") & (F.col("n_children") == 0))
    tail_ends = tails.where(F.col("depth") == F.col("n")).select("conv", F.lit(None).cast("long").alias("not_owned"), F.lit(1).cast("long").alias("leaf"), F.lit(0).cast("long").alias("one"))
    by_conv = placed.select("conv", F.when(~F.col("own"), F.col("run")).alias("not_owned"), leaf.alias("leaf"), F.lit(1).cast("long").alias("one")).unionByName(tail_ends)
    by_conv = stored(by_conv.groupBy("conv").agg(F.max("not_owned").alias("not_owned"), F.max("leaf").alias("leaf"), F.sum("one").alias("rows")), "owners")
    saved = F.when(F.col("own"), F.lit(0)).otherwise(F.col("not_owned") - F.col("run") + F.col("bytes"))
    sums = join_groups(placed.select("conv", "own", "run", "bytes", *_KEY), by_conv, ["conv"], "rows")
    sums = sums.groupBy(*_KEY).agg(F.sum(saved).alias("saved_tokens"), F.sum("leaf").alias("n_leaves"))

    ends = rows.where(F.col("depth") == F.col("n")).select(*_KEY, "conv").repartition(*_KEY).sortWithinPartitions(*_KEY, "conv")
    ends = ends.mapInArrow(_end_digests, "k1 long, k2 long, ends_sha256 string")
    shared = groups.join(sums, _KEY).join(ends, _KEY, "left").fillna(_EMPTY, ["ends_sha256"])

    # Parents: of open groups and first tail nodes an open group, else the conversation itself.
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    one = F.lit(1).cast("long")
    tail = [
        one.alias("n_convs"), _yes(F.col("depth") < F.col("n")).alias("n_children"), one.alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
        F.when(F.col("depth") == F.col("n"), F.sha2(F.col("conv").cast("string"), 256)).otherwise(F.lit(_EMPTY)).alias("ends_sha256"),
    ]
    settled = tails.where("above").select(F.col("conv").alias("conv_id"), "depth", F.col("conv").alias("parent_conv_id"), *tail)
    to_find = shared.where("not above and depth > 0").drop("above", *_KEY).unionByName(heads.select(F.col("conv").alias("conv_id"), "depth", "q1", "q2", *tail))
    parents = groups.where("n_children > 0").select(F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("siblings"))
    found = join_groups(to_find, parents, ["q1", "q2"], "siblings")
    self_made = shared.where("above or depth = 0").withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.col("conv_id")))
    return settled.select(*out).unionByName(found.select(*out)).unionByName(self_made.select(*out))


def trie(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The nodes of the trie of a table of turns (see ``turns`` and ``nodes``)."""
    given = turns(df, conv, turn, role, text)
    return nodes(Turns(given.items, given.members))
