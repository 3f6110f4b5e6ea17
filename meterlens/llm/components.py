"""Connected components as Spark jobs, and exact set similarity inside candidate groups."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.llm import textbytes
from meterlens.llm.store import stored

BLOCK_SETS = 256
BLOCK_ELEMENTS = 1 << 19
FRAGMENTS = 4


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (the smallest node) of every node of ``edges`` (``a, b``: long); loops are left out.

    Alternating star steps: each node's larger neighbours are linked to its smallest
    neighbour, then its smaller ones, until all edges are stars around the smallest
    node. Each round is written, so no lineage grows and nothing reaches the driver.
    """
    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while True:
        ends = e.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down"))
        ends = ends.unionByName(e.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        uneven = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)")
        if not uneven.limit(1).count():
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        e = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = e.groupBy("u").agg(F.min("v").alias("m"))
        small = e.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _overlaps(group: np.ndarray, size: np.ndarray, sets: list[np.ndarray], percent: int, first: int, limit: int | None, label: np.ndarray) -> list[tuple[int, int]]:
    """Links between set i >= ``first`` and sets before it (before ``limit``), one for each label that it meets.

    The global order of the elements is cut into fragments. A set's overlaps with all
    others are counted in one fragment after the other and summed by pair; a pair is left
    as soon as the rest of both sets can't make up for what is missing.
    """
    counts = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), counts)
    elements = np.concatenate(sets) ^ textbytes.mix(group.view(np.uint64))[owner]  # only sets of a group share elements
    order = np.argsort(elements)
    new = np.ones(len(order), bool)
    new[1:] = elements[order][1:] != elements[order][:-1]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new) - 1
    n = int(new.sum())
    held = np.bincount(rank, minlength=n)
    by_element = np.lexsort((owner, rank))
    lists, starts = owner[by_element], np.concatenate(([0], np.cumsum(held)))
    fragment = rank * FRAGMENTS // max(n, 1)
    part = np.zeros((len(sets), FRAGMENTS), np.int64)
    np.add.at(part, (owner, fragment), 1)
    after = part[:, ::-1].cumsum(axis=1)[:, ::-1] - part
    shared = np.flatnonzero(held[rank] > 1)
    by_set = shared[np.lexsort((rank[shared], owner[shared]))]
    elements_of, bounds = rank[by_set], np.searchsorted(owner[by_set], np.arange(len(sets) + 1))
    found = []
    for i in range(first, len(sets)):
        own = elements_of[bounds[i] : bounds[i + 1]]
        most = i if limit is None else limit
        if not len(own) or not most:
            continue
        need = -(-percent * (size[i] + size[:most]) // (100 + percent))
        total = np.zeros(most, np.int64)
        cut = np.searchsorted(own * FRAGMENTS // n, np.arange(FRAGMENTS + 1))
        for f in range(FRAGMENTS):
            here = own[cut[f] : cut[f + 1]]
            if len(here):
                met = np.concatenate([lists[starts[t] : starts[t + 1]] for t in here])
                total += np.bincount(met, minlength=len(sets))[:most]
            alive = (total + np.minimum(after[i, f], after[:most, f]) >= need) & (label[:most] != label[i])
            if not alive.any():
                break
        else:
            linked = np.flatnonzero(alive)
            labels, at = np.unique(label[linked], return_index=True)
            found += [(i, int(linked[k])) for k in at]
            if limit is None:
                label[np.isin(label, labels)] = label[i]
    return found


def _sets(table: pa.Table, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
    table = table.take(pa.array(order))
    raw = [np.frombuffer(x, np.uint64) for x in table.column("grams").to_pylist()]
    return table.column("cls").to_numpy(), table.column("group").to_numpy(), table.column("n").to_numpy(), raw


def _edges(cls: np.ndarray, found: list[tuple[int, int]]) -> pa.Table:
    return pa.table({"a": pa.array([int(cls[i]) for i, _ in found], pa.int64()), "b": pa.array([int(cls[j]) for _, j in found], pa.int64())})


def _first_cell(percent: int) -> Callable[[pa.Table], pa.Table]:
    """All pairs of a bin of small groups, of a large group's first block, or of another block with both."""

    def run(table: pa.Table) -> pa.Table:
        block = table.column("block").to_numpy()
        order = np.lexsort((table.column("cls").to_numpy(), block))
        first = int((block == 0).sum()) if table.column("part")[0].as_py() else 0
        cls, group, size, sets = _sets(table, order)
        return _edges(cls, _overlaps(group, size, sets, percent, first, None, np.arange(len(cls))))

    return run


def _later_cell(percent: int) -> Callable[[pa.Table], pa.Table]:
    """Sets outside of their group's largest component against a block of the group."""

    def run(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy(zero_copy_only=False)
        order = np.lexsort((table.column("cls").to_numpy(), asks))
        limit = int((~asks).sum())
        cls, group, size, sets = _sets(table, order)
        label = table.column("label").to_numpy()[order]
        return _edges(cls, _overlaps(group, size, sets, percent, limit, limit, label))

    return run


def link(sets: DataFrame, candidates: DataFrame, percent: int = 80) -> DataFrame:
    """``cls, component`` of the sets that are linked with another one: a Jaccard similarity of at least ``percent`` / 100.

    ``sets`` has ``cls`` (long), ``n`` (long, its size) and ``grams`` (its elements, sorted
    unsigned 64-bit numbers as bytes), each cls once or more; ``candidates`` has pairs
    ``a, b`` of cls such that linked sets are connected by them. All sets of a candidate
    group are compared, exactly:

    - small groups share bins of bounded size, a bin to a task;
    - a large group is cut into blocks of bounded size; its first block meets every block;
    - whatever isn't in the group's largest component by then meets every block too. Pairs
      inside a component need no further look, so copies aren't paired one by one.
    """
    groups = components(candidates)
    members = stored(
        sets.dropDuplicates(["cls"]).join(groups, F.col("cls") == F.col("node")).select("cls", F.col("component").alias("group"), "n", "grams"), "members"
    )
    sizes = stored(members.groupBy("group").agg(F.count("*").alias("count"), F.sum("n").alias("elements")), "group-sizes")
    blocks = F.greatest(F.ceil(F.col("count") / BLOCK_SETS), F.ceil(F.col("elements") / BLOCK_ELEMENTS), F.lit(1)).cast("int")
    sizes = sizes.select("group", "elements", blocks.alias("blocks"))
    row = sizes.agg(F.sum(F.when(F.col("blocks") == 1, F.col("elements"))), F.max("blocks")).head()
    bins = max(32, -(-(row[0] or 0) // BLOCK_ELEMENTS))

    placed = members.join(sizes, "group").withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    large = F.col("blocks") > 1
    parts = F.when(large & (F.col("block") == 0), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))
    bin_ = F.when(large, F.col("group")).otherwise(F.pmod(F.xxhash64("group"), F.lit(bins)))
    cells = placed.select("cls", "group", "n", "grams", "block", large.alias("large"), bin_.alias("bin"), F.explode(parts).alias("part"))
    links = stored(cells.groupBy("large", "bin", "part").applyInArrow(_first_cell(percent), "a long, b long"), "links")
    if (row[1] or 0) > 1:
        so_far = components(links)
        labelled = placed.where(large).join(so_far, F.col("cls") == F.col("node"), "left")
        labelled = stored(labelled.select("cls", "group", "n", "grams", "block", "blocks", F.coalesce("component", "cls").alias("label")), "labelled")
        counts = labelled.groupBy("group", "label").agg(F.count("*").alias("count"))
        largest = counts.groupBy("group").agg(F.max_by("label", "count").alias("largest"), F.max("count").alias("of"), F.sum("count").alias("all"))
        chunks = F.ceil((F.col("all") - F.col("of")) / BLOCK_SETS).cast("int")
        labelled = labelled.join(largest.select("group", "largest", chunks.alias("chunks")).where("chunks > 0"), "group")
        columns = ("cls", "group", "n", "grams", "label")
        asking = labelled.where("label <> largest").select(
            *columns,
            F.lit(True).alias("asks"),
            F.pmod(F.xxhash64("cls", F.lit(1)), F.col("chunks")).cast("int").alias("chunk"),
            F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("part"),
        )
        asked = labelled.select(
            *columns, F.lit(False).alias("asks"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.col("block").alias("part")
        )
        more = asking.unionByName(asked).groupBy("group", "chunk", "part").applyInArrow(_later_cell(percent), "a long, b long")
        links = links.unionByName(more)
    return components(links).select(F.col("node").alias("cls"), "component")
