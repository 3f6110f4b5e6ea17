"""Exact top-k search by inner product: MaxScore over shards of an inverted index.

Items are dealt to shards of bounded size; each shard keeps, for every term, the list of
its rows and weights with the largest and smallest weight. Queries are cut into blocks,
and each block meets each shard once, in a task of its own. In a shard a query's terms
are ordered by the most they can add to a score. A pilot gives a first k-th best score;
the terms at the low end whose bounds together stay below it are non-essential. The
essential postings are traversed, and rows that may still compete are probed in the
others, as long as they compete. The shards' best k are merged at the end.

Weights may be negative: a term's bound is the larger of 0 and its weight times the
list's extremes, so no row is missed. Scores are exact integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SHARD = 8192  # items
BLOCK = 512  # queries
PILOT_TERMS = 16

_INDEX = "shard int, ids binary, terms binary, starts binary, rows binary, weights binary, kind string"
_BLOCK = "block int, ids binary, starts binary, terms binary, weights binary"


def _flat(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids, and for each entry its row, term and weight; entries of weight 0 are left out."""
    table = table.sort_by("id").combine_chunks()
    ids = table.column("id").to_numpy()
    terms, weights = (table.column(c).combine_chunks() for c in ("terms", "weights"))
    counts = terms.value_lengths().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(ids)), counts)
    t, w = (x.flatten().to_numpy(zero_copy_only=False) for x in (terms, weights))
    keep = w != 0
    return ids, row[keep], t[keep].astype(np.int64), w[keep].astype(np.int64)


def _narrow(values: np.ndarray) -> np.ndarray:
    for kind in (np.int8, np.int16, np.int32):
        if not len(values) or (values.min() >= np.iinfo(kind).min and values.max() <= np.iinfo(kind).max):
            return values.astype(kind)
    return values


def _index(table: pa.Table) -> pa.Table:
    ids, row, term, weight = _flat(table)
    order = np.lexsort((row, term))
    terms, starts = np.unique(term[order], return_index=True)
    weight = _narrow(weight[order])
    return pa.table(
        {
            "shard": table.column("shard").slice(0, 1),
            "ids": [ids.astype(np.int64).tobytes()],
            "terms": [terms.tobytes()],
            "starts": [np.append(starts, len(order)).astype(np.int64).tobytes()],
            "rows": [row[order].astype(np.int32).tobytes()],
            "weights": [weight.tobytes()],
            "kind": [weight.dtype.str],
        }
    )


def _block(table: pa.Table) -> pa.Table:
    ids, row, term, weight = _flat(table)
    starts = np.searchsorted(row, np.arange(len(ids) + 1)).astype(np.int64)
    return pa.table(
        {
            "block": table.column("block").slice(0, 1),
            "ids": [ids.astype(np.int64).tobytes()],
            "starts": [starts.tobytes()],
            "terms": [term.tobytes()],
            "weights": [weight.tobytes()],
        }
    )


class Shard:
    """Postings of a shard. A list that holds over half of the rows is kept as a full column."""

    def __init__(self, ids: np.ndarray, terms: np.ndarray, starts: np.ndarray, rows: np.ndarray, weights: np.ndarray):
        self.ids, self.n = ids, len(ids)
        self.place = {int(t): i for i, t in enumerate(terms)}
        self.lists: list[tuple[np.ndarray, np.ndarray] | None] = []
        self.columns: list[np.ndarray | None] = []
        self.high, self.low = np.zeros(len(terms), object), np.zeros(len(terms), object)
        for i in range(len(terms)):
            r, w = rows[starts[i] : starts[i + 1]], weights[starts[i] : starts[i + 1]].astype(np.int64)
            self.high[i], self.low[i] = max(0, int(w.max())), min(0, int(w.min()))
            full = 2 * len(r) > self.n and np.abs(w).max() < 1 << 50
            self.lists.append(None if full else (r, w))
            column = None
            if full:
                column = np.zeros(self.n)
                column[r] = w
            self.columns.append(column)

    def add(self, scores: np.ndarray, i: int, weight: int) -> None:
        """Traverse the list of term ``i``."""
        if self.columns[i] is not None:
            scores += self.columns[i] * weight
        else:
            r, w = self.lists[i]
            scores[r] += (w.astype(scores.dtype) if scores.dtype == object else w) * weight

    def probe(self, i: int, rows: np.ndarray, exact: bool) -> np.ndarray:
        """The weights of term ``i`` in some rows."""
        if self.columns[i] is not None:
            found = self.columns[i][rows]
            return found if exact else np.array([int(x) for x in found], object)
        r, w = self.lists[i]
        at = np.minimum(np.searchsorted(r, rows), len(r) - 1)
        found = np.where(r[at] == rows, w[at], 0)
        return found if exact else found.astype(object)

    def best(self, own: int, terms: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids and scores of the best ``k`` rows but ``own``, by score, then smaller id."""
        held = [(self.place[int(t)], int(w)) for t, w in zip(terms, weights, strict=True) if int(t) in self.place]
        bound = {i: max(w * self.high[i], w * self.low[i]) for i, w in held}
        held.sort(key=lambda x: -bound[x[0]])
        most = sum(max(abs(w * self.high[i]), abs(w * self.low[i])) for i, w in held)
        exact = most < 1 << 53  # doubles hold such integers exactly
        held = [(i, w if not exact else float(w)) for i, w in held]
        scores = np.zeros(self.n) if exact else np.zeros(self.n, object)
        others = np.flatnonzero(self.ids != own)
        rest, at, least = sum(bound.values()), 0, None
        while at < len(held):
            if at == PILOT_TERMS and len(others) > k:
                pilot = others[np.argpartition(-scores[others], k - 1)[:k]]
                full = scores[pilot].copy()
                for i, w in held[at:]:
                    full += self.probe(i, pilot, exact) * w
                least = full.min()
            if least is not None and rest < least:
                break  # what follows is non-essential
            self.add(scores, *held[at])
            rest -= bound[held[at][0]]
            at += 1
        rows = others
        if least is not None:
            rows = rows[scores[rows] + float(rest) >= least] if exact else rows[scores[rows] + rest >= least]
        value = scores[rows]
        for i, w in held[at:]:
            value = value + self.probe(i, rows, exact) * w
            rest -= bound[i]
            compete = (value + (float(rest) if exact else rest)) >= least
            rows, value = rows[compete], value[compete]
        order = np.lexsort((self.ids[rows], -value)) if exact else np.array(sorted(range(len(rows)), key=lambda j: (-value[j], self.ids[rows[j]])), np.int64)
        order = order[:k]
        top = 2**63 - 1
        found = value[order].astype(np.int64) if exact else np.array([max(-top - 1, min(top, int(v))) for v in value[order]], np.int64)
        return self.ids[rows[order]], found


def _cell(k: int):
    def run(index: pa.Table, blocks: pa.Table) -> pa.Table:
        q_out, v_out, s_out = [], [], []
        if index.num_rows and blocks.num_rows:
            row = index.to_pylist()[0]
            raw = {c: np.frombuffer(row[c], t) for c, t in (("ids", np.int64), ("terms", np.int64), ("starts", np.int64), ("rows", np.int32), ("weights", row["kind"]))}
            shard = Shard(**raw)
            for block in blocks.to_pylist():
                ids, starts, terms, weights = (np.frombuffer(block[c], np.int64) for c in ("ids", "starts", "terms", "weights"))
                for j, own in enumerate(ids):
                    part = slice(starts[j], starts[j + 1])
                    v, s = shard.best(int(own), terms[part], weights[part], k)
                    q_out.append(np.full(len(v), own, np.int64))
                    v_out.append(v)
                    s_out.append(s)
        cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        return pa.table({"query_id": cat(q_out), "vec_id": cat(v_out), "score": cat(s_out)})

    return run


def search(items: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` best items of another id, all if there are fewer.

    Both take columns ``id`` (long), ``terms`` (array of long, no term twice) and
    ``weights`` (array of long); other columns are left out. Rows with a null in any of
    these take no part; an empty list has the score 0 with everything. Ties go to the
    smaller id. An id that occurs twice is two items, neither found by a query of that id.
    Equal query rows are one query; rows of one id with other vectors share its ranks.
    A score beyond the range of a long becomes that range's end.
    """
    items, queries = (x.select("id", "terms", "weights").dropna() for x in (items, queries))
    queries = queries.dropDuplicates()
    n_shards = max(1, -(-items.count() // SHARD))
    n_blocks = max(1, -(-queries.count() // BLOCK))
    index = (
        items.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(n_shards)).cast("int"))
        .groupBy("shard")
        .applyInArrow(_index, _INDEX)
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    )
    blocks = (
        queries.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(n_blocks)).cast("int"))
        .groupBy("block")
        .applyInArrow(_block, _BLOCK)
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))))
    )
    found = (
        index.groupBy("shard", "block").cogroup(blocks.groupBy("shard", "block")).applyInArrow(_cell(k), "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def vectors(df: DataFrame, id_column: str, vector: str, scale: int) -> DataFrame:
    """Vectors as ``id, terms, weights``: term i is component i, its weight floor(scale * component).

    Rows with a null id, a null vector, or a null or non-finite component are left out.
    """
    component = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * scale).cast("long"))
    sound = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    places = F.when(F.size(vector) > 0, F.sequence(F.lit(0).cast("long"), F.size(vector).cast("long") - 1)).otherwise(F.array().cast("array<bigint>"))
    return df.where(F.col(id_column).isNotNull() & F.col(vector).isNotNull() & sound).select(
        F.col(id_column).cast("long").alias("id"), places.alias("terms"), component.alias("weights")
    )
