"""Benchmark decontamination: a distributed positional inverted index, searched for phrases.

``build_index`` stores the postings of every training token. The index is cut by
documents: a segment holds some megabytes of whole texts, with each term's positions in
increasing order, so a phrase is found inside one segment and no posting is shuffled.
``search`` looks for the windows of benchmark items: a window's lists are intersected,
each shifted by the term's place in the window, beginning with the rarest term. A window
with a term that the segment doesn't hold costs one look-up.

The benchmark goes to the segments in blocks of bounded size, one after the other, so
neither the driver nor a task holds it whole.
"""

from __future__ import annotations

import functools
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.llm import textbytes
from meterlens.llm.store import fresh, row_key, stored

SEGMENT_BYTES = 2 << 20
BLOCK_BYTES = 4 << 20
WIDTH = 13
#: A document is contaminated if at least one word in so many is hit.
SHARE = 20

_INDEX = "segment long, doc_ids array<long>, row_keys array<long>, n_words array<long>, terms binary, starts binary, positions binary"
_MATCH = "segment long, ordinal int, item_id string, kind string, spans array<struct<start:int,end:int>>"


def _postings(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct terms in order, where each one's positions start, and the positions."""
    order = None
    if len(hashes) < 1 << 20:  # one sort of hash and position; 44 bits of the hash nearly always tell all apart
        low = np.uint64((1 << 20) - 1)
        key = np.sort((hashes & ~low) | np.arange(len(hashes), dtype=np.uint64))
        order = (key & low).astype(np.int64)
        tried = hashes[order]
        if np.any((tried[1:] != tried[:-1]) & ((key[1:] & ~low) == (key[:-1] & ~low))):
            order = None
    if order is None:
        order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    starts = np.flatnonzero(new)
    return ordered[starts], np.append(starts, len(ordered)), order


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    n = TaskContext.get().partitionId() << 32
    for b in batches:
        data, rows = textbytes.buffers(b.column(2))
        for start, stop in textbytes.slices(rows, SEGMENT_BYTES):
            hashes, ends = textbytes.words(data, rows[start : stop + 1], textbytes.ALNUM)
            terms, starts, positions = _postings(hashes)
            n += 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([n], pa.int64()),
                    *(pa.array([b.column(k).slice(start, stop - start).to_pylist()], pa.list_(pa.int64())) for k in (0, 1)),
                    pa.array([np.diff(ends)], pa.list_(pa.int64())),
                    *(pa.array([x.astype(t).tobytes()], pa.binary()) for x, t in ((terms, np.uint64), (starts, np.uint32), (positions, np.uint32))),
                ],
                ["segment", "doc_ids", "row_keys", "n_words", "terms", "starts", "positions"],
            )
    textbytes.release()


def build_index(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored positional index of whole texts: a row for each segment.

    Words are runs of ASCII letters, digits and whatever isn't ASCII, A-Z lower-cased. A
    null text has no words. Null and repeated ids and repeated rows are kept as they are:
    inside the index a document is a place in a segment.
    """
    rows = df.select(F.col(id_column).cast("long"), row_key(id_column, text), F.col(text))
    return stored(rows.mapInArrow(_segments, _INDEX), "positions")


def documents(index: DataFrame) -> DataFrame:
    """``segment, ordinal, doc_id, row_key, n_words`` of every document of an index."""
    parts = F.arrays_zip("doc_ids", "row_keys", "n_words")
    return index.select("segment", F.posexplode(parts).alias("ordinal", "d")).select("segment", "ordinal", "d.doc_ids", "d.row_keys", "d.n_words").toDF(
        "segment", "ordinal", "doc_id", "row_key", "n_words"
    )


def _windows(items: list[tuple[str | None, str]], width: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """The distinct terms, and by length of window the term numbers of each window and its item's number."""
    column = pa.array([t for _, t in items], pa.string())
    data, rows = textbytes.buffers(column)
    hashes, ends = textbytes.words(data, rows, textbytes.ALNUM)
    terms, number = np.unique(hashes, return_inverse=True)
    by_length = defaultdict(list)
    for i in range(len(items)):
        own = number[ends[i] : ends[i + 1]]
        n = min(width, len(own))
        if n:
            windows = np.unique(np.lib.stride_tricks.sliding_window_view(own, n), axis=0)
            by_length[n].append((windows, np.full(len(windows), i)))
    return terms, [tuple(np.concatenate(x) for x in zip(*parts, strict=True)) for parts in by_length.values()]


def _within(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


def _near(lists: list[np.ndarray], doc_of, near: int) -> tuple[np.ndarray, np.ndarray]:
    """Spans around positions of the rarest term that hold every other term at most ``near`` words away, in one document."""
    middle = lists[0]
    low, high, fine = middle.copy(), middle.copy(), np.ones(len(middle), bool)
    for other in lists[1:]:
        at = np.searchsorted(other, middle)
        before, after = other[np.maximum(at - 1, 0)], other[np.minimum(at, len(other) - 1)]
        own = doc_of(middle)
        gaps = [np.where(doc_of(x) == own, np.abs(x - middle), near + 1) for x in (before, after)]
        nearest = np.where(gaps[0] <= gaps[1], before, after)
        fine &= np.minimum(*gaps) <= near
        low, high = np.minimum(low, nearest), np.maximum(high, nearest)
    return low[fine], high[fine] + 1


def _find(items: list[tuple[str | None, str]], width: int, near: int | None, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    vocabulary, groups = _windows(items, width)
    for b in batches:
        for r in range(len(b)):
            terms, starts, positions = (
                np.frombuffer(b.column(c)[r].as_buffer(), t) for c, t in (("terms", np.uint64), ("starts", np.uint32), ("positions", np.uint32))
            )
            if not len(terms):
                continue
            starts, segment = starts.astype(np.int64), b.column("segment")[r].as_py()
            bounds = np.concatenate(([0], np.cumsum(b.column("n_words")[r].values.to_numpy())))
            doc_of = lambda p, bounds=bounds: np.searchsorted(bounds, p, "right") - 1
            at = np.minimum(np.searchsorted(terms, vocabulary), len(terms) - 1)
            held = terms[at] == vocabulary
            sizes = np.where(held, starts[at + 1] - starts[at], 0)
            found = defaultdict(list)
            for windows, owner in groups:
                n = windows.shape[1]
                counts = sizes[windows]
                for w in np.flatnonzero(counts.min(axis=1) > 0):
                    rarest = np.argsort(counts[w], kind="stable")
                    lists = [positions[starts[at[t]] : starts[at[t] + 1]].astype(np.int64) for t in windows[w][rarest]]
                    first = lists[0] - rarest[0]
                    for k, other in zip(rarest[1:], lists[1:], strict=True):
                        first = first[_within(first + k, other)]
                        if not len(first):
                            break
                    first = first[first >= 0]
                    first = first[doc_of(first) == doc_of(first + n - 1)]
                    if len(first):
                        found[owner[w], "phrase"].append((first, first + n))
                    if near is not None:
                        low, high = _near(lists, doc_of, near)
                        if len(low):
                            found[owner[w], "proximity"].append((low, high))
            rows = []
            for (item, kind), parts in found.items():
                low, high = (np.concatenate(x) for x in zip(*parts, strict=True))
                order = np.argsort(low, kind="stable")
                low, high = low[order], np.maximum.accumulate(high[order])
                own = doc_of(low)
                new = np.ones(len(low), bool)
                new[1:] = (low[1:] > high[:-1]) | (own[1:] != own[:-1])
                begin = np.flatnonzero(new)
                last = np.append(begin[1:], len(low)) - 1
                spans = defaultdict(list)
                for d, x, y in zip(own[begin], low[begin], high[last], strict=True):
                    spans[int(d)].append({"start": int(x - bounds[d]), "end": int(y - bounds[d])})
                rows += [{"segment": segment, "ordinal": d, "item_id": items[item][0], "kind": kind, "spans": v} for d, v in spans.items()]
            yield pa.RecordBatch.from_pylist(rows, _schema())
    textbytes.release()


@functools.cache
def _schema() -> pa.Schema:
    span = pa.struct([("start", pa.int32()), ("end", pa.int32())])
    return pa.schema([("segment", pa.int64()), ("ordinal", pa.int32()), ("item_id", pa.string()), ("kind", pa.string()), ("spans", pa.list_(span))])


def search(index: DataFrame, items: DataFrame, item_id: str = "item_id", text: str = "text", width: int = WIDTH, near: int | None = None) -> DataFrame:
    """``segment, ordinal, item_id, kind, spans``: where windows of items occur in a stored index.

    A window is ``width`` following words of an item; an item of fewer words, but not
    none, is one window. ``spans`` are the merged word ranges of an item's windows in a
    document. ``kind`` is "phrase", or with ``near`` also "proximity": all words of a window
    in any order, each at most ``near`` words from the rarest one. Null texts have no
    words; a null id stays null; items with the same id are one in what callers count.
    """
    rows = items.select(F.col(item_id).cast("string").alias("id"), F.col(text).alias("text")).where(F.col("text").isNotNull())
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).head()[0] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    spark = index.sparkSession
    out = spark.createDataFrame([], _MATCH)
    for k in range(blocks):
        part = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k).distinct().orderBy("id", "text").collect()
        if part:
            found = functools.partial(_find, [(r["id"], r["text"]) for r in part], width, near)
            hits = index.select("segment", "n_words", "terms", "starts", "positions").mapInArrow(found, _MATCH)
            out = hits if k == 0 else out.unionByName(hits)
    return out


def contamination(df: DataFrame, items: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, row_key, n_words, n_hit, n_items, items, contaminated`` of every row of ``df``.

    A word inside any phrase match is hit; a document is contaminated if ``SHARE`` times
    its hit words are at least its words, and some are hit. ``items`` are the sorted ids of
    the items found; an item without an id counts for the words, not among these.
    """
    index = build_index(df, id_column, text)
    spans = F.array_sort(F.flatten(F.collect_list("spans")))
    # Sorted by start, each span adds the words beyond the furthest end before it.
    union = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("hit"), F.lit(0).alias("until")),
        lambda a, x: F.struct(
            (a["hit"] + F.greatest(F.lit(0), x["end"] - F.greatest(x["start"], a["until"]))).alias("hit"),
            F.greatest(a["until"], x["end"]).alias("until"),
        ),
    )["hit"]
    matches = search(index, items).groupBy("segment", "ordinal").agg(union.alias("n_hit"), F.array_sort(F.collect_set("item_id")).alias("items"))
    joined = documents(index).join(matches, ["segment", "ordinal"], "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    found = F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(
        "doc_id",
        "row_key",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(found).cast("long").alias("n_items"),
        found.alias("items"),
        ((n_hit > 0) & (n_hit * SHARE >= F.col("n_words"))).alias("contaminated"),
    )


def decontaminate(df: DataFrame, items: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` without its contaminated rows; of repeated rows all stay or go, and a null id is like any other."""
    bad = contamination(df, items, id_column, text).where("contaminated").select("doc_id", "row_key").distinct()
    key = fresh(df, "_key")
    keyed = df.withColumn(key, row_key(id_column, text))
    gone = (keyed[key] == bad["row_key"]) & keyed[id_column].cast("long").eqNullSafe(bad["doc_id"])
    return keyed.join(bad, gone, "left_anti").select(*df.columns)
