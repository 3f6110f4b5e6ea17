"""N-gram Jaccard join by vertical partitioning of the global n-gram order.

1. Every document becomes the set of its hashed n-grams, and equal sets are one class.
   In hash order, two similar sets share at least k n-grams of their first ones, so only
   these are dealt to shards. A class with fewer than k n-grams there that a class of
   fitting size has too can't be similar to any and goes no further.
2. For the classes that remain, whole sets are dealt to shards, which count how many
   classes hold each n-gram. By these counts, rarest first, a set's prefix is found:
   similar sets share an n-gram of their prefixes. Classes that share one are joined to
   a candidate group by one edge each, so frequent n-grams cost no more than their count.
3. Inside a group the n-gram order is cut into fragments; overlaps are counted by
   fragment, summed by pair, and pairs that reach the similarity are linked
   (``components.link``). The components of the links are the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.llm import textbytes
from meterlens.llm.components import link
from meterlens.llm.store import fresh, row_key, shards, stored

WIDTH = 5
PERCENT = 80
SHARD_BYTES = 16 << 20
_SLICE = 2 << 20

_POSTINGS = "shard int, s binary, c binary, t binary, q binary"


def needed(n: np.ndarray) -> np.ndarray:
    """How many elements of a set of ``n`` a similar set has at least."""
    return -(-PERCENT * n // 100)


def shared(n: np.ndarray) -> np.ndarray:
    """The k of step 1: how many elements of both prefixes sets of ``n`` elements or more share."""
    return np.maximum(1, n // 10)


def sets_of(texts: pa.Array, width: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For slices of rows: first row, last row, and the n-gram sets and offsets of its rows."""
    data, rows = textbytes.buffers(texts)
    for start, stop in textbytes.slices(rows, _SLICE):
        yield start, stop, *textbytes.ngram_sets(*textbytes.words(data, rows[start : stop + 1], textbytes.NOT_SPACE), width)


def postings(shard: np.ndarray, grams: np.ndarray, row: np.ndarray, table: np.ndarray, extra: np.ndarray) -> Iterator[dict]:
    """Postings by shard, packed: elements, places in a table of sets, the table, and a value for each of its sets."""
    for k, (s, r) in textbytes.split_by(shard, grams, row):
        used, place = np.unique(r, return_inverse=True)
        yield {"shard": k, "s": s.tobytes(), "c": place.astype(np.uint32).tobytes(), "t": table[used].tobytes(), "q": extra[used].tobytes()}


def unpacked(table: pa.Table, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Element, set and its value of all postings of a shard, ordered by element and set, each once."""
    s, c, q = [], [], []
    for row in table.select(["s", "c", "t", "q"]).to_pylist():
        if row["s"] is not None:
            place = np.frombuffer(row["c"], np.uint32)
            s.append(np.frombuffer(row["s"], np.uint64))
            c.append(np.frombuffer(row["t"], np.int64)[place])
            q.append(np.frombuffer(row["q"], kind)[place])
    if not s:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, kind)
    s, c, q = (np.concatenate(x) for x in (s, c, q))
    order = np.argsort(s)
    s, c, q = s[order], c[order], q[order]
    # What stands alone is left out before the slower sort.
    alike = np.zeros(len(s) + 1, bool)
    alike[1:-1] = s[1:] == s[:-1]
    keep = alike[1:] | alike[:-1]
    s, c, q = s[keep], c[keep], q[keep]
    order = np.lexsort((c, q, s))
    s, c, q = s[order], c[order], q[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (c[1:] != c[:-1])
    return s[new], c[new], q[new]


def _first_pass(n_shards: int, width: int):
    schema = pa.schema(
        [("shard", pa.int32()), *((x, pa.binary()) for x in "sctq"), ("doc_id", pa.int64()), ("row_key", pa.int64()), ("cls", pa.int64()), ("n", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start, stop, grams, ends in sets_of(b.column(2), width):
                n = np.diff(ends)
                cls = textbytes.set_ids(grams, ends).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((cls.view(np.uint64) % np.uint64(n_shards)).astype(np.int32)),
                        *[pa.nulls(stop - start, pa.binary())] * 4,
                        b.column(0).slice(start, stop - start),
                        b.column(1).slice(start, stop - start),
                        pa.array(cls),
                        pa.array(n),
                    ],
                    schema=schema,
                )
                row = np.repeat(np.arange(stop - start), n)
                prefix = np.minimum(n, n - needed(n) + shared(n))
                first = np.arange(len(grams)) - ends[:-1][row] < prefix[row]
                grams, row = grams[first], row[first]
                # Sets whose sizes fit are in the same or neighbouring classes of size.
                fits = np.floor(np.log(np.maximum(n, 1)) / np.log(100 / PERCENT) + 1e-9).astype(np.uint8)
                packed = list(postings((grams % np.uint64(n_shards)).astype(np.int32), grams, row, cls, fits))
                yield pa.RecordBatch.from_pylist(packed, schema)
        textbytes.release()

    return run


def _partners(table: pa.Table) -> pa.Table:
    """By class, the n-grams of this shard that a class of fitting size has too; and the documents as they came."""
    s, c, q = unpacked(table, np.uint8)
    beside = np.zeros(len(s) + 1, bool)
    beside[1:-1] = (s[1:] == s[:-1]) & (q[1:] - q[:-1] <= 1)
    found, count = np.unique(c[beside[1:] | beside[:-1]], return_counts=True)
    docs = table.filter(table.column("cls").is_valid()).select(["doc_id", "row_key", "cls", "n"])
    nulls = pa.nulls(len(found), pa.int64())
    sums = pa.table({"doc_id": nulls, "row_key": nulls, "cls": found.astype(np.int64), "n": nulls, "common": count.astype(np.int64)})
    return pa.concat_tables([docs.append_column("common", pa.nulls(docs.num_rows, pa.int64())), sums])


def _whole_sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, _, grams, ends in sets_of(b.column(0), width):
                raw = [grams[x:y].tobytes() for x, y in zip(ends, ends[1:], strict=False)]
                cls = textbytes.set_ids(grams, ends).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(cls), pa.array(np.diff(ends)), pa.array(raw, pa.binary())], ["cls", "n", "grams"])
        textbytes.release()

    return run


def _deal(n_shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("shard", pa.int32()), *((x, pa.binary()) for x in "sctq")])
        for whole in batches:
            for at in range(0, len(whole), 2000):
                b = whole.slice(at, 2000)
                n, cls = b.column(1).to_numpy(), b.column(0).to_numpy()
                grams = np.frombuffer(b"".join(b.column(2).to_pylist()), np.uint64)
                row = np.repeat(np.arange(len(b)), n)
                packed = list(postings((grams % np.uint64(n_shards)).astype(np.int32), grams, row, cls, n))
                yield pa.RecordBatch.from_pylist(packed, schema)

    return run


def _counted(table: pa.Table) -> pa.Table:
    """By class, its n-grams of this shard that other classes have too, and how many have each."""
    s, c, n = unpacked(table, np.int64)
    starts = np.flatnonzero(np.concatenate(([True], s[1:] != s[:-1]))) if len(s) else np.zeros(0, np.int64)
    count = np.repeat(np.diff(np.append(starts, len(s))), np.diff(np.append(starts, len(s))))
    keep = count > 1
    order = np.argsort(c[keep], kind="stable")
    s, c, n, count = s[keep][order], c[keep][order], n[keep][order], count[keep][order]
    cls, at = np.unique(c, return_index=True)
    ends = np.append(at[1:], len(c))
    return pa.table(
        {
            "cls": cls.astype(np.int64),
            "n": n[at] if len(at) else np.zeros(0, np.int64),
            "s": pa.array([s[x:y].tobytes() for x, y in zip(at, ends, strict=False)], pa.binary()),
            "count": pa.array([count[x:y].astype(np.uint32).tobytes() for x, y in zip(at, ends, strict=False)], pa.binary()),
        }
    )


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The n-grams of each class's prefix that other classes have too."""
    for b in batches:
        s_out, c_out = [], []
        for row in b.to_pylist():
            s = np.frombuffer(b"".join(p["s"] for p in row["parts"]), np.uint64)
            count = np.frombuffer(b"".join(p["count"] for p in row["parts"]), np.uint32)
            n = row["n"]
            left = int(n - needed(np.int64(n)) + 1 - (n - len(s)))  # those that no other class has come first
            if left > 0:
                s = s[np.lexsort((s, count))[:left]]
                s_out.append(s.view(np.int64))
                c_out.append(np.full(len(s), row["cls"], np.int64))
        cat = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(cat(s_out)), pa.array(cat(c_out))], ["s", "cls"])


def candidates(sets: DataFrame) -> DataFrame:
    """Edges ``a, b`` that join classes sharing an n-gram of their prefixes: one edge for each class and n-gram."""
    total = sets.agg(F.sum("n")).head()[0] or 0
    n_shards = max(16, -(-total // (2 << 20)))
    counted = sets.select("cls", "n", "grams").mapInArrow(_deal(n_shards), _POSTINGS).groupBy("shard").applyInArrow(_counted, "cls long, n long, s binary, count binary")
    whole = counted.groupBy("cls").agg(F.max("n").alias("n"), F.collect_list(F.struct("s", "count")).alias("parts"))
    prefixes = stored(whole.mapInArrow(_prefixes, "s long, cls long"), "prefixes")
    least = prefixes.groupBy("s").agg(F.min("cls").alias("a"))
    return prefixes.join(least, "s").where("cls <> a").select("a", F.col("cls").alias("b")).distinct()


def similar(df: DataFrame, id_column: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """``doc_id, row_key, n_shingles, component_id`` of every row of ``df``; ``component_id`` is the smallest id reachable.

    Words are runs of what isn't ASCII white space, A-Z lower-cased; a text of fewer than
    ``width`` words has them all as its only n-gram. A null text, or one without words,
    is linked with nothing. Rows of one id are one document to the result. A row without
    an id takes part, but isn't the smallest; its component is null if it meets no id.
    """
    docs = df.select(F.col(id_column).cast("long").alias("doc_id"), row_key(id_column, text).alias("row_key"), F.col(text).alias("text"))
    n_shards = shards(df, text, SHARD_BYTES)
    first = docs.mapInArrow(_first_pass(n_shards, width), _POSTINGS + ", doc_id long, row_key long, cls long, n long")
    rows = stored(first.groupBy("shard").applyInArrow(_partners, "doc_id long, row_key long, cls long, n long, common long"), "classes")
    least = F.min(F.when(F.col("n").isNotNull(), F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key")))
    classes = rows.groupBy("cls").agg(
        F.max("n").alias("n"), F.sum("common").alias("common"), F.count("n").alias("documents"), least.alias("first"), F.min("doc_id").alias("least")
    )
    enough = F.greatest(F.lit(1), F.expr(f"(({PERCENT} * n + 99) div 100) div 10"))
    left = classes.where((F.col("n") > 0) & (F.col("common") >= enough)).select(F.col("first.doc_id").alias("_id"), F.col("first.row_key").alias("_key"))
    chosen = docs.join(left, (F.col("row_key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    sets = stored(chosen.select("text").mapInArrow(_whole_sets(width), "cls long, n long, grams binary"), "sets")
    linked = stored(link(sets, candidates(sets), PERCENT), "linked")

    known = classes.where((F.col("n") > 0)).join(linked, "cls", "left")
    known = known.where((F.col("documents") > 1) | F.col("component").isNotNull()).select("cls", "least", F.coalesce("component", "cls").alias("component"))
    known = stored(known, "known")
    smallest = known.groupBy("component").agg(F.min("least").alias("component_id"))
    answer = known.join(smallest, "component").select("cls", "component_id")
    members = rows.where(F.col("n").isNotNull()).join(answer.withColumn("_found", F.lit(True)), "cls", "left")
    return members.select(
        "doc_id", "row_key", F.col("n").alias("n_shingles"), F.when(F.col("_found"), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


def keep_one(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with the document of the smallest id of each component only; null ids go where an id is in the component."""
    found = similar(df, id_column, text)
    gone = found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id", "row_key").distinct()
    key = fresh(df, "_key")
    keyed = df.withColumn(key, row_key(id_column, text))
    match = (keyed[key] == gone["row_key"]) & keyed[id_column].cast("long").eqNullSafe(gone["doc_id"])
    return keyed.join(gone, match, "left_anti").select(*df.columns)
