"""Line dedup: documents probe sharded arrays behind a minimal perfect hash, and no lines are joined.

1. Every document emits a 128-bit hash of each distinct line key; the keys found in two
   documents or more are kept, with the smallest document and the number of documents.
2. Their hashes are dealt to shards of bounded size. Each shard builds a minimal perfect
   hash over its hashes; it indexes arrays of fingerprints, counts and first documents.
3. Documents are dealt to blocks of bounded size. A block sends each of its distinct
   hashes once to that hash's shard, where the arrays answer it, so a line that a third of
   all documents hold costs a shard one probe for each block. The hits go back to the block.
4. A block reads its hits and lets its documents go by, dropping the lines that are hit
   and aren't in their first document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.llm import textbytes
from meterlens.llm.store import shards, stored

MIN_POINTS = 10  # code points of a key that may be dropped
SHARD_KEYS = 1 << 17
BLOCK_BYTES = 8 << 20
_WHITE = b" \t\n\x0b\x0c\r"
_LOAD = 2.0  # bits of a level of the perfect hash for each key that reaches it


class PerfectHash:
    """A minimal perfect hash over distinct 64-bit values, as bit arrays by level.

    At each level a key has one bit; keys alone on theirs settle there, the others go on
    to the next level. A key's index is its bit's rank among all set bits.
    """

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks, before = [], 0
        for bits in levels:
            self.ranks.append(np.cumsum(bits, dtype=np.int64) - 1 + before)
            before += int(bits.sum())
        self.size = before

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (textbytes.mix(keys + np.uint64(level * 0x9E3779B97F4A7C15 % 2**64)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys):
            size = max(8, int(_LOAD * len(keys)))
            place = cls._place(keys, len(levels), size)
            alone = np.bincount(place, minlength=size) == 1
            levels.append(alone)
            keys = keys[~alone[place]]
        return cls(levels)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key; any index or -1 for a value that isn't a key."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, bits in enumerate(self.levels):
            place = self._place(keys[left], level, len(bits))
            here = bits[place]
            out[left[here]] = self.ranks[level][place[here]]
            left = left[~here]
        return out

    def dump(self) -> tuple[bytes, list[int]]:
        return b"".join(np.packbits(b).tobytes() for b in self.levels), [len(b) for b in self.levels]

    @classmethod
    def load(cls, raw: bytes, sizes: list[int]) -> PerfectHash:
        levels, at = [], 0
        for size in sizes:
            width = -(-size // 8)
            levels.append(np.unpackbits(np.frombuffer(raw, np.uint8, width, at), count=size).astype(bool))
            at += width
        return cls(levels)


def _hashes(text: str, min_points: int) -> tuple[list[str], list[tuple[int, int] | None]]:
    """The lines of a text and the signed 64-bit halves of each key's hash; None for a short key."""
    lines = text.split("\n")
    out = []
    for line in lines:
        key = line.encode("utf-8", "surrogatepass").strip(_WHITE).lower()  # of bytes, lower() changes A-Z only
        if len(key) < min_points or (len(key) < 4 * min_points and len(key.decode("utf-8", "surrogatepass")) < min_points):
            out.append(None)
            continue
        d = xxhash.xxh3_128_intdigest(key)
        out.append(((d >> 64) - (1 << 63), (d & ((1 << 64) - 1)) - (1 << 63)))
    return lines, out


def _keys(min_points: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            rows = [(i, *h) for i, t in zip(ids, texts, strict=True) for h in {h for h in _hashes(t or "", min_points)[1] if h}]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(3)], ["doc", "h", "fp"])

    return run


def _block_keys(min_points: int):
    """The distinct keys of a block, as they come; a key that comes again in a later batch is sent once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = {(k, *h) for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for h in _hashes(t or "", min_points)[1] if h}
            rows = list(rows)
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[k] for r in rows], pa.int64()) for k in (1, 2))], ["block", "h", "fp"])

    return run


def _arrays(table: pa.Table) -> pa.Table:
    """The arrays of a shard."""
    h = table.column("h").to_numpy().view(np.uint64)
    fp = table.column("fp").to_numpy()
    # Two keys may share one half of the hash: the perfect hash is over both halves.
    keys = textbytes.mix(h ^ textbytes.mix(fp.view(np.uint64)))
    perfect = PerfectHash.build(keys)
    at = perfect.index(keys)
    prints, counts, first = (np.empty(len(h), np.int64) for _ in range(3))
    prints[at], counts[at], first[at] = fp, table.column("n").to_numpy(), table.column("first").to_numpy()
    bits, sizes = perfect.dump()
    return pa.table(
        {
            "shard": table.column("shard").slice(0, 1),
            "bits": [bits],
            "sizes": pa.array([sizes], pa.list_(pa.int32())),
            "prints": [prints.tobytes()],
            "counts": [counts.astype(np.uint32).tobytes()],
            "first": [first.tobytes()],
        }
    )


def _probe(arrays: pa.Table, probes: pa.Table) -> pa.Table:
    """The probes that a shard's arrays hold."""
    if not arrays.num_rows or not probes.num_rows:
        return pa.table({c: pa.array([], t) for c, t in (("block", pa.int32()), ("h", pa.int64()), ("fp", pa.int64()), ("first", pa.int64()))})
    a = arrays.to_pylist()[0]
    perfect = PerfectHash.load(a["bits"], a["sizes"])
    prints, first = np.frombuffer(a["prints"], np.int64), np.frombuffer(a["first"], np.int64)
    h, fp = probes.column("h").to_numpy(), probes.column("fp").to_numpy()
    at = perfect.index(textbytes.mix(h.view(np.uint64) ^ textbytes.mix(fp.view(np.uint64))))
    hit = np.flatnonzero((at >= 0) & (prints[np.maximum(at, 0)] == fp))
    return pa.table({"block": probes.column("block").take(hit), "h": h[hit], "fp": fp[hit], "first": first[at[hit]]})


def _drop(names: list[str], id_at: int, text_at: int, min_points: int):
    def run(docs: pa.Table, hits: pa.Table) -> pa.Table:
        docs = docs.select(range(len(names) - 2))
        first = dict(zip(zip(hits.column("h").to_pylist(), hits.column("fp").to_pylist(), strict=True), hits.column("first").to_pylist(), strict=True))
        texts, total, dropped = [], [], []
        for doc, text in zip(docs.column(id_at).to_pylist(), docs.column(text_at).to_pylist(), strict=True):
            lines, keys = _hashes(text or "", min_points)
            keep = [line for line, k in zip(lines, keys, strict=True) if k is None or doc is None or first.get(k, doc) == doc]
            texts.append("\n".join(keep))
            total.append(len(lines))
            dropped.append(len(lines) - len(keep))
        docs = docs.set_column(text_at, names[text_at], pa.array(texts, pa.string()))
        return docs.append_column("_lines", pa.array(total, pa.int64())).append_column("_dropped", pa.array(dropped, pa.int64())).rename_columns(names)

    return run


def drop_repeated_lines(
    df: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    min_points: int = MIN_POINTS,
    lines_out: str = "n_lines",
    dropped_out: str = "n_dropped",
) -> DataFrame:
    """``df`` with repeated lines taken out of ``text``, the number of lines before, and of those dropped.

    A line's key is the line without ASCII white space at both ends, A-Z lower-cased.
    Keys of at least ``min_points`` code points that two documents hold lose their lines
    in all but the document of the smallest id. A null text is an empty line. A row
    without an id takes no part and keeps its lines; rows of one id are one document.
    Other columns and repeated rows stay; columns of the two new names are replaced.
    """
    names = [c for c in df.columns if c not in (lines_out, dropped_out)]
    n_blocks = shards(df, text, BLOCK_BYTES)
    columns = [F.col(c).alias(f"_{i}") for i, c in enumerate(names)]
    doc, words = f"_{names.index(id_column)}", f"_{names.index(text)}"
    docs = df.select(*columns)
    # Dealt by the hash of the row, so that even many rows of one id come apart.
    docs = docs.withColumn("_block", F.pmod(F.xxhash64(F.col(doc).cast("string"), words), F.lit(n_blocks)).cast("int"))
    known = docs.where(F.col(doc).isNotNull())

    repeated = stored(
        known.select(F.col(doc).cast("long"), words)
        .mapInArrow(_keys(min_points), "doc long, h long, fp long")
        .groupBy("h", "fp")
        .agg(F.min("doc").alias("first"), F.max("doc").alias("last"), F.count("*").alias("n"))
        .where(F.col("first") < F.col("last")),
        "repeated-lines",
    )
    n_shards = max(16 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-repeated.count() // SHARD_KEYS))
    shard = F.pmod("h", F.lit(n_shards)).cast("int")
    arrays = (
        repeated.select(shard.alias("shard"), "h", "fp", "n", "first")
        .groupBy("shard")
        .applyInArrow(_arrays, "shard int, bits binary, sizes array<int>, prints binary, counts binary, first binary")
    )
    probes = (
        known.select("_block", words)
        .mapInArrow(_block_keys(min_points), "block int, h long, fp long")
        .distinct()
        .withColumn("shard", shard)
    )
    hits = arrays.groupBy("shard").cogroup(probes.groupBy("shard")).applyInArrow(_probe, "block int, h long, fp long, first long")
    schema = df.select(*names).withColumns({lines_out: F.lit(0).cast("long"), dropped_out: F.lit(0).cast("long")}).schema
    run = _drop(schema.names, names.index(id_column), names.index(text), min_points)
    return docs.groupBy("_block").cogroup(hits.groupBy("block")).applyInArrow(run, schema)
