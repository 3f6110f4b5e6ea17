"""Substring dedup: paragraph MinHash banding, exact verification, components.

Paragraphs come from a cutting function: ``lines`` here, windows cut by content in
``passages``. Each gets the set of its 5-word
shingles; paragraphs with equal sets are one class. MinHash signatures give bands in which
alike classes always meet (``sure_keys``): where sets are small, each band holds all hashes
of a set in its share of one permutation; lines have bands of many permutations, tuned so
that a pair at the similarity asked for meets nearly always, and their least hashes. Classes that meet in a band become candidate groups by one edge each, so a band that
thousands share costs no more than their number. Inside a group the exact Jaccard
similarity decides (``components.link``), and components of what is alike are removed
but for their first paragraph.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlens.llm import textbytes
from meterlens.llm.components import link
from meterlens.llm.store import fresh, row_key, shards, stored

MIN_WORDS = 25
WIDTH = 5
PERCENT = 80
RECALL = 0.999
MOST_HASHES = 128
SHARD_BYTES = 8 << 20
_SLICE = 2 << 20

#: Paragraphs of a column of texts with so many words at least, as ``lines`` gives them.
Cut = Callable[[pa.Array, int], Iterator[tuple[np.ndarray, ...]]]

#: Classes that share a key are compared by their parities up to so many; larger groups are cut by parts of these first.
MOST_COMPARED = 64
#: How often a group is cut; what is larger even then is a candidate group as it is.
MOST_CUTS = 3
_PACKED = ("band", "of", "cls", "low", "high", "sure", "whose", "parity", "size")
_MEMBER = "doc_id long, row_key long, paragraph long, start long, length long, n_words long, cls long"


def tune_bands(similarity: float, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """The number of bands and of rows in each: the most rows that ``most`` hashes allow at this recall."""
    best = (1, 1)
    for rows in range(1, most + 1):
        meet = similarity**rows
        bands = 1 if meet >= 1 else max(1, math.ceil(math.log(1 - recall) / math.log1p(-meet)))
        if bands * rows > most:
            break
        best = (bands, rows)
    return best


def lines(texts: pa.Array, min_words: int) -> Iterator[tuple[np.ndarray, ...]]:
    """For slices of rows: of each long line its row, number, first character, length, words and set."""
    data, rows = textbytes.buffers(texts)
    for a, b in textbytes.slices(rows, _SLICE):
        ends = rows[a : b + 1]
        part = data[ends[0] : ends[-1]]
        breaks = np.flatnonzero(part == 0x0A) + 1 + ends[0]
        bounds = np.unique(np.concatenate((ends, breaks)))
        hashes, offsets = textbytes.words(data, bounds, textbytes.NOT_SPACE)
        count = np.diff(offsets)
        row = np.searchsorted(ends, bounds[:-1], "right") - 1
        number = np.arange(len(row)) - np.searchsorted(row, row)
        points = np.concatenate(([0], np.cumsum((part & 0xC0) != 0x80)))
        start = points[bounds[:-1] - ends[0]]
        length = points[bounds[1:] - ends[0]] - start
        length -= np.isin(bounds[1:], breaks)  # the line feed is no part of it
        long = np.flatnonzero(count >= min_words)
        keep = np.zeros(len(count), bool)
        keep[long] = True
        words = np.repeat(keep, count)
        grams, at = textbytes.ngram_sets(hashes[words], np.concatenate(([0], np.cumsum(count[long]))), WIDTH)
        yield row[long] + a, number[long], start[long] - points[ends[row[long]] - ends[0]], length[long], count[long], grams, at


def signatures(grams: np.ndarray, offsets: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One key for each set and band: a hash of the band's minima. No set may be empty."""
    rng = np.random.default_rng(99)
    keys = np.zeros((len(offsets) - 1, bands), np.uint64)
    for band in range(bands):
        total = np.full(len(offsets) - 1, textbytes.STEPS[60] ^ np.uint64(band + 1))
        for _ in range(rows):
            a, c = (np.uint64(x) for x in rng.integers(0, 2**63, 2, dtype=np.uint64))
            least = np.minimum.reduceat((grams ^ c) * (a | np.uint64(1)), offsets[:-1])
            total = textbytes.mix(total ^ least)
        keys[:, band] = total
    return keys


def most_different(most: int) -> int:
    """In how many elements two alike sets of at most ``most`` each can differ."""
    return 2 * most * (100 - PERCENT) // (100 + PERCENT)


def parities(grams: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """64 bits of each set, each the parity of the elements hashed to it: sets differ in as many elements as bits, or more."""
    bit = np.uint64(1) << (textbytes.mix(grams ^ textbytes.STEPS[57]) >> np.uint64(58))
    return np.bitwise_xor.reduceat(bit, offsets[:-1])


def sure_keys(grams: np.ndarray, offsets: np.ndarray, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """MinHash keys of one permutation, of which any two sets share one if they are alike (``PERCENT``), and each key's set.

    Alike sets share one of their least hashes, as both hold ``PERCENT`` of the larger one.
    If sets have at most ``most`` elements, they differ in few: dealt to one bin more than
    that, by their hashes, all that one bin holds is equal. A bin's hashes are a key; sets
    in which it is empty meet by the least hashes of the whole.
    """
    count = np.diff(offsets)
    of = np.repeat(np.arange(len(count)), count)
    least = np.arange(len(grams)) - offsets[of] <= (count - (PERCENT * count + 99) // 100)[of]
    of = of[least]
    if most is None:
        return textbytes.mix(grams[least] ^ textbytes.STEPS[59]), of
    parts = most_different(most) + 1
    cell = np.repeat(np.arange(len(count)), count) * parts + (grams % np.uint64(parts)).astype(np.int64)
    held = np.bincount(cell, minlength=len(count) * parts)
    keys = textbytes.set_ids(grams[np.argsort(cell, kind="stable")], np.concatenate(([0], np.cumsum(held))))
    number = textbytes.mix(np.arange(1, parts + 1, dtype=np.uint64) * textbytes.STEPS[58])
    keys = textbytes.mix(keys ^ np.tile(number, len(count)))
    full = held > 0
    found, owner = [keys[full]], [np.repeat(np.arange(len(count)), parts)[full]]
    for part in range(parts):
        empty = ~full[part::parts][of]
        found.append(textbytes.mix(grams[least][empty] ^ number[part]))
        owner.append(of[empty])
    return np.concatenate(found), np.concatenate(owner)


def _members(cut: Cut, min_words: int):
    names = [x.split()[0] for x in _MEMBER.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row, number, start, length, count, grams, at in cut(b.column(2), min_words):
                take = pa.array(row)
                numbers = (number, start, length, count, textbytes.set_ids(grams, at).view(np.int64))
                yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), *(pa.array(x.astype(np.int64)) for x in numbers)], names)
        textbytes.release()

    return run


def _postings(cut: Cut, n_shards: int, min_words: int, bands: int, rows: int, most: int | None):
    """By shard: bands (32 bits of a key beside the shard) with their classes, and classes with the least and greatest document."""
    schema = pa.schema([("shard", pa.int32()), *((x, pa.binary()) for x in _PACKED)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.uint64(n_shards)
        for b in batches:
            document = b.column(1).to_numpy()
            for row, _, _, _, _, grams, at in cut(b.column(0), min_words):
                if not len(row):
                    continue
                ids = textbytes.set_ids(grams, at)
                order = np.lexsort((document[row], ids))
                first = np.flatnonzero(np.concatenate(([True], ids[order][1:] != ids[order][:-1])))  # equal sets of a slice go once
                last = np.append(first[1:], len(order)) - 1
                cls = ids[order[first]]
                keys = signatures(grams, at, bands, rows)[order[first]]
                flat, of = keys.ravel(), np.repeat(cls, bands)
                sure, owner = sure_keys(grams, at, most)
                chosen = np.zeros(len(ids), bool)
                chosen[order[first]] = True
                sure, owner = sure[chosen[owner]], owner[chosen[owner]]
                packed = {}
                if most is None:
                    flat, of = np.concatenate((flat, sure)), np.concatenate((of, ids[owner]))
                else:
                    parts = ((sure // n).astype(np.uint32), ids[owner], parities(grams, at)[owner], np.diff(at)[owner].astype(np.uint16))
                    for k, arrays in textbytes.split_by((sure % n).astype(np.int32), *parts):
                        packed[k] = dict(zip(_PACKED[5:], (x.tobytes() for x in arrays), strict=True))
                for k, (key, c) in textbytes.split_by((flat % n).astype(np.int32), (flat // n).astype(np.uint32), of):
                    packed.setdefault(k, {}).update({"band": key.tobytes(), "of": c.tobytes()})
                for k, parts in textbytes.split_by((cls % n).astype(np.int32), cls, document[row[order[first]]], document[row[order[last]]]):
                    packed.setdefault(k, {}).update(zip(("cls", "low", "high"), (x.tobytes() for x in parts), strict=True))
                yield pa.RecordBatch.from_pylist([{"shard": k, **x} for k, x in packed.items()], schema)
        textbytes.release()

    return run


def _joined(table: pa.Table, name: str, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(x for x in table.column(name).to_pylist() if x), kind)


def _alike_keys(s: np.ndarray, *rest: np.ndarray) -> tuple[np.ndarray, ...]:
    """Entries whose key another one has too, by key and class, once each; the others are left out before the slower sort."""
    order = np.argsort(s)
    s = s[order]
    alike = np.zeros(len(s) + 1, bool)
    alike[1:-1] = s[1:] == s[:-1]
    order = order[alike[1:] | alike[:-1]]
    s, rest = s[alike[1:] | alike[:-1]], [x[order] for x in rest]
    order = np.lexsort((rest[0], s))
    s, rest = s[order], [x[order] for x in rest]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (rest[0][1:] != rest[0][:-1])
    return s[new], *(x[new] for x in rest)


def _star(s: np.ndarray, c: np.ndarray) -> np.ndarray:
    """An edge from the smallest class of a key to each other one in it."""
    first = np.ones(len(s), bool)
    first[1:] = s[1:] != s[:-1]
    least = c[np.maximum.accumulate(np.where(first, np.arange(len(s)), 0))] if len(s) else c
    return np.stack((least[~first], c[~first]), axis=1)


def _near(
    s: np.ndarray, c: np.ndarray, parity: np.ndarray, size: np.ndarray, differ: int, bits: int = 64, cuts: int | None = None
) -> list[np.ndarray]:
    """Edges that connect the classes of a key (entries lie by key) whose sizes and parities (of ``bits``) let them be alike.

    Small groups are compared pair by pair. A large one is taken by the number of elements in
    which its sets can differ, at most ``differ``. Their bits are cut into one part more than
    that: alike sets agree in a part, so each part's value cuts the group, and the other bits
    go on. Nothing alike is left out.
    """
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    group = np.cumsum(new) - 1
    many = np.bincount(group)[group] > MOST_COMPARED
    edges = [np.zeros((0, 2), c.dtype)]
    large = [x[many] for x in (group, c, parity, size)]
    group, c, parity, size = (x[~many] for x in (group, c, parity, size))
    at, step = np.arange(len(group)), 1
    while len(at):
        at = at[at + step < len(group)]
        at = at[group[at] == group[at + step]]
        most = (size[at] + size[at + step]) * (100 - PERCENT) // (100 + PERCENT)
        apart = np.maximum(np.bitwise_count(parity[at] ^ parity[at + step]), np.abs(size[at] - size[at + step]))
        near = at[(apart <= most) & (most > 0)]
        edges.append(np.stack((c[near], c[near + step]), axis=1))
        step += 1
    group, c, parity, size = large
    if not len(group):
        return edges
    if cuts is None:
        largest = 100 * size // PERCENT
        can = np.minimum((size + largest) * (100 - PERCENT) // (100 + PERCENT), differ)
        for most in np.unique(can[can > 0]).tolist():
            some = (size >= size[can == most].min()) & (size <= largest[can == most].max())
            edges += _near(group[some], c[some], parity[some], size[some], most, bits, MOST_CUTS)
    elif not cuts:
        edges.append(_star(group, c))
    else:
        order = np.lexsort((size, parity, group))
        group, c, parity, size = (x[order] for x in (group, c, parity, size))
        new = np.ones(len(group), bool)
        new[1:] = (group[1:] != group[:-1]) | (parity[1:] != parity[:-1]) | (size[1:] != size[:-1])
        edges.append(_star(np.cumsum(new), c))
        group, c, parity, size = (x[new] for x in (group, c, parity, size))
        for part in range(differ + 1):
            low, high = (np.uint64(bits * k // (differ + 1)) for k in (part, part + 1))
            value = (parity >> low) & ((np.uint64(1) << (high - low)) - np.uint64(1))
            others = ((parity >> high) << low) | (parity & ((np.uint64(1) << low) - np.uint64(1)))
            order = np.lexsort((value, group))
            new = np.ones(len(order), bool)
            new[1:] = (group[order][1:] != group[order][:-1]) | (value[order][1:] != value[order][:-1])
            edges += _near(np.cumsum(new), c[order], others[order], size[order], differ, bits - int(high - low), cuts - 1)
    return [np.unique(np.concatenate(edges), axis=0)]


def _meetings(differ: int):
    """Edges that connect the classes of a band, or those of another key that can be alike, and one from each class of two documents to itself."""

    def run(table: pa.Table) -> pa.Table:
        edges = [_star(*_alike_keys(_joined(table, "band", np.uint32), _joined(table, "of", np.int64)))]
        kinds = (np.uint32, np.int64, np.uint64, np.uint16)
        key, whose, parity, size = _alike_keys(*(_joined(table, x, kind) for x, kind in zip(_PACKED[5:], kinds, strict=True)))
        pairs = np.unique(np.concatenate(edges + _near(key, whose, parity, size.astype(np.int64), differ)), axis=0)

        c, low, high = (_joined(table, x, np.int64) for x in ("cls", "low", "high"))
        order = np.argsort(c, kind="stable")
        c, low, high = c[order], low[order], high[order]
        starts = np.flatnonzero(np.concatenate(([True], c[1:] != c[:-1]))) if len(c) else np.zeros(0, np.int64)
        several = np.minimum.reduceat(low, starts) < np.maximum.reduceat(high, starts) if len(c) else np.zeros(0, bool)
        own = c[starts][several]
        return pa.table({"a": np.concatenate((pairs[:, 0], own)), "b": np.concatenate((pairs[:, 1], own))})

    return run


def _wanted_sets(cut: Cut, min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            wanted = [set(x) for x in b.column(1).to_pylist()]
            for row, _, _, _, _, grams, at in cut(b.column(0), min_words):
                cls = textbytes.set_ids(grams, at).view(np.int64)
                keep = [k for k in range(len(row)) if int(cls[k]) in wanted[row[k]]]
                raw = [grams[at[k] : at[k + 1]].tobytes() for k in keep]
                yield pa.RecordBatch.from_arrays([pa.array(cls[keep]), pa.array(np.diff(at)[keep]), pa.array(raw, pa.binary())], ["cls", "n", "grams"])

    return run


def _place() -> Column:
    """What orders paragraphs and tells documents apart: an id, or for a row without one its key after all ids."""
    none = F.col("doc_id").isNull()
    return F.struct(none.alias("none"), F.coalesce("doc_id", "row_key").alias("doc"))


def keyed(df: DataFrame, id_column: str, text: str) -> DataFrame:
    """``doc_id, row_key, text`` of the rows."""
    return df.select(F.col(id_column).cast("long").alias("doc_id"), row_key(id_column, text).alias("row_key"), F.col(text).alias("text"))


def repeated(docs: DataFrame, cut: Cut, min_words: int, bands: int = 0, rows: int = 0, most: int | None = None) -> DataFrame:
    """The paragraphs of ``docs`` (``keyed``) that another document repeats, each with ``component, component_id, own, removed``.

    ``own``: it is in the document that holds the first paragraph of its component.
    ``most`` is the number of shingles that a paragraph of ``cut`` has at most, if there is one.
    Members are written straight from the texts, so rows with equal paragraphs never meet in
    one task; the shards of bands get each class once for a slice of texts, and say which
    classes go on: those of two documents, and those that meet another.
    """
    n_shards = shards(docs, "text", SHARD_BYTES)
    written = stored(docs.mapInArrow(_members(cut, min_words), _MEMBER), "paragraphs")
    packed = docs.select("text", F.xxhash64(_place()).alias("document")).mapInArrow(
        _postings(cut, n_shards, min_words, bands, rows, most), f"shard int, {', '.join(f'{x} binary' for x in _PACKED)}"
    )
    found = stored(packed.groupBy("shard").applyInArrow(_meetings(most_different(most or 0)), "a long, b long"), "meetings")
    pairs = found.where("a <> b").distinct()
    # written, so that nothing but the join rides on its shuffle, and a class of many rows can be split
    several = stored(found.select(F.col("a").alias("node")).union(found.select("b")).distinct(), "several")
    members = stored(written.join(several, F.col("cls") == F.col("node"), "left_semi"), "paragraph-members").withColumn("place", _place())

    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    here = F.struct("place", "paragraph", "doc_id", "row_key")
    classes = stored(
        members.groupBy("cls").agg(F.min(here).alias("first"), F.min("place").alias("low"), F.max("place").alias("high"), F.min("doc_id").alias("least")), "paragraph-classes"
    )
    wanted = classes.join(nodes, F.col("cls") == F.col("node"), "left_semi").groupBy("first.doc_id", "first.row_key").agg(F.collect_list("cls").alias("wanted"))
    wanted = stored(wanted.select(F.col("doc_id").alias("_id"), F.col("row_key").alias("_key"), "wanted"), "wanted")
    chosen = docs.join(wanted, (F.col("row_key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    sets = stored(chosen.select("text", "wanted").mapInArrow(_wanted_sets(cut, min_words), "cls long, n long, grams binary"), "paragraph-sets")
    linked = link(sets, pairs, PERCENT)

    alike = stored(classes.join(linked, "cls", "left").withColumn("component", F.coalesce("component", "cls")), "alike")
    shared = (
        alike.groupBy("component")
        .agg(F.min("first").alias("kept"), F.min("low").alias("low"), F.max("high").alias("high"), F.min("least").alias("component_id"))
        .where("low <> high")
    )
    again = alike.select("cls", "component").join(shared, "component").select("cls", "component", "component_id", "kept")
    own = F.col("place") == F.col("kept.place")
    joined = members.join(again, "cls").withColumns({"own": own, "removed": ~(own & (F.col("paragraph") == F.col("kept.paragraph")))})
    return joined.drop("place", "kept", "cls")


def repeats(df: DataFrame, id_column: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``doc_id, row_key, paragraph, start, length, n_words, component_id, removed`` of every repeated line.

    A paragraph is repeated if its component holds paragraphs of two documents or more.
    ``paragraph`` counts the lines of the text from 0; ``start`` and ``length`` are in
    characters. ``component_id`` is the smallest id in the component, and all but the
    first paragraph, by id and place, are ``removed``. Null and empty texts have none;
    rows of one id are one document; a row without an id comes after all ids, and a
    component of such rows only has a null id.
    """
    columns = ("doc_id", "row_key", "paragraph", "start", "length", "n_words", "component_id", "removed")
    return repeated(keyed(df, id_column, text), lines, min_words, *tune_bands(PERCENT / 100)).select(*columns)


def remove_repeats(df: DataFrame, id_column: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``df`` with the removed paragraphs taken out of ``text``; a text without any stays as it is, null too."""
    gone = repeats(df, id_column, text, min_words).where("removed").distinct().groupBy("doc_id", "row_key").agg(F.collect_set("paragraph").alias("_gone"))
    own, doc, key, lines_gone = (fresh(df, x) for x in ("_own", "_id", "_key", "_gone"))
    gone = gone.select(F.col("doc_id").alias(doc), F.col("row_key").alias(key), F.col("_gone").alias(lines_gone))
    joined = df.withColumn(own, row_key(id_column, text)).join(gone, (F.col(own) == F.col(key)) & F.col(id_column).cast("long").eqNullSafe(F.col(doc)), "left")
    kept = F.array_join(F.filter(F.split(F.col(text), "\n", -1), lambda x, i: ~F.array_contains(lines_gone, i.cast("long"))), "\n")
    return joined.withColumn(text, F.when(F.col(lines_gone).isNull(), F.col(text)).otherwise(kept)).select(*df.columns)
