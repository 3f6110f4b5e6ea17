"""Repeated passages wherever lines end: MinHash banding of paragraphs that are cut by content.

Words whose hash is the least of their neighbours' mark places of a text by what stands
there, so that a passage has the same places in every document. The ``WINDOW`` words around
a place are a paragraph. These go through ``paragraphs.repeated``: bands, exact Jaccard,
components. What lies beside a removed paragraph and beside the one of its component that
stays is then compared word by word, so that a passage is found up to its ends and not only
as far as its paragraphs reach. Matches that touch are joined to spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlens.llm import textbytes
from meterlens.llm.paragraphs import MIN_WORDS, WIDTH, keyed, repeated
from meterlens.llm.store import fresh, row_key, stored

WINDOW = 24
#: Words on either side of which a cut is the least: cuts are about twice that apart.
REACH = 8
#: Words on either side of a paragraph that are compared.
BESIDE = 32
#: Words that a span has at least, unless it is a whole text of ``MIN_WORDS``.
SPAN = 50
#: Fewer words between two matches than a shingle has belong to the span.
GAP = WIDTH - 1
_SLICE = 2 << 20


def _slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For slices of rows: the first row, the bytes, the rows' offsets, and the words' hashes and offsets by row."""
    data, rows = textbytes.buffers(texts)
    for a, b in textbytes.slices(rows, _SLICE):
        yield a, data, rows[a : b + 1], *textbytes.words(data, rows[a : b + 1], textbytes.NOT_SPACE)


def _cuts(hashes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Words at which the hash of three words is the least of ``REACH`` on either side; each row with words has one.

    Of equal ones the first counts, and each eighth word of a stretch that repeats itself.
    """
    n = len(hashes)
    if not n:
        return np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    padded = np.concatenate((hashes, np.zeros(2, np.uint64)))
    inside = np.zeros((2, n), bool)
    inside[0, :-1], inside[1, :-2] = row[1:] == row[:-1], row[2:] == row[:-2]
    sums = textbytes.mix(
        hashes + np.where(inside[0], padded[1:-1], np.uint64(0)) * textbytes.STEPS[0] + np.where(inside[1], padded[2:], np.uint64(0)) * textbytes.STEPS[1]
    )
    most = ~np.uint64(0)
    place = np.arange(n) + (row + 1) * REACH  # rows stand apart, so that none sees its neighbours
    wide = np.full(int(place[-1]) + REACH + 1, most)
    wide[place] = sums
    left, right = np.full(len(wide), most), np.full(len(wide), most)
    for k in range(1, REACH + 1):
        left[k:] = np.minimum(left[k:], wide[:-k])
        right[:-k] = np.minimum(right[:-k], wide[k:])
    left, right = left[place], right[place]
    return np.flatnonzero((sums <= right) & ((sums < left) | ((sums == left) & ((np.arange(n) - offsets[row]) % 8 == 0))))


def windows(texts: pa.Array, min_words: int) -> Iterator[tuple[np.ndarray, ...]]:
    """As ``paragraphs.lines``: the words around each cut, numbered by their first word; characters aren't counted."""
    for a, _, _, hashes, offsets in _slices(texts):
        cuts = _cuts(hashes, offsets)
        row = np.searchsorted(offsets, cuts, "right") - 1
        enough = np.diff(offsets)[row] >= min_words
        cuts, row = cuts[enough], row[enough]
        first = np.unique(np.clip(cuts - WINDOW // 2, offsets[row], offsets[row + 1] - WINDOW))
        row = np.searchsorted(offsets, first, "right") - 1
        grams, at = textbytes.ngram_sets(hashes[first[:, None] + np.arange(WINDOW)].ravel(), np.arange(len(first) + 1) * WINDOW, WIDTH)
        none = np.zeros(len(first), np.int64)
        yield row + a, first - offsets[row], none, none, none + WINDOW, grams, at


_BESIDE = "doc_id long, row_key long, at long, component long, own boolean, removed boolean, before binary, after binary"


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words before (outward) and after each listed paragraph, as 32 bits of their hashes; 0 beyond the text."""
    for b in batches:
        listed = b.column(3).to_pylist()
        for a, _, _, hashes, offsets in _slices(b.column(2)):
            short = (hashes >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
            for k in range(len(offsets) - 1):
                words = np.concatenate((np.zeros(BESIDE, np.uint32), short[offsets[k] : offsets[k + 1]], np.zeros(BESIDE, np.uint32)))
                some = listed[a + k]
                at = np.array([x["at"] for x in some], np.int64)
                before = words[at[:, None] + np.arange(BESIDE)[::-1]]
                after = words[at[:, None] + BESIDE + WINDOW + np.arange(BESIDE)]
                take = pa.array(np.full(len(some), a + k))
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0).take(take),
                        b.column(1).take(take),
                        pa.array(at),
                        pa.array([x["component"] for x in some], pa.int64()),
                        pa.array([x["own"] for x in some], pa.bool_()),
                        pa.array([x["removed"] for x in some], pa.bool_()),
                        pa.array([x.tobytes() for x in before], pa.binary()),
                        pa.array([x.tobytes() for x in after], pa.binary()),
                    ],
                    [x.split()[0] for x in _BESIDE.split(", ")],
                )
    textbytes.release()


def _reach(one: pa.Array, other: pa.Array) -> np.ndarray:
    """How many words outward two contexts agree; a single other word counts if as many agree after it as a shingle has."""
    x, y = (np.array([np.frombuffer(v, np.uint32) for v in c.to_pylist()], np.uint32).reshape(-1, BESIDE) for c in (one, other))
    same = (x == y) & (x > 0)
    padded = np.concatenate((np.ones((len(x), 1), bool), same, np.zeros((len(x), WIDTH + 1), bool)), axis=1)
    follow = np.all([padded[:, 2 + k : 2 + k + BESIDE] for k in range(WIDTH)], axis=0)
    ok = same | (padded[:, :BESIDE] & follow)
    return np.where(ok.all(axis=1), BESIDE, ok.argmin(axis=1))


def _extents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        before, after = _reach(b.column(4), b.column(6)), _reach(b.column(5), b.column(7))
        yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(before.astype(np.int64)), pa.array(after.astype(np.int64))], ["doc_id", "row_key", "at", "component", "low", "high"])


def _starts(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte of each word of a slice of rows, and the byte after its last."""
    word = textbytes.NOT_SPACE[data[rows[0] : rows[-1]]]
    begins = np.unique(rows[:-1] - rows[0])
    begins = begins[begins < len(word)]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    first[begins] = word[begins]
    last[:-1] &= ~word[1:]
    last[begins[begins > 0] - 1] = word[begins[begins > 0] - 1]
    return np.flatnonzero(first) + rows[0], np.flatnonzero(last) + 1 + rows[0]


def _bridged(state: np.ndarray, row: np.ndarray) -> np.ndarray:
    """``state`` with gaps of up to ``GAP`` words filled; they go only if both sides go."""
    on = np.flatnonzero(state > 0)
    left, right = on[:-1], on[1:]
    near = (right - left > 1) & (right - left <= GAP + 1) & (row[left] == row[right])
    out = state.copy()
    for a, b in zip(left[near], right[near], strict=True):
        out[a + 1 : b] = 2 if state[a] == state[b] == 2 else 1
    return out


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words inside of matches, as the longest spans that stay or go."""
    for b in batches:
        ends = b.column(3).to_pylist()
        for a, data, rows, hashes, offsets in _slices(b.column(2)):
            depth = np.zeros((2, len(hashes) + 1), np.int64)
            for k in range(len(offsets) - 1):
                for x in ends[a + k]:
                    first = offsets[k] + x["at"]
                    depth[int(x["kept"]), first] += 1
                    depth[int(x["kept"]), first + x["n"]] -= 1
            gone, kept = (np.cumsum(x)[:-1] > 0 for x in depth)
            row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
            state = _bridged(np.where(gone, 2, np.where(kept, 1, 0)), row)  # what goes has a copy in an earlier document
            new = np.ones(len(state), bool)
            new[1:] = ((state[1:] > 0) != (state[:-1] > 0)) | (row[1:] != row[:-1])
            first = np.flatnonzero(new)
            count = np.diff(np.append(first, len(state)))
            long = (count >= SPAN) | (count == np.diff(offsets)[row[first]])
            state = np.where(np.repeat(long, count), state, 0)
            new[1:] |= state[1:] != state[:-1]
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(state)) - 1
            on = state[first] > 0
            first, last = first[on], last[on]
            begin, end = _starts(data, rows)
            points = np.concatenate(([0], np.cumsum((data[rows[0] : rows[-1]] & 0xC0) != 0x80)))
            start = points[begin[first] - rows[0]]
            row = row[first]
            take = pa.array(row + a)
            numbers = (first - offsets[row], last - first + 1, start - points[rows[row] - rows[0]], points[end[last] - rows[0]] - start)
            columns = [b.column(0).take(take), b.column(1).take(take), *(pa.array(x.astype(np.int64)) for x in numbers), pa.array(state[first] == 2)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row_key", "word", "n_words", "start", "length", "removed"])
    textbytes.release()


def _beside(docs: DataFrame, found: DataFrame, value: Column) -> DataFrame:
    """``doc_id, row_key, text, found`` of the documents with something found, with its distinct values.

    The lists are written first: Spark then knows their bytes, and moves no text where they are few.
    """
    lists = found.groupBy("doc_id", "row_key").agg(F.collect_set(value).alias("found")).select(F.col("doc_id").alias("_id"), F.col("row_key").alias("_key"), "found")
    joined = docs.join(stored(lists, "lists"), (F.col("row_key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    return joined.select("doc_id", "row_key", "text", "found")


def spans(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, row_key, word, n_words, start, length, removed`` of every repeated span, wherever its lines end.

    A span joins the matches that touch each other or have at most ``GAP`` words between
    them, and has ``SPAN`` words or is a whole text of ``MIN_WORDS`` or more. A match is a
    paragraph of ``WINDOW`` words that is similar to one of another document, with what
    agrees on either side of it. Words are ``removed`` if a document with a smaller id holds
    the match; in the first document all stays. ``word`` counts the words of the text
    from 0; ``start`` and ``length`` are in characters. Equal rows have their spans once;
    null, empty and short texts have none; rows of one id are one document, and a row
    without an id comes after all ids. Other columns may have any name.
    """
    docs = keyed(df, id_column, text)
    found = stored(repeated(docs, windows, MIN_WORDS, most=WINDOW - WIDTH + 1).select("doc_id", "row_key", F.col("paragraph").alias("at"), "component", "own", "removed"), "passages")
    beside = stored(_beside(docs, found, F.struct("at", "component", "own", "removed")).mapInArrow(_contexts, _BESIDE), "contexts")
    first = beside.where("not removed").dropDuplicates(["component"])
    stays = first.select("component", F.col("before").alias("_before"), F.col("after").alias("_after"))
    both = beside.where("not own").join(stays, "component").select("doc_id", "row_key", "at", "component", "before", "after", "_before", "_after")
    gone = stored(both.mapInArrow(_extents, "doc_id long, row_key long, at long, component long, low long, high long"), "extents")
    most = gone.groupBy("component").agg(F.max("low").alias("low"), F.max("high").alias("high"))
    kept = first.select("doc_id", "row_key", "at", "component").join(most, "component")
    again = beside.where("own and removed").select("doc_id", "row_key", "at", "component").withColumns({"low": F.lit(0), "high": F.lit(0)})
    matches = gone.withColumn("kept", F.lit(False)).unionByName(kept.unionByName(again).withColumn("kept", F.lit(True)))
    value = F.struct((F.col("at") - F.col("low")).alias("at"), (F.col("low") + F.col("high") + WINDOW).alias("n"), "kept")
    out = "doc_id long, row_key long, word long, n_words long, start long, length long, removed boolean"
    return _beside(docs, matches, value).mapInArrow(_merged, out).distinct()


def remove_spans(df: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``df`` with the removed spans taken out of ``text``; a text without any stays as it is, null too."""
    own, doc, key, cut = (fresh(df, x) for x in ("_own", "_id", "_key", "_cut"))
    gone = spans(df, id_column, text).where("removed").groupBy("doc_id", "row_key").agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias(cut))
    gone = gone.select(F.col("doc_id").alias(doc), F.col("row_key").alias(key), cut)
    joined = df.withColumn(own, row_key(id_column, text)).join(gone, (F.col(own) == F.col(key)) & F.col(id_column).cast("long").eqNullSafe(F.col(doc)), "left")
    begins = F.concat(F.array(F.lit(0).cast("long")), F.transform(F.col(cut), lambda x: x["start"] + x["length"]))
    ends = F.concat(F.transform(F.col(cut), lambda x: x["start"]), F.array(F.char_length(text).cast("long")))
    kept = F.zip_with(begins, ends, lambda a, b: F.substring(F.col(text), (a + 1).cast("int"), (b - a).cast("int")))
    return joined.withColumn(text, F.when(F.col(cut).isNull(), F.col(text)).otherwise(F.array_join(kept, ""))).select(*df.columns)
