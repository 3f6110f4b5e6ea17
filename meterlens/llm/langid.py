"""Language ID: a byte convolutional network over batched windows of fixed length.

Bytes are embedded, filters of several widths slide over the embedded bytes, each
filter keeps its maximum over the window, and a softmax layer reads the maxima. The
network is trained in numpy on a bounded sample of labelled rows and applied to the
whole of every text: all its windows vote, weighted by their length.

The first two layers are linear in each byte, so a filter's value is a sum of table
look-ups by byte, or by pairs of bytes, without a product of matrices.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlens.llm import textbytes

WINDOW = 256  # bytes
WIDTHS = (2, 3, 4)
FILTERS = 16  # of each width
EMBEDDING = 8
#: At most so many labelled rows of each language are learned from.
SAMPLE = 1000
UNKNOWN = "und"


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray  # byte, dimension
    filters: list[np.ndarray]  # by width: place, dimension, filter
    bias: list[np.ndarray]
    out: np.ndarray  # filter, language
    out_bias: np.ndarray

    def tables(self) -> list[list[np.ndarray]]:
        """By width: one table of byte pairs for each two places, and one of bytes for an odd last one."""
        by_width = []
        for weights, bias in zip(self.filters, self.bias, strict=True):
            single = [self.embedding @ w for w in weights]
            single[0] = single[0] + bias
            pairs = [(single[k][:, None] + single[k + 1][None]).reshape(1 << 16, -1) for k in range(0, len(single) - 1, 2)]
            by_width.append([np.ascontiguousarray(t, np.float32) for t in pairs + single[len(single) & ~1 :]])
        return by_width


def _windows(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of each row (the last one filled up with 0), each one's row and its own bytes."""
    size = np.diff(rows)
    per_row = -(-size // WINDOW)
    row = np.repeat(np.arange(len(size)), per_row)
    place = np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    length = np.minimum(size[row] - place * WINDOW, WINDOW)
    part = np.concatenate((data[rows[0] : rows[-1]], np.zeros(WINDOW, np.uint8)))
    x = np.lib.stride_tricks.sliding_window_view(part, WINDOW)[rows[row] - rows[0] + place * WINDOW]
    return np.where(np.arange(WINDOW) < length[:, None], x, np.uint8(0)), row, length


def _maxima(tables: list[list[np.ndarray]], x: np.ndarray) -> np.ndarray:
    wide = x.astype(np.intp)
    pairs = wide[:, :-1] * 256 + wide[:, 1:]
    found = []
    for width, parts in zip(WIDTHS, tables, strict=True):
        n = WINDOW - width + 1
        total = np.take(parts[0], pairs[:, :n], axis=0)
        for k, part in enumerate(parts[1:], 1):
            total += np.take(part, (pairs if len(part) > 256 else wide)[:, 2 * k : 2 * k + n], axis=0)
        found.append(total.max(axis=1))
    return np.maximum(np.concatenate(found, axis=1), 0)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(x: np.ndarray, y: np.ndarray, languages: list[str], steps: int = 640, batch: int = 64, rate: float = 0.01) -> Network:
    """A network for windows ``x`` with language numbers ``y``, by Adam with a fixed seed and number of steps."""
    rng = np.random.default_rng(7)
    net = Network(
        languages,
        rng.normal(0, 0.5, (256, EMBEDDING)),
        [rng.normal(0, (w * EMBEDDING) ** -0.5, (w, EMBEDDING, FILTERS)) for w in WIDTHS],
        [np.zeros(FILTERS) for _ in WIDTHS],
        rng.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages))),
        np.zeros(len(languages)),
    )
    weights = [net.embedding, *net.filters, *net.bias, net.out, net.out_bias]
    first, second = ([np.zeros_like(w) for w in weights] for _ in range(2))
    step = 0
    while step < steps:
        order = rng.permutation(len(x))
        for at in range(0, len(order), batch):
            xs, ys = x[order[at : at + batch]].astype(np.intp), y[order[at : at + batch]]
            n = len(xs)
            peaks, places = [], []
            for w, f, b in zip(WIDTHS, net.filters, net.bias, strict=True):
                value = b + sum((net.embedding @ f[k])[xs[:, k : WINDOW - w + 1 + k]] for k in range(w))
                places.append(value.argmax(axis=1))
                peaks.append(np.take_along_axis(value, places[-1][:, None], axis=1)[:, 0])
            peak = np.concatenate(peaks, axis=1)
            hidden = np.maximum(peak, 0)
            error = _softmax(hidden @ net.out + net.out_bias)
            error[np.arange(n), ys] -= 1
            error /= n
            back = (error @ net.out.T) * (peak > 0)
            slope = [np.zeros_like(w) for w in weights]
            slope[-2], slope[-1] = hidden.T @ error, error.sum(axis=0)
            for i, (w, f) in enumerate(zip(WIDTHS, net.filters, strict=True)):
                g = back[:, i * FILTERS : (i + 1) * FILTERS]
                slope[1 + len(WIDTHS) + i] = g.sum(axis=0)
                for k in range(w):  # only the place of the maximum has a slope
                    seen = xs[np.arange(n)[:, None], places[i] + k]
                    slope[1 + i][k] = np.einsum("nf,nfd->df", g, net.embedding[seen])
                    np.add.at(slope[0], seen, g[..., None] * f[k].T[None])
            step += 1
            for w, m, v, s in zip(weights, first, second, slope, strict=True):
                m += 0.1 * (s - m)
                v += 0.001 * (s * s - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


def held_out(id_column: str = "doc_id") -> Column:
    """Whether a row is kept from training: crc32 of its id as text, modulo 3, is 1; a null id isn't."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def has_letter(text: str = "text") -> Column:
    return F.coalesce(F.col(text).rlike("\\p{L}"), F.lit(False))


def fit(df: DataFrame, sample: int = SAMPLE, id_column: str = "doc_id", text: str = "text", lang: str = "lang") -> Network | None:
    """Learn from at most ``sample`` rows of each language that have an id, a letter, a label and are not held out.

    The rows are those with the smallest hash of their id, so a rerun takes the same.
    Two windows of each go into the training, a third of them cut short, so that short
    texts are known too. None if there is no such row.
    """
    rows = df.where(F.col(lang).isNotNull() & F.col(id_column).isNotNull() & ~held_out(id_column))
    sizes = {r[0]: r[1] for r in rows.groupBy(F.col(lang).alias("lang")).count().collect()}
    if not sizes:
        return None
    # A threshold on the hash leaves about twice the sample before anything is ranked.
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, 2 * sample / n))])
    order = F.xxhash64(F.col(id_column).cast("string"), F.lit(11))
    picked = rows.select(F.col(lang).alias("lang"), order.alias("order"), F.col(text).alias("text")).where(
        (F.pmod("order", F.lit(1 << 20)) < share[F.col("lang")] * (1 << 20)) & has_letter("text")
    )

    def two(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, ends = textbytes.buffers(b.column("text"))
            x, row, _ = _windows(data, ends)
            first = np.searchsorted(row, np.arange(len(b)))
            count = np.bincount(row, minlength=len(b))
            seed = np.abs(b.column("order").to_numpy(zero_copy_only=False)) >> 20
            take = np.concatenate([first + seed % np.maximum(count, 1), first + (seed >> 9) % np.maximum(count, 1)])
            rows_of = np.concatenate([np.arange(len(b))] * 2)
            yield pa.RecordBatch.from_arrays(
                [b.column("lang").take(rows_of), b.column("order").take(rows_of), pa.array([x[i].tobytes() for i in take], pa.binary())],
                ["lang", "order", "bytes"],
            )

    ranked = Window.partitionBy("lang").orderBy("order", "bytes")
    got = (
        picked.mapInArrow(two, "lang string, order long, bytes binary")
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= 2 * sample)
        .orderBy("lang", "rank")
        .collect()
    )
    if not got:
        return None
    languages = sorted({r["lang"] for r in got})
    x = np.stack([np.frombuffer(r["bytes"], np.uint8) for r in got]).copy()
    y = np.array([languages.index(r["lang"]) for r in got])
    rng = np.random.default_rng(5)
    for i in rng.permutation(len(x))[: len(x) // 3]:
        x[i, rng.integers(8, WINDOW) :] = 0
    return train(x, y, languages)


def identify(
    df: DataFrame, net: Network | None, text: str = "text", keep_text: bool = False, lang_out: str = "lang_pred", score_out: str = "score"
) -> DataFrame:
    """``df`` with a language and a score (0 to 1), without ``text`` unless ``keep_text``.

    A null text or one without a letter is ``und`` with score 0; so is all without a
    network. Columns of the two names are replaced; all other columns and repeated rows
    stay. Nothing is shuffled.
    """
    others = [c for c in df.columns if c not in (lang_out, score_out) and (keep_text or c != text)]
    schema = df.select(*others).withColumns({lang_out: F.lit(""), score_out: F.lit(0.0)}).schema
    letters = has_letter(text) if net is not None else F.lit(False)
    n = len(others)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = net.tables() if net is not None else []
        for b in batches:
            known = np.asarray(b.column(n + 1).to_numpy(zero_copy_only=False), bool)
            label, score = np.full(len(b), UNKNOWN, object), np.zeros(len(b))
            data, ends = textbytes.buffers(b.column(n))
            for start, stop in textbytes.slices(ends, 1 << 20) if net is not None else ():
                x, row, length = _windows(data, ends[start : stop + 1])
                votes = np.zeros((stop - start, len(net.languages)))
                for at in range(0, len(x), 64):
                    p = _softmax(_maxima(tables, x[at : at + 64]) @ net.out + net.out_bias)
                    np.add.at(votes, row[at : at + 64], p * length[at : at + 64, None])
                votes /= np.maximum(np.diff(ends[start : stop + 1]), 1)[:, None]
                best = votes.argmax(axis=1)
                own = np.flatnonzero(known[start:stop])
                label[start + own] = np.array(net.languages, object)[best[own]]
                score[start + own] = np.clip(votes[own, best[own]], 0, 1)
            columns = [b.column(i) for i in range(n)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(label, pa.string()), pa.array(score)], schema.names)
        textbytes.release()

    inputs = [F.col(c).alias(f"_{i}") for i, c in enumerate(others)]
    return df.select(*inputs, F.col(text).alias("_text"), letters.alias("_known")).mapInArrow(predict, schema)
