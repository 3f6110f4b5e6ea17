"""Quality classifier: weak labels by expectation-maximisation, and a hashed linear scorer.

Heuristic labellers vote good, bad or nothing on every document. How often each pattern
of votes occurs is counted over all documents; there are at most 3^labellers patterns, so
the counts are all that the driver needs. Expectation-maximisation estimates the share of
good documents and of each kind of defect, and each labeller's accuracy on them, and with
these the posterior of every pattern. The posteriors label a bounded sample, on which a linear
scorer over hashed features (byte trigrams and classes of the text's statistics) is
trained; it scores the whole of every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlens.llm import textbytes
from meterlens.llm.store import row_key

#: The scorer learns from about so many documents of either posterior label.
SAMPLE = 1500
BUCKETS = 2048
#: Added to a text's bytes in its shares of trigrams, so that a few words weigh little.
DAMP = 200
GOOD, BAD = 1, 2
_SLICE = 2 << 20

#: Words of insult and contempt (a plain list, matched whole and without case).
INSULTS = """arsehole asshole bastard bitch bullshit clown creep cretin degenerate dimwit disgusting dumb dumbass dumbest fool freak
garbage hag idiot idiotic idiots imbecile jerk lame loser losers lowlife maggot moron moronic morons nitwit numbskull parasite pathetic
pig pigs prick psycho retard scum scumbag shithead sicko simpleton slob sleazy slut stupid subhuman swine thug trash twat twit ugly
vermin weasel whore worthless wretch""".split()


def _class(*spans: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for a, b in spans:
        table[a : b + 1] = True
    return table


_UPPER = _class((65, 90))
_LETTER = _class((65, 90), (97, 122), (128, 255))
_DIGIT = _class((48, 57))
_PLAIN = _LETTER | _DIGIT | textbytes.SPACE | _class((33, 34), (39, 41), (44, 46), (58, 59), (63, 63))  # with !"'(),-.:;?
_END = _class((33, 34), (39, 39), (41, 41), (46, 46), (58, 58), (63, 63))
_BAR = _class((9, 9), (124, 124))

STATISTICS = ("symbols", "upper", "digits", "bars", "repeats", "distinct", "word_length", "ends", "insults", "marks")


@dataclass
class Texts:
    """Statistics of a slice of texts, one array for each of ``STATISTICS``, and the number of words."""

    words: np.ndarray
    values: dict[str, np.ndarray]


def _insult_hashes() -> np.ndarray:
    data, rows = textbytes.buffers(pa.array(INSULTS))
    return np.sort(textbytes.words(data, rows, textbytes.ALNUM)[0])


def statistics(data: np.ndarray, rows: np.ndarray, insults: np.ndarray) -> Texts:
    """Shares of kinds of bytes, words and lines in each text."""
    base, n = int(rows[0]), len(rows) - 1
    part, ends = data[base : int(rows[-1])], rows - base
    size = np.diff(ends)

    def count(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return total[ends[1:]] - total[ends[:-1]]

    letters, bytes_ = np.maximum(count(_LETTER[part]), 1), np.maximum(size, 1)
    hashes, offsets = textbytes.words(data, rows, textbytes.NOT_SPACE)
    words = np.diff(offsets)
    some = np.maximum(words, 1)
    row = np.repeat(np.arange(n), words)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    key = np.sort((row.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24)))
    fresh = np.ones(len(key), bool)
    fresh[1:] = key[1:] != key[:-1]
    distinct = np.bincount((key[fresh] >> np.uint64(40)).astype(np.int64), minlength=n)
    clean, at = textbytes.words(data, rows, textbytes.ALNUM)
    where = np.minimum(np.searchsorted(insults, clean), len(insults) - 1)
    insulting = np.bincount(np.repeat(np.arange(n), np.diff(at))[insults[where] == clean], minlength=n)
    # A line's last byte: before a line feed, or the text's last one.
    closing = np.zeros(len(part), bool)
    feeds = np.flatnonzero(part == 10)
    closing[feeds[feeds > 0] - 1] = True
    closing[ends[1:][size > 0] - 1] = True
    closing &= part != 10
    lines = np.maximum(count(closing), 1)
    return Texts(
        words,
        {
            "symbols": count(~_PLAIN[part]) / bytes_,
            "upper": count(_UPPER[part]) / letters,
            "digits": count(_DIGIT[part]) / bytes_,
            "bars": count(_BAR[part]) / some,
            "repeats": np.bincount(row[again], minlength=n) / some,
            "distinct": distinct / some,
            "word_length": count(_LETTER[part]) / some,
            "ends": count(closing & _END[part]) / lines,
            "insults": insulting / some,
            "marks": count(part == 33) / some,
        },
    )


def _vote(good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    return np.where(bad, BAD, np.where(good, GOOD, 0)).astype(np.int64)


def quality_votes(t: Texts) -> np.ndarray:
    """The labellers of quality: a row of votes for each.

    A defect has two labellers or more, which overlap; where it is absent they say nothing.
    """
    v, some, long, never = t.values, t.words >= 5, t.words >= 20, np.zeros(len(t.words), bool)
    votes = [
        _vote(never, v["symbols"] > 0.08),
        _vote(v["symbols"] < 0.02, v["symbols"] > 0.15),
        _vote(never, some & (v["upper"] > 0.35)),
        _vote(v["upper"] < 0.15, some & ((v["upper"] > 0.5) | (v["marks"] > 0.3))),
        _vote(never, v["digits"] > 0.3),
        _vote(never, v["bars"] > 0.1),
        _vote(never, (v["bars"] > 0.05) | (long & (v["ends"] < 0.1))),
        _vote(never, some & (v["repeats"] > 0.2)),
        _vote(long & (v["distinct"] > 0.35), long & (v["distinct"] < 0.15)),
        _vote(v["ends"] > 0.8, (v["word_length"] < 1.5) | (v["word_length"] > 20)),
    ]
    return np.where(t.words > 0, np.stack(votes), 0)


def civility_votes(t: Texts) -> np.ndarray:
    """The labellers of toxicity, which overlap: any insult, several, and their share of the words."""
    n = np.rint(t.values["insults"] * np.maximum(t.words, 1))
    never = np.zeros(len(n), bool)
    votes = [_vote(n == 0, n > 0), _vote(never, n > 1), _vote(n == 0, t.values["insults"] > 0.0002)]
    return np.where(t.words > 0, np.stack(votes), 0)


#: The labellers of each task, and the kind of defect that each of them looks for.
VOTERS = {"quality": (quality_votes, (0, 0, 1, 1, 2, 3, 3, 4, 4, 5)), "civility": (civility_votes, (0, 0, 0))}


def code(votes: np.ndarray) -> np.ndarray:
    """A number for each pattern of votes."""
    return (votes * 3 ** np.arange(len(votes))[:, None]).sum(axis=0)


def patterns(voters: int) -> np.ndarray:
    """The votes of each pattern number."""
    return np.arange(3**voters)[None] // 3 ** np.arange(voters)[:, None] % 3


@dataclass
class Accuracies:
    """Shares of the classes (good, and one for each kind of defect) and the chance of each labeller's votes in each."""

    share: np.ndarray  # class
    votes: np.ndarray  # class, labeller, vote

    def classes(self, votes: np.ndarray) -> np.ndarray:
        voters = np.arange(len(votes))[:, None]
        odds = np.log(self.share)[:, None] + np.log(self.votes)[:, voters, votes].sum(axis=1)
        e = np.exp(odds - odds.max(axis=0))
        return e / e.sum(axis=0)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """The chance that a text with these votes is good."""
        return self.classes(votes)[0]

    def accuracy(self) -> np.ndarray:
        """For each labeller the chance that its vote is right, on good and on bad texts."""
        bad = (self.share[1:, None, None] * self.votes[1:]).sum(axis=0) / self.share[1:].sum()
        return np.stack([self.votes[0][:, GOOD] / self.votes[0][:, 1:].sum(axis=1), bad[:, BAD] / bad[:, 1:].sum(axis=1)])


def estimate(votes: np.ndarray, counts: np.ndarray, kinds: tuple[int, ...], rounds: int = 200) -> Accuracies:
    """Expectation-maximisation over patterns and how often each occurs.

    Labellers overlap: those of one kind of defect vote together, and texts with one
    defect seldom have another. So bad texts are a class for each kind. It begins with
    labellers that seldom call a good text bad, which also stays a bound.
    """
    kinds = np.array(kinds)
    n = 1 + kinds.max() + 1
    first = np.tile(np.array([0.44, 0.55, 0.01]), (n, len(kinds), 1))
    for k in range(1, n):
        first[k, kinds == k - 1] = (0.15, 0.05, 0.8)
    found = Accuracies(np.array([0.8] + [0.2 / (n - 1)] * (n - 1)), first)
    hit = np.stack([votes == v for v in range(3)], axis=-1).astype(float)  # labeller, pattern, vote
    for _ in range(rounds):
        p = found.classes(votes) * counts
        rates = np.einsum("cp,jpv->cjv", p, hit) + 20 * first
        rates /= rates.sum(axis=2, keepdims=True)
        over = np.maximum(rates[0, :, BAD] - 0.02, 0)
        rates[0, :, BAD] -= over
        rates[0, :, 0] += over
        share = (p.sum(axis=1) + 1) / (counts.sum() + n)
        done = np.allclose(share, found.share, atol=1e-9) and np.allclose(rates, found.votes, atol=1e-7)
        found = Accuracies(share, np.clip(rates, 1e-4, 1))
        if done:
            break
    return found


def _buckets(data: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The bucket of the trigram at each byte of the texts."""
    part = data[int(rows[0]) : int(rows[-1])].astype(np.uint32)
    after = np.concatenate((part[1:], np.zeros(1, np.uint32))), np.concatenate((part[2:], np.zeros(min(2, len(part)), np.uint32)))
    return (((part * 0x9E3779B1 + after[0] * 0x85EBCA6B + after[1] * 0xC2B2AE35) & 0xFFFFFFFF) >> 16).astype(np.int64) % BUCKETS


def _statistic_buckets(t: Texts) -> list[np.ndarray]:
    """A bucket for the class of each statistic but insults, on a scale of doublings."""
    out = []
    for i, name in enumerate(STATISTICS):
        if name != "insults":
            level = np.clip(np.floor(np.log2(np.maximum(t.values[name], 1e-4)) * 2), -30, 12).astype(np.int64)
            out.append((i * 7919 + level * 104729) % BUCKETS)
    return out


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float

    def score(self, data: np.ndarray, rows: np.ndarray, t: Texts) -> np.ndarray:
        ends = rows - rows[0]
        total = np.concatenate(([0.0], np.cumsum(self.weights[_buckets(data, rows)])))
        value = self.bias + (total[ends[1:]] - total[ends[:-1]]) / (np.diff(ends) + DAMP)
        for bucket in _statistic_buckets(t):
            value += self.weights[BUCKETS + bucket]
        return 1 / (1 + np.exp(-np.clip(value, -50, 50)))


def _features(data: np.ndarray, rows: np.ndarray, t: Texts, chosen: np.ndarray) -> list[bytes]:
    """The feature vectors of some texts of a slice: shares of trigram buckets, and 1 for each statistic's bucket."""
    buckets, ends, stats = _buckets(data, rows), rows - rows[0], _statistic_buckets(t)
    out = []
    for i in chosen:
        x = np.zeros(2 * BUCKETS, np.float32)
        x[:BUCKETS] = np.bincount(buckets[ends[i] : ends[i + 1]], minlength=BUCKETS) / (ends[i + 1] - ends[i] + DAMP)
        np.add.at(x, [BUCKETS + int(b[i]) for b in stats], 1)
        out.append(x.tobytes())
    return out


def train(x: np.ndarray, y: np.ndarray, steps: int = 200, rate: float = 0.05, decay: float = 1e-3) -> Scorer:
    """A logistic regression on soft labels ``y``, by Adam over features scaled to their spread."""
    spread = x.std(axis=0) + 1e-4
    z = (x / spread).astype(np.float32)
    w, bias = np.zeros(x.shape[1], np.float32), float(np.log(max(y.mean(), 1e-3) / max(1 - y.mean(), 1e-3)))
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        error = (1 / (1 + np.exp(-np.clip(z @ w + bias, -50, 50))) - y).astype(np.float32) / len(y)
        slope = error @ z + decay * w
        bias -= rate * float(error.sum())
        first += 0.1 * (slope - first)
        second += 0.01 * (slope * slope - second)
        w -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Scorer((w / spread).astype(np.float64), bias)


@dataclass
class Model:
    quality: Accuracies
    civility: Accuracies
    scorer: Scorer | None


def _slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, Texts]]:
    insults = _insult_hashes()
    data, rows = textbytes.buffers(column)
    for start, stop in textbytes.slices(rows, _SLICE):
        own = rows[start : stop + 1]
        yield start, stop, data, own, statistics(data, own, insults)


def _codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each pair of patterns occurs in a batch."""
    for b in batches:
        for _, _, _, _, t in _slices(b.column(0)):
            both, n = np.unique(np.stack((code(quality_votes(t)), code(civility_votes(t)))), axis=1, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1]), pa.array(n)], ["quality", "civility", "n"])


def fit(df: DataFrame, id_column: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Model | None:
    """Accuracies over all rows, and a scorer from about ``sample`` rows of either posterior label; None without rows."""
    counted = df.select(text).mapInArrow(_codes, "quality long, civility long, n long").groupBy("quality", "civility").agg(F.sum("n").alias("n")).collect()
    if not counted:
        return None
    found = {}
    for name, (_, kinds) in VOTERS.items():
        counts = np.zeros(3 ** len(kinds))
        for r in counted:
            counts[r[name]] += r["n"]
        seen = np.flatnonzero(counts)
        found[name] = (estimate(patterns(len(kinds))[:, seen], counts[seen], kinds), counts)
    accuracy, counts = found["quality"]
    posterior = accuracy.posterior(patterns(len(VOTERS["quality"][1])))
    good = posterior >= 0.5
    share = [min(1.0, sample / max(1.0, counts[good == side].sum())) for side in (False, True)]

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            order = b.column(1).to_numpy()
            for start, stop, data, own, t in _slices(b.column(0)):
                c = code(quality_votes(t))
                part = (order[start:stop] & ((1 << 30) - 1)) / (1 << 30)
                chosen = np.flatnonzero(part < np.where(good[c], share[1], share[0]))
                raw = _features(data, own, t, chosen)
                yield pa.RecordBatch.from_arrays([pa.array(order[start:stop][chosen]), pa.array(posterior[c[chosen]]), pa.array(raw, pa.binary())], ["order", "label", "x"])

    rows = (
        df.select(F.col(text), row_key(id_column, text).alias("order"))
        .mapInArrow(pick, "order long, label double, x binary")
        .orderBy("order", "label")
        .limit(3 * sample)
        .collect()
    )
    y = np.array([r["label"] for r in rows])
    scorer = None
    if len(rows) and (y < 0.5).any() and (y >= 0.5).any():
        scorer = train(np.stack([np.frombuffer(r["x"], np.float32) for r in rows]), y)
    return Model(accuracy, found["civility"][0], scorer)


def classify(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``df`` without ``text`` but with ``posterior, score, quality, toxic, keep``.

    ``posterior`` is the labellers' and ``score`` the scorer's probability of a good text;
    ``quality`` is 1 from a score of 0.5. ``toxic`` is the posterior verdict of the
    labellers of civility, and ``keep`` means good and not toxic. A null text, or one
    without words, has the scores 0 and isn't kept. If all labels of the sample agree,
    the posterior is the score. Columns of these names are replaced, others and repeated
    rows stay; nothing is shuffled.
    """
    added = {"posterior": F.lit(0.0), "score": F.lit(0.0), "quality": F.lit(0), "toxic": F.lit(False), "keep": F.lit(False)}
    others = [c for c in df.columns if c != text and c not in added]
    schema = df.select(*others).withColumns(added).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {}
        if model is not None:
            tables = {name: getattr(model, name).posterior(patterns(len(kinds))) for name, (_, kinds) in VOTERS.items()}
        for b in batches:
            posterior, score, civil = (np.zeros(len(b)) for _ in range(3))
            for start, stop, data, own, t in _slices(b.column(0)) if model is not None else ():
                some = t.words > 0
                posterior[start:stop] = np.where(some, tables["quality"][code(quality_votes(t))], 0)
                civil[start:stop] = np.where(some, tables["civility"][code(civility_votes(t))], 1)
                score[start:stop] = np.where(some, model.scorer.score(data, own, t), 0) if model.scorer else posterior[start:stop]
            good, toxic = score >= 0.5, civil < 0.5
            columns = [pa.array(posterior), pa.array(score), pa.array(good.astype(np.int32)), pa.array(toxic), pa.array(good & ~toxic)]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], *columns], schema.names)

    return df.select(F.col(text).alias("_text"), *[F.col(c).alias(f"_{i}") for i, c in enumerate(others)]).mapInArrow(run, schema)
