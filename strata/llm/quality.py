"""Quality scores from a regularised quadratic discriminant over document statistics."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, holding, _Index, mapped, slices

#: Octet classes of the character statistics.
LOWER, UPPER, DIGIT, SPACE, LINE, STOP, MARK, WIDE = range(8)
CLASS = np.full(256, MARK, np.int64)
CLASS[ord("a"):ord("z") + 1] = LOWER
CLASS[ord("A"):ord("Z") + 1] = UPPER
CLASS[ord("0"):ord("9") + 1] = DIGIT
CLASS[[9, 11, 12, 13, 32]] = SPACE
CLASS[10] = LINE
CLASS[[ord(c) for c in ".,;:'\"-?()"]] = STOP
CLASS[128:] = WIDE
FEATURES = ("chars", "words", "mean_word", "spread_word", "upper", "digit", "space", "lines", "stops", "marks", "wide",
            "distinct_words", "repeats", "top_word", "marked_words", "capital_words", "distinct_lines")
REMEMBERED = 150_000


class Statistics:
    """Statistics of documents; words are numbered once while remembered."""

    def __init__(self):
        self.index = _Index()
        self.traits = np.empty((0, 3))

    def __call__(self, texts: list[str | None]) -> np.ndarray:
        """One row of FEATURES for each text; a null text counts as empty."""
        if len(self.index) > REMEMBERED:
            self.__init__()
        texts = [t or "" for t in texts]
        octets = [t.encode("utf-8", "replace") for t in texts]
        sizes = np.fromiter(map(len, octets), np.int64, len(octets))
        doc = np.repeat(np.arange(len(texts)), sizes)
        kinds = np.bincount(doc * 8 + CLASS[np.frombuffer(b"".join(octets), np.uint8)],
                            minlength=8 * len(texts)).reshape(-1, 8) / np.maximum(sizes, 1)[:, None]
        words = [t.split() for t in texts]
        counts = np.fromiter(map(len, words), np.int64, len(words))
        at = np.fromiter((self.index[w] for own in words for w in own), np.int64, int(counts.sum()))
        if self.index.fresh:
            fresh = self.index.fresh
            self.traits = np.concatenate((self.traits, np.array(
                [(len(w), sum(not c.isalpha() for c in w) > 1, w.isupper() and len(w) > 1) for w in fresh], float)))
            self.index.fresh = []
        owner = np.repeat(np.arange(len(texts)), counts)
        n = np.maximum(counts, 1)
        traits = self.traits[at]
        total = lambda v: np.bincount(owner, v, len(texts))
        mean = total(traits[:, 0]) / n
        spread = np.sqrt(np.maximum(total(traits[:, 0] ** 2) / n - mean ** 2, 0))
        again = np.zeros(len(at))
        again[1:] = (at[1:] == at[:-1]) & (owner[1:] == owner[:-1])
        found, times = np.unique(owner * (len(self.index) + 1) + at, return_counts=True)
        whose = found // (len(self.index) + 1)
        distinct = np.bincount(whose, minlength=len(texts))
        top = np.zeros(len(texts))
        np.maximum.at(top, whose, times)
        lines = [t.split("\n") for t in texts]
        line_share = np.array([len(set(x)) / len(x) for x in lines])
        root = np.sqrt
        return np.column_stack((
            np.log1p(sizes), np.log1p(counts), np.log1p(mean), np.log1p(spread), root(kinds[:, UPPER]), root(kinds[:, DIGIT]),
            root(kinds[:, SPACE]), np.log1p(sizes / np.array([len(x) for x in lines])), root(kinds[:, STOP]),
            root(kinds[:, MARK]), root(kinds[:, WIDE]), distinct / n, root(total(again) / n), root(top / n),
            root(total(traits[:, 1]) / n), root(total(traits[:, 2]) / n), line_share))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, x)``: transformed statistics of every whole text."""
    @holding("quality")
    def run(batches: Iterator[pa.RecordBatch]):
        tool = held("quality", Statistics)
        for batch in slices(batches):
            x = tool(batch.column(1).to_pylist())
            values = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), values], ["doc_id", "x"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return mapped(picked, run, "doc_id long, x array<double>")


class Discriminant:
    """Two Gaussian classes with shrunken covariances, kept as inverse Cholesky factors.

    A class covariance is drawn towards the pooled one by ``pool`` and then
    towards the scaled identity by ``ridge``. The score is the posterior of
    class 1; log-odds are tempered by ``temper``, as statistics of one text
    are far from independent.
    """

    def __init__(self, moments: dict[int, tuple[float, np.ndarray, np.ndarray]], pool: float = 0.2,
                 ridge: float = 0.02, temper: float = 0.2):
        self.temper = temper
        total = sum(m[0] for m in moments.values())
        self.share = (moments.get(1, (0,))[0] + 1) / (total + 2)
        self.classes = []
        if len(moments) < 2:  # one class or none: the share of class 1 is all there is to say
            return
        cov = {c: s2 / n - np.outer(s / n, s / n) for c, (n, s, s2) in moments.items()}
        pooled = sum(moments[c][0] / total * cov[c] for c in cov)
        for c in (0, 1):
            n, s, _ = moments[c]
            mixed = (1 - pool) * cov[c] + pool * pooled
            mixed = (1 - ridge) * mixed + ridge * max(np.trace(mixed) / len(mixed), 1e-6) * np.eye(len(mixed))
            factor = np.linalg.cholesky(mixed)
            prior = np.log(n / total)
            self.classes.append((s / n, np.linalg.inv(factor).T, prior - np.log(np.diag(factor)).sum()))

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.classes:
            return np.full(len(x), self.share)
        logs = [const - 0.5 * (((x - mean) @ half) ** 2).sum(axis=1) for mean, half, const in self.classes]
        return 1 / (1 + np.exp(np.clip(-self.temper * (logs[1] - logs[0]), -700, 700)))


def fit(rows: DataFrame, **settings) -> Discriminant:
    """From ``(x, label)``: class moments over all rows; the driver gets one row a class and moment.

    Labels other than 0 and 1, and null ones, teach nothing.
    """
    d = len(FEATURES)

    def run(batches: Iterator[pa.RecordBatch]):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            x = batch.column(0).flatten().to_numpy().reshape(-1, d)
            x = np.column_stack((np.ones(len(x)), x))
            label = batch.column(1).to_numpy()
            for c in (0, 1):
                own = x[label == c]
                if len(own):
                    sums[c] = sums.get(c, 0) + own.T @ own
        for c, m in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([c] * m.size, pa.int32()), pa.array(np.arange(m.size), pa.int32()), pa.array(m.ravel())],
                ["label", "place", "value"])

    labelled = rows.select("x", F.col("label").cast("int").alias("label")).where("label IN (0, 1)")
    sums = (mapped(labelled, run, "label int, place int, value double").groupBy("label", "place")
            .agg(F.sum("value").alias("value")).toArrow())
    moments = {}
    for c in (0, 1):
        own = sums.filter(pa.compute.equal(sums.column("label"), c))
        if own.num_rows:
            m = np.zeros((d + 1) ** 2)
            m[own.column("place").to_numpy()] = own.column("value").to_numpy()
            m = m.reshape(d + 1, d + 1)
            moments[c] = (m[0, 0], m[0, 1:], m[1:, 1:])
    return Discriminant(moments, **settings)


def scored(rows: DataFrame, model: Discriminant) -> DataFrame:
    """``(doc_id, score)`` from ``(doc_id, x)``, ``score`` in 0..1, higher where class 1 is likelier."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], ["doc_id", "score"])

    return mapped(rows.select("doc_id", "x"), run, "doc_id long, score double")
