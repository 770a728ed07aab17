"""Toxicity from a subsequence string kernel, Nyström landmarks and a linear support vector machine."""

from __future__ import annotations

import re
import uuid
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, holding, mapped, slices, written

#: Length of the compared subsequences, and the weight of each character they span.
LENGTH, DECAY = 4, 0.5
#: Characters of a word that are compared (a word's kernel is the largest of its windows of this length).
WINDOW = 24
LANDMARKS = 96
#: Landmarks expected to be chosen by chance alone.
CHANCE = 0.05
STEMS = range(4, 9)
REMEMBERED = 150_000
#: Texts, and bytes of them, that a worker reads at once: it holds their words as Python strings.
ROWS, SIZE = 128, 256 << 10
#: Words whose kernels are gathered at once.
GATHERED = 8192
LETTERS = re.compile(r"[\W\d_]+")
#: Words of at most three letters, or of signs.
SHORT = re.compile(r"(?:\W*\w){0,3}\W*")


def plain(word: str) -> str:
    """A word's letters behind a start mark: digits and signs between letters don't hide it."""
    return "^" + (word if word.isalpha() else LETTERS.sub("", word))


def traits(words: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Of each word its letters (as :func:`plain` has them), whether it ends a sentence, and whether it is SHORT."""
    letters = list(words)
    ends, short = np.zeros(len(words), bool), np.fromiter(map(len, words), np.int64, len(words)) <= 3
    signed = np.flatnonzero(~np.fromiter(map(str.isalpha, words), bool, len(words)))
    for i in signed.tolist():
        word = words[i]
        last, most = word[-1], word[:-1]
        letters[i] = own = most if last in ".,;:!?" and most.isalpha() else LETTERS.sub("", word)
        ends[i] = last in ".!?"
        short[i] = short[i] or len(own) <= 3 and SHORT.fullmatch(word) is not None
    return letters, ends, short


def broken(short: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(places, first, last, run)``: the places of neighbouring short words of one text, and what is joined of them.

    From each word of a run but its last one, up to WINDOW words of the run are
    joined: those from ``first`` to before ``last`` in ``places``.
    """
    pair = np.flatnonzero(short[:-1] & short[1:] & (text[:-1] == text[1:]))
    new = np.diff(pair, prepend=-2) > 1
    run = np.cumsum(new) - 1
    tail = pair[np.append(new[1:], True)[:len(pair)]]
    places = np.union1d(pair, tail + 1)
    first = np.searchsorted(places, pair)
    return places, first, np.minimum(first + WINDOW, np.searchsorted(places, tail + 1)[run] + 1), run


def joined(own: list[str], first: np.ndarray, last: np.ndarray) -> list[str]:
    """Short words' letters joined, up to WINDOW characters; nothing from a word without letters on."""
    return ["".join(own[i:j])[:WINDOW - 1] if own[i] else "" for i, j in zip(first.tolist(), last.tolist())]


def sentences(text: str) -> tuple[list[str], np.ndarray]:
    """A text's words and the number of each one's sentence.

    Neighbouring short words are joined too, from each of them on (up to
    WINDOW characters), since a word may be spelled out or broken up; those of
    one run are a sentence of their own.
    """
    words = text.lower().split()
    letters, ends, short = traits(words)
    number = np.cumsum(ends) - ends
    places, first, last, run = broken(short, np.zeros(len(words)))
    more = joined([letters[i] for i in places.tolist()], first, last)
    if any(more):
        some = np.array(list(map(bool, more)))
        number = np.concatenate((number, number[-1] + 1 + run[some]))
        words = words + list(filter(None, more))
    return words, number


def coded(words: list[str], width: int) -> np.ndarray:
    """Words as rows of code points, zero-padded."""
    return np.array(words, f"<U{width}").view(np.uint32).reshape(len(words), width)


def kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Gap-weighted subsequence kernel of aligned pairs of rows.

    Sums, over common subsequences of LENGTH characters, DECAY to the number
    of characters each spans in both words; the recursion runs over positions
    while every step handles all pairs.
    """
    n, p, q = len(a), a.shape[1], b.shape[1]
    a, b = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)  # a step handles neighbouring numbers
    same = ((a[:, None] == b[None]) & (a[:, None] > 0)).astype(np.float32)
    upto = np.ones((p + 1, q + 1, n), np.float32)
    for _ in range(LENGTH - 1):
        fresh = np.zeros((p + 1, q + 1, n), np.float32)
        ends = fresh[1:, 1:]
        np.multiply(same, upto[:p, :q], out=ends)
        ends *= np.float32(DECAY ** 2)
        for j in range(1, q):  # a character of b more, for all places of a
            ends[:, j] += np.float32(DECAY) * ends[:, j - 1]
        for i in range(1, p):  # a character of a more, for all places of b
            ends[i] += np.float32(DECAY) * ends[i - 1]
        upto = fresh
    return (same * upto[:p, :q]).sum(axis=(0, 1), dtype=np.float64) * DECAY ** 2


class Landmarks:
    """Landmark words and the kernel of other words with them.

    A word is compared with a landmark when they share a subsequence of LENGTH
    characters; their kernel is zero otherwise.
    """

    def __init__(self, words: list[str]):
        self.words = words
        self.width = max((len(w) for w in words), default=1)
        self.codes = coded(words, self.width) if words else np.zeros((0, 1), np.uint32)
        self.size = np.sqrt(np.maximum(self.pairs(self.codes, self.codes), 1e-9)) if words else np.ones(0)
        grid = [np.repeat(np.arange(len(words)), len(words)), np.tile(np.arange(len(words)), len(words))]
        self.gram = (self.pairs(self.codes[grid[0]], self.codes[grid[1]]).reshape(len(words), len(words))
                     / self.size[:, None] / self.size[None, :]) if words else np.zeros((0, 0))
        alphabet = np.unique(self.codes[self.codes > 0])
        #: Numbers of the landmarks' letters by code point; other letters, and what is beyond the table, are 0.
        self.letter = np.zeros(int(alphabet.max(initial=0)) + 2, np.uint16)
        self.letter[alphabet] = np.arange(1, len(alphabet) + 1)
        #: Landmarks that share 64 bits: each letter's places as bits, and their lengths.
        self.packed: list[tuple[np.ndarray, list[int]]] = []
        used = 64
        for landmark in self.codes:
            own = landmark[landmark > 0]
            if used + len(own) + 1 > 64:
                self.packed.append((np.zeros(len(alphabet) + 1, np.uint64), []))
                used = 0
            places, lengths = self.packed[-1]
            np.bitwise_or.at(places, self.letter[own], np.uint64(1) << np.arange(used, used + len(own), dtype=np.uint64))
            lengths.append(len(own))
            used += len(own) + 1

    def shared(self, letters: np.ndarray) -> list[np.ndarray]:
        """Of each landmark, the words whose longest common subsequence with it has LENGTH characters or more.

        ``letters`` has a column for each word and a row for each of its
        places, letters of no landmark being 0. A bit of ``row`` is a place of
        a landmark that raises the length; a place of the words is one step
        for all of them and for as many landmarks as 64 bits hold, with a bit
        between two that takes what is carried beyond the first.
        """
        some = np.flatnonzero((letters > 0).sum(axis=0) >= LENGTH)
        width = (letters[:, some] > 0)[::-1].argmax(axis=0)  # places behind the last letter
        order = np.argsort(width, kind="stable")  # longer words first: a step is for those that have its place
        reach = len(letters) - width[order]
        some = some[order]
        letters = letters[:, some]
        out = []
        for places, lengths in self.packed:
            starts = np.cumsum([0] + [n + 1 for n in lengths[:-1]]).tolist()
            fields = np.uint64(sum(((1 << n) - 1) << at for n, at in zip(lengths, starts)))
            row = np.full(len(some), fields, np.uint64)
            for i, step in enumerate(letters):
                n = int(np.searchsorted(-reach, -i))  # words that reach beyond place i
                own = row[:n]
                both = own & places[step[:n]]
                row[:n] = ((own + both) | (own - both)) & fields
            for n, at in zip(lengths, starts):
                left = np.bitwise_count((row >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64)
                out.append(np.sort(some[n - left >= LENGTH]))
        return out

    @staticmethod
    def pairs(a: np.ndarray, b: np.ndarray, block: int = 512) -> np.ndarray:
        out, width = np.empty(len(a)), (a > 0).sum(axis=1)
        order = np.argsort(width, kind="stable")
        for i in range(0, len(a), block):  # words of like length together, without their padding
            own = order[i:i + block]
            out[own] = kernel(a[own, :max(1, width[own[-1]])], b[own])
        return out

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """``(rows, values)``: the words (see :func:`plain`) with a kernel above zero and their kernels with all landmarks."""
        pieces = list(words)
        owner = np.arange(len(pieces))
        if not pieces or not self.words:
            return owner[:0], np.zeros((0, len(self.words)))
        longer = [i for i, w in enumerate(pieces) if len(w) > WINDOW]
        if longer:  # overlapping windows of long words
            more = [(i, "^" + pieces[i][at:at + WINDOW - 1]) for i in longer
                    for at in range(1, len(pieces[i]), WINDOW // 2)]
            owner = np.concatenate((owner, [i for i, _ in more]))
            pieces = [w[:WINDOW] for w in pieces] + [w for _, w in more]
        codes = coded(pieces, WINDOW)
        hits = self.shared(self.letter[np.minimum(codes.T, len(self.letter) - 1)])
        left, right = np.concatenate(hits), np.repeat(np.arange(len(hits)), list(map(len, hits)))
        values = self.pairs(codes[left], self.codes[right]) / self.size[right]
        rows, place = np.unique(owner[left], return_inverse=True)
        out = np.zeros((len(rows), len(self.words)))
        np.maximum.at(out, (place, right), values)
        return rows, out


class Numbers(dict):
    """Numbers keys in order of first sight."""

    def __call__(self, keys: list[str]) -> tuple[np.ndarray, list[str]]:
        """The numbers of keys, and the keys that had none before."""
        fresh = [k for k in dict.fromkeys(keys) if k not in self]
        self.update(zip(fresh, range(len(self), len(self) + len(fresh))))
        return np.fromiter(map(self.__getitem__, keys), np.int64, len(keys)), fresh


class Tester:
    """Highest-scoring sentence of texts; distinct words are compared with the landmarks once while remembered."""

    def __init__(self, landmarks: Landmarks):
        self.landmarks = landmarks
        self.clear()

    def clear(self) -> None:
        self.index, self.stems = Numbers(), Numbers()
        self.stem, self.place = np.empty(0, np.int64), np.empty(0, np.int64)
        self.ends, self.short = np.empty(0, bool), np.empty(0, bool)
        self.letters: dict[int, str] = {}  # of short words
        self.values = np.zeros((0, len(self.landmarks.words)))

    def stemmed(self, letters: list[str]) -> np.ndarray:
        """Numbers of words' letters; new ones are compared with the landmarks."""
        at, fresh = self.stems(letters)
        if fresh:
            rows, values = self.landmarks(["^" + s for s in fresh])
            place = np.full(len(fresh), -1)
            place[rows] = len(self.values) + np.arange(len(rows))
            self.place = np.concatenate((self.place, place))
            self.values = np.concatenate((self.values, values))
        return at

    def features(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """``(owner, kernels)`` of the sentences that touch a landmark: the largest kernel of a sentence's words.

        The words and sentences are those of :func:`sentences`, of all texts at once.
        """
        if max(len(self.index), len(self.stems)) > REMEMBERED or len(self.values) > REMEMBERED // 4:
            self.clear()
        split = [(t or "").lower().split() for t in texts]
        owner = np.repeat(np.arange(len(split)), list(map(len, split)))
        at, fresh = self.index(list(chain.from_iterable(split)))
        letters, ends, short = traits(fresh)
        few = np.flatnonzero(short)
        self.letters.update(zip((len(self.short) + few).tolist(), map(letters.__getitem__, few.tolist())))
        self.ends, self.short = np.concatenate((self.ends, ends)), np.concatenate((self.short, short))
        ends = self.ends[at]
        number = np.cumsum(ends) - ends
        places, first, last, run = broken(self.short[at], owner)
        more = joined(list(map(self.letters.__getitem__, at[places].tolist())), first, last)
        some = np.fromiter(map(bool, more), bool, len(more))
        # words that differ in signs only are compared once
        stem = self.stemmed(letters + list(filter(None, more)))
        self.stem = np.concatenate((self.stem, stem[:len(fresh)]))
        place = self.place[np.concatenate((self.stem[at], stem[len(fresh):]))]
        hit = np.flatnonzero(place >= 0)
        owner = np.concatenate((owner, owner[places[first[some]]]))[hit]
        number = np.concatenate((number, len(at) + run[some]))[hit]
        order = np.argsort(owner, kind="stable")  # a text's joined words behind its words
        hit, owner, number = hit[order], owner[order], number[order]
        if not len(hit):
            return owner, np.zeros((0, len(self.landmarks.words)))
        new = np.concatenate(([True], (owner[1:] != owner[:-1]) | (number[1:] != number[:-1])))
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(hit))
        kernels, rows = np.empty((len(starts), self.values.shape[1])), place[hit]
        i = 0
        while i < len(starts):  # whole sentences of some GATHERED words at once
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + GATHERED, "right")))
            kernels[i:j] = np.maximum.reduceat(self.values[rows[starts[i]:ends[j - 1]]], starts[i:j] - starts[i])
            i = j
        return owner[starts], kernels


class Model:
    """Nyström map of the landmarks, support vector weights on it, and a calibrated score."""

    def __init__(self, landmarks: Landmarks, prior: float):
        self.landmarks, self.prior = landmarks, prior
        if landmarks.words:
            values, vectors = np.linalg.eigh(landmarks.gram)
            keep = values > 1e-6 * values.max()
            self.map = vectors[:, keep] / np.sqrt(values[keep])
        else:
            self.map = np.zeros((0, 0))
        self.weights, self.bias = np.zeros(self.map.shape[1]), -1.0
        self.scale, self.shift = 3.0, 0.0

    def margin(self, kernels: np.ndarray) -> np.ndarray:
        return kernels @ (self.map @ self.weights) + self.bias

    def learn(self, kernels: np.ndarray, label: np.ndarray, cost: float = 1.0, steps: int = 200) -> None:
        """Squared-hinge support vector machine by Newton steps on the active rows."""
        x = np.column_stack((kernels @ self.map, np.ones(len(kernels))))
        y = np.where(label > 0, 1.0, -1.0)
        w = np.zeros(x.shape[1])
        ridge = np.r_[np.full(x.shape[1] - 1, 1e-3), 1e-6]
        for _ in range(steps):
            slack = 1 - y * (x @ w)
            on = slack > 0
            grad = ridge * w - (x[on] * (cost * y * slack)[on, None]).sum(axis=0)
            step = np.linalg.solve(cost * x[on].T @ x[on] + np.diag(ridge), grad)
            w = w - step
            if np.abs(step).max() < 1e-8:
                break
        self.weights, self.bias = w[:-1], w[-1]

    def calibrate(self, kernels: np.ndarray, label: np.ndarray, folds: int = 4, steps: int = 100) -> None:
        """Platt's sigmoid, fitted to margins of rows that the machine behind each margin has not seen."""
        weights, bias = self.weights, self.bias
        fold, margin = np.empty(len(label), np.int64), np.empty(len(label))
        fold[np.argsort(label, kind="stable")] = np.arange(len(label)) % folds  # both labels in every fold
        for label_fold in range(folds):
            own = fold == label_fold
            if len(np.unique(label[~own])) < 2:
                return
            self.learn(kernels[~own], label[~own])
            margin[own] = self.margin(kernels[own])
        self.weights, self.bias = weights, bias
        positive = label > 0
        target = np.where(positive, (positive.sum() + 1) / (positive.sum() + 2), 1 / ((~positive).sum() + 2))
        x = np.column_stack((margin, np.ones(len(margin))))
        w = np.zeros(2)
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            grad = x.T @ (p - target) + 1e-3 * w
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), grad)
            w = w - step * min(1.0, 5 / max(np.abs(step).max(), 1e-12))
            if np.abs(step).max() < 1e-8:
                break
        if w[0] > 0:
            self.scale, self.shift = w

    def score(self, owner: np.ndarray, kernels: np.ndarray, texts: int) -> np.ndarray:
        """Of each text, the calibrated margin of its worst sentence; texts that touch no landmark have the bias alone."""
        if not self.landmarks.words:
            return np.full(texts, self.prior)
        best = np.full(texts, self.bias)
        if len(owner):
            np.maximum.at(best, owner, self.margin(kernels))
        return 1 / (1 + np.exp(np.clip(-self.scale * best - self.shift, -700, 700)))


def sample(labels: DataFrame, rows: int, clean_rows: int) -> DataFrame:
    """At most so many rows ``(label_id, label)`` of each label, those whose ids have the smallest hashes."""
    least = lambda label, n: labels.where(F.col("label") == label).orderBy(F.xxhash64("label_id"), "label_id").limit(n)
    return least(1, rows).unionByName(least(0, clean_rows))


def beginnings(text: str) -> set[str]:
    """The words of a text and their beginnings, as landmarks may have them."""
    own = set()
    for word in {plain(w) for w in sentences(text)[0]}:
        if LENGTH <= len(word) <= WINDOW:
            own.update(word[:n + 1] for n in STEMS if n < len(word) - 1)
            own.add(word)
    return own


def occurrences(texts: DataFrame, known: frozenset[str] | None = None) -> DataFrame:
    """``(stem, n)``: in how many texts a word or word beginning occurs; only the known ones if given."""
    def run(batches: Iterator[pa.RecordBatch]):
        counts: Counter[str] = Counter()
        for batch in slices(batches, ROWS, SIZE):
            for text in batch.column(0).to_pylist():
                own = beginnings(text)
                counts.update(own if known is None else own & known)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["stem", "n"])

    return mapped(texts.select("text"), run, "stem string, n long").groupBy("stem").agg(F.sum("n").alias("n"))


def sketch(text: str, keys: int = 8) -> list[int]:
    """Min-hashes of a text's three-word shingles: near copies share some of them."""
    words = text.lower().split()
    shingles = {zlib.crc32(" ".join(words[i:i + 3]).encode()) for i in range(max(1, len(words) - 2))}
    own = np.fromiter(shingles, np.uint64, len(shingles))
    factors = np.arange(1, keys + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)
    return (own[:, None] * factors).min(axis=0).astype(np.int64).tolist()


def places(texts: DataFrame, stems: list[str]) -> DataFrame:
    """``(found, sketch)``: of each text, the numbers of the stems it holds, and its min-hashes."""
    number = {s: i for i, s in enumerate(stems)}

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in slices(batches, ROWS, SIZE):
            own = batch.column(0).to_pylist()
            found = [sorted(number[s] for s in beginnings(t) & number.keys()) for t in own]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())),
                                              pa.array(list(map(sketch, own)), pa.list_(pa.int64()))], ["found", "sketch"])

    return mapped(texts.select("text"), run, "found array<int>, sketch array<long>")


def families(sketches: list[list[int]]) -> list[int]:
    """A number for each text of the bounded sample, the same for texts linked by two equal min-hashes."""
    parent = list(range(len(sketches)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    first: dict[tuple, int] = {}
    for i, own in enumerate(sketches):
        for key in combinations(enumerate(own), 2):
            parent[root(i)] = root(first.setdefault(key, i))
    return [root(i) for i in range(len(sketches))]


def surprise(n, m, toxic: int, clean: int):
    """Log-likelihood ratio of a stem in ``n`` toxic and ``m`` clean texts against one common share."""
    def part(k, rows):
        share = (n + m) / (toxic + clean)
        return (k * np.log(np.maximum(k, 1e-9) / (rows * np.maximum(share, 1e-12)))
                + (rows - k) * np.log(np.maximum(rows - k, 1e-9) / (rows * np.maximum(1 - share, 1e-12))))

    return 2 * (part(np.asarray(n, float), toxic) + part(np.asarray(m, float), clean))


def telling(n, m, toxic: int, clean: int, stems: int):
    """Whether a stem is over 20 times as frequent in toxic texts, by more than chance makes of ``stems`` tries.

    Over all tries less than CHANCE stems are expected to pass without telling
    anything (chi-squared tail of the likelihood ratio).
    """
    a, b = (np.asarray(n) + 0.5) / (toxic + 1), (np.asarray(m) + 0.5) / (clean + 1)
    g = np.maximum(surprise(n, m, toxic, clean), 1e-9)
    return (a > 20 * b) & (g / 2 + np.log(np.pi * g / 2) / 2 >= np.log(max(stems, 1) / CHANCE))


def chosen_landmarks(found: list[tuple[str, int, int]], held: list[list[int]], toxic: int, clean: int, stems: int) -> list[str]:
    """Stems that cover the toxic texts, greedily.

    ``held`` lists the places in ``found`` of each toxic text's stems. A stem
    counts the texts that no chosen one covers, so rare insults come before
    other forms of common ones; it is taken while those texts alone tell. The
    slots left go to further stems by the texts they tell in all, unless they
    hold letters of a chosen one. No two of the chosen begin each other; a
    longer one is taken only where it is cleaner.
    """
    order = sorted(range(len(found)), key=lambda i: (len(found[i][0]), found[i][0]))
    n, m = np.array([found[i][1] for i in order], float), np.array([found[i][2] for i in order], float)
    place = {old: new for new, old in enumerate(order)}
    rows = np.repeat(np.arange(len(held)), [len(h) for h in held])
    cols = np.array([place[i] for h in held for i in h], np.int64)
    open_rows, free, picked = np.ones(len(held), bool), np.ones(len(order), bool), []
    covering = True
    while len(picked) < LANDMARKS and free.any():
        count = np.bincount(cols[open_rows[rows]], minlength=len(order)).astype(float) if covering else n
        a, b = (count + 0.5) / (toxic + 1), (m + 0.5) / (clean + 1)
        worth = np.where(free & (count > 0) & telling(count, m, toxic, clean, stems), (a - b) * np.log(a / b), 0.0)
        best = int(worth.argmax())
        if worth[best] <= 0:
            if not covering:
                break
            covering = False
            # what is left speaks of texts that are covered: keep only stems without a chosen one's letters
            free &= np.array([not any(shares(found[i][0], p) for p in picked) for i in order], bool)
            continue
        stem = found[order[best]][0]
        picked.append(stem)
        open_rows[rows[cols == best]] = False
        free &= np.array([not (s.startswith(stem) or stem.startswith(s)) for s in (found[i][0] for i in order)], bool)
    return picked


def shares(a: str, b: str) -> bool:
    """Whether one holds LENGTH letters in a row of the other: its kernel with it is high already."""
    a, b = a[1:], b[1:]
    return a in b or b in a or any(a[i:i + LENGTH] in b for i in range(len(a) - LENGTH + 1))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "label",
        rows: int = 4000, clean_rows: int = 12_000) -> Model:
    """A model from texts and the labels of some (1 toxic, 0 clean; other labels and nulls teach nothing).

    Fitted on a bounded sample: at most ``rows`` toxic and ``clean_rows`` clean
    labels, chosen by id hash, and their texts. Landmarks are the word beginnings that cover the toxic texts best.
    Only texts are labelled, so a toxic text's most suspicious sentence and a
    clean text's are the examples, chosen anew by the machine's own margin in
    three rounds. Without examples of both labels every score is the smoothed
    share of toxic ones.
    """
    known = labels.select(F.col(id_col).cast("long").alias("label_id"), F.col(label_col).cast("int").alias("label")).where(
        "label_id IS NOT NULL AND label IN (0, 1)")
    asked = F.broadcast(sample(known, rows, clean_rows))  # rows + clean_rows rows at most
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).dropna()
    chosen = written(texts.join(asked, F.col("doc_id") == F.col("label_id")).select("text", "label"), "toxicity-sample")
    counts = {r.label: r.n for r in chosen.groupBy("label").agg(F.count("*").alias("n")).collect()}
    toxic, clean = counts.get(1, 0), counts.get(0, 0)
    prior = (toxic + 1) / (toxic + clean + 2)
    if not toxic or not clean:
        return Model(Landmarks([]), prior)
    first = occurrences(chosen.where("label = 1")).persist(StorageLevel.DISK_ONLY)
    stems = first.count()
    # a stem of fewer texts can't tell even where no clean text has it
    sizes = np.arange(1, toxic + 1)
    enough = sizes[telling(sizes, 0, toxic, clean, stems)]
    least = int(enough[0]) if len(enough) else toxic + 1
    often = {r.stem: r.n for r in first.where(F.col("n") >= least).toLocalIterator()}  # of at most ``rows`` texts
    first.unpersist()
    rest = {r.stem: r.n for r in occurrences(chosen.where("label = 0"), frozenset(often)).collect()}
    known = sorted(s for s, n in often.items() if telling(n, rest.get(s, 0), toxic, clean, stems))
    texts_held = places(chosen.where("label = 1"), known).collect() if known else []  # ``rows`` rows at most
    held_by = defaultdict(set)  # near copies count as one text
    for family, row in zip(families([r.sketch for r in texts_held]), texts_held):
        held_by[family].update(row.found)
    alone = Counter(i for own in held_by.values() for i in own)
    kinds = len(held_by)
    found = [(stem, alone[i], rest.get(stem, 0)) for i, stem in enumerate(known)]
    model = Model(Landmarks(chosen_landmarks(found, list(map(sorted, held_by.values())), kinds, clean, stems)), prior)
    if not model.landmarks.words:
        return model
    model.weights = np.linalg.lstsq(model.map, np.ones(len(model.map)), rcond=None)[0]
    for _ in range(3):
        worst = examples(chosen, model).toArrow()
        kernels = worst.column("kernels").combine_chunks().flatten().to_numpy().reshape(worst.num_rows, -1)
        label = worst.column("label").to_numpy()
        model.learn(kernels, label)
    model.calibrate(kernels, label)
    return model


def examples(chosen: DataFrame, model: Model) -> DataFrame:
    """``(label, kernels)``: of each text of the bounded sample the sentence with the highest margin."""
    def run(batches: Iterator[pa.RecordBatch]):
        tester = Tester(model.landmarks)
        for batch in slices(batches, ROWS, SIZE):
            owner, kernels = tester.features(batch.column(0).to_pylist())
            margin = model.margin(kernels)
            best = np.lexsort((-margin, owner))
            best = best[np.unique(owner[best], return_index=True)[1]]
            out = np.zeros((batch.num_rows, len(model.landmarks.words)))
            out[owner[best]] = kernels[best]
            values = pa.FixedSizeListArray.from_arrays(pa.array(out.ravel()), out.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(1), values], ["label", "kernels"])

    return mapped(chosen.select("text", "label"), run, "label int, kernels array<double>")


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score)`` of every row, in 0..1, higher where a text is likelier toxic.

    A null or empty text touches no landmark and gets the lowest score the
    model gives. Ids may be null or repeat; each row is returned.
    """
    shared, token = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex  # LANDMARKS words

    @holding(("toxicity", token))
    def run(batches: Iterator[pa.RecordBatch]):
        learned = shared.value
        tester = held(("toxicity", token), lambda: Tester(learned.landmarks))
        for batch in slices(batches, ROWS, SIZE):
            owner, kernels = tester.features(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(learned.score(owner, kernels, batch.num_rows))], ["doc_id", "score"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return mapped(picked, run, "doc_id long, score double")


def without_toxic(docs: DataFrame, model: Model, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose own text scores ``least`` or more.

    Decided row by row where the rows lie: ids may be null or repeat, columns
    may have any names, nothing is joined or shuffled.
    """
    shared, token = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex  # LANDMARKS words
    at = docs.columns.index(text_col)

    @holding(("toxicity", token))
    def run(batches: Iterator[pa.RecordBatch]):
        learned = shared.value
        tester = held(("toxicity", token), lambda: Tester(learned.landmarks))
        for batch in slices(batches, ROWS, SIZE):
            owner, kernels = tester.features(batch.column(at).to_pylist())
            yield batch.filter(pa.array(learned.score(owner, kernels, batch.num_rows) < least))

    return mapped(docs, run, docs.schema)
