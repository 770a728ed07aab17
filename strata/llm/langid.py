"""Language identification with interpolated Kneser-Ney character models."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held, holding, _Index, mapped, slices, written

#: Characters of a gram: each is predicted from the three before it.
ORDER = 4
#: Codes before a word's first and after its last letter.
START, END = 1, 2
LETTERS = re.compile(r"[^\W\d_]+")
UNDETERMINED = "und"
#: Words remembered by a worker.
REMEMBERED = 150_000
#: Numbers (grams of all languages times languages) up to which one model holds everything; more are split into several.
PART_CELLS = 6_000_000
#: Words of texts a worker holds back, to load each of several models once for all of them.
HELD_WORDS = 2_000_000
MASKS = [np.uint64((1 << 16 * k) - 1) for k in range(ORDER + 1)]


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the ORDER-grams that end at each letter and word end, and how many each word has.

    A word's letter runs are scored one after another, each between boundary
    codes. A character takes 16 bits (characters beyond the first plane are
    folded into it), so a gram's hash is its characters side by side.
    """
    runs = [LETTERS.findall(w) for w in words]
    per_word = np.fromiter((sum(map(len, r)) + len(r) for r in runs), np.int64, len(runs))
    flat = [r for word in runs for r in word]
    if not flat:
        return np.empty(0, np.uint64), per_word
    points = np.frombuffer("".join(flat).encode("utf-32-le", "replace"), np.uint32)
    points = ((points & 0xFFFF) ^ (points >> 16) * 0x9E3).astype(np.uint64) & np.uint64(0xFFFF)
    sizes = np.fromiter(map(len, flat), np.int64, len(flat))
    # every run: ORDER - 1 starts, its letters, an end
    places = np.cumsum(sizes + ORDER) - sizes - 1
    codes = np.full(int((sizes + ORDER).sum()), START, np.uint64)
    within = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    codes[np.repeat(places, sizes) + within] = points
    codes[places + sizes] = END
    keys = np.zeros(len(codes) - ORDER + 1, np.uint64)
    for i in range(ORDER):
        keys = keys << np.uint64(16) | codes[i:len(codes) - ORDER + 1 + i]
    predicted = np.ones(len(codes), bool)
    for i in range(ORDER - 1):
        predicted[places - 1 - i] = False
    return keys[predicted[ORDER - 1:]], per_word


def counted(docs: DataFrame) -> DataFrame:
    """``(lang, gram, n)`` over all rows of ``docs(text, lang)``; each task sums its own words first."""
    def flush(index: _Index, counts: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        keys, sizes = grams(list(index))
        for lang, n in counts.items():
            n = np.pad(n, (0, len(index) - len(n)))
            weights = np.repeat(n, sizes)
            found, place = np.unique(keys[weights > 0], return_inverse=True)
            total = np.bincount(place, weights[weights > 0], len(found)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(found), pa.string()), pa.array(found.view(np.int64)), pa.array(total)], ["lang", "gram", "n"])

    def run(batches: Iterator[pa.RecordBatch]):
        index, counts = _Index(), {}
        for batch in slices(batches):
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = text.lower().split()
                at = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
                old = counts.get(lang, np.empty(0, np.int64))
                if len(old) < len(index):
                    old = np.pad(old, (0, len(index) - len(old) + 4096))
                np.add.at(old, at, 1)
                counts[lang] = old
            if len(index) > REMEMBERED:
                counts = {k: v[:len(index)] for k, v in counts.items()}
                yield from flush(index, counts)
                index, counts = _Index(), {}
        yield from flush(index, {k: v[:len(index)] for k, v in counts.items()})

    parts = mapped(docs.select("text", "lang"), run, "lang string, gram long, n long")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Level:
    """Probabilities of one gram length for every language, in sorted hash arrays."""

    def __init__(self, keys: np.ndarray, logs: np.ndarray, contexts: np.ndarray, backs: np.ndarray):
        self.keys, self.logs, self.contexts, self.backs = keys, logs, contexts, backs


def located(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the wanted hashes in a sorted array, and which are there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


def discount(once: int, twice: int) -> float:
    return once / (once + 2 * twice) if once else 0.5


class Model:
    """Interpolated Kneser-Ney models of several languages over common sorted hash arrays.

    ``counts`` are each language's ORDER-grams. If they are only those whose
    middle pair is in a range, ``lower`` has the levels 1 and 2 (by level and
    language) and ``cuts`` the discounts (by language and level) of all grams.
    """

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]],
                 lower: dict[tuple[int, str], tuple[np.ndarray, np.ndarray]] | None = None,
                 cuts: dict[tuple[str, int], float] | None = None):
        self.langs = sorted(counts)
        own: dict[str, list[tuple]] = {}
        for lang, (keys, n) in counts.items():
            order = np.argsort(keys)
            levels = {ORDER: (keys[order], n[order].astype(np.float64))}
            for k in range(ORDER - 1, 0, -1):  # below the top: in how many longer grams a gram ends
                if lower is not None and k <= 2:
                    shorter, times = lower[k, lang]
                    order = np.argsort(shorter)
                    shorter, times = shorter[order], times[order]
                else:
                    shorter, times = np.unique(levels[k + 1][0] & MASKS[k], return_counts=True)
                levels[k] = (shorter, times.astype(np.float64))
            own[lang] = [levels[k] for k in range(1, ORDER + 1)]
        self.floor = -np.log(len(np.unique(np.concatenate([x[0][0] for x in own.values()] or [np.empty(0, np.uint64)]))) + 1)
        self.levels: list[Level] = []
        for k in range(1, ORDER + 1):
            keys = np.unique(np.concatenate([own[x][k - 1][0] for x in self.langs] or [np.empty(0, np.uint64)]))
            contexts = np.unique(keys >> np.uint64(16))
            logs = np.empty((len(keys), len(self.langs)))
            backs = np.zeros((len(contexts), len(self.langs)))
            lower = self.logs(keys, k - 1)
            for j, lang in enumerate(self.langs):
                mine, n = own[lang][k - 1]
                cut = discount((n == 1).sum(), (n == 2).sum()) if cuts is None else cuts[lang, k]
                heads, place = np.unique(mine >> np.uint64(16), return_inverse=True)
                total, kinds = np.bincount(place, n), np.bincount(place)
                back = np.minimum(1.0, cut * kinds / total)
                at, there = located(heads, contexts)
                backs[there, j] = np.log(back[at[there]])
                at, seen = located(mine, keys)
                direct = np.zeros(len(keys))
                direct[seen] = (np.maximum(n - cut, 0) / total[place])[at[seen]]
                at, there = located(contexts, keys >> np.uint64(16))
                logs[:, j] = np.log(direct + np.exp(backs[at, j] + lower[:, j]))
            self.levels.append(Level(keys, logs, contexts, backs))

    def logs(self, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Log-probability of each gram's last character in each language, by the longest known history."""
        if order == 0 or not len(keys):
            return np.full((len(keys), len(self.langs)), self.floor)
        keys = keys & np.uint64((1 << 16 * order) - 1)
        level = self.levels[order - 1]
        at, there = located(level.keys, keys)
        if not len(level.keys):
            return np.full((len(keys), len(self.langs)), self.floor)
        out = level.logs[at]
        unseen = np.flatnonzero(~there)
        if len(unseen):
            rest = self.logs(keys[unseen], order - 1)
            at, there = located(level.contexts, keys[unseen] >> np.uint64(16))
            rest[there] += level.backs[at[there]]
            out[unseen] = rest
        return out


def middle(keys: np.ndarray) -> np.ndarray:
    """The second last and the character before it, in this order: what grams are split by."""
    return (keys >> np.uint64(16) & MASKS[1]) << np.uint64(16) | keys >> np.uint64(32) & MASKS[1]


class Parts:
    """Broadcast models, each of the grams whose middle pair is in one of consecutive ranges.

    A gram's probability needs the counts of grams with the same middle pair,
    and of pairs and single characters, so one part alone has all of it.
    """

    def __init__(self, langs: list[str], starts: list[int], models: list[Broadcast]):
        self.langs, self.starts, self.models = langs, np.array(starts, np.uint64), models
        self.token = uuid.uuid4().hex

    def logs(self, keys: np.ndarray) -> np.ndarray:
        """Log-probabilities as of one model of all grams; of several models one at a time is in memory."""
        if len(self.models) == 1:
            return self.models[0].value.logs(keys)
        out = np.empty((len(keys), len(self.langs)))
        part = np.searchsorted(self.starts, middle(keys), "right") - 1
        for i in np.unique(part):
            shared = self.models[i]
            out[part == i] = shared.value.logs(keys[part == i])
            if getattr(shared, "_path", None):  # it can be read from the executor's disk again
                vars(shared).pop("_value", None)
        return out


class Scorer:
    """Sums of log-probabilities of texts, each distinct word worked out once while remembered."""

    def __init__(self, model: Model | Parts):
        self.model = model
        self.clear()

    def clear(self) -> None:
        self.index = _Index()
        self.sums = np.empty((0, len(self.model.langs) + 1))

    def placed(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all words end to end, and each text's count."""
        words = [(t or "").lower().split() for t in texts]
        counts = np.fromiter(map(len, words), np.int64, len(words))
        return np.fromiter((self.index[w] for own in words for w in own), np.int64, int(counts.sum())), counts

    def learn(self) -> None:
        """Works out the words not yet known."""
        if self.index.fresh:
            keys, sizes = grams(self.index.fresh)
            edges = np.concatenate(([0], np.cumsum(sizes)))
            totals = np.concatenate((np.zeros((1, len(self.model.langs))), np.cumsum(self.model.logs(keys), axis=0)))
            self.sums = np.concatenate((self.sums, np.column_stack((np.diff(totals[edges], axis=0), sizes))))
            self.index.fresh = []

    def totals(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """For each text its log-probability in each language and, last, its scored characters."""
        self.learn()
        out = np.zeros((len(counts), len(self.model.langs) + 1))
        full = np.flatnonzero(counts)
        if len(full):
            out[full] = np.add.reduceat(self.sums[at], (np.cumsum(counts) - counts)[full])
        return out

    def scored(self, batches: Iterator[pa.RecordBatch], together: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        """Slices and their texts' totals; new words are worked out for about ``together`` words at a time."""
        held, words = [], 0
        for batch in slices(batches):
            if not held and len(self.index) > REMEMBERED:
                self.clear()
            at, counts = self.placed(batch.column(1).to_pylist())
            held.append((batch, at, counts))
            words += len(at)
            if words >= together or len(self.index.fresh) > REMEMBERED:
                yield from ((b, self.totals(*own)) for b, *own in held)
                held, words = [], 0
        yield from ((b, self.totals(*own)) for b, *own in held)


def arrays(rows: DataFrame, langs: list[str]) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Grams and counts of each language from rows ``(lang, gram, n)``."""
    table = rows.select("lang", "gram", "n").toArrow()
    lang = table.column("lang").to_numpy(zero_copy_only=False).astype(str)
    keys, n = table.column("gram").to_numpy().view(np.uint64), table.column("n").to_numpy()
    return {x: (keys[lang == x], n[lang == x]) for x in langs}


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", cells: int = PART_CELLS) -> Parts:
    """Models of every non-null label, from all grams of all labelled texts.

    Up to ``cells`` numbers the grams are one model; more are split by ranges
    of their middle pair into models of about that size, which the driver
    builds and broadcasts one after another. Counts of counts, continuation
    counts and the alphabet are of all grams either way, so the split changes
    no probability. Rows with a null text or label teach nothing; no labelled
    row gives a model without languages.
    """
    known = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).dropna()
    all_grams = written(counted(known), "grams")
    sizes = {r.lang: r.n for r in all_grams.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(sizes)
    parts = -(-sum(sizes.values()) * len(langs) // cells) if langs else 1
    share = docs.sparkSession.sparkContext.broadcast
    if parts <= 1:
        return Parts(langs, [0], [share(Model(arrays(all_grams, langs)))])
    return split(docs.sparkSession, all_grams, langs, parts)


def split(spark: SparkSession, all_grams: DataFrame, langs: list[str], parts: int) -> Parts:
    """``parts`` models of consecutive ranges, or fewer where one pair has more grams than a part."""
    levels, cuts = {ORDER: all_grams}, {}
    for k in range(ORDER, 0, -1):
        if k < ORDER:
            shorter = F.col("gram").bitwiseAND(F.lit(int(MASKS[k])))
            levels[k] = written(levels[k + 1].groupBy("lang", shorter.alias("gram")).agg(F.count("*").alias("n")), f"grams-{k}")
        for r in levels[k].groupBy("lang").agg(F.count_if(F.col("n") == 1).alias("once"), F.count_if(F.col("n") == 2).alias("twice")).collect():
            cuts[r.lang, k] = discount(r.once, r.twice)
    last = F.shiftright("gram", 16).bitwiseAND(F.lit(0xFFFF))
    pair = last * 65536 + F.shiftright("gram", 32).bitwiseAND(F.lit(0xFFFF))
    edges = all_grams.agg(F.percentile_approx(pair, [i / parts for i in range(1, parts)], 10_000)).first()[0]
    starts = [0, *sorted(set(edges) - {0})]
    single = arrays(levels[1], langs)  # at most as many as there are characters
    models = []
    for lo, hi in zip(starts, [*starts[1:], 1 << 32]):
        double = arrays(levels[2].where(last.between(lo >> 16, hi - 1 >> 16)), langs)
        lower = {(k, x): level[x] for k, level in ((1, single), (2, double)) for x in langs}
        models.append(spark.sparkContext.broadcast(Model(arrays(all_grams.where((pair >= lo) & (pair < hi)), langs), lower, cuts)))
    return Parts(langs, starts, models)


def predict(docs: DataFrame, model: Model | Parts, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score, cross_entropy)`` of every row.

    The language with the lowest cross-entropy per character wins (ties: the
    first in name order); ``score`` is its share among all languages when each
    is weighted by its per-character probability over up to 20 characters. A
    text that is null or holds no letter, and any text when no language was
    learned, is ``und`` with score 0 and no cross-entropy. Ids may be null or
    repeat; each row is returned.
    """
    learned = Parts(model.langs, [0], [docs.sparkSession.sparkContext.broadcast(model)]) if isinstance(model, Model) else model

    @holding(("langid", learned.token))
    def run(batches: Iterator[pa.RecordBatch]):
        scorer = held(("langid", learned.token), lambda: Scorer(learned))
        names = np.array([*learned.langs, UNDETERMINED], object)
        for batch, totals in scorer.scored(batches, HELD_WORDS if len(learned.models) > 1 else 1):
            size = totals[:, -1]
            cost = -totals[:, :-1] / np.maximum(size, 1)[:, None]
            best = np.full(len(size), len(learned.langs))
            low, share = np.full(len(size), np.nan), np.zeros(len(size))
            if learned.langs:
                scored = size > 0
                best[scored] = cost[scored].argmin(axis=1)
                low[scored] = cost[scored].min(axis=1)
                gap = (cost - cost.min(axis=1, keepdims=True)) * np.minimum(size, 20)[:, None]
                share[scored] = 1 / np.exp(-gap[scored]).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names[best], pa.string()), pa.array(share), pa.array(low, mask=np.isnan(low))],
                ["doc_id", "lang_pred", "score", "cross_entropy"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return mapped(picked, run, "doc_id long, lang_pred string, score double, cross_entropy double")


def calibrated(predicted: DataFrame, learned_from: DataFrame, share: float = 0.999) -> DataFrame:
    """``predicted`` with ``rejected``: its cross-entropy is beyond what the language's own texts reach.

    The limit of a language is the ``share`` quantile of cross-entropy over all
    predictions of that language among the rows ``learned_from`` marks; a text
    above it resembles no learned language. ``und`` counts as rejected.
    """
    limits = (learned_from.where("cross_entropy IS NOT NULL").groupBy("lang_pred")
              .agg(F.percentile_approx("cross_entropy", share, 10_000).alias("limit")))
    limits = F.broadcast(limits)  # one row a language
    return (predicted.join(limits, "lang_pred", "left")
            .withColumn("rejected", F.coalesce(F.col("cross_entropy") > F.col("limit"), F.lit(True))).drop("limit"))
