"""Benchmark decontamination: a BM25 index of test items searched with block-max WAND."""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, holding, mapped, slices, written

#: BM25 constants, pieces of a block, and items of one index (what an executor holds).
K1, B = 1.2, 0.75
BLOCK = 4
#: Passages of one text that are searched together.
PASSAGES = 128
SHARD_ITEMS = 20_000
#: Words of an indexed piece of an item; passages are twice as long and half overlap, so a piece lies whole in one.
PIECE = 64
#: Retrieved from this share of a piece's own score on; words of a shingle, and the overlap that confirms.
THRESHOLD = 0.6
SHINGLE, OVERLAP = 5, 0.8
#: Fewest words of an answer that is verified on its own.
ANSWER_WORDS = 8
REMEMBERED = 300_000
EDGES = re.compile(r"^[\W_]+|[\W_]+$")
SENTENCE = re.compile(r"(?<=[.!?])\s+")


def normal(word: str) -> str:
    return word.lower() if word.isalnum() else EDGES.sub("", word.lower())


def words_of(text: str) -> list[str]:
    return [w for w in map(normal, text.split()) if w]


def parts(text: str) -> tuple[list[str], list[str]]:
    """Question and answer of an item that comes as one text: its last sentences, ANSWER_WORDS words at least, are the answer.

    An item too short for two such parts is all question.
    """
    sentences = [words_of(s) for s in SENTENCE.split(text)]
    answer: list[str] = []
    while sentences and len(answer) < ANSWER_WORDS:
        answer = sentences.pop() + answer
    question = [w for s in sentences for w in s]
    return (question, answer) if len(question) >= ANSWER_WORDS else (question + answer, [])


def shingles(words: list[str]) -> set[tuple[str, ...]]:
    return {tuple(words[i:i + SHINGLE]) for i in range(max(1, len(words) - SHINGLE + 1))} if words else set()


def covered(part: list[str], region: list[str]) -> float:
    """Share of a part's word shingles that the region holds; a part shorter than a shingle must occur whole."""
    if not part:
        return 1.0
    n = min(SHINGLE, len(part))
    there = {tuple(region[i:i + n]) for i in range(len(region) - n + 1)}
    own = shingles(part)
    return len(own & there) / len(own)


def edits(part: list[str], region: list[str]) -> int:
    """Fewest words to replace, insert or leave out so that the part occurs in the region."""
    at = np.arange(len(region) + 1)
    words = np.array(["", *region], object)
    row = np.zeros(len(at), np.int64)
    for n, word in enumerate(part, 1):
        one = np.append(n, np.minimum(row[:-1] + (words[1:] != word), row[1:] + 1))
        row = np.minimum.accumulate(one - at) + at
    return int(row.min())


def nearly_whole(words: list[str], region: list[str]) -> bool:
    """Whether the region holds OVERLAP of the words' shingles; of fewer words than one change leaves that of, all but one edit."""
    if covered(words, region) >= OVERLAP:
        return True
    fragile = max(1, len(words) - SHINGLE + 1) * (1 - OVERLAP) < SHINGLE
    return fragile and 1 <= (1 - OVERLAP) * len(words) + 1e-9 and edits(words, region) <= 1


class Postings:
    """Values by term: the numbers and values of each term's entries, in order of number."""

    def __init__(self, terms: np.ndarray, numbers: np.ndarray, values: np.ndarray, size: int):
        order = np.lexsort((numbers, terms))
        self.numbers, self.values = numbers[order], values[order]
        counts = np.bincount(terms, minlength=size + 1)
        self.starts, self.sizes = np.cumsum(counts) - counts, counts

    def of(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For all entries of the terms: which of the terms, and the place of the entry."""
        sizes = self.sizes[terms]
        ends = np.cumsum(sizes)
        which = np.repeat(np.arange(len(terms)), sizes)
        return which, np.arange(len(which)) - np.repeat(ends - sizes - self.starts[terms], sizes)


class Index:
    """BM25 postings of item pieces, each piece's own score scaled to one, with the maximum of every block.

    A block is BLOCK pieces with consecutive numbers; pieces are numbered by
    their heaviest term, so that similar ones share blocks. A piece that would
    miss THRESHOLD without one of its terms is scaled up until it doesn't;
    ``own`` has the factor that gives the score as a share of its own again.
    """

    def __init__(self, pieces: list[tuple[int, list[str]]], df: dict[str, int], total: int, mean: float):
        weighed = []
        for item, words in pieces:
            idf = {w: np.log(1 + (total - df[w] + 0.5) / (df[w] + 0.5)) for w in set(words)}
            norm = K1 * (1 - B + B * len(words) / mean)
            impact = {w: idf[w] * n * (K1 + 1) / (n + norm) for w, n in Counter(words).items()}
            heaviest = max(impact, key=lambda w, i=impact: (i[w], w))
            whole = sum(impact.values())
            own = min(1.0, (1 - impact[heaviest] / whole) / THRESHOLD) if len(impact) > 1 else 1.0
            weighed.append((heaviest, item, {w: v / whole / own for w, v in impact.items()}, own))
        weighed.sort(key=lambda x: x[:2])
        self.owner = np.array([item for _, item, _, _ in weighed], np.int64)
        self.own = np.array([own for _, _, _, own in weighed])
        self.terms: dict[str, int] = {}
        term, piece, value = [], [], []
        for number, (_, _, impact, _) in enumerate(weighed):
            for w in sorted(impact):
                term.append(self.terms.setdefault(w, len(self.terms)))
                piece.append(number)
                value.append(impact[w])
        term, piece, value = np.array(term, np.int64), np.array(piece, np.int64), np.array(value)
        self.blocks = -(-len(weighed) // BLOCK)
        self.pieces = Postings(term, piece, value, len(self.terms))
        places, which = np.unique(term * self.blocks + piece // BLOCK, return_inverse=True)
        peaks = np.zeros(len(places))
        np.maximum.at(peaks, which, value)
        self.maxima = Postings(places // self.blocks, places % self.blocks, peaks, len(self.terms))

    def search(self, passages: np.ndarray, terms: np.ndarray, threshold: float) -> Iterator[tuple[int, int, float]]:
        """``(passage, piece, score)`` of all that reach the threshold; ``terms`` are each passage's distinct ones.

        Block-max WAND for many passages at once: a block is a pivot only if
        the block maxima of a passage's terms add up to the threshold; all
        other blocks are skipped, and the pieces of a pivot block are scored
        in full from the postings.
        """
        many = int(passages.max(initial=-1)) + 1
        which, at = self.maxima.of(terms)
        bound = np.bincount(passages[which] * self.blocks + self.maxima.numbers[at], self.maxima.values[at],
                            many * self.blocks)
        pivots = bound >= threshold - 1e-9
        if not pivots.any():
            return
        hopeful = pivots.reshape(many, self.blocks).any(axis=1)[passages]
        passages, terms = passages[hopeful], terms[hopeful]
        which, at = self.pieces.of(terms)
        number = self.pieces.numbers[at]
        live = pivots[passages[which] * self.blocks + number // BLOCK]
        which, at, number = which[live], at[live], number[live]
        keys, place = np.unique(passages[which] * len(self.owner) + number, return_inverse=True)
        score = np.bincount(place, self.pieces.values[at])
        for key, value in zip(keys[score >= threshold - 1e-9].tolist(), score[score >= threshold - 1e-9].tolist()):
            yield key // len(self.owner), key % len(self.owner), value


class _Terms(dict):
    """Term number of every raw word, the number after the last for words without postings."""

    def __init__(self, terms: dict[str, int]):
        super().__init__()
        self.terms = terms

    def __missing__(self, word: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = number = self.terms.get(normal(word), len(self.terms))
        return number


class Searcher:
    """Queries an index with every passage of a text and verifies what it retrieves."""

    def __init__(self, index: Index, items: dict[int, tuple[list[str], list[str], bool]]):
        self.index, self.items = index, items
        self.term = _Terms(index.terms)

    def leaks(self, text: str | None) -> list[tuple[int, int, float, float, float]]:
        """``(item, first word of the passage, score, question and answer overlap)``, the best passage of each item."""
        raw = (text or "").split()
        if not raw:
            return []
        numbers = np.fromiter(map(self.term.__getitem__, raw), np.int64, len(raw))
        known = np.flatnonzero(numbers < len(self.index.terms))
        last = max(0, -(-len(raw) // PIECE) - 2)  # passages start at 0, PIECE, ... last * PIECE
        best: dict[int, tuple] = {}
        for first in range(0, last + 1, PASSAGES):
            lo, hi = np.searchsorted(known, (first * PIECE, (first + PASSAGES + 1) * PIECE))
            step, term = known[lo:hi] // PIECE - first, numbers[known[lo:hi]]
            both = np.concatenate((step, step - 1))  # a word is in the passage of its step and in the one before
            fits = (both >= 0) & (both < min(PASSAGES, last + 1 - first))
            pairs = np.unique((both * len(self.index.terms) + np.concatenate((term, term)))[fits])
            found = self.index.search(pairs // len(self.index.terms), pairs % len(self.index.terms), THRESHOLD)
            for passage, piece, score in found:
                at, item = (first + passage) * PIECE, int(self.index.owner[piece])
                question, answer, given = self.items[item]
                score *= float(self.index.own[piece])
                around = len(question) + len(answer)
                region = words_of(" ".join(raw[max(0, at - around):at + 2 * PIECE + around]))
                q, a = covered(question, region), covered(answer, region)
                if item in best and score <= best[item][2]:
                    continue
                if q >= OVERLAP and a >= OVERLAP or not given and nearly_whole(question + answer, region):
                    best[item] = (item, at, score, q, a)
        return [best[i] for i in sorted(best)]


#: By a token of the driver's: an address may serve another index once its own is freed.
LEAK = "doc_id long, item_id long, passage long, score double, question_overlap double, answer_overlap double"


def pieces_of(items: DataFrame) -> DataFrame:
    """``(item_id, question, answer, given, pieces)``: normalised words of the parts, whether the answer came as such, and the whole cut into indexed pieces."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            split = [(words_of(q or ""), words_of(a)) if a is not None else parts(q or "")
                     for q, a in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            cut = []
            for question, answer in split:
                words = question + answer
                last = max(1, len(words) - PIECE // 2)
                cut.append([words[i:i + PIECE] for i in range(0, last, PIECE // 2)] if len(words) > PIECE else [words])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([q for q, _ in split], pa.list_(pa.string())),
                 pa.array([a for _, a in split], pa.list_(pa.string())), batch.column(2).is_valid(),
                 pa.array(cut, pa.list_(pa.list_(pa.string())))], ["item_id", "question", "answer", "given", "pieces"])

    return mapped(items, run, "item_id long, question array<string>, answer array<string>, given boolean, pieces array<array<string>>")


def leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
          question_col: str = "text", answer_col: str | None = None) -> DataFrame:
    """Every (document, test item) with a passage that holds the item's question and answer.

    Test items are indexed as pieces of up to PIECE words; statistics are over
    all items. Each passage of 2 * PIECE words (every PIECE words) is a query;
    pieces scoring THRESHOLD of their own score are retrieved, and an item
    counts when OVERLAP of the word shingles of its question, and of its
    answer, occur around the passage. Without an answer column (or value) an
    item's last sentences are its answer, and it also counts when OVERLAP of
    the shingles of its whole text occur, or, where a single changed word costs
    more than that, when one word is replaced, added or missing. Indexes hold SHARD_ITEMS items each; more items
    mean more passes over the texts. Null or empty texts and items match
    nothing; rows with a null document id are searched too, items with a null
    id are not; repeated documents are each returned, repeated items (same id)
    count as one; without documents or items the result is empty.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    found = docs.sparkSession.createDataFrame([], LEAK)
    for number, own in enumerate(shards(items, item_col, question_col, answer_col)):
        part = searched(texts, *own)
        found = found.unionByName(part) if number else part
    return found


def searched(texts: DataFrame, own: DataFrame, df: DataFrame, total: int, mean: float) -> DataFrame:
    """Leaks of one index's items."""
    shared, token = shared_index(own, df, total, mean)

    @holding(("decontam", token))
    def run(batches: Iterator[pa.RecordBatch]):
        searcher = held(("decontam", token), lambda: Searcher(*shared.value))
        for batch in slices(batches):
            out = [(d, *leak) for d, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                   for leak in searcher.leaks(t)]
            columns = list(zip(*out)) or [()] * 6
            kinds = [pa.int64()] * 3 + [pa.float64()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                             [f.split()[0] for f in LEAK.split(", ")])

    return mapped(texts, run, LEAK)


def shared_index(own: DataFrame, df: DataFrame, total: int, mean: float) -> tuple[Broadcast, str]:
    """One index of SHARD_ITEMS items at most as a broadcast, and a token that names it."""
    terms = own.select(F.explode(F.flatten("pieces")).alias("word")).distinct()
    counts = {r.word: r.df for r in df.join(terms, "word", "left_semi").collect()}  # words of SHARD_ITEMS items
    rows = sorted(own.collect(), key=lambda r: r.item_id)
    items = {r.item_id: (list(r.question), list(r.answer), r.given) for r in rows}
    index = Index([(r.item_id, list(p)) for r in rows for p in r.pieces], counts, total, mean)
    return own.sparkSession.sparkContext.broadcast((index, items)), uuid.uuid4().hex


def shards(items: DataFrame, item_col: str = "item_id", question_col: str = "text",
           answer_col: str | None = None) -> Iterator[tuple[DataFrame, DataFrame, int, float]]:
    """Test items in shards of about SHARD_ITEMS, each with the document frequencies, number and mean length of all pieces.

    Of items that repeat an id, the one with the smallest (question, answer) counts, nulls last.
    """
    answer = F.col(answer_col).cast("string") if answer_col else F.lit(None).cast("string")
    both = F.struct(F.col(question_col).cast("string").alias("question"), answer.alias("answer"))
    picked = (items.select(F.col(item_col).cast("long").alias("item_id"), both.alias("item")).where("item_id IS NOT NULL")
              .groupBy("item_id").agg(F.min_by("item", F.struct(
                  F.col("item.question").isNull(), "item.question", F.col("item.answer").isNull(), "item.answer")).alias("item"))
              .select("item_id", "item.*"))
    cut = written(pieces_of(picked).where(F.size("question") + F.size("answer") > 0), "test-items")
    each = cut.select(F.explode("pieces").alias("words"))
    total, mean = each.agg(F.count("*"), F.avg(F.size("words"))).first()
    n_items = cut.count()
    df = each.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    count = -(-n_items // SHARD_ITEMS)
    for shard in range(count):
        yield cut.where(F.pmod(F.xxhash64("item_id"), F.lit(count)) == shard), df, total, mean


def without_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  question_col: str = "text", answer_col: str | None = None) -> DataFrame:
    """``docs`` without the rows whose own text leaks a test item, as ``leaks`` finds it.

    Decided row by row where the rows lie: ids may be null or repeat, columns
    may have any names, nothing is joined or shuffled. A row is searched in one
    index after the other until it leaks.
    """
    at = docs.columns.index(text_col)

    def run_of(shared: Broadcast, token: str):
        @holding(("decontam", token))
        def run(batches: Iterator[pa.RecordBatch]):
            searcher = held(("decontam", token), lambda: Searcher(*shared.value))
            for batch in slices(batches):
                clean = [next(iter(searcher.leaks(t)), None) is None for t in batch.column(at).to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))
        return run

    for own in shards(items, item_col, question_col, answer_col):
        docs = mapped(docs, run_of(*shared_index(*own)), docs.schema)
    return docs
