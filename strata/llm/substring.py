"""Substring dedup: paragraph MinHash banding, exact Jaccard, removal by components."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import _Index, checked, components, held, holding, mapped, slices, written

#: A paragraph ends where a word pair's hash is the least of this many words to either side, or after MAX_WORDS.
RADIUS = 5
MAX_WORDS = 64
#: Words of a shingle, the Jaccard similarity of a link, and the fewest words a removed passage has.
SHINGLE, SIMILARITY, MIN_WORDS = 5, 0.8, 10
#: Bands and MinHash rows of a band: at Jaccard 0.8, 1 - (1 - 0.8 ** 2) ** 4 = 98 % of pairs share a band.
BANDS, ROWS = 4, 2
BAND_BITS = (1 << (BANDS - 1).bit_length()) - 1
#: Paragraphs whose counts a task sums before it sends them on.
HELD = 400_000
REMEMBERED = 300_000
WORD = re.compile(r"\S+")
TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
ODD = (np.arange(1, MAX_WORDS + 64, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


class Cutter:
    """Cuts texts into content-defined paragraphs and hashes them; words are hashed once while remembered.

    Passages repeat inside lines, not only as whole lines, so a paragraph is
    cut by its content alone: copies of a passage are cut alike wherever they
    stand, but for the paragraphs at its ends. A few words repeated over and
    over are a paragraph of their own, whose shingles don't tell its length.
    """

    def __init__(self):
        self.index, self.hashes = _Index(), np.empty(0, np.uint64)

    def words(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all lower-cased words end to end, and each text's count."""
        if len(self.index) > REMEMBERED:
            self.__init__()
        split = [(t or "").lower().split() for t in texts]
        counts = np.fromiter(map(len, split), np.int64, len(split))
        at = np.fromiter((self.index[w] for own in split for w in own), np.int64, int(counts.sum()))
        if self.index.fresh:
            new = [xxhash.xxh3_64_intdigest(w) for w in self.index.fresh]
            self.hashes = np.concatenate((self.hashes, np.array(new, np.uint64)))
            self.index.fresh = []
        return self.hashes[at], counts

    @staticmethod
    def starts(h: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each paragraph's first word, and the text it is in."""
        text = np.repeat(np.arange(len(counts)), counts)
        if not len(h):
            return np.empty(0, np.int64), text
        first = np.concatenate(([True], text[1:] != text[:-1]))
        pair = mix(h * np.uint64(3) + np.concatenate((h[1:], h[:1])))
        ends = np.concatenate((first[1:], [True]))
        pair[ends] = TOP
        # texts are set apart by RADIUS places, so none is cut by its neighbour's words
        place = np.arange(len(h)) + text * RADIUS + RADIUS
        wide = np.full(int(place[-1]) + RADIUS + 1, TOP)
        wide[place] = pair
        least = pair < TOP
        for d in range(1, RADIUS + 1):
            least &= (pair <= wide[place - d]) & (pair <= wide[place + d])
        # least ones near each other are equal: words that repeat over and over; such a run is cut where it begins and ends
        cut = np.flatnonzero(least)
        near = np.diff(place[cut]) <= RADIUS
        cut = cut[~(np.append(False, near) & np.append(near, False))] if len(cut) else cut
        begins = first.copy()
        begins[cut + 1] = True  # a text's last word has no pair, so this stays inside the text
        at = np.flatnonzero(begins)
        sizes = np.diff(np.append(at, len(h)))
        parts = -(-sizes // MAX_WORDS)
        which = np.repeat(np.arange(len(at)), parts)
        at = at[which] + (np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)) * MAX_WORDS
        return at, text[at]

    @staticmethod
    def shingles(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the shingle at each word, and how many words its paragraph has from there on."""
        sizes = np.diff(np.append(at, len(h)))
        left = np.repeat(at + sizes, sizes) - np.arange(len(h))
        total = np.zeros(len(h), np.uint64)
        for i in range(SHINGLE):
            ahead = np.concatenate((h[i:], np.zeros(min(i, len(h)), np.uint64)))
            total += np.where(left > i, ahead * ODD[i], np.uint64(0))
        return mix(total), left

    @staticmethod
    def whole(h: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Hash of each paragraph's words in order."""
        sizes = np.diff(np.append(at, len(h)))
        return mix(np.add.reduceat(mix(h * ODD[np.arange(len(h)) - np.repeat(at, sizes)]), at)) if len(at) else h[:0]

    def keys(self, h: np.ndarray, at: np.ndarray) -> np.ndarray:
        """BANDS keys of each paragraph from ROWS least shingle hashes each; the low bits tell the band."""
        shingle, left = self.shingles(h, at)
        sizes = np.diff(np.append(at, len(h)))
        usable = (left >= SHINGLE) | (np.repeat(sizes, sizes) == left)  # a short paragraph has one shingle, itself
        out = np.zeros((len(at), BANDS), np.uint64)
        for band in range(BANDS):
            key = np.full(len(at), band + 1, np.uint64)
            for row in range(ROWS):
                v = mix(shingle * ODD[8 + band * ROWS + row] + ODD[40 + band * ROWS + row])
                v[~usable] = TOP
                key = mix(key * np.uint64(31) + np.minimum.reduceat(v, at))
            out[:, band] = key & ~np.uint64(BAND_BITS) | np.uint64(band)
        return out


def cutter() -> Cutter:
    return held("substring", Cutter)


def counted(texts: DataFrame) -> DataFrame:
    """``(hash, n, keys)`` of paragraphs; each task sums equal ones first, so a common passage is one row a task."""
    def flush(hashes: list, keys: list) -> pa.RecordBatch:
        all_hashes, all_keys = np.concatenate(hashes), np.concatenate(keys)
        found, first, n = np.unique(all_hashes, return_index=True, return_counts=True)
        own = pa.FixedSizeListArray.from_arrays(pa.array(all_keys[first].view(np.int64).ravel()), BANDS)
        return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n), own.cast(pa.list_(pa.int64()))],
                                          ["hash", "n", "keys"])

    @holding("substring")
    def run(batches: Iterator[pa.RecordBatch]):
        tool, hashes, keys, count = cutter(), [], [], 0
        for batch in slices(batches):
            h, counts = tool.words(batch.column(1).to_pylist())
            at, _ = tool.starts(h, counts)
            if len(at):
                hashes.append(tool.whole(h, at))
                keys.append(tool.keys(h, at))
                count += len(at)
            if count > HELD:
                yield flush(hashes, keys)
                hashes, keys, count = [], [], 0
        if count:
            yield flush(hashes, keys)

    return mapped(texts, run, "hash long, n long, keys array<long>")


def paragraphs(texts: DataFrame) -> DataFrame:
    """``(doc_id, sig, idx, n_words, hash)`` of every paragraph of ``texts(doc_id, sig, text)``."""
    @holding("substring")
    def run(batches: Iterator[pa.RecordBatch]):
        tool = cutter()
        for batch in slices(batches):
            h, counts = tool.words(batch.column(2).to_pylist())
            at, text = tool.starts(h, counts)
            first = np.searchsorted(text, np.arange(len(counts)))
            sizes = np.diff(np.append(at, len(h)))
            ids, sigs = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[text], pa.int64()), pa.array(sigs[text], pa.int64()),
                 pa.array(np.arange(len(at)) - first[text], pa.int32()),
                 pa.array(sizes, pa.int32()), pa.array(tool.whole(h, at).view(np.int64))],
                ["doc_id", "sig", "idx", "n_words", "hash"])

    return mapped(texts, run, "doc_id long, sig long, idx int, n_words int, hash long")


def looked_up(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(hash, shingles)`` of the wanted paragraphs ``(doc_id, sig, idx, hash)``, cut from their texts again."""
    @holding("substring")
    def run(batches: Iterator[pa.RecordBatch]):
        tool = cutter()
        for batch in slices(batches, 64):
            h, counts = tool.words(batch.column(1).to_pylist())
            at, text = tool.starts(h, counts)
            shingle, left = tool.shingles(h, at)
            first = np.searchsorted(text, np.arange(len(counts)))
            ends = np.append(at, len(h))
            hashes, sets = [], []
            for row, asked in enumerate(batch.column(2).to_pylist()):
                for one in asked:
                    p = first[row] + one["idx"]
                    a, z = ends[p], ends[p + 1]
                    own = shingle[a:max(a + 1, z - SHINGLE + 1)]
                    hashes.append(one["hash"])
                    sets.append(np.unique(own).view(np.int64).tolist())
            yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["hash", "shingles"])

    by_doc = written(wanted.groupBy(F.col("doc_id").alias("asked_id"), F.col("sig").alias("asked_sig")).agg(
        F.collect_list(F.struct("idx", "hash")).alias("asked")), "paragraphs-asked")  # at most a text's paragraphs
    found = texts.join(checked(by_doc, "asked"), (F.col("doc_id") == F.col("asked_id")) & (F.col("sig") == F.col("asked_sig")))
    return mapped(found.select("doc_id", "text", "asked"), run, "hash long, shingles array<long>").dropDuplicates(["hash"])


def prefixes(shingles: str = "shingles", head_set: str = "head_set") -> str:
    """``(token, own, other)`` by which a set meets every set of a bucket with SIMILARITY or more, as SQL.

    Sets of a and b shingles need o = ceil((a + b) * S / (1 + S)) in common,
    so in any order of shingles that a bucket agrees on the first a - o + 1
    and the first b - o + 1 share one. Shingles that the bucket's head lacks
    come first: what a crowded bucket has in common is hardly ever a token.
    """
    share = SIMILARITY / (1 + SIMILARITY)
    ordered = (f"concat(array_sort(array_except({shingles}, {head_set})), array_sort(array_intersect({shingles}, {head_set})))")
    own = f"size({shingles})"
    sizes = f"sequence(int(ceil({SIMILARITY} * {own} - 1e-9)), int(floor({own} / {SIMILARITY} + 1e-9)))"
    first = f"slice({ordered}, 1, greatest(0, {own} - int(ceil(({own} + other) * {share} - 1e-9)) + 1))"
    return f"flatten(transform({sizes}, other -> transform({first}, token -> struct(token AS token, {own} AS own, other AS other))))"


#: Members up to which all pairs of a bucket's far members are compared.
SMALL_BUCKET = 32


def near_links(buckets: DataFrame, sets: DataFrame) -> DataFrame:
    """Edges between different paragraphs of a bucket whose Jaccard similarity is SIMILARITY or more.

    All are compared with the bucket's head, the paragraph found most often;
    of the rest only pairs not both linked to the head already are compared,
    inside the join: all of a bucket of SMALL_BUCKET members or fewer, and in
    a larger one those that share a prefix token, which every similar pair
    does. Heads come from an aggregate and a join, so a large bucket is not
    gathered in one task.
    """
    both = "size(array_intersect({0}, {1}))"
    similar = f"{both} >= {SIMILARITY} * (size({{0}}) + size({{1}}) - {both})"
    members = written(buckets.join(sets, "hash"), "paragraph-buckets")
    heads = members.groupBy("key").agg(F.max_by(F.struct("hash", "shingles"), F.struct("n", -F.col("hash"))).alias("head"),
                                       F.count("*").alias("members"))
    rows = written(members.join(heads, "key").select(
        "key", "hash", "shingles", F.col("head.hash").alias("head"), F.col("head.shingles").alias("head_set"),
        (F.col("members") > SMALL_BUCKET).alias("large")).withColumn("near", F.expr(similar.format("shingles", "head_set"))), "paragraph-heads")
    stars = rows.where("near AND hash <> head").select(F.col("hash").alias("a"), F.col("head").alias("b"))

    def pairs(left: DataFrame, far: DataFrame, on: str) -> DataFrame:
        left = left.withColumnsRenamed({"hash": "a", "shingles": "set_a", "near": "near_a"})
        far = far.where("NOT near").withColumnsRenamed({c: f"far_{c}" for c in far.columns} | {"hash": "b", "shingles": "set_b"})
        return left.join(far, F.expr(
            f"key = far_key AND {on} AND a <> b AND (near_a OR a < b) "
            f"AND size(set_a) >= {SIMILARITY} * size(set_b) AND size(set_b) >= {SIMILARITY} * size(set_a) AND "
            + similar.format("set_a", "set_b"))).select("a", "b")

    plain = ("key", "hash", "shingles", "near")
    small = rows.where("NOT large").select(*plain)
    large = rows.where("large").select(*plain, F.explode(F.expr(prefixes())).alias("p")).select(*plain, "p.*")
    rest = pairs(small, small, "true").union(pairs(large, large, "token = far_token AND own = far_other AND other = far_own"))
    return stars.union(rest).distinct()


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Passages that repeat an earlier one: ``(doc_id, first, last, n_words, class_id, kept_doc_id, kept_first, sig)``.

    Texts are cut into paragraphs; those that share a band are compared
    (equal hash of all words, or Jaccard similarity of their shingles), linked
    ones form classes, and in each class the paragraph with the smallest
    (doc_id, text hash, place) is kept. A run of other paragraphs, MIN_WORDS
    words or more, is a repeated passage; ``kept_*`` name where its first
    paragraph is kept. Null and empty texts have no paragraphs; rows with a
    null id take no part; rows that repeat an id and its text count as one
    document, other texts under the same id as documents of their own, which
    ``sig``, a hash of the text, tells apart; an empty table gives an empty
    result.
    """
    text = F.col(text_col).cast("string")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("sig"), text.alias("text")).where(
        "doc_id IS NOT NULL")
    # the two random columns side by side and no band column: that is most of what is shuffled
    keyed = counted(texts.select("doc_id", "text")).select(F.explode("keys").alias("key"), "hash", "n")
    rows = keyed.repartition("key").groupBy("key", "hash").agg(F.sum("n").alias("n"))
    shared = written(rows.withColumn("texts", F.count("*").over(Window.partitionBy("key")))
                     .where(f"texts > 1 OR (n > 1 AND key & {BAND_BITS} = 0)"), "paragraph-keys")
    wanted = checked(written(shared.select("hash").distinct(), "paragraph-hashes"))
    found = written(paragraphs(texts).join(wanted, "hash", "left_semi"), "paragraphs")
    buckets = shared.where("texts > 1").select("key", "hash", "n")
    near = checked(written(buckets.select("hash").distinct(), "paragraph-near"))
    asked = (found.join(near, "hash", "left_semi").groupBy("hash").agg(F.min(F.struct("doc_id", "sig", "idx")).alias("at"))
             .select("at.doc_id", "at.sig", "at.idx", "hash"))
    labels = components(near_links(buckets, looked_up(texts, asked)), "paragraph-classes")
    classes = checked(written(labels.withColumnRenamed("node", "hash"), "paragraph-labels"))
    classed = found.join(classes, "hash", "left").withColumn("class_id", F.coalesce("label", "hash"))
    kept = classed.groupBy("class_id").agg(F.min(F.struct("doc_id", "sig", "idx")).alias("kept"), F.count("*").alias("times")).where("times > 1")
    kept = checked(written(kept.select("class_id", "kept"), "paragraphs-kept"))
    gone = (classed.join(kept, "class_id").where("doc_id <> kept.doc_id OR sig <> kept.sig OR idx <> kept.idx")
            .select("doc_id", "sig", "idx", "n_words", "class_id", "kept")
            .repartition("doc_id", "sig").dropDuplicates(["doc_id", "sig", "idx"]))  # one exchange for this and the two groupings below
    runs = gone.withColumn("run", F.col("idx") - F.row_number().over(Window.partitionBy("doc_id", "sig").orderBy("idx")))
    first = F.min(F.struct("idx", "class_id", "kept"))
    return (runs.groupBy("doc_id", "sig", "run").agg(first.alias("f"), F.max("idx").alias("last"), F.sum("n_words").alias("n_words"))
            .where(F.col("n_words") >= MIN_WORDS)
            .select("doc_id", F.col("f.idx").alias("first"), "last", "n_words", F.col("f.class_id").alias("class_id"),
                    F.col("f.kept.doc_id").alias("kept_doc_id"), F.col("f.kept.idx").alias("kept_first"), "sig"))


def cut_out(texts: list[str], spans: list[list[dict]]) -> list[str]:
    """Texts without their repeated passages and the white space after each."""
    tool = cutter()
    h, counts = tool.words(texts)
    at, text = tool.starts(h, counts)
    begins = np.concatenate(([0], np.cumsum(counts)))
    out = []
    for row, own in enumerate(spans):
        mine = at[text == row] - begins[row]
        ends = np.append(mine[1:], counts[row])
        words = [m.span() for m in WORD.finditer(texts[row])]
        parts, done = [], 0
        for span in sorted(own, key=lambda s: s["first"]):
            lo, hi = mine[span["first"]], ends[span["last"]]
            parts.append(texts[row][done:words[lo][0]])
            done = words[hi][0] if hi < len(words) else len(texts[row])
        out.append("".join(parts) + texts[row][done:])
    return out


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with repeated passages cut out of the texts; ``n_chars``, where there, follows.

    A document nothing is left of goes; all others keep their other columns.
    Texts are told apart as in ``repeats``, so rows that share an id are each
    cut where their own text repeats.
    """
    spans = repeats(docs, id_col, text_col).groupBy(F.col("doc_id").alias("__cut_id"), F.col("sig").alias("__cut_sig")).agg(
        F.collect_list(F.struct("first", "last")).alias("__spans"))  # at most a text's paragraphs
    spans = checked(written(spans, "passages"), "__spans")

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in slices(batches, 64):
            names = batch.schema.names
            texts = batch.column(names.index(text_col)).to_pylist()
            new = cut_out(texts, batch.column(names.index("__spans")).to_pylist())
            columns = [pa.array(new, pa.string()) if n == text_col else batch.column(i) for i, n in enumerate(names[:-1])]
            yield pa.RecordBatch.from_arrays(columns, names[:-1])

    same_text = ((docs[id_col].cast("long") == F.col("__cut_id")) & (F.xxhash64(docs[text_col].cast("string")) == F.col("__cut_sig")))
    edited = docs.join(spans, same_text)
    cut = mapped(edited.select(*docs.columns, "__spans"), run, docs.schema).where(F.trim(F.col(text_col)) != "")
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length(text_col).cast(docs.schema["n_chars"].dataType))
    same = docs.join(spans.select("__cut_id", "__cut_sig"), same_text, "left_anti")
    return same.unionByName(cut)
