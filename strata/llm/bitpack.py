"""Token ids in bit-packed files: fixed width, block offsets, random access."""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from tokenizers import Tokenizer

from .common import held, holding, mapped, Memo, shared_folder, slices, written

MAGIC = b"TOKBITS1"
#: Ids in a block.
BLOCK = 8192
#: Documents whose ids are unpacked together when a file is read back.
READ_DOCS = 256
TRAILER = struct.Struct("<8sIIQQQ")


def bits_for(vocabulary: int) -> int:
    """Fewest bits that hold every id of a vocabulary of this size."""
    return max(1, (max(1, vocabulary) - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as consecutive little-endian bit fields."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    planes = (ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(planes.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, count: int) -> np.ndarray:
    """The first ``count`` ids of a packed block."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype(np.uint32)
    planes = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little", count=bits * count).reshape(count, bits)
    out = np.zeros(count, np.uint32)
    for bit in range(bits):
        out |= planes[:, bit].astype(np.uint32) << np.uint32(bit)
    return out


def opened(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """File system and path of a shared folder's address."""
    return pa.fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


class Writer:
    """Writes one file: packed blocks, then block offsets, document ids and starts, then a trailer.

    Ids are flushed block by block, so only the document index is held.
    """

    def __init__(self, stream, bits: int):
        self.stream, self.bits = stream, bits
        self.rest = np.empty(0, np.uint32)
        self.offsets, self.names, self.sizes, self.at, self.total = [], [], [], 0, 0

    def add(self, names: list[int | None], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.names += names
        self.sizes.append(sizes)
        self.total += len(ids)
        ids = np.concatenate((self.rest, ids))
        whole = len(ids) // BLOCK * BLOCK
        for at in range(0, whole, BLOCK):
            self._block(ids[at:at + BLOCK])
        self.rest = ids[whole:]

    def _block(self, ids: np.ndarray) -> None:
        data = pack(ids, self.bits)
        self.offsets.append(self.at)
        self.stream.write(data)
        self.at += len(data)

    def close(self) -> None:
        if len(self.rest):
            self._block(self.rest)
        sizes = np.concatenate(self.sizes or [np.empty(0, np.int64)]).astype(np.int64)
        known = np.array([n is not None for n in self.names], np.uint8)
        self.stream.write(np.array(self.offsets + [self.at], "<u8").tobytes())
        self.stream.write(np.array([n or 0 for n in self.names], "<i8").tobytes() + known.tobytes())
        self.stream.write(np.concatenate(([0], np.cumsum(sizes))).astype("<u8").tobytes())
        self.stream.write(TRAILER.pack(MAGIC, self.bits, BLOCK, self.total, len(self.names), self.at))


class Reader:
    """Random access to a file's documents; only the blocks a document touches are read."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        magic, self.bits, self.block, self.total, docs, at = TRAILER.unpack(self._bytes(size - TRAILER.size, TRAILER.size))
        if magic != MAGIC:
            raise ValueError("not a packed token file")
        blocks = -(-self.total // self.block)
        index = self._bytes(at, 8 * (blocks + 1) + 9 * docs + 8 * (docs + 1))
        self.offsets = np.frombuffer(index, "<u8", blocks + 1).astype(np.int64)
        self.names = np.frombuffer(index, "<i8", docs, 8 * (blocks + 1))
        self.known = np.frombuffer(index, np.uint8, docs, 8 * (blocks + 1) + 8 * docs)
        self.starts = np.frombuffer(index, "<u8", docs + 1, 8 * (blocks + 1) + 9 * docs).astype(np.int64)

    def _bytes(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def ids(self, lo: int, hi: int) -> np.ndarray:
        """Ids lo..hi of the file."""
        if hi <= lo:
            return np.empty(0, np.uint32)
        first, last = lo // self.block, (hi - 1) // self.block
        data = self._bytes(int(self.offsets[first]), int(self.offsets[last + 1] - self.offsets[first]))
        parts = []
        for b in range(first, last + 1):
            count = min(self.block, self.total - b * self.block)
            a, z = int(self.offsets[b] - self.offsets[first]), int(self.offsets[b + 1] - self.offsets[first])
            parts.append(unpack(data[a:z], self.bits, count))
        return np.concatenate(parts)[lo - first * self.block:hi - first * self.block]

    def document(self, number: int) -> np.ndarray:
        return self.ids(int(self.starts[number]), int(self.starts[number + 1]))


#: The printable stand-ins byte-level vocabularies use for bytes (fixed rule of the format).
PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
STAND_INS = {b: chr(b) for b in PLAIN} | {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in PLAIN)}
#: Letters up to here are one pre-token whatever stands around them and have no decomposed form.
LAST_SIMPLE = "\u017e"


class Words:
    """Ids of single words: plain words go straight to the tokenizer's model, others through the whole tokenizer.

    For a tokenizer that lower-cases, drops white space and splits letters
    from the rest, a word of simple letters (with one stop or comma) has only
    its own pieces; ``checked`` compares such words with the whole tokenizer
    before the short way is used at all.
    """

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.stops = {c: tokenizer.encode(c, add_special_tokens=False).ids for c in ".,"}
        self.short = self.checked()

    def checked(self) -> bool:
        trial = ["a", "The", "Été,", "straße.", "ÑANDÚ", "don", "s", "Ångström.", "naïve,", "LL"]
        try:
            return [self.simple(w) for w in trial] == self.whole(trial)
        except Exception:  # noqa: BLE001 - a vocabulary without byte stand-ins: always the whole tokenizer
            return False

    def whole(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def simple(self, word: str) -> list[int] | None:
        """Ids of a simple word, None if the word isn't one."""
        stop = self.stops.get(word[-1])
        core = word[:-1] if stop else word
        if not core.isalpha():
            return None
        if core.isascii():
            core = core.lower()
        elif max(core) > LAST_SIMPLE or "\u0130" in core:
            return None
        else:
            core = core.lower().encode().decode("latin-1").translate(STAND_INS)
        ids = [t.id for t in self.model.tokenize(core)]
        return ids + stop if stop else ids

    def __call__(self, words: list[str]) -> list[list[int]]:
        out = [self.simple(w) if self.short else None for w in words]
        rest = [i for i, ids in enumerate(out) if ids is None]
        for i, ids in zip(rest, self.whole([words[i] for i in rest])):
            out[i] = ids
        return out


def encoder(path: str) -> Memo:
    """A worker's tokenizer with its memory of words."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # the tasks are the parallelism
    return held(("bitpack", path), lambda: Memo(Words(Tokenizer.from_file(path)), limit=500_000))


def pieces(text: str) -> list[str]:
    """White-space separated parts of a text, which a white-space dropping tokenizer encodes one by one.

    Python also splits at the separators U+001C to U+001F, which the tokenizer
    keeps; a text that holds one is split at spaces alone.
    """
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return [w for w in text.split(" ") if w]
    return text.split()


def encode(texts: list[str | None], memo: Memo, end_id: int | None) -> tuple[np.ndarray, np.ndarray]:
    """All texts' ids end to end, each followed by ``end_id``, and each text's count."""
    words, counts = [], []
    for text in texts:
        own = pieces(text or "")
        words += own
        counts.append(len(own))
    ids, sizes = memo(words)
    edges = np.concatenate(([0], np.cumsum(sizes)))
    ends = np.concatenate(([0], np.cumsum(counts)))
    stops = edges[ends[1:]]
    lengths = np.diff(np.concatenate(([0], stops)))
    if end_id is None:
        return ids.astype(np.uint32), lengths
    return np.insert(ids, stops, end_id).astype(np.uint32), lengths + 1


def write_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int | None = 1,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes every text and writes packed files in ascending id order; returns the list of files.

    Rows are dealt by ranges of (id, checksum of the text) and sorted, so a
    file holds one run of the order and equal ids don't pile up. Files have
    names of their own for each attempt; the returned table ``(path, first_id,
    first_sum, n_docs, n_ids)``, written in the shared folder, names those of
    the attempts that counted.
    """
    bits = bits_for(max(Tokenizer.from_file(tokenizer_path).get_vocab_size(), (end_id or 0) + 1))

    @holding(("bitpack", tokenizer_path))
    def run(batches: Iterator[pa.RecordBatch]):
        memo, writer, first = encoder(tokenizer_path), None, None
        fs, base = opened(folder)
        path = f"{base}/{uuid.uuid4().hex}.tok"
        for batch in slices(batches):
            if writer is None:
                stream = fs.open_output_stream(path)
                writer, first = Writer(stream, bits), (batch.column(0)[0].as_py(), batch.column(2)[0].as_py())
            ids, sizes = encode(batch.column(1).to_pylist(), memo, end_id)
            writer.add(batch.column(0).to_pylist(), ids, sizes)
        if writer:
            writer.close()
            stream.close()
            yield pa.RecordBatch.from_pydict({
                "path": pa.array([path.rsplit("/", 1)[1]]), "first_id": pa.array([first[0]], pa.int64()),
                "first_sum": pa.array([first[1]], pa.int64()), "n_docs": pa.array([len(writer.names)], pa.int64()),
                "n_ids": pa.array([writer.total], pa.int64())})

    picked = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    summed = picked.withColumn("sum", F.crc32(F.col("text").cast("binary")))
    dealt = summed.repartitionByRange("id", "sum").sortWithinPartitions("id", "sum", "text")
    return written(mapped(dealt, run, "path string, first_id long, first_sum long, n_docs long, n_ids long"), "tokens-list")


def read_files(files: DataFrame, folder: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document of the listed files."""
    before = Window.orderBy(F.asc_nulls_first("first_id"), "first_sum").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("offset", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))  # one row a file

    def run(batches: Iterator[pa.RecordBatch]):
        fs, base = opened(folder)
        for batch in batches:
            for name, offset in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with fs.open_input_file(f"{base}/{name}") as source:
                    reader = Reader(source)
                    for at in range(0, len(reader.names), READ_DOCS):
                        starts = reader.starts[at:at + READ_DOCS + 1]
                        ids = reader.ids(int(starts[0]), int(starts[-1])).astype("<u4")
                        sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts - starts[0], starts[1:] - starts[0])]
                        names = pa.array(reader.names[at:at + READ_DOCS], mask=reader.known[at:at + READ_DOCS] == 0)
                        yield pa.RecordBatch.from_arrays(
                            [names, pa.array(starts[:-1] + offset), pa.array(np.diff(starts)), pa.array(sums, pa.int64())],
                            ["doc_id", "start", "n_tokens", "ids_crc32"])

    count = max(1, files.count())
    spread = placed.select("path", "offset").repartition(count, "path")
    return mapped(spread, run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer_path: str, end_id: int | None = 1, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Writes the packed files to the shared folder and returns what they hold, a row for each document.

    A null text counts as empty and gives the end id alone; rows with a null
    id come first; repeated rows are each written, in the order of their text;
    an empty table writes no file.
    """
    folder = shared_folder(docs.sparkSession, "tokens")
    opened(folder)[0].create_dir(opened(folder)[1], recursive=True)
    return read_files(write_files(docs, folder, tokenizer_path, end_id, id_col, text_col), folder)
