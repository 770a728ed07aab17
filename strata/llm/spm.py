"""SentencePiece models rebuilt on the tokenizers library: encoding, decoding, parity."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from sentencepiece import sentencepiece_model_pb2 as proto
from tokenizers import Tokenizer, decoders, models, normalizers

from .common import held, holding, mapped, Memo, slices

SPACE = "▁"
#: Piece types and model types of the protobuf (fixed values of the format).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
#: Threads of a worker's batch encoder.
THREADS = 2
#: Texts, and bytes of them, that a worker encodes at once: it holds their runs as Python strings.
ROWS, SIZE = 64, 128 << 10


def parse(data: bytes) -> proto.ModelProto:
    model = proto.ModelProto()
    model.ParseFromString(data)
    return model


def merges(scores: dict[str, float]) -> list[tuple[str, str]]:
    """Every way to join two pieces into a third, best-scored result first."""
    found = []
    for piece, score in scores.items():
        found += [(-score, piece[:i], piece[i:]) for i in range(1, len(piece))
                  if piece[:i] in scores and piece[i:] in scores]
    found.sort(key=lambda f: f[0])
    return [(a, b) for _, a, b in found]


def rebuild(model: proto.ModelProto) -> Tokenizer:
    """The model as a tokenizer: character map, space marker, scores or merges, byte fallback.

    The marker in front of the text is added by the caller (``Codec``), which
    encodes marked runs one by one.
    """
    kind = model.trainer_spec.model_type
    if kind == UNIGRAM:
        core = models.Unigram([(p.piece, p.score) for p in model.pieces],
                              next((i for i, p in enumerate(model.pieces) if p.type == UNKNOWN), None),
                              byte_fallback=model.trainer_spec.byte_fallback)
    elif kind == BPE:
        vocabulary = {p.piece: i for i, p in enumerate(model.pieces)}
        usable = {p.piece: p.score for p in model.pieces if p.type in (NORMAL, USER_DEFINED)}
        unknown = next((p.piece for p in model.pieces if p.type == UNKNOWN), None)
        core = models.BPE(vocab=vocabulary, merges=merges(usable), unk_token=unknown, fuse_unk=True,
                          byte_fallback=model.trainer_spec.byte_fallback)
    else:
        raise ValueError(f"model type {kind} is neither unigram nor BPE")
    tokenizer = Tokenizer(core)
    steps = []
    if model.normalizer_spec.precompiled_charsmap:
        steps.append(normalizers.Precompiled(model.normalizer_spec.precompiled_charsmap))
    steps.append(normalizers.Replace(" ", SPACE))
    tokenizer.normalizer = normalizers.Sequence(steps)
    tokenizer.decoder = decoders.Sequence([decoders.Replace(SPACE, " "), decoders.ByteFallback(), decoders.Fuse()])
    return tokenizer


class Codec:
    """Encodes and decodes texts with a rebuilt model, and checks it against the sentencepiece library.

    When no piece joins another character to a following space marker, runs
    that begin at a marker are encoded independently of each other; then each
    distinct run is encoded once and remembered, and compared there with the
    library's own ids, which is parity for every text made of such runs.
    Models without that property, or with a character map, are encoded text by
    text and compared so.
    """

    def __init__(self, data: bytes):
        os.environ.setdefault("RAYON_NUM_THREADS", str(THREADS))
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
        self.model = parse(data)
        self.tokenizer = rebuild(self.model)
        self.library = SentencePieceProcessor(model_proto=data)
        spec = self.model.normalizer_spec
        self.prefix, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.by_run = (self.prefix and not spec.precompiled_charsmap
                       and not self.model.trainer_spec.treat_whitespace_as_suffix
                       and not any(SPACE in p.piece.lstrip(SPACE) for p in self.model.pieces))
        self.differ: set[str] = set()
        self.memo = Memo(self._encode)  # forgets together with ``differ``, see encode()
        self.octets = [self._octets(p) for p in self.model.pieces]
        width = max(map(len, self.octets), default=1)
        self.lengths = np.array([len(o) for o in self.octets], np.int64)
        self.table = np.zeros((len(self.octets), max(1, width)), np.uint8)
        for i, o in enumerate(self.octets):
            self.table[i, :len(o)] = np.frombuffer(o, np.uint8)

    @staticmethod
    def _octets(piece) -> bytes:
        if piece.type == BYTE:
            return bytes([int(piece.piece[1:-1], 16)])
        if piece.type in (CONTROL, UNUSED):
            return b""
        return " ⁇ ".encode() if piece.type == UNKNOWN else piece.piece.replace(SPACE, " ").encode()

    def _encode(self, runs: list[str]) -> list[list[int]]:
        """Ids of new runs (or texts), encoded as a multithreaded batch and compared with the library."""
        mark = " " if self.prefix else ""
        mine = [e.ids for e in self.tokenizer.encode_batch_fast([mark + r for r in runs], add_special_tokens=False)]
        for run, a, b in zip(runs, mine, self.library.encode(runs, num_threads=1)):
            if a != b and run:  # the library gives an empty text no marker; a run is never a whole empty text
                self.differ.add(run)
        return mine

    def runs(self, text: str) -> list[str]:
        """A text cut before every run of spaces, less the first space (the prefix gives it back)."""
        text = text.replace(SPACE, " ")
        if self.squeeze:
            text = re.sub(" +", " ", text).strip(" ")
        if not text:
            return []
        if not self.by_run:
            return [text]
        if "  " in text or text[0] == " " or text[-1] == " ":
            return [r[1:] for r in re.findall(" +[^ ]*", " " + text)]
        return text.split(" ")

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[bool]]:
        """All ids end to end, each text's count, and whether each text's ids are the library's."""
        parts = [self.runs(t or "") for t in texts]
        counts = np.array([len(p) for p in parts], np.int64)
        if len(self.differ) > 100_000:  # what the memory holds and what of it differs go together
            self.memo.clear()
            self.differ.clear()
        ids, sizes = self.memo([r for p in parts for r in p])
        edges = np.concatenate(([0], np.cumsum(sizes)))
        stops = edges[np.cumsum(counts)] if len(counts) else edges[:0]
        same = [not self.differ or self.differ.isdisjoint(p) for p in parts]
        return ids, np.diff(np.concatenate(([0], stops))), same

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[str]:
        """Texts of ids laid end to end; the prefix marker's space is taken off."""
        lengths = self.lengths[ids]
        rows = self.table[ids]
        flat = rows[np.arange(rows.shape[1])[None, :] < lengths[:, None]].tobytes()
        ends = np.concatenate(([0], np.cumsum(lengths)))[np.cumsum(sizes)] if len(sizes) else []
        out, at = [], 0
        for end in ends:
            part = flat[at:end]
            out.append((part[1:] if self.prefix and part[:1] == b" " else part).decode("utf-8", "replace"))
            at = end
        return out

    def settled(self, text: str) -> str:
        """What a text decodes to when nothing is unknown to the model."""
        text = text.replace(SPACE, " ")
        return re.sub(" +", " ", text).strip(" ") if self.squeeze else text


def codec(path: str) -> Codec:
    def load() -> Codec:
        with open(path, "rb") as source:
            return Codec(source.read())

    return held(("sentencepiece", path), load)


def encoded(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, ids, n_tokens, parity, round_trip)`` of every row.

    ``parity``: the ids are those the sentencepiece library gives.
    ``round_trip``: decoding them gives the text back (after the model's own
    white-space rules). A null or empty text has no ids; ids may be null or
    repeat, each row is returned; an empty table gives an empty result.
    ``model_path`` names a file every executor has.
    """
    @holding(("sentencepiece", model_path))
    def run(batches: Iterator[pa.RecordBatch]):
        tool = codec(model_path)
        for batch in slices(batches, ROWS, SIZE):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            ids, sizes, same = tool.encode(texts)
            back = tool.decode(ids, sizes)
            edges = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(edges, pa.array(ids, pa.int32())), pa.array(sizes, pa.int64()),
                 pa.array(same), pa.array([tool.settled(t) == b for t, b in zip(texts, back)])],
                ["doc_id", "ids", "n_tokens", "parity", "round_trip"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return mapped(picked, run, "doc_id long, ids array<int>, n_tokens long, parity boolean, round_trip boolean")


def decoded(tokens: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``(doc_id, text)`` of every row of ids; null ids give an empty text."""
    @holding(("sentencepiece", model_path))
    def run(batches: Iterator[pa.RecordBatch]):
        tool = codec(model_path)
        for batch in slices(batches, ROWS, SIZE):
            lists = [np.array(i or [], np.int64) for i in batch.column(1).to_pylist()]
            texts = tool.decode(np.concatenate(lists), np.array([len(i) for i in lists], np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    picked = tokens.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return mapped(picked, run, "doc_id long, text string")
