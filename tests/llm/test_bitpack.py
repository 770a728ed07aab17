import io
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strata.llm import bitpack

PATH = public_tokenizers.path("word_bpe_49k.json")


def brute(rows, end_id):
    tokenizer = Tokenizer.from_file(PATH)
    out, at = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, zlib.crc32((r[1] or "").encode()))):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end_id]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def got(frame):
    return sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in frame.collect()), key=lambda r: r[1])


def test_documents_and_odd_rows(docs, odd, nothing):
    for frame in (docs, odd):
        assert got(bitpack.round_trip(frame, PATH)) == brute([(r.doc_id, r.text) for r in frame.collect()], 1)
    assert bitpack.round_trip(nothing, PATH).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=300))
def test_pack_unpack(bits, ids):
    ids = np.array(ids, np.uint64) & np.uint64((1 << bits) - 1)
    data = bitpack.pack(ids, bits)
    assert len(data) == -(-bits * len(ids) // 8)
    assert (bitpack.unpack(data, bits, len(ids)) == ids).all()


@pytest.mark.parametrize("bits", [13, 16, 17])
def test_random_access(bits):
    rng = np.random.default_rng(0)
    sizes = np.array([0, 3, bitpack.BLOCK, 0, 5 * bitpack.BLOCK + 7, 1])
    ids = rng.integers(0, 1 << bits, sizes.sum()).astype(np.uint32)
    out = io.BytesIO()
    writer = bitpack.Writer(out, bits)
    writer.add([5, 6, None], ids[:sizes[:3].sum()], sizes[:3])
    writer.add([7, 8, 9], ids[sizes[:3].sum():], sizes[3:])
    writer.close()
    reader = bitpack.Reader(pa.BufferReader(out.getvalue()))
    edges = np.concatenate(([0], np.cumsum(sizes)))
    for i in (4, 0, 2, 5, 1, 3):
        assert (reader.document(i) == ids[edges[i]:edges[i + 1]]).all()
    assert reader.known.tolist() == [1, 1, 0, 1, 1, 1]


def test_bits_for():
    assert [bitpack.bits_for(n) for n in (0, 1, 2, 3, 256, 257, 49408)] == [1, 1, 1, 2, 8, 9, 16]
