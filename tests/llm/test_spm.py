import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as proto

from strata.llm import spm

PATH = public_tokenizers.path("piece_bpe_32k.model")


def check(frame, library):
    rows = spm.encoded(frame, PATH).collect()
    texts = {(r.doc_id, r.text) for r in frame.collect()}
    want = sorted((str(i), library.encode(t or "")) for i, t in texts)
    assert sorted({(str(r.doc_id), tuple(r.ids)) for r in rows}) == sorted({(i, tuple(x)) for i, x in want})
    assert all(r.parity and r.round_trip and r.n_tokens == len(r.ids) for r in rows)
    assert len(rows) == frame.count()


def test_documents_and_odd_rows(docs, odd, nothing):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    check(docs, library)
    check(odd, library)
    assert spm.encoded(nothing, PATH).count() == 0


def test_decoding_gives_the_texts_back(docs):
    back = {r.doc_id: r.text for r in spm.decoded(spm.encoded(docs, PATH), PATH).collect()}
    assert back == {r.doc_id: r.text or "" for r in docs.collect()}


def unigram(byte_fallback):
    """A model written out by hand: no training."""
    model = proto.ModelProto()
    model.trainer_spec.model_type = spm.UNIGRAM
    model.trainer_spec.byte_fallback = byte_fallback
    model.normalizer_spec.name = "identity"
    model.normalizer_spec.add_dummy_prefix = True
    model.normalizer_spec.remove_extra_whitespaces = True
    listed = [("<unk>", 0.0, spm.UNKNOWN), ("<s>", 0.0, spm.CONTROL), ("</s>", 0.0, spm.CONTROL)]
    if byte_fallback:
        listed += [(f"<0x{b:02X}>", 0.0, spm.BYTE) for b in range(256)]
    listed += [(p, s, spm.NORMAL) for p, s in (
        ("▁", -2.0), ("▁the", -2.5), ("▁th", -3.5), ("e", -3.1), ("re", -3.3), ("▁cat", -4.2), ("s", -3.0), ("a", -3.9),
        ("t", -3.7), ("c", -4.4), ("h", -4.6), ("at", -3.8), ("▁a", -3.2), ("ta", -5.0))]
    for piece, score, kind in listed:
        model.pieces.add(piece=piece, score=score, type=kind)
    return model.SerializeToString()


@pytest.mark.parametrize("byte_fallback", [True, False])
def test_unigram_models(byte_fallback):
    data = unigram(byte_fallback)
    tool, library = spm.Codec(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    texts = ["the cats there", "  a  catch at  the ", "", "hat"] + ["thé cät"] * byte_fallback
    ids, sizes, same = tool.encode(texts)
    assert all(same)
    at = 0
    for text, size in zip(texts, sizes):
        assert ids[at:at + size].tolist() == library.encode(text)
        at += size
    assert tool.decode(ids, sizes) == [tool.settled(t) for t in texts]
