from __future__ import annotations

import struct
import zlib

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from cardtide.llm.sentencepieces import DECODED, IDS, PARITY, ROUND_TRIP, Decoder, Encoder, decoded, encoded, parse, read_model, rebuild
from tests.llm.helpers import messy_docs, messy_texts, prose

MODEL = read_model()
REFERENCE = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
ENCODER = Encoder(MODEL, verify=True, memory=50)
ODD = ["  a  b ", "\n\n x\t y", "日本語 テスト 🎉🎉 ▁ a▁b", "<s> </s> <unk> <0x41>", "\x00\x01 z", " leading", "trailing  ", " ", "▁", "aba" * 50]


def _ids(codes: list[bytes]) -> list[list[int]]:
    return [np.frombuffer(c, "<i4").tolist() for c in codes]


def test_parse_agrees_with_the_library():
    model = parse(MODEL)
    assert len(model.pieces) == REFERENCE.get_piece_size()
    assert [p for p, _, _ in model.pieces[:500]] == [REFERENCE.id_to_piece(i) for i in range(500)]
    assert [s for _, s, _ in model.pieces[:500]] == [REFERENCE.get_score(i) for i in range(500)]
    assert model.unk_id == REFERENCE.unk_id()


def test_parity_on_whole_texts():
    texts = [t or "" for t in messy_texts()] + ODD
    expected = REFERENCE.encode(texts)
    codes, same = Encoder(MODEL, verify=True).encode(texts)
    assert _ids(codes) == expected and all(same)
    assert [e.ids for e in rebuild(parse(MODEL)).encode_batch(texts, add_special_tokens=False)] == expected
    assert Decoder(MODEL).decode(expected) == REFERENCE.decode(expected)
    assert rebuild(parse(MODEL)).decode_batch(expected, skip_special_tokens=False) == REFERENCE.decode(expected)


@given(st.lists(st.text(max_size=40), min_size=1, max_size=5))
@settings(max_examples=200, deadline=None)
def test_any_text_has_parity_and_comes_back(texts):
    encoder = ENCODER
    codes, same = encoder.encode(texts)
    assert _ids(codes) == REFERENCE.encode(texts) and all(same)
    plain = [t for t in texts if "▁" not in t]
    assert Decoder(MODEL).decode(_ids(encoder.encode(plain)[0])) == plain


def _varint(n: int) -> bytes:
    return bytes([n & 127 | 128]) + _varint(n >> 7) if n > 127 else bytes([n])


def _part(number: int, value: int | bytes) -> bytes:
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    return _varint(number << 3 | 2) + _varint(len(value)) + value


def _unigram(byte_fallback: bool, prefix: bool, squeeze: bool) -> bytes:
    """A model file written by hand for the other kind of model, with made-up scores."""
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    pieces += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)] if byte_fallback else []
    found = sorted({w[i:j] for w in (" " + prose(3, 200)).replace(" ", " ▁").split(" ") for i in range(len(w)) for j in range(i + 1, min(len(w), i + 4) + 1)})
    pieces += [(p, -3.0 - hash_of(p) / 2**29, 1) for p in found]
    out = b"".join(_part(1, _part(1, p.encode()) + b"\x15" + struct.pack("<f", s) + _part(3, k)) for p, s, k in pieces)
    out += _part(2, _part(3, 1) + _part(35, int(byte_fallback)))
    return out + _part(3, _part(1, b"identity") + _part(3, int(prefix)) + _part(4, int(squeeze)) + _part(5, 1))


def hash_of(text: str) -> int:
    return zlib.crc32(text.encode())


@pytest.mark.parametrize("byte_fallback", [True, False])
@pytest.mark.parametrize("prefix", [True, False])
@pytest.mark.parametrize("squeeze", [True, False])
def test_unigram_models(byte_fallback, prefix, squeeze):
    model = _unigram(byte_fallback, prefix, squeeze)
    reference = sentencepiece.SentencePieceProcessor(model_proto=model)
    texts = [prose(i, 60) for i in range(20)] + ["", "a  b", "unseen Q 🎉", "  lead"]
    codes, same = Encoder(model, verify=True).encode(texts)
    assert all(same) and _ids(codes) == reference.encode(texts)


def test_rows(spark):
    docs = messy_docs(spark)
    rows = decoded(encoded(docs, MODEL, batch_bytes=500), MODEL).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r[IDS] == REFERENCE.encode(r["text"] or "") and r[ROUND_TRIP] and r[PARITY]
        assert r[DECODED] == (r["text"] or "") and r["_part"] == 7
    assert encoded(messy_docs(spark, []), MODEL).count() == 0
    assert [r[PARITY] for r in encoded(docs, MODEL, verify=False).collect()] == [None] * len(rows)
    nothing = spark.createDataFrame([(1, None)], "i int, ids array<int>")
    assert decoded(nothing, MODEL, "ids").first()[DECODED] is None


@pytest.mark.parametrize("data", [b"", b"\x0a\x7f"])
def test_bad_models_are_errors(data):
    with pytest.raises(ValueError):
        parse(data)
