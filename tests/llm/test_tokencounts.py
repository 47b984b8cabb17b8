from __future__ import annotations

import json

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cardtide.llm.common import packed_text
from cardtide.llm.queries import op11_token_counts
from cardtide.llm.tokencounts import N_BYTES, N_TOKENS, Resync, read_tokenizer, token_counts
from tests.conftest import TESTDATA
from tests.llm.helpers import messy_docs, messy_texts, prose

JSON = read_tokenizer()
LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
END = "<|endoftext|>"
ODD = [
    " ", "  x", "a  b", "a \n b", "don't we're I'll 'r 's", END, f"a{END}b {END}{END} c", f"<|endof {END[:-1]} x", "x" * 5000, " " * 5000 + "x",
    "1234 567  ", "é è　ü   b", "🎉🎉 🎉", "日本語 " * 700, "\x00 \x01", "<|" * 900, ("ab'" * 30 + " " * 40 + END) * 40, "\r\n" * 700,
]


def whole(text: str | None) -> list[int]:
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("chunk,overlap", [(1, 1), (7, 3), (40, 20), (64, 64), (500, 30), (32768, 256)])
def test_spliced_ids_are_those_of_the_whole_text(chunk, overlap):
    resync = Resync(JSON, chunk, overlap)
    for text in [t or "" for t in messy_texts() if len(t or "") < 20_000] + ODD:
        if len(text) // chunk > 400:
            text = text[: 400 * chunk]
        assert [i for part in resync.spliced(text) for i in part] == whole(text), text[:50]


def test_one_very_long_text():
    text = prose(9, 20_000) + END + "a" * 80_000 + prose(10, 20_000)
    resync = Resync(JSON)
    assert [i for part in resync.spliced(text) for i in part] == whole(text)
    widest = max(c.end - c.begin for c in resync.chunks(text))
    assert widest <= (1 << 15) + 256


def test_chunks_out_of_step_are_widened():
    """No common place in any overlap of a run of one kind, yet the same ids."""
    resync = Resync(JSON, 32, 16)
    text = "b " + "a" * 3000 + " c"
    assert all(resync._stable(a, 0, b) is None for a, b in zip(*[list(resync.chunks("a" * 300))[i:] for i in (0, 1)]) if a.end < 300)
    assert [i for part in resync.spliced(text) for i in part] == whole(text)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "Ab", " ", "  ", "\n", "'", "'re", "7", "é", "日", "🎉", "<|", END, " ", ".", "　", "'l"]), max_size=80), st.integers(1, 40), st.integers(1, 30))
def test_any_text(parts, chunk, overlap):
    text = "".join(parts)
    resync = Resync(JSON, chunk, overlap)
    assert [i for part in resync.spliced(text) for i in part] == whole(text)
    data, offsets = packed_text(pa.array([text, None, text]))
    for sized in (Resync(JSON, 10**6, memory=3), resync):
        assert sized.counts(data, offsets).tolist() == [len(whole(text)), 0, len(whole(text))]


def test_rows(spark):
    docs = messy_docs(spark, [*messy_texts(), *ODD])
    found = token_counts(docs, JSON, chunk=200, overlap=20).collect()
    assert len(found) == docs.count()
    for r in found:
        assert r[N_BYTES] == len((r["text"] or "").encode()) and r[N_TOKENS] == len(whole(r["text"])), r["text"]
    assert token_counts(messy_docs(spark, []), JSON).count() == 0


def test_query(spark):
    """The registered query against the library over whole texts."""
    sf = f"{TESTDATA}/sf0.01"
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    rows = op11_token_counts(spark, sf)
    assert rows.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    found = rows.collect()
    assert len(found) == len(texts)
    true = dict(zip(texts, map(len, LIBRARY.encode_batch_fast([t or "" for t in texts.values()], add_special_tokens=False)), strict=True))
    for r in found:
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(texts[r["doc_id"]].encode()), true[r["doc_id"]], true[r["doc_id"]] > 512)


def test_other_tokenizers_are_refused():
    told = json.loads(JSON)
    told["normalizer"] = {"type": "NFC"}
    with pytest.raises(ValueError, match="proven stable"):
        Resync(json.dumps(told))
    assert np.isfinite(Resync(JSON).sight)
