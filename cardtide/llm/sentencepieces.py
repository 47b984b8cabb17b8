"""SentencePiece models on the Tokenizers library: parse, rebuild, encode, decode, verify."""

from __future__ import annotations

import gc
import os
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType
from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

from cardtide.llm.common import HIDDEN, pieces, releasing

IDS, ROUND_TRIP, PARITY, DECODED = (f"{HIDDEN}{x}" for x in ("ids", "round_trip", "parity", "decoded"))

#: Default place of the public vocabulary; a parameter everywhere.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"

# Fixed values of the model format.
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
SPACE = "▁"

_GROUP = 256
_WORD = re.compile(f"{SPACE}+[^{SPACE}]*")


@dataclass(frozen=True)
class Model:
    """What a model file says about its vocabulary and normaliser."""

    pieces: list[tuple[str, float, int]]
    kind: int
    byte_fallback: bool
    unk_id: int
    unk_surface: str
    charsmap: bytes
    dummy_prefix: bool
    squeeze: bool
    escape: bool


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and raw values of one protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}[kind] if kind != 2 else varint()
        if at + size > len(data):
            raise ValueError("the model file ends within a field")
        yield key >> 3, data[at : at + size]
        at += size


def parse(data: bytes) -> Model:
    """The parts of a model that encoding needs. Absent fields take the format's defaults."""
    vocabulary = []
    trainer: dict[int, int | bytes] = {}
    normaliser: dict[int, int | bytes] = {}
    for number, value in _fields(data):
        if number == 1:
            piece = dict(_fields(value))
            score = struct.unpack("<f", piece.get(2, b"\0\0\0\0"))[0]
            vocabulary.append((piece.get(1, b"").decode("utf-8"), score, piece.get(3, NORMAL)))
        elif number == 2:
            trainer = dict(_fields(value))
        elif number == 3:
            normaliser = dict(_fields(value))
    if not vocabulary:
        raise ValueError("not a SentencePiece model: it has no pieces")
    return Model(
        pieces=vocabulary,
        kind=trainer.get(3, UNIGRAM),
        byte_fallback=bool(trainer.get(35, 0)),
        unk_id=next((i for i, (_, _, kind) in enumerate(vocabulary) if kind == UNKNOWN), 0),
        unk_surface=trainer.get(44, " ⁇ ".encode()).decode("utf-8"),
        charsmap=normaliser.get(2, b""),
        dummy_prefix=bool(normaliser.get(3, 1)),
        squeeze=bool(normaliser.get(4, 1)),
        escape=bool(normaliser.get(5, 1)),
    )


def rebuild(model: Model, memory: int = 100_000) -> Tokenizer:
    """A tokenizer that gives the ids of the model: normaliser, space marker, scores, byte fallback."""
    if model.kind not in (UNIGRAM, BPE):
        raise ValueError("only unigram and BPE models have a counterpart here")
    if not model.escape:
        raise ValueError("models that leave spaces unmarked are not supported")
    unknown = model.pieces[model.unk_id][0]
    if model.kind == BPE:
        vocabulary = {piece: i for i, (piece, _, _) in enumerate(model.pieces)}
        inner = models.BPE(
            vocabulary, _merges(model), unk_token=unknown, fuse_unk=True, byte_fallback=model.byte_fallback,
            cache_capacity=memory,
        )
    else:
        inner = models.Unigram([(p, s) for p, s, _ in model.pieces], model.unk_id, model.byte_fallback)
    out = Tokenizer(inner)
    steps = []
    if model.charsmap:
        steps.append(normalizers.Precompiled(model.charsmap))
    if model.squeeze:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex("^ | $"), "")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(SPACE))
    steps.append(normalizers.Replace(" ", SPACE))
    out.normalizer = normalizers.Sequence(steps)
    signs = [AddedToken(p, normalized=True) for p, _, kind in model.pieces if kind == USER_DEFINED]
    if signs:
        out.add_tokens(signs)
    out.decoder = decoders.Sequence(
        [
            decoders.Replace(SPACE, " "),
            *([decoders.ByteFallback()] if model.byte_fallback else []),
            decoders.Fuse(),
            *([decoders.Strip(" ", 1, 0)] if model.dummy_prefix else []),
        ]
    )
    out.encode_special_tokens = True
    return out


class Encoder:
    """Ids of texts, as the bytes of 32-bit numbers, with each word encoded once where that cannot change them.

    Where no piece has a marker behind another sign, no piece reaches from one word into the next. A word
    here is a run of markers with what follows it. New words of a batch go to the library together;
    ``memory`` bounds the number of remembered ones. With ``verify``, ids that the SentencePiece library would
    not give are noted: whole texts, or words where texts are encoded by word.
    """

    def __init__(self, data: bytes, verify: bool = False, memory: int = 300_000) -> None:
        model = parse(data)
        self.whole = rebuild(model)
        self.by_word = (
            model.dummy_prefix
            and not model.charsmap
            and not model.squeeze
            and all(kind != USER_DEFINED and SPACE not in piece.lstrip(SPACE) for piece, _, kind in model.pieces)
        )
        # Words are remembered here, so the library need not do so a second time.
        self.words = Tokenizer(rebuild(model, 0).model)
        self.words.encode_special_tokens = True
        self.memory = memory
        self.known: dict[str, bytes] = {}
        self.wrong: set[str] = set()
        self.reference = None
        if verify:
            import sentencepiece

            self.reference = sentencepiece.SentencePieceProcessor(model_proto=data)

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[bool | None]]:
        """The ids of each text, and whether they have parity (None where that is not verified)."""
        if not self.by_word:
            ids = [e.ids for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]
            same = [None] * len(texts)
            if self.reference is not None:
                same = [a == b for a, b in zip(self.reference.encode(texts, num_threads=1), ids, strict=True)]
            return [np.array(x, "<i4").tobytes() for x in ids], same
        split = [self._words(t) for t in texts]
        if len(self.known) > self.memory:
            self.known = {}
        fresh = list(set(chain.from_iterable(split)).difference(self.known))
        codes = self._fresh(fresh)
        self.known.update(zip(fresh, codes, strict=True))
        same = [None] * len(texts)
        if self.reference is not None:
            plain = [w.replace(SPACE, " ") for w in fresh]
            true = self.reference.encode(plain, num_threads=1)
            # An empty word is one marker alone, which the reference gives for no text by itself.
            right = np.fromiter(chain.from_iterable(true), "<i4").tobytes()
            ends = np.cumsum([0, *map(len, true)]) * 4
            given = zip(fresh, codes, ends[:-1].tolist(), ends[1:].tolist(), strict=True)
            self.wrong.update(w for w, ids, i, j in given if right[i:j] != ids and w)
            same = [not self.wrong or self.wrong.isdisjoint(words) for words in split]
        return [b"".join(map(self.known.__getitem__, words)) for words in split], same

    def _fresh(self, words: list[str]) -> list[bytes]:
        """The ids of words that are not remembered; many words go as one input of the library."""
        groups = [[SPACE + w for w in words[i : i + _GROUP]] for i in range(0, len(words), _GROUP)]
        found = self.words.encode_batch(groups, is_pretokenized=True, add_special_tokens=False)
        sizes = [np.bincount(e.word_ids, minlength=len(g)) for e, g in zip(found, groups, strict=True)]
        raw = np.fromiter(chain.from_iterable(e.ids for e in found), "<i4").tobytes()
        ends = np.cumsum(np.concatenate([[0], *sizes]).astype(np.int64)) * 4
        return [raw[i:j] for i, j in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def _words(self, text: str) -> list[str]:
        """The words of a text, each without its first marker."""
        if not text:
            return []
        words = text.split(" ")
        if "" in words:
            return [w[1:] for w in _WORD.findall(SPACE + text.replace(" ", SPACE))]
        return words


class Decoder:
    """Texts of ids: by a table of the pieces' bytes where texts have no other normalisation."""

    def __init__(self, data: bytes) -> None:
        model = parse(data)
        self.whole = rebuild(model)
        self.prefix = model.dummy_prefix
        self.table = None
        if model.byte_fallback:
            self.table = [_shown(model, piece, kind) for piece, _, kind in model.pieces]

    def decode(self, ids: list[list[int]]) -> list[str]:
        if self.table is None:
            return self.whole.decode_batch(ids, skip_special_tokens=False)
        look = self.table.__getitem__
        texts = [b"".join(map(look, x)).decode("utf-8", "replace") for x in ids]
        return [t[1:] if self.prefix and t[:1] == " " else t for t in texts]


def _shown(model: Model, piece: str, kind: int) -> bytes:
    if kind == BYTE:
        return bytes([int(piece[3:5], 16)])
    if kind == CONTROL:
        return b""
    return model.unk_surface.encode() if kind == UNKNOWN else piece.replace(SPACE, " ").encode()


def _merges(model: Model) -> list[tuple[str, str]]:
    """All ways to join two pieces into a third; a better score of the third comes first."""
    usable = {p: s for p, s, kind in model.pieces if kind == NORMAL}
    place = {p: i for i, (p, _, _) in enumerate(model.pieces)}
    ways = [
        (-score, place[piece[:i]], place[piece[i:]], piece[:i], piece[i:])
        for piece, score in usable.items()
        for i in range(1, len(piece))
        if piece[:i] in usable and piece[i:] in usable
    ]
    return [(left, right) for *_, left, right in sorted(ways)]


def read_model(path: str = MODEL) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def _threads(n: int) -> None:
    os.environ["TOKENIZERS_PARALLELISM"] = "true"
    os.environ["RAYON_NUM_THREADS"] = str(n)


def encoded(
    docs: DataFrame, model: bytes, text_col: str = "text", verify: bool = True, threads: int = 2, batch_bytes: int = 1 << 20
) -> DataFrame:
    """All rows and columns of ``docs`` with IDS (array of int), ROUND_TRIP and PARITY (boolean).

    Batches of about ``batch_bytes`` of text, and at least one row, are encoded by ``threads`` threads. ROUND_TRIP: the
    ids decode to the text (with byte fallback and no normalisation that fails only for a text which holds the
    marker itself). PARITY: the ids are those of the SentencePiece library, checked for every row, by word
    where texts are encoded by word; null where ``verify`` is off. A null or empty text has no ids and both flags true; repeated rows stay; an empty table
    stays empty. The model is passed as bytes, so executors need not have its file.
    """
    schema = StructType(
        [
            *docs.schema.fields,
            StructField(IDS, ArrayType(IntegerType(), False)),
            StructField(ROUND_TRIP, BooleanType()),
            StructField(PARITY, BooleanType()),
        ]
    )
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _threads(threads)
        gc.disable()  # millions of small objects without cycles are not worth going through
        encoder, decoder = Encoder(model, verify), Decoder(model)
        try:
            for batch in pieces(batches, text_col, batch_bytes):
                texts = [t or "" for t in batch.column(at).to_pylist()]
                ids, same = encoder.encode(texts)
                ends = np.cumsum([0, *map(len, ids)]) // 4
                values = np.frombuffer(b"".join(ids), "<i4")
                back = decoder.decode([values[i:j].tolist() for i, j in zip(ends[:-1], ends[1:], strict=True)])
                yield pa.RecordBatch.from_arrays(
                    [
                        *batch.columns,
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values)),
                        pa.array([a == b for a, b in zip(back, texts, strict=True)], pa.bool_()),
                        pa.array(same, pa.bool_()),
                    ],
                    schema.names,
                )
        finally:
            gc.enable()

    return docs.mapInArrow(releasing(run), schema)


def decoded(rows: DataFrame, model: bytes, ids_col: str = IDS, threads: int = 2) -> DataFrame:
    """All rows and columns with DECODED (string): the text of ``ids_col``; null ids give null."""
    schema = StructType([*rows.schema.fields, StructField(DECODED, StringType())])
    at = rows.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _threads(threads)
        decoder = Decoder(model)
        for batch in batches:
            ids = batch.column(at).to_pylist()
            texts = decoder.decode([x or [] for x in ids])
            texts = [None if x is None else t for x, t in zip(ids, texts, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], schema.names)

    return rows.mapInArrow(releasing(run), schema)
