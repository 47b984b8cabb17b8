"""Token counts of whole texts; huge texts are encoded in overlapping chunks that are brought back into step."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType
from tokenizers import Encoding, Tokenizer

from cardtide.llm.common import HIDDEN, packed_text, pieces, releasing

N_BYTES, N_TOKENS = f"{HIDDEN}n_bytes", f"{HIDDEN}n_tokens"

#: Chunks of a huge text that are encoded at a time.
_GROUP = 16


def read_tokenizer(name: str = "byte_bpe_50k.json") -> str:
    """A public tokenizer, as text that travels to the executors."""
    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


@dataclass(frozen=True)
class _Chunk:
    """The tokens of text[begin:end]: ids, places where they start, and the places where the scan of words stood."""

    begin: int
    end: int
    ids: list[int]
    starts: np.ndarray
    stops: np.ndarray

    @classmethod
    def of(cls, encoding: Encoding, begin: int, end: int) -> _Chunk:
        starts = np.array([i for i, _ in encoding.offsets], np.int64) + begin
        words = np.array([-1 if w is None else w for w in encoding.word_ids], np.int64)
        first = np.concatenate([[True], words[1:] != words[:-1]]) if len(words) else np.zeros(0, bool)
        return cls(begin, end, encoding.ids, starts, starts[first])

    def between(self, begin: int, end: int | None) -> list[int]:
        """Ids of the tokens that start from ``begin`` on and before ``end``."""
        i = int(np.searchsorted(self.starts, begin))
        return self.ids[i:] if end is None else self.ids[i : int(np.searchsorted(self.starts, end))]


class Resync:
    """A byte-level BPE tokenizer whose words are found by one scan from left to right.

    Such a scan goes on from a place by what follows it alone. If a chunk's scan stands at a place where the scan of
    the whole text stands too, both agree from there on, up to where the chunk's end comes into sight. So a place is
    stable if both the chunk before, from a stable place of its own and away from its end, and the chunk after stop
    there: the tokens before it are taken from the one and those behind it from the other. Added tokens are matched
    before the scan; a place in one of them is no stop of a chunk that sees the whole of it.
    """

    def __init__(self, tokenizer: str, chunk: int = 1 << 15, overlap: int = 256, memory: int = 1 << 19) -> None:
        told = json.loads(tokenizer)
        scan = told.get("pre_tokenizer") or {}
        plain = scan.get("type") == "ByteLevel" and scan.get("use_regex", True) and not scan.get("add_prefix_space")
        added = told.get("added_tokens") or []
        if not plain or told.get("normalizer") or any(a["lstrip"] or a["rstrip"] or a["single_word"] for a in added):
            raise ValueError("only byte-level tokenizers without a normaliser have places that are proven stable")
        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # What the scan may look at behind a place: white space and one more, a contraction, or an added token.
        self.sight = 4 + max((len(a["content"]) for a in added), default=0)
        # No segment begins with a byte that an added token holds, so none of those is cut.
        self.free = np.ones(256, bool)
        self.free[np.frombuffer("".join(a["content"] for a in added).encode(), np.uint8)] = False
        self.chunk, self.overlap = max(1, chunk), max(1, overlap)
        self.memory = memory
        self.known: dict[bytes, int] = {}

    def _encoded(self, texts: list[str]) -> list[Encoding]:
        return self.tokenizer.encode_batch(texts, add_special_tokens=False)

    def chunks(self, text: str) -> Iterator[_Chunk]:
        begins = range(0, len(text), self.chunk)
        for at in range(0, len(begins), _GROUP):
            spans = [(i, min(len(text), i + self.chunk + self.overlap)) for i in begins[at : at + _GROUP]]
            for (i, j), encoding in zip(spans, self._encoded([text[i:j] for i, j in spans]), strict=True):
                yield _Chunk.of(encoding, i, j)

    def spliced(self, text: str) -> Iterator[list[int]]:
        """The ids of the whole text, part by part."""
        left, since = None, 0
        for right in self.chunks(text):
            if left is None:
                left = right
                continue
            while left.end < right.end:
                at = self._stable(left, since, right)
                if at is not None:
                    yield left.between(since, at)
                    left, since = right, at
                    break
                # Out of step over the whole overlap: twice the text, from the last stable place on.
                end = min(len(text), since + 2 * (left.end - since))
                left = _Chunk.of(self._encoded([text[since:end]])[0], since, end)
        if left is not None:
            yield left.between(since, None)

    def _stable(self, left: _Chunk, since: int, right: _Chunk) -> int | None:
        """The last place where both scans stop, if there is one."""
        ours = left.stops[(left.stops >= max(since, right.begin)) & (left.stops <= left.end - self.sight)]
        both = np.intersect1d(ours, right.stops)
        return int(both[-1]) if len(both) else None

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of each text. Bytes that are not UTF-8 count as U+FFFD."""
        out = np.zeros(len(offsets) - 1, np.int64)
        sizes = np.diff(offsets)
        huge = sizes > self.chunk
        for i in np.flatnonzero(huge):
            text = data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace")
            out[i] = sum(map(len, self.spliced(text)))
        small = np.flatnonzero(~huge & (sizes > 0))
        if not len(small):
            return out
        begins = segment_begins(data, offsets, self.free)
        edges = np.searchsorted(begins, offsets)
        wanted = ~np.repeat(huge, np.diff(edges))
        total = np.zeros(len(begins) + 1, np.int64)
        np.cumsum(self._segments(data, begins, wanted), out=total[1:])
        out[small] = (total[edges[1:]] - total[edges[:-1]])[small]
        return out

    def _segments(self, data: np.ndarray, begins: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Tokens of the wanted segments, each different one encoded once; 0 for the others."""
        ends = np.append(begins[1:], len(data))[wanted]
        picked = begins[wanted]
        # Arrow tells equal segments by their bytes.
        body = data if wanted.all() else data[np.repeat(wanted, np.diff(np.append(begins, len(data))))]
        places = np.concatenate([[0], np.cumsum(ends - picked)])
        column = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(picked), [None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(body))]
        ).dictionary_encode()
        different = column.dictionary.to_pylist()
        new = [s for s in different if s not in self.known]
        if len(self.known) + len(new) > self.memory:
            self.known.clear()
            new = different
        for at in range(0, len(new), 4096):
            some = new[at : at + 4096]
            found = self.tokenizer.encode_batch_fast([s.decode("utf-8", "replace") for s in some], add_special_tokens=False)
            self.known.update(zip(some, map(len, found), strict=True))
        out = np.zeros(len(begins), np.int64)
        out[wanted] = np.array([self.known[s] for s in different], np.int64)[column.indices.to_numpy()]
        return out


def segment_begins(data: np.ndarray, offsets: np.ndarray, free: np.ndarray) -> np.ndarray:
    """Places at which a text, or a segment of it, begins, where its first byte (or the line end before it) is ``free``.

    These are places where the scan of words stops whatever is around: before a space behind a visible ASCII
    character, before an ASCII character behind an ASCII letter unless it is a letter too, and between a line end,
    alone behind a visible character, and a letter. What a segment ends in has the same words with the text's end
    behind it.
    """
    begin = np.zeros(len(data), bool)
    visible = (data > 32) & (data < 127)
    letter = ((data | 32) >= 97) & ((data | 32) <= 122)
    begin[1:] = ((data[1:] == 32) & visible[:-1] | (data[1:] < 128) & ~letter[1:] & letter[:-1]) & free[data[1:]]
    if free[10]:
        begin[2:] |= letter[2:] & (data[1:-1] == 10) & visible[:-2]
    begin[offsets[:-1][np.diff(offsets) > 0]] = True
    return np.flatnonzero(begin)


def token_counts(
    docs: DataFrame,
    tokenizer: str,
    text_col: str = "text",
    chunk: int = 1 << 15,
    overlap: int = 256,
    threads: int = 2,
    batch_bytes: int = 1 << 22,
) -> DataFrame:
    """All rows and columns of ``docs`` with N_BYTES (of UTF-8) and N_TOKENS, both long.

    The count is that of the library over the whole text, without special tokens being added; their strings in a text
    are treated as the tokenizer says. Texts of over ``chunk`` bytes go through chunks of so many characters and
    ``overlap`` more, others through their segments, of which each different one is encoded once as long as it is
    remembered. What a task holds at a time is a batch of about ``batch_bytes`` and at least one row, and the tokens
    of a few chunks; where a run of one kind of characters is longer than an overlap, the chunk grows as far as that
    run. A null text counts as empty, an empty one has no tokens; repeated rows stay; an empty table stays empty.
    """
    schema = StructType([*docs.schema.fields, StructField(N_BYTES, LongType()), StructField(N_TOKENS, LongType())])
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "true"
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        counter = None
        for batch in pieces(batches, text_col, batch_bytes):
            counter = counter or Resync(tokenizer, chunk, overlap)
            data, offsets = packed_text(batch.column(at))
            found = counter.counts(data, offsets)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.diff(offsets)), pa.array(found)], schema.names)

    return docs.mapInArrow(releasing(run), schema)
