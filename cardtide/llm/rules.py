"""Quality rules as a short-circuit cascade, ordered by measured rejection per cost."""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StringType, StructField, StructType

from cardtide.llm.common import HIDDEN, hashed_sample, releasing

KEPT, REJECTED_BY, EVALUATED = (f"{HIDDEN}{x}" for x in ("kept", "rejected_by", "evaluated"))

_SPACE = " \t\n\v\f\r"
_SYMBOLS = "#*$%&|<>"
_LETTER = re.compile(rb"[A-Za-z\x80-\xff]")


class Features:
    """What rules look at, each worked out when it is first asked for. Words are runs without ASCII white space."""

    def __init__(self, text: str | None) -> None:
        self.text = text or ""

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.encode("utf-8", "surrogatepass").split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, _SPACE))

    @cached_property
    def n_symbols(self) -> int:
        return sum(map(self.text.count, _SYMBOLS))

    @cached_property
    def lines(self) -> list[str]:
        return [line for line in self.text.split("\n") if line.strip(_SPACE)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        words = self.words
        windows = list(zip(words, words[1:], words[2:], words[3:], words[4:], strict=False))
        times = Counter(windows)
        if len(times) == len(windows):
            return 0
        covered = upto = 0
        for i, window in enumerate(windows):
            if times[window] > 1:
                covered += i + 5 - max(upto, i)
                upto = i + 5
        return covered

    @cached_property
    def n_lettered(self) -> int:
        return sum(_LETTER.search(word) is not None for word in set(self.words))


@dataclass(frozen=True)
class Rule:
    """A name, and whether a text with these features is to be rejected."""

    name: str
    rejects: Callable[[Features], bool]


def too_short(f: Features) -> bool:
    return f.n_words < 10


def too_repetitive(f: Features) -> bool:
    return 100 * f.n_repeat_words > 20 * f.n_words


#: The rules that base_failed stands for.
BASE = (Rule("few_words", too_short), Rule("repeated_windows", too_repetitive))

#: Further rules, with lenient limits: they mean text that no reader would call prose.
FURTHER = (
    Rule("symbols", lambda f: 100 * f.n_symbols > 30 * f.n_words),
    Rule("word_length", lambda f: not 2 * f.n_words <= f.word_chars <= 20 * f.n_words),
    Rule("repeated_lines", lambda f: 100 * f.n_dup_lines > 50 * len(f.lines)),
    Rule("few_letters", lambda f: 2 * f.n_lettered < len(set(f.words))),
)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def ordered(rules: Sequence[Rule], texts: Sequence[str | None], clock: Callable[[], float] = time.perf_counter) -> list[Rule]:
    """``rules`` with the highest rejection per cost on ``texts`` first, ties in the order given.

    Each rule is timed on features of its own, so that it pays for what it needs; a rule that rejects
    nothing here still counts as rejecting half a text. No texts: the order given.
    """
    if not texts:
        return list(rules)
    worth = {}
    for rule in rules:
        features = [Features(t) for t in texts]
        begin = clock()
        rejected = sum(map(rule.rejects, features))
        worth[rule.name] = (rejected + 0.5) / (len(texts) + 1) / max(clock() - begin, 1e-9)
    return sorted(rules, key=lambda rule: -worth[rule.name])


def sampled(docs: DataFrame, text_col: str, order: Column, rows: int = 400, max_bytes: int = 200_000) -> list[str | None]:
    """At most ``rows`` texts, by hash of ``order``, for timing rules; longer texts than ``max_bytes`` are left out here alone."""
    usable = docs.where(F.coalesce(F.octet_length(text_col), F.lit(0)) <= max_bytes)
    return [r[text_col] for r in hashed_sample(usable, order, "rules", rows).select(text_col).collect()]


def cascaded(
    docs: DataFrame, rules: Sequence[Rule], text_col: str = "text", counts: Sequence[str] = (), batch_rows: int = 512
) -> DataFrame:
    """All rows and columns of ``docs`` with KEPT, REJECTED_BY, EVALUATED, and the features named in ``counts``.

    A text goes through ``rules`` in the order given and no further than the first that rejects it, which REJECTED_BY
    names; EVALUATED is the number of rules looked at. Whether a text is kept does not depend on the order. Features named in
    ``counts`` are given for every row, as hidden long columns. A null text counts as empty; an empty table stays empty.
    """
    schema = StructType(
        [
            *docs.schema.fields,
            StructField(KEPT, BooleanType()),
            StructField(REJECTED_BY, StringType()),
            StructField(EVALUATED, IntegerType()),
            *(StructField(HIDDEN + c, LongType()) for c in counts),
        ]
    )
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, batch_rows):
                batch = whole.slice(begin, batch_rows)
                verdicts, found = [], []
                for text in batch.column(at):
                    features = Features(text.as_py())
                    looked, name = 0, None
                    for rule in rules:
                        looked += 1
                        if rule.rejects(features):
                            name = rule.name
                            break
                    verdicts.append((name is None, name, looked))
                    found.append([getattr(features, c) for c in counts])
                kept, names, looked = zip(*verdicts, strict=True)
                more = [pa.array(c, pa.int64()) for c in zip(*found, strict=True)] if counts else []
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(kept, pa.bool_()), pa.array(names, pa.string()), pa.array(looked, pa.int32()), *more],
                    schema.names,
                )

    return docs.mapInArrow(releasing(run), schema)
