"""License scans with ordered signature rules.

Hundreds of hand-written patterns (``license_rules``) run over a text's words,
lower-cased and joined by one space, so punctuation, line breaks and case never
hide a phrase.  A keyword prefilter gates them: the words of a text are looked
up in the set of all keywords once, and only rules whose keyword is there are
tried (most texts hold none).  Detections are word intervals; rules are ordered
by priority, and a detection that lies inside the interval of one that comes
before it is suppressed, so a full licence text reports its licence and not
every name inside it.  Partly overlapping detections both stay.

Texts are read whole, one at a time; a task holds one Arrow batch and the
words of one text.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureflow.llm.license_rules import KINDS, Rule, default_rules
from featureflow.llm.words import chunks

SCHEMA = ("id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
          "labels array<string>, score double, "
          "detections array<struct<label:string,kind:string,rule:int,first_word:long,last_word:long>>")

# bytes of words: ASCII letters (lower-cased) and digits, and every byte of a non-ASCII character
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes) -> list[bytes]:
    """Words of a UTF-8 text, A-Z lower-cased."""
    return text.translate(_WORD_BYTES).split()


class Gate:
    """Rules by keyword: which rules a text's words let through, in rule order."""

    def __init__(self, rules: list[Rule]):
        self.by_word: dict[bytes, list[Rule]] = defaultdict(list)
        for rule in rules:
            for word in rule.keywords:
                self.by_word[word].append(rule)
        self.words = frozenset(self.by_word)

    def __call__(self, words: list[bytes]) -> list[Rule]:
        found = self.words.intersection(words)
        return sorted({rule.order: rule for word in found for rule in self.by_word[word]}.values())


def detect(words: list[bytes], rules: list[Rule]) -> list[tuple[Rule, int, int]]:
    """(rule, first word, last word) of every place where a rule's pattern matches.

    Matches of one rule do not overlap each other; the base phrases cannot
    overlap themselves, so all their places are found.
    """
    text = b" ".join(words)
    spaces = np.flatnonzero(np.frombuffer(text, np.uint8) == 32) if rules else None
    out = []
    for rule in rules:
        spans = [m.span() for m in rule.pattern.finditer(text)]
        if spans:
            at = np.searchsorted(spaces, np.array(spans))
            out += [(rule, int(a), int(b)) for a, b in at]
    return out


class _Reach:
    """The furthest end of the intervals added so far that start at or before a place."""

    def __init__(self, starts: list[int]):
        self.starts = sorted(set(starts))
        self.best = [-1] * (len(self.starts) + 1)

    def add(self, start: int, end: int) -> None:
        i = bisect_right(self.starts, start)
        while i < len(self.best):
            self.best[i] = max(self.best[i], end)
            i += i & -i

    def end(self, start: int) -> int:
        i, out = bisect_right(self.starts, start), -1
        while i:
            out = max(out, self.best[i])
            i -= i & -i
        return out


def resolve(found: list[tuple[Rule, int, int]]) -> list[tuple[Rule, int, int]]:
    """Detections that are not inside one that comes before them, by first word.

    Order: priority of the rule's kind, then the longer interval, then the
    earlier rule, then the earlier place.
    """
    reach = _Reach([a for _, a, _ in found])
    kept = []
    for rule, a, b in sorted(found, key=lambda d: (d[0].priority, d[1] - d[2], d[0].order, d[1])):
        if reach.end(a) < b:
            kept.append((rule, a, b))
            reach.add(a, b)
    return sorted(kept, key=lambda d: (d[1], -d[2], d[0].order))


def _row(text: bytes, gate: Gate) -> tuple:
    words = words_of(text)
    rules = gate(words)
    found = detect(words, rules) if rules else []
    base = [d for d in found if d[0].kind == "base"]
    base_labels = sorted({rule.label for rule, _, _ in base})
    kept = resolve(found) if found else []
    miss = 1.0
    for kind in {rule.label: rule.kind for rule, _, _ in sorted(kept, key=lambda d: -d[0].priority)}.values():
        miss *= 1.0 - KINDS[kind]
    starts = [a for _, a, _ in base]
    return (len(words), len(base), min(starts, default=None), max(starts, default=None), base_labels,
            sorted({rule.label for rule, _, _ in kept}.union(base_labels)), 1.0 - miss,
            [{"label": rule.label, "kind": rule.kind, "rule": rule.order, "first_word": a, "last_word": b}
             for rule, a, b in kept])


def _scan_rows(rules: list[Rule] | None):
    """The task's function; rules travel as text, patterns are compiled in the worker."""
    span = pa.struct([("label", pa.string()), ("kind", pa.string()), ("rule", pa.int32()), ("first_word", pa.int64()),
                      ("last_word", pa.int64())])
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()), pa.float64(),
             pa.list_(span)]
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gate = Gate(rules if rules is not None else default_rules())
        for batch in batches:
            for part in chunks(batch, "text"):
                texts = part.column("text").cast(pa.large_binary())
                rows = [_row(t.as_buffer().to_pybytes() if t.is_valid else b"", gate) for t in texts]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("id"), *columns], ["id", *names])
    return run


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """One row per row of ``docs``: the licences its whole text names or carries.

    Columns: id; n_words; n_base, first_word and last_word: places of the base
    phrases, their smallest and largest first word (from 0; NULL without any);
    base_labels and labels, sorted and distinct (labels: base ones and those of
    all detections left after suppression); score, 1 - product over detected
    labels of (1 - weight of their strongest kind), 0 without detections;
    detections, the intervals left, by first word.

    NULL and empty texts have no words and no detections.  Repeated rows and
    ids are rows of their own.  Ties between rules go to the longer interval,
    then to the earlier rule.  An empty table gives an empty result; other
    columns are not read.  Very long texts are held one at a time.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_scan_rows(rules), SCHEMA)
