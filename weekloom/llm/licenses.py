"""License scan by ordered signature rules.

Hundreds of hand-written patterns (``license_rules``) name licences by identifiers, by
sentences of their texts, by notices, addresses and names. A keyword gates each of them:
one automaton over all keywords passes over a batch, rows without any keyword are done,
and on the others only the patterns whose keyword occurs are searched. Detections may
overlap; one that lies inside a detection of the same or a higher priority is suppressed
(of equal intervals and priorities the rule that comes first stays), so that a lesser
license is not also a general one and a version is not also its family.

The phrases of the base are rules of the lowest priority whose detections always stay.
Words are numbered in the text; the score is the strength of the best evidence that stays.
Whole texts are searched: gaps and wildcards in patterns are bounded, so that the cost is
linear in a text, and the suppression is one sweep over its sorted detections.

Null and empty texts have no words and no detections. Repeated rows each get a row, a null
id is kept, an empty table gives no rows, other columns are ignored. No row is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from weekloom.llm import license_rules
from weekloom.llm.common import byte_view, long_rows, pick, slices

GAP = rb"[^0-9a-z\x80-\xff]{1,32}"
WORD = np.zeros(256, bool)
WORD[ord("0") : ord("9") + 1] = WORD[ord("a") : ord("z") + 1] = WORD[128:] = True
#: The contract's base lets any run of other characters stand between the words.
ANY_GAP = rb"[^0-9a-z\x80-\xff]+"
FOUND = "array<struct<label:string,kind:string,first:long,last:long,text:string>>"
SCANNED = f"doc_id long, n_words long, base {FOUND}, found {FOUND}, score double"


@dataclass(frozen=True)
class Rule:
    """A pattern that stands for a label; ``order`` breaks ties within a priority."""

    label: str
    kind: str
    keyword: re.Pattern
    pattern: re.Pattern
    order: int

    @property
    def priority(self) -> int:
        return license_rules.KINDS[self.kind][0]

    @property
    def strength(self) -> float:
        return license_rules.KINDS[self.kind][1]


@dataclass(frozen=True)
class Detection:
    start: int
    end: int
    label: str
    rule: Rule


def compiled(pattern: str, gap: bytes = GAP) -> re.Pattern:
    raw = pattern.encode().replace(b"~", b"(?:" + gap + b")?").replace(b" ", b"(?:" + gap + b")")
    return re.compile(raw, re.DOTALL)


def lines() -> Iterator[tuple[str, str, str, str]]:
    """(kind, label, keyword, pattern) of all rules, strongest kind first."""
    for tag in license_rules.TAGGED.split():
        words = re.sub(r"[.-]", " ", tag)
        yield "identifier", tag, "spdx", f"spdx license identifier {words}"
    for kind, table in license_rules.TABLES.items():
        for line in table.strip().splitlines():
            yield kind, *line.split(" ; ")


@cache
def rules() -> tuple[Rule, ...]:
    return tuple(
        Rule(label, kind, compiled(key), compiled(pattern, ANY_GAP if kind == "base" else GAP), i)
        for i, (kind, label, key, pattern) in enumerate(lines())
    )


@cache
def gated() -> dict[re.Pattern, tuple[Rule, ...]]:
    """Keyword -> its rules."""
    out: dict[re.Pattern, list[Rule]] = {}
    for rule in rules():
        out.setdefault(rule.keyword, []).append(rule)
    return {k: tuple(v) for k, v in out.items()}


@cache
def gate() -> str:
    """One expression that finds any keyword; its gaps may be wider, never narrower."""
    keys = sorted({re.sub("[ ~]+", "[^0-9a-z]+", key) for _, _, key, _ in lines()})
    return "|".join(keys)


def version(group: bytes) -> str:
    digits = re.findall(rb"[0-9]", group)
    return b".".join(digits if len(digits) > 1 else [*digits, b"0"]).decode()


def is_word(text: bytes, i: int) -> bool:
    return 0 <= i < len(text) and bool(WORD[text[i]])


def occurrences(rule: Rule, text: bytes) -> Iterator[Detection]:
    """Matches of a rule between word borders, from left to right, not overlapping."""
    at = 0
    while m := rule.pattern.search(text, at):
        start, end = m.span()
        if is_word(text, start - 1) or is_word(text, end):
            at = start + 1
            continue
        label = rule.label
        if "*" in label:
            label = label.replace("*", version(m["v"]))
        yield Detection(start, end, label, rule)
        at = end


def detected(text: bytes) -> Iterator[Detection]:
    """All detections of the rules whose keyword occurs in a lowered text."""
    for keyword, group in gated().items():
        if keyword.search(text):
            for rule in group:
                yield from occurrences(rule, text)


def unsuppressed(detections: list[Detection]) -> list[Detection]:
    """Those inside no other of the same or a higher priority, in text order.

    Sorted by start, longer and stronger first: whatever could contain a detection comes
    before it, so the furthest end so far of each priority decides.
    """
    reach = [-1] * (1 + max(p for p, _ in license_rules.KINDS.values()))
    kept = []
    order = lambda d: (d.start, -d.end, -d.rule.priority, d.rule.order)
    for d in sorted(detections, key=order):
        if d.end > max(reach[d.rule.priority :]):
            kept.append(d)
        reach[d.rule.priority] = max(reach[d.rule.priority], d.end)
    return kept


def numbered(found: list[Detection], starts: np.ndarray, text: bytes) -> list[dict]:
    """Detections as rows, places as numbers of words."""
    firsts = np.searchsorted(starts, [d.start for d in found])
    lasts = np.searchsorted(starts, [d.end for d in found]) - 1
    return [
        {
            "label": d.label,
            "kind": d.rule.kind,
            "first": int(a),
            "last": int(b),
            "text": text[d.start : d.end].decode(errors="replace"),
        }
        for d, a, b in zip(found, firsts, lasts, strict=True)
    ]


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: ``base`` and ``found`` detections, words and score."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(
            pa.struct(
                [("label", pa.string()), ("kind", pa.string()), ("first", pa.int64()),
                 ("last", pa.int64()), ("text", pa.string())]
            )
        )
        for batch in batches:
            for part in slices(batch, 1):
                lowered = pc.ascii_lower(part.column(1).cast(pa.string()).fill_null(""))
                offsets, data = byte_view(lowered.cast(pa.binary()))
                inside = WORD[data]
                begins = inside.copy()
                begins[1:] &= ~inside[:-1]
                cuts = offsets[:-1][offsets[:-1] < len(data)]
                begins[cuts] = inside[cuts]
                upto = np.append(0, np.cumsum(begins))
                n = len(part)
                base, found, score = [[]] * n, [[]] * n, np.zeros(n)
                hit = pc.match_substring_regex(lowered, gate()).to_numpy(zero_copy_only=False)
                for i in np.flatnonzero(hit):
                    here = slice(offsets[i], offsets[i + 1])
                    text = data[here].tobytes()
                    every = list(detected(text))
                    if not every:
                        continue
                    starts = np.flatnonzero(begins[here])
                    phrases = [d for d in every if d.rule.kind == "base"]
                    phrases.sort(key=lambda d: (d.start, d.rule.order))
                    rest = unsuppressed([d for d in every if d.rule.kind != "base"])
                    base[i] = numbered(phrases, starts, text)
                    found[i] = numbered(rest, starts, text)
                    score[i] = max(d.rule.strength for d in phrases + rest)
                counts = upto[offsets[1:]] - upto[offsets[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(counts, pa.int64()), pa.array(base, kind),
                     pa.array(found, kind), pa.array(score)],
                    ["doc_id", "n_words", "base", "found", "score"],
                )

    rows = pick(docs, "doc_id", "text").selectExpr("cast(doc_id AS long) AS doc_id", "cast(text AS binary)")
    return long_rows(rows).mapInArrow(search, SCANNED)
