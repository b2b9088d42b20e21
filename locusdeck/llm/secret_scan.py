"""Secret scan: three fixed patterns, and entropy of sliding windows over candidate strings.

The patterns give the base spans. The method adds spans of kind ``entropy``: maximal runs of
letters, digits and ``+/_=-`` of at least WINDOW characters are candidates. A window of WINDOW
characters slides over each; its Shannon entropy is kept by incremental counts, as a hex string
if the window has hex characters only, else as base64. Windows at or above their class's threshold
that hold both letters and digits are merged to spans. A span loses the parts (between ``/`` and ``=``) at its ends that match
the allow-list, and is suppressed if it lies in a base span, if less than a window is left of it, or if one class of characters
hardly changes.

Spans are ``kind:start:end`` over code points, the end exclusive; a base span is the whole match.
NULL and empty texts have no spans; repeated rows give repeated rows; an empty table gives no rows; any other columns are
ignored. The time for a text grows with its length and the number of its spans.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 20
HEX_BITS, BASE64_BITS = 3.0, 3.9

# --- fixed values: the three kinds, their patterns and least lengths ---
ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24
KINDS = ("assign", "access", "hex", "entropy")
# --- end of fixed values ---

# Equal to runs of the pattern that are long enough: a shorter run cannot hold a longer one.
_LONG_ACCESS = re.compile(r"AKIA[A-Z0-9]{%d,}" % (LEAST_ACCESS - 4))
_LONG_HEX = re.compile(r"[0-9a-f]{%d,}" % LEAST_HEX)
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % WINDOW)
_PART = re.compile(r"[^/=]+")
_MIXED = re.compile(r"(?=.*[0-9])(?=.*[A-Za-z])", re.DOTALL)

#: Candidates that are known to be harmless: identifiers in snake or kebab case, paths of words,
#: UUIDs, dates and times, and text marked as an example.
ALLOWED = (
    re.compile(r"[A-Za-z]+(?:[_/=+-]+[A-Za-z]+)*[0-9]{0,3}"),
    re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}"),
    re.compile(r"[0-9]+(?:[-/_=+][0-9]+)*"),
    re.compile(r"[\s\S]*(?:EXAMPLE|example|xxxx|XXXX|0000000|1234567)[\s\S]*"),
)

Span = tuple[int, int, int]


def base_spans(text: str) -> list[Span]:
    """(start, kind number, end) of the three patterns, by start, then kind."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    found += [(m.start(), 1, m.end()) for m in _LONG_ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _LONG_HEX.finditer(text)]
    return sorted(found)


def _kind(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3


def hot_windows(run: str, window: int = WINDOW) -> Iterator[tuple[int, int]]:
    """(start, end) of merged windows whose entropy reaches the threshold of their class.

    The entropy of a window of w characters is log2 w - sum(n log2 n) / w; a step changes two counts.
    """
    cost = [0.0, *(n * log2(n) for n in range(1, window + 1))]
    count: dict[str, int] = {}
    kinds = [0, 0, 0, 0]
    not_hex = total = 0
    is_hex = lambda c: c in "0123456789abcdef" or c in "ABCDEF"
    start = end = -1
    for i, c in enumerate(run):
        n = count.get(c, 0)
        total += cost[n + 1] - cost[n]
        count[c] = n + 1
        kinds[_kind(c)] += 1
        not_hex += not is_hex(c)
        if i >= window:
            old = run[i - window]
            n = count[old]
            total += cost[n - 1] - cost[n]
            count[old] = n - 1
            kinds[_kind(old)] -= 1
            not_hex -= not is_hex(old)
        if i + 1 < window:
            continue
        bits = log2(window) - total / window
        mixed = kinds[0] >= 2 and kinds[1] + kinds[2] >= 2
        if mixed and bits >= (HEX_BITS if not not_hex else BASE64_BITS):
            if start >= 0 and i + 1 - window <= end:
                end = i + 1
            else:
                if start >= 0:
                    yield start, end
                start, end = i + 1 - window, i + 1
    if start >= 0:
        yield start, end


def allowed(candidate: str) -> bool:
    return any(p.fullmatch(candidate) for p in ALLOWED)


class _Parts:
    """The parts of a candidate between ``/`` and ``=``, each held against the allow-list at most once."""

    def __init__(self, run: str):
        self.run = run
        self.spans = [m.span() for m in _PART.finditer(run)]
        self.ends = [end for _, end in self.spans]
        self.known: dict[int, bool] = {}

    def _harmless(self, k: int) -> bool:
        if k not in self.known:
            self.known[k] = allowed(self.run[slice(*self.spans[k])])
        return self.known[k]

    def trimmed(self, start: int, end: int, window: int = WINDOW) -> tuple[int, int] | None:
        """The span without the harmless parts at its ends; None if less than a window is left."""
        first, last = bisect_right(self.ends, start), bisect_left(self.ends, end)
        last = min(last, len(self.spans) - 1)
        while last >= 0 and self.spans[last][0] >= end:
            last -= 1
        while first <= last and self._harmless(first):
            first += 1
        while first <= last and self._harmless(last):
            last -= 1
        if first > last:
            return None
        start, end = max(start, self.spans[first][0]), min(end, self.spans[last][1])
        return (start, end) if end - start >= window else None


def entropy_spans(text: str, base: list[Span]) -> list[Span]:
    found = []
    reach = at = 0  # how far the base spans that begin so far reach
    for m in _CANDIDATE.finditer(text):
        run = m.group()
        if not _MIXED.match(run):
            continue
        parts = _Parts(run)
        for a, b in hot_windows(run):
            kept = parts.trimmed(a, b)
            if kept is None:
                continue
            start, end = kept[0] + m.start(), kept[1] + m.start()
            while at < len(base) and base[at][0] <= start:
                reach = max(reach, base[at][2])
                at += 1
            if reach < end:
                found.append((start, 3, end))
    return found


def spans_of(text: str) -> tuple[list[Span], list[Span]]:
    """(base spans, all spans), each by start, then kind."""
    base = base_spans(text)
    return base, sorted(base + entropy_spans(text, base))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, base and all spans as text, and the base spans per kind."""
    schema = docs.select(id_col).schema
    for name, kind in (("n_assign", "long"), ("n_access", "long"), ("n_hex", "long"), ("base", "string"), ("spans", "string")):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: list[list[int]] = [[], [], []]
            base_text, all_text = [], []
            for text in batch.column(1).to_pylist():
                base, every = spans_of(text or "")
                for kind in range(3):
                    counts[kind].append(sum(k == kind for _, k, _ in base))
                base_text.append(joined(base))
                all_text.append(joined(every))
            columns = [pa.array(c, pa.int64()) for c in counts] + [pa.array(c, pa.string()) for c in (base_text, all_text)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema.names)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()
