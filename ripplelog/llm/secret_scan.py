"""Secrets in texts: fixed shapes, and strings whose sliding-window entropy is high."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from ripplelog.llm.frames import batches_of

# The shapes of the contract.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
#: Bits per character that a window must reach, by the class of its characters.
THRESHOLDS = {"hex": 3.0, "base64": 3.8, "letters": 4.15}
#: Letters of each case in a window that words in camel case don't have.
MIXED = 6
#: Parts of a candidate, between its marks, that are no secrets.
ALLOWED = (
    r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",  # identifiers of version 1 to 8
    r"(https?|ftp|www)[^A-Za-z0-9][^/=]*",  # up to the end of the host
    r"\d{4}-\d\d-\d\d[T_]\d{0,6}",
    r"\d[\d.+/_=-]*\d",  # numbers
    r"[A-Za-z0-9]*(EXAMPLE|example|0123456789|abcdefghij)[A-Za-z0-9]*",
    r"[A-Z]?[a-z]{3,18}|[A-Z]{4,18}",  # a word
    r"^([A-Za-z]{1,19}[-_./])+[A-Za-z]{0,19}\d{0,4}$",  # nothing but words joined by marks
)

_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _char_class(text: str) -> str:
    if not re.search("[0-9]", text) or not re.search("[A-Za-z]", text):
        return "letters"
    return "hex" if re.fullmatch("[0-9a-f]+|[0-9A-F]+", text) else "base64"


def _kind_of(char: str) -> int:
    """Digit, a-f, other small letter, A-F, other capital letter, mark."""
    if "0" <= char <= "9":
        return 0
    if "a" <= char <= "z":
        return 1 if char <= "f" else 2
    if "A" <= char <= "Z":
        return 3 if char <= "F" else 4
    return 5


def _window_class(n: list[int], window: int) -> str:
    small, capital = n[1] + n[2], n[3] + n[4]
    if n[0] and (n[0] + n[1] == window or n[0] + n[3] == window) and n[0] < window:
        return "hex"
    return "base64" if min(small, capital) >= MIXED or (n[0] and small + capital) else "letters"


def high_entropy(text: str, window: int, threshold: float, thresholds: dict[str, float] | None = None) -> list[tuple[int, int]]:
    """Stretches covered by windows of at least ``threshold`` bits per character, or of what
    ``thresholds`` ask of the window's own class if that is less.

    The window's sum of c*log2(c) changes by two terms as it moves by one character, and so do the
    counts of its classes of characters.
    """
    if len(text) < window:
        return []
    term = [0.0] + [c * math.log2(c) for c in range(1, window + 1)]
    counts: dict[str, int] = {}
    total, out = 0.0, []
    bound = lambda bits: (math.log2(window) - bits) * window + 1e-9
    most = bound(threshold)
    own = {k: max(most, bound(bits)) for k, bits in (thresholds or {}).items()}
    least = max(own.values(), default=most)
    kinds = [0] * 6
    for i, char in enumerate(text):
        c = counts.get(char, 0)
        total += term[c + 1] - term[c] if c < window else 0.0
        counts[char] = c + 1
        kinds[_kind_of(char)] += 1
        if i >= window:
            old = text[i - window]
            c = counts[old]
            total += term[c - 1] - term[min(c, window)]
            counts[old] = c - 1
            kinds[_kind_of(old)] -= 1
        if i >= window - 1 and total <= least and (total <= most or total <= own[_window_class(kinds, window)]):
            start = i - window + 1
            if out and start <= out[-1][1]:
                out[-1] = (out[-1][0], i + 1)
            else:
                out.append((start, i + 1))
    return out


class Scanner:
    """Finds the spans of one text at a time."""

    def __init__(self, window: int, thresholds: dict[str, float], allowed: tuple[str, ...]):
        self.window, self.thresholds = window, thresholds
        self.assign = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
        self.access = re.compile(ACCESS)
        # A run is matched from its first character, so only starts of runs are tried.
        self.hex = re.compile("(?<![0-9a-f])[0-9a-f]{32,}")
        self.candidate = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{%d,}" % window)
        # At each place the pattern that reaches furthest counts, so each is looked for by itself.
        self.allowed = [re.compile(f"(?<![A-Za-z0-9])(?:{x})(?![A-Za-z0-9])") for x in allowed]

    def base(self, text: str) -> list[tuple[int, int, int]]:
        spans = []
        if ":" in text or "=" in text:
            spans += [(m.start(), 0, m.end()) for m in self.assign.finditer(text) if len(m[2]) >= 8]
        spans += [(m.start(), 1, m.end()) for m in self.access.finditer(text) if len(m[0]) >= 16]
        spans += [(m.start(), 2, m.end()) for m in self.hex.finditer(text)]
        return spans

    def parts(self, run: str) -> Iterator[tuple[int, str]]:
        """What of a candidate lies outside allowed parts, with its place."""
        place = 0
        for a, b in sorted(x.span() for pattern in self.allowed for x in pattern.finditer(run)):
            if a > place:
                yield place, run[place:a]
            place = max(place, b)
        if place < len(run):
            yield place, run[place:]

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(start, number of the kind, end) in order."""
        base = sorted(self.base(text))
        found, n, reach = list(base), 0, 0
        # Stretches come in order of their start, so one pass over the base spans tells which they cover.
        for m in self.candidate.finditer(text):
            for first, part in self.parts(m[0]):
                for a, b in high_entropy(part, self.window, self.thresholds[_char_class(part)], self.thresholds):
                    a, b = a + first + m.start(), b + first + m.start()
                    while n < len(base) and base[n][0] <= a:
                        reach = max(reach, base[n][2])
                        n += 1
                    if b > reach:
                        found.append((a, 3, b))
        return sorted(found)


def scan_secrets(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    thresholds: dict[str, float] = THRESHOLDS,
    allowed: tuple[str, ...] = ALLOWED,
) -> DataFrame:
    """One row (id, spans) per row: spans are structs of kind, start and end in code points.

    Kinds ``assign``, ``access`` and ``hex`` are the fixed shapes. ``entropy`` spans are unions of
    windows whose Shannon entropy reaches the threshold of their own character class or of what they
    lie in between allowed parts; a window that touches an allowed part is suppressed, and so is
    what a fixed shape already covers. Null and empty texts have no spans; null ids, repeated rows and other columns
    of any name don't matter; an empty table gives an empty table. A text is scanned whole, in
    time proportional to its length.
    """

    def scan(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(window, thresholds, allowed)
        for batch in batches_of(rows, 16 << 20):
            spans = [
                [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in scanner.spans(text or "")]
                for text in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, _SPANS)], ["id", "spans"])

    kind = df.select(id_col).schema[0].dataType.simpleString()
    narrow = df.select(df[id_col].alias("id"), df[text_col].alias("text"))
    return narrow.mapInArrow(scan, f"id {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>")
