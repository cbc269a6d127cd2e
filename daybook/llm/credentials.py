"""Secret scan by multipart credential linking.

Some secrets are told by their form alone: values assigned to a secret's name,
access identifiers with a known prefix, long runs of hexadecimal digits. They are
always reported. Other parts of a credential look harmless alone: a user name, an
endpoint, a mixed token. These weak candidates are reported only where their
complementary parts co-occur in the same scope, a paragraph (text without a blank
line), at most ``reach`` code points apart:

* ``user`` (weak identifier) beside a secret: ``assign``, ``hex`` or ``weak``;
* ``weak`` (mixed token) beside an identifier: ``access`` or ``user``;
* ``endpoint`` beside both an identifier and a secret.

Whether parts co-occur is an interval join: all parts of a block are sorted by
(row, scope, start), a running maximum of the ends is kept for each class, and one
binary search per weak part finds an interval that reaches into its own. It is
linear up to sorting, with no pairs, however many parts a text holds.

Rows are scanned where they are read, in blocks of about 2 MB of text, so nothing
is shuffled and a task's memory is bounded by the longest text. A null text counts
as empty; an empty text has no spans; every row gives one row, equal rows and null
ids included; an empty table gives an empty result; columns other than ``doc_id``
and ``text`` are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import blocks

# The forms that tell a secret alone.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

# Forms of weak candidates.
USER = r"""\b(?:user(?:_?name|_?id)?|login|account|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]{3,})"""
ENDPOINT = r"""\b[A-Za-z][A-Za-z0-9+.-]{1,15}://[^\s"'<>]+|\b(?:host(?:name)?|endpoint|server)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]+)+(?::\d+)?)"""
TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
BLANK = r"\n[ \t\r]*\n"
#: Bits per character from which on a mixed token looks random.
LEAST_BITS = 3.5
#: Code points between parts that belong together.
REACH = 300

KINDS = ("assign", "access", "hex", "user", "endpoint", "weak")
BASE_KINDS = KINDS[:3]
_IDENTIFIERS, _SECRETS = ("access", "user"), ("assign", "hex", "weak")

_ASSIGN, _USER, _ENDPOINT = (re.compile(p, re.ASCII | re.IGNORECASE) for p in (ASSIGN, USER, ENDPOINT))
_ACCESS, _HEX, _TOKEN, _BLANK = (re.compile(p, re.ASCII) for p in (ACCESS, HEX, TOKEN, BLANK))
# A row with any span matches this; most rows don't, and are passed over at once.
_ANY = (
    r"""(?i:(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{6})"""
    rf"""|AKIA[A-Z0-9]{{16}}|[0-9a-f]{{24}}|(?i:(?:user|login|account|name|id)["']?\x20*[:=])"""
)

SPAN = "struct<kind:string,start:int,end:int,scope:int,partner_start:int,partner_end:int,value:string>"


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The spans told by their form alone, leftmost and not overlapping within a kind."""
    out = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    out += [("access", *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    out += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return out


def looks_random(token: str) -> bool:
    """Upper and lower case letters and digits, with the entropy of random text."""
    codes = np.frombuffer(token.encode(), np.uint8)
    upper, lower, digit = ((codes >= a) & (codes <= b) for a, b in ((65, 90), (97, 122), (48, 57)))
    if not (upper.any() and lower.any() and digit.any()):
        return False
    share = np.bincount(codes)
    share = share[share > 0] / len(codes)
    return float(-(share * np.log2(share)).sum()) >= LEAST_BITS


def weak_spans(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Candidates that need a complementary part; mixed tokens only outside all other spans."""
    out = [("user", *m.span()) for m in _USER.finditer(text)]
    if not out and not any(k == "access" for k, *_ in base):
        return []  # endpoints and tokens need an identifier somewhere
    out += [("endpoint", *m.span()) for m in _ENDPOINT.finditer(text)]
    taken = np.zeros(len(text) + 1, np.int32)
    for _, a, b in [*base, *out]:
        taken[a] += 1
        taken[b] -= 1
    taken = np.cumsum(np.cumsum(taken) > 0)
    for m in _TOKEN.finditer(text):
        a, b = m.span()
        if taken[b - 1] == (taken[a - 1] if a else 0) and looks_random(m[0]):
            out.append(("weak", a, b))
    return out


def partners(low: np.ndarray, high: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Interval join for existence: for each [low, high) the index of an interval [start, end) that
    overlaps it, the one that ends last among those that start before ``high``; -1 where there is none."""
    if not len(start):
        return np.full(len(low), -1)
    order = np.lexsort((end, start))
    far = np.maximum.accumulate(end[order])
    holder = np.maximum.accumulate(np.where(end[order] == far, np.arange(len(order)), 0))
    at = np.searchsorted(start[order], high, "left") - 1
    found = (at >= 0) & (far[np.maximum(at, 0)] > low)
    return np.where(found, order[holder[np.maximum(at, 0)]], -1)


def linked(rows: np.ndarray, scopes: np.ndarray, start: np.ndarray, end: np.ndarray, kind: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """Which parts are reported, and the index of a complementary part (-1: none)."""
    # every (row, scope) on a stretch of its own, further apart than any interval reaches
    key = np.unique(np.stack([rows, scopes]), axis=1, return_inverse=True)[1].ravel()
    step = int(end.max(initial=0)) + 2 * reach + 1
    low, high = key * step + reach + start, key * step + reach + end

    def beside(kinds: tuple[str, ...]) -> np.ndarray:
        mine = np.flatnonzero(np.isin(kind, kinds))
        at = partners(low - reach, high + reach, low[mine], high[mine])
        return np.where(at >= 0, mine[at] if len(mine) else -1, -1)

    by_identifier, by_secret = beside(_IDENTIFIERS), beside(_SECRETS)
    partner = np.where(np.isin(kind, _SECRETS), by_identifier, by_secret)
    both = (by_identifier >= 0) & (by_secret >= 0)
    reported = np.isin(kind, BASE_KINDS) | np.where(kind == "endpoint", both, partner >= 0)
    return reported, np.where((kind == "endpoint") & ~both, -1, partner)


def _scan(reach: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches):
            column = batch.column("text")
            hit = np.flatnonzero(pc.fill_null(pc.match_substring_regex(column, _ANY), False).to_numpy(zero_copy_only=False))
            parts: list[tuple[int, int, str, int, int]] = []
            texts = {}
            for row in hit.tolist():
                text = texts[row] = column[row].as_py()
                base = base_spans(text)
                found = base + weak_spans(text, base)
                if found:
                    ends = np.array([m.end() for m in _BLANK.finditer(text)], np.int64)
                    scope = np.searchsorted(ends, [a for _, a, _ in found], "right")
                    parts += [(row, int(s), *f) for s, f in zip(scope, found, strict=True)]
            spans: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            if parts:
                row, scope, kind, start, end = (np.array(c) for c in zip(*parts, strict=True))
                reported, partner = linked(row, scope, start, end, kind, reach)
                order = sorted(np.flatnonzero(reported).tolist(), key=lambda i: (parts[i][0], parts[i][3], KINDS.index(parts[i][2]), parts[i][4]))
                for i in order:
                    r, s, k, a, b = parts[i]
                    p = int(partner[i])
                    spans[r].append({
                        "kind": k, "start": a, "end": b, "scope": s, "value": texts[r][a:b],
                        "partner_start": parts[p][3] if p >= 0 else None, "partner_end": parts[p][4] if p >= 0 else None,
                    })
            yield pa.record_batch([batch.column("doc_id"), pa.array(spans, _ARROW)], ["doc_id", "spans"])

    return run


_ARROW = pa.list_(pa.struct([
    ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("scope", pa.int32()),
    ("partner_start", pa.int32()), ("partner_end", pa.int32()), ("value", pa.string()),
]))


def scan_credentials(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """(doc_id, spans) of every document: the reported parts by start, then kind, with their scope (blank
    lines before it), their text, and the place of a complementary part beside them (null: none).
    Places are code points, ends exclusive."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _scan(reach), f"doc_id long, spans array<{SPAN}>"
    )


def span_digests(found: DataFrame) -> DataFrame:
    """doc_id, numbers of the spans told by their form alone, a digest of their places, and all places."""
    base = f"filter(spans, s -> s.kind IN ({', '.join(repr(k) for k in BASE_KINDS)}))"
    text = "array_join(transform({}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
    return found.select(
        "doc_id", *[F.expr(f"CAST(size(filter(spans, s -> s.kind = '{k}')) AS BIGINT)").alias(f"n_{k}") for k in BASE_KINDS],
        F.expr(f"sha2({text.format(base)}, 256)").alias("base_sha256"), F.expr(text.format("spans")).alias("spans"),
    )
