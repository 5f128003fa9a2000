"""Secret scan with multipart credential linking.

A credential has parts: an access identifier, a secret, and an endpoint.  Strong parts (the base kinds `assign`,
`access`, `hex`) are reported wherever they stand.  Weak candidates (a user name assignment, a long token of mixed
characters, a connection address) are common in clean text and are reported only where complementary parts meet:
an interval join links parts of one scope (text between blank lines) whose gap is at most `window` code points.

* `user` (weak access identifier): needs a secret, strong or weak, in reach.
* `key` (weak secret): needs an access identifier, strong or weak, in reach.
* `endpoint`: needs an access identifier and a secret in reach.

Scopes never cross rows, so the join runs inside each row as a sort and a binary search per part: O(n log n) in the
parts of one text, no pairs are listed, and nothing is shuffled.  Rows that cannot hold a part are ruled out for whole
Arrow batches by linear-time searches before any text becomes a Python string.

Defined results: null and empty texts have no spans (counts 0, the digest of the empty string); spans count code
points, end exclusive; equal starts are ordered by kind as in `KINDS`; repeated rows get equal results each; an empty
table gives an empty table; columns beyond the key and the text are not read.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from covlens.llm.batches import slices

KINDS = ("assign", "access", "hex", "user", "key", "endpoint")
WINDOW = 300

#: The base kinds.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_VALUE = 8

USER = re.compile(r"""\b(?:user(?:name)?|login|account|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?"""
                  r"[A-Za-z0-9@+/_.-]{3,}", re.IGNORECASE | re.ASCII)
KEY = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}(?![A-Za-z0-9+/_=-])", re.ASCII)
ENDPOINT = re.compile(r"""\b(?:[a-z][a-z0-9+.-]{1,20}://[^\s"'<>]+|(?:host|endpoint|server)["']?\x20*[:=]\x20*["']?"""
                      r"[A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]+)+(?::[0-9]+)?)", re.IGNORECASE | re.ASCII)
SCOPE_END = re.compile(r"\n[^\S\n]*\n")

# A text without any of these has neither a strong part nor a weak candidate that could be reported.
_ANY_STRONG = (r"(?i:passw|secret|token|api_?key)", r"AKIA", r"[0-9a-f]{32}")
_ANY_WEAK = r"(?i:user|login|account|client_?id|access_?key)"


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base kinds: leftmost, non-overlapping per kind."""
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def _mixed(token: str) -> bool:
    """A token that looks drawn at random: digits, small and large letters in one."""
    return any(c.isdigit() for c in token) and any(c.islower() for c in token) and any(c.isupper() for c in token)


class _Reach:
    """Which intervals of a sorted set lie within `window` of a given one, in one scope."""

    def __init__(self, spans: list[tuple[int, int, str]]):
        self.spans = sorted(spans)
        self.starts = [s[0] for s in self.spans]
        self.ends = list(accumulate((s[1] for s in self.spans), max))

    def near(self, start: int, end: int, scope: tuple[int, int], window: int) -> bool:
        i = bisect_right(self.starts, start)
        before = i and self.starts[i - 1] >= scope[0] and self.ends[i - 1] >= start - window
        return bool(before or i < len(self.starts) and self.starts[i] < scope[1] and self.starts[i] <= end + window)


def linked_spans(text: str, base: list[tuple[int, int, str]], window: int) -> list[tuple[int, int, str]]:
    """The weak candidates of `text` whose complementary parts are in reach."""
    taken = _Reach(base)
    free = lambda m: not taken.near(m.start(), m.end() - 1, (0, len(text)), 0)
    users = [(m.start(), m.end(), "user") for m in USER.finditer(text) if free(m)]
    access = [s for s in base if s[2] == "access"] + users
    if not access:
        return []
    keys = [(m.start(), m.end(), "key") for m in KEY.finditer(text) if _mixed(m[0]) and free(m)]
    by_user = _Reach(users)
    keys = [k for k in keys if not by_user.near(k[0], k[1] - 1, (0, len(text)), 0)] if users else keys
    secrets = [s for s in base if s[2] != "access"] + keys
    if not secrets:
        return []
    ends = [m.start() for m in SCOPE_END.finditer(text)]
    scope = lambda at: ((ends[i - 1] if (i := bisect_left(ends, at)) else 0),
                        ends[i] if i < len(ends) else len(text))
    by_access, by_secret = _Reach(access), _Reach(secrets)
    out = [s for s in users if by_secret.near(s[0], s[1], scope(s[0]), window)]
    out += [s for s in keys if by_access.near(s[0], s[1], scope(s[0]), window)]
    for m in ENDPOINT.finditer(text):
        at = (m.start(), m.end(), scope(m.start()), window)
        if free(m) and by_access.near(*at) and by_secret.near(*at):
            out.append((m.start(), m.end(), "endpoint"))
    return out


def _listed(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def _may_hold(texts: pa.Array) -> list[bool]:
    found = pc.match_substring_regex(texts, _ANY_STRONG[0])
    for p in (*_ANY_STRONG[1:], _ANY_WEAK):
        found = pc.or_(found, pc.match_substring_regex(texts, p))
    return pc.fill_null(found, False).to_pylist()


def scan(df: DataFrame, text: str = "text", key: str = "doc_id", window: int = WINDOW) -> DataFrame:
    """Per row: key, n_assign, n_access, n_hex, base_sha256 (of the base spans), spans (all spans, `kind:start:end`
    joined by commas), n_linked (weak candidates reported)."""
    kind = df.schema[key].dataType.simpleString()
    nothing = (0, 0, 0, hashlib.sha256(b"").hexdigest(), "", 0)

    def row(t: str) -> tuple:
        base = base_spans(t)
        weak = linked_spans(t, base, window)
        spans = sorted(base + weak, key=lambda s: (s[0], KINDS.index(s[2])))
        count = lambda k: sum(s[2] == k for s in base)
        return (count("assign"), count("access"), count("hex"), hashlib.sha256(_listed(base).encode()).hexdigest(),
                _listed(spans), len(weak))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                texts = part.column("_text")
                rows = [row(texts[i].as_py()) if may else nothing for i, may in enumerate(_may_hold(texts))]
                cols = [*zip(*rows)] if rows else [()] * 6
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("_key"), *(pa.array(c, t) for c, t in zip(cols, kinds))],
                    [key, "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_linked"])

    return df.select(df[key].alias("_key"), df[text].alias("_text")).mapInArrow(
        run, f"`{key}` {kind}, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, "
             "n_linked bigint")
