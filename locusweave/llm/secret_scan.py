"""Secret scan with multipart credential linking.

Strong patterns (assignments, access keys, long hex) are reported by themselves. Weak candidates - long tokens of mixed
characters - are reported only where a complementary part co-occurs: an interval join links them to access identifiers
and endpoints that lie anywhere in the same scope and don't overlap them. A plain web link (no user, no port, no service in its host) is such a part only for a candidate that is an assigned value, as links stand beside
commit hashes and ids everywhere. A given ``reach`` also bounds the distance in code points. A scope is
a block of lines without a blank line between. Parts are found by bisection of their sorted starts and ends, so a text with many parts costs n log n.
Texts are scanned one by one inside Arrow batches; no part leaves its row, so nothing is shuffled.

Null text counts as empty: no spans. doc_id, null or repeated, is only passed on. An empty table gives an empty
result. Other columns of the input are not read. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
#: In the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "linked")

#: Names may have others in front (``DB_USER``).
IDENTIFIER = re.compile(r"""(?<![A-Za-z0-9])(?:user(?:name)?|login|account|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})""", re.ASCII | re.IGNORECASE)
ENDPOINT = re.compile(r"\b[a-z][a-z0-9+.-]{1,15}://[^\s\"'<>]{4,}", re.ASCII)
HOST = re.compile(r"""(?<![A-Za-z0-9])(?:host(?:name)?|server|endpoint|url)["']?\x20*[:=]\x20*["']?([A-Za-z0-9][A-Za-z0-9-]*(?:\.[A-Za-z0-9-]+)+(?::[0-9]+)?)""", re.ASCII | re.IGNORECASE)
#: Parts of host names that tell a service from a page.
SERVICES = "admin|api|auth|cache|data|db|git|gateway|kafka|ldap|login|mail|mongo|mq|mysql|postgres|queue|redis|registry|s3|smtp|sql|sso|storage|vault|vpn"
#: A link that tells no more than a page in the web: no user, no port, no service.
PLAIN_LINK = re.compile(rf"https?://(?![^/\s]*@)(?![^/\s]*:[0-9])(?!(?:[a-z0-9-]+\.)*(?:{SERVICES})[0-9-]*\.)", re.ASCII | re.IGNORECASE)
#: What stands before a value that is assigned.
ASSIGNED = re.compile(r"""[A-Za-z0-9_]["']?\x20*[:=]\x20*["']?\Z""", re.ASCII)
#: A value may stand straight after "=".
WEAK = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])")
BLANK_LINE = re.compile(r"\n[ \t\r]*\n")

OUT = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_linked long, score double, links string"
#: Kinds of complementary parts.
PARTS = ("access", "endpoint", "identifier")


def _mixed(token: str) -> bool:
    """Letters and digits, and at least 3.2 bits a character."""
    if not (any(c.isdigit() for c in token) and any(c.isalpha() for c in token)):
        return False
    n = len(token)
    return -sum(k / n * math.log2(k / n) for k in Counter(token).values()) >= 3.2


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, rank of kind, end) of the base patterns."""
    found = []
    low = text.lower()
    if "passw" in low or "secret" in low or "token" in low or "api" in low:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def linked_parts(text: str, base: list[tuple[int, int, int]], reach: int | None = None) -> list[tuple[int, int, tuple[int, int, int]]]:
    """Weak candidates outside the base spans that have a complementary part in the same scope, within ``reach`` if that is given.

    (start, end, part): the part is the nearest one, the earlier of two as near, as (kind, start, end) with the place of its kind in ``PARTS``.
    """
    links = [m.span() for m in ENDPOINT.finditer(text)] if "://" in text else []
    plain = [span for span in links if PLAIN_LINK.match(text, span[0])]
    parts = [(0, start, end) for start, kind, end in base if kind == 1] + [(1, *span) for span in links if span not in set(plain)]
    if "=" in text or ":" in text:
        parts += [(1, *m.span()) for m in HOST.finditer(text)] + [(2, *m.span()) for m in IDENTIFIER.finditer(text)]
    if not parts and not plain:
        return []
    known, more = _Parts(parts), _Parts(parts + [(1, *span) for span in plain])
    walls = [m.start() for m in BLANK_LINE.finditer(text)]
    taken = sorted([(s, e) for s, _, e in base] + links)
    taken_starts = [t[0] for t in taken]
    taken_ends, furthest = [], -1
    for t in taken:
        furthest = max(furthest, t[1])
        taken_ends.append(furthest)
    found = []
    for m in WEAK.finditer(text):
        start, end = m.span()
        i = bisect_left(taken_starts, end)
        if i and taken_ends[i - 1] > start or not _mixed(m[0]):
            continue
        k = bisect_left(walls, start)
        lo = walls[k - 1] if k else 0
        hi = walls[k] if k < len(walls) else len(text)
        if reach is not None:
            lo, hi = max(start - reach, lo), min(end + reach, hi)
        nearest = (more if ASSIGNED.search(text, max(0, start - 40), start) else known).nearest(start, end, lo, hi)
        if nearest:
            found.append((start, end, nearest))
    return found


class _Parts:
    """Complementary parts by their starts and by their ends."""

    def __init__(self, parts: list[tuple[int, int, int]]) -> None:
        self.by_start, self.by_end = sorted(parts, key=lambda p: (p[1], p)), sorted(parts, key=lambda p: (p[2], p))
        self.starts, self.ends = [p[1] for p in self.by_start], [p[2] for p in self.by_end]

    def nearest(self, start: int, end: int, lo: int, hi: int) -> tuple[int, int, int] | None:
        """The part nearest to the candidate that ends after ``lo`` and not after its start, or starts before ``hi`` and not before its end."""
        i, j = bisect_right(self.ends, start), bisect_left(self.starts, end)
        near = [(start - self.ends[i - 1], self.by_end[i - 1])] if i and self.ends[i - 1] > lo else []
        near += [(self.starts[j] - end, self.by_start[j])] if j < len(self.starts) and self.starts[j] < hi else []
        return min(near, key=lambda n: n[0])[1] if near else None


def linked_spans(text: str, base: list[tuple[int, int, int]], reach: int | None = None) -> list[tuple[int, int, int]]:
    """(start, rank of kind, end) of the linked candidates."""
    return [(start, 3, end) for start, end, _ in linked_parts(text, base, reach)]


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _scan(batches: Iterator[pa.RecordBatch], reach: int | None) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in common.slices(batch):
            rows = []
            for text in part.column("text").to_pylist():
                base = base_spans(text)
                pairs = linked_parts(text, base, reach)
                linked = [(start, 3, end) for start, end, _ in pairs]
                links = ",".join(f"linked:{s}:{e}>{PARTS[k]}:{a}:{b}" for s, e, (k, a, b) in pairs)
                n = Counter(kind for _, kind, _ in base)
                rows.append((n[0], n[1], n[2], hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(sorted(base + linked)), len(linked), 1.0 if base else 0.6 if linked else 0.0, links))
            kinds = (pa.int64(),) * 3 + (pa.string(),) * 2 + (pa.int64(), pa.float64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds))],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_linked", "score", "links"],
            )


def scan(docs: DataFrame, reach: int | None = None) -> DataFrame:
    """One row per input row; ``spans`` holds base and linked spans as ``kind:start:end``, by start; ``links`` each linked span with the nearest part, as ``linked:start:end>kind:start:end``."""
    base = common.small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), common.whole_text().alias("text"))
    return base.mapInArrow(lambda batches: _scan(batches, reach), OUT)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(common.table(spark, sf_dir, "documents"))
