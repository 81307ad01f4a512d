"""Secret scans with multipart credential linking.

Base kinds (``assign``, ``access``, ``hex``) are reported wherever they match. Three weak kinds
are candidates only: ``user`` (an identifier: ``user = name`` or an e-mail address), ``endpoint``
(a URL of any scheme with a host, a host:port or an IPv4 address) and ``blob`` (a bare run of 32 and more
base64 letters with both cases and a digit, not in the path of a link). Credentials have parts: an
identifier, a secret and an endpoint. A candidate's scope is the text ``REACH`` code points to either side
and the group of assignment lines that it stands in, however long; an interval join looks there for
parts of complementary roles. A weak candidate is reported only when one occurs that shares no text with
it, an endpoint or a user only together with a secret. The join sorts the starts and the ends of each
role's intervals and answers every candidate by bisection, so no pairs are formed.

Cases: null text counts as empty; a text without secrets has no spans, n_* of 0 and the hash of
the empty string. Repeated rows give repeated rows. Only the two named columns are read.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import ship

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")     # a run of at least 24 is the leftmost match of [0-9a-f]+ that stands
ASSIGN_LEAST, ACCESS_LEAST = 6, 20

USER = re.compile(r"""\b(?:user(?:name)?|login|client_?id|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@-]{3,}"""
                  r"""|(?<![A-Za-z0-9_.+-])[A-Za-z0-9_.+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+""", re.I | re.A)
# A host:port is a dotted name with a letter or a bare name, and a port of 2 to 5 digits that no text goes on from.
ENDPOINT = re.compile(r"""(?:https?|(?<![A-Za-z0-9+.-])[A-Za-z][A-Za-z0-9+.-]{0,31})://[^\s"'<>]+"""
                      r"""|\b(?:\d{1,3}\.){3}\d{1,3}(?::\d{2,5})?\b"""
                      r"""|(?<![A-Za-z0-9_.-])(?=[A-Za-z0-9.-]{0,253}[A-Za-z])[A-Za-z0-9][A-Za-z0-9-]{0,62}+(?:\.[A-Za-z0-9][A-Za-z0-9-]{0,62}+){0,126}+:\d{2,5}(?![\w.:]*\w)""", re.A)
BLOB = re.compile(r"(?<![A-Za-z0-9+/=_-])[A-Za-z0-9+/]{32,}={0,2}(?![A-Za-z0-9+/=_-])")
MIXED = [re.compile(x) for x in ("[0-9]", "[a-z]", "[A-Z]")]     # a blob has some of each

ORDER = {k: i for i, k in enumerate(("assign", "access", "hex", "user", "endpoint", "blob"))}
ROLE = {"assign": "secret", "hex": "secret", "blob": "secret", "access": "identifier", "user": "identifier", "endpoint": "endpoint"}
#: The roles of which one must lie in a weak candidate's scope.
NEEDS = {"user": ("secret",), "endpoint": ("secret",), "blob": ("identifier", "endpoint")}
REACH = 200
#: Lines in a row that each assign something or hold brackets only: a block of settings.
GROUP = re.compile(r"""(?:^[ \t]*+(?:(?:(?:export[ \t]+|-[ \t]+)?["']?[\w.-]{1,100}+["']?[ \t]*+[:=][^\n]*+|[,; \t]*+[][{}()][][{}(),; \t]*+|\[[^]\n]{1,100}\][ \t]*+)(?:\n|\Z)))++""", re.M)

Span = tuple[int, int, str]     # start, end (exclusive), kind


def base_spans(text: str) -> list[Span]:
    """The base matches, each kind leftmost and without overlaps, failing ones dropped."""
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_LEAST]
    return out + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


def _stands(m: re.Match) -> bool:
    """Whether an endpoint match is one: a host:port needs a name that ends in letters after a dot, or is
    ``localhost``, or a small bare name with a port of four digits that is no year. Headings have none."""
    if "://" in m[0] or m[0][0].isdigit() and not m[0].upper().isupper():
        return True
    host, port = m[0].rsplit(":", 1)
    if "." in host:
        last = host.rsplit(".", 1)[1]
        return len(last) >= 2 and last.isalpha()
    return host == "localhost" or host.islower() and len(port) >= 4 and not (len(port) == 4 and port[:2] in ("19", "20"))


def candidates(text: str, base: list[Span]) -> list[tuple[Span, int]]:
    """The weak candidates, each with the start of its own part: for a URL with a user before its host,
    the host, as what stands before may be the secret that belongs to it."""
    weak, links = [], []
    for m in ENDPOINT.finditer(text):
        if _stands(m):
            at = m[0].find("://")
            host = m.start()
            if at >= 0:
                end = re.search(r"[/?#]|\Z", m[0][at + 3:]).start() + at + 3
                host += m[0].rfind("@", at, end) + 1 if "@" in m[0][at:end] else 0
            weak.append(((m.start(), m.end(), "endpoint"), host))
            links.append((host, m.end()))
    secret = _overlaps([x[:2] for x in base if ROLE[x[2]] == "secret"])
    link = _overlaps(links)
    weak += [((m.start(), m.end(), "blob"), m.start()) for m in BLOB.finditer(text)
             if all(x.search(m[0]) for x in MIXED) and not secret(m.start(), m.end()) and not link(m.start(), m.end())]
    if base or weak:    # an identifier alone has no secret to go with
        weak += [((m.start(), m.end(), "user"), m.start()) for m in USER.finditer(text)]
    return weak


def _overlaps(spans: list[tuple[int, int]]) -> Callable[[int, int], bool]:
    """A test whether any of ``spans`` overlaps an interval: starts sorted, with the greatest end so far."""
    spans = sorted(spans)
    starts, ends = [s for s, _ in spans], list(itertools.accumulate((e for _, e in spans), max))
    return lambda lo, hi: (k := bisect_left(starts, hi)) > 0 and ends[k - 1] > lo


def scopes(text: str) -> Callable[[int, int], tuple[int, int]]:
    """The scope of an interval: ``REACH`` to either side and the settings it stands in."""
    groups = [(m.start(), m.end()) for m in GROUP.finditer(text)]
    starts = [s for s, _ in groups]

    def scope(start: int, end: int) -> tuple[int, int]:
        lo, hi = start - REACH, end + REACH
        k = bisect_right(starts, start) - 1
        if k >= 0 and groups[k][1] >= end:
            lo, hi = min(lo, groups[k][0]), max(hi, groups[k][1])
        return lo, hi
    return scope


def linked_spans(text: str, base: list[Span]) -> list[Span]:
    """Weak candidates with a complementary part in their scope that shares no text with them. A blob
    inside a base match of its own role is that match again and is left out."""
    weak = candidates(text, base)
    if not weak:
        return []
    starts: dict[str, list[int]] = {"secret": [], "identifier": [], "endpoint": []}
    ends: dict[str, list[int]] = {"secret": [], "identifier": [], "endpoint": []}
    for (_, end, kind), start in [*((x, x[0]) for x in base), *weak]:
        starts[ROLE[kind]].append(start)
        ends[ROLE[kind]].append(end)
    if not any(starts[r] for (_, _, k), _ in weak for r in NEEDS[k]):
        return []
    for found in (*starts.values(), *ends.values()):
        found.sort()
    scope = scopes(text)

    def beside(role: str, lo: int, start: int, end: int, hi: int) -> bool:
        """Whether a part of ``role`` ends in (lo, start] or starts in [end, hi)."""
        return (bisect_right(ends[role], start) > bisect_right(ends[role], lo)
                or bisect_left(starts[role], hi) > bisect_left(starts[role], end))

    out = []
    for x, own in weak:
        lo, hi = scope(x[0], x[1])
        if any(beside(role, lo, own, x[1], hi) for role in NEEDS[x[2]]):
            out.append(x)
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], ORDER[x[2]], x[1])))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id, counts of the base kinds, ``base_sha256`` and ``spans``. No shuffle."""
    ship(docs.sparkSession)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, every = [], []
            for t in batch.column(1).to_pylist():
                b = base_spans(t or "")
                base.append(b)
                every.append(joined(b + linked_spans(t or "", b)))
            count = [pa.array([sum(x[2] == k for x in b) for b in base], pa.int64()) for k in ("assign", "access", "hex")]
            sha = [hashlib.sha256(joined(b).encode()).hexdigest() for b in base]
            yield pa.RecordBatch.from_arrays([batch.column(0), *count, pa.array(sha), pa.array(every, pa.string())],
                                             names=["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    schema = f"id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return src.mapInArrow(run, schema).withColumnRenamed("id", id_col)
