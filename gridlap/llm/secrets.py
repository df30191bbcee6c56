"""Secret scans with multipart credential linking.

Base patterns (assignments, access identifiers, long hexadecimal runs) are reported as they stand. Other parts of
a credential are weak by themselves: account names, unlabelled random-looking strings, endpoints. A scope is the
interval of text between two blank lines; parts are joined to the scopes that hold them, in one sweep over both in
order of place, and a weak part is reported if its scope has the complementary ones: a random string needs an access
identifier or account, an account needs a secret (an assignment, hexadecimal run or random string), an endpoint needs
both. No part crosses a blank line, so each has one scope, however far apart in it the parts lie.

Spans are in code points, end exclusive. A weak part that overlaps a stronger one (base, then endpoint and account,
then random) isn't a candidate.

Defined cases: a null text counts as empty; repeated rows each give a row; an empty table gives an empty result.
Only doc_id and text are read; `redact` keeps all columns.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlap.llm.common import map_batches

#: In the order in which spans with one start are listed.
KINDS = ("assign", "access", "hex", "account", "random", "endpoint")
ASSIGN = re.compile(r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: A maximal run of 32 or more; a shorter one is no match to keep.
HEX = re.compile(r"[0-9a-f]{32,}")
LONG = re.compile(r"[A-Za-z0-9+/=_-]{20,}")
ACCOUNT = re.compile(r"""(?ai:user(?:name)?|login|account|client_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}""")
#: The scheme (group 1) begins at a border of its letters and gives none back, so a long run of letters is read once.
ENDPOINT = re.compile(r"""(?<![a-z0-9+])[0-9+]*+([a-z][a-z0-9+]*+://[^\s"'<>]+)""")
#: A blank line, after a line end of either kind.
SCOPE = re.compile(r"\n[ \t\r]*\n")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    lower = text.lower()
    out: list[Span] = []
    if any(x in lower for x in ("passw", "secret", "token", "key")):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    return out + [("hex", *m.span()) for m in HEX.finditer(text)]


def _random(s: str) -> bool:
    return len(set(s)) >= 10 and any(c.isupper() for c in s) and any(c.islower() for c in s) and any(c.isdigit() for c in s)


class _Cover:
    """Disjoint intervals that together cover the given spans."""

    def __init__(self, spans: list[Span]) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []
        for s, e in sorted((s, e) for _, s, e in spans):
            if self.ends and s <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], e)
            else:
                self.starts.append(s)
                self.ends.append(e)

    def free(self, start: int, end: int) -> bool:
        at = bisect_left(self.starts, end)
        return at == 0 or self.ends[at - 1] <= start


def linked_spans(text: str, base: list[Span]) -> list[Span]:
    """Weak candidates whose counterparts are in their scope."""
    accounts = [("account", *m.span()) for m in ACCOUNT.finditer(text)] if ":" in text or "=" in text else []
    if not base and not accounts:
        return []
    endpoints = [("endpoint", *m.span(1)) for m in ENDPOINT.finditer(text)] if "://" in text else []
    strong = _Cover(base)
    accounts = [x for x in accounts if strong.free(x[1], x[2])]
    taken = _Cover([*base, *endpoints, *accounts])
    randoms = [("random", *m.span()) for m in LONG.finditer(text) if _random(m[0]) and taken.free(*m.span())]
    if not (randoms or accounts or endpoints):
        return []
    out: list[Span] = []
    breaks, at, scope = [*(m.start() for m in SCOPE.finditer(text)), len(text)], 0, []
    for span in sorted([*base, *accounts, *randoms, *endpoints], key=lambda x: x[1]):
        if span[1] >= breaks[at]:
            out += _complete(scope)
            at, scope = bisect_right(breaks, span[1], at), []
        scope.append(span)
    return out + _complete(scope)


def _complete(scope: list[Span]) -> list[Span]:
    """The weak parts of one scope that have their counterparts in it."""
    there = {k for k, _, _ in scope}
    identifier, secret = bool(there & {"access", "account"}), bool(there & {"assign", "hex", "random"})
    met = {"account": secret, "random": identifier, "endpoint": identifier and secret}
    return [x for x in scope if met.get(x[0])]


def all_spans(text: str) -> tuple[list[Span], list[Span]]:
    """The base spans, and these with the linked ones, each by start and then kind."""
    order = lambda x: (x[1], KINDS.index(x[0]))
    base = sorted(base_spans(text), key=order)
    return base, sorted(base + linked_spans(text, base), key=order)


def _said(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""

    def make():
        def one(batch):
            out = {"doc_id": batch.column("doc_id"), "n_assign": [], "n_access": [], "n_hex": [], "base_sha256": [], "spans": []}
            for text in batch.column("text").to_pylist():
                base, every = all_spans(text or "")
                for kind in KINDS[:3]:
                    out[f"n_{kind}"].append(sum(x[0] == kind for x in base))
                out["base_sha256"].append(hashlib.sha256(_said(base).encode()).hexdigest())
                out["spans"].append(_said(every))
            return out

        return one

    return map_batches(docs.select(F.col("doc_id").cast("long"), "text"), make, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redacted(text: str | None, mark: str = "[SECRET]") -> str | None:
    """The text with every span, or run of overlapping spans, replaced by the mark."""
    if not text or not (spans := all_spans(text)[1]):
        return text
    out, at = [], 0
    for _, s, e in spans:
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """docs with the secrets in text replaced; all rows and columns stay."""
    import pyarrow as pa

    def run(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                at = batch.schema.get_field_index("text")
                text = pa.array([redacted(t) for t in batch.column(at).to_pylist()], batch.schema.field(at).type)
                yield batch.set_column(at, batch.schema.field(at), text)

    return docs.mapInArrow(run, docs.schema)
