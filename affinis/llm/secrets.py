"""Secret scans with multipart credential linking.

Base spans (assignments, access identifiers, long hexadecimal runs) stand by themselves. Weak candidates (bare high-entropy
strings, account identifiers, endpoints) are everyday text alone; they are reported only where the complementary parts of a
credential lie in the same scope, found by an interval join of the parts, sorted by position, within each text.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinis.llm.common import holding

#: Code points that may lie between the parts of one credential.
SCOPE = 160
#: Rows whose texts a worker holds at once.
SLICE = 512
#: Kinds in the order in which spans with the same start are listed: base, then linked.
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "secret", "account", "endpoint")

# The base patterns.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
#: Words without which ASSIGN cannot match, in lower case.
HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")

SECRET = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{32,}={0,2}(?![A-Za-z0-9+/_=-])")
ACCOUNT = re.compile(r"\b(?:user(?:name)?|login|account|client_?id|access_?key_?id)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9_.@-]{3,}", re.ASCII | re.IGNORECASE)
ENDPOINT = re.compile(r"\b(?:https?|ftp|ssh|postgres(?:ql)?|mysql|mongodb|redis|amqp|jdbc:[a-z]+)://[^\s\"'<>]+", re.ASCII | re.IGNORECASE)

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """Spans that need no company, leftmost and non-overlapping per kind."""
    spans = []
    low = text.lower()
    if any(hint in low for hint in HINTS):
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    return spans


class Parts:
    """Disjoint spans of one role in order, and whether one of them lies near an interval."""

    def __init__(self, spans: list[Span]):
        self.spans = sorted((a, b) for _, a, b in spans)
        self.ends = [b for _, b in self.spans]
        for k in range(1, len(self.ends)):  # spans of two kinds may overlap
            self.ends[k] = max(self.ends[k], self.ends[k - 1])

    def near(self, start: int, end: int, scope: int) -> bool:
        """Whether a span begins by end + scope and ends from start - scope on."""
        k = bisect_left(self.ends, start - scope)
        return k < len(self.spans) and self.spans[k][0] <= end + scope

    def beside(self, start: int, end: int, scope: int) -> bool:
        """Whether a span that is near does not overlap [start, end): a part is no company for what it lies in."""
        k = bisect_left(self.ends, start - scope)
        while k < len(self.spans) and self.spans[k][0] <= end + scope:
            if self.spans[k][0] >= end or start - scope <= self.spans[k][1] <= start:
                return True
            k += 1
        return False


def linked_spans(text: str, base: list[Span], scope: int = SCOPE) -> list[Span]:
    """Weak candidates whose complementary parts lie in scope: a secret needs an identifier, an account a secret, an endpoint both."""
    taken = Parts(base)

    def candidates(kind: str, pattern: re.Pattern) -> list[Span]:
        return [(kind, *m.span()) for m in pattern.finditer(text) if not taken.near(m.start() + 1, m.end() - 1, 0)]

    access, accounts = [x for x in base if x[0] == "access"], candidates("account", ACCOUNT)
    if not (access or accounts):
        return []
    secrets = [x for x in candidates("secret", SECRET) if _mixed(text[x[1] : x[2]])]
    endpoints = candidates("endpoint", ENDPOINT) if "://" in text else []
    identifiers = Parts(access + accounts)
    known = Parts([x for x in base if x[0] != "access"] + secrets)
    out = [x for x in secrets if identifiers.beside(*x[1:], scope)]
    out += [x for x in accounts if known.beside(*x[1:], scope)]
    out += [x for x in endpoints if identifiers.beside(*x[1:], scope) and known.beside(*x[1:], scope)]
    return out


def _mixed(token: str) -> bool:
    """Whether a token has lower-case and upper-case letters and digits, as random ones do."""
    return token.lower() != token and token.upper() != token and any(c.isdigit() for c in token)


def find_spans(text: str, scope: int = SCOPE) -> list[Span]:
    """All spans of a text by start, then kind."""
    base = base_spans(text)
    return sorted(base + linked_spans(text, base, scope), key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def listed(spans: list[Span]) -> str:
    """kind:start:end, comma-joined."""
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with every stretch of spans replaced by its first span's kind in brackets."""
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def scan(docs: DataFrame, scope: int = SCOPE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, redacted) of every whole text; no shuffle.

    ``redacted`` is the text without its spans, null where there are none. Null and empty texts have no spans; repeated rows
    are scanned each; an empty table gives no rows; a null doc_id stays null; further columns are ignored. Every step is
    linear in the text or n log n in its candidates.
    """
    names = ["doc_id", *(f"n_{k}" for k in BASE), "base_sha256", "spans", "redacted"]

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column(1):
                text = value.as_py() or ""
                spans = find_spans(text, scope)
                base = [x for x in spans if x[0] in BASE]
                counts = [sum(x[0] == k for x in base) for k in BASE]
                digest = hashlib.sha256(listed(base).encode()).hexdigest()
                rows.append((*counts, digest, listed(spans), redacted(text, spans) if spans else None))
            kinds = [pa.int64()] * len(BASE) + [pa.string()] * 3
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.record_batch([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds))], names)

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(
        scanned, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, redacted string"
    )


def redact(docs: DataFrame, scope: int = SCOPE, text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """docs with every span of the text replaced by its kind in brackets, and the text's length anew; no shuffle.

    Rows without spans, null texts included, pass unchanged; a table without the length column passes without it.
    """
    names = docs.columns

    def changed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holding("secrets", lambda: None)
        for batch in (whole.slice(at, SLICE) for whole in batches for at in range(0, whole.num_rows, SLICE)):
            columns, lengths = list(batch.columns), {}
            texts = batch.column(names.index(text_col)).to_pylist()
            for k, text in enumerate(texts):
                if text and (spans := find_spans(text, scope)):
                    texts[k] = redacted(text, spans)
                    lengths[k] = len(texts[k])
            if lengths:
                columns[names.index(text_col)] = pa.array(texts, batch.schema.field(names.index(text_col)).type)
                if length_col in names:
                    at = names.index(length_col)
                    old = columns[at].to_pylist()
                    columns[at] = pa.array([lengths.get(k, n) for k, n in enumerate(old)], batch.schema.field(at).type)
            yield pa.record_batch(columns, schema=batch.schema)

    return docs.mapInArrow(changed, docs.schema)
