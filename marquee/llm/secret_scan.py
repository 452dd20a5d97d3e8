"""Secret scan: fixed patterns, and novelty against zstandard dictionaries.

Base kinds are patterns: an assignment to a name such as ``token``, an access key, a long run of
hexadecimal digits. The method adds spans of kind ``novel``: a word of ``CANDIDATE`` or more
characters, with letters and digits, that follows a sensitive word closely. The surrounding text
and a dictionary of identifiers prime zstandard, and the candidate costs what it adds to the
compressed size. Names and numbers are cheap after such a dictionary; random keys are not. Other
copies of the candidate are left out of its surroundings, so a key that is repeated costs as much as one.
A candidate whose cost is at least ``NOVELTY`` of its length is reported. A base span stays as it
is, and no novel span overlaps one.

Spans are code points, end exclusive, in the order of their starts, then of ``KINDS``.
Defined results: null and empty texts have no spans. Texts are scanned whole.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, functions as F

KINDS = ("assign", "access", "hex", "novel")

# The base patterns, and the least number of characters that count.
ASSIGN = re.compile(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # maximal runs, of 24 digits and more
LEAST = {"assign": 6, "access": 20}
ASSIGNED_NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey")

CANDIDATE = 16
REACH = 40  # characters between the sensitive word and the candidate
AROUND = 256  # characters of surrounding text that prime the compressor
NOVELTY = 0.75
LEVEL = 5
SENSITIVE_WORDS = ("pass", "secret", "token", "key", "credential", "auth", "bearer", "private", "signature", "cookie")
SENSITIVE = re.compile("|".join(SENSITIVE_WORDS), re.IGNORECASE | re.ASCII)
# What "=" parts are words of their own, but for the padding that ends a base64 key.
WORD = re.compile(rf"[A-Za-z0-9+/_.-]{{{CANDIDATE},}}(?:={{1,2}}(?![A-Za-z0-9+/_.=-]))?", re.ASCII)
LONG_RUN = re.compile(rf"[A-Za-z0-9]{{{CANDIDATE},}}", re.ASCII)

# Identifiers that code and configuration are full of.
IDENTIFIERS = " ".join(
    """
    access account address admin algorithm amount application argument array attribute author authorization
    backend base64 begin boolean branch buffer bucket build bytes cache callback certificate channel charset class
    client cluster code collection column command comment commit config configuration connection console constant
    container content context controller cookie count create credential currency database date debug default
    delete deploy description development device digest directory document domain double download element email
    enable encoding encrypt endpoint environment error event example exception execute export expire extension
    false field file filter final float folder font format function gateway generate get group handler hash header
    height hex home host html http https icon identifier image import include index info input insert instance
    integer interface internal invalid item java javascript json key label language length level library license
    limit link list local localhost location lock login logout long manager map master max memory message method
    min mode model module name namespace network node null number object offset option order output package page
    parameter parent parser password path pattern payload permission phone port position post prefix private
    process production profile project property protocol provider proxy public python query queue random range
    read record redirect reference region register release remote remove report repository request require
    resource response result return role root route schema scope script search secret secure select send sequence
    server service session set setting sha256 signature size source ssh staging start state static status storage
    stream string struct style subject submit success suffix system table tag target task template test text
    thread time timeout timestamp title token total transaction transfer true type unicode update upload url user
    username utf-8 uuid valid value variable vector version view void volume warning web width window write xml yaml
    0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 127.0.0.1 0.0.0.0 example.com www.example.org
    """.split()
)


def base_spans(text: str, lower: str) -> list[tuple[str, int, int]]:
    """The matches of the base patterns; ``lower`` is the text in small letters, to rule patterns out quickly."""
    spans = []
    if any(name in lower for name in ASSIGNED_NAMES):
        for m in ASSIGN.finditer(text):
            if len(m.group(1)) >= LEAST["assign"]:
                spans.append(("assign", m.start(), m.end()))
    if "AKIA" in text:
        spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    spans += [("hex", m.start(), m.end()) for m in HEX.finditer(text)]
    return spans


class Novelty:
    """What a string costs after its surroundings, with a dictionary of identifiers."""

    def __init__(self) -> None:
        primed = zstandard.ZstdCompressionDict(IDENTIFIERS.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        primed.precompute_compress(level=LEVEL)
        self.size = zstandard.ZstdCompressor(
            dict_data=primed, level=LEVEL, write_checksum=False, write_content_size=False, write_dict_id=False
        ).compress

    def cost(self, text: str, start: int, end: int) -> float:
        """Compressed bytes that text[start:end] adds to its surroundings, per byte of it."""
        around = [(max(0, start - AROUND), start), (end, min(len(text), end + AROUND))]
        around = "".join(_without_copies(text, start, end, low, high) for low, high in around).encode()
        found = text[start:end].encode()
        return (len(self.size(around + found)) - len(self.size(around))) / len(found)

    def spans(self, text: str, lower: str, taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
        """The costly candidates close behind a sensitive word and apart from the spans already taken."""
        if not any(word in lower for word in SENSITIVE_WORDS):
            return []
        starts, ends = _disjoint(taken)
        out, done = [], 0
        for sensitive in SENSITIVE.finditer(text):
            at, reach = max(done, sensitive.end()), sensitive.end() + REACH + CANDIDATE
            while candidate := WORD.search(text, at, reach):
                start = candidate.start()
                end = at = WORD.match(text, start).end()  # beyond the reach too
                if start == sensitive.end():
                    continue  # the rest of the name that holds the sensitive word
                done = end
                found = text[start:end]
                before = bisect_left(starts, end) - 1
                if before >= 0 and ends[before] > start:
                    continue
                if any(c.isdigit() for c in found) and any(c.isalpha() for c in found) and self.cost(text, start, end) >= NOVELTY:
                    out.append(("novel", start, end))
        return out


def _without_copies(text: str, start: int, end: int, low: int, high: int) -> str:
    """text[low:high] without the copies of text[start:end], with other marks around it or cut by a bound too."""
    found = text[start:end]
    copies = []
    for copy in {found.strip("+/_.=-"), *LONG_RUN.findall(found)} - {""}:
        first, last = max(0, low - len(copy) + 1), high + len(copy) - 1
        while (at := text.find(copy, first, last)) >= 0:
            copies.append((at, at + len(copy)))
            first = at + 1
    out, at = [], low
    for first, last in sorted(copies):
        if first > at:
            out.append(text[at:first])
        at = max(at, last)
    return "".join([*out, text[at:high]])


def _disjoint(spans: list[tuple[str, int, int]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the spans, overlapping ones joined, in order."""
    starts, ends = [], []
    for _, start, end in sorted(spans, key=lambda s: s[1]):
        if ends and start <= ends[-1]:
            ends[-1] = max(ends[-1], end)
        else:
            starts.append(start)
            ends.append(end)
    return starts, ends


def spans_of(text: str | None, novelty: Novelty) -> list[tuple[str, int, int]]:
    """All spans of one text in order."""
    if not text:
        return []
    lower = text.lower()
    spans = base_spans(text, lower)
    spans += novelty.spans(text, lower, spans)
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def find_secrets(text: Column) -> Column:
    """array<struct<kind, start, end>> of the secrets in each text."""

    @F.arrow_udf("array<struct<kind:string,start:int,end:int>>")
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        novelty = Novelty()
        for texts in batches:
            yield pa.array(
                [[{"kind": k, "start": a, "end": b} for k, a, b in spans_of(t.as_py(), novelty)] for t in texts], kind
            )

    return found(text)


def mask_secrets(text: Column, mask: str = "[SECRET]") -> Column:
    """The text with each secret, overlapping ones together, replaced by the mask; null stays null."""

    @F.arrow_udf("string")
    def masked(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        novelty = Novelty()
        for texts in batches:
            yield pa.array([_masked(t.as_py(), novelty, mask) for t in texts], pa.string())

    return masked(text)


def _masked(text: str | None, novelty: Novelty, mask: str) -> str | None:
    spans = spans_of(text, novelty)
    if not spans:
        return text
    out, at = [], 0
    for _, start, end in spans:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


def spans_text(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
