"""Personal data by anchor expansion: an Aho-Corasick automaton finds anchors, local parsers do the rest.

Anchors are the at-sign, ``://`` behind a scheme, a plus with a digit, two digits next to each other or
around a dot, blank or hyphen, and words that announce an identifier. Each kind has a parser that starts
at its anchor, expands to the boundaries and checks what it found. A parser skips anchors inside what it
has already read, so that every text is read in linear time.

Base kinds are ``email``, ``ip``, ``card``, ``phone``; a failing match is dropped and not tried again in
another way. The method adds ``url`` (scheme and authority with user information), ``ip6`` (bracketed
address behind a scheme), ``iban``, ``ssn`` and ``account`` (behind their cue, checked by checksum, ranges
or length). Places are code points, ends exclusive.

Defined results: a null or empty text has no spans; every row is judged by itself, so that repeated rows
and null ids get what their text has; texts are read whole, of any length; spans of different kinds may
overlap, those of one kind do not; extra columns are ignored by ``spans_of`` and kept by ``redact``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache
from ipaddress import AddressValueError, IPv6Address
from itertools import product

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arenamart.llm.common import read

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "url", "ip6", "iban", "ssn", "account")
#: Words that announce an identifier.
CUES = {
    "iban": ("iban",),
    "ssn": ("ssn", "social security"),
    "account": ("account", "acct", "konto", "compte", "cuenta"),
}
DIGITS = "0123456789"
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
USER_HOST = re.compile(r"[^\s/?#@\"'<>]++@[A-Za-z0-9.-]*[A-Za-z0-9](?::[0-9]++)?")
BRACKETED = re.compile(r"\[([0-9A-Fa-f:.]{2,45})\]")
AFTER_CUE = re.compile(r"[ \t]{0,3}[:#=]?[ \t]{0,3}")
IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_BY_LETTER = str.maketrans({c: str(int(c, 36)) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
SSN = re.compile(r"(?:[ \t]{0,3}(?:number|no\.?|nr\.?|#|:|=)){0,3}[ \t]{0,3}(([0-9]{3})-([0-9]{2})-([0-9]{4}))(?![0-9])")
ACCOUNT = re.compile(r"[ \t]{0,3}(?:(?:number|no\.?|nr\.?|num\.?)[ \t]{0,3}[:#=]?|[:#=])[ \t]{0,3}([0-9](?:[ -]?[0-9])++)")
Span = tuple[int, int, int]  # start, number of the kind, end


def _luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2])
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in DIGITS)


class _Reader:
    """Spans of one text; ``behind`` holds, per kind, the place up to which it has read."""

    def __init__(self, text: str):
        self.text, self.found = text, []
        self.behind = dict.fromkeys(KINDS, 0)

    def add(self, kind: str, start: int, end: int) -> None:
        self.found.append((start, KINDS.index(kind), end))

    def left(self, at: int, members: frozenset | str, least: int) -> int:
        while at > least and self.text[at - 1] in members:
            at -= 1
        return at

    def at_sign(self, at: int) -> None:
        start = self.left(at, LOCAL, self.behind["email"])
        if start < at and (host := DOMAIN.match(self.text, at + 1)):
            self.behind["email"] = host.end()
            self.add("email", start, host.end())

    def dotted(self, at: int) -> None:
        """Every four parts of a dotted number, from its first part on."""
        if at < self.behind["ip"]:
            return
        chain = DOTTED.match(self.text, self.left(at, DIGITS, self.behind["ip"]))
        self.behind["ip"], start = chain.end(), chain.start()
        parts = chain[0].split(".")
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in four):
                self.add("ip", start, end)
            start = end + 1

    def number(self, at: int) -> None:
        if at < self.behind["card"]:
            return
        chain = CARD.match(self.text, at)
        self.behind["card"] = chain.end()
        digits = _digits(chain[0])
        if 12 <= len(digits) <= 19 and _luhn(digits):
            self.add("card", at, chain.end())

    def plus(self, at: int) -> None:
        if (found := PHONE.match(self.text, at)) and 9 <= len(_digits(found[0])) <= 15:
            self.add("phone", at, found.end())

    def scheme(self, at: int) -> None:
        start = self.left(at, SCHEME, self.behind["url"])
        while start < at and not self.text[start].isalpha():
            start += 1
        if start == at:
            return
        if found := USER_HOST.match(self.text, at + 3):
            self.behind["url"] = found.end()
            self.add("url", start, found.end())
        elif found := BRACKETED.match(self.text, at + 3):
            try:
                IPv6Address(found[1])
            except AddressValueError:
                return
            self.add("ip6", found.start(1), found.end(1))

    def iban(self, end: int) -> None:
        found = IBAN.match(self.text, AFTER_CUE.match(self.text, end).end())
        while found:
            plain = found[0].replace(" ", "")
            if int((plain[4:] + plain[:4]).translate(_BY_LETTER)) % 97 == 1:
                self.add("iban", found.start(), found.end())
                return
            found = IBAN.match(self.text, found.start(), found.end() - 1)

    def ssn(self, end: int) -> None:
        if found := SSN.match(self.text, end):
            area, group, serial = found[2], found[3], found[4]
            if area not in ("000", "666") and area[0] != "9" and group != "00" and serial != "0000":
                self.add("ssn", found.start(1), found.end(1))

    def account(self, end: int) -> None:
        if (found := ACCOUNT.match(self.text, end)) and 6 <= len(_digits(found[1])) <= 20:
            self.add("account", found.start(1), found.end(1))


@cache
def anchors() -> ahocorasick.Automaton:
    """Anchor -> (name of its parser, length to step back from the anchor's end)."""
    out = ahocorasick.Automaton()
    out.add_word("@", ("at_sign", 1))
    out.add_word("://", ("scheme", 3))
    for a, b in product(DIGITS, DIGITS):
        out.add_word(f"{a}.{b}", ("dotted", 3))
        out.add_word(f"{a}{b}", ("number", 2))
        out.add_word(f"{a} {b}", ("number", 3))
        out.add_word(f"{a}-{b}", ("number", 3))
    for a in DIGITS:
        out.add_word(f"+{a}", ("plus", 2))
    for kind, cues in CUES.items():
        for cue in cues:
            for written in {cue, cue.upper(), cue.title(), cue.capitalize()}:
                out.add_word(written, (kind, 0))
    out.make_automaton()
    return out


def find_spans(text: str | None) -> list[Span]:
    """(start, number of the kind, end), sorted."""
    if not text:
        return []
    reader = _Reader(text)
    for last, (parser, back) in anchors().iter(text):
        getattr(reader, parser)(last + 1 - back)
    return sorted(set(reader.found))


def _span_arrays(texts: list[str | None]) -> pa.Array:
    offsets, starts, kinds, ends = [0], [], [], []
    for text in texts:
        for start, kind, end in find_spans(text):
            starts.append(start)
            kinds.append(KINDS[kind])
            ends.append(end)
        offsets.append(len(starts))
    fields = [pa.array(kinds, pa.string()), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(fields, ["kind", "start", "end"]))


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans = _span_arrays(batch.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), spans], ["doc_id", "spans"])


def spans_of(docs: DataFrame) -> DataFrame:
    """doc_id and spans (array of kind, start, end; by start, then kind) for every document row."""
    span = T.StructType().add("kind", "string").add("start", "long").add("end", "long")
    schema = T.StructType().add("doc_id", docs.schema["doc_id"].dataType).add("spans", T.ArrayType(span))
    return docs.select("doc_id", "text").mapInArrow(_find, schema)


def masked(text: str | None) -> str | None:
    """The text with each span, or run of overlapping ones, replaced by the kind of its first."""
    if not text:
        return text
    out, done = [], 0
    for start, kind, end in find_spans(text):
        if start >= done:
            out += [text[done:start], f"<{KINDS[kind].upper()}>"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def redact(docs: DataFrame) -> DataFrame:
    """All documents with masked texts; other columns as they are."""
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(F.lit(0).alias("_none"), *others).alias("rest"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([masked(t) for t in batch.column("text").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("rest"), texts], ["rest", "text"])

    out = rows.mapInArrow(run, rows.schema)
    return out.select(*[F.col("text") if c == "text" else F.col("rest").getField(c).alias(c) for c in docs.columns])


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def _of_kinds(spans: Column, *kinds: str) -> Column:
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def op13_personal_data(spark, sf_dir: str) -> DataFrame:
    found = spans_of(read(spark, sf_dir, "documents"))
    spans = F.col("spans")
    counts = [F.size(_of_kinds(spans, k)).cast("bigint").alias(f"n_{k}") for k in BASE]
    base = _of_kinds(spans, *BASE)
    return found.select("doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(spans).alias("spans"))
