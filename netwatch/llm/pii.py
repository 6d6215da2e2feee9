"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust the score.

Base kinds, always kept: email, ip (parts up to 255), card (12 to 19 digits, Luhn), phone (+, 9 to 15
digits). The method adds iban (mod 97), national_phone and ssn; the last two are written like many other
numbers, so that a word near them must raise their score to ``ENOUGH``. Added spans never overlap a
base span. Positions are code points, the end exclusive. Each pattern starts at characters that no
other attempt has passed, so that the work is in proportion to the text's length.

Defined results: NULL and empty texts have no spans; equal rows give equal results.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netwatch.llm.tasks import numbered_names, per_text

# Kinds in the order of their listing.
BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "national_phone", "ssn")
# Lengths of an account number with its country code, and those of the countries that fix one.
IBAN_LENGTHS = (15, 34)
COUNTRY_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28,
    "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18,
    "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22,
    "IL": 23, "IQ": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18,
    "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SE": 24,
    "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24,
    "XK": 20,
}

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN_START = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}")
# The rest of a number: as long as its country has it, or as long as it goes.
IBAN_REST = {
    n: re.compile(rf"(?: ?[A-Z0-9]){{{n - 4}}}(?![A-Za-z0-9])") for n in {*COUNTRY_LENGTHS.values()}
}
IBAN_OPEN = re.compile(r"(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
NATIONAL = re.compile(r"(?<![0-9+().-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

# What a span is worth by itself, and what a word of its kind nearby adds or an opposing one takes.
SCORES = {
    "email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "national_phone": 0.3, "ssn": 0.3,
}
CONTEXT = {
    "email": re.compile(r"(?i)\b(?:e-?mail|contact|write)\b"),
    "ip": re.compile(r"(?i)\b(?:ip|address|host|server)\b"),
    "card": re.compile(r"(?i)\b(?:card|visa|credit|debit|payment)\b"),
    "phone": re.compile(r"(?i)\b(?:phone|tel|call|mobile|fax)\b"),
    "iban": re.compile(r"(?i)\b(?:iban|account|bank)\b"),
    "national_phone": re.compile(r"(?i)\b(?:phone|tel|telephone|call|mobile|cell|fax)\b"),
    "ssn": re.compile(r"(?i)\b(?:ssn|social security)\b"),
}
AGAINST = re.compile(r"(?i)\b(?:version|order|invoice|isbn|part|serial|sample)\b")
NEAR = 40
RAISE, LOWER = 0.4, 0.2
ENOUGH = 0.5


class Span(NamedTuple):
    start: int
    kind: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    """Whether the digit sum, with every second digit from the right doubled, ends in 0."""
    values = [int(d) for d in reversed(digits)]
    return (sum(values[::2]) + sum(sum(divmod(2 * v, 10)) for v in values[1::2])) % 10 == 0


def mod97(account: str) -> bool:
    """Whether an account number, its first four characters put last and letters as 10 to 35, leaves 1."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """At each @ the run of local characters before it, if a domain follows."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (domain := DOMAIN.match(text, at + 1)):
            yield start, domain.end()
            done = domain.end()
        else:
            done = at + 1
        at = text.find("@", done)


def ips(text: str) -> Iterator[tuple[int, int]]:
    for match in IP.finditer(text):
        if all(len(p := part.lstrip("0")) <= 3 and int(p or "0") <= 255 for part in match[0].split(".")):
            yield match.span()


def cards(text: str) -> Iterator[tuple[int, int]]:
    for match in CARD.finditer(text):
        start, end = match.span()
        if 12 <= end - start <= 37:
            digits = match[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                yield start, end


def phones(text: str) -> Iterator[tuple[int, int]]:
    if "+" in text:
        for match in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in match[0]) <= 15:
                yield match.span()


def ibans(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for start in IBAN_START.finditer(text):
        rest = IBAN_REST.get(COUNTRY_LENGTHS.get(start[0][:2]), IBAN_OPEN)
        if start.start() >= done and (match := rest.match(text, start.end())):
            account = (start[0] + match[0]).replace(" ", "")
            if IBAN_LENGTHS[0] <= len(account) <= IBAN_LENGTHS[1] and mod97(account):
                yield start.start(), match.end()
                done = match.end()


def matches(pattern: re.Pattern) -> Callable[[str], Iterator[tuple[int, int]]]:
    return lambda text: (match.span() for match in pattern.finditer(text))


FINDERS = (emails, ips, cards, phones, ibans, matches(NATIONAL), matches(SSN))


def scored(text: str, kind: str, start: int, end: int) -> float:
    near = f"{text[max(0, start - NEAR) : start]} {text[end : end + NEAR]}"
    score = SCORES[kind] + RAISE * bool(CONTEXT[kind].search(near)) - LOWER * bool(AGAINST.search(near))
    return min(1.0, max(0.0, round(score, 6)))


def find_spans(text: str) -> list[Span]:
    """All spans of a text by start, then kind."""
    found = []
    for kind in range(len(BASE_KINDS)):
        found += [Span(a, kind, b, scored(text, KINDS[kind], a, b)) for a, b in FINDERS[kind](text)]
    taken = None
    for kind in range(len(BASE_KINDS), len(KINDS)):
        for a, b in FINDERS[kind](text):
            if taken is None:
                taken = bytearray(len(text))
                for span in found:
                    taken[span.start : span.end] = b"\1" * (span.end - span.start)
            score = scored(text, KINDS[kind], a, b)
            if score >= ENOUGH and not any(taken[a:b]):
                found.append(Span(a, kind, b, score))
                taken[a:b] = b"\1" * (b - a)
    return sorted(found)


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span, overlapping ones joined, replaced by its kind."""
    out, at, covered = [], 0, 0
    for span in spans:
        if span.start >= covered:
            out += [text[at : span.start], f"<{KINDS[span.kind].upper()}>"]
        covered = max(covered, span.end)
        at = covered
    return "".join([*out, text[at:]])


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in spans)


def _decoded(values: list) -> list[str]:
    return [value.decode("utf-8", "replace") if value else "" for value in values]


def find_pii(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns and ``pii``: the spans of each text with kind, start, end and score."""

    def make() -> Callable[[list], dict[str, list]]:
        return lambda values: {
            "pii": [
                [{"kind": KINDS[s.kind], "start": s.start, "end": s.end, "score": s.score} for s in find_spans(t)]
                for t in _decoded(values)
            ]
        }

    return per_text(docs, keep, "pii array<struct<kind:string,start:int,end:int,score:double>>", make, text)


def count_pii(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns, a count per base kind, the digest of the base spans, and all spans in one string."""

    def make() -> Callable[[list], dict[str, list]]:
        def work(values: list) -> dict[str, list]:
            found = [find_spans(t) for t in _decoded(values)]
            base = [[s for s in spans if s.kind < len(BASE_KINDS)] for spans in found]
            out = {
                f"n_{name}": [sum(s.kind == kind for s in spans) for spans in base]
                for kind, name in enumerate(BASE_KINDS)
            }
            out["base_sha256"] = [hashlib.sha256(listed(spans).encode()).hexdigest() for spans in base]
            out["spans"] = [listed(spans) for spans in found]
            return out

        return work

    counts = ", ".join(f"n_{name} long" for name in BASE_KINDS)
    return per_text(docs, keep, f"{counts}, base_sha256 string, spans string", make, text)


def mask_pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns as they are, but for the spans of the text, which name their kind instead; NULL stays."""
    own = numbered_names(docs)
    at = docs.columns.index(text)
    others = [name for i, name in enumerate(own.columns) if i != at]

    def make() -> Callable[[list], dict[str, list]]:
        def work(values: list) -> dict[str, list]:
            return {
                "_masked": [
                    None if value is None else masked(t, find_spans(t))
                    for value, t in zip(values, _decoded(values))
                ]
            }

        return work

    out = per_text(own, others, "_masked string", make, f"_c{at}")
    return out.select(*(F.col("_masked") if i == at else name for i, name in enumerate(own.columns))).toDF(*docs.columns)
