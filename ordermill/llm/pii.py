"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass over a text: at-signs,
plus signs, digits, address schemes and cues of identifiers. A local parser
expands each anchor to the boundaries of the span it belongs to and validates
it. Cues, schemes and prefixes count in any case. Offsets are code points, ends exclusive. Per kind, spans are leftmost and
do not overlap; a span that fails validation is dropped whole.
"""

from __future__ import annotations

import re

import ahocorasick
import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import text_of

BASE_KINDS = ("email", "ip", "card", "phone")
MORE_KINDS = ("url", "account", "secret")
KINDS = BASE_KINDS + MORE_KINDS
# Fixed values, in lower case: address schemes; cues before an account number or a secret; key prefixes.
SCHEMES = ("http://", "https://", "ftp://", "mailto:")
ACCOUNT_CUES = ("iban", "account", "acct", "ssn")
SECRET_CUES = ("password", "passwd", "passphrase", "pwd", "api_key", "apikey", "api-key", "api key", "secret")
WEAK_CUES = ("token", "key", "bearer", "credential", "authorization")      # ordinary words, too: see weak()
KEY_PREFIXES = ("akia",)
LONGEST_NUMBER = 34      # digits of an account number; a longer run may be several
# Characters of an IBAN by country.
LENGTHS = {country: n for n, countries in {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU",
    31: "MT SC", 32: "LC", 33: "RU"}.items() for country in countries.split()}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_GROUPED = re.compile(r"[0-9](?:[\x20-]?[0-9])*")
_DIALLED = re.compile(r"\+[0-9][\x20().0-9-]+")
_ADDRESS = re.compile(r"[^\s<>\"'`{}|\\^]+")
_CUED = re.compile(r"[\"'`]?(?:[\s_-]*(?i:no\.?|number|nr\.?|#))?[\"'`]?\s*[:=#]?\s*[\"'`]?")
_IBAN = re.compile(r"[A-Za-z]{2}[0-9]{2}(?:[\x20-]?[A-Za-z0-9]){10,30}")
_NUMBER = re.compile(r"[0-9](?:[\x20-]?[0-9])*(?![A-Za-z0-9])")
_UNSPACED = re.compile(r"[0-9](?:-?[0-9])*")
_GIVEN = re.compile(r"[\"'`]?\s*(?:=>|:=|[:=])\s*(?:(?i:bearer|basic)\s+)?")
_BEARER = re.compile(r"\s+")
_QUOTED = re.compile(r"([\"'`])((?:(?!\1)[^\\\n]|\\.){6,})\1")
_SECRET = re.compile(r"[\"'`]?(\S{6,})")
_ALNUM = re.compile("[A-Za-z0-9]")
_ASCII_LOWER = {c: c + 32 for c in range(65, 91)}
_KEY = re.compile(r"AKIA[A-Z0-9]{16}(?![A-Za-z0-9])")


def _automaton():
    found = ahocorasick.Automaton()
    for word, kind in [("@", "at"), ("+", "plus"), *[(str(d), "digit") for d in range(10)],
                       *[(s, "scheme") for s in SCHEMES], *[(c, "account") for c in ACCOUNT_CUES],
                       *[(c, "secret") for c in SECRET_CUES], *[(c, "weak") for c in WEAK_CUES],
                       *[(k, "key") for k in KEY_PREFIXES]]:
        found.add_word(word, (kind, len(word)))
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) << (k & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


class Scanner:
    """Finds the spans of one text after another."""

    def __init__(self):
        self.automaton = _automaton()

    def spans(self, text: str) -> list[tuple[int, int, str]]:
        """(start, end, kind) by start, then kind as listed."""
        out: list[tuple[int, int, str]] = []
        done = dict.fromkeys(("email", "ip", "card", "phone", "url", "account", "secret"), 0)
        low = text.lower()
        if len(low) != len(text):               # offsets must be those of the text
            low = text.translate(_ASCII_LOWER)
        for last, (anchor, size) in self.automaton.iter(low):
            at = last + 1 - size
            if anchor == "digit":
                if at >= done["ip"]:
                    done["ip"] = self.dotted(text, at, out)
                if at >= done["card"]:
                    done["card"] = self.grouped(text, at, out)
            elif anchor == "at":
                done["email"] = self.email(text, at, done["email"], out)
            elif anchor == "plus":
                if at >= done["phone"]:
                    done["phone"] = self.dialled(text, at, done["phone"], out)
            elif anchor == "scheme":
                if at >= done["url"]:
                    done["url"] = self.address(text, at, last + 1, out)
            elif anchor == "key":
                got = _KEY.match(text, at)
                if got and at >= done["secret"] and not text[at - 1:at].isalnum():
                    out.append((at, got.end(), "secret"))
                    done["secret"] = got.end()
            elif anchor == "account":
                done["account"] = self.account(text, last + 1, done["account"], out)
            else:
                done["secret"] = self.given(text, at, last + 1, anchor, done["secret"], out)
        out.sort(key=lambda s: (s[0], KINDS.index(s[2])))
        return out

    @staticmethod
    def email(text: str, at: int, free: int, out: list) -> int:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if not domain:
            return free
        out.append((start, domain.end(), "email"))
        return domain.end()

    @staticmethod
    def dotted(text: str, at: int, out: list) -> int:
        """A chain of numbers and dots, four numbers at a time."""
        chain = _DOTTED.match(text, at)
        parts = chain[0].split(".")
        for k in range(0, len(parts) - 3, 4):
            end = at + sum(map(len, parts[k:k + 4])) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts[k:k + 4]):
                out.append((at, end, "ip"))
            at = end + 1
        return chain.end()

    @staticmethod
    def grouped(text: str, at: int, out: list) -> int:
        """Digits with single blanks or hyphens between them."""
        chain = _GROUPED.match(text, at)
        if 12 <= chain.end() - at <= 37:
            digits = chain[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((at, chain.end(), "card"))
        return chain.end()

    @staticmethod
    def dialled(text: str, at: int, free: int, out: list) -> int:
        """From a plus and a digit to the last digit of the run."""
        run = _DIALLED.match(text, at)
        if not run:
            return free
        body = run[0].rstrip(" ().-")
        if len(body) < 4:                # nothing between the first and the last digit
            return free
        if 9 <= sum(c.isdigit() for c in body) <= 15:
            out.append((at, at + len(body), "phone"))
        return at + len(body)

    @staticmethod
    def address(text: str, at: int, after: int, out: list) -> int:
        rest = _ADDRESS.match(text, after)
        body = rest[0].rstrip(".,;:!?)]") if rest else ""
        if not body or not body[0].isalnum():
            return at
        out.append((at, after + len(body), "url"))
        return after + len(body)

    @staticmethod
    def account(text: str, after: int, free: int, out: list) -> int:
        """After a cue an IBAN by its check digits, else six digits or more, at
        any length; single blanks or hyphens may stand between groups. Blanks
        in a run longer than any account number part several numbers, if the
        first has six digits itself: each that has is a span."""
        start = _CUED.match(text, after).end()
        if start < free:
            return free
        got = _IBAN.match(text, start)
        if got:
            # ends before a separator or another sign; that of the country's length first, then the longest
            kept = [k for k in range(start, got.end()) if text[k] not in " -"]
            own = LENGTHS.get(text[start:start + 2].upper())
            for n in sorted(range(14, len(kept) + 1), key=lambda n: (n != own, -n)):
                end = kept[n - 1] + 1
                if not _ALNUM.match(text, end) and iban("".join(text[k] for k in kept[:n])):
                    out.append((start, end, "account"))
                    return end
            return free
        got = _NUMBER.match(text, start)
        if got and sum(c.isdigit() for c in got[0]) > LONGEST_NUMBER:
            several = [p for p in _UNSPACED.finditer(text, start, got.end()) if sum(c.isdigit() for c in p[0]) >= 6]
            if several and several[0].start() == start:
                out += [(*p.span(), "account") for p in several]
                return several[-1].end()
        if not got or sum(c.isdigit() for c in got[0]) < 6:
            return free
        out.append((start, got.end(), "account"))
        return got.end()

    @staticmethod
    def given(text: str, at: int, after: int, anchor: str, free: int, out: list) -> int:
        """The value given to a cue: what its quotes hold, else to the next blank."""
        sign = _GIVEN.match(text, after)
        if not sign and text[at:after].lower() == "bearer":
            sign = _BEARER.match(text, after)
        if not sign or sign.end() < free:
            return free
        value = _QUOTED.match(text, sign.end())
        span = value.span(2) if value else None
        if not value:
            value = _SECRET.match(text, sign.end())
            span = value.span(1) if value else None
        if not span or anchor == "weak" and not weak(text, at, *span):
            return free
        out.append((*span, "secret"))
        return span[1]


def weak(text: str, at: int, a: int, b: int) -> bool:
    """Whether a cue that is an ordinary word, too, counts: it starts a word or
    a part of a name (api_key, apiKey; any place for token), and its value has
    a digit or sixteen characters."""
    part = text[at] in "tT" or not text[at - 1:at].isalpha() or text[at - 1].islower() and text[at].isupper()
    return part and (b - a >= 16 or any(c.isdigit() for c in text[a:b]))


def iban(number: str) -> bool:
    """Check digits of an IBAN without separators."""
    turned = number[4:] + number[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


_OUT = pa.schema([("doc_id", pa.int64()), *[(f"n_{k}", pa.int64()) for k in BASE_KINDS],
                  ("base_sha256", pa.string()), ("spans", pa.string()), ("n_more", pa.int64())])


def _scan(batches):
    scanner = Scanner()
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            spans = scanner.spans(text)
            kinds = [s[2] for s in spans]
            name = [f"{k}:{a}:{b}" for a, b, k in spans]
            base = ",".join(n for n, k in zip(name, kinds) if k in BASE_KINDS)
            counts = {f"n_{k}": kinds.count(k) for k in BASE_KINDS}
            rows.append({"doc_id": doc_id, **counts, "base_sha256": hashlib.sha256(base.encode()).hexdigest(),
                         "spans": ",".join(name), "n_more": len(spans) - sum(counts.values())})
        yield pa.RecordBatch.from_pylist(rows, _OUT)


def find_pii(docs: DataFrame) -> DataFrame:
    """A row per row of ``docs`` (``doc_id``, ``text``; others ignored): counts
    of the base kinds, ``spans`` (kind:start:end, comma-joined, by start, then
    kind), the hex SHA-256 of the base spans alone, and the number of further
    ones (addresses, accounts, secrets). Null text is empty and has no span."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    return rows.mapInArrow(_scan, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                                  "base_sha256 string, spans string, n_more long")


def redact(text: str, spans: str) -> str:
    """``text`` with each span replaced by its kind in brackets; overlapping
    spans become one, named after the first."""
    out, at = [], 0
    for item in filter(None, spans.split(",")):
        kind, a, b = item.split(":")
        a, b = int(a), int(b)
        if a >= at:
            out += [text[at:a], f"[{kind}]"]
        at = max(at, b)
    return "".join(out) + text[at:]
