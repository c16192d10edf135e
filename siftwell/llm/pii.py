"""8. PII: patterns propose spans, checksums confirm them, nearby context words adjust the score.

The base kinds are email, ip, card and phone, each leftmost and non-overlapping in its kind. The method
adds what the base patterns drop or don't know: card and phone numbers that a neighbouring number hid, phones
without a country code, IBANs (mod 97), national ids, IPv6 addresses, access keys, tokens of known providers, JSON
web tokens, private keys and credentials. Each kind starts from a score; within `NEAR` characters, a word that goes
with the kind raises it by STEP, and one that speaks against it (an order number, a version, a sample) lowers it.
Added spans under `ACCEPT` are dropped, those failing a checksum never pass; of those that overlap, the one with the
higher score stays, then the earlier one. Base spans stay, whatever their score.

Null and empty texts: no spans. Texts are read whole; offsets are code points. Repeated rows and ids: a row
each. Other columns are ignored by find_pii, whatever their names, and pass through redact_pii. Time and memory are in
proportion to a text's length, whatever it holds. Empty table: no rows.
"""

from __future__ import annotations

import base64
import hashlib
import ipaddress
import json
import re
from collections.abc import Callable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.llm.common import map_arrow, table

KINDS = ["email", "ip", "card", "phone", "iban", "national_id", "ipv6", "access_key", "provider_token", "web_token", "private_key", "credential"]
NEAR, ACCEPT, STEP = 40, 0.5, 0.25

_LOCAL_SET = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Possessive, and begun only where a run begins: a match that fails at a run's first digit fails at all of them.
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_DIGITS = re.compile(r"[0-9]+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")

_CARD_ALONE = re.compile(r"(?<![0-9])[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}(?![0-9])")
_PHONE_ALONE = re.compile(r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-][0-9]{2,4}){1,3}(?![0-9])")
_PHONE_LOCAL = re.compile(r"(?<![0-9+(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9.-])")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
_NATIONAL = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_IPV6 = re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![0-9A-Za-z:.])")
_ACCESS = re.compile(r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[A-Z0-9]{16}(?![A-Za-z0-9])")
_PROVIDER = re.compile(r"(?<![A-Za-z0-9])(?:gh[pousr]_[A-Za-z0-9]{36,}|github_pat_[A-Za-z0-9_]{22,}|glpat-[A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}|[sr]k_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35}|npm_[A-Za-z0-9]{36})(?![A-Za-z0-9])")
_WEB_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{5,}\.[A-Za-z0-9_-]{5,}\.[A-Za-z0-9_-]*")
_KEY_BEGIN = re.compile(r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----")
_KEY_END = re.compile(r"(?=(-----END (?:[A-Z]+ )*PRIVATE KEY-----))")
_NO_KEY = re.compile(r"[^A-Za-z0-9+/=\s:,.-]")
_CREDENTIAL = re.compile(r"(?i:\b(?:password|passwd|pwd|secret|token|api[_-]?key)\b)[\"']?\s{0,3}[=:]\s{0,3}[\"']?([A-Za-z0-9+/_.!@#$%^&*-]{8,})")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def is_card(text: str) -> bool:
    digits = _NO_DIGIT.sub("", text)
    return 12 <= len(digits) <= 19 and luhn(digits)


def cards(text: str) -> Iterator[tuple[int, int]]:
    """As ``[0-9]([\\x20-]?[0-9])+`` finds them, those that are cards: runs of digits with one space or hyphen between."""
    start = end = digits = 0
    for m in _DIGITS.finditer(text):
        a, b = m.span()
        if not (digits and a - end == 1 and text[end] in " -"):
            if 12 <= digits <= 19 and is_card(text[start:end]):
                yield start, end
            start, digits = a, 0
        end, digits = b, digits + b - a
    if 12 <= digits <= 19 and is_card(text[start:end]):
        yield start, end


def private_keys(text: str) -> Iterator[tuple[int, int]]:
    """Headers of private keys, with all up to the next end where only a key's characters lie between."""
    ends, other, at, k = [m.span(1) for m in _KEY_END.finditer(text)], -1, 0, 0
    while m := _KEY_BEGIN.search(text, at):
        a, at = m.span()
        if other < at:
            found = _NO_KEY.search(text, at)
            other = found.start() if found else len(text)
        while k < len(ends) and ends[k][0] < at:
            k += 1
        if k < len(ends) and ends[k][0] <= other:
            at = ends[k][1]
        yield a, at


def is_phone(text: str) -> bool:
    return 9 <= len(_NO_DIGIT.sub("", text)) <= 15


def is_ip(text: str) -> bool:
    return all(len(x.lstrip("0")) <= 3 and int(x) <= 255 for x in text.split("."))


def is_iban(text: str) -> bool:
    x = text.replace(" ", "")
    return 15 <= len(x) <= 34 and int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97 == 1


def is_national(text: str) -> bool:
    a, b, c = text.split("-")
    return a not in ("000", "666") and a < "900" and b != "00" and c != "0000"


def is_ipv6(text: str) -> bool:
    try:
        found = ipaddress.IPv6Address(text)
    except ValueError:
        return False
    return text.count(":") > 2 and not found.is_unspecified and not found.is_loopback


def is_web_token(text: str) -> bool:
    head = text.split(".")[0]
    try:
        found = json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except ValueError:
        return False
    return isinstance(found, dict) and "alg" in found


def is_secret(text: str) -> bool:
    """Varied enough for no word: digits or signs among letters, or both cases inside it."""
    mixed = bool(_DIGIT.search(text)) or bool(re.search(r"[a-z][A-Z]", text)) or bool(re.search(r"[A-Za-z][+/_!@#$%^&*][A-Za-z]", text))
    return mixed and len(set(text)) >= 5


class Rule(NamedTuple):
    """A kind's proposals, what confirms them, and what speaks for and against them."""

    kind: int
    propose: Callable[[str], Iterator[tuple[int, int]]]
    right: Callable[[str], bool]
    score: float
    needs: str  # a text without it has none
    raising: re.Pattern
    lowering: re.Pattern


def words(*found: str) -> re.Pattern:
    return re.compile(rf"(?<![^\W_])(?:{'|'.join(found)})(?![^\W_])") if found else re.compile(r"(?!)")


_SAMPLE = ("example", "sample", "dummy", "placeholder", "fictitious", "fake")
_NUMBER = ("order", "invoice", "tracking", "isbn", "serial", "reference", "article", "version", "release")
_ANY = lambda x: True
_CONTEXT = {
    "email": (words("e-?mail", "mail", "contact", "write"), words("noreply", "no-reply", *_SAMPLE)),
    "ip": (words("ip", "address", "host", "server", "client", "login"), words("version", "release", "section", "chapter", "build", *_SAMPLE)),
    "card": (words("card", "visa", "mastercard", "credit", "debit", "payment", "carte", "karte", "tarjeta"), words(*_NUMBER, *_SAMPLE)),
    "phone": (words("phone", "tel", "call", "mobile", "fax", "telefon", "tel[eé]fono", "t[eé]l[eé]phone", "whatsapp"), words(*_NUMBER, *_SAMPLE)),
    "iban": (words("iban", "account", "bank", "konto", "compte", "cuenta"), words(*_SAMPLE)),
    "national_id": (words("ssn", "social", "security", "national", "taxpayer"), words(*_NUMBER, *_SAMPLE)),
    "ipv6": (words("ip", "ipv6", "address", "host", "server", "client"), words("mac", "time", "ratio", *_SAMPLE)),
    "access_key": (words("aws", "key", "access", "secret"), words(*_SAMPLE)),
    "provider_token": (words("token", "key", "secret", "auth"), words(*_SAMPLE)),
    "web_token": (words("token", "bearer", "jwt", "auth", "authorization"), words(*_SAMPLE)),
    "private_key": (words("key", "ssh", "rsa", "pem"), words(*_SAMPLE)),
    "credential": (words("login", "user", "username", "account", "credentials?"), words("your", "changeme", "choose", *_SAMPLE)),
}
BASE_SCORES = (0.8, 0.6, 0.8, 0.7)


def _matches(pattern: re.Pattern) -> Callable[[str], Iterator[tuple[int, int]]]:
    """The spans of a pattern's group 1 where it has one."""
    return lambda text: (m.span(pattern.groups and 1) for m in pattern.finditer(text))


def _rule(kind: str, pattern: re.Pattern | Callable, right: Callable[[str], bool], score: float, needs: str = "") -> Rule:
    return Rule(KINDS.index(kind), _matches(pattern) if isinstance(pattern, re.Pattern) else pattern, right, score, needs, *_CONTEXT[kind])


RULES = [
    _rule("card", _CARD_ALONE, is_card, 0.6), _rule("phone", _PHONE_ALONE, is_phone, 0.6, "+"), _rule("phone", _PHONE_LOCAL, _ANY, 0.3),
    _rule("iban", _IBAN, is_iban, 0.8), _rule("national_id", _NATIONAL, is_national, 0.3, "-"), _rule("ipv6", _IPV6, is_ipv6, 0.6, ":"),
    _rule("access_key", _ACCESS, _ANY, 0.8, "IA"), _rule("provider_token", _PROVIDER, _ANY, 0.9), _rule("web_token", _WEB_TOKEN, is_web_token, 0.8, "eyJ"),
    _rule("private_key", private_keys, _ANY, 0.9, "PRIVATE KEY"), _rule("credential", _CREDENTIAL, is_secret, 0.6),
]


def emails(text: str) -> list[tuple[int, int]]:
    """As the pattern finds them: a match is the whole run before an @ and the domain after it."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL_SET:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((start, end := m.end()))
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, index of the kind, end), sorted."""
    out = [(a, 0, b) for a, b in emails(text)]
    if _DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if is_ip(m[0])]
        out += [(a, 2, b) for a, b in cards(text)]
        out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if is_phone(m[0])]
    return sorted(out)


def adjusted(text: str, a: int, b: int, score: float, raising: re.Pattern, lowering: re.Pattern) -> float:
    """The score after a look at the words to either side."""
    near = f"{text[max(0, a - NEAR) : a]} {text[b : b + NEAR]}".lower()
    score += STEP * (raising.search(near) is not None) - STEP * (lowering.search(near) is not None)
    return round(min(1.0, max(0.0, score)), 2)


def added_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, float]]:
    """(start, kind, end, score) of what the method adds; no two overlap, nor do they overlap base spans."""
    found = []
    for rule in RULES:
        if rule.needs in text:
            for a, b in rule.propose(text):
                if rule.right(text[a:b]):
                    s = adjusted(text, a, b, rule.score, rule.raising, rule.lowering)
                    if s >= ACCEPT:
                        found.append((-s, a, rule.kind, b))
    taken, out = bytearray(len(text) if found else 0), []
    for a, _, b in base if found else ():
        taken[a:b] = b"\1" * (b - a)
    for s, a, kind, b in sorted(found):
        if taken.find(1, a, b) < 0:
            taken[a:b] = b"\1" * (b - a)
            out.append((a, kind, b, -s))
    return out


def scored_spans(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int, float]]]:
    """(base spans: start, kind, end; all spans with their score, sorted)."""
    text = text or ""
    base = base_spans(text)
    scored = [(a, k, b, adjusted(text, a, b, BASE_SCORES[k], *_CONTEXT[KINDS[k]])) for a, k, b in base]
    return base, sorted(scored + added_spans(text, base))


def spans(text: str | None) -> tuple[list, list]:
    base, every = scored_spans(text)
    return base, [x[:3] for x in every]


def joined(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def redact(text: str | None) -> str | None:
    """The text with each span, overlapping ones together, as [KIND] of the first."""
    if not text:
        return text
    out, end = [], 0
    for a, k, b in spans(text)[1]:
        if a >= end:
            out += [text[end:a], f"[{KINDS[k].upper()}]"]
        end = max(end, b)
    return "".join([*out, text[end:]]) if out else text


def find_pii(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (kind:start:end by start, then kind), their number
    n_spans, their scores in that order and the highest, top_score (0 without any)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            counts, shas, every, n, scores, top = [[], [], [], []], [], [], [], [], []
            for text in b.column(1):
                base, found = scored_spans(text.as_py())
                for k in range(4):
                    counts[k].append(sum(x[1] == k for x in base))
                shas.append(hashlib.sha256(joined(base).encode()).hexdigest())
                every.append(joined([x[:3] for x in found]))
                n.append(len(found))
                scores.append(",".join(f"{x[3]:.2f}" for x in found))
                top.append(max((x[3] for x in found), default=0.0))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.int64()) for c in counts), *(pa.array(x, pa.string()) for x in (shas, every)), pa.array(n, pa.int64()), pa.array(scores, pa.string()), pa.array(top, pa.float64())], names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_spans", "scores", "top_score"])

    return map_arrow(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), run, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_spans long, scores string, top_score double")


def redact_pii(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """All rows and columns; the text has its personal data masked."""
    at = docs.columns.index(text_col)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            yield b.set_column(at, b.schema.field(at), pa.array([redact(x.as_py()) for x in b.column(at)], b.schema.field(at).type))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return map_arrow(docs, run, schema)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))
