"""Personal data: patterns propose spans, checksums confirm them, words near by adjust the score.

Kinds and how they are found:

email, ip, card, phone   the base patterns (parts at most 255; Luhn; 8 to 15 digits)
iban                     country code and digits, confirmed by mod 97
card                     also 13 to 15 digits that pass Luhn, if a word near by speaks for a card
ssn                      three, two and four digits, if a word near by speaks for it
key                      access keys, and values given to words such as password or token that look made up:
                         they mix letters with digits or signs, or cases within a word

Every span has a score: its kind's own, more if a word near by speaks for it and less if one speaks
against it. Base spans are always kept, however low their scores; a span that the method adds is kept
if its score reaches `KEEP`.

Every pattern is searched from a rare first character, or from the start of a run, so no text takes
more than linear time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .rows import change_column, map_lists

KINDS = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn", "key")
#: Code points before and after a span in which words count.
NEAR = 48
KEEP = 0.5

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_DIGITS = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_DIGIT = re.compile(r"[0-9]")
_ACCESS = re.compile(r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b")
_SECRET = re.compile(r"\b(?:password|passwd|pwd|secret|token|api_?key)\b[\x20\t]{0,3}[=:][\x20\t]{0,3}(?P<q>[\"']?)(?P<v>[^\s\"']{6,})(?P=q)", re.IGNORECASE)
_SIGNS = re.compile(r"[^\W_][#$%&*+/=@^~|\\!?]+[^\W_]")
_CASES = re.compile(r"[a-z][A-Z]|[A-Z]{2}[a-z]")

#: Own score of a kind; words that speak for it; words that speak against it. Cards of 16 digits or more, as base spans, have a score beyond other ones'.
CONTEXT = {
    "email": (0.9, r"mail|contact|write|reach|address", r"example|sample|noreply|no-reply"),
    "ip": (0.6, r"ip|host|server|address|login|client", r"version|release|section|build|v\b"),
    "phone": (0.7, r"phone|call|tel|mobile|fax|contact|whatsapp", r"order|invoice|serial|tracking|isbn"),
    "base card": (0.7, r"card|visa|master|amex|credit|debit|karte|carte|tarjeta|kredit", r"order|invoice|serial|tracking|isbn"),
    "iban": (0.8, r"iban|account|konto|cuenta|compte|bank|bic|swift", r"example|sample|dummy"),
    "card": (0.3, r"card|visa|master|amex|credit|debit|karte|carte|tarjeta|kredit", r"order|invoice|serial|tracking|isbn"),
    "ssn": (0.4, r"ssn|social|security|tax", r"order|invoice|serial|part|model"),
    "key": (0.7, r"key|secret|password|token|credential|aws", r"example|placeholder|changeme"),
}
_CONTEXT = {k: (own, re.compile(rf"\b(?:{pro})", re.IGNORECASE), re.compile(rf"\b(?:{con})", re.IGNORECASE)) for k, (own, pro, con) in CONTEXT.items()}


def luhn(digits: str) -> bool:
    """Whether digits pass the Luhn check."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        if i % 2:
            n = 2 * n - 9 if n > 4 else 2 * n
        total += n
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """Whether an IBAN without spaces passes the mod-97 check."""
    turned = iban[4:] + iban[:4]
    return 15 <= len(iban) <= 34 and int("".join(str(int(c, 36)) for c in turned)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for m in _DOMAIN.finditer(text):
        at = start = m.start()
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        if start < at:
            yield start, m.end()
            done = m.end()


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of the base patterns by kind, in code points, end exclusive."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if "@" in text:
        out["email"] = list(_emails(text))
    if "." in text:
        out["ip"] = [m.span() for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in _DIGITS.finditer(text) if _DIGIT.search(text) else ():
        if len(m[0]) >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out["card"].append(m.span())
    if "+" in text:
        out["phone"] = [m.span() for m in _PHONE.finditer(text) if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return out


def made_up(value: str) -> bool:
    """Whether a value is no word of a language: letters with digits or signs between them, or cases mixed past the first letter."""
    value = value.strip(".,;:!?()[]<>")
    letters = any(c.isalpha() for c in value)
    others = any(c.isdigit() for c in value) or _SIGNS.search(value)
    return len(value) >= 6 and letters and bool(others or _CASES.search(value))


def scored(kind: str, text: str, start: int, end: int, base: bool = False, around: tuple[int, int] | None = None) -> float:
    """Score of a span: its kind's own, moved by the words near by; of a span that stands for more of the text, those near `around`."""
    own, pro, con = _CONTEXT["base card" if base and kind == "card" else kind]
    start, end = around or (start, end)
    near = f"{text[max(0, start - NEAR) : start]} | {text[end : end + NEAR]}"
    return min(1.0, max(0.0, own + 0.3 * bool(pro.search(near)) - 0.4 * bool(con.search(near))))


def spans(text: str | None) -> list[tuple[str, int, int, float, bool]]:
    """(kind, start, end, score, whether it is a base span) of all personal data in a whole text, by kind and start.

    Added spans never overlap base ones or each other.
    """
    text = text or ""
    base = base_spans(text)
    found = [(k, s, e, scored(k, text, s, e, base=True), True) for k in KINDS for s, e in base[k]]
    extra: list[tuple[str, int, int]] = []
    whole: dict[int, tuple[int, int]] = {}
    if _DIGIT.search(text):
        for m in _IBAN.finditer(text):
            body = m[0]
            while len(body.replace(" ", "")) >= 15 and not mod97(body.replace(" ", "")):
                body = body.rpartition(" ")[0]
            if len(body.replace(" ", "")) >= 15:
                extra.append(("iban", m.start(), m.start() + len(body)))
        for m in _DIGITS.finditer(text):
            if len(m[0]) >= 13:
                digits = m[0].replace(" ", "").replace("-", "")
                if 13 <= len(digits) <= 15 and luhn(digits):
                    extra.append(("card", *m.span()))
        extra += [("ssn", *m.span()) for m in _SSN.finditer(text)]
        extra += [("key", *m.span()) for m in _ACCESS.finditer(text)]
    if "=" in text or ":" in text:
        for m in _SECRET.finditer(text):
            if made_up(m["v"]):
                extra.append(("key", *m.span("v")))
                whole[m.start("v")] = m.span()  # the word before the value is no context
    taken = bytearray(len(text) if extra else 0)
    for _, s, e, *_ in found if extra else ():
        taken[s:e] = b"\1" * (e - s)
    for kind, s, e in extra:
        if not any(taken[s:e]) and (x := scored(kind, text, s, e, around=whole.get(s) if kind == "key" else None)) >= KEEP:
            found.append((kind, s, e, x, False))
            taken[s:e] = b"\1" * (e - s)
    order = {k: i for i, k in enumerate((*KINDS, *ADDED))}
    return sorted(found, key=lambda x: (order[x[0]], x[1]))


def masked(text: str, found: list[tuple]) -> str:
    """The text with every span replaced by its kind in angle brackets; of overlapping spans, the first."""
    out, done = [], 0
    for kind, s, e, *_ in sorted(found, key=lambda x: (x[1], -x[2])):
        if s >= done:
            out += [text[done:s], f"<{kind}>"]
        done = max(done, e)
    return "".join([*out, text[done:]])


def _written(found: list[tuple]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e, *_ in found)


FOUND = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, scores array<double>"


def _report(columns: dict[str, list]) -> dict[str, list]:
    out: dict[str, list] = {"doc_id": columns["doc_id"]} | {c: [] for c in (*(f"n_{k}" for k in KINDS), "base_sha256", "spans", "scores")}
    for text in columns["text"]:
        found = spans(text)
        base = [x for x in found if x[4]]
        for k in KINDS:
            out[f"n_{k}"].append(sum(x[0] == k for x in base))
        out["base_sha256"].append(hashlib.sha256(_written(base).encode()).hexdigest())
        out["spans"].append(_written(found))
        out["scores"].append([x[3] for x in found])
    return out


def find(docs: DataFrame) -> DataFrame:
    """Personal data of every row of `docs`: counts of the base kinds, their digest, and all spans with scores.

    Null and empty texts have none; repeated rows are searched each; columns beyond doc_id and text
    are left out; an empty table gives an empty result.
    """
    return map_lists(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), _report, FOUND)


def mask(docs: DataFrame) -> DataFrame:
    """`docs`, all its columns, with personal data in `text` masked.

    Null texts stay null and empty ones empty; repeated rows are masked each; an empty table gives an empty result.
    """
    return change_column(docs, lambda texts: [None if t is None else masked(t, spans(t)) for t in texts])


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of all documents."""
    return find(table(spark, sf_dir, "documents"))
