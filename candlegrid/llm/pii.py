"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors in one pass: at-signs, plus signs, digits, schemes and cue words. From
each anchor a small deterministic parser walks outwards to the bounds of what could stand there and validates
it. Parsers never look further than the characters their own pattern allows, so a text costs what its anchors
cost. Kinds of the base, in order: email, ip, card, phone. Kinds that the method adds: url (a scheme and what
follows it), secret (a value that a cue such as `token =` assigns), account (an identifier after a cue such as
`iban` or `account`), address (a street number and the words before a cue such as `street`).
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlegrid.llm.batches import map_texts

KINDS = ("email", "ip", "card", "phone", "url", "secret", "account", "address")
BASE = KINDS[:4]

# fixed values: characters of the base patterns
_DIGITS = frozenset("0123456789")
_LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
_LOCAL = _LETTERS | _DIGITS | frozenset("._%+-")
_LABEL = _LETTERS | _DIGITS | frozenset("-")
_PHONE = _DIGITS | frozenset(" ().-")

# fixed values: cues of the kinds that the method adds
SCHEMES = ("http://", "https://", "ftp://")
SECRET_CUES = ("token", "secret", "password", "passwd", "api_key", "apikey")
ACCOUNT_CUES = ("iban", "account", "ssn", "passport", "routing")
ADDRESS_CUES = (" street", " avenue", " road", " lane", " boulevard")
_URL_END = frozenset(" \t\n\r\x0b\x0c\"'<>|")
_VALUE = _LETTERS | _DIGITS | frozenset("_-+/=.")
_ACCOUNT = _LETTERS | _DIGITS
#: Shortest secret, shortest account number, and most words between a street number and its cue.
LEAST_SECRET, LEAST_ACCOUNT, STREET_WORDS = 8, 6, 3


@lru_cache(maxsize=1)
def anchors() -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    for c in _DIGITS:
        made.add_word(c, ("digit", 1))
    made.add_word("@", ("at", 1))
    made.add_word("+", ("plus", 1))
    for words, kind in ((SCHEMES, "url"), (SECRET_CUES, "secret"), (ACCOUNT_CUES, "account"), (ADDRESS_CUES, "address")):
        for word in words:
            for form in {word, word.capitalize(), word.upper(), word.title()}:
                made.add_word(form, (kind, len(form)))
    made.make_automaton()
    return made


def luhn(digits: str) -> bool:
    """Whether the check digit is right: every second digit from the right counts twice."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _run(text: str, at: int, allowed: frozenset) -> int:
    """The end of the run of allowed characters that begins at `at`."""
    n = len(text)
    while at < n and text[at] in allowed:
        at += 1
    return at


def email_at(text: str, sign: int, floor: int) -> tuple[int, int] | None:
    start = sign
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    end = _run(text, sign + 1, _LABEL)
    if start == sign or end == sign + 1:
        return None
    labels = 0
    while end < len(text) and text[end] == "." and (after := _run(text, end + 1, _LABEL)) > end + 1:
        end, labels = after, labels + 1
    return (start, end) if labels else None


def ip_at(text: str, start: int) -> tuple[int, bool]:
    """Where the four numbers from a digit on end, and whether each is at most 255; (start, False) if there aren't four."""
    end, parts = _run(text, start, _DIGITS), 1
    fits = _byte(text[start:end])
    while parts < 4:
        after = _run(text, end + 1, _DIGITS)
        if end >= len(text) or text[end] != "." or after == end + 1:
            return start, False
        fits &= _byte(text[end + 1 : after])
        end, parts = after, parts + 1
    return end, fits


def _byte(digits: str) -> bool:
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def card_at(text: str, start: int) -> tuple[int, str]:
    """The end of the run of digits with single blanks or hyphens between, and its digits."""
    n, end, digits = len(text), start + 1, [text[start]]
    while end < n:
        c = text[end]
        if c in _DIGITS:
            end += 1
        elif (c == " " or c == "-") and end + 1 < n and text[end + 1] in _DIGITS:
            c = text[end + 1]
            end += 2
        else:
            break
        digits.append(c)
    return end, "".join(digits)


def phone_at(text: str, plus: int) -> tuple[int, int] | None:
    """The end of a number from its plus sign on, and how many digits it has; None if the pattern doesn't match."""
    if plus + 1 >= len(text) or text[plus + 1] not in _DIGITS:
        return None
    end = _run(text, plus + 2, _PHONE)
    while end > plus + 3 and text[end - 1] not in _DIGITS:
        end -= 1
    if end < plus + 4 or text[end - 1] not in _DIGITS:
        return None
    return end, sum(c in _DIGITS for c in text[plus:end])


def url_at(text: str, start: int, after: int) -> tuple[int, int] | None:
    end = after
    while end < len(text) and text[end] not in _URL_END:
        end += 1
    while end > after and text[end - 1] in ".,;:!?)]}":
        end -= 1
    return (start, end) if end > after else None


def _value_after(text: str, after: int, signs: str) -> int:
    """Where the value after a cue starts: past blanks, one sign and a quotation mark; -1 without the sign."""
    at = _run(text, after, frozenset(" \t\"'"))
    if at >= len(text) or text[at] not in signs:
        return -1
    return _run(text, at + 1, frozenset(" \t\"'"))


def secret_at(text: str, after: int) -> tuple[int, int] | None:
    start = _value_after(text, after, "=:")
    if start < 0:
        return None
    end = _run(text, start, _VALUE)
    while end > start and text[end - 1] == ".":
        end -= 1
    value = text[start:end]
    return (start, end) if len(value) >= LEAST_SECRET and not _DIGITS.isdisjoint(value) else None


def account_at(text: str, after: int) -> tuple[int, int] | None:
    """An identifier of letters and digits, in groups set apart by single blanks or hyphens, with enough digits."""
    start = _value_after(text, after, ":#=")
    if start < 0:
        start = _run(text, after, frozenset(" \t#"))
    end = _run(text, start, _ACCOUNT)
    if end == start or _DIGITS.isdisjoint(text[start:end]):
        return None
    while end < len(text) and text[end] in " -":
        group = _run(text, end + 1, _ACCOUNT)
        if group == end + 1 or _DIGITS.isdisjoint(text[end + 1 : group]):
            break
        end = group
    return (start, end) if sum(c in _DIGITS for c in text[start:end]) >= LEAST_ACCOUNT else None


def address_at(text: str, cue: int, after: int) -> tuple[int, int] | None:
    """A number and at most STREET_WORDS words before the cue."""
    if after < len(text) and text[after].isalnum():
        return None
    at = cue
    for _ in range(STREET_WORDS + 1):
        start = at
        while start > 0 and text[start - 1].isalnum():
            start -= 1
        if start == at:
            return None
        if text[start:at].isdecimal():
            return (start, after) if at < cue else None
        if start == 0 or text[start - 1] != " ":
            return None
        at = start - 1
    return None


def find(text: str | None) -> list[tuple[str, int, int]]:
    """All spans as (kind, start, end) in code points, by start, then kind as listed."""
    if not text:
        return []
    found: list[tuple[str, int, int]] = []
    reached = dict.fromkeys(KINDS, 0)  # the end of what each kind has consumed, also by a match that failed its check

    def take(kind: str, span: tuple[int, int] | None) -> None:
        if span and span[0] >= reached[kind]:
            reached[kind] = span[1]
            found.append((kind, *span))

    for last, (anchor, length) in anchors().iter(text):
        start, after = last - length + 1, last + 1
        if anchor == "digit":
            if start >= reached["card"]:
                end, digits = card_at(text, start)
                reached["card"] = end
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append(("card", start, end))
            if start >= reached["ip"]:
                end, fits = ip_at(text, start)
                if end > start:
                    reached["ip"] = end
                    if fits:
                        found.append(("ip", start, end))
                else:
                    # fewer than four numbers follow, wherever in this run of digits one begins
                    reached["ip"] = _run(text, start, _DIGITS)
        elif anchor == "at":
            take("email", email_at(text, start, reached["email"]))
        elif anchor == "plus":
            number = phone_at(text, start) if start >= reached["phone"] else None
            if number:
                reached["phone"] = number[0]
                if 10 <= number[1] <= 15:
                    found.append(("phone", start, number[0]))
        elif anchor == "url":
            take("url", url_at(text, start, after))
        elif anchor == "address":
            take("address", address_at(text, start, after))
        elif not (start and text[start - 1].isalnum() or after < len(text) and text[after].isalnum()):
            take(anchor, (secret_at if anchor == "secret" else account_at)(text, after))
    found.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return found


def told(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; of spans that overlap, the union by the first one's kind."""
    out, at, i = [], 0, 0
    while i < len(spans):
        kind, start, end = spans[i]
        while i < len(spans) and spans[i][1] < end or i < len(spans) and spans[i][1] == start:
            end = max(end, spans[i][2])
            i += 1
        out += [text[at:start], f"[{kind}]"]
        at = end
    out.append(text[at:])
    return "".join(out)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", masked: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of docs: id, what `keep` names, spans (array of kind, start, end in code points); with masked also the masked text.

    Base kinds are exactly the leftmost non-overlapping matches of their patterns. Null and empty texts have no
    spans; a null text stays null when masked; repeated rows and null ids each keep their row; other columns are
    ignored.
    """
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    columns = [T.StructField("spans", T.ArrayType(span))]
    if masked:
        columns.append(T.StructField("masked", T.StringType()))

    def make():
        def apply(texts):
            spans = [find(t) for t in texts]
            out = [[[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in spans]]
            if masked:
                out.append([mask(t, s) if t else t for t, s in zip(texts, spans, strict=True)])
            return out

        return apply

    return map_texts(docs, make, columns, id_col, text_col, keep)


def span_digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Of find_pii()'s rows: counts by base kind, SHA-256 of the base spans, and all spans as text."""

    def line(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE))

    def count(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in BASE]
    return found.select(id_col, *counts, F.sha2(F.encode(line(base), "UTF-8"), 256).alias("base_sha256"), line(spans).alias("spans"))


def base_digest(text: str) -> str:
    """SHA-256 of the base spans of one text."""
    return hashlib.sha256(told([s for s in find(text) if s[0] in BASE]).encode()).hexdigest()
