"""Personal data by anchor expansion: an Aho-Corasick automaton finds cues, local parsers expand and check spans.

One pass of the automaton over a text yields its anchors: at-signs, digits, plus signs, schemes and identifier cues
(also spelled-out at-signs). A parser for the anchor's kind looks only at the neighbourhood: it walks to the borders of
what can belong to the span, checks it (part ranges, digit counts, check digits), and moves past it. No expression is
matched against the whole text.

Base kinds, leftmost and without overlap within a kind: ``email``, ``ip``, ``card``, ``phone``. The method adds
``account`` (IBAN with valid check digits, with or without a cue; a number after an identifier cue such as "ssn" or
"passport"; the user in ``scheme://user:password@host``), ``secret`` (what follows a password or token cue; the password
of such a url) and ``contact`` (an e-mail spelled with "(at)" or "[at]"; a mailto address that is no plain e-mail).

Spans are in code points, end exclusive. Edge cases: null and empty texts have no spans; equal rows get equal results;
other columns pass through, an output column replaces one of the same name.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.frames import field, with_columns

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "account", "secret", "contact")

DIGITS = frozenset("0123456789")
LETTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
LABEL = LETTERS | DIGITS | {"-"}
LOCAL = LETTERS | DIGITS | frozenset("._%+-")
PHONE = DIGITS | frozenset(" ().-")
SECRET = LETTERS | DIGITS | frozenset("_-+/.=~!@#$%^&*")

NUMBER_CUES = ("ssn", "passport", "iban", "account no", "account number", "tax id", "national id")
SECRET_CUES = ("password", "passwd", "pwd", "api_key", "apikey", "api key", "secret", "token")
AT_CUES = ("(at)", "[at]")
SCHEME_CUES = ("://", "mailto:")
URL_END = frozenset("/?#\\\"'<>`|{}^ \t\r\n\f\v\u00a0")
MAIL_END = frozenset("?#&\"'<>() \t\r\n\f\v\u00a0")

# Characters of an IBAN by country.
IBAN_LENGTHS = {country: length for length, countries in {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for country in countries.split()}
IBAN_MOST = 34


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for d in DIGITS:
        found.add_word(d, "digit")
    found.add_word("@", "at")
    found.add_word("+", "plus")
    for words, kind in ((NUMBER_CUES, "number"), (SECRET_CUES, "secret"), (AT_CUES, "spelled"),
                        (SCHEME_CUES, "scheme")):
        for w in words:
            found.add_word(w.lower(), kind)
    found.make_automaton()
    return found


LOWER = {c: c + 32 for c in range(65, 91)}


def run_end(text: str, at: int, allowed: frozenset) -> int:
    n = len(text)
    while at < n and text[at] in allowed:
        at += 1
    return at


def email(text: str, at: int, after: int) -> tuple[int, int] | None:
    """The address around the at-sign at ``at``; its local part may begin at ``after`` at the earliest."""
    start = at
    while start > after and text[start - 1] in LOCAL:
        start -= 1
    end = run_end(text, at + 1, LABEL)
    if start == at or end == at + 1:
        return None
    labels = 0
    while end < len(text) and text[end] == ".":
        to = run_end(text, end + 1, LABEL)
        if to == end + 1:
            break
        end, labels = to, labels + 1
    return (start, end) if labels else None


def ip(text: str, start: int) -> tuple[int, bool] | None:
    """End of the four dotted numbers that begin at ``start``, and whether all are at most 255."""
    end = run_end(text, start, DIGITS)
    good = _byte(text, start, end)
    for _ in range(3):
        if end >= len(text) or text[end] != ".":
            return None
        to = run_end(text, end + 1, DIGITS)
        if to == end + 1:
            return None
        good &= _byte(text, end + 1, to)
        end = to
    return end, good


def _byte(text: str, start: int, end: int) -> bool:
    digits = text[start:end].lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def card(text: str, start: int) -> tuple[int, bool]:
    """End of the digits from ``start`` on with single spaces or hyphens between, and whether they are a card number."""
    n, end, digits = len(text), start + 1, [text[start]]
    while end < n:
        if text[end] in DIGITS:
            digits.append(text[end])
            end += 1
        elif text[end] in " -" and end + 1 < n and text[end + 1] in DIGITS:
            digits.append(text[end + 1])
            end += 2
        else:
            break
    return end, 13 <= len(digits) <= 19 and luhn(digits)


def luhn(digits: list[str]) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def phone(text: str, plus: int) -> tuple[int, bool] | None:
    """End of the number at the plus sign, and whether it has 9 to 15 digits."""
    if plus + 1 >= len(text) or text[plus + 1] not in DIGITS:
        return None
    end = run_end(text, plus + 2, PHONE)
    while end > plus + 3 and text[end - 1] not in DIGITS:
        end -= 1
    if end <= plus + 3 or text[end - 1] not in DIGITS:
        return None
    return end, 9 <= sum(c in DIGITS for c in text[plus:end]) <= 15


def number_after(text: str, end: int) -> tuple[int, int] | None:
    """An identifier with at least 6 digits that follows a cue, after ':', '=', '#', 'no' or spaces; an IBAN too."""
    at = end
    while at < len(text) and at - end < 8 and (text[at] in " :=#." or text[at:at + 2].lower() == "no"):
        at += 2 if text[at:at + 2].lower() == "no" else 1
    if end_of := iban_end(text, at):
        return at, end_of
    to = at
    while to < len(text) and (text[to] in LETTERS or text[to] in DIGITS or (
            text[to] in " -" and to + 1 < len(text) and text[to + 1] in DIGITS)) and to - at < 40:
        to += 1
    digits = sum(c in DIGITS for c in text[at:to])
    letters = sum(c in LETTERS for c in text[at:to])
    if iban(text[at:to]):
        return at, to
    return (at, to) if digits >= 6 and letters <= 4 else None


def iban(text: str) -> bool:
    code = text.replace(" ", "").replace("-", "").upper()
    if not (15 <= len(code) <= 34 and code[:2].isalpha() and code[2:4].isdigit() and code.isascii() and code.isalnum()):
        return False
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def iban_end(text: str, start: int) -> int | None:
    """End of the IBAN that begins at ``start``: at most 34 letters and digits, single spaces or hyphens between.

    It ends where its country's length says, or for other countries at the last border where its check digits fit.
    """
    code, ends, at, n = [], [], start, len(text)
    while at < n and len(code) < IBAN_MOST:
        if text[at] in LETTERS or text[at] in DIGITS:
            code.append(text[at])
            at += 1
            if at == n or not (text[at] in LETTERS or text[at] in DIGITS):
                ends.append((len(code), at))
        elif text[at] in " -" and code and at + 1 < n and (text[at + 1] in LETTERS or text[at + 1] in DIGITS):
            at += 1
        else:
            break
    length = IBAN_LENGTHS.get("".join(code[:2]).upper())
    for size, end in reversed(ends):
        if length in (None, size) and iban("".join(code[:size])):
            return end
    return None


def login(text: str, start: int) -> tuple[tuple[int, int] | None, tuple[int, int] | None]:
    """The user and the password in ``user:password@host`` that begins at ``start``, behind a scheme's ``://``."""
    end, at = start, -1
    while end < len(text) and text[end] not in URL_END:
        if text[end] == "@":
            at = end
        end += 1
    if at < 0 or at + 1 == end:
        return None, None
    colon = text.find(":", start, at)
    user = (start, at if colon < 0 else colon)
    secret = (colon + 1, at)
    return user if user[0] < user[1] else None, secret if 0 <= colon < at - 1 else None


def mailboxes(text: str, start: int) -> tuple[list[tuple[int, int]], int]:
    """Addresses behind ``mailto:``, commas between, that are no plain e-mail (``name%40host``, ``name@host``); and where
    they end."""
    end = start
    while end < len(text) and text[end] not in MAIL_END:
        end += 1
    found = []
    for part in text[start:end].split(","):
        at = start + part.find("@")
        plain = "@" in part and email(text, at, start)
        name, mark, host = part.replace("%40", "@").partition("@")
        if mark and name and host.strip(".") and not plain:
            found.append((start, start + len(part.rstrip("."))))
        start += len(part) + 1
    return found, end


def secret_after(text: str, end: int, walked: int) -> tuple[tuple[int, int] | None, int]:
    """A value of 8 or more characters with a digit that follows ``=`` or ``:`` and perhaps a quote; and how far values
    have been read. One that begins before ``walked`` is the end of one that was read already."""
    at = end
    while at < len(text) and text[at] in " \"'":
        at += 1
    if at >= len(text) or text[at] not in "=:":
        return None, walked
    at += 1
    while at < len(text) and text[at] in " \"'":
        at += 1
    if at < walked:
        return None, walked
    to = run_end(text, at, SECRET)
    return (at, to) if to - at >= 8 and any(c in DIGITS for c in text[at:to]) else None, to


def spelled(text: str, start: int, end: int) -> tuple[int, int] | None:
    """``name (at) host.tld`` with single spaces around the cue."""
    left = start - 1 if start and text[start - 1] == " " else start
    right = end + 1 if end < len(text) and text[end] == " " else end
    first = left
    while first and text[first - 1] in LOCAL:
        first -= 1
    last = run_end(text, right, LABEL | {"."})
    while last > right and text[last - 1] == ".":
        last -= 1
    return (first, last) if first < left and "." in text[right:last].strip(".") else None


def spans(text: str | None, cues: ahocorasick.Automaton) -> dict[str, list[tuple[int, int]]]:
    """All spans by kind, in order of their start."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if not text:
        return found
    past = dict.fromkeys(KINDS, 0)  # where each kind's last match ended, failed checks included
    in_digits = walked = mailed = 0
    lower = text.lower()
    if len(lower) != len(text):
        lower = text.translate(LOWER)
    for last, cue in cues.iter(lower):
        if cue == "digit":
            if last < in_digits and last < past["card"]:
                continue
            if last >= past["card"]:
                past["card"], good = card(text, last)
                if past["card"] == last + 1:
                    pass
                elif good:
                    found["card"].append((last, past["card"]))
            if last >= in_digits:
                if last >= past["account"] + 2 and _country(text, last) and (end := iban_end(text, last - 2)):
                    found["account"].append((last - 2, end))
                    past["account"] = end
                in_digits = run_end(text, last, DIGITS)
                if last >= past["ip"] and (hit := ip(text, last)):
                    past["ip"] = hit[0]
                    if hit[1]:
                        found["ip"].append((last, hit[0]))
        elif cue == "at":
            if hit := email(text, last, past["email"]):
                found["email"].append(hit)
                past["email"] = hit[1]
        elif cue == "plus":
            if last >= past["phone"] and (hit := phone(text, last)):
                past["phone"] = hit[0]
                if hit[1]:
                    found["phone"].append((last, hit[0]))
        elif cue == "scheme":
            if text[last] == "/":
                hits = zip(("account", "secret"), login(text, last + 1), strict=True)
            elif last + 1 < mailed:
                continue  # inside the addresses just read
            else:
                read, mailed = mailboxes(text, last + 1)
                hits = [("contact", hit) for hit in read]
            for kind, hit in hits:
                if hit and hit[1] > past[kind]:
                    found[kind].append((max(hit[0], past[kind]), hit[1]))
                    past[kind] = hit[1]
        else:
            kind = {"number": "account", "secret": "secret", "spelled": "contact"}[cue]
            if cue == "secret":
                hit, walked = secret_after(text, last + 1, walked)
            else:
                hit = number_after(text, last + 1) if cue == "number" else spelled(text, last - 3, last + 1)
            if hit and hit[0] >= past[kind]:
                found[kind].append(hit)
                past[kind] = hit[1]
    return found


def _country(text: str, digit: int) -> bool:
    """Whether two capitals that begin a word stand before the two digits at ``digit``."""
    return (digit >= 2 and "A" <= text[digit - 1] <= "Z" and "A" <= text[digit - 2] <= "Z" and text[digit + 1:digit + 2] in DIGITS
            and not (digit >= 3 and text[digit - 3].isalnum()))


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``spans`` (kind:start:end, by kind and start, comma-joined), their number, a count per base kind and ``base_sha256``."""
    local: dict[str, ahocorasick.Automaton] = {}

    def run(column: pa.Array) -> list:
        cues = local.setdefault("cues", automaton()) if "cues" not in local else local["cues"]
        counts = np.zeros((len(BASE), len(column)), np.int64)
        base, everything, total = [], [], []
        for row, value in enumerate(column):
            hits = spans(value.as_py(), cues)
            written = {k: [f"{k}:{s}:{e}" for s, e in hits[k]] for k in KINDS}
            counts[:, row] = [len(hits[k]) for k in BASE]
            base.append(hashlib.sha256(",".join(x for k in BASE for x in written[k]).encode()).hexdigest())
            total.append(sum(map(len, hits.values())))
            everything.append(",".join(x for k in KINDS for x in written[k]))
        return [*counts, base, everything, total]

    added = [*(field(f"n_{k}", "bigint") for k in BASE), field("base_sha256", "string"), field("spans", "string"),
             field("n_spans", "bigint")]
    return with_columns(docs, added, run, text)
