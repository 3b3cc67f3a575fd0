"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, ``+`` before a
digit, a dot before a digit, digits next to each other, ``://`` and cues of
accounts and secrets (``iban``, ``password``, ...; behind an account cue only
IBANs are read, no other account numbers and no SSNs). A parser of the anchor's kind expands it to both sides, finds the boundaries and validates.
Text without anchors costs the automaton's pass only.

Base kinds (code points, end exclusive; per kind leftmost, not overlapping):
email, ip (four numbers of at most 255), card (12 to 19 digits with a right
Luhn sum), phone (9 to 15 digits). Added kinds: account (an IBAN whose check
digits are right), url_login (name and password before the host of a URL) and
secret (the value of a password, key or token cue).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from string import ascii_letters, digits

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import per_worker

#: Kinds in the order in which spans with one start are listed.
KINDS = ("email", "ip", "card", "phone", "account", "url_login", "secret")
BASE_KINDS = KINDS[:4]

DIGITS = frozenset(digits)
LOCAL = frozenset(ascii_letters + digits + "._%+-")
LABEL = frozenset(ascii_letters + digits + "-")
PHONE = frozenset(digits + " ().-")
UPPER_OR_DIGIT = frozenset(ascii_letters[26:] + digits)
USER_INFO = frozenset(ascii_letters + digits + "._~%!$&'()*+,;=:-")

ACCOUNT_GAP = frozenset(" :.#=\t")
#: Places of an IBAN with its blanks: 34 characters in groups of four.
IBAN_PLACES = 42

#: Cues before a value that is private; fixed values.
SECRET_CUES = ("password", "passwd", "pwd", "api_key", "apikey", "secret", "token")
ACCOUNT_CUES = ("iban", "account", "konto", "compte", "cuenta")

Span = tuple[int, int, int]  # start, kind, end


def automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for x in digits:
        a.add_word("+" + x, ("phone", 2))
        a.add_word("." + x, ("dot", 2))
        for y in digits:
            for sep in ("", " ", "-"):
                a.add_word(x + sep + y, ("number", 2 + len(sep)))
    a.add_word("@", ("at", 1))
    a.add_word("://", ("scheme", 3))
    for cues, kind in ((SECRET_CUES, "secret"), (ACCOUNT_CUES, "account")):
        for cue in cues:
            for form in {cue, cue.upper(), cue.capitalize()}:
                a.add_word(form, (kind, len(form)))
    a.make_automaton()
    return a


def _run(text: str, at: int, allowed: frozenset[str]) -> int:
    """The first place from ``at`` on whose character is not allowed."""
    n = len(text)
    while at < n and text[at] in allowed:
        at += 1
    return at


def _run_back(text: str, at: int, allowed: frozenset[str], floor: int) -> int:
    while at > floor and text[at - 1] in allowed:
        at -= 1
    return at


def _email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """The address around the at-sign at ``at``: a local part behind ``floor``, a domain of two labels or more."""
    start = _run_back(text, at, LOCAL, floor)
    end = _run(text, at + 1, LABEL)
    if start == at or end == at + 1:
        return None
    labels = 1
    while end < len(text) and text[end] == "." and (stop := _run(text, end + 1, LABEL)) > end + 1:
        end, labels = stop, labels + 1
    return (start, end) if labels > 1 else None


def _ips(text: str, at: int) -> tuple[list[tuple[int, int]], int]:
    """Addresses in the chain of numbers and dots around the dot at ``at``, and where the chain ends."""
    start = _run_back(text, at, DIGITS, 0)
    while start > 1 and text[start - 1] == "." and text[start - 2] in DIGITS:
        start = _run_back(text, start - 1, DIGITS, 0)
    parts, end = [], start
    while end < len(text) and text[end] in DIGITS:
        stop = _run(text, end, DIGITS)
        parts.append((end, stop))
        if stop + 1 < len(text) and text[stop] == "." and text[stop + 1] in DIGITS:
            end = stop + 1
        else:
            end = stop
            break
    found = []
    for i in range(0, len(parts) - 3, 4):
        four = parts[i : i + 4]
        # more than three digits behind leading zeros are over 255
        if all(len(n := text[a:b].lstrip("0")) <= 3 and int(n or "0") <= 255 for a, b in four):
            found.append((four[0][0], four[3][1]))
    return found, end


def luhn(number: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(number)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _number(text: str, at: int) -> tuple[int, int]:
    """The chain of digits from ``at`` on, with at most one blank or hyphen between two."""
    end, n = at + 1, len(text)
    while end < n:
        if text[end] in DIGITS:
            end += 1
        elif text[end] in " -" and end + 1 < n and text[end + 1] in DIGITS:
            end += 2
        else:
            break
    return at, end


def _phone(text: str, at: int) -> tuple[int, int] | None:
    """From the plus at ``at`` to the last digit of the run behind it, two places on at least."""
    end = _run(text, at + 2, PHONE)
    while end > at + 3 and text[end - 1] not in DIGITS:
        end -= 1
    return (at, end) if end > at + 3 and text[end - 1] in DIGITS else None


def iban(text: str) -> bool:
    number = "".join(str(int(c, 36)) for c in text[4:] + text[:4])
    return 15 <= len(text) <= 34 and text[:2].isalpha() and text[2:4].isdigit() and int(number) % 97 == 1


def _account(text: str, at: int) -> tuple[int, int] | None:
    """An IBAN among the first places behind an account cue: groups of capitals and digits, one blank between.
    Only the places that an IBAN can take are looked at, however long the run is."""
    near = text[at : at + 9 + IBAN_PLACES + 1]
    start = _run(near, 0, ACCOUNT_GAP)
    if start > 8:
        return None
    end, ends, most = start, [], start + IBAN_PLACES
    while end < most and (stop := _run(near, end, UPPER_OR_DIGIT)) > end and stop <= most:
        ends.append(stop)
        if stop >= len(near) or near[stop] != " ":
            break
        end = stop + 1
    for stop in reversed(ends):
        code = near[start:stop].replace(" ", "")
        if len(code) <= 34 and code.isascii() and iban(code):
            return at + start, at + stop
    return None


def _login(text: str, at: int) -> tuple[int, int] | None:
    """``name:password`` between a scheme and an at-sign."""
    end = _run(text, at, USER_INFO)
    return (at, end) if end < len(text) and text[end] == "@" and ":" in text[at:end].strip(":") else None


def _secret(text: str, at: int) -> tuple[int, int] | None:
    """The value behind a cue and ``=`` or ``:``; six places at least."""
    start = _run(text, at, frozenset(" "))
    if start >= len(text) or text[start] not in "=:":
        return None
    start = _run(text, start + 1, frozenset(" \"'"))
    end = start
    while end < len(text) and not text[end].isspace() and text[end] not in "\"',;":
        end += 1
    return (start, end) if end - start >= 6 else None


def find_spans(text: str, anchors) -> list[Span]:
    """All spans of one text, by start and kind."""
    out: list[Span] = []
    email_end = ip_end = card_end = secret_end = 0
    for last, (anchor, size) in anchors.iter(text):
        at = last + 1 - size
        if anchor == "number":
            if at < card_end:
                continue
            start, card_end = _number(text, at)
            number = text[start:card_end].replace(" ", "").replace("-", "")
            if 12 <= len(number) <= 19 and luhn(number):
                out.append((start, 2, card_end))
        elif anchor == "dot":
            if at >= ip_end and at and text[at - 1] in DIGITS:
                found, ip_end = _ips(text, at)
                out += [(a, 1, b) for a, b in found]
        elif anchor == "at":
            if at >= email_end and (found := _email(text, at, email_end)):
                email_end = found[1]
                out.append((found[0], 0, found[1]))
        elif anchor == "phone":
            found = _phone(text, at)
            if found and 9 <= sum(c in DIGITS for c in text[found[0] : found[1]]) <= 15:
                out.append((found[0], 3, found[1]))
        elif anchor == "secret":
            # a cue inside a value belongs to the value, which is read once however many cues it holds
            if at >= secret_end and (found := _secret(text, last + 1)):
                secret_end = found[1]
                out.append((found[0], KINDS.index("secret"), found[1]))
        elif anchor == "account":
            if found := _account(text, last + 1):
                out.append((found[0], KINDS.index("account"), found[1]))
        elif found := _login(text, last + 1):
            out.append((found[0], KINDS.index("url_login"), found[1]))
    return sorted(set(out))


def show_spans(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row its id, n_email, n_ip, n_card, n_phone, base_sha256 and spans.

    Null and empty texts have no spans. Each row is read for itself, whole, in
    time that grows with its length; spans of one kind do not overlap. Repeated
    rows and null ids are returned as they come. Other columns are not read.
    """
    id_type = docs.schema[id_col].dataType
    schema = f"`{id_col}` {id_type.simpleString()}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = per_worker("pii_anchors", automaton)
        for batch in batches:
            counts: list[list[int]] = [[] for _ in BASE_KINDS]
            hashes, spans = [], []
            for value in batch.column(1):
                found = find_spans(value.as_py() or "", anchors)
                base = [s for s in found if s[1] < len(BASE_KINDS)]
                for k, column in enumerate(counts):
                    column.append(sum(s[1] == k for s in base))
                hashes.append(hashlib.sha256(show_spans(base).encode()).hexdigest())
                spans.append(show_spans(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(hashes, pa.string()), pa.array(spans, pa.string())],
                names=[id_col, "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
            )

    return docs.select(id_col, F.col(text).cast("string")).mapInArrow(run, schema)
