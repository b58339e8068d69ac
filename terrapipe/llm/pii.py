"""Format-preserving pseudonyms for personal numbers and dates.

Candidates are found by pattern and validated (Luhn, IBAN modulo 97, calendar,
octets, number plans); what is valid is replaced by another valid value of
the same format, chosen by a keyed permutation of all values of that format.
Equal values get equal pseudonyms in every document, different ones stay
different, and only the key's owner can go back (:func:`Cipher.invert`). A day
has one pseudonym, shown in whatever notation the day was found in.

The permutation is a Feistel network over Z_a x Z_b with keyed BLAKE2b round
functions, walked along its cycle until it falls into the format's domain. It
is applied as ``P^-1(P(x) + 1)``, so that no value stands for itself.
"""

from __future__ import annotations

import bisect
import datetime as dt
import hashlib
import math
import re
import string
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from terrapipe.llm.shared import pieces

ROUNDS = 8


class Cipher:
    """Keyed permutations of ``range(n)``, one for each ``tweak`` (the format)."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()
        self.seen: dict[tuple[str, int, int], int] = {}

    def _round(self, tweak: str, n: int, i: int, half: int) -> int:
        return int.from_bytes(hashlib.blake2b(f"{tweak}|{n}|{i}|{half}".encode(), key=self.key, digest_size=64).digest(), "big")

    def _once(self, tweak: str, n: int, x: int, back: bool) -> int:
        a = math.isqrt(n - 1) + 1
        b = -(-n // a)
        while True:
            left, right = divmod(x, b)
            for i in range(ROUNDS - 1, -1, -1) if back else range(ROUNDS):
                if i % 2:
                    step = self._round(tweak, n, i, left)
                    right = (right - step if back else right + step) % b
                else:
                    step = self._round(tweak, n, i, right)
                    left = (left - step if back else left + step) % a
            x = left * b + right
            if x < n:
                return x

    def permute(self, tweak: str, n: int, x: int) -> int:
        """Another value of ``range(n)``; ``x`` itself only if there is no other."""
        known = self.seen.get((tweak, n, x))
        if known is None:
            if len(self.seen) > 100_000:
                self.seen.clear()
            known = self._once(tweak, n, (self._once(tweak, n, x, False) + 1) % n, True)
            self.seen[tweak, n, x] = known
        return known

    def invert(self, tweak: str, n: int, y: int) -> int:
        return self._once(tweak, n, (self._once(tweak, n, y, False) - 1) % n, True)

    def walk(self, tweak: str, n: int, x: int, valid: Callable[[int], bool]) -> int:
        """Along the cycle to the next valid value; a permutation of the valid ones."""
        y = self.permute(tweak, n, x)
        while not valid(y):
            y = self.permute(tweak, n, y)
        return y


# ---- formats: each returns the replacement, or None if the value is not valid -------

def _digits(cipher: Cipher, tweak: str, shown: str, keep: int = 0) -> str:
    """Permute the digits after the first ``keep`` ones in their places."""
    places = [i for i, c in enumerate(shown) if c.isdigit()][keep:]
    n = len(places)
    new = f"{cipher.permute(f'{tweak}{n}', 10 ** n, int(''.join(shown[i] for i in places))):0{n}d}"
    out = list(shown)
    for i, c in zip(places, new, strict=True):
        out[i] = c
    return "".join(out)


def _characters(cipher: Cipher, tweak: str, shown: str, digits: str = string.digits, letters: str = string.ascii_lowercase) -> str:
    """Permute letters among letters and digits among digits; case and all else stay."""
    sets = [digits if c in digits else letters if c.lower() in letters else "" for c in shown]
    n = math.prod(len(s) for s in sets if s)
    if n < 2:
        return shown
    x = 0
    for c, s in zip(shown, sets, strict=True):
        if s:
            x = x * len(s) + s.index(c.lower())
    x = cipher.permute(tweak + "".join("." if not s else "9" if s is digits else "a" for s in sets), n, x)
    out = list(shown)
    for i in range(len(shown) - 1, -1, -1):
        if sets[i]:
            x, k = divmod(x, len(sets[i]))
            out[i] = sets[i][k].upper() if shown[i].isupper() else sets[i][k]
    return "".join(out)


def luhn(digits: str) -> bool:
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10 == 0


def card(cipher: Cipher, m: re.Match) -> str | None:
    plain = re.sub(r"\D", "", m[0])
    if not luhn(plain) or len(set(plain)) == 1:
        return None
    n = len(plain) - 1
    body = f"{cipher.permute(f'card{n}', 10 ** n, int(plain[:-1])):0{n}d}"
    body += next(c for c in string.digits if luhn(body + c))
    new = iter(body)
    return "".join(next(new) if c.isdigit() else c for c in m[0])


def iban(cipher: Cipher, m: re.Match) -> str | None:
    plain = m[0].replace(" ", "")
    number = lambda s: int("".join(str(int(c, 36)) for c in s))
    if not 15 <= len(plain) <= 34 or number(plain[4:] + plain[:4]) % 97 != 1:
        return None
    body = _characters(cipher, "iban" + plain[:2], plain[4:])
    new = iter(plain[:2] + f"{98 - number(body + plain[:2] + '00') % 97:02d}" + body)
    return "".join(c if c == " " else next(new) for c in m[0])


def address(cipher: Cipher, m: re.Match) -> str | None:
    parts = m[0].split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    x = cipher.permute("ipv4", 1 << 32, int.from_bytes(bytes(map(int, parts)), "big"))
    return ".".join(map(str, x.to_bytes(4, "big")))


def _ssn(x: int) -> bool:
    area, group, serial = x // 1_000_000, x // 10_000 % 100, x % 10_000
    return 0 < area < 900 and area != 666 and group > 0 and serial > 0


def ssn(cipher: Cipher, m: re.Match) -> str | None:
    x = int(m[0].replace("-", ""))
    if not _ssn(x):
        return None
    new = f"{cipher.walk('ssn', 10 ** 9, x, _ssn):09d}"
    return f"{new[:3]}-{new[3:5]}-{new[5:]}"


def phone(cipher: Cipher, m: re.Match) -> str | None:
    n = sum(c.isdigit() for c in m[0])
    if not 10 <= n <= 15:
        return None
    keep = len(m["country"] or "")
    return _digits(cipher, f"phone{m['country'] or ''}", m[0], keep) if n - keep >= 6 else None


FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1).toordinal(), dt.date(2099, 12, 31).toordinal()


def _day(y: str, m: str, d: str) -> int | None:
    try:
        day = dt.date(int(y), int(m), int(d)).toordinal()
    except ValueError:
        return None
    return day - FIRST_DAY if FIRST_DAY <= day <= LAST_DAY else None


def _moved(cipher: Cipher, x: int) -> dt.date:
    """The day that stands for day ``x`` in every notation.

    Days after the 12th become such days and earlier ones earlier ones, as
    ``17/05/1999`` says which number is the day only after the 12th.
    """
    late = dt.date.fromordinal(FIRST_DAY + x).day > 12
    return dt.date.fromordinal(FIRST_DAY + cipher.walk("date", LAST_DAY - FIRST_DAY + 1, x,
                                                       lambda y: (dt.date.fromordinal(FIRST_DAY + y).day > 12) == late))


def iso_date(cipher: Cipher, m: re.Match) -> str | None:
    if (x := _day(m[1], m[3], m[4])) is None:
        return None
    new = _moved(cipher, x)
    return f"{new.year:04d}{m[2]}{new.month:02d}{m[2]}{new.day:02d}"


def short_date(cipher: Cipher, m: re.Match) -> str | None:
    """Day or month first: a dot means the day, else a first number over 12 does."""
    day_first = m[2] == "." or int(m[1]) > 12
    if (x := _day(m[4], m[3], m[1]) if day_first else _day(m[4], m[1], m[3])) is None:
        return None
    padded = len(m[1]) == 2 and len(m[3]) == 2
    new = _moved(cipher, x)
    first, second = (new.day, new.month) if day_first else (new.month, new.day)
    return f"{first:02d}{m[2]}{second:02d}{m[2]}{new.year:04d}" if padded else f"{first}{m[2]}{second}{m[2]}{new.year:04d}"


def email(cipher: Cipher, m: re.Match) -> str | None:
    new = _characters(cipher, "email@" + m[2].lower(), m[1])
    return None if new == m[1] else f"{new}@{m[2]}"


def secret(cipher: Cipher, m: re.Match) -> str | None:
    new = _characters(cipher, "key", m[2].lower(), digits=string.hexdigits[:16], letters="")
    return m[1] + (new.upper() if m[2].isupper() else new)


#: name, what a text must hold for the pattern to be tried, pattern, format. Earlier ones win where two overlap.
KINDS: list[tuple[str, str, re.Pattern, Callable[[Cipher, re.Match], str | None]]] = [
    ("email", "@", re.compile(r"(?<![A-Za-z0-9._%+-])([A-Za-z0-9._%+-]{1,64})@([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})"), email),
    ("key", "\"'", re.compile(r"((?i:\b(?:token|key|secret|passwd|password|api_?key)\s?[:=]\s?[\"']))([0-9a-f]{32,64}|[0-9A-F]{32,64})(?=[\"'])"), secret),
    ("iban", "9", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"), iban),
    ("date", "9", re.compile(r"(?<![\d/.-])(\d{4})([-/])(\d{2})\2(\d{2})(?![\d/-])"), iso_date),
    ("date", "9", re.compile(r"(?<![\d/.-])(\d{1,2})([/.-])(\d{1,2})\2(\d{4})(?!\d|[/-]\d)"), short_date),
    ("ssn", "9", re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"), ssn),
    ("ip", "9", re.compile(r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)"), address),
    ("card", "9", re.compile(r"(?<!\d)(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{1,7}|\d{4}([ -])\d{6}\2\d{4,5})(?!\d)"), card),
    ("phone", "9", re.compile(r"(?<![\w+])(?:\+(?P<country>1|7|[2-9]\d{1,2})[ .-]?)(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\d)"
                              r"|(?<![\w+(])(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}(?!\d)"), phone),
]
_DIGIT = re.compile(r"\d\D{0,4}\d")


def spans(text: str, cipher: Cipher) -> list[tuple[int, int, str, str]]:
    """``(start, end, kind, replacement)`` in order, without overlaps."""
    found: list[tuple[int, int, str, str]] = []  # in order: what overlaps a match is beside its place
    numbers = None
    for kind, needs, pattern, fmt in KINDS:
        if needs == "9":
            numbers = bool(_DIGIT.search(text)) if numbers is None else numbers
            if not numbers:
                continue
        elif not any(c in text for c in needs):
            continue
        for m in pattern.finditer(text):
            place = bisect.bisect_left(found, m.end(), key=lambda f: f[0])
            if place and found[place - 1][1] > m.start():
                continue
            new = fmt(cipher, m)
            if new is not None:
                found.insert(place, (*m.span(), kind, new))
    return found


def replaced(text: str, found: list[tuple[int, int, str, str]]) -> str:
    out, at = [], 0
    for a, b, _, new in found:
        out += [text[at:a], new]
        at = b
    return "".join([*out, text[at:]])


_ciphers: dict[bytes, Cipher] = {}


def pseudonymise(docs: DataFrame, key: bytes, text_column: str = "text", found_column: str | None = "pii") -> DataFrame:
    """``docs`` with the personal values of ``text_column`` replaced, row by row.

    ``found_column`` (None: left out) lists ``start, end, kind`` of each value
    in the text as it came; if the input has a column of that name, the new one
    takes its place. Null and empty texts stay as they are, with an empty
    list; all other columns and repeated rows pass unchanged.
    """
    docs = docs.drop(found_column) if found_column else docs
    schema = docs.schema
    found_type = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
                                           T.StructField("kind", T.StringType())]))
    out = T.StructType([*schema.fields, *([T.StructField(found_column, found_type)] if found_column else [])])
    arrow = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))
    at = schema.fieldNames().index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cipher = _ciphers.setdefault(key, Cipher(key))
        for batch in pieces(batches, text_column):
            texts, lists = [], []
            for text in batch.column(at).to_pylist():
                found = spans(text, cipher) if text else []
                texts.append(replaced(text, found) if found else text)
                lists.append([{"start": a, "end": b, "kind": k} for a, b, k, _ in found])
            columns = [*batch.columns]
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            if found_column:
                columns.append(pa.array(lists, arrow))
            yield pa.record_batch(columns, names=[f.name for f in out.fields])

    return docs.mapInArrow(run, out)
