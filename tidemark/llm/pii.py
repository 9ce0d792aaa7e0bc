"""Personal data replaced by format-preserving pseudonyms.

Numbers and dates are found by their form and validated (check digits, ranges,
calendar), and each is permuted within its own format by a keyed Feistel
network: a card number becomes another valid card number of the same issuer
form, a date another date, an address another address. The permutation depends
on key and kind only, so equal values have equal pseudonyms in all documents,
unlike values never share one, and the holder of the key can go back.

Values that are written apart keep their separators. Nothing is looked up or
exchanged between rows, so documents are handled where they lie.
"""

from __future__ import annotations

import hmac
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import date, timedelta

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
DIGITS = "0123456789"
LOWER = "abcdefghijklmnopqrstuvwxyz"
EPOCH = date(1900, 1, 1)
DAYS = (date(2100, 1, 1) - EPOCH).days


@dataclass(frozen=True)
class Feistel:
    """A keyed permutation of the numbers below ``size``.

    An unbalanced network over two halves of the next rectangle of numbers;
    values that fall outside ``size`` walk on until they are inside.
    """

    key: bytes
    kind: str
    size: int

    def _halves(self) -> tuple[int, int]:
        a = max(2, int(self.size**0.5))
        while a * a > self.size and a > 2:
            a -= 1
        return a, -(-self.size // a)

    def _round(self, step: int, value: int, modulus: int) -> int:
        message = f"{self.kind}|{self.size}|{step}|{value}".encode()
        return int.from_bytes(hmac.digest(self.key, message, "sha256")[:16]) % modulus

    def forward(self, value: int) -> int:
        a, b = self._halves()
        while True:
            left, right = divmod(value, b)
            for step in range(0, ROUNDS, 2):
                left = (left + self._round(step, right, a)) % a
                right = (right + self._round(step + 1, left, b)) % b
            value = left * b + right
            if value < self.size:
                return value

    def back(self, value: int) -> int:
        a, b = self._halves()
        while True:
            left, right = divmod(value, b)
            for step in reversed(range(0, ROUNDS, 2)):
                right = (right - self._round(step + 1, left, b)) % b
                left = (left - self._round(step, right, a)) % a
            value = left * b + right
            if value < self.size:
                return value


def luhn(digits: str) -> bool:
    total = sum(
        d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(map(int, reversed(digits)))
    )
    return total % 10 == 0


def iban_check(country: str, body: str) -> str:
    value = int("".join(str(int(c, 36)) for c in body + country + "00"))
    return f"{98 - value % 97:02d}"


class Permuter:
    """Forward or backward pseudonyms under one key."""

    def __init__(self, key: bytes, back: bool = False):
        self.key, self.reverse = key, back

    def number(self, kind: str, value: int, size: int) -> int:
        if size < 2:
            return value
        net = Feistel(self.key, kind, size)
        return net.back(value) if self.reverse else net.forward(value)

    def digits(self, kind: str, text: str) -> str:
        return f"{self.number(f'{kind}{len(text)}', int(text), 10 ** len(text)):0{len(text)}d}" if text else text

    def like(self, kind: str, text: str) -> str:
        """A string of the same form: digits, lower and upper case letters stay such; other characters stay."""
        alphabets = [
            DIGITS if c in DIGITS else LOWER if c in LOWER else LOWER.upper() if c in LOWER.upper() else None
            for c in text
        ]
        size, value = 1, 0
        for c, alphabet in zip(text, alphabets):
            if alphabet:
                size, value = size * len(alphabet), value * len(alphabet) + alphabet.index(c)
        form = "".join("9" if a == DIGITS else "a" if a == LOWER else "A" if a else c for c, a in zip(text, alphabets))
        value = self.number(f"{kind}|{form}", value, size)
        out = []
        for c, alphabet in zip(reversed(text), reversed(alphabets)):
            if alphabet:
                value, at = divmod(value, len(alphabet))
                out.append(alphabet[at])
            else:
                out.append(c)
        return "".join(reversed(out))


def _refill(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced in order; separators stay."""
    source = iter(digits)
    return "".join(next(source) if c in DIGITS else c for c in shape)


def _only(text: str) -> str:
    return "".join(c for c in text if c in DIGITS)


def _valid_card(shape: str) -> bool:
    text = _only(shape)
    return 13 <= len(text) <= 19 and luhn(text)


def _card(p: Permuter, shape: str) -> str:
    text = _only(shape)
    body = text[0] + p.digits("card" + text[0], text[1:-1])
    check = next(c for c in DIGITS if luhn(body + c))
    return _refill(shape, body + check)


def _card_parts(groups: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """First and last of neighbouring digit groups that have as many digits as a card, in the order they are tried.

    Undivided numbers and the usual 4-4-4-4 and 4-6-5 come first, then the
    rest from the left, the longer before the shorter.
    """
    found = []
    for first in range(len(groups)):
        sizes: list[int] = []
        for last in range(first, min(first + 19, len(groups))):
            sizes.append(groups[last][1] - groups[last][0])
            if sum(sizes) > 19:
                break
            if sum(sizes) >= 13:
                usual = len(sizes) == 1 or sizes in ([4, 4, 4, 4], [4, 6, 5])
                found.append((not usual, first, -last))
    return [(first, -last) for _, first, last in sorted(found)]


def _cards(p: Permuter, text: str, groups: list[tuple[int, int]]) -> list[tuple[int, int, str]]:
    """Cards among the digit groups of a run, by every group boundary: start, end and what replaces them.

    A part tried in vain must not become valid beside the new number, or the
    way back would read other parts; in that case the number is permuted again.
    """
    parts = _card_parts(groups)
    if not parts:
        return []
    now = [text[a:z] for a, z in zip([g[0] for g in groups], [*(g[0] for g in groups[1:]), groups[-1][1]])]
    around: dict[int, list[int]] = {}  # tries by group, in order
    for rank, (first, last) in enumerate(parts):
        for g in range(first, last + 1):
            around.setdefault(g, []).append(rank)
    owner: dict[int, int] = {}
    taken: list[tuple[int, list[int]]] = []

    def shape(rank: int) -> str:
        return "".join(now[parts[rank][0] : parts[rank][1] + 1])

    def free(rank: int) -> bool:
        return not any(owner.get(g, rank) < rank for g in range(parts[rank][0], parts[rank][1] + 1))

    for rank, (first, last) in enumerate(parts):
        if free(rank) and _valid_card(shape(rank)):
            own = range(first, last + 1)
            taken.append((rank, [r for r in {r for g in own for r in around[g]} if r < rank and free(r)]))
            owner.update(dict.fromkeys(own, rank))
    for rank, before in reversed(taken) if p.reverse else taken:
        first, last = parts[rank]
        while True:
            new = iter(_card(p, shape(rank)))
            for g in range(first, last + 1):
                now[g] = "".join(next(new) for _ in now[g])
            if not any(_valid_card(shape(r)) for r in before):
                break
    out = []
    for rank, _ in taken:
        start, end = groups[parts[rank][0]][0], groups[parts[rank][1]][1]
        out.append((start, end, shape(rank)[: end - start]))
    return out


def _iban(p: Permuter, m: re.Match) -> str | None:
    text = m[0].replace(" ", "")
    if not 15 <= len(text) <= 34 or iban_check(text[:2], text[4:]) != text[2:4]:
        return None
    body = p.like("iban" + text[:2], text[4:])
    source = iter(text[:2] + iban_check(text[:2], body) + body)
    return "".join(c if c == " " else next(source) for c in m[0])


def _ssn(p: Permuter, m: re.Match) -> str | None:
    area, group, serial = int(m["ssn1"]), int(m["ssn2"]), int(m["ssn3"])
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    areas = 898
    held = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    held, serial = divmod(p.number("ssn", held, areas * 99 * 9999), 9999)
    area, group = divmod(held, 99)
    area += 1
    return f"{area + (area >= 666):03d}-{group + 1:02d}-{serial + 1:04d}"


def _address(p: Permuter, m: re.Match) -> str | None:
    parts = m[0].split(".")
    if any(int(x) > 255 or (len(x) > 1 and x[0] == "0") for x in parts):
        return None
    value = p.number("ipv4", int.from_bytes(bytes(map(int, parts))), 1 << 32)
    return ".".join(map(str, value.to_bytes(4)))


def _phone(p: Permuter, m: re.Match) -> str | None:
    """The country code stays, and ten digits that begin with 2 to 9 do so again."""
    whole = m[0]
    lead = re.match(r"\+\d{1,3}(?=[ (.-])", whole)
    head = lead[0] if lead else "+" if whole[0] == "+" else ""
    text = _only(whole[len(head) :])
    if not 7 <= len(text) <= 13:
        return None
    if len(text) == 10:
        least, size = (2 * 10**9, 8 * 10**9) if text[0] in "23456789" else (0, 2 * 10**9)
        value = p.number(f"phone{least}", int(text) - least, size) + least
        return head + _refill(whole[len(head) :], f"{value:010d}")
    return head + _refill(whole[len(head) :], p.digits("phone", text))


def _day(p: Permuter, found: date, fits: Callable[[date], bool] = lambda d: True) -> date | None:
    """The permuted date; walks on until the result ``fits`` as the given one does."""
    at = (found - EPOCH).days
    if not 0 <= at < DAYS:
        return None
    while True:
        at = p.number("date", at, DAYS)
        new = EPOCH + timedelta(days=at)
        if fits(new):
            return new


def _iso_date(p: Permuter, m: re.Match) -> str | None:
    try:
        new = _day(p, date(int(m["y"]), int(m["m"]), int(m["d"])))
    except ValueError:
        return None
    return new and f"{new.year:04d}{m['s']}{new.month:02d}{m['s']}{new.day:02d}"


def _date(p: Permuter, m: re.Match) -> str | None:
    """Day first, or month first where the second number can only be a day."""
    try:
        if int(m["b"]) <= 12:
            new = _day(p, date(int(m["y"]), int(m["b"]), int(m["a"])))
            return new and f"{new.day:02d}{m['s']}{new.month:02d}{m['s']}{new.year:04d}"
        new = _day(p, date(int(m["y"]), int(m["a"]), int(m["b"])), lambda d: d.day > 12)
    except ValueError:
        return None
    return new and f"{new.month:02d}{m['s']}{new.day:02d}{m['s']}{new.year:04d}"


def _email(p: Permuter, m: re.Match) -> str | None:
    local, domain = m[0].rsplit("@", 1)
    name, _, top = domain.rpartition(".")
    return f"{p.like('mail', local)}@{p.like('host', name)}.{top}"


def _secret(p: Permuter, m: re.Match) -> str | None:
    return m[0][: m.start("value") - m.start()] + _hexlike(p, m["value"])


def _hexlike(p: Permuter, text: str) -> str:
    if re.fullmatch(r"[0-9a-f]+", text):
        return f"{p.number(f'hex{len(text)}', int(text, 16), 16 ** len(text)):0{len(text)}x}"
    return p.like("secret", text)


def _access_key(p: Permuter, m: re.Match) -> str | None:
    return m[0][:4] + p.like("access", m[0][4:])


_DIGIT = re.compile(r"\d")
_GROUP = re.compile(r"\d+", re.A)
_WORDS = ("password", "passwd", "token", "secret", "api")
#: Kind, what a text must hold to be searched, form, and how a match is permuted if it validates.
#: At a place that several forms match, the first in this order wins.
FORMS: list[tuple[str, Callable[[str], object], re.Pattern, Callable]] = [
    (
        "email",
        lambda t: "@" in t,
        re.compile(r"(?<![\w.+%-])[A-Za-z0-9_][\w.+%-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}", re.A),
        _email,
    ),
    ("access_key", lambda t: "AKIA" in t, re.compile(r"(?<!\w)AKIA[0-9A-Z]{16}(?!\w)"), _access_key),
    (
        "secret",
        lambda t: any(w in t.lower() for w in _WORDS),
        re.compile(
            r"(?i:(?<![^\W_])(?:password|passwd|token|secret|api[_-]?key)\s*[=:]\s*[\"']?)"
            r"(?P<value>[A-Za-z0-9_+/-]{8,})"
        ),
        _secret,
    ),
    ("iban", _DIGIT.search, re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"), _iban),
    ("ip_address", _DIGIT.search, re.compile(r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\w)", re.A), _address),
    (
        "date",
        _DIGIT.search,
        re.compile(r"(?<![\w-])(?P<y>\d{4})(?P<s>[-/])(?P<m>\d{2})(?P=s)(?P<d>\d{2})(?=[Tt]\d\d|Z\b|[^\w-]|$)", re.A),
        _iso_date,
    ),
    (
        "date",
        _DIGIT.search,
        re.compile(r"(?<![\w.])(?P<a>\d{2})(?P<s>[./])(?P<b>\d{2})(?P=s)(?P<y>\d{4})(?!\w)", re.A),
        _date,
    ),
    (
        "ssn",
        _DIGIT.search,
        re.compile(r"(?<![\w-])(?P<ssn1>\d{3})-(?P<ssn2>\d{2})-(?P<ssn3>\d{4})(?![\w-])", re.A),
        _ssn,
    ),
    ("card", _DIGIT.search, re.compile(r"(?<![\w-])\d(?:[ -]?\d){12,}(?![\w-])", re.A), _cards),
    (
        "phone",
        lambda t: "+" in t,
        re.compile(r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,3}(?!\w)", re.A),
        _phone,
    ),
    (
        "phone",
        _DIGIT.search,
        re.compile(r"(?<![\w+])(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])", re.A),
        _phone,
    ),
]


def _inside(taken: list[tuple], match: re.Match) -> list[tuple]:
    """The spans of ``taken``, which is sorted and without overlaps, that a match meets."""
    begin, end = bisect_left(taken, (match.start(),)), bisect_left(taken, (match.end(),))
    return taken[begin - (begin > 0 and taken[begin - 1][1] > match.start()) : end]


def _free_groups(text: str, run: re.Match, taken: list[tuple]) -> Iterator[list[tuple[int, int]]]:
    """Digit groups of a run, parted where something else was found."""
    inside = [(a, z) for a, z, *_ in _inside(taken, run)]
    groups: list[tuple[int, int]] = []
    for match in _GROUP.finditer(text, *run.span()):
        at = bisect_left(inside, (match.end(),))  # found spans do not overlap
        if at and inside[at - 1][1] > match.start():
            yield groups
            groups = []
        else:
            groups.append(match.span())
    yield groups


class Pseudonymiser:
    """Forward pseudonyms under a key, or with ``back`` the way from pseudonyms to what they stand for."""

    def __init__(self, key: bytes, back: bool = False):
        self._permuter = Permuter(key, back)

    def replace(self, text: str) -> tuple[str, list[tuple[str, int, int]]]:
        """The new text, and kind, start and end of what was replaced in the given one."""
        taken: list[tuple[int, int, str, str]] = []  # sorted, without overlaps
        for kind, likely, pattern, permuted in FORMS:
            if not likely(text):
                continue
            found: list[tuple[int, int, str, str]] = []  # matches of one form do not overlap
            for match in pattern.finditer(text):
                if permuted is _cards:
                    for groups in _free_groups(text, match, taken):
                        found += [(a, z, kind, new) for a, z, new in _cards(self._permuter, text, groups)]
                elif not _inside(taken, match):
                    new = permuted(self._permuter, match)
                    if new is not None:
                        found.append((match.start(), match.end(), kind, new))
            if found:
                taken = sorted(taken + found)
        if not taken:
            return text, []
        out, at = [], 0
        for start, end, _, new in taken:
            out += [text[at:start], new]
            at = end
        return "".join([*out, text[at:]]), [(kind, start, end) for start, end, kind, _ in taken]


FOUND = "struct<text:string,spans:array<struct<kind:string,start:int,end:int>>>"
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
_FOUND = pa.struct([("text", pa.string()), ("spans", pa.list_(_SPAN))])


def pseudonyms(text: Column, key: bytes, back: bool = False) -> Column:
    """New ``text`` and replaced ``spans`` (kind, start and end in the given text); a NULL text stays NULL."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = Pseudonymiser(key, back)
        for texts in batches:
            out, found = [], []
            for value in texts:
                value = value.as_py()
                new, spans = own.replace(value) if value else (value, [])
                out.append(new)
                found.append([{"kind": k, "start": a, "end": z} for k, a, z in spans])
            yield pa.StructArray.from_arrays(
                [pa.array(out, pa.string()), pa.array(found, _FOUND.field("spans").type)], fields=list(_FOUND)
            )

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, FOUND)(text.cast("string"))


def pseudonymise(docs: DataFrame, secret: bytes, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, ``text`` with pseudonyms, and ``spans`` of what was replaced in the old text.

    NULL texts stay NULL and empty ones empty, both without spans. Equal
    values of one kind have equal pseudonyms in all rows, NULL keys and
    repeated rows included. Other columns are not read.
    """
    rows = docs.select(F.col(key), pseudonyms(F.col(text), secret).alias("found"))
    return rows.select(key, F.col("found.text").alias("text"), F.col("found.spans").alias("spans"))
