"""Personal data replaced by format-preserving pseudonyms.

A found value is validated (check digits, calendar, number ranges), turned into a number
within the domain of its format, permuted there by a keyed Feistel network, and written
back in the same format and length. The permutation depends on key, kind and format
alone, never on what stands beside a value, so equal values get equal pseudonyms in all
documents and different values of one format different ones. Phone numbers are permuted
as national numbers, and email addresses and account numbers in one letter case, so that they are linked over
their notations. Where the values stood is recorded, and with that and the key pseudonyms
become the values again.
"""

import datetime
import hashlib
import ipaddress
import re
from bisect import bisect
from collections.abc import Callable, Iterator
from functools import lru_cache
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from usagelens.llm.common import identified, pieces, release, ship, text_of

ROUNDS = 8
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ALPHABET = {c: alphabet for alphabet in (DIGITS, LOWER, UPPER) for c in alphabet}
_HEX = dict.fromkeys("0123456789abcdef", "0123456789abcdef")
_HEX_KINDS = ("hex", "address6")

FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()


def permuted(value: int, size: int, key: bytes, tweak: bytes, back: bool = False) -> int:
    """The place of ``value`` in a keyed permutation of range(size).

    A Feistel network on two digits whose bases are near the square root of ``size``; results
    beyond ``size`` go through it again until they lie inside.
    """
    if size < 2:
        return value
    a = isqrt(size - 1) + 1
    b = -(-size // a)

    def function(turn, half):
        text = b"%d|%d|" % (turn, half) + tweak
        return int.from_bytes(hashlib.blake2b(text, key=key, digest_size=32).digest(), "big")

    while True:
        left, right = divmod(value, b)
        for turn in reversed(range(ROUNDS)) if back else range(ROUNDS):
            sign = -1 if back else 1
            if turn % 2:
                right = (right + sign * function(turn, left)) % b
            else:
                left = (left + sign * function(turn, right)) % a
        value = left * b + right
        if value < size:
            return value


class Mixed:
    """Numbers written with a base per place."""

    @staticmethod
    def read(places: list[int], bases: list[int]) -> int:
        value = 0
        for place, base in zip(places, bases):
            value = value * base + place
        return value

    @staticmethod
    def write(value: int, bases: list[int]) -> list[int]:
        places = []
        for base in reversed(bases):
            value, place = divmod(value, base)
            places.append(place)
        return places[::-1]


def _shape(text: str, alphabet: dict[str, str]) -> bytes:
    """The format of a value: the class of every character."""
    return "".join(alphabet[c][0] if c in alphabet else c for c in text).encode()


def _in_case_of(made: str, text: str) -> str:
    """``made`` with the letter case that ``text`` has at each place."""
    return "".join(m.upper() if c in UPPER else m.lower() if c in LOWER else m for m, c in zip(made, text))


class Pseudonyms:
    """One method per kind of value; each returns the pseudonym, or None where validation fails."""

    def __init__(self, key: bytes, back: bool = False):
        self.key, self.back = key, back

    def _permute(self, value: int, size: int, tweak: bytes) -> int:
        return permuted(value, size, self.key, tweak, self.back)

    def characters(self, kind: str, text: str, valid: Callable[[str], bool] = lambda text: True) -> str:
        """Letters and digits permuted, each within its class; again until ``valid``."""
        alphabet = _HEX if kind in _HEX_KINDS else _ALPHABET
        known = [alphabet.get(c) for c in text]
        bases = [len(k) for k in known if k]
        size = Mixed.read([b - 1 for b in bases], bases) + 1
        tweak = kind.encode() + b"|" + _shape(text, alphabet)
        value = Mixed.read([k.index(c) for c, k in zip(text, known) if k], bases)
        while True:
            value = self._permute(value, size, tweak)
            places = iter(Mixed.write(value, bases))
            made = "".join(k[next(places)] if k else c for c, k in zip(text, known))
            if valid(made):
                return made

    def email(self, text):
        name, ending = text.rsplit(".", 1)
        return f"{_in_case_of(self.characters('email', name.lower()), name)}.{ending}"

    def credential(self, text):
        return self.characters("credential", text) if any(c in _ALPHABET for c in text) else None

    def secret(self, text):
        def numbered(value):
            return any(c in DIGITS for c in value)

        if not numbered(text):
            return None  # a word, as in "password: please"
        return self.characters("hex" if all(c in _HEX for c in text) else "secret", text, numbered)

    def token(self, text):
        return self.secret(text)

    bearer = token

    def cloud_key(self, text):
        return text[:4] + self.characters("cloud_key", text[4:])

    def iban(self, text):
        plain = text.replace(" ", "").upper()
        if text not in (text.upper(), text.lower()):
            return None
        if text == text.lower() and len(plain) != IBAN_LENGTHS.get(plain[:2]):
            return None
        if not 15 <= len(plain) <= 34 or _iban_remainder(plain[4:] + plain[:4]) != 1:
            return None
        country, account = plain[:2], self.characters("iban", plain[4:])
        check = 98 - _iban_remainder(f"{account}{country}00")
        made = iter(f"{country}{check:02d}{account}")
        made = "".join(c if c == " " else next(made) for c in text)
        return made if text == text.upper() else made.lower()

    def address(self, text):
        """An IPv4 address; every number keeps its number of digits."""
        numbers = text.split(".")
        if any(int(n) > 255 or str(int(n)) != n for n in numbers):
            return None
        low = [0 if len(n) == 1 else 10 ** (len(n) - 1) for n in numbers]
        bases = [{1: 10, 2: 90, 3: 156}[len(n)] for n in numbers]
        value = Mixed.read([int(n) - l for n, l in zip(numbers, low)], bases)
        size = bases[0] * bases[1] * bases[2] * bases[3]
        value = self._permute(value, size, b"address|" + _shape(text, _ALPHABET))
        return ".".join(str(p + l) for p, l in zip(Mixed.write(value, bases), low))

    def address6(self, text):
        """An IPv6 address; every group keeps its number of digits."""
        try:
            ipaddress.IPv6Address(text)
        except ValueError:
            return None
        groups = [g for g in text.split(":") if g]
        if len(groups) < 3 or not any(c in DIGITS for c in text):
            return None
        made = self.characters("address6", text.lower())
        return made if text.upper() != text or text.lower() == text else made.upper()

    def date(self, text):
        """A date of 1900 to 2099, permuted among the days that every form writes in equal width.

        So a day has one pseudonym in all forms, with zeros or without, and the order of day
        and month can be told from it as before.
        """
        separator = next(c for c in text if c not in DIGITS)
        parts = text.split(separator)
        if len(parts) != 3 or len({c for c in text if c not in DIGITS}) != 1:
            return None
        order = "ymd" if len(parts[0]) == 4 else "mdy" if separator == "/" else "dmy"
        if order != "ymd" and int(parts[order.index("m")]) > 12:
            order = "dmy" if order == "mdy" else "mdy"
        named = dict(zip(order, map(int, parts)))
        try:
            day = datetime.date(named["y"], named["m"], named["d"])
        except ValueError:
            return None
        if not FIRST_DAY <= day.toordinal() <= LAST_DAY:
            return None
        width = _date_width(day)
        days = _days()[width]
        place = self._permute(bisect(days, day.toordinal()) - 1, len(days), b"date|%d|%d" % width)
        made = datetime.date.fromordinal(days[place])
        written = {"y": made.year, "m": made.month, "d": made.day}
        return separator.join(f"{written[o]:0{len(part)}d}" for o, part in zip(order, parts))

    def ssn(self, text):
        return self.characters("ssn", text, _valid_ssn) if _valid_ssn(text) else None

    def card(self, text):
        """A payment card number with its check digit."""
        digits = "".join(c for c in text if c in DIGITS)
        if _luhn(digits) or len(set(digits)) == 1 or not _issued(digits, len(digits)):
            return None
        made = list(self.characters("card", digits[:-1], lambda made: _issued(made, len(digits))))
        made.append(str(-_luhn([*made, "0"]) % 10))
        places = iter(made)
        return "".join(next(places) if c in DIGITS else c for c in text)

    def phone(self, text):
        """A phone number; the country code stays, and the 0 before a national number.

        What is permuted is the national number, so it is the same with and without its country.
        """
        digits = "".join(c for c in text if c in DIGITS)
        if not 7 <= len(digits) <= 15:
            return None
        kept = 0
        if text[0] == "+":
            kept = 1 if digits[0] in "17" else 2 if digits[:2] in TWO_DIGIT_CODES else 3
            # In Italy the 0 is part of the number.
            kept += digits[kept] == "0" and digits[:2] != "39"
        elif digits[0] == "0" and not _THREE_THREE_FOUR.fullmatch(text):
            if not 9 <= len(digits) <= 12:
                return None
            kept = 1
        national = digits[kept:]
        zero = national[0] == "0"
        made = iter(digits[:kept] + self.characters("phone", national, lambda made: (made[0] == "0") == zero))
        return "".join(next(made) if c in DIGITS else c for c in text)


# Country calling codes of two digits; those of 1 and 7 have one digit, all others three (ITU-T E.164).
TWO_DIGIT_CODES = frozenset(
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 "
    "81 82 84 86 90 91 92 93 94 95 98".split()
)
_THREE_THREE_FOUR = re.compile(r"\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}([ .-])\d{3}\1\d{4}", re.ASCII)


def _date_width(day: datetime.date) -> tuple[int, int]:
    """Digits of the month, and of the day, or 3 for a day that is no month."""
    return 1 + (day.month > 9), 1 + (day.day > 9) + (day.day > 12)


@lru_cache(maxsize=1)
def _days() -> dict[tuple[int, int], list[int]]:
    """All days that are values, by width."""
    found = {}
    for day in range(FIRST_DAY, LAST_DAY + 1):
        found.setdefault(_date_width(datetime.date.fromordinal(day)), []).append(day)
    return found


def _luhn(digits) -> int:
    """What is left of a Luhn sum divided by 10; 0 for a valid number."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10


# How card numbers of the payment networks begin, and how many digits they have (ISO/IEC 7812, fixed values).
ISSUERS = [
    ("4", "4", (13, 16, 19)),
    ("34", "34", (15,)),
    ("37", "37", (15,)),
    ("51", "55", (16,)),
    ("2221", "2720", (16,)),
    ("300", "305", range(14, 20)),
    ("36", "36", range(14, 20)),
    ("38", "39", range(14, 20)),
    ("3528", "3589", range(16, 20)),
    ("6011", "6011", range(16, 20)),
    ("62", "62", range(16, 20)),
    ("644", "649", range(16, 20)),
    ("65", "65", range(16, 20)),
    ("2200", "2205", range(16, 20)),
    ("50", "50", range(13, 20)),
    ("56", "58", range(13, 20)),
    ("60", "60", (16,)),
    ("63", "63", range(13, 20)),
    ("67", "67", range(13, 20)),
    ("81", "82", (16,)),
    ("9792", "9792", (16,)),
]


def _issued(digits: str, length: int) -> bool:
    """Whether card numbers of this length begin like this."""
    return any(low <= digits[: len(low)] <= high and length in sizes for low, high, sizes in ISSUERS)


def _iban_remainder(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def _valid_ssn(text: str) -> bool:
    area, group, serial = text[:3], text[4:6], text[7:]
    return area not in ("000", "666") and area[0] != "9" and group != "00" and serial != "0000"


# A value is never part of a longer word or number. Where values overlap the kind named
# first holds.
KINDS = {
    "credential": r"://[^\s/:@]{1,64}:(?P<value>[^\s/:@]{4,64})(?=@[A-Za-z0-9])",
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,24}(?![A-Za-z0-9])",
    "secret": (
        r"(?i:password|passwd|passphrase|pwd|secret|token|(?:api|access|private)[_-]?key)"
        r"(?i:[_-]?(?:access[_-]?)?(?:key|token|id|value|hash))?[\"']? ?(?:=>|[=:]) ?[\"']?"
        r"(?P<value>[A-Za-z0-9][^\s\"',;]{4,}[A-Za-z0-9])"
    ),
    # How the tokens of some public services begin (fixed values).
    "token": (
        r"(?<![A-Za-z0-9])(?:gh[pousr]_|github_pat_|glpat-|xox[abprs]-|[sr]k_live_|sk-|npm_|hf_|eyJ)"
        r"(?P<value>[A-Za-z0-9_.-]{15,}[A-Za-z0-9])(?![A-Za-z0-9])"
    ),
    "bearer": r"(?<![A-Za-z0-9])(?i:bearer) (?P<value>[A-Za-z0-9][A-Za-z0-9._~+/-]{14,}[A-Za-z0-9])",
    "cloud_key": r"(?<![A-Za-z0-9])A[KS]IA[A-Z0-9]{16}(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "address": r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\w)",
    "address6": r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:]|\.\w)",
    "date": (
        r"(?<![\w./-])(?:\d{4}-\d{2}-\d{2}(?=[Tt]\d\d)"
        r"|(?:\d{4}([-/.])\d{1,2}\1\d{1,2}|\d{1,2}([-/.])\d{1,2}\2\d{4})(?![\w/-]|\.\d))"
    ),
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "card": r"(?<![\w.+-])\d(?:[ -]?\d){12,18}(?![\w-]|\.\d)",
    "phone": (
        r"(?<![\w.])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?|\d{1,4}[ .-])"
        r"(?:(?:\d{2,4}[ .-]){1,3}\d{2,4}|\d{5,8})"
        r"|\+\d{8,15}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}([ .-])\d{3}\1\d{4}"
        r"|(?<!\d )(?:0[1-9]\d{0,3}|\(0[1-9]\d{0,3}\))(?:([ .-])\d{2,4}(?:\2\d{2,4}){1,3}|[ .-]\d{5,8}))(?:(?!\w)|(?=(?i:x|ext)\d{1,5}(?!\w)))"
    ),
}
_PATTERNS = {kind: re.compile(pattern, re.ASCII) for kind, pattern in KINDS.items()}
# Kinds whose pattern names the value inside of what it matches.
NAMED = {kind for kind, pattern in KINDS.items() if "?P<value>" in pattern}
# Characters of an account number by country (ISO 13616).
IBAN_LENGTHS = {
    country: size
    for size, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
        21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
        24: "AD CZ DZ ES MD PK RO SA SE SK TN VG", 25: "AO CV GW LY MZ PT ST", 26: "IR IS TR",
        27: "BF BI CF CG CM DJ EG FR GA GR IT KM MC MG MR SM TD",
        28: "AL AZ BJ BY CI CY DO GT HN HU LB ML NE NI PL SN SV TG", 29: "BR PS QA UA",
        30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
_IBAN_START = re.compile(r"(?<![A-Za-z0-9])(?:[A-Z]{2}\d{2}(?= ?[A-Z0-9])|[a-z]{2}\d{2}(?= ?[a-z0-9]))", re.ASCII)
_IBAN_BODY = {
    size: re.compile(rf"(?: ?[A-Za-z0-9]){{{size - 4}}}(?![A-Za-z0-9])") for size in {*IBAN_LENGTHS.values()}
}
_DIGIT_RUN = re.compile(r"[0-9](?:[ -]?[0-9]){12,}")
_DIGIT_GROUP = re.compile("[0-9]+")
_BEFORE_CARD, _BEHIND_CARD = re.compile(r"(?<![\w.+-])", re.ASCII), re.compile(r"(?![\w-]|\.\d)", re.ASCII)


def _iban_spans(text: str) -> Iterator[tuple[int, int]]:
    """Where account numbers can be: of their country's length, then of any other."""
    starts = [m.span() for m in _IBAN_START.finditer(text)]
    for begin, body in starts:
        size = IBAN_LENGTHS.get(text[begin : begin + 2].upper())
        if size and (match := _IBAN_BODY[size].match(text, body)):
            yield begin, match.end()
    for begin, _ in starts:
        if match := _PATTERNS["iban"].match(text, begin):
            yield match.span()
            if text[begin : begin + 2] not in IBAN_LENGTHS:
                for end in reversed([m.start() for m in re.finditer(" ", match[0])]):
                    yield begin, begin + end


def _card_spans(text: str) -> Iterator[tuple[int, int]]:
    """Where card numbers can be, run of digit groups by run.

    First as cards are usually written, then in groups of four and more digits, of which the last may
    be shorter, then the longest sequences in any groups.
    """
    for run in _DIGIT_RUN.finditer(text):
        groups = [m.span() for m in _DIGIT_GROUP.finditer(text, *run.span())]
        n = len(groups)
        # A group can begin or end a value where no word, or dash on a word, adjoins.
        opens, closes = [True] * n, [True] * n
        opens[0] = bool(_BEFORE_CARD.match(text, run.start()))
        closes[-1] = bool(_BEHIND_CARD.match(text, run.end()))
        for i in range(1, n):
            opens[i] = text[groups[i][0] - 1] == " " or opens[i - 1]
            closes[-1 - i] = text[groups[-1 - i][1]] == " " or closes[-i]
        usual, other = [], []
        for i in range(n):
            if not opens[i]:
                continue
            sizes, longer = [], []
            for j in range(i, n):
                sizes.append(groups[j][1] - groups[j][0])
                if sum(sizes) > 19:
                    break
                if closes[j] and sum(sizes) >= 13:
                    signs = {text[groups[k][1]] for k in range(i, j)}
                    known = len(sizes) == 1 or len(signs) == 1 and sizes in ([4] * 4, [4, 6, 5], [4, 6, 4])
                    (usual if known else longer).append((groups[i][0], groups[j][1]))
                if sizes[-1] < 4:
                    break
            other += reversed(longer)
        yield from usual
        yield from other
        # Two characters more, as the pattern looks that far behind a number.
        yield from (m.span() for m in _PATTERNS["card"].finditer(text, run.start(), run.end() + 2))


def _phone_spans(text: str) -> Iterator[tuple[int, int]]:
    """Where phone numbers can be, from every start, the longest first."""
    pattern, at = _PATTERNS["phone"], 0
    while match := pattern.search(text, at):
        begin, end = match.span()
        yield begin, end
        for stop in reversed([m.start() for m in re.finditer("[ .-]", match[0])]):
            if pattern.fullmatch(match[0], 0, stop):
                yield begin, begin + stop
        at = begin + 1


def _spans(kind: str, text: str) -> Iterator[tuple[int, int]]:
    """Where values of a kind can be, in order of preference; classes of characters alone decide."""
    if kind == "iban":
        return _iban_spans(text)
    if kind == "card":
        return _card_spans(text)
    if kind == "phone":
        return _phone_spans(text)
    group = "value" if kind in NAMED else 0
    return (m.span(group) for m in _PATTERNS[kind].finditer(text))


# Every value holds a digit, an email address its sign, or a key how it begins.
_HINT = re.compile("[0-9@]|A[KS]IA")


class Replacer:
    """Finds and replaces the values in texts, and puts them back."""

    def __init__(self, key: bytes):
        secret = hashlib.blake2b(key, digest_size=32).digest()
        there, back = Pseudonyms(secret), Pseudonyms(secret, back=True)
        self.pseudonym = lru_cache(maxsize=50_000)(lambda kind, text: getattr(there, kind)(text))
        self.value = lru_cache(maxsize=50_000)(lambda kind, text: getattr(back, kind)(text))

    def values(self, text: str) -> list[tuple[int, int, str, str]]:
        """Begin, end, kind and pseudonym of every valid value, in order."""
        found: list[tuple[int, int, str, str]] = []
        if not _HINT.search(text):
            return found
        for kind in KINDS:
            for begin, end in _spans(kind, text):
                at = bisect(found, (begin,))
                if at and found[at - 1][1] > begin or at < len(found) and found[at][0] < end:
                    continue
                made = self.pseudonym(kind, text[begin:end])
                if made is not None:
                    found.insert(at, (begin, end, kind, made))
        return found

    def replace(self, text: str) -> tuple[str, list[tuple[int, int, str]]]:
        """The text with pseudonyms for its values, and (start, length, kind) of each."""
        pieces, spans, at = [], [], 0
        for begin, end, kind, made in self.values(text):
            pieces += [text[at:begin], made]
            spans.append((begin, end - begin, kind))
            at = end
        return "".join([*pieces, text[at:]]) if spans else text, spans

    def restore(self, text: str, spans: list[tuple[int, int, str]]) -> str:
        """The text that ``replace`` made this one from."""
        pieces, at = [], 0
        for begin, length, kind in spans:
            pieces += [text[at:begin], self.value(kind, text[begin : begin + length])]
            at = begin + length
        return "".join([*pieces, text[at:]])


@lru_cache(maxsize=4)
def replacer(key: bytes) -> Replacer:
    return Replacer(key)


SPANS = "array<struct<start:int,length:int,kind:string>>"


def _named(spans: list[tuple[int, int, str]]) -> list[dict]:
    return [{"start": a, "length": n, "kind": kind} for a, n, kind in spans]


def _unnamed(spans) -> list[tuple[int, int, str]]:
    return [(s["start"], s["length"], s["kind"]) for s in spans or ()]


def pseudonymise(
    docs: DataFrame,
    key: bytes,
    id_col: str = "doc_id",
    text_col: str = "text",
    back: bool = False,
    spans_col: str = "spans",
) -> DataFrame:
    """(doc_id, text, n_values, kinds, spans), one row per row of ``docs``.

    Values of ``KINDS`` in the whole text are replaced by pseudonyms of the same length and
    format; ``kinds`` names them in order, and ``spans`` says where they stand, in code points. The
    rest of a text stays as it is. With ``back``, the same key and the spans in ``spans_col``,
    pseudonyms become the values again. NULL text counts as empty; repeated rows give
    equal results, a NULL id stays NULL, an empty table gives no rows, and other columns
    are not read. ``key`` is a secret of the caller.
    """
    ship(docs.sparkSession)

    def replace(batches):
        known = replacer(key)
        for batch in batches:
            first = 0
            for part in pieces(batch.column(1)):
                own = batch.slice(first, len(part))
                first += len(part)
                if back:
                    spans = [_unnamed(s) for s in own.column(2).to_pylist()]
                    made = [(known.restore(t, s), s) for t, s in zip(part.to_pylist(), spans)]
                else:
                    made = [known.replace(t) for t in part.to_pylist()]
                columns = {
                    "doc_id": own.column(0),
                    "text": [t for t, _ in made],
                    "n_values": [len(s) for _, s in made],
                    "kinds": [[kind for *_, kind in s] for _, s in made],
                    "spans": [_named(s) for _, s in made],
                }
                yield pa.RecordBatch.from_pydict(columns, schema=types)

    schema = f"doc_id long, text string, n_values long, kinds array<string>, spans {SPANS}"
    types = to_arrow_schema(StructType.fromDDL(schema))
    rows = identified(docs, id_col, text_col)
    if back:
        rows = docs.select(
            F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"), F.col(spans_col).alias("spans")
        )
    return rows.mapInArrow(replace, schema)


def with_pseudonyms(
    docs: DataFrame, key: bytes, text_col: str = "text", back: bool = False, spans_col: str | None = None
) -> DataFrame:
    """``docs`` with pseudonyms in its text column and all other columns as they are; NULL stays NULL.

    With ``spans_col`` a column of that name says where the pseudonyms stand. ``back`` needs it: it puts the
    values back in and drops the column.
    """
    ship(docs.sparkSession)
    if back and spans_col is None:
        raise ValueError("the way back needs the column of spans")
    at = docs.columns.index(text_col)
    where = docs.columns.index(spans_col) if back else -1
    plain = docs.drop(spans_col) if back else docs
    made_as = StructType(list(plain.schema.fields))
    if spans_col and not back:
        made_as = made_as.add(spans_col, StructType.fromDDL(f"spans {SPANS}")["spans"].dataType)
    types = to_arrow_schema(made_as)

    def run(batches):
        known = replacer(key)
        for batch in batches:
            first = 0
            # Texts, results and arrays of a piece at a time, not of a whole batch.
            for part in pieces(batch.column(at).fill_null("")):
                own = batch.slice(first, len(part))
                first += len(part)
                texts = own.column(at).to_pylist()
                if back:
                    spans = [_unnamed(s) for s in own.column(where).to_pylist()]
                    made = [(t if t is None else known.restore(t, s), s) for t, s in zip(texts, spans)]
                    own = own.remove_column(where)
                else:
                    made = [(None, []) if t is None else known.replace(t) for t in texts]
                place = own.schema.get_field_index(text_col)
                columns = list(own.columns)
                columns[place] = pa.array([t for t, _ in made], own.column(place).type)
                if spans_col and not back:
                    columns.append(pa.array([_named(s) for _, s in made], types.field(spans_col).type))
                yield pa.RecordBatch.from_arrays(columns, names=types.names)
        release()

    return docs.mapInArrow(run, made_as)
