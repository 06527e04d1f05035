"""Format-preserving pseudonyms by a keyed Feistel network.

Personal numbers and dates are found by pattern, validated (checksums, ranges, the calendar) and permuted, under a key, within the set of
valid values of their kind: a card number becomes another one that passes the checksum, a date another date. The permutation depends on
the kind and the key only, so equal values stay linked across documents, however they are written: dates in figures or with a month's name,
phone numbers with separators or, next to a word for a phone or beside the same number written so, as bare digits, accounts in capitals or
not. Mail addresses, access keys and stated secrets are permuted character class by character class. Text that validates as nothing is
left alone.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import ipaddress
import math
import re
import secrets
from bisect import bisect_left
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import chunks, ship_code

ROUNDS = 8
#: The setting of a session that has the key.
KEY_SETTING = "spark.marlstone.pii.key"

FIRST_DAY, LAST_DAY = dt.date(1900, 1, 1), dt.date(2099, 12, 31)
DIGITS, UPPER, LOWER, HEX = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789abcdef"

#: Lengths of account numbers by country, from the IBAN registry.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29, "BY": 28, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28,
    "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FK": 18, "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HN": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26,
    "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28,
    "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24, "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SO": 23, "ST": 25,
    "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20, "YE": 30,
}

#: Names of the months, in English whole and short, in German, French and Spanish.
MONTHS = (
    ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"),
    ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"),
    ("Januar", "Februar", "März", "April", "Mai", "Juni", "Juli", "August", "September", "Oktober", "November", "Dezember"),
    ("janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août", "septembre", "octobre", "novembre", "décembre"),
    ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre"),
)
#: Names in lower case to (language, month); a name that two lists have is of the first.
MONTH_OF = {name.lower(): (names, i + 1) for names in reversed(MONTHS) for i, name in enumerate(names)} | {"sept": (MONTHS[1], 9)}


def key_of(spark: SparkSession) -> bytes:
    """The key that the session's setting names. Without it one is drawn for the application, so that no known key makes pseudonyms; they are
    then linked within the application only."""
    given = spark.conf.get(KEY_SETTING, None)
    return given.encode() if given else _drawn(spark.sparkContext.applicationId)


@lru_cache(maxsize=4)
def _drawn(application: str) -> bytes:
    return secrets.token_bytes(32)


@lru_cache(maxsize=200_000)
def permuted(value: int, size: int, kind: str, key: bytes) -> int:
    """A keyed permutation of range(size): a Feistel network over two halves, walked until the result is in range again."""
    if size < 2:
        return value
    right = math.isqrt(size - 1) + 1
    left = -(-size // right)
    width = (right.bit_length() + 71) // 8

    def step(turn: int, half: int) -> int:
        out = b""
        block = 0
        while len(out) < width:
            data = f"{kind}|{size}|{turn}|{half}|{block}".encode()
            out += hashlib.blake2b(data, key=key[:64], digest_size=32).digest()
            block += 1
        return int.from_bytes(out[:width], "big")

    while True:
        a, b = divmod(value, right)
        for turn in range(ROUNDS):
            if turn % 2:
                b = (b + step(turn, a)) % right
            else:
                a = (a + step(turn, b)) % left
        value = a * right + b
        if value < size:
            return value


def by_class(text: str, kind: str, key: bytes, hexadecimal: bool = False) -> str:
    """Permutes the ASCII letters and digits of a text within their classes; all else stays."""
    sets = [HEX if hexadecimal and c in HEX else next((s for s in (DIGITS, UPPER, LOWER) if c in s), None) for c in text]
    value, size = 0, 1
    for c, s in zip(text, sets, strict=True):
        if s:
            value, size = value * len(s) + s.index(c), size * len(s)
    value = permuted(value, size, f"{kind}|{''.join('-' if s is None else str(len(s)) + s[0] for s in sets)}", key)
    out = []
    for c, s in zip(reversed(text), reversed(sets), strict=True):
        if s:
            value, k = divmod(value, len(s))
            c = s[k]  # noqa: PLW2901
        out.append(c)
    return "".join(reversed(out))


def refilled(shape: str, digits: str) -> str:
    """The digits put in the places of the shape's digits."""
    new = iter(digits)
    return "".join(next(new) if c.isdigit() else c for c in shape)


def check_digit(body: str) -> str:
    total = sum(sum(divmod(2 * int(c), 10)) if i % 2 == 0 else int(c) for i, c in enumerate(reversed(body)))
    return str(-total % 10)


def card(text: str, key: bytes) -> str | None:
    digits = re.sub(r"\D", "", text)
    if not 13 <= len(digits) <= 19 or check_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
        return None
    n = len(digits) - 1
    body = str(permuted(int(digits[:-1]), 10**n, "card", key)).zfill(n)
    return refilled(text, body + check_digit(body))


def in_plan(number: int) -> bool:
    """Whether neither area nor exchange of ten digits begins with 0 or 1."""
    return number // 10**9 > 1 and number // 10**6 % 10 > 1


def phone(text: str, key: bytes, stated: bool = False) -> str | None:
    """Numbers of the North American plan: area and exchange do not begin with 0 or 1. Ten digits outside the plan that are written as a
    phone number, with a plus sign, brackets or separators, or are stated to be one, are permuted among those outside it; other bare digits
    are no phone number then."""
    digits = re.sub(r"\D", "", text)
    own = digits[-10:]
    if len(digits) not in (10, 11) or (len(digits) == 11 and digits[0] != "1"):
        return None
    value = int(own)
    if not in_plan(value):
        if len(digits) == len(text) and not stated:
            return None
        value = permuted(value, 10**10, "phone10", key)
        while in_plan(value):
            value = permuted(value, 10**10, "phone10", key)
        return refilled(text, digits[:-10] + f"{value:010d}")
    value = ((int(own[:3]) - 200) * 800 + int(own[3:6]) - 200) * 10_000 + int(own[6:])
    value = permuted(value, 800 * 800 * 10_000, "phone", key)
    head, line = divmod(value, 10_000)
    area, exchange = divmod(head, 800)
    return refilled(text, digits[:-10] + f"{area + 200}{exchange + 200}{line:04d}")


def other_phone(text: str, key: bytes) -> str | None:
    """International numbers: a plus sign, the country stays (its first digits), the last seven or more are permuted."""
    digits = re.sub(r"\D", "", text)
    if not 9 <= len(digits) <= 15:
        return None
    n = len(digits) - 2
    return refilled(text, digits[:2] + str(permuted(int(digits[2:]), 10**n, f"phone{digits[:2]}", key)).zfill(n))


def dialled(text: str, key: bytes) -> str | None:
    """International numbers with 00 instead of a plus sign; linked with those."""
    digits = re.sub(r"\D", "", text)[2:]
    rest = phone(text[2:], key) if len(digits) == 11 and digits[0] == "1" else other_phone(text[2:], key)
    return None if rest is None else "00" + rest


def social(text: str, key: bytes) -> str | None:
    a, g, s = (int(x) for x in text.split("-"))
    if not (1 <= a <= 899 and a != 666 and g and s):
        return None
    value = permuted(((a - 1 - (a > 666)) * 99 + g - 1) * 9999 + s - 1, 898 * 99 * 9999, "social", key)
    value, s = divmod(value, 9999)
    a, g = divmod(value, 99)
    a += 1
    return f"{a + (a >= 666):03d}-{g + 1:02d}-{s + 1:04d}"


def address(text: str, key: bytes) -> str | None:
    parts = [int(x) for x in text.split(".")]
    if any(p > 255 for p in parts) or any(len(x) > 1 and x[0] == "0" for x in text.split(".")):
        return None
    value = permuted(int.from_bytes(bytes(parts), "big"), 2**32, "address", key)
    return ".".join(str(b) for b in value.to_bytes(4, "big"))


def address6(text: str, key: bytes) -> str | None:
    """IPv6 addresses, but that of the host itself and the empty one; groups stay whole or compressed, as written."""
    try:
        given = ipaddress.IPv6Address(text)
    except ValueError:
        return None
    if given.is_loopback or given.is_unspecified:
        return None
    new = ipaddress.IPv6Address(permuted(int(given), 2**128, "address6", key))
    out = str(new) if "::" in text else ":".join(f"{int(g, 16):x}" for g in new.exploded.split(":"))
    out = new.exploded if len(text) == 39 else out
    return out.upper() if text.upper() == text else out


def accounts(text: str):
    """Places where an account number of its country's length stands, in any case, with single blanks in it or not."""
    for m in _country.finditer(text):
        left, at = IBAN_LENGTHS.get(m[0][:2].upper(), 0) - 4, m.end()
        while left > 0 and at < len(text):
            c = text[at]
            if c.isascii() and c.isalnum():
                left -= 1
            elif c != " " or text[at - 1] == " ":
                break
            at += 1
        if left == 0 and not (at < len(text) and (text[at].isalnum() or text[at] == "_")) and sum(map(str.isdigit, text[m.start() : at])) >= 10:
            yield m.start(), at, text[m.start() : at]


def account(text: str, key: bytes) -> str | None:
    plain = text.replace(" ", "").upper()
    country, body = plain[:2], plain[4:]
    number = lambda x: int("".join(str(int(c, 36)) for c in x))
    if IBAN_LENGTHS.get(country) != len(plain) or number(body + plain[:4]) % 97 != 1:
        return None
    body = by_class(body, f"account{country}", key)
    new = iter(f"{country}{98 - number(body + country + '00') % 97:02d}{body}")
    return "".join(c if c == " " else next(new).lower() if c.islower() else next(new) for c in text)


def other_day(day: dt.date, key: bytes) -> dt.date:
    """Days of other centuries are permuted among themselves."""
    before, after = (FIRST_DAY - dt.date.min).days, (dt.date.max - LAST_DAY).days
    value = (day - dt.date.min).days if day < FIRST_DAY else before + (day - LAST_DAY).days - 1
    value = permuted(value, before + after, "otherdate", key)
    return dt.date.min + dt.timedelta(value) if value < before else LAST_DAY + dt.timedelta(value - before + 1)


def other_date(day: dt.date, key: bytes) -> dt.date:
    """A day's pseudonym."""
    if FIRST_DAY <= day <= LAST_DAY:
        return FIRST_DAY + dt.timedelta(permuted((day - FIRST_DAY).days, (LAST_DAY - FIRST_DAY).days + 1, "date", key))
    return other_day(day, key)


def date(text: str, key: bytes) -> str | None:
    """Dates in figures: the year first, or day or month first, with / . or - between; a date that can be read both ways is read day first.
    Days and months of one figure have no zero in front."""
    sep = next(c for c in text if not c.isdigit())
    written = text.split(sep)
    a, b, c = (int(x) for x in written)
    for order in ((0, 1, 2),) if len(written[0]) == 4 else ((2, 1, 0), (2, 0, 1)):
        try:
            day = dt.date(*((a, b, c)[i] for i in order))
        except ValueError:
            continue
        new = other_date(day, key)
        parts = [(new.year, new.month, new.day)[order.index(i)] for i in range(3)]
        width = min(len(written[order[1]]), len(written[order[2]]))
        return sep.join(str(p).zfill(4 if order[i] == 0 else width) for i, p in enumerate(parts))
    return None


def worded_dates(text: str):
    """Places of dates with a month's name: March 5, 1980, 5th of March 1980, 5. März 1980, 5 de marzo de 1980."""
    for pattern in _worded:
        for m in pattern.finditer(text):
            if m["month"].lower() in MONTH_OF:
                yield m.start(), m.end(), m[0]


def worded_date(text: str, key: bytes) -> str | None:
    m = next(x for p in _worded if (x := p.fullmatch(text)))
    names, month = MONTH_OF[m["month"].lower()]
    try:
        day = dt.date(int(m["year"]), month, int(m["day"]))
    except ValueError:
        return None
    new = other_date(day, key)
    name = names[new.month - 1]
    name = name.upper() if m["month"].isupper() else name.lower() if m["month"].islower() else name[0].upper() + name[1:]
    ending = m["ending"] or ""
    if ending.lower() in ("st", "nd", "rd", "th"):
        ending = "th" if 10 < new.day < 14 else {1: "st", 2: "nd", 3: "rd"}.get(new.day % 10, "th")
    out = {"month": name, "day": str(new.day).zfill(len(m["day"]) if m["day"][0] == "0" else 1) + ending, "year": f"{new.year:04d}"}
    spans = sorted((m.start(g), m.end("ending") if g == "day" and m["ending"] else m.end(g), g) for g in out)
    parts, at = [], 0
    for a, b, g in spans:
        parts += [text[at:a], out[g]]
        at = b
    return "".join([*parts, text[at:]])


def mail(text: str, key: bytes) -> str:
    """All but the last part of the domain; linked regardless of case."""
    head, dot, top = text.lower().rpartition(".")
    return by_class(head, "mail", key) + dot + top


_country = re.compile(r"(?<![A-Za-z0-9])[A-Za-z]{2}[0-9]{2}(?= ?[A-Za-z0-9])")
_worded = (
    re.compile(r"(?<![^\W\d_])(?P<month>[^\W\d_]{3,10})\.? (?P<day>\d{1,2})(?P<ending>st|nd|rd|th)?,? (?P<year>\d{4})(?![\w])"),
    re.compile(r"(?<![\w.,/-])(?P<day>\d{1,2})(?P<ending>st|nd|rd|th|\.)? (?:de |of )?(?P<month>[^\W\d_]{3,10})\.?,? (?:de |del )?(?P<year>\d{4})(?![\w])"),
)

#: kind, pattern (or what gives places), what must be in a text for the pattern to be tried, what makes the pseudonym of the first group
#: (None: no such value).
KINDS = (
    ("key", re.compile(r"\b((?:AKIA|ASIA)[A-Z0-9]{16})\b"), ("AKIA", "ASIA"), lambda t, k: t[:4] + _base36(t[4:], k)),
    ("key", re.compile(r"\b(gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9_-]{16,}|xox[abprs]-[A-Za-z0-9-]{10,})"), ("gh", "sk-", "xox"), lambda t, k: t[:4] + by_class(t[4:], "key", k)),
    ("secret", re.compile(r"""(?i)\b(?:token|password|passwd|secret|api[_-]?key|access[_-]?key)\b["']?\s*[=:]\s*["']?([^\s"',;]{6,})"""), ("=", ":"), lambda t, k: by_class(t, "secret", k, hexadecimal=re.fullmatch("[0-9a-f]+", t) is not None)),
    ("mail", re.compile(r"(?<![A-Za-z0-9._%+-])([A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})"), ("@",), mail),
    ("address", re.compile(r"(?<![\w:.])((?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{1,4})(?!\w|:\w|\.\d)"), (":",), address6),
    ("account", accounts, (), account),
    ("social", re.compile(r"(?<![\d-])(\d{3}-\d{2}-\d{4})(?![\d-])"), ("-",), social),
    ("date", re.compile(r"(?<![\d./-])(\d{4}([-/.])\d{2}\2\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4}|\d{1,2}-\d{1,2}-\d{4})(?![\d/-]|\.\d)"), ("-", "/", "."), date),
    ("date", worded_dates, (), worded_date),
    ("address", re.compile(r"(?<![\d.])(\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3})(?!\d|\.\d)"), (".",), address),
    ("card", re.compile(r"(?<![\d-])(\d{4}[ .-]\d{4}[ .-]\d{4}[ .-]\d{1,7}|\d{4}[ .-]\d{6}[ .-]\d{5}|\d{13,19})(?![\d-])"), (), card),
    ("phone", re.compile(r"(?<![\d\w])(\+?1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[ .-]\d{3}[ .-]\d{4})(?!\d)"), ("+", "-", "(", ".", " "), phone),
    ("phone", re.compile(r"(?<![\d\w])(\+(?!1[ (.-])\d[\d ().-]{7,18}\d)(?!\d)"), ("+",), other_phone),
    ("phone", re.compile(r"(?<![\d\w.,-])(?<!\d )(00(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9]\d\d)[ .-][\d ().-]{5,17}\d)(?!\d)"), ("00",), dialled),
)
#: Ten bare digits, or eleven that begin with 1, and the words before them that say that they are a phone number.
_bare = re.compile(r"(?<![\w.,+-])(1?\d{10})(?![\w-]|[.,]\d)")
_phone_word = re.compile(r"(?i)\b(?:phone|telephone|tel|mobile|cell|call|fax|sms|whatsapp|telefon|telefono|teléfono|téléphone|mobil|handy|móvil|portable)\b\W{0,6}(?:(?:at|is|no|nr|number|us|me|us on|on)\b\W{0,4}){0,2}$")

_digit = re.compile(r"[0-9]")


def _base36(text: str, key: bytes) -> str:
    signs = DIGITS + UPPER
    value = permuted(int(text, 36), 36 ** len(text), "key36", key)
    out = ""
    for _ in text:
        value, k = divmod(value, 36)
        out = signs[k] + out
    return out


def pseudonymised(text: str, key: bytes) -> tuple[str, dict[str, int]]:
    """The text with pseudonyms, and how many values of each kind were replaced. A place that one kind has taken is no other kind's."""
    if not (_digit.search(text) or "@" in text or "=" in text or ":" in text):
        return text, {}
    found: list[tuple[int, int, str, str]] = []
    phones: set[str] = set()

    def put(a: int, b: int, kind: str, made, *more) -> None:
        # Places do not overlap, so only the two neighbours can be in the way.
        at = bisect_left(found, (a,))
        if at and found[at - 1][1] > a or at < len(found) and found[at][0] < b:
            return
        if (new := made(text[a:b], key, *more)) is not None:
            found.insert(at, (a, b, kind, new))
            if kind == "phone":
                phones.add(re.sub(r"\D", "", text[a:b])[-10:])

    for kind, pattern, signs, made in KINDS:
        if signs and not any(s in text for s in signs):
            continue
        if kind not in ("mail", "secret") and not _digit.search(text):
            continue
        if callable(pattern):
            for a, b, _ in pattern(text):
                put(a, b, kind, made)
        else:
            for m in pattern.finditer(text):
                put(*m.span(1), kind, made)
    for m in _bare.finditer(text):
        if m[1][-10:] in phones or _phone_word.search(text, max(0, m.start() - 40), m.start()):
            put(*m.span(1), "phone", phone, True)
    counts: dict[str, int] = {}
    parts, at = [], 0
    for a, b, kind, new in found:
        parts += [text[at:a], new]
        at = b
        counts[kind] = counts.get(kind, 0) + 1
    return "".join([*parts, text[at:]]), counts


def pseudonymise(df: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Under a key (see key_of), for every row of df: doc_id, the text with pseudonyms, n_values, and kinds (`kind:count`, sorted, comma-joined; empty without any).

    A null text stays null. Whole texts are read. Rows that repeat give equal rows; other columns are not read; an empty table gives an
    empty result. No shuffle takes place.
    """
    ship_code(df.sparkSession)

    def scan(batches):
        for batch in chunks(batches, "t"):
            texts, n, kinds = [], [], []
            for t in batch.column("t").to_pylist():
                new, counts = (None, {}) if t is None else pseudonymised(t, key)
                texts.append(new)
                n.append(sum(counts.values()))
                kinds.append(",".join(f"{k}:{c}" for k, c in sorted(counts.items())))
            yield pa.RecordBatch.from_arrays([batch.column("d"), pa.array(texts, pa.string()), pa.array(n, pa.int64()), pa.array(kinds, pa.string())], ["doc_id", "text", "n_values", "kinds"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(df[id_col].alias("d"), df[text_col].alias("t")).mapInArrow(scan, f"doc_id {kind}, text string, n_values long, kinds string")
