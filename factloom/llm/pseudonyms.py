"""Format-preserving pseudonyms for personal data by a keyed Feistel permutation.

A found value is read as a number in the range of its format (digits by place,
letters by place, days since 1900), permuted within that range by a Feistel
network with cycle walking, and written back in the same format. Checked
formats stay valid: check digits are computed anew. The permutation depends on
the key, the kind and the value alone, however it is written: spaces, marks, the
order of a date's parts, the case of an address and the place where a telephone
number's country code ends make no difference. So equal values stay equal in
every document and different ones stay different; whoever has the key can undo it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from datetime import date, timedelta
from functools import lru_cache
from hashlib import blake2b

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, text_of, unpacked

ROUNDS = 8


def permute(value: int, size: int, key: bytes, tweak: str, inverse: bool = False) -> int:
    """A keyed bijection of 0 .. size - 1."""
    if size < 2:
        return value
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask, width = (1 << half) - 1, (half + 7) // 8

    def mix(i: int, x: int) -> int:
        seed, out, n = b"%d|%d|%s|" % (i, size, tweak.encode()) + x.to_bytes(width, "big"), b"", 0
        while len(out) < width:
            out, n = out + blake2b(seed + b"%d" % n, key=key, digest_size=min(64, width)).digest(), n + 1
        return int.from_bytes(out[:width], "big") & mask

    while True:
        a, b = value >> half, value & mask
        for i in reversed(range(ROUNDS)) if inverse else range(ROUNDS):
            a, b = (b ^ mix(i, a), a) if inverse else (b, a ^ mix(i, b))
        value = a << half | b
        if value < size:
            return value


def permute_characters(text: str, key: bytes, tweak: str, inverse: bool = False) -> str:
    """Permute digits among digits and ASCII letters among letters of their case, all places as one number."""
    radix = lambda c: 10 if "0" <= c <= "9" else 26 if "a" <= c <= "z" or "A" <= c <= "Z" else 1
    base = lambda c: ord("0") if c.isdigit() else ord("a") if c.islower() else ord("A")
    value, size = 0, 1
    for c in text:
        if (r := radix(c)) > 1:
            value, size = value * r + ord(c) - base(c), size * r
    value, out = permute(value, size, key, tweak, inverse), []
    for c in reversed(text):
        if (r := radix(c)) > 1:
            value, at = divmod(value, r)
            c = chr(base(c) + at)
        out.append(c)
    return "".join(reversed(out))


def permute_hex(text: str, key: bytes, tweak: str, inverse: bool = False) -> str:
    return f"{permute(int(text, 16), 16 ** len(text), key, tweak, inverse):0{len(text)}x}"


def luhn_digit(body: str) -> str:
    total = sum(sum(divmod(int(c) * (2 - i % 2), 10)) for i, c in enumerate(reversed(body)))
    return str(-total % 10)


def regrouped(like: str, digits: str) -> str:
    """``digits`` in the places of the digits of ``like``."""
    rest = iter(digits)
    return "".join(next(rest) if c.isdigit() else c for c in like)


def _card(m: re.Match, key: bytes, inverse: bool) -> str | None:
    digits = re.sub(r"\D", "", m[0])
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1] or len(set(digits)) == 1:
        return None
    body = permute_characters(digits[:-1], key, "card", inverse)
    return regrouped(m[0], body + luhn_digit(body))


def _iban(m: re.Match, key: bytes, inverse: bool) -> str | None:
    text = m[0].replace(" ", "")
    check = lambda country, bban: 98 - int("".join(str(int(c, 36)) for c in bban + country + "00")) % 97
    if not 15 <= len(text) <= 34 or int(text[2:4]) != check(text[:2], text[4:]):
        return None
    bban = permute_characters(text[4:], key, "iban", inverse)
    rest = iter(f"{text[:2]}{check(text[:2], bban):02d}{bban}")
    return "".join(" " if c == " " else next(rest) for c in m[0])


def _ssn(m: re.Match, key: bytes, inverse: bool) -> str | None:
    area, group, serial = map(int, m.groups())
    if not (0 < area < 900 and area != 666 and group and serial):
        return None
    areas = 898  # 1 to 899 without 666
    value = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    rest, serial = divmod(permute(value, areas * 99 * 9999, key, "ssn", inverse), 9999)
    area, group = divmod(rest, 99)
    area += 1 + (area >= 665)
    return f"{area:03d}-{group + 1:02d}-{serial + 1:04d}"


# Country calling codes of one and of two digits; all others have three.
SHORT_CODES = set("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())


def _number(code: str, rest: str, key: bytes, inverse: bool) -> str:
    """The permuted subscriber digits. Ten digits under code 1 stay dialable if they are, and only then."""
    dialable = lambda x: code == "1" and len(x) == 10 and x[0] > "1" and x[3] > "1"
    new = rest
    while True:
        new = permute_characters(new, key, "phone", inverse)
        if dialable(new) == dialable(rest):
            return new


def _phone(m: re.Match, key: bytes, inverse: bool) -> str | None:
    digits = re.sub(r"\D", "", m[0])
    code = next((digits[:n] for n in (1, 2) if digits[:n] in SHORT_CODES), digits[:3])
    rest = digits[len(code) :]
    if not 7 <= len(rest) <= 13:
        return None
    return regrouped(m[0], code + _number(code, rest, key, inverse))


def _national(m: re.Match, key: bytes, inverse: bool) -> str | None:
    return regrouped(m[0], _number("1", re.sub(r"\D", "", m[0]), key, inverse))


def _ip(m: re.Match, key: bytes, inverse: bool) -> str | None:
    parts = [int(x) for x in m[0].split(".")]
    if max(parts) > 255 or any(len(x) > 1 and x[0] == "0" for x in m[0].split(".")):
        return None
    value = permute(int.from_bytes(bytes(parts), "big"), 1 << 32, key, "ip", inverse)
    return ".".join(map(str, value.to_bytes(4, "big")))


FIRST_DAY, DAYS = date(1900, 1, 1), (date(2100, 1, 1) - date(1900, 1, 1)).days


def _date(m: re.Match, key: bytes, inverse: bool) -> str | None:
    """Year first, or day and month before the year (the month first where only that is a date)."""
    if m["y1"]:
        order, sep = ("y", "m", "d"), m["s1"]
        year, month, day = int(m["y1"]), int(m["m1"]), int(m["d1"])
    else:
        sep, year, day, month = m["s2"], int(m["y2"]), int(m["d2"]), int(m["m2"])
        order = ("d", "m", "y")
        if month > 12:
            day, month, order = month, day, ("m", "d", "y")
    try:
        at = (date(year, month, day) - FIRST_DAY).days
    except ValueError:
        return None
    if not 0 <= at < DAYS:
        return None
    # Days up to the 12th stay so, as do later ones, in any order: else a date with the month first could be read otherwise.
    new = at
    while True:
        new = permute(new, DAYS, key, "date", inverse)
        found = FIRST_DAY + timedelta(days=new)
        if (found.day > 12) == (day > 12):
            break
    values = {"y": f"{found.year:04d}", "m": f"{found.month:02d}", "d": f"{found.day:02d}"}
    return sep.join(values[x] for x in order)


def _email(m: re.Match, key: bytes, inverse: bool) -> str | None:
    head, dot, tail = m[0].rpartition(".")
    new = permute_characters(head.lower(), key, "email", inverse)
    return "".join(b.upper() if a.isupper() else b for a, b in zip(head, new)) + dot + tail


def _secret(m: re.Match, key: bytes, inverse: bool) -> str | None:
    value = m["value"]
    new = permute_hex(value, key, "hex", inverse) if re.fullmatch(r"[0-9a-f]+", value) else permute_characters(value, key, "secret", inverse)
    return m[0][: m.start("value") - m.start()] + new + m[0][m.end("value") - m.start() :]


#: kind, texts of which a document must hold one for the pattern to be tried, case aside (None: a digit), pattern, replacement. Earlier kinds win.
KINDS: list[tuple[str, tuple[str, ...] | None, re.Pattern, Callable[[re.Match, bytes, bool], str | None]]] = [
    ("email", ("@",), re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9-])"), _email),
    ("secret", ("token", "secret", "passw", "key"), re.compile(r"(?i:token|secret|password|passwd|api[_-]?key|access[_-]?key)[\"']?\s{0,3}[=:]\s{0,3}[\"']?(?P<value>[A-Za-z0-9_/+-]{16,512})"), _secret),
    ("secret", ("akia", "asia"), re.compile(r"(?<![A-Za-z0-9])(?:AKIA|ASIA)(?P<value>[A-Z0-9]{16})(?![A-Za-z0-9])"), _secret),
    ("iban", None, re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])"), _iban),
    ("phone", None, re.compile(r"(?P<code>(?<![\w+])\+\d{1,3}[ .-]?)(?P<rest>\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){2,4})(?!\d)"), _phone),
    ("phone", None, re.compile(r"(?<![\w+.-])(?:\([2-9]\d{2}\) ?[2-9]\d{2}[ .-]|[2-9]\d{2}(?P<mark>[.-])[2-9]\d{2}(?P=mark))\d{4}(?![\w-]|\.\d)"), _national),
    ("card", None, re.compile(r"(?<![\w.+-])\d{4}(?:[ -]?\d{2,6}){2,4}(?![\w-])"), _card),
    ("ssn", None, re.compile(r"(?<![\w-])(\d{3})-(\d{2})-(\d{4})(?![\w-])"), _ssn),
    ("date", None, re.compile(r"(?<![\w./-])(?:(?P<y1>\d{4})(?P<s1>[-/.])(?P<m1>\d{2})(?P=s1)(?P<d1>\d{2})|(?P<d2>\d{2})(?P<s2>[-/.])(?P<m2>\d{2})(?P=s2)(?P<y2>\d{4}))(?![\w-]|[./]\d)"), _date),
    ("ip", None, re.compile(r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)"), _ip),
]
_DIGIT = re.compile("[0-9]")


#: Checked kinds whose pattern may take in what stands before or behind a value: pattern of the value alone.
PARTS = {"iban": re.compile(r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}"), "card": re.compile(r"\d{4}(?:[ -]?\d{2,6}){2,4}")}
IBAN_LENGTH = {"AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IT": 27, "LT": 20, "LU": 20, "LV": 21, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "SE": 24, "SI": 19, "SK": 24}


def _within(m: re.Match, part: re.Pattern, replace: Callable, key: bytes, inverse: bool) -> tuple[int, int, str] | None:
    """(start, end, replacement) of the first valid value in a match that is none as a whole: an IBAN of its country's length, or else the longest."""
    text, tried = m.string, [(m.start(), m.end())]
    breaks = [i for i in range(m.start(), m.end()) if text[i] in " -"]
    for a in [m.start(), *[i + 1 for i in breaks]]:
        ends = [m.end(), *[i for i in reversed(breaks) if i > a]]
        if length := IBAN_LENGTH.get(text[a : a + 2]):
            ends.sort(key=lambda b: len(text[a:b].replace(" ", "")) != length)
        for b in ends:
            if not (x := part.fullmatch(text, a, b)):
                continue
            if (new := replace(x, key, inverse)) is None:
                tried.append((a, b))
                continue
            # Walk on while the new text would be read otherwise, so that the key can undo it.
            while True:
                then = text[:a] + new + text[b:]
                if not any((y := part.fullmatch(then, i, j)) and replace(y, key, inverse) is not None for i, j in tried):
                    return a, b, new
                new = replace(part.fullmatch(then, a, b), key, inverse)
    return None


def pseudonymise(text: str, key: bytes, inverse: bool = False) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with every found value replaced, and (kind, start, end) of each in the old text."""
    digits, lower, spans = _DIGIT.search(text), text.lower(), []
    for kind, needs, pattern, replace in KINDS:
        if not (any(x in lower for x in needs) if needs else digits):
            continue
        free = lambda start, end: all(end <= a or start >= b for a, b, _, _ in spans)
        at = 0
        while m := pattern.search(text, at):
            at = m.end()
            if free(m.start(), m.end()) and (new := replace(m, key, inverse)) is not None:
                spans.append((m.start(), m.end(), kind, new))
            elif kind in PARTS:
                if (found := _within(m, PARTS[kind], replace, key, inverse)) and free(*found[:2]):
                    spans.append((*found[:2], kind, found[2]))
                    at = found[1]
                elif " " in m[0]:  # a value may begin in this match and go on behind it
                    at = m.start() + m[0].index(" ") + 1
    if not spans:
        return text, []
    spans.sort()
    out, at = [], 0
    for a, b, _, new in spans:
        out += [text[at:a], new]
        at = b
    return "".join([*out, text[at:]]), [(kind, a, b) for a, b, kind, _ in spans]


FOUND = "array<struct<kind:string,start:int,end:int>>"


def pseudonymise_documents(df: DataFrame, key: bytes, text_col: str = "text", inverse: bool = False) -> DataFrame:
    """Replace personal values in every text; add ``found``: kind and place of each in the old text.

    Emails, secrets after a telling name, IBANs, phone numbers with a country
    code or as North American ones are written without, payment cards, social
    security numbers, dates and IPv4 addresses count; numbers with check digits
    and dates only if they are valid. Nothing else of a text changes. ``inverse``
    takes a pseudonymised text back.

    A null text stays null and an empty one empty, both with nothing found; very
    long texts are read whole; rows are independent, so repeated rows, ties and
    empty tables need no care. All other columns are returned; one named
    ``found`` is replaced.
    """
    if not key:
        raise ValueError("a key is needed")

    @F.pandas_udf(f"text string, found {FOUND}")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        cached = lru_cache(1 << 12)(lambda t: pseudonymise(t, key, inverse))
        for batch in batches:
            done = [cached(t) if len(t) < 200 else pseudonymise(t, key, inverse) for t in batch]
            yield pd.DataFrame({"text": [t for t, _ in done], "found": [[{"kind": k, "start": a, "end": b} for k, a, b in f] for _, f in done]})

    made = packed(df, _made=run(text_of(text_col)))
    outputs = {text_col: F.when(F.col("_row").getField(text_col).isNotNull(), F.col("_made.text")), "found": F.col("_made.found")}
    return unpacked(made, df.columns, **outputs).select(*[c for c in df.columns if c != "found"], "found")
