"""Format-preserving pseudonyms: personal values are permuted within their format by a keyed Feistel network."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from datetime import date, timedelta
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from cairnlake.llm.common import pick, table
from cairnlake.llm.words import slices

#: A stand-in. Whoever has the key can undo the pseudonyms, so a real one comes from outside.
DEFAULT_KEY = b"replace this key"
ROUNDS = 8

FIRST_DAY, LAST_DAY = date(1900, 1, 1), date(2099, 12, 31)


def permute(value: int, size: int, key: bytes, kind: str, back: bool = False) -> int:
    """A keyed bijection of 0 .. size-1: a Feistel network over pairs of digits to the base
    ceil(sqrt(size)), walked on until the result is below ``size``. back: the inverse."""
    if size < 2:
        return value
    base = isqrt(size - 1) + 1
    while True:
        left, right = divmod(value, base)
        for turn in reversed(range(ROUNDS)) if back else range(ROUNDS):
            if back:
                left, right = (right - _noise(left, turn, base, key, kind)) % base, left
            else:
                left, right = right, (left + _noise(right, turn, base, key, kind)) % base
        value = left * base + right
        if value < size:
            return value


def _noise(half: int, turn: int, base: int, key: bytes, kind: str) -> int:
    size = base.bit_length() // 8 + 9
    text = f"{kind}|{base}|{turn}|{half}".encode()
    out = b"".join(hashlib.blake2b(text + bytes([i]), key=key, digest_size=64).digest() for i in range(-(-size // 64)))
    return int.from_bytes(out[:size], "big") % base


class Mixed:
    """Numbers for strings whose every character stays in its class (digits, small, capitals, hex)."""

    CLASSES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")

    @classmethod
    def permute(cls, text: str, key: bytes, kind: str, back: bool = False, classes: tuple[str, ...] = CLASSES) -> str:
        places = [next((c for c in classes if ch in c), None) for ch in text]
        number, size = 0, 1
        for ch, c in zip(text, places):
            if c:
                number, size = number * len(c) + c.index(ch), size * len(c)
        number = permute(number, size, key, f"{kind}|{''.join(str(len(c)) if c else ch for ch, c in zip(text, places))}", back)
        out = []
        for ch, c in zip(reversed(text), reversed(places)):
            if c:
                number, place = divmod(number, len(c))
                ch = c[place]
            out.append(ch)
        return "".join(reversed(out))


def luhn_digit(digits: str) -> str:
    """The check digit that makes ``digits`` with it a valid card number."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return str(-total % 10)


def _refill(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced in order; separators stay."""
    left = iter(digits)
    return "".join(next(left) if ch.isdigit() else ch for ch in shape)


def _digits(text: str) -> str:
    return re.sub(r"\D", "", text)


# Each kind: value, key, back -> its pseudonym, or None if the value is not valid.
def card(text: str, key: bytes, back: bool = False) -> str | None:
    """13 to 19 digits with a right check digit, which is made anew; the issuer's digit stays."""
    digits = _digits(text)
    issuer, body, last = digits[0], digits[1:-1], digits[-1]
    if not 13 <= len(digits) <= 19 or luhn_digit(issuer + body) != last:
        return None
    body = str(permute(int(body), 10 ** len(body), key, f"card{issuer}{len(body)}", back)).zfill(len(body))
    return _refill(text, issuer + body + luhn_digit(issuer + body))


_GROUP = re.compile(r"\d+")
#: Groups of digits in which cards of several groups are written.
_SHAPES = ([4, 4, 4, 4], [4, 6, 5], [4, 6, 4])


def cards(run: str) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Places of the cards in a run of digit groups, and of the candidates that were tried before and failed.

    Candidates begin and end at borders of groups and have 13 to 19 digits. First come single
    groups, then the usual shapes, the whole run, and all others from the left, longest first.
    """
    groups = [m.span() for m in _GROUP.finditer(run)]
    candidates = []
    for i in range(len(groups)):
        n = 0
        for j in range(i, len(groups)):
            n += groups[j][1] - groups[j][0]
            if n > 19:
                break
            if n >= 13:
                a, b = groups[i][0], groups[j][1]
                usual = [y - x for x, y in groups[i : j + 1]] in _SHAPES and len(set(_GROUP.sub("", run[a:b]))) == 1
                rank = 0 if i == j else 1 if usual else 2 if (a, b) == (0, len(run)) else 3
                candidates.append((rank, a, -b))
    good: list[tuple[int, int]] = []
    failed = []
    for _, a, b in sorted(candidates):
        b = -b
        if any(x < b and a < y for x, y in good):
            continue
        digits = _digits(run[a:b])
        (good if luhn_digit(digits[:-1]) == digits[-1] else failed).append((a, b))
    return sorted(good), failed


def card_run(run: str, key: bytes, back: bool = False) -> list[tuple[int, int, str]]:
    """Cards of a run of digit groups with their pseudonyms.

    A pseudonym next to which a failed candidate would turn valid is permuted on, so that the cards
    of the new run are at the same places and the way back, in the opposite order, finds them.
    """
    good, failed = cards(run)
    for a, b in reversed(good) if back else good:
        near = [(x, y) for x, y in failed if x < b and a < y]
        while True:
            run = run[:a] + card(run[a:b], key, back) + run[b:]
            near_digits = [_digits(run[x:y]) for x, y in near]
            if all(luhn_digit(d[:-1]) != d[-1] for d in near_digits):
                break
    return [(a, b, run[a:b]) for a, b in good]


def phone(text: str, key: bytes, back: bool = False) -> str | None:
    """Ten digits, area and exchange not from 0 or 1; a leading 1 stays."""
    digits = _digits(text)
    lead, ten = ("1", digits[1:]) if len(digits) == 11 and digits[0] == "1" else ("", digits)
    if len(ten) != 10 or ten[0] in "01" or ten[3] in "01":
        return None
    number = ((int(ten[0]) - 2) * 100 + int(ten[1:3])) * 8 + int(ten[3]) - 2
    number = permute(number * 10**6 + int(ten[4:]), 800 * 8 * 10**6, key, "phone", back)
    head, rest = divmod(number, 10**6)
    area, exchange = divmod(head, 8)
    return _refill(text, f"{lead}{area // 100 + 2}{area % 100:02d}{exchange + 2}{rest:06d}")


def ssn(text: str, key: bytes, back: bool = False) -> str | None:
    """ddd-dd-dddd: no part all zero, area not 666 and below 900."""
    area, group, serial = int(text[:3]), int(text[4:6]), int(text[7:])
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    index = (area - 1 - (area > 666)) * 99 * 9999 + (group - 1) * 9999 + serial - 1
    index = permute(index, 898 * 99 * 9999, key, "ssn", back)
    index, serial = divmod(index, 9999)
    area, group = divmod(index, 99)
    area += 1 + (area >= 665)
    return f"{area:03d}{text[3]}{group + 1:02d}{text[6]}{serial + 1:04d}"


#: Octets by their number of digits: least value and how many there are.
_OCTETS = {1: (0, 10), 2: (10, 90), 3: (100, 156)}


def ipv4(text: str, key: bytes, back: bool = False) -> str | None:
    """Each octet keeps its number of digits."""
    parts = text.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    shape = [_OCTETS[len(p)] for p in parts]
    number, size = 0, 1
    for part, (least, count) in zip(parts, shape):
        number, size = number * count + int(part) - least, size * count
    number = permute(number, size, key, "ipv4" + "".join(str(len(p)) for p in parts), back)
    out = []
    for least, count in reversed(shape):
        number, place = divmod(number, count)
        out.append(str(least + place))
    return ".".join(reversed(out))


def _day(year: str, month: str, day: str, key: bytes, back: bool) -> date | None:
    try:
        value = date(int(year), int(month), int(day))
    except ValueError:
        return None
    if not FIRST_DAY <= value <= LAST_DAY:
        return None
    size = (LAST_DAY - FIRST_DAY).days + 1
    return FIRST_DAY + timedelta(permute((value - FIRST_DAY).days, size, key, "date", back))


def iso_date(text: str, key: bytes, back: bool = False) -> str | None:
    new = _day(text[:4], text[5:7], text[8:], key, back)
    return new and f"{new.year}{text[4]}{new.month:02d}{text[7]}{new.day:02d}"


def day_date(text: str, key: bytes, back: bool = False) -> str | None:
    """dd.mm.yyyy, or mm/dd/yyyy if written with slashes."""
    first, second, year = re.split(r"[./]", text)
    slash = "/" in text
    new = _day(year, first if slash else second, second if slash else first, key, back)
    if new is None:
        return None
    a, b = (new.month, new.day) if slash else (new.day, new.month)
    return f"{a:02d}{text[2]}{b:02d}{text[5]}{new.year}"


def email(text: str, key: bytes, back: bool = False) -> str | None:
    """The part before @ is permuted, the domain stays."""
    local, at, domain = text.rpartition("@")
    return Mixed.permute(local, key, "email", back) + at + domain


def secret(text: str, key: bytes, back: bool = False) -> str | None:
    """Keys and passwords: the value behind the name, hexadecimal if it is."""
    m = re.fullmatch(r"(AKIA|.*?[=:]\s*[\"']?)(.*)", text, re.S)
    name, value = m[1], m[2]
    if re.fullmatch(r"[0-9a-f]+", value):
        return name + Mixed.permute(value, key, "hex", back, classes=("0123456789abcdef",))
    return name + Mixed.permute(value, key, "secret", back)


#: kind, what must be in a text for it to be searched, pattern, function. Earlier kinds win.
KINDS: tuple[tuple[str, str, re.Pattern, Callable], ...] = tuple(
    (kind, hint, re.compile(pattern), fn)
    for kind, hint, pattern, fn in (
        ("email", "@", r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", email),
        ("secret", "AKIA", r"(?<![A-Za-z0-9])AKIA[A-Z0-9]{16}(?![A-Za-z0-9])", secret),
        ("secret", "=", r"(?i:\b(?:password|passwd|token|secret|api_?key))\s*=\s*[\"']?[A-Za-z0-9+/_-]{8,}", secret),
        ("card", "", r"(?<![\w.+-])\d(?:[ -]?\d){12,}(?![\w-]|\.\d)", card_run),
        ("phone", "", r"(?<![\w.])(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])", phone),
        ("ssn", "-", r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", ssn),
        ("ipv4", ".", r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)", ipv4),
        ("date", "-", r"(?<![\w-])\d{4}-\d{2}-\d{2}(?![\w-])", iso_date),
        ("date", "/", r"(?<![\w/])\d{4}/\d{2}/\d{2}(?![\w/])", iso_date),
        ("date", "", r"(?<![\w./])(?:\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?![\w/]|\.\d)", day_date),
    )
)
#: All digit kinds have two digits with at most two characters between them.
_TWO_DIGITS = re.compile(r"\d\D{0,2}\d")
_NOT_DIGIT_KINDS = ("email", "secret")


def pseudonymise(text: str, key: bytes, back: bool = False) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with valid values replaced, and their (start, end, kind) in the given text."""
    numbers = None
    spans: list[tuple[int, int, str, str]] = []
    for kind, hint, pattern, fn in KINDS:
        if hint and hint not in text:
            continue
        if kind not in _NOT_DIGIT_KINDS:
            numbers = _TWO_DIGITS.search(text) is not None if numbers is None else numbers
            if not numbers:
                continue
        if fn is card_run:
            # Runs of digits end where a value of an earlier kind begins.
            borders = [0, *(x for a, b, _, _ in sorted(spans) for x in (a, b)), len(text)]
            for start, end in zip(borders[::2], borders[1::2]):
                for m in pattern.finditer(text, start, end):
                    spans += [(m.start() + a, m.start() + b, kind, new) for a, b, new in card_run(m[0], key, back)]
            continue
        for m in pattern.finditer(text):
            if any(a < m.end() and m.start() < b for a, b, _, _ in spans):
                continue
            new = fn(m[0], key, back)
            if new is not None:
                spans.append((m.start(), m.end(), kind, new))
    if not spans:
        return text, []
    spans.sort()
    out, at = [], 0
    for a, b, _, new in spans:
        out += [text[at:a], new]
        at = b
    return "".join([*out, text[at:]]), [(a, b, k) for a, b, k, _ in spans]


def pseudonymise_column(df: DataFrame, text_column: str, key: bytes = DEFAULT_KEY, back: bool = False, spans: bool = False) -> DataFrame:
    """``df`` with the personal values of one column replaced; all rows and other columns stay.

    Validated numbers (cards, phones, social security numbers, addresses of machines) and dates,
    and besides them mail names and secrets, are permuted within their format, so equal values
    stay equal in all documents however they are spaced, and with the key ``back`` restores them
    (a card among further digits may have another pseudonym if that is needed for the way back).
    Work is by row: no shuffle. spans: also ``pii_spans``, an array of (start, end, kind) in the given
    text, which replaces a column of that name.

    A NULL text stays NULL with no span, an empty one empty; repeated rows get equal results; an
    empty table gives an empty result; other columns, whatever their names, pass unchanged.
    """
    at = df.columns.index(text_column)
    named = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    found = "array<struct<start:int,end:int,kind:string>>"
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in named.schema.fields) + f", spans {found}"
    span_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1000):
            texts, places = [], []
            for text in batch.column(at).to_pylist():
                new, where = (None, []) if text is None else pseudonymise(text, key, back)
                texts.append(new)
                places.append([{"start": a, "end": b, "kind": k} for a, b, k in where])
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(places, span_type)], names=[*batch.schema.names, "spans"])

    out = named.mapInArrow(run, schema)
    if not spans:
        return out.drop("spans").toDF(*df.columns)
    kept = [i for i, c in enumerate(df.columns) if c != "pii_spans"]
    return out.select(*[f"_c{i}" for i in kept], "spans").toDF(*[df.columns[i] for i in kept], "pii_spans")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pseudonymise_column(docs, "text", spans=True)
    return found.selectExpr("doc_id", "text", "cast(size(pii_spans) as bigint) as n_found", "array_join(array_sort(array_distinct(pii_spans.kind)), ',') as kinds")
