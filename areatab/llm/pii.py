"""Format-preserving pseudonyms for personal data.

Addresses, numbers, dates and secrets are found in the text, validated (Luhn
digit, IBAN remainder, octets, calendar) and replaced by another valid value of
the same format: the value's place in the format's domain is permuted by a
keyed Feistel network, with cycle walking where the domain is no power of two.
The permutation depends on the key and the kind only, so equal values get equal
pseudonyms in every document and run, different values different ones, and
whoever holds the key can undo it. Lengths and separators stay.

Defined cases: a null text stays null and an empty one empty; digits that fail
their check (a card number without its Luhn digit) are left alone; of an IBAN
with a word in capitals behind it, the IBAN alone changes; repeated
rows change alike; all other columns stay as they are.
"""

from __future__ import annotations

import bisect
import datetime
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from areatab.llm.common import slices

ROUNDS = 8
STRETCH = 64
#: Default key, for tests and demonstrations; a run passes its own.
KEY = b"areatab-pseudonyms"


def day_class(day: datetime.date) -> int:
    """Whether day and month have one digit or two, and whether the day is past the 12th, which tells it from a month."""
    return 3 * (day.month > 9) + (day.day > 9) + (day.day > 12)


#: Days from 1900 to 2099 by class.
DAYS: list[list[int]] = [[] for _ in range(6)]
for _d in range(datetime.date(1900, 1, 1).toordinal(), datetime.date(2100, 1, 1).toordinal()):
    DAYS[day_class(datetime.date.fromordinal(_d))].append(_d)

#: Texts without a digit, an @ or one of these words hold nothing to find.
SUSPECT = r"[0-9@]|(?i:token|secret|passw|api[_-]?key)"
FIND = re.compile(
    r"""
    (?<![\w.+%-])(?P<email>[\w.+%-]++@(?:[A-Za-z0-9-]++\.)++[A-Za-z]{2,24}+)
    |(?i:\b(?:\w{0,40}_)?(?:token|secret|passwd|password|api[_-]?key)\b["']?\s{0,3}[=:]\s{0,3}["']?)(?P<secret>[A-Za-z0-9+/_-]{12,}+)
    |(?<![0-9A-Za-z])(?P<hex>(?=[0-9]*+[a-fA-F])[0-9a-fA-F]{32,}+)(?![0-9A-Za-z])
    |(?<![\w.])(?P<ip>(?:[0-9]{1,3}\.){3}[0-9]{1,3})(?![0-9]|\.[0-9])
    |(?<!\w)(?P<iban>[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?)(?!\w)
    |(?<![\w-])(?P<iso>[0-9]{4}-[0-9]{2}-[0-9]{2})(?:(?=T[0-9]{2}:?[0-9]{2})|(?![\w-]))
    |(?<![\w./-])(?P<day>[0-9]{1,2}([./-])[0-9]{1,2}\8[0-9]{4})(?![\w/-]|\.[0-9])
    |(?<![\w-])(?P<ssn>[0-9]{3}-[0-9]{2}-[0-9]{4})(?![\w-])
    |(?<![\w.+-])(?P<phone>(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ .-]?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4})(?![0-9]|[-.][0-9])
    |(?<![\w+-])(?P<tel>\+[0-9](?:[ .-]?[0-9]){7,13}+)(?![0-9])
    |(?<![0-9A-Za-z.])(?P<card>[0-9]{13,19}+|[0-9]{4}([ -])[0-9]{4}\13[0-9]{4}\13[0-9]{1,7}+|[0-9]{4}([ -])[0-9]{6}\14[0-9]{5})(?![0-9A-Za-z]|[.-][0-9])
    """,
    re.VERBOSE,
)


#: The length of an IBAN by country.
IBAN_LENGTHS = {c[:2]: int(c[2:]) for c in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DK18 DO28 EE20 EG29 ES24 FI18 FO18 FR27 GB22 GE22 GI23 GL18 "
    "GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 MC27 MD24 ME22 MK19 MR27 MT31 MU30 NL18 NO15 PK24 "
    "PL28 PS29 PT25 QA29 RO24 RS22 SA24 SC31 SE24 SI19 SK24 SM27 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20"
).split()}


def iban_ends(text: str) -> list[int]:
    """Where an IBAN that begins ``text`` may end: its country's length, then all of it, then at each blank, longest first."""
    ends = [len(text), *(m.start() for m in reversed(list(re.finditer(" ", text))))]
    own = IBAN_LENGTHS.get(text[:2])
    return sorted(ends, key=lambda e: len(text[:e].replace(" ", "")) != own)


def feistel(value: int, size: int, key: bytes, kind: str, backwards: bool = False) -> int:
    """A permutation of 0 ... size - 1 by key and kind: a balanced network, walked until it lands inside."""
    if size < 2:
        return value
    half = max(1, -(-(size - 1).bit_length() // 2))
    mask, n_bytes = (1 << half) - 1, -(-half // 8)
    salt = len(key).to_bytes(4, "big") + key + kind.encode() + b"/" + format(size, "x").encode() + b"/"

    def turn(i: int, x: int) -> int:
        found = hashlib.shake_256(salt + bytes([i]) + x.to_bytes(n_bytes, "big")).digest(n_bytes)
        return int.from_bytes(found, "big") & mask

    while True:
        left, right = value >> half, value & mask
        if backwards:
            for i in reversed(range(ROUNDS)):
                left, right = right ^ turn(i, left), left
        else:
            for i in range(ROUNDS):
                left, right = right, left ^ turn(i, right)
        value = left << half | right
        if value < size:
            return value


def luhn_digit(digits: str) -> int:
    """The check digit that completes ``digits``."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (2 if k % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return -total % 10


def iban_rest(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


LETTERS = (
    "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "".join(chr(c) for c in range(0xDF, 0x100) if c != 0xF7), "".join(chr(c) for c in range(0xC0, 0xDF) if c != 0xD7),
)


def by_class(text: str, key: bytes, kind: str, backwards: bool) -> str:
    """Permute among the texts whose every character is of the same class; other characters stay.

    Long texts are permuted in stretches of ``STRETCH`` characters, which keeps the work linear.
    """
    if len(text) > STRETCH:
        parts = [text[i : i + STRETCH] for i in range(0, len(text), STRETCH)]
        return "".join(by_class(p, key, f"{kind}+{i}", backwards) for i, p in enumerate(parts))
    sets = [next((s for s in LETTERS if c in s), c) for c in text]
    value, size = 0, 1
    for c, s in zip(text, sets, strict=True):
        value, size = value * len(s) + s.index(c), size * len(s)
    # the pattern is part of the kind: texts of one size but different patterns are unrelated
    value = feistel(value, size, key, kind, backwards)
    out = []
    for s in reversed(sets):
        value, at = divmod(value, len(s))
        out.append(s[at])
    return "".join(reversed(out))


def digits(text: str, key: bytes, kind: str, backwards: bool, keep: int = 0) -> str:
    """Permute the digits after the first ``keep``; all that is no digit stays in its place."""
    own = [c for c in text if c in LETTERS[0]]
    rest = "".join(own[keep:])
    new = iter(own[:keep] + list(str(feistel(int(rest), 10 ** len(rest), key, f"{kind}{keep}", backwards)).zfill(len(rest))))
    return "".join(next(new) if c in LETTERS[0] else c for c in text)


def email(text: str, key: bytes, back: bool) -> str:
    name, _, host = text.rpartition("@")
    host, _, top = host.rpartition(".")
    return f"{by_class(name, key, 'name', back)}@{by_class(host, key, 'host', back)}.{top}"


def secret(text: str, key: bytes, back: bool) -> str:
    if len(text) > STRETCH:
        parts = [text[i : i + STRETCH] for i in range(0, len(text), STRETCH)]
        return "".join(secret(p, key + i.to_bytes(4, "big"), back) for i, p in enumerate(parts))
    if re.fullmatch("[0-9a-f]+|[0-9A-F]+", text):
        new = format(feistel(int(text, 16), 16 ** len(text), key, "hex", back), "x").zfill(len(text))
        return new.upper() if re.search("[A-F]", text) else new
    return by_class(text, key, "secret", back)


def ip(text: str, key: bytes, back: bool) -> str | None:
    """Octets keep their number of digits."""
    parts = text.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    low, count = zip(*[((0, 10), (10, 90), (100, 156))[len(p) - 1] for p in parts], strict=True)
    value, size = 0, 1
    for p, a, n in zip(parts, low, count, strict=True):
        value, size = value * n + int(p) - a, size * n
    value = feistel(value, size, key, "ip" + "".join(str(len(p)) for p in parts), back)
    out = []
    for a, n in zip(reversed(low), reversed(count), strict=True):
        value, rest = divmod(value, n)
        out.append(str(rest + a))
    return ".".join(reversed(out))


def iban(text: str, key: bytes, back: bool) -> str | None:
    """Country stays, check digits are computed anew."""
    plain = text.replace(" ", "")
    if not 15 <= len(plain) <= 34 or iban_rest(plain) != 1:
        return None
    body = by_class(plain[4:], key, "iban" + plain[:2], back)
    new = iter(f"{plain[:2]}{98 - iban_rest(plain[:2] + '00' + body):02d}{body}")
    return "".join(c if c == " " else next(new) for c in text)


def card(text: str, key: bytes, back: bool) -> str | None:
    plain = "".join(c for c in text if c in LETTERS[0])
    if luhn_digit(plain[:-1]) != int(plain[-1]):
        return None
    body = digits(plain[:-1], key, "card", back)
    new = iter(body + str(luhn_digit(body)))
    return "".join(next(new) if c in LETTERS[0] else c for c in text)


def date(text: str, key: bytes, back: bool) -> str | None:
    """A day from 1900 to 2099; the same day in another notation gets the same new day.

    Numbers of digits stay, and days after the 12th stay after the 12th, so a
    notation is as long and reads as clearly as before.
    """
    parts = re.split("[./-]", text)
    sep = text[len(parts[0])]
    orders = [(0, 1, 2)] if len(parts[0]) == 4 else [(2, 1, 0), (2, 0, 1)]  # day first unless that is no day
    for y, m, d in orders:
        try:
            old = datetime.date(int(parts[y]), int(parts[m]), int(parts[d]))
        except ValueError:
            continue
        if 1900 <= old.year < 2100:
            days = DAYS[day_class(old)]
            place = bisect.bisect_left(days, old.toordinal())
            new = datetime.date.fromordinal(days[feistel(place, len(days), key, f"date{day_class(old)}", back)])
            put = {y: new.year, m: new.month, d: new.day}
            return sep.join(f"{put[k]:0{len(parts[k])}d}" for k in range(3))
    return None


KINDS: dict[str, Callable[[str, bytes, bool], str | None]] = {
    "email": email, "secret": secret, "hex": secret, "ip": ip, "iban": iban, "iso": date, "day": date, "card": card,
    "ssn": lambda t, key, back: digits(t, key, "ssn", back),
    "phone": lambda t, key, back: digits(t, key, "phone", back, max(0, sum(map(str.isdigit, t)) - 10)),
    "tel": lambda t, key, back: digits(t, key, "phone", back, 2),
}


def pseudonyms(text: str, key: bytes = KEY, backwards: bool = False) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with every value replaced, and (start, end, kind) of each in the new text."""
    out, end, spans, length, pos = [], 0, [], 0, 0
    while m := FIND.search(text, pos):
        kind = m.lastgroup if m.lastgroup in KINDS else next(k for k in KINDS if m[k] is not None)
        a, b = m.span(kind)
        # a word in capitals behind an IBAN looks like its last group
        for b in iban_ends(m[kind]) if kind == "iban" else (b - a,):
            new = KINDS[kind](m[kind][:b], key, backwards)
            if new is not None:
                break
        b += a
        if new is None:
            # not this kind after all: what begins later may still be something
            pos = b if kind == "card" else a + 1
            continue
        out += [text[end:a], new]
        length += a - end
        spans.append((length, length + len(new), kind))
        length += len(new)
        end = pos = b
    out.append(text[end:])
    return "".join(out), spans


def replaced(texts: pa.Array, key: bytes, backwards: bool = False) -> tuple[pa.Array, list[list[dict]]]:
    texts = texts.cast(pa.string())
    look = pc.fill_null(pc.match_substring_regex(texts, SUSPECT), False).to_pylist()
    if not any(look):
        return texts, [[] for _ in look]
    new, spans = [], []
    for t, some in zip(texts, look, strict=True):
        changed, found = pseudonyms(t.as_py(), key, backwards) if some else (t, [])
        new.append(changed if some else t.as_py())
        spans.append([{"start": a, "end": b, "kind": k} for a, b, k in found])
    return pa.array(new, pa.string()), spans


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())]))


def pseudonymise(docs: DataFrame, key: bytes = KEY, backwards: bool = False) -> DataFrame:
    """``docs`` with the values in ``text`` replaced; every other column stays as it is."""
    schema = docs.schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            at = batch.schema.get_field_index("text")
            text, _ = replaced(batch.column("text"), key, backwards)
            yield batch.set_column(at, batch.schema.field(at), text.cast(batch.schema.field(at).type))

    return docs.mapInArrow(work, schema)


def report(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """(doc_id, text, n_values, spans): the new text and where its pseudonyms stand (code points)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            text, spans = replaced(batch.column("text"), key)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), text, pa.array([len(x) for x in spans], pa.int64()), pa.array(spans, SPANS)],
                ["doc_id", "text", "n_values", "spans"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(work, "doc_id long, text string, n_values long, spans array<struct<start:int,end:int,kind:string>>")
