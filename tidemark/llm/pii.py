"""Personal data in texts: patterns propose, checksums confirm, context adjusts."""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import by_batch, whole_text

# Fixed by the contract of the query, in its order.
BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("iban", "ssn", "local_phone", "secret")
KINDS = BASE_KINDS + ADDED_KINDS

THRESHOLD = 0.6
NEARBY = 40
# Words that make a kind likelier when they stand near a match.
CONTEXT = {
    "email": {"email", "mail", "contact", "correo", "courriel"},
    "ip": {"ip", "address", "host", "server", "login"},
    "card": {"card", "credit", "visa", "mastercard", "amex", "carte", "karte", "tarjeta"},
    "phone": {"phone", "tel", "call", "mobile", "fax", "telefon", "téléphone", "teléfono"},
    "iban": {"iban", "account", "bank", "konto", "compte", "cuenta"},
    "ssn": {"ssn", "social", "security"},
    "secret": {"token", "key", "apikey", "api_key", "secret", "password", "passwd", "bearer", "credential"},
    "local_phone": {"phone", "tel", "call", "mobile", "cell", "fax", "telefon", "téléphone", "teléfono"},
}
# A checksum or a narrow form is enough alone; weaker forms need a context word.
PRIOR = {"email": 0.9, "ip": 0.7, "card": 0.9, "phone": 0.8, "iban": 0.9, "ssn": 0.4, "local_phone": 0.4, "secret": 0.4}
BONUS = 0.3
# An account number in small letters needs a context word as well as its checksum.
SMALL_LETTERS = 0.5

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A number never starts within a run of digits: the run's first digit would have matched.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Za-z]{2}[0-9]{2}(?: ?[A-Za-z0-9]){11,30}(?![A-Za-z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_LOCAL_PHONE = re.compile(r"(?<![0-9+.-])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9.-])")
# Keys as they are issued: long runs of hexadecimal digits, letters among them.
_SECRET = re.compile(r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![A-Za-z0-9])")
_DIGIT = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_WORD = re.compile(r"\w+")
_WORD_CHARACTER = re.compile(r"\w")

SPANS = "array<struct<kind:string,start:int,end:int,score:double>>"
_SPAN_TYPE = pa.list_(pa.struct([
    ("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()),
]))


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> list[tuple[int, int]]:
    """From each @ outwards, which takes linear time whatever stands before it."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        start = at
        if domain:
            while start > free and text[start - 1] in _LOCAL:
                start -= 1
        if start < at:
            found.append((start, domain.end()))
            free = domain.end()
            at = text.find("@", free)
        else:
            at = text.find("@", at + 1)
    return found


def _is_ip(value: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in value.split("."))


def _is_card(value: str) -> bool:
    digits = _NOT_DIGIT.sub("", value)
    return 16 <= len(digits) <= 19 and luhn(digits)


def _is_phone(value: str) -> bool:
    return 8 <= len(_NOT_DIGIT.sub("", value)) <= 15


def _ibans(text: str) -> list[tuple[int, int]]:
    """Trailing groups go until the checksum holds, as other words may follow; the search goes on behind the last kept."""
    found, match = [], _IBAN.search(text)
    while match:
        value, at = match[0], match.start() + 4
        while len(value.replace(" ", "")) >= 15:
            if mod97(value.replace(" ", "")):
                at = match.start() + len(value)
                found.append((match.start(), at))
                break
            if " " not in value:
                break
            value = value.rpartition(" ")[0]
        match = _IBAN.search(text, at)
    return found


def _is_ssn(value: str) -> bool:
    area, group, serial = value.split("-")
    return area not in ("000", "666") and area < "900" and group != "00" and serial != "0000"


def _is_local_phone(value: str) -> bool:
    """Area and exchange of a ten-digit number never begin with 0 or 1."""
    digits = _NOT_DIGIT.sub("", value)
    return digits[0] > "1" and digits[3] > "1"


def _inside_word(text: str, at: int) -> bool:
    return 0 < at < len(text) and _WORD_CHARACTER.match(text, at - 1) is not None and _WORD_CHARACTER.match(text, at) is not None


def _score(kind: str, text: str, start: int, end: int) -> float:
    """Prior of the kind, and a bonus for a context word that stands whole within ``NEARBY`` characters."""
    left, right = max(0, start - NEARBY), min(len(text), end + NEARBY)
    while left < start and _inside_word(text, left):
        left += 1
    while right > end and _inside_word(text, right):
        right -= 1
    close = CONTEXT[kind].intersection(_WORD.findall((text[left:start] + " " + text[end:right]).lower()))
    prior = PRIOR[kind] - (SMALL_LETTERS if kind == "iban" and not text[start:end].isupper() else 0.0)
    return round(min(1.0, prior + (BONUS if close else 0.0)), 2)


def find_spans(text: str) -> list[tuple[str, int, int, float]]:
    """Spans (kind, start, end, score) in code points, by kind as in ``KINDS`` and then by start."""
    by_kind: dict[str, list[tuple[int, int]]] = {"email": _emails(text)}
    if _DIGIT.search(text):
        for kind, pattern, valid in (
            ("ip", _IP, _is_ip), ("card", _CARD, _is_card), ("phone", _PHONE, _is_phone),
            ("ssn", _SSN, _is_ssn), ("local_phone", _LOCAL_PHONE, _is_local_phone),
            ("secret", _SECRET, lambda value: not value.isdigit()),
        ):
            by_kind[kind] = [m.span() for m in pattern.finditer(text) if valid(m[0])]
        by_kind["iban"] = _ibans(text)
    found = []
    for kind in BASE_KINDS:
        found += [(kind, a, b, _score(kind, text, a, b)) for a, b in by_kind.get(kind, ())]
    taken = sorted((a, b) for _, a, b, _ in found)
    starts = [a for a, _ in taken]
    # The furthest end of the base spans so far: one that starts before b reaches beyond a, or none does.
    reach = list(accumulate((b for _, b in taken), max))
    for kind in ADDED_KINDS:
        for a, b in by_kind.get(kind, ()):
            score = _score(kind, text, a, b)
            before = bisect_left(starts, b)
            if score >= THRESHOLD and not (before and reach[before - 1] > a):
                found.append((kind, a, b, score))
    return found


def find_pii(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans`` of every row.

    The four base kinds are always reported; their score is informative. Added
    kinds need a score of 0.6 and must not overlap a base span. Null and empty
    texts have no spans. Rows are taken one by one: null or repeated ids and
    copies change nothing, other columns are not read, an empty table gives an
    empty result, and every pattern takes linear time on very long texts.
    """

    def run(batch: pa.Table) -> pa.Table:
        spans = [
            [dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in find_spans(t)]
            for t in batch.column("text").to_pylist()
        ]
        return pa.table({"doc_id": batch.column("doc_id"), "spans": pa.array(spans, _SPAN_TYPE)})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return by_batch(rows, run, f"doc_id long, spans {SPANS}")


def redact(docs: DataFrame) -> DataFrame:
    """The same rows and columns with every span's text replaced by its kind in angle brackets.

    Overlapping spans become one, named after the first. ``n_chars`` follows the
    new text where the table has it. A null text stays null; rows without spans
    stay as they are.
    """
    names = docs.columns

    def mask(text: str) -> str:
        merged: list[list] = []
        for kind, start, end, _ in sorted(find_spans(text), key=lambda s: (s[1], -s[2])):
            if merged and start < merged[-1][2]:
                merged[-1][2] = max(end, merged[-1][2])
            else:
                merged.append([kind, start, end])
        parts, at = [], 0
        for kind, start, end in merged:
            parts += [text[at:start], f"<{kind.upper()}>"]
            at = end
        return "".join([*parts, text[at:]])

    def run(batch: pa.Table) -> pa.Table:
        texts = [None if t is None else mask(t) for t in batch.column("text").to_pylist()]
        return batch.set_column(names.index("text"), batch.schema.field("text"), pa.array(texts, batch.schema.field("text").type))

    masked = by_batch(docs, run, docs.schema)
    if "n_chars" not in names:
        return masked
    kind = docs.schema["n_chars"].dataType
    return masked.withColumn("n_chars", F.coalesce(F.length("text"), F.col("n_chars")).cast(kind))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` joined by commas, in the order of the spans."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def pii_digests(found: DataFrame) -> DataFrame:
    """Counts of base spans, the hash of their list, all spans as text, their scores in the same order, and their number."""
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *map(count, BASE_KINDS),
        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"),
        F.array_join(F.transform("spans", lambda s: s["score"].cast("string")), ",").alias("scores"),
        F.size("spans").cast("long").alias("n_spans"),
    )
