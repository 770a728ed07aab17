"""Personal data in texts: patterns propose spans, checksums confirm them, context words adjust their score."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, slices

#: Base kinds in the order of the digest, then the kinds that the operator adds.
BASE = ("email", "ip", "card", "phone")
ADDED = ("card_part", "iban", "phone_local", "phone_part", "ssn")
#: Code points before and behind a span that are read for context words, and the words themselves (fixed values).
BEFORE, BEHIND = 48, 24
CONTEXT = {
    "email": "email e-mail mail contact write correo courriel kontakt",
    "ip": "ip address host server login client adresse",
    "card": "card credit debit visa mastercard amex payment tarjeta carte karte",
    "phone": "phone tel telephone call mobile cell fax telefon teléfono téléphone handy",
    "iban": "iban account bank konto cuenta compte bic swift",
    "ssn": "ssn social security",
}
#: Score of a span by kind, before and after its checksum, if it has one; context adds BONUS; added kinds need LEAST.
PROPOSED = {"email": 0.8, "ip": 0.5, "card": 0.3, "phone": 0.6, "card_part": 0.2, "iban": 0.2, "phone_local": 0.3,
            "phone_part": 0.3, "ssn": 0.3}
CONFIRMED = {"card": 0.8, "card_part": 0.5, "iban": 0.8}
BONUS, LEAST = 0.2, 0.5
#: Digits by which card numbers of the large issuers begin (fixed values).
ISSUERS = ("34", "35", "36", "37", "38", "4", "51", "52", "53", "54", "55", "6011", "62", "65", "2")
#: Length of an account number (IBAN) by country (fixed values).
IBAN_LENGTH = dict(
    AD=24, AE=23, AL=28, AT=20, AZ=28, BA=20, BE=16, BG=22, BH=22, BR=29, BY=28, CH=21, CR=22, CY=28, CZ=24, DE=22, DK=18,
    DO=28, EE=20, EG=29, ES=24, FI=18, FO=18, FR=27, GB=22, GE=22, GI=23, GL=18, GR=27, GT=28, HR=21, HU=28, IE=22, IL=23,
    IQ=23, IS=26, IT=27, JO=30, KW=30, KZ=20, LB=28, LC=32, LI=21, LT=20, LU=20, LV=21, MC=27, MD=24, ME=22, MK=19, MR=27,
    MT=31, MU=30, NL=18, NO=15, PK=24, PL=28, PS=29, PT=25, QA=29, RO=24, RS=22, SA=24, SC=31, SE=24, SI=19, SK=24, SM=27,
    ST=25, SV=28, TL=23, TN=24, TR=26, UA=29, VA=22, VG=24, XK=20)

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
CHAIN = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")
PHONE_LOCAL = re.compile(r"(?<![0-9+().-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9-])")
DIGITS = re.compile(r"[0-9]++")
WORD = re.compile(r"\w+(?:-\w+)*")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    score: float


def luhn(digits: str) -> bool:
    """True if the digits pass the Luhn check: every second digit from the right doubled, digit sums add up to a multiple of ten."""
    odd, even = digits[::-1][::2], digits[::-1][1::2]
    return (sum(map(int, odd)) + sum(2 * int(d) - 9 * (d > "4") for d in even)) % 10 == 0


def mod97(account: str) -> bool:
    """True if an IBAN without spaces leaves 1 modulo 97, its first four characters moved to the end and letters as numbers."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the address pattern, found from each @ so that a long run of name characters is read once."""
    last, at = 0, text.find("@")
    while at >= 0:
        found = DOMAIN.match(text, at)
        if found:
            start = at
            while start > last and text[start - 1] in LOCAL:
                start -= 1
            if start < at:
                yield start, found.end()
                last = found.end()
        at = text.find("@", max(at + 1, last))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four numbers of a dotted chain at a time, from its left; those with a part above 255 are dropped."""
    for chain in CHAIN.finditer(text):
        if text.find(".", chain.start(), chain.end()) < 0:
            continue
        parts = [(m.start(), m.end()) for m in DIGITS.finditer(text, chain.start(), chain.end())]
        for n in range(0, len(parts) - 3, 4):
            four = parts[n:n + 4]
            if all(len(p := text[a:b].lstrip("0")) <= 3 and int(p or 0) <= 255 for a, b in four):
                yield four[0][0], four[3][1]


def cards(text: str) -> Iterator[tuple[int, int, bool]]:
    """Runs of digits with single separators, and whether they are card numbers."""
    for run in CARD.finditer(text):
        if run.end() - run.start() >= 13:
            digits = run[0].replace(" ", "").replace("-", "")
            if len(digits) >= 13:
                yield run.start(), run.end(), len(digits) <= 19 and luhn(digits)


def card_parts(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """Card numbers of whole digit groups inside a longer run, from the left, in an issuer's form of 13 to 19 digits."""
    groups = [(m.start(), m.end()) for m in DIGITS.finditer(text, start, end)]
    n = 0
    while n < len(groups):
        digits, stop = "", n
        while stop < len(groups) and len(digits) + groups[stop][1] - groups[stop][0] <= 19:
            digits += text[groups[stop][0]:groups[stop][1]]
            stop += 1
            if len(digits) >= 13 and digits.startswith(ISSUERS) and luhn(digits):
                yield groups[n][0], groups[stop - 1][1]
                n = stop - 1
                break
        n += 1


def phones(text: str) -> Iterator[tuple[int, int, bool]]:
    for run in PHONE.finditer(text):
        yield run.start(), run.end(), 9 <= sum("0" <= c <= "9" for c in run[0]) <= 15


def phone_part(text: str, start: int, end: int) -> tuple[int, int] | None:
    """The first digit groups of a number that goes on too long: as many as make 9 to 12 digits."""
    digits = 0
    for group in DIGITS.finditer(text, start, end):
        digits += group.end() - group.start()
        if 9 <= digits <= 12:
            return start, group.end()
        if digits > 12:
            return None
    return None


def accounts(text: str) -> Iterator[tuple[int, int]]:
    """IBANs: the country's number of characters, confirmed modulo 97."""
    for run in IBAN.finditer(text):
        length, end, taken = IBAN_LENGTH.get(run[0][:2], 0), run.start(), 0
        while taken < length and end < run.end():
            taken += text[end] != " "
            end += 1
        whole = not (end < len(text) and text[end].isascii() and text[end].isalnum())
        if length and taken == length and whole and mod97(text[run.start():end].replace(" ", "")):
            yield run.start(), end


WORDS = {kind: frozenset(words.split()) for kind, words in CONTEXT.items()}


def near(text: str, kind: str, start: int, end: int) -> bool:
    """True if a context word of the kind stands near the span."""
    family = kind.partition("_")[0]
    around = text[max(0, start - BEFORE):start] + " " + text[end:end + BEHIND]
    return not WORDS[family].isdisjoint(WORD.findall(around.lower()))


def spans(text: str) -> list[Span]:
    """All spans of a text, by kind (base kinds first) and start; offsets are code points, ends exclusive.

    The base kinds are exactly the confirmed leftmost matches of their
    patterns, whatever their score. Added: card and phone numbers inside a
    longer run of digits that failed as a whole, account numbers confirmed
    modulo 97, and national and local numbers that context words must support.
    An added span must not overlap a base one and needs a score of LEAST.
    """
    proposed: list[tuple[str, int, int, bool]] = []
    base: list[tuple[str, int, int]] = [("email", a, b) for a, b in emails(text)]
    if re.search("[0-9]", text):
        base += [("ip", a, b) for a, b in addresses(text)]
        for a, b, good in cards(text):
            if good:
                base.append(("card", a, b))
            else:
                proposed += [("card_part", *part, True) for part in card_parts(text, a, b)]
        for a, b, good in phones(text):
            if good:
                base.append(("phone", a, b))
            elif part := phone_part(text, a, b):
                proposed.append(("phone_part", *part, False))
        proposed += [("iban", a, b, True) for a, b in accounts(text)]
        proposed += [("ssn", m.start(), m.end(), False) for m in SSN.finditer(text)]
        proposed += [("phone_local", m.start(), m.end(), False) for m in PHONE_LOCAL.finditer(text)]

    def scored(kind: str, start: int, end: int, checked: bool) -> Span:
        score = CONFIRMED.get(kind, PROPOSED[kind]) if checked else PROPOSED[kind]
        return Span(kind, start, end, round(min(1.0, score + BONUS * near(text, kind, start, end)), 2))

    out = [scored(*span, True) for span in base]
    taken, n = sorted((a, b) for _, a, b in base), 0
    for kind, a, b, checked in sorted(proposed, key=lambda p: p[1]):
        while n < len(taken) and taken[n][1] <= a:
            n += 1
        free = not any(x < b and y > a for x, y in taken[n:n + 8])
        if free and (span := scored(kind, a, b, checked)).score >= LEAST:
            out.append(span)
    place = {kind: n for n, kind in enumerate(BASE + ADDED)}
    return sorted(out, key=lambda s: (place[s.kind], s.start))


SPANS = "array<struct<kind:string,start:long,stop:long,score:double>>"


def found(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, spans)`` of every row: kind, start, stop (exclusive, code points) and score of each span.

    Null and empty texts have no spans, a null id is returned as it is, a
    repeated row as often as it occurs, an empty table gives an empty result;
    other columns are not read. A text is read whole, whatever its length, in
    time that grows with it (no pattern reads a run twice).
    """
    layout = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in slices(batches):
            lists = [[tuple(s) for s in spans(t)] if t else [] for t in batch.column(1).to_pylist()]
            rows = [[dict(zip(("kind", "start", "stop", "score"), s)) for s in spans_] for spans_ in lists]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, layout)], ["doc_id", "spans"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return mapped(picked, run, f"doc_id long, spans {SPANS}")


def digest(rows: DataFrame) -> DataFrame:
    """``(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, scores)``; the counts are those of the base kinds."""
    one = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))
    text = lambda spans: F.array_join(F.transform(spans, one), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return rows.select("doc_id", *map(count, BASE), F.sha2(text(base).cast("binary"), 256).alias("base_sha256"),
                       text(F.col("spans")).alias("spans"), F.transform("spans", lambda s: s["score"]).alias("scores"))


def masked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST) -> DataFrame:
    """``docs`` with every span of ``least`` score or more replaced by its kind in angle brackets.

    Overlapping spans are replaced together, under the kind of the first of
    them. Null texts stay null; columns and rows stay as they are.
    """
    at = docs.columns.index(text_col)

    def clean(text: str | None) -> str | None:
        if not text:
            return text
        out, last, open_ = [], 0, None
        for s in sorted((s for s in spans(text) if s.score >= least), key=lambda s: (s.start, -s.end)):
            if open_ and s.start < open_[1]:
                open_[1] = max(open_[1], s.end)
                continue
            if open_:
                out += [text[last:open_[0]], f"<{open_[2]}>"]
                last = open_[1]
            open_ = [s.start, s.end, s.kind]
        if open_:
            out += [text[last:open_[0]], f"<{open_[2]}>"]
            last = open_[1]
        return "".join(out) + text[last:]

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in slices(batches):
            texts = pa.array([clean(t) for t in batch.column(at).to_pylist()], batch.schema.field(at).type)
            yield batch.set_column(at, batch.schema.field(at), texts)

    return mapped(docs, run, docs.schema)
