"""Personal data in texts: patterns propose spans, checks confirm them, words nearby adjust a score.

A proposal starts with its kind's score. A check (Luhn, mod 97, an address parser, number ranges)
either refuses it or adds to the score, and so do words of its kind within ``NEAR`` code points. What
reaches the limit is reported. Four base kinds are fixed patterns whose checked matches are always
reported, whatever their score; the other proposals only add to them.

Texts of a slice are joined by line breaks, which no pattern contains, and searched in one go. No
pattern backtracks over a run twice: addresses are looked for from their sign outwards, and number
runs are possessive, so long runs of letters or digits cost no more than other text.
"""

import ipaddress
import re
from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tristrata.llm.rows import fresh, slices

LIMIT = 0.6  # score from which an added span is reported
NEAR = 48  # code points before and after a span that are looked at for words
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "national_id", "birth_date")

# What an address is made of, and how long account numbers are, by country.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21,
    "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27,
    "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26,
    "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27,
    "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25,
    "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "ST": 25, "SV": 28,
    "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20,
}
# Words that speak for a kind, and words that speak against it.
WORDS_FOR = {
    "email": "email e-mail mail contact write correo courriel kontakt",
    "ip": "ip ipv4 ipv6 address host server client",
    "card": "card credit debit visa mastercard amex payment karte kreditkarte tarjeta carte",
    "phone": "phone tel telephone telefon call fax mobile cell handy whatsapp teléfono téléphone móvil portable",
    "iban": "iban account bank konto cuenta compte transfer",
    "national_id": "ssn social security",
    "birth_date": "born birth birthday birthdate dob geboren geburtsdatum né née nacido nacida nacimiento naissance",
}
WORDS_AGAINST = {
    "ip": "version release build v",
    "card": "isbn order tracking serial",
    "phone": "isbn order tracking serial version",
    "national_id": "isbn order tracking serial part",
}
FOR, AGAINST = 0.3, -0.3  # what a word nearby adds


def luhn(digits: str) -> bool:
    """Every second digit from the right doubled, digits of the results summed: a multiple of ten."""
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else sum(divmod(2 * d, 10))
    return total % 10 == 0


def mod97(account: str) -> bool:
    """The first four signs moved to the end, letters as two digits: one more than a multiple of 97."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


@dataclass(frozen=True)
class Span:
    kind: str
    start: int
    end: int
    score: float


# -- base kinds: fixed patterns, whole matches kept or dropped -------------------------------------

DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    for m in DOMAIN.finditer(text):
        start = m.start()
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < m.start():
            done = m.end()
            yield start, done


def _is_ip(found: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.split("."))


def _is_card(found: str) -> bool:
    digits = digits_of(found) if len(found) <= 40 else ""
    return 12 <= len(digits) <= 19 and luhn(digits)


def _is_phone(found: str) -> bool:
    return 9 <= len(digits_of(found)) <= 15


def base_spans(text: str) -> Iterator[Span]:
    """Checked matches of the four base kinds; each kind's do not overlap one another."""
    for start, end in emails(text):
        yield Span("email", start, end, 0.9)
    for kind, pattern, right, score in (("ip", IP, _is_ip, 0.7), ("card", CARD, _is_card, 0.8), ("phone", PHONE, _is_phone, 0.7)):
        for m in pattern.finditer(text):
            if right(m.group()):
                yield Span(kind, m.start(), m.end(), score)


# -- added kinds -----------------------------------------------------------------------------------

AT_SIGN = re.compile(r"[\[(]\x20?(?:at|AT)\x20?[\])]")
DOTTED = re.compile(r"\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?[\[(]\x20?(?:dot|DOT)\x20?[\])]\x20?)[A-Za-z0-9-]++)++")
WIDE_DOMAIN = re.compile(r"@[\w-]++(?:\.[\w-]++)*+\.[^\W\d_]{2,}+(?![\w-])|@[\w-]++(?:\.[\w-]++)+")
DIGITS = re.compile(r"[0-9]++")
GROUPED_CARD = re.compile(r"[0-9](?<![0-9.][0-9])[0-9]{3}([.\xa0 ])[0-9]{4}\1[0-9]{4}\1[0-9]{4}(?![0-9.])")
LOCAL_PHONE = re.compile(r"[(0-9](?<![\w+.(/-][(0-9])[0-9]{1,4}\)?[\x20./-]\x20?[0-9]{3,4}(?:[\x20./-][0-9]{2,4}){1,3}(?![\w/-])")
V6 = re.compile(r"[0-9A-Fa-f:](?<![\w:.][0-9A-Fa-f:])[0-9A-Fa-f]{0,3}:[0-9A-Fa-f:]{3,36}(?![\w:])")
IBAN = re.compile(r"[A-Z](?<![A-Za-z0-9][A-Z])[A-Z][0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
SSN = re.compile(r"[0-9](?<![\w-][0-9])[0-9]{2}-[0-9]{2}-[0-9]{4}(?![\w-])")
DATE = re.compile(r"[0-9](?<![\w./-][0-9])(?:[0-9]?[./-][0-9]{1,2}[./-][0-9]{4}|[0-9]{3}-[0-9]{2}-[0-9]{2})(?![\w/-])")


def _spelled_emails(text: str) -> Iterator[Span]:
    """``name [at] example [dot] org``, and addresses with letters beyond ASCII."""
    for m in AT_SIGN.finditer(text):
        domain = DOTTED.match(text, m.end())
        end = m.start() - (text[m.start() - 1 : m.start()] == " ")
        start = end
        while start and text[start - 1] in LOCAL:
            start -= 1
        if domain and start < end:
            yield Span("email", start, domain.end(), 0.7)
    if not text.isascii():
        done = 0
        for m in WIDE_DOMAIN.finditer(text):
            start = m.start()
            while start > done and (text[start - 1] in LOCAL or text[start - 1].isalpha()):
                start -= 1
            done = m.end()
            if start < m.start() and not text[start:done].isascii():
                yield Span("email", start, done, 0.6)


def _issued(digits: str) -> bool:
    """A first digit and a length that card issuers use together."""
    n = len(digits)
    return digits[0] == "4" and n in (13, 16, 19) or digits[0] in "25" and n == 16 or digits[:2] in ("34", "37") and n == 15 or (
        digits[0] == "6" and 16 <= n <= 19
    ) or digits[:2] in ("30", "36", "38") and n == 14


def _other_cards(text: str) -> Iterator[Span]:
    """Cards that stand beside other digits, which the base pattern takes for one number, or with other signs between."""
    for m in CARD.finditer(text):
        found = m.group()
        if _is_card(found):
            continue
        parts = list(DIGITS.finditer(found))
        at = 0
        while at < len(parts):
            size = 4 if [len(p.group()) for p in parts[at : at + 4]] == [4, 4, 4, 4] else 1
            digits = "".join(p.group() for p in parts[at : at + size])
            if 13 <= len(digits) <= 19 and _issued(digits) and luhn(digits):
                yield Span("card", m.start() + parts[at].start(), m.start() + parts[at + size - 1].end(), 0.7)
                at += size
            else:
                at += 1
    for m in GROUPED_CARD.finditer(text):
        digits = digits_of(m.group())
        if _issued(digits) and luhn(digits):
            yield Span("card", m.start(), m.end(), 0.7)


def _local_phones(text: str) -> Iterator[Span]:
    """National numbers; without a word nearby they stay below the limit."""
    for m in LOCAL_PHONE.finditer(text):
        if 7 <= len(digits_of(m.group())) <= 13 and ("(" in m.group()) == (")" in m.group()):
            yield Span("phone", m.start(), m.end(), 0.4)


def _version_six(text: str) -> Iterator[Span]:
    for m in V6.finditer(text):
        try:
            parsed = ipaddress.IPv6Address(m.group())
        except ValueError:
            continue
        if len([g for g in m.group().split(":") if g]) > 2 or parsed.is_link_local:
            yield Span("ip", m.start(), m.end(), 0.7)


def _accounts(text: str) -> Iterator[Span]:
    at = 0
    while m := IBAN.search(text, at):
        at = m.start() + 4
        places = [i for i, c in enumerate(m.group()) if c != " "]
        size = IBAN_LENGTHS.get(m.group()[:2], 0)
        if not 15 <= size <= len(places):
            continue
        end = m.start() + places[size - 1] + 1
        if end < len(text) and (text[end].isalnum() or text[end] == "_"):
            continue
        if mod97(m.group()[: places[size - 1] + 1].replace(" ", "")):
            at = end
            yield Span("iban", m.start(), end, 0.9)


def _national_ids(text: str) -> Iterator[Span]:
    for m in SSN.finditer(text):
        area, group, serial = m.group().split("-")
        if area not in ("000", "666") and area[0] != "9" and group != "00" and serial != "0000":
            yield Span("national_id", m.start(), m.end(), 0.4)


def _birth_dates(text: str) -> Iterator[Span]:
    for m in DATE.finditer(text):
        parts = re.split("[./-]", m.group())
        numbers = sorted(map(int, parts if len(parts[-1]) == 4 else parts[1:] + parts[:1]))
        if 1 <= numbers[0] <= 12 and 1 <= numbers[1] <= 31 and 1880 <= numbers[2] <= 2100:
            yield Span("birth_date", m.start(), m.end(), 0.35)


ADDED: tuple[Callable[[str], Iterator[Span]], ...] = (
    _spelled_emails, _version_six, _other_cards, _local_phones, _accounts, _national_ids, _birth_dates,
)

# -- scores ----------------------------------------------------------------------------------------

_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?|v(?=\d)")
_FOR = {kind: frozenset(words.split()) for kind, words in WORDS_FOR.items()}
_AGAINST = {kind: frozenset(words.split()) for kind, words in WORDS_AGAINST.items()}


def weighed(span: Span, text: str, first: int, last: int) -> float:
    """The span's score with the words nearby, within ``first`` and ``last``."""
    near = text[max(first, span.start - NEAR) : span.start] + " " + text[span.end : min(last, span.end + NEAR)]
    words = set(_WORD.findall(near.lower()))
    score = span.score + FOR * bool(words & _FOR[span.kind]) + AGAINST * bool(words & _AGAINST.get(span.kind, frozenset()))
    return round(min(1.0, max(0.0, score)), 3)


def spans(text: str, starts: list[int], limit: float = LIMIT) -> list[tuple[int, Span, bool]]:
    """(number of the text, span, whether base) for texts that begin at ``starts`` of a joined text.

    Ordered by text, start and kind. An added span that overlaps a base span, or an added one of an
    earlier start, is left out.
    """
    def bounds(span: Span) -> tuple[int, int, int]:
        i = bisect_right(starts, span.start) - 1
        return i, starts[i], starts[i + 1] - 1 if i + 1 < len(starts) else len(text)

    rank = {kind: i for i, kind in enumerate(KINDS)}
    out, taken = [], []
    for span in base_spans(text):
        i, first, last = bounds(span)
        out.append((i, Span(span.kind, span.start - first, span.end - first, weighed(span, text, first, last)), True))
        taken.append((span.start, span.end))
    taken.sort()
    begin = [s for s, _ in taken]
    reach = np.maximum.accumulate([e for _, e in taken]).tolist() if taken else []
    free = 0
    for span in sorted((s for find in ADDED for s in find(text)), key=lambda s: (s.start, rank[s.kind], -s.end)):
        before = bisect_right(begin, span.end - 1)
        if span.start < free or before and reach[before - 1] > span.start:
            continue
        i, first, last = bounds(span)
        score = weighed(span, text, first, last)
        if score >= limit:
            free = span.end
            out.append((i, Span(span.kind, span.start - first, span.end - first, score), False))
    return sorted(out, key=lambda x: (x[0], x[1].start, rank[x[1].kind]))


FOUND = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("score", T.DoubleType()), T.StructField("base", T.BooleanType()),
]))


def find(
    docs: DataFrame, keep: list[str], text_col: str = "text", limit: float = LIMIT, name: str = "found", masked: str | None = None,
) -> DataFrame:
    """The columns ``keep`` with the spans of each whole text, by start and kind.

    A span has ``kind``, ``start`` and ``end`` (code points, end exclusive), ``score`` and ``base``.
    ``masked`` names a further column: the text with each span replaced by its kind in brackets, spans
    that overlap by the first one's. Null texts count as empty. Rows do not depend on one another, so
    repeated rows give equal results and an empty table none; a long text is searched whole, alone.
    Columns of ``keep`` may not have the made names.
    """
    made = [name, *([masked] if masked else [])]
    if clash := {c.lower() for c in keep} & {m.lower() for m in made}:
        raise ValueError(f"columns to keep have names of the result: {sorted(clash)}")
    extra = [T.StructField(name, FOUND)] + ([T.StructField(masked, T.StringType())] if masked else [])
    schema = T.StructType([docs.schema[c] for c in keep] + extra)
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("base", pa.bool_())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, batch.num_columns - 1):
                texts = [t or "" for t in part.column(part.num_columns - 1).to_pylist()]
                starts = [0, *np.cumsum([len(t) + 1 for t in texts]).tolist()][:-1]
                rows: list[list[dict]] = [[] for _ in texts]
                for i, s, base in spans("\n".join(texts), starts, limit):
                    rows[i].append({"kind": s.kind, "start": s.start, "end": s.end, "score": s.score, "base": base})
                columns = [*part.columns[:-1], pa.array(rows, arrow)]
                if masked:
                    columns.append(pa.array([_masked(t, r) for t, r in zip(texts, rows)], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    hidden = fresh([*keep, *made], "_whole_text")[0]
    return docs.select(*keep, F.col(text_col).alias(hidden)).mapInArrow(run, schema)


def _masked(text: str, found: list[dict]) -> str:
    out, at = [], 0
    for s in found:
        if s["start"] >= at:
            out += [text[at : s["start"]], f"[{s['kind'].upper()}]"]
        at = max(at, s["end"])
    return "".join([*out, text[at:]])


def digest(found: DataFrame, keep: list[str], name: str = "found") -> DataFrame:
    """``keep`` with counts of base spans by kind, their digest, all spans as text, and how many were added."""
    spans_of = F.col(name)

    def text(some):
        return F.array_join(F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of_kind(kind):
        return F.filter(spans_of, lambda s: s["base"] & (s["kind"] == kind))

    base = F.filter(spans_of, lambda s: s["base"])
    return found.select(
        *keep,
        *(F.size(of_kind(kind)).cast("long").alias(f"n_{kind}") for kind in BASE),
        F.sha2(text(base), 256).alias("base_sha256"),
        text(spans_of).alias("spans"),
        F.size(F.filter(spans_of, lambda s: ~s["base"])).cast("long").alias("n_added"),
    )
