"""PII: validated numbers, dates, addresses and secrets replaced by format-preserving pseudonyms.

A value is read as a whole number in the range of its format (the digits of a card but for
issuer digit and check digit, the day of a date, the letters and digits of an address). A keyed
Feistel network permutes that range, and the number is written back in the same format, with
check digits made anew. Equal values give equal pseudonyms in all documents, however they are
punctuated; different values stay different. With the key the step is reversible.

Only values that pass their check are touched: Luhn sum, octets, calendar, area numbers,
mod 97. A pseudonym passes the same checks.

Defined cases: null text stays null, empty text empty; overlapping finds go to the kind that
comes first in ``KINDS``; repeated values and rows get equal results; texts without finds come
back unchanged; other columns pass through, except that a column named ``pii`` is replaced.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator, Sequence
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "secret", "iban", "card", "ip", "ssn", "phone", "date")
ROUNDS = 8
CHUNK = 24  # characters permuted at a time; longer values are cut into chunks that depend on each other's length


class Permutation:
    """Keyed permutations of ranges of whole numbers."""

    def __init__(self, key: bytes, inverse: bool = False):
        self.key = hashlib.blake2b(key, digest_size=32).digest()
        self.inverse = inverse

    def _round(self, tweak: str, i: int, value: int, size: int) -> int:
        width = size.bit_length() // 8 + 9
        head = hashlib.blake2b(f"{tweak}|{i}|{value}".encode(), key=self.key, digest_size=min(64, width)).digest()
        return int.from_bytes(head, "big") % size

    def _once(self, x: int, a: int, b: int, tweak: str) -> int:
        left, right = divmod(x, b)
        steps = range(ROUNDS - 1, -1, -1) if self.inverse else range(ROUNDS)
        sign = -1 if self.inverse else 1
        for i in steps:
            if i % 2 == 0:
                left = (left + sign * self._round(tweak, i, right, a)) % a
            else:
                right = (right + sign * self._round(tweak, i, left, b)) % b
        return left * b + right

    def permute(self, x: int, size: int, tweak: str, valid: Callable[[int], bool] | None = None) -> int:
        """The image of ``x`` in ``range(size)``; stays among the numbers for which ``valid`` says the same.

        The network works on a slightly larger rectangle; images outside are sent through again, which
        keeps the map one-to-one.
        """
        if size < 2:
            return x
        a = isqrt(size - 1) + 1
        b = -(-size // a)
        kind = valid(x) if valid else None
        while True:
            x = self._once(x, a, b, tweak)
            if x < size and (valid is None or valid(x) == kind):
                return x


CLASSES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
HEX = ("0123456789abcdef", "0123456789ABCDEF")


def permute_letters(p: Permutation, text: str, tweak: str, alphabets: Sequence[str] = CLASSES) -> str:
    """Letters and digits permuted within their classes; anything else stays in place."""
    spots = [(i, next(a for a in alphabets if c in a)) for i, c in enumerate(text) if any(c in a for a in alphabets)]
    out = list(text)
    for k in range(0, len(spots), CHUNK):
        chunk = spots[k : k + CHUNK]
        value, size = 0, 1
        for i, alphabet in chunk:
            value, size = value * len(alphabet) + alphabet.index(text[i]), size * len(alphabet)
        shape = "".join(str(len(a)) + a[0] for _, a in chunk)
        value = p.permute(value, size, f"{tweak}|{k}|{len(spots)}|{shape}")
        for i, alphabet in reversed(chunk):
            value, digit = divmod(value, len(alphabet))
            out[i] = alphabet[digit]
    return "".join(out)


def _fill(template: str, digits: str) -> str:
    """The template with its digits replaced one after another."""
    rest = iter(digits)
    return "".join(next(rest) if c.isdigit() else c for c in template)


def _digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def luhn_digit(payload: str) -> str:
    total = sum(sum(divmod(int(c) * (2 if i % 2 == 0 else 1), 10)) for i, c in enumerate(reversed(payload)))
    return str(-total % 10)


def card(p: Permutation, text: str) -> str | None:
    digits = _digits(text)
    if not 13 <= len(digits) <= 19 or digits[0] not in "23456" or luhn_digit(digits[:-1]) != digits[-1]:
        return None
    inner = digits[1:-1]
    unit = 10 ** (len(inner) - 3)

    def issued(x: int) -> bool:  # cards that begin with 2 begin with 2221 to 2720
        return digits[0] != "2" or 221 <= x // unit <= 720

    if not issued(int(inner)):
        return None
    moved = p.permute(int(inner), 10 ** len(inner), f"card|{digits[0]}|{len(digits)}", issued)
    payload = digits[0] + str(moved).zfill(len(inner))
    return _fill(text, payload + luhn_digit(payload))


def ip(p: Permutation, text: str) -> str | None:
    octets = [int(x) for x in text.split(".")]
    if max(octets) > 255 or octets[0] in (0, 127, 255):
        return None

    def unicast(x: int) -> bool:
        return 1 <= x >> 24 <= 223 and x >> 24 != 127

    value = int.from_bytes(bytes(octets), "big")
    return ".".join(map(str, p.permute(value, 1 << 32, "ip", unicast).to_bytes(4, "big")))


def ssn(p: Permutation, text: str) -> str | None:
    def issued(x: int) -> bool:
        area, group, serial = x // 1_000_000, x // 10_000 % 100, x % 10_000
        return area not in (0, 666) and area < 900 and group > 0 and serial > 0

    value = int(_digits(text))
    return _fill(text, str(p.permute(value, 10**9, "ssn", issued)).zfill(9)) if issued(value) else None


def phone(p: Permutation, text: str) -> str | None:
    digits = _digits(text)
    if not 7 <= len(digits) <= 15:
        return None
    if len(digits) == 10 or (len(digits) == 11 and digits[0] == "1"):

        def dialable(x: int) -> bool:  # area and exchange start with 2 to 9
            return x >= 2 * 10**9 and x // 10**6 % 10 >= 2

        moved = str(p.permute(int(digits[-10:]), 10**10, "phone", dialable)).zfill(10)
        return _fill(text, digits[:-10] + moved)
    head, rest = digits[:2], digits[2:]
    return _fill(text, head + str(p.permute(int(rest), 10 ** len(rest), f"phone|{head}|{len(rest)}")).zfill(len(rest)))


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def iban(p: Permutation, text: str) -> str | None:
    solid = text.replace(" ", "")
    if not 15 <= len(solid) <= 34 or _mod97(solid[4:] + solid[:4]) != 1:
        return None
    body = permute_letters(p, solid[4:], f"iban|{solid[:2]}")
    check = 98 - _mod97(body + solid[:2] + "00")
    rest = iter(f"{solid[:2]}{check:02d}{body}")
    return "".join(c if c == " " else next(rest) for c in text)


FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()


def date(p: Permutation, text: str) -> str | None:
    parts = re.split(r"[-/.]", text)
    mark = re.search(r"[-/.]", text).group()
    orders = ["ymd"] if len(parts[0]) == 4 else ["mdy", "dmy"] if mark == "/" else ["dmy", "mdy"]
    for order in orders:
        of = dict(zip(order, parts))
        try:
            day = datetime.date(int(of["y"]), int(of["m"]), int(of["d"])).toordinal()
        except ValueError:
            continue
        if not FIRST_DAY <= day <= LAST_DAY:
            return None
        new = datetime.date.fromordinal(FIRST_DAY + p.permute(day - FIRST_DAY, LAST_DAY - FIRST_DAY + 1, "date"))
        padded = all(len(of[k]) == 2 for k in "dm")
        out = {"y": f"{new.year:04d}", "m": f"{new.month:02d}" if padded else str(new.month), "d": f"{new.day:02d}" if padded else str(new.day)}
        return mark.join(out[k] for k in order)
    return None


def email(p: Permutation, text: str) -> str | None:
    local, _, domain = text.rpartition("@")
    host, _, top = domain.rpartition(".")
    return f"{permute_letters(p, local, 'local')}@{permute_letters(p, host, 'host')}.{top}"


def secret(p: Permutation, text: str) -> str | None:
    head = re.match(r"(?:AKIA|ASIA|gh[pousr]_|sk-|xox[abprs]-)?", text).group()
    body = text[len(head) :]
    plain = [a for a in HEX if all(c in a for c in body)]
    return head + permute_letters(p, body, f"secret|{head}", plain[:1] or CLASSES)


# Where to look, per kind; group 1 is the value where there is one. An address is looked for from its @ on.
PATTERNS = {
    "email": re.compile(r"@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,24}"),
    "secret": re.compile(
        r"\b((?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{30,}|sk-[0-9A-Za-z]{20,}|xox[abprs]-[0-9A-Za-z-]{10,})\b"
        r"|(?:(?:pass(?:word|wd)|pwd|token|secret|api[_-]?key|access[_-]?key)[\"']?\s{0,3}[=:]\s{0,3}[\"']?)([0-9A-Za-z+/_\-.]{8,})",
        re.I,
    ),
    "iban": re.compile(r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b"),
    "card": re.compile(r"(?<!\d)(?<!\d\.)\d(?:[ -]?\d){12,18}(?!\d)"),
    "ip": re.compile(r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)"),
    "ssn": re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    "phone": re.compile(
        r"(?<![\d.])(?:\+1|1)?[ .-]?\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.])(?:\+1|1)?[ .-]?\d{3}[ .-]\d{3}[ .-]\d{4}(?!\d)"
        r"|(?<![\d+])\+\d{1,3}(?:[ .-]?\(?\d{1,4}\)?){2,5}(?!\d)"
    ),
    "date": re.compile(r"(?<![\d/.-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?![\d/-])"),
}
WRITERS = {"email": email, "secret": secret, "iban": iban, "card": card, "ip": ip, "ssn": ssn, "phone": phone, "date": date}
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
RUN = re.compile(r"(?<!\d)(?<!\d\.)\d+(?:[ -]\d+)+")  # groups of digits that one separator parts
# How cards are grouped, longest first; single groups are tried too.
CARD_GROUPS = ((4, 4, 4, 4, 3), (4, 4, 4, 4), (4, 6, 5), (4, 6, 4))
POSSIBLE = re.compile(r"[0-9@=:]|gh[pousr]_|sk-|xox")  # every find contains one of these


Find = tuple[int, int, str]


def find_emails(p: Permutation, text: str) -> Iterator[Find]:
    """Addresses by their @: the local part is the run before it, read once, so time is linear in the text."""
    last = 0
    for found in PATTERNS["email"].finditer(text):
        start = found.start()
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        while start < found.start() and not text[start].isalnum():
            start += 1
        end = last = found.end()
        while text[end - 1] in ".-":
            end -= 1  # a full stop that ends the sentence
        if start < found.start():
            yield start, end, email(p, text[start:end])


def find_cards(p: Permutation, text: str) -> Iterator[Find]:
    """Cards, also beside other digits: within a run of groups, stretches that are grouped like cards go first.

    Between them, and in runs without them, the longest stretch of 13 to 19 digits is tried, however it is grouped.
    """
    sure: list[Find] = []
    for run in RUN.finditer(text):
        groups = [m.span() for m in re.finditer(r"\d+", run[0])]
        sizes = [e - s for s, e in groups]
        i = 0
        while i < len(groups):
            step = 1
            for shape in ((sizes[i],), *CARD_GROUPS):
                if tuple(sizes[i : i + len(shape)]) == shape and 13 <= sum(shape) <= 19:
                    start, end = run.start() + groups[i][0], run.start() + groups[i + len(shape) - 1][1]
                    new = card(p, text[start:end])
                    if new is not None:
                        sure.append((start, end, new))
                        step = len(shape)
                        break
            i += step
    yield from sure
    # What remains is searched between the finds, which only their own digits border on.
    at = 0
    for start, end in [*((s, e) for s, e, _ in sure), (len(text), len(text))]:
        for found in PATTERNS["card"].finditer(text, at, start):
            new = card(p, found[0])
            if new is not None:
                yield *found.span(), new
        at = end


def find_ibans(p: Permutation, text: str) -> Iterator[Find]:
    """Account numbers; where capitals or digits follow, ends at earlier blanks are tried, then later starts."""
    found = PATTERNS["iban"].search(text)
    while found:
        value = found[0]
        ends = [len(value), *(i for i in range(len(value) - 1, 0, -1) if value[i] == " ")]
        new, end = next(((new, e) for e in ends if (new := iban(p, value[:e])) is not None), (None, 0))
        if new is not None:
            yield found.start(), found.start() + end, new
        else:
            end = value.find(" ") if " " in value else len(value)
        found = PATTERNS["iban"].search(text, found.start() + end)


FINDERS = {"email": find_emails, "card": find_cards, "iban": find_ibans}


def _finds(p: Permutation, text: str, kind: str) -> Iterator[Find]:
    """Values of a kind that pass its check: start, end, pseudonym."""
    if kind in FINDERS:
        yield from FINDERS[kind](p, text)
        return
    for found in PATTERNS[kind].finditer(text):
        start, end = found.span(found.lastindex or 0)
        while kind == "secret" and end > start and text[end - 1] in ".-":
            end -= 1
        while kind == "phone" and text[start] in " .-":
            start += 1
        new = WRITERS[kind](p, text[start:end])
        if new is not None:
            yield start, end, new


def replace_all(p: Permutation, text: str, kinds: Sequence[str] = KINDS) -> tuple[str, list[dict]]:
    """The text with pseudonyms, and the places of the originals."""
    if not POSSIBLE.search(text):
        return text, []
    spans: list[tuple[int, int, str, str]] = []
    for kind in kinds:
        if kind == "email" and "@" not in text:
            continue
        taken = sorted((s, e) for s, e, _, _ in spans)
        starts = [s for s, _ in taken]
        for start, end, new in _finds(p, text, kind):
            before = bisect_left(starts, end) - 1  # finds do not overlap, so only the last before ``end`` can reach in
            if before < 0 or taken[before][1] <= start:
                spans.append((start, end, kind, new))
    spans.sort()
    out, at = [], 0
    for start, end, _, new in spans:
        out += [text[at:start], new]
        at = end
    return "".join([*out, text[at:]]), [{"kind": k, "start": s, "end": e} for s, e, k, _ in spans]


FOUND = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def pseudonymise(
    docs: DataFrame, key: bytes, text: str = "text", kinds: Sequence[str] = KINDS, inverse: bool = False
) -> DataFrame:
    """The input with pseudonyms in its text, and a column ``pii`` of the kinds and places replaced."""
    kept = [c for c in docs.columns if c != "pii"]
    schema = docs.select(*[F.col(f"`{c}`") for c in kept]).withColumn(
        "pii", F.array().cast("array<struct<kind:string,start:int,end:int>>")
    ).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Permutation(key, inverse)
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                rows = batch.slice(first, 512)
                results = [(None, []) if t is None else replace_all(p, t, kinds) for t in rows.column(text).to_pylist()]
                made = {text: pa.array([t for t, _ in results], pa.string()), "pii": pa.array([s for _, s in results], FOUND)}
                yield pa.RecordBatch.from_arrays([made[c] if c in made else rows.column(c) for c in [*kept, "pii"]], [*kept, "pii"])

    return docs.select(*[F.col(f"`{c}`") for c in kept]).mapInArrow(run, schema)


def replace_in(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """The same columns as the input, with pseudonyms; ``n_chars`` follows the text if there is one."""
    done = pseudonymise(docs, key, text)
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.when(F.size("pii") > 0, F.length(F.col(f"`{text}`")).cast("long")).otherwise(F.col("n_chars")))
    return done.select(*[F.col(f"`{c}`") for c in docs.columns])
