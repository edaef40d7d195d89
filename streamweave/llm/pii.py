"""Format-preserving pseudonyms of personal data (operator 7).

Card numbers (Luhn), IBANs (mod 97), phone numbers, US social security numbers, IPv4 addresses, e-mail addresses
and calendar dates are found by pattern and validated. A valid value is a number below the size of its format's
domain; a keyed Feistel network permutes that domain, and walking the permutation until the result is valid again
keeps it a permutation of the valid values. Separators, lengths (of an IPv4 address: the dotted form), country codes
and mail domains stay, check digits are made anew. The same key gives the same pseudonym wherever a value occurs, so
documents stay linked, and whoever holds the key can turn it back. Beside other numbers or capital words a match may
take in too much: its shorter ends and later starts, cut at separators, are tried as well, in one pass from left to
right. Card numbers and IBANs, which other digits fit by chance, give way to values of stricter patterns. Only where a
pseudonym would change how the text around it is read is the next one on its cycle taken.

Each text is worked through on its own, where it was read: nothing is shuffled, collected or broadcast.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from datetime import date, timedelta
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from streamweave.llm.common import chunks, small_batches

ROUNDS = 10
#: Dates that can be permuted: all from the first of these days up to the last.
FIRST_DAY, LAST_DAY = date(1900, 1, 1), date(2099, 12, 31)
EDGE = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
PATTERNS = {
    "email": r"[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,62}[A-Za-z0-9])?@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24}",
    "iban": r"[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?",
    "date": r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})",
    "ip": r"(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.[0-9])",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "card": r"[0-9](?:[ -]?[0-9]){12,18}",
    "phone": r"\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}|[0-9]{3}-[0-9]{3}-[0-9]{4}",
}
#: With a country code in front; the pattern starts at a plus sign.
ABROAD = r"\+[0-9]{1,3}(?:[ .-]?\(?[0-9]{2,5}\)?)(?:[ .-]?[0-9]{2,5}){1,4}"
EDGED = {"abroad": f"(?<![0-9A-Za-z+]){ABROAD}{EDGE[1]}",
         **{k: f"{EDGE[0]}{'(?<![.@-])' if k == 'ip' else ''}(?:{p}){EDGE[1]}" for k, p in PATTERNS.items()}}
FINDER = re.compile("|".join(EDGED.values()))
OWN = {k: re.compile(p) for k, p in EDGED.items()}
#: Where a shorter reading may end: before a separator.
CUT = re.compile(r"(?<=[0-9A-Z)])(?=[ .-])")
#: Most digits behind a country code; numbers of other codes have at most 15 with it.
MOST_DIGITS = {"1": 10, "7": 10, "20": 10, "27": 9, "30": 10, "31": 9, "32": 9, "33": 9, "34": 9, "36": 9, "39": 11, "40": 9, "41": 9,
               "44": 10, "45": 8, "46": 9, "47": 8, "48": 9, "49": 11, "52": 10, "54": 11, "55": 11, "56": 9, "57": 10, "61": 9,
               "64": 10, "65": 8, "81": 10, "86": 11, "90": 10, "91": 10, "351": 9, "353": 9, "380": 9, "420": 9, "421": 9, "852": 8}
#: Lengths of IBANs by country.
IBAN_LENGTHS = {"AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24,
                "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "LI": 21, "LT": 20,
                "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24, "RS": 22, "SA": 24, "SE": 24,
                "SI": 19, "SK": 24, "SM": 27, "TR": 26, "UA": 29}
#: Lengths of cards by their first digit.
CARD_LENGTHS = {"2": (16,), "3": (14, 15), "4": (16,), "5": (16,), "6": (16,)}
MAYBE = re.compile(r"[0-9@]")


class Feistel:
    """A keyed permutation of range(n) for any n, with its inverse."""

    def __init__(self, key: bytes, tweak: str):
        self.key, self.tweak = hashlib.blake2b(key, digest_size=32).digest(), tweak.encode()

    def _round(self, i: int, n: int, half: int, below: int) -> int:
        text = b"%b|%d|%d|%d" % (self.tweak, n, i, half)
        return int.from_bytes(hashlib.blake2b(text, key=self.key, digest_size=32).digest(), "big") % below

    def once(self, n: int, x: int, back: bool = False) -> int:
        """One way through the network over an a x b grid that covers range(n)."""
        a = isqrt(n - 1) + 1
        b = -(-n // a)
        left, right = divmod(x, b)  # left < a, right < b
        for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
            if i % 2:
                right = (right + (-1 if back else 1) * self._round(i, n, left, b)) % b
            else:
                left = (left + (-1 if back else 1) * self._round(i, n, right, a)) % a
        return left * b + right

    def walk(self, n: int, x: int, valid=lambda x: True, back: bool = False) -> int:
        """The next valid number on x's cycle: a permutation of the valid numbers."""
        while True:
            x = self.once(n, x, back)
            if x < n and valid(x):
                return x


def luhn(digits: str) -> int:
    return sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10


def refilled(shape: str, chars: str, kind=str.isdigit) -> str:
    """``shape`` with its digits (or what ``kind`` says) replaced by ``chars`` in order."""
    new = iter(chars)
    return "".join(next(new) if kind(c) else c for c in shape)


class Pseudonyms:
    """value -> pseudonym of the same kind and format, or None if the value isn't valid."""

    def __init__(self, key: bytes, back: bool = False, most: int = 200_000):
        self.key, self.back, self.most, self.known = key, back, most, {}

    def of(self, kind: str, value: str) -> str | None:
        own = kind, value
        if own not in self.known:
            if len(self.known) >= self.most:
                self.known.clear()
            self.known[own] = getattr(self, f"_{kind}")(value)
        return self.known[own]

    def _walk(self, tweak: str, n: int, x: int, valid=lambda x: True) -> int:
        return Feistel(self.key, tweak).walk(n, x, valid, self.back)

    def _card(self, value):
        digits = re.sub("[^0-9]", "", value)
        if luhn(digits) or digits[0] == "0":
            return None
        n = len(digits) - 1
        # The first digit names the kind of card and stays.
        new = digits[0] + str(self._walk(f"card{digits[0]}", 10 ** (n - 1), int(digits[1:-1]))).zfill(n - 1)
        return refilled(value, new + str(-luhn(new + "0") % 10))

    def _iban(self, value):
        text = value.replace(" ", "")
        number = lambda s: int("".join(str(int(c, 36)) for c in s))
        if not 15 <= len(text) <= 34 or number(text[4:] + text[:4]) % 97 != 1:
            return None
        body = text[4:]
        digits = "".join(c for c in body if c.isdigit())
        if digits:
            letters = "".join(c for c in body if not c.isdigit())
            tweak = f"iban{text[:2]}{letters}{refilled(body, '0' * len(digits))}"
            body = refilled(body, str(self._walk(tweak, 10 ** len(digits), int(digits))).zfill(len(digits)))
        check = 98 - number(body + text[:2] + "00") % 97
        return refilled(value, f"{text[:2]}{check:02d}{body}", str.isalnum)

    def _phone(self, value):
        digits = re.sub("[^0-9]", "", value)
        # Without a country code only North American numbers count: area and office begin with 2 to 9.
        valid = lambda x: str(x).zfill(10)[0] > "1" and str(x).zfill(10)[3] > "1"
        if not valid(int(digits)):
            return None
        return refilled(value, str(self._walk("phone", 10 ** 10, int(digits), valid)).zfill(10))

    def _abroad(self, value):
        digits = re.sub("[^0-9]", "", value)
        if not 8 <= len(digits) <= 15:
            return None
        code = re.match(r"\+([0-9]{1,3}?)(?=[ .(-]|[0-9]{7})", value)
        code = len(code[1]) if code else 2
        rest = digits[code:]
        new = str(self._walk(f"abroad{digits[:code]}", 10 ** len(rest), int(rest))).zfill(len(rest))
        return refilled(value, digits[:code] + new)

    def _ssn(self, value):
        def valid(x):
            s = str(x).zfill(9)
            return s[:3] not in ("000", "666") and s[0] != "9" and s[3:5] != "00" and s[5:] != "0000"
        number = int(value.replace("-", ""))
        return refilled(value, str(self._walk("ssn", 10 ** 9, number, valid)).zfill(9)) if valid(number) else None

    def _ip(self, value):
        parts = value.split(".")
        if any(int(p) > 255 or p != str(int(p)) for p in parts):
            return None
        new = self._walk("ip", 2 ** 32, int.from_bytes(bytes(map(int, parts)), "big"))
        return ".".join(map(str, new.to_bytes(4, "big")))

    def _date(self, value):
        numbers = list(map(int, re.split(r"\D", value)))
        order = (0, 1, 2) if len(re.split(r"\D", value)[0]) == 4 else (2, 1, 0) if "." in value else (2, 0, 1)
        try:
            day = date(*(numbers[i] for i in order))
        except ValueError:
            return None
        if not FIRST_DAY <= day <= LAST_DAY:
            return None
        new = FIRST_DAY + timedelta(self._walk("date", (LAST_DAY - FIRST_DAY).days + 1, (day - FIRST_DAY).days))
        own = (new.year, new.month, new.day)
        return refilled(value, "".join(str(own[order.index(i)]).zfill(4 if order.index(i) == 0 else 2) for i in range(3)))

    def _email(self, value):
        name, domain = value.rsplit("@", 1)
        sets = [("0123456789" if c.isdigit() else "abcdefghijklmnopqrstuvwxyz" if c.islower() else "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
                if c.isalnum() else c for c in name]
        n = x = 0
        size = 1
        for c, own in zip(name, sets):
            x = x * len(own) + own.index(c)
            size *= len(own)
        shape = "".join(own[0] for own in sets)
        if size > 1:
            x = self._walk(f"email{shape}@{domain.lower()}", size, x)
        out = []
        for own in reversed(sets):
            x, n = divmod(x, len(own))
            out.append(own[n])
        return "".join(reversed(out)) + "@" + domain


def addresses(text: str, names: Pseudonyms) -> list[tuple[int, int]]:
    return [m.span() for m in OWN["ip"].finditer(text) if names.of("ip", m[0]) is not None]


def readings(text: str, kind: str, start: int, ips: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(rank, end) of what may be a value from ``start`` on: the match and its shorter ends.

    None begins or ends inside an IPv4 address, whose pseudonym may have another length."""
    m = OWN[kind].match(text, start)
    if not m or any(s < start < e for s, e in ips):
        return []
    if kind not in ("abroad", "iban", "card"):
        return [(0, m.end())]
    cuts = [c.start() for c in CUT.finditer(text, start + 1, m.end())]
    if kind != "card":
        cuts = [c for c in cuts if OWN[kind].fullmatch(text, start, c)]
    ends = [x for x in [m.end(), *cuts] if not any(s < x < e for s, e in ips)]
    sizes = {e: e - start - sum(map(text[start:e].count, " .-+()")) for e in ends}
    if kind == "card":
        sizes = {e: n for e, n in sizes.items() if n >= 13}
        ends = [e for e in ends if e in sizes]
    if kind == "abroad":
        digits = re.sub("[^0-9]", "", m[0])
        most = next((n + MOST_DIGITS[digits[:n]] for n in (1, 2, 3) if digits[:n] in MOST_DIGITS), 15)
        # One reading: the longest that is no longer than the country's numbers.
        fit = [e for e in ends if 8 <= sizes[e] <= most] or [e for e in ends if 8 <= sizes[e] <= 15]
        return [(0, max(fit))] if fit else []
    usual = (IBAN_LENGTHS.get(m[0][:2]),) if kind == "iban" else CARD_LENGTHS.get(m[0][0], ())
    return [(0 if sizes[e] in usual else 1, e) for e in ends]


#: Order and name of the kinds that may begin with a character.
BEGINS = {"+": [(0, "abroad")], "(": [(7, "phone")],
          **dict.fromkeys("0123456789", [(n, k) for n, k in enumerate(OWN) if k not in ("abroad", "iban")]),
          **dict.fromkeys("abcdefghijklmnopqrstuvwxyz", [(1, "email")]),
          **dict.fromkeys("ABCDEFGHIJKLMNOPQRSTUVWXYZ", [(1, "email"), (2, "iban")])}
#: Patterns that other numbers fit by chance: their values give way to those of stricter ones.
LOOSE = "iban", "card"
#: A reading is at most 42 characters long, mail addresses aside, and looks at readings that begin inside it.
REACH = 84


class Scanner:
    """The values of one text, in one pass from left to right with a look-ahead of REACH characters."""

    def __init__(self, text: str, names: Pseudonyms):
        self.text, self.names, self.known = text, names, {}
        self.ips = addresses(text, names)
        self.ip_starts = [x[0] for x in self.ips]

    def options(self, start: int) -> list[tuple[int, int, int, str]]:
        """(rank, order of the kind, -end, kind) of the valid readings that begin here, the best first."""
        if start not in self.known:
            i = bisect_right(self.ip_starts, start + REACH)
            near = [x for x in self.ips[max(0, i - REACH):i] if x[1] > start]
            found = [(rank, nth, -end, kind) for nth, kind in BEGINS[self.text[start]] for rank, end in readings(self.text, kind, start, near)
                     if self.names.of(kind, self.text[start:end]) is not None]
            self.known[start] = sorted(found)
        return self.known[start]

    def chosen(self, start: int) -> tuple[int, int, str] | None:
        """The value that begins here. A loose reading gives way to a strict value that begins in it, and one of
        unusual length to a value of usual length."""
        options = self.options(start)
        strict = [x for x in options if x[3] not in LOOSE]
        for rank, _, last, kind in strict or options:
            if kind not in LOOSE or not self._crossed(rank, start, -last):
                return start, -last, kind
        return None

    def _crossed(self, rank: int, start: int, end: int) -> bool:
        m = FINDER.search(self.text, start + 1)
        while m and m.start() < end:
            if any(kind not in LOOSE or other < rank for other, _, _, kind in self.options(m.start())):
                return True
            m = FINDER.search(self.text, m.start() + 1)
        return False

    def values(self, at: int):
        m = FINDER.search(self.text, at)
        while m:
            value = self.chosen(m.start())
            if value:
                yield value
            m = FINDER.search(self.text, value[1] if value else m.start() + 1)


class Line:
    """A text cut into gaps and values, some of which are pseudonyms by now."""

    def __init__(self, text: str, values: list[tuple[int, int, str]], names: Pseudonyms):
        ends = [0, *(e for _, e, _ in values)]
        self.gaps = [text[e:s] for e, (s, _, _) in zip(ends, values)] + [text[ends[-1]:]]
        self.now, self.kinds, self.names = [text[s:e] for s, e, _ in values], [k for *_, k in values], names

    def as_read(self, i: int) -> bool:
        """Whether the text around value i is read as it is cut. What begins after value i doesn't depend on it, what
        ends more than REACH before it neither."""
        first, left = i, self.gaps[i]
        while first and len(left) < REACH:
            first -= 1
            left = self.gaps[first] + self.now[first] + left
        before = self.now[first - 1][-2:] if first else ""
        if len(self.gaps[first]) > REACH:  # no value begins in a gap, so it may be cut
            more = len(self.gaps[first]) - REACH
            before, left = left[more - 2:more], left[more:]
        right, last = self.gaps[i + 1][:REACH], i + 1
        while len(right) < REACH and last < len(self.now):
            right += self.now[last] + self.gaps[last + 1][:REACH]
            last += 1
        at = len(before)
        want, place = [], at + len(left) - sum(len(self.now[j]) + len(self.gaps[j + 1]) for j in range(first, i))
        for j in range(first, i + 1):
            want.append((place, place + len(self.now[j]), self.kinds[j]))
            place += len(self.now[j]) + len(self.gaps[j + 1])
        got = Scanner(before + left + self.now[i] + right, self.names).values(at)
        return all(next(got, None) == w for w in want)

    def settle(self) -> None:
        """Values become pseudonyms one by one. A pseudonym that would change how the text around it is read is passed
        over for the next on its cycle, which ends at the value itself at the latest; the way back goes from the last
        value to the first, meets the same texts and so undoes each step."""
        for i in reversed(range(len(self.now))) if self.names.back else range(len(self.now)):
            steady = self.as_read(i)
            while True:
                self.now[i] = self.names.of(self.kinds[i], self.now[i])
                if not steady or self.as_read(i):
                    break


def replaced(text: str, names: Pseudonyms) -> tuple[str, list[dict]]:
    """The text with pseudonyms, and what was found: kind, start and end in the new text."""
    values = list(Scanner(text, names).values(0)) if MAYBE.search(text) else []
    if not values:
        return text, []
    line = Line(text, values, names)
    line.settle()
    out, found, length = [], [], 0
    for gap, new, kind in zip(line.gaps, line.now, line.kinds):
        out += [gap, new]
        length += len(gap) + len(new)
        found.append({"kind": "phone" if kind == "abroad" else kind, "start": length - len(new), "end": length})
    return "".join(out) + line.gaps[-1], found


FOUND = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def pseudonymized(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text", back: bool = False) -> DataFrame:
    """(doc_id, text, found, n_found), one row for each row of ``docs``; found: array<struct<kind, start, end>>, code
    points in the returned text.

    ``back`` turns pseudonyms into the values again. A null text stays null, an empty one empty, both with nothing
    found; repeated rows are treated alike; an empty table gives an empty result; other columns are ignored."""
    def run(batches):
        names = Pseudonyms(key, back)
        for batch in chunks(batches, 1):
            rows = [(None, []) if t is None else replaced(t, names) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], FOUND),
                 pa.array([len(r[1]) for r in rows], pa.int64())], names=["doc_id", "text", "found", "n_found"])

    return (small_batches(docs).select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string"))
            .mapInArrow(run, "doc_id bigint, text string, found array<struct<kind:string,start:int,end:int>>, n_found bigint"))
