"""Personal data replaced by format-preserving pseudonyms.

Method: a value found and validated is a number of its format's domain (its digits and letters as a mixed-radix
number, a date as its day, an address as its octets). A keyed Feistel network permutes the domain; a result outside
it, or one that the format forbids, is permuted again. So a pseudonym is valid, has the same shape, and is the same
for equal values in all documents, while different values never meet. Who has the key can turn it back.

Each text is handled alone; nothing is shuffled, and no table of values is kept.
"""

from __future__ import annotations

import datetime
import hashlib
import math
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

#: For tests and demonstration; production passes its own.
KEY = b"change me"
ROUNDS = 8
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FIRST_DAY, LAST_DAY = datetime.date(1900, 1, 1).toordinal(), datetime.date(2099, 12, 31).toordinal()

#: What is looked for, in order of precedence at one place.
PATTERN = re.compile(
    r"""
    (?P<email>(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)
  | (?P<access_key>(?<!\w)(?:AKIA|ASIA)[A-Z0-9]{16}(?!\w))
  | (?P<secret>(?:(?<=token\ =\ ")|(?<=token=)|(?<=password=)|(?<=secret=)|(?<=api_key=))[A-Za-z0-9]{8,}(?!\w))
  | (?P<iban>(?<!\w)[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?!\w))
  | (?P<date>(?<![\w.-])(?:\d{4}(?P<s1>[-/.])\d{2}(?P=s1)\d{2}|\d{2}(?P<s2>[-/.])\d{2}(?P=s2)\d{4})(?![\w-]|\.\d))
  | (?P<ip>(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d))
  | (?P<phone>(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{3}[.-])\d{3,4}[ .-]\d{3,4}(?!\w|-\d)
      | (?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\w|[.-]\d)
      | (?<![\w+])\+\d{1,3}(?:[ .-]?\(\d\)|(?:[ .-]|(?<=\)))\d(?=[ .-])){1,2}(?:[ .-]?\d{2,4}){2,4}(?!\w|[.-]\d))
  | (?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))
  | (?P<card>(?<![\w-])(?:\d{13,19}|\d{4}(?P<s3>[ -])\d{4}(?P=s3)\d{4}(?P=s3)\d{1,7}|\d{4}(?P<s4>[ -])\d{6}(?P=s4)\d{5})(?![\w-]))
    """,
    re.VERBOSE,
)

# How long an IBAN of a country is.
IBAN_LENGTHS = {
    c[:2]: int(c[2:])
    for c in """
    AD24 AE23 AL28 AO25 AT20 AZ28 BA20 BE16 BF28 BG22 BH22 BI27 BJ28 BR29 BY28 CF27 CG27 CH21 CI28 CM27 CR22 CV25 CY28
    CZ24 DE22 DJ27 DK18 DO28 DZ26 EE20 EG29 ES24 FI18 FK18 FO18 FR27 GA27 GB22 GE22 GI23 GL18 GQ27 GR27 GT28 GW25 HN28
    HR21 HU28 IE22 IL23 IQ23 IR26 IS26 IT27 JO30 KM27 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 MA28 MC27 MD24 ME22
    MG27 MK19 ML28 MN20 MR27 MT31 MU30 MZ25 NE28 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31
    SD18 SE24 SI19 SK24 SM27 SN28 SO23 ST25 SV28 TD27 TG28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30
    """.split()
}


class Permutation:
    """A keyed one-to-one map of 0 .. n - 1 onto itself."""

    def __init__(self, key: bytes, kind: str, n: int):
        self.n, self.side = n, max(1, math.isqrt(max(n - 1, 0)) + 1)
        self.tag = hashlib.blake2b(f"{kind}:{n}".encode(), key=hashlib.sha256(key).digest()).digest()

    def _noise(self, round_: int, half: int) -> int:
        said = round_.to_bytes(1, "big") + half.to_bytes(max(1, (half.bit_length() + 7) // 8), "big")
        wide = hashlib.blake2b(said, key=self.tag).digest()
        while len(wide) * 8 < self.side.bit_length() + 64:
            wide += hashlib.blake2b(wide, key=self.tag).digest()
        return int.from_bytes(wide, "big") % self.side

    def _walk(self, x: int, step: Callable[[int], int]) -> int:
        x = step(x)
        while x >= self.n:  # the square is at most a little larger than the domain
            x = step(x)
        return x

    def forward(self, x: int) -> int:
        def step(x):
            left, right = divmod(x, self.side)
            for i in range(ROUNDS):
                left, right = right, (left + self._noise(i, right)) % self.side
            return left * self.side + right

        return self._walk(x, step)

    def backward(self, x: int) -> int:
        def step(x):
            left, right = divmod(x, self.side)
            for i in reversed(range(ROUNDS)):
                left, right = (right - self._noise(i, left)) % self.side, left
            return left * self.side + right

        return self._walk(x, step)


def _alphabet(c: str) -> str:
    return next((a for a in (DIGITS, LOWER, UPPER) if c in a), "")


class Pseudonyms:
    """Pseudonyms of one key; ``back`` inverts them."""

    def __init__(self, key: bytes, back: bool = False):
        self.key, self.back = key, back
        self.held: dict[tuple, Permutation] = {}

    def number(self, kind: str, n: int, x: int, allowed: Callable[[int], bool] = lambda x: True) -> int:
        if (kind, n) not in self.held:
            if len(self.held) > 10_000:
                self.held.clear()
            self.held[kind, n] = Permutation(self.key, kind, n)
        step = self.held[kind, n].backward if self.back else self.held[kind, n].forward
        x = step(x)
        while not allowed(x):  # the start is allowed, so the walk ends
            x = step(x)
        return x

    def characters(self, kind: str, value: str, alphabets: list[str], allowed=lambda v: True) -> str:
        """Permute the characters that have an alphabet; the others stay."""
        n, x = 1, 0
        for c, a in zip(value, alphabets, strict=True):
            if a:
                n, x = n * len(a), x * len(a) + a.index(c)

        def spelled(x: int) -> str:
            out = []
            for c, a in zip(reversed(value), reversed(alphabets), strict=True):
                if a:
                    x, i = divmod(x, len(a))
                    c = a[i]
                out.append(c)
            return "".join(reversed(out))

        shape = "".join(c if not a else a[0] for c, a in zip(value, alphabets, strict=True))
        return spelled(self.number(f"{kind} {shape}", n, x, lambda x: allowed(spelled(x))))

    def begin(self, kind: str, value: str) -> tuple[int, str] | None:
        """The length of the part from the begin of ``value`` that is valid, and its pseudonym.

        What follows an IBAN or a phone number can look like one more group of it.
        """
        for end in ENDS[kind](value) if kind in ENDS else (len(value),):
            other = self.of(kind, value[:end])
            if other is not None:
                return end, other
        return None

    def of(self, kind: str, value: str) -> str | None:
        """The pseudonym, or None if ``value`` is not valid."""
        return getattr(self, f"_{kind}")(value)

    def _email(self, value: str) -> str:
        name, _, domain = value.partition("@")
        return self.characters("email", name, [_alphabet(c) for c in name]) + "@" + domain

    def _access_key(self, value: str) -> str:
        return value[:4] + self.characters("access key", value[4:], [UPPER + DIGITS] * (len(value) - 4))

    def _secret(self, value: str) -> str:
        hexes = "0123456789abcdef"
        if all(c in hexes for c in value):
            return self.characters("hex", value, [hexes] * len(value))
        # never all hexadecimal, so that it is read as the same kind again
        return self.characters("secret", value, [_alphabet(c) for c in value], lambda v: any(c not in hexes for c in v))

    def _ip(self, value: str) -> str | None:
        octets = [int(o) for o in value.split(".")]
        if max(octets) > 255 or any(str(int(o)) != o for o in value.split(".")):
            return None
        x = self.number("ip", 1 << 32, int.from_bytes(bytes(octets), "big"))
        return ".".join(map(str, x.to_bytes(4, "big")))

    def _phone(self, value: str) -> str | None:
        digits = sum(c.isdigit() for c in value)
        if not 7 <= digits <= 15:
            return None
        code = re.match(r"\+\d{1,3}(?=\D)", value)
        keep = code.end() if code else 0
        places = [DIGITS if i >= keep and c.isdigit() else "" for i, c in enumerate(value)]
        return self._digits("phone", value, places)

    def _ssn(self, value: str) -> str | None:
        def valid(v: str) -> bool:
            return v[:3] not in ("000", "666") and v[0] != "9" and v[4:6] != "00" and v[7:] != "0000"

        return self._digits("ssn", value, [DIGITS if c.isdigit() else "" for c in value], valid) if valid(value) else None

    def _digits(self, kind: str, value: str, places: list[str], allowed=lambda v: True) -> str:
        """As ``characters``, but equal digits are linked whatever separates them."""
        bare = "".join(c for c, a in zip(value, places, strict=True) if a)
        kept = "".join(c for c, a in zip(value, places, strict=True) if not a and c.isdigit())

        def spread(digits: str) -> str:
            rest = iter(digits)
            return "".join(next(rest) if a else c for c, a in zip(value, places, strict=True))

        return spread(self.characters(f"{kind} {kept}", bare, [DIGITS] * len(bare), lambda v: allowed(spread(v))))

    def _card(self, value: str) -> str | None:
        digits = [c for c in value if c.isdigit()]
        if check_digit(digits[:-1]) != digits[-1]:
            return None
        body = "".join(digits[:-1])
        body = body[0] + self.characters(f"card {body[0]}", body[1:], [DIGITS] * (len(body) - 1))
        rest = iter(body + check_digit(body))
        return "".join(next(rest) if c.isdigit() else c for c in value)

    def _iban(self, value: str) -> str | None:
        if not iban_valid(value):
            return None
        bare = value.replace(" ", "")

        def spelled(body: str) -> str:
            rest = iter(bare[:2] + iban_check(bare[:2], body) + body)
            return "".join(c if c == " " else next(rest) for c in value)

        def same_end(body: str) -> bool:  # so that it is read with the same end again
            other = spelled(body)
            return not any(iban_valid(other[:end]) for end in iban_ends(other)[:-1])

        # a value with an earlier valid end never comes here from a text
        allowed = same_end if same_end(bare[4:]) else lambda body: True
        return spelled(self.characters(f"iban {bare[:2]}", bare[4:], [_alphabet(c) for c in bare[4:]], allowed))

    def _date(self, value: str) -> str | None:
        if value[4] in "-/.":
            order, mark = "ymd", value[4]
            forms = [("%Y{0}%m{0}%d", None)]
        else:
            order, mark = "dmy", value[2]
            # month first only if the day can't be a month, so the two readings never meet
            forms = [("%d{0}%m{0}%Y", None), ("%m{0}%d{0}%Y", 12)]
        for form, above in forms:
            try:
                day = datetime.datetime.strptime(value, form.format(mark)).date()
            except ValueError:
                continue
            if not FIRST_DAY <= day.toordinal() <= LAST_DAY or above and day.day <= above:
                continue
            fits = (lambda x, a=above: datetime.date.fromordinal(FIRST_DAY + x).day > a) if above else (lambda x: True)
            kind = f"date {order if not above else 'mdy'}"
            x = self.number(kind if above else "date", LAST_DAY - FIRST_DAY + 1, day.toordinal() - FIRST_DAY, fits)
            return datetime.date.fromordinal(FIRST_DAY + x).strftime(form.format(mark))
        return None


def check_digit(body) -> str:
    """The last digit that makes a number pass the Luhn test."""
    doubled = [int(c) * (2 if i % 2 == 0 else 1) for i, c in enumerate(reversed(list(body)))]
    return str(-sum(d - 9 if d > 9 else d for d in doubled) % 10)


def iban_check(country: str, body: str) -> str:
    """The two check digits, modulo 97."""
    return f"{98 - int(''.join(str(int(c, 36)) for c in body + country + '00')) % 97:02d}"


def iban_valid(value: str) -> bool:
    bare = value.replace(" ", "")
    return 15 <= len(bare) <= 34 and iban_check(bare[:2], bare[4:]) == bare[2:4]


def iban_ends(value: str) -> list[int]:
    """Where an IBAN at the begin of ``value`` may end: at its country's length, or else with the whole value."""
    places = [i + 1 for i, c in enumerate(value) if c != " "]
    length = IBAN_LENGTHS.get(value[:2], len(places))
    known = [places[length - 1]] if length < len(places) and value[places[length - 1]] == " " else []
    return [*known, len(value)]


def phone_ends(value: str) -> list[int]:
    """Where a phone number at the begin of ``value`` may end: with the whole value, or else before a space."""
    return [len(value), *(i for i in range(len(value) - 1, 0, -1) if value[i] == " ")] if value[0] == "+" else [len(value)]


ENDS = {"iban": iban_ends, "phone": phone_ends}


def replaced(text: str, names: Pseudonyms) -> tuple[str, list[dict]]:
    """The text with pseudonyms, and what was found: kind, begin and end in code points of the given text, pseudonym."""
    out, found, last, at = [], [], 0, 0
    while m := PATTERN.search(text, at):
        kind = next(k for k in KINDS if m[k] is not None)
        valid = names.begin(kind, m[kind])
        at = m.start() + 1  # an invalid match may hide a valid one
        if valid is not None:
            at = m.start() + valid[0]
            out += [text[last : m.start()], valid[1]]
            found.append({"kind": kind, "begin": m.start(), "end": at, "pseudonym": valid[1]})
            last = at
    return "".join([*out, text[last:]]), found


KINDS = ("email", "access_key", "secret", "iban", "date", "ip", "phone", "ssn", "card")
_FOUND = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("end", pa.int64()), ("pseudonym", pa.string())]))


def pseudonymise(docs: DataFrame, text: str = "text", key: bytes = KEY, out: str = "pii", back: bool = False) -> DataFrame:
    """``docs`` with pseudonyms in ``text`` and a column ``out`` of what was replaced, in order.

    Card numbers must pass the Luhn test, IBANs modulo 97 (at their country's length, or else with all groups), dates the calendar (1900 to 2099), addresses the octet range;
    what fails stays. Of a card the first digit stays, of an e-mail address the domain, of a phone number the country
    code. ``back`` turns pseudonyms made with the same key into the values. A null text stays null and has nothing;
    equal rows get equal results; ``out`` replaces a column of that name and other columns stay.
    """
    kind = pa.struct([("text", pa.string()), ("found", _FOUND)])

    def run(texts: pa.Array) -> pa.Array:
        names = Pseudonyms(key, back)
        new, found = [], []
        for t in texts:
            t = t.as_py()
            done = (t, []) if t is None or not SIGN.search(t) else replaced(t, names)
            new.append(done[0])
            found.append(done[1])
        return pa.StructArray.from_arrays([pa.array(new, pa.string()), pa.array(found, _FOUND)], [f.name for f in kind])

    tool = arrow_udf(run, "struct<text:string,found:array<struct<kind:string,begin:long,end:long,pseudonym:string>>>")
    rows = docs.withColumn("__pii", tool.asNondeterministic()(F.col(text)))
    return rows.withColumns({text: F.col("__pii.text"), out: F.col("__pii.found")}).drop("__pii")


#: Every pattern has a digit, an @, or a word that names a secret.
SIGN = re.compile(r"[0-9@]|token|password|secret|api_key")


def op3_pii(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pseudonymise(docs).select("doc_id", F.size("pii").cast("long").alias("n_found"), "pii", "text")
