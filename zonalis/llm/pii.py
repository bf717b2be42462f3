"""Format-preserving pseudonyms for personal data: keyed Feistel permutations within each value's format.

Found in each whole text: e-mail addresses, IPv4 addresses (each part at most
255), telephone numbers (North American ones, and international ones by their
country's lengths), IBANs (country's length, remainder mod 97), payment cards
(13 to 19 digits, issuer's first digits, Luhn; whole digit groups, even beside
other numbers), social security numbers (issued areas), calendar dates from
1800 to 2199 (YYYY-MM-DD, DD.MM.YYYY, DD/MM/YYYY, and MM/DD/YYYY where the day
is above 12) and credentials, up to the closing quote or white space (of those,
ASCII letters and digits are replaced).  A value that fails its check stays as
it is, and so do four numbers that a version's name stands before or that are
one digit each, and a date that says when something was released, published
and the like.  A valid value is replaced by another valid one of the same
format:

* numbers and dates: their ordinal is split in two halves a < m, b < n, and
  each of ``ROUNDS`` rounds adds a keyed hash of one half to the other, mod m
  or n.  m x n is exactly the number of values of the format, so the map is a
  permutation; check digits are worked out anew.
* e-mail names, IBANs and credentials: the same on strings; digits turn within
  digits, letters within letters of their case, marks stay.  An e-mail name's
  case is laid over the pseudonym of its lower-case form, so spellings of one
  name stay linked; the domain stays.

Equal values have equal pseudonyms in every document, for the same ``key``,
which is a secret: who has it can undo the map.  DataFrame functions only.  A
null text stays null; other columns pass through unchanged, whatever their
names; rows are judged one by one, so repeated rows and null ids stay, and
where two formats fit one place the first in ``PATTERN`` counts.  Every pattern
takes time in proportion to a text's length and a bounded stack, whatever the
text; a run of more than 1000 digit groups is judged for cards in stretches of
1000 groups.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_text

ROUNDS = 10
#: Characters that one permutation of a string takes.
BLOCK = 64
#: An IBAN's length by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18, "FO": 18, "FR": 27,
    "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "KW": 30, "KZ": 20, "LB": 28, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24,
    "ME": 22, "MK": 19, "MT": 31, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TN": 24, "TR": 26, "UA": 29,
}
#: How many digits follow a country's calling code, least and most.
PHONE_LENGTHS = {
    "7": (10, 10), "20": (8, 10), "27": (9, 9), "30": (10, 10), "31": (9, 9), "32": (8, 9), "33": (9, 9), "34": (9, 9), "36": (8, 9), "39": (8, 11), "40": (9, 9), "41": (9, 9), "43": (7, 13), "44": (9, 10),
    "45": (8, 8), "46": (7, 10), "47": (8, 8), "48": (9, 9), "49": (7, 11), "51": (8, 9), "52": (10, 10), "54": (10, 11), "55": (10, 11), "56": (9, 9), "57": (10, 10), "58": (10, 10), "60": (8, 10), "61": (9, 9),
    "62": (8, 12), "63": (10, 10), "64": (8, 10), "65": (8, 8), "66": (8, 9), "81": (9, 10), "82": (8, 10), "84": (9, 10), "86": (10, 11), "90": (10, 10), "91": (10, 10), "92": (9, 10), "212": (9, 9), "234": (8, 10),
    "254": (9, 9), "351": (9, 9), "352": (6, 9), "353": (8, 9), "354": (7, 7), "358": (6, 11), "359": (8, 9), "370": (8, 8), "371": (8, 8), "372": (7, 8), "380": (9, 9), "385": (8, 9), "386": (8, 8), "420": (9, 9),
    "421": (9, 9), "852": (8, 8), "886": (8, 9), "966": (9, 9), "971": (8, 9), "972": (8, 9),
}
#: Fixed formats.  ``RUN`` is what an e-mail's name and a credential's are made of; it is taken whole, from its start, so that no text is scanned twice.
RUN = r"[A-Za-z0-9._%+-]++"
RUN_START = r"(?<![A-Za-z0-9._%+-])"
EMAIL = rf"{RUN}@(?:[A-Za-z0-9-]{{1,63}}+\.){{1,126}}[A-Za-z]{{2,24}}"
KEY_ID = r"AKIA[0-9A-Z]{16}(?![A-Za-z0-9_])"
#: The end of a credential's name, its mark, then a quoted value of any length, or a bare one up to white space or a quote: 8 characters at least, or any number of them right after "=" or with a digit.
SECRET_MARK = r"(?=[\"']?\s?[=:])(?<=(?i:password|passwd|pwd|token|secret|api[_-]key))[\"']?\s?[=:]\s?"
SECRET_VALUE = r"(?:\"(?:[^\"\\\r\n]|\\.)*+\"|'(?:[^'\\\r\n]|\\.)*+'|[\"']?(?:[^\s\"']{8,}+|(?<=[=][\"']?)[^\s\"']++|(?=[^\s\"'0-9]*+[0-9])[^\s\"']++))"
SECRET = rf"{RUN}{SECRET_MARK}{SECRET_VALUE}"
IBAN = r"(?=[A-Z]{2}\d\d)(?:" + "|".join(rf"(?:{'|'.join(c for c, n in IBAN_LENGTHS.items() if n == size)})\d\d(?: ?[A-Z0-9]){{{size - 4}}}" for size in sorted(set(IBAN_LENGTHS.values()))) + r")(?![A-Za-z0-9])"
IPV4 = r"(?<![\d.])(?!\d\.\d\.\d\.\d(?!\d))(?<!(?i:\b(?:version|ver|release|build|v)[ .:#]{0,2}))(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)"
#: Words before a date that is no person's.
DATED = "released|published|updated|posted|modified|accessed|retrieved|effective|copyright|version|since"
DATE = rf"(?=\d\d(?:\d\d-|[/.]\d))(?<![\d/.-])(?<!(?i:\b(?:{DATED})(?: on| in| at)?:? ))(?:\d{{4}}-\d{{2}}-\d{{2}}|\d{{2}}/\d{{2}}/\d{{4}}|\d{{2}}\.\d{{2}}\.\d{{4}})(?![\d/-]|\.\d)"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
PHONE = r"(?<![\d+])(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[ .-]\d{4}(?!\d)"
_BY_LENGTH = {n: "|".join(c for c, m in PHONE_LENGTHS.items() if m == n) for n in PHONE_LENGTHS.values()}
ABROAD = r"(?<![\d+])\+(?:" + "|".join(rf"(?:{codes})(?: ?\(0\))?(?:[ .()-]{{0,2}}\d){{{low},{high}}}" for (low, high), codes in _BY_LENGTH.items()) + r"|1(?:[ .-]?\d){10})(?!\d)"
#: A run of digit groups with 13 digits or more, up to where another value begins; the cards within it are told by ``_card``.
_GROUP = r"\d{1,19}+(?!\d)"
CARD = rf"(?<!\d)(?=\d(?:[ -]?\d){{12}}){_GROUP}(?:[ -](?=\d)(?!{RUN_START}(?:{EMAIL}|{SECRET})|{IPV4}|{DATE}|{SSN}|{PHONE}){_GROUP}){{0,999}}+"
#: Usual groupings of a card number, and issuers' first digits with their lengths.
LAYOUT = r"^(?:\d{13,19}|\d{4}([ -])\d{4}\1\d{4}\1\d{4}|\d{4}([ -])\d{6}\2\d{4,5}|\d{4}([ -])\d{4}\3\d{4}\3\d{4}\3\d{1,3}|\d{6}[ -]\d{13})$"
ISSUER = r"^(?:4(?:\d{12}|\d{15}|\d{18})|(?:5[1-5]|2[2-7])\d{14}|3[47]\d{13}|3[0689]\d{12,17}|35\d{14,17}|(?:5[06-9]|6)\d{12,18})$"
#: Most groups that a card is written in.
CARD_GROUPS = 7
#: Two groups: the values of all formats but cards, and a card's run.
PATTERN = rf"({RUN_START}(?:{KEY_ID}|{IBAN}|{RUN}(?:@(?:[A-Za-z0-9-]{{1,63}}+\.){{1,126}}[A-Za-z]{{2,24}}|{SECRET_MARK}{SECRET_VALUE}))|(?=[0-9+(])(?:{IPV4}|{DATE}|{SSN}|{PHONE}|{ABROAD}))|({CARD})"
#: Stands around matches while they are told from the rest, unless a text has it itself.
SENTINEL = "\uffff"
#: Days from 1800-01-01 to 2199-12-31: a whole Gregorian cycle, 189 x 773.
FIRST_DAY, DAY_A, DAY_B = "1800-01-01", 189, 773
#: The setting that holds the secret key of the registered queries.
KEY_SETTING = "spark.zonalis.pii.key"


def session_key(spark: SparkSession) -> str:
    """The key in ``KEY_SETTING``; where it is unset, a fresh random one for this session: its pseudonyms are linked with no other session's."""
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        key = secrets.token_hex(32)
        spark.conf.set(KEY_SETTING, key)
    return key


def _hash(key: str, tweak: Column, i: Column, other: Column) -> Column:
    """60 bits of a keyed hash."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", F.lit(key), tweak, i.cast("string"), other), 256), 1, 15), 16, 10).cast("long")


def _let(value: Column, use) -> Column:
    """``use(value)``, with ``value`` worked out once."""
    return F.get(F.transform(F.array(value), use), 0)


def feistel(key: str, tweak: Column, a: Column, m: Column, b: Column, n: Column) -> Column:
    """Struct (a, b) of a permutation of the pairs a < m, b < n."""
    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))

    def turn(s: Column, i: Column) -> Column:
        up = ((s["a"] + _hash(key, tweak, i, s["b"].cast("string")) % m) % m).cast("long")
        down = ((s["b"] + _hash(key, tweak, i, s["a"].cast("string")) % n) % n).cast("long")
        even = i % 2 == 0
        return F.struct(F.when(even, up).otherwise(s["a"]).alias("a"), F.when(even, s["b"]).otherwise(down).alias("b"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def _shift(key: str, tweak: Column, i: Column, part: Column, other: Column) -> Column:
    """``part`` with each character moved within its class by a byte of the keyed hash of ``other``."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), tweak, i.cast("string"), other), 256)

    def move(part: Column, digest: Column, k: Column) -> Column:
        c = F.ascii(F.substr(part, k, F.lit(1)))
        by = F.conv(F.substr(digest, (k - 1) % 32 * 2 + 1, F.lit(2)), 16, 10).cast("int")
        low = F.when(c < 58, 48).when(c < 91, 65).otherwise(97)
        size = F.when(c < 58, 10).otherwise(26)
        return F.char(low + (c - low + by) % size)

    moved = lambda part, digest: F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(F.length(part), F.lit(1))), lambda k: move(part, digest, k)), "")
    return F.when(F.length(part) == 0, part).otherwise(_let(part, lambda part: _let(digest, lambda digest: moved(part, digest))))


def scramble(key: str, tweak: Column, s: Column) -> Column:
    """A permutation of the strings of letters and digits of ``s``'s shape, which is part of the tweak; other characters stay in place."""
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(s, "[0-9]", "0"), "[a-z]", "a"), "[A-Z]", "A")
    shaped = F.concat_ws("|", tweak, F.when(F.length(s) <= BLOCK, shape).otherwise(F.sha2(shape, 256)))
    return _let(shaped, lambda t: _blocks(key, t, s))


def _blocks(key: str, tweak: Column, s: Column) -> Column:
    """A long string by blocks, each with its number and the block before it in the tweak: time in proportion to the length."""

    def block(b: Column, i: Column) -> Column:
        before = F.when(i == 0, tweak).otherwise(F.concat_ws("|", tweak, i.cast("string"), F.sha2(F.get(b, i - 1), 256)))
        return _let(before, lambda t: _scramble(key, t, F.get(b, i)))

    return _let(F.regexp_extract_all(s, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0)), lambda b: F.array_join(F.transform(b, lambda _, i: block(b, i)), ""))


def _scramble(key: str, tweak: Column, s: Column) -> Column:
    core = F.regexp_replace(s, "[^A-Za-z0-9]", "")
    half = F.floor(F.length(core) / 2).cast("int")
    start = F.struct(F.substr(core, F.lit(1), half).alias("a"), F.substr(core, half + 1, F.length(core)).alias("b"))

    def turn(x: Column, i: Column) -> Column:
        even = i % 2 == 0
        return F.struct(F.when(even, _shift(key, tweak, i, x["a"], x["b"])).otherwise(x["a"]).alias("a"), F.when(even, x["b"]).otherwise(_shift(key, tweak, i, x["b"], x["a"])).alias("b"))

    done = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)
    return _relay(s, _let(done, lambda x: F.concat(x["a"], x["b"])), "[^A-Za-z0-9]")


def _relay(s: Column, core: Column, marks: str) -> Column:
    """``s`` with the characters that aren't ``marks`` replaced by those of ``core`` in turn."""

    def put(s: Column, core: Column, k: Column) -> Column:
        c = F.substr(s, k, F.lit(1))
        return F.when(c.rlike(marks), c).otherwise(F.substr(core, F.length(F.regexp_replace(F.substr(s, F.lit(1), k), marks, "")), F.lit(1)))

    laid = lambda s, core: F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(F.length(s), F.lit(1))), lambda k: put(s, core, k)), "")
    return F.when(F.length(s) == 0, s).otherwise(_let(s, lambda s: _let(core, lambda core: laid(s, core))))


def _check_digit(digits: Column) -> Column:
    """Luhn's check digit for a payload: from its right, every other digit counts twice, the last one first."""

    def total(digits: Column) -> Column:
        n = F.length(digits)

        def worth(k: Column) -> Column:
            d = F.ascii(F.substr(digits, k, F.lit(1))) - 48
            twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
            return F.when((n - k) % 2 == 0, twice).otherwise(d)

        return F.aggregate(F.transform(F.sequence(F.lit(1), n), worth), F.lit(0), lambda x, y: x + y)

    return ((10 - _let(digits, total) % 10) % 10).cast("string")


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _ten(n: Column) -> Column:
    """10 to the n, up to 10^9."""
    return F.element_at(F.array(*[F.lit(10**k) for k in range(10)]), n + 1)


def _number(key: str, tweak: Column, digits: Column) -> Column:
    """A permutation of the digit strings of this length (2 to 18)."""
    half = F.floor(F.length(digits) / 2).cast("int")
    rest = F.length(digits) - half
    got = feistel(key, tweak, F.substr(digits, F.lit(1), half), _ten(half), F.substr(digits, half + 1, rest), _ten(rest))
    return _let(got, lambda x: F.concat(F.lpad(x["a"].cast("string"), half, F.lit("0")), F.lpad(x["b"].cast("string"), rest, F.lit("0"))))


def _one_card(key: str, s: Column) -> Column:
    d = _digits(s)
    new = _number(key, F.concat(F.lit("card"), F.length(d).cast("string")), F.substr(d, F.lit(1), F.length(d) - 1))
    return _relay(s, _let(new, lambda x: F.concat(x, _check_digit(x))), "[^0-9]")


def _card(key: str, s: Column) -> Column:
    """Struct (text, n) of a run of digit groups: its cards replaced, and their number.

    A card is a sub-run of whole groups with 13 to 19 digits that has an
    issuer's first digits and passes Luhn.  From left to right, a usual
    grouping goes before another one, then one of fewer groups; an unusual one
    gives way to a usual one that begins within it.
    """

    def best(g: Column, i: Column) -> Column:
        """Struct (rank, size, text) of the card that begins with group ``i``, or null."""

        def judge(c: Column) -> Column:
            d = c["digits"]
            valid = d.rlike(ISSUER) & (_check_digit(F.substr(d, F.lit(1), F.length(d) - 1)) == F.substr(d, F.length(d), F.lit(1)))
            return F.when(valid, F.struct(F.when(c["text"].rlike(LAYOUT), 0).otherwise(1).alias("rank"), c["size"].alias("size"), c["text"].alias("text")))

        def cut(size: Column) -> Column:
            text = F.regexp_replace(F.array_join(F.slice(g, i, size), ""), "[ -]$", "")
            return _let(text, lambda x: F.struct(size.alias("size"), x.alias("text"), F.translate(x, " -", "").alias("digits")))

        cuts = F.transform(F.sequence(F.lit(1), F.least(F.size(g) - i + 1, F.lit(CARD_GROUPS))), cut)
        found = F.array_min(F.transform(F.filter(cuts, lambda c: F.length(c["digits"]).between(13, 19)), judge))
        return F.when(F.get(g, i - 1).rlike("^[2-6]") & (F.length(F.array_join(F.slice(g, i, CARD_GROUPS), "")) >= 13), found)

    def swap(g: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            def put(c: Column) -> Column:
                last = F.regexp_extract(F.element_at(g, i + c["size"] - 1), "[ -]?$", 0)
                return F.struct((i + c["size"]).alias("at"), F.concat(state["text"], _one_card(key, c["text"]), last).alias("text"), (state["n"] + 1).alias("n"))

            def later(c: Column) -> Column:
                return (c["rank"] == 1) & (c["size"] > 1) & F.exists(F.sequence(i + 1, i + F.greatest(c["size"], F.lit(2)) - 1), lambda j: F.coalesce(best(g, j)["rank"] == 0, F.lit(False)))

            kept = F.struct((i + 1).alias("at"), F.concat(state["text"], F.element_at(g, i)).alias("text"), state["n"].alias("n"))
            return F.when(i < state["at"], state).otherwise(_let(best(g, i), lambda c: F.when(c.isNull() | later(c), kept).otherwise(put(c))))

        start = F.struct(F.lit(1).alias("at"), F.lit("").alias("text"), F.lit(0).alias("n"))
        return F.aggregate(F.sequence(F.lit(1), F.size(g)), start, step, lambda x: F.struct(x["text"].alias("text"), x["n"].alias("n")))

    return _let(F.regexp_extract_all(s, F.lit("[0-9]+[ -]?"), F.lit(0)), swap)


def _phone(key: str, s: Column) -> Column:
    """A North American number's ten digits."""
    d = _digits(s)
    own = F.substr(d, F.length(d) - 9, F.lit(10))
    return _relay(s, F.concat(F.substr(d, F.lit(1), F.length(d) - 10), _number(key, F.lit("phone"), own)), "[^0-9]")


def _abroad(key: str, s: Column) -> Column:
    """An international number's digits behind the country's code and the first of its own; a trunk nought in brackets stays."""
    d = _digits(F.regexp_replace(s, r"\(0\)", ""))
    codes = F.create_map(*[x for c in PHONE_LENGTHS for x in (F.lit(c), F.lit(len(c)))])
    fixed = 1 + F.coalesce(*[F.try_element_at(codes, F.substr(d, F.lit(1), F.lit(n))) for n in (1, 2, 3)])
    new = F.concat(F.substr(d, F.lit(1), fixed), _number(key, F.concat(F.lit("phone"), F.substr(d, F.lit(1), fixed)), F.substr(d, fixed + 1, F.length(d))))
    trunk = F.regexp_extract(s, r"^[^(]*\(0\)", 0)
    code = F.regexp_extract(trunk, r"^\+\d+", 0)
    rest = F.substr(s, F.length(trunk) + 1, F.length(s))
    return F.when(trunk == "", _relay(s, new, "[^0-9]")).otherwise(F.concat(trunk, _relay(rest, F.substr(new, F.length(code), F.length(new)), "[^0-9]")))


def _remainder(text: Column) -> Column:
    """mod 97 of digits and letters, a letter as two digits from 10 on."""

    def add(x: Column, c: Column) -> Column:
        v = F.when(F.ascii(c) < 58, F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
        return ((x * F.when(v > 9, 100).otherwise(10) + v) % 97).cast("int")

    return F.aggregate(F.split(text, ""), F.lit(0), lambda x, c: F.when(c == "", x).otherwise(add(x, c)))


def _lettered(key: str, s: Column) -> Column:
    """A value of letters and digits: the part of it that is scrambled, and what then stands around; null for any other value.

    An e-mail name's case lies over the pseudonym of its lower-case form; an
    IBAN's two check digits are worked out anew.
    """
    head = F.regexp_extract(s, rf"^{RUN}[\"']?\s?[=:]\s?[\"']?", 0)
    name = F.regexp_extract(s, "^([^@]*)@", 1)
    plain = F.translate(s, " ", "")
    part = lambda kind, before, core: F.struct(F.lit(kind).alias("kind"), before.alias("before"), core.alias("core"))
    parts = (
        F.when(s.rlike(f"^{KEY_ID}$"), part("key", F.lit("AKIA"), F.substr(s, F.lit(5), F.lit(16))))
        .when(s.rlike(f"^(?:{IBAN})$"), part("iban", F.substr(plain, F.lit(1), F.lit(2)), F.substr(plain, F.lit(5), F.length(plain))))
        .when(s.rlike(f"^{RUN}@"), part("email", F.lit(""), F.lower(name)))
        .when(head != "", part("secret", head, F.substr(s, F.length(head) + 1, F.length(s))))
    )

    def made(x: Column, new: Column) -> Column:
        checked = F.concat(x["before"], F.lpad((98 - _remainder(F.concat(new, x["before"], F.lit("00")))).cast("string"), 2, "0"), new)
        iban = F.when(_remainder(F.concat(x["core"], F.substr(plain, F.lit(1), F.lit(4)))) == 1, _relay(s, checked, " ")).otherwise(s)
        cased = F.array_join(F.zip_with(F.split(new, ""), F.split(name, ""), lambda a, b: F.when(F.ascii(b).between(65, 90), F.upper(a)).otherwise(a)), "")
        email = F.concat(F.when(name == x["core"], new).otherwise(cased), F.substr(s, F.length(name) + 1, F.length(s)))
        return F.when(x["kind"] == "iban", iban).when(x["kind"] == "email", email).otherwise(F.concat(x["before"], new))

    tweak = lambda x: F.when(x["kind"] == "iban", F.concat(x["kind"], x["before"])).otherwise(x["kind"])
    return _let(parts, lambda x: F.when(x.isNotNull(), _let(scramble(key, tweak(x), x["core"]), lambda new: made(x, new))))


def _ipv4(key: str, s: Column) -> Column:
    p = F.transform(F.split(s, r"\."), lambda x: x.cast("int"))
    got = feistel(key, F.lit("ipv4"), F.get(p, 0) * 256 + F.get(p, 1), F.lit(65536), F.get(p, 2) * 256 + F.get(p, 3), F.lit(65536))
    parts = [F.floor(got["a"] / 256), got["a"] % 256, F.floor(got["b"] / 256), got["b"] % 256]
    return F.when(F.array_max(p) <= 255, F.concat_ws(".", *[x.cast("string") for x in parts])).otherwise(s)


def _ssn(key: str, s: Column) -> Column:
    """Areas 001-899 but 666, groups 01-99, serials 0001-9999."""
    area, group, serial = (F.substring(s, *x).cast("int") for x in ((1, 3), (5, 2), (8, 4)))
    ok = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    got = feistel(key, F.lit("ssn"), F.when(area > 666, area - 2).otherwise(area - 1), F.lit(898), (group - 1) * 9999 + serial - 1, F.lit(99 * 9999))
    new = F.when(got["a"] >= 665, got["a"] + 2).otherwise(got["a"] + 1)
    return F.when(ok, F.concat_ws("-", F.lpad(new.cast("string"), 3, "0"), F.lpad((F.floor(got["b"] / 9999) + 1).cast("string"), 2, "0"), F.lpad((got["b"] % 9999 + 1).cast("string"), 4, "0"))).otherwise(s)


def _date(key: str, s: Column) -> Column:
    """One permutation of the days, whatever the form; a slashed date whose second number is above 12 has the month first."""
    iso, first = s.rlike("^[0-9]{4}-"), s.rlike("^[0-9]{2}/(?:1[3-9]|[23][0-9])/")
    a, b = F.substring(s, 1, 2), F.substring(s, 4, 2)
    text = F.when(iso, s).when(first, F.concat_ws("-", F.substring(s, 7, 4), a, b)).otherwise(F.concat_ws("-", F.substring(s, 7, 4), b, a))
    day = F.try_to_date(text, "yyyy-MM-dd")
    at = F.datediff(day, F.lit(FIRST_DAY).cast("date"))
    got = feistel(key, F.lit("date"), F.floor(at / DAY_B), F.lit(DAY_A), at % DAY_B, F.lit(DAY_B))
    new = F.date_add(F.lit(FIRST_DAY).cast("date"), (got["a"] * DAY_B + got["b"]).cast("int"))
    mark = F.substring(s, 3, 1)
    two = F.when(first, F.date_format(new, "MM/dd")).otherwise(F.concat_ws("", F.date_format(new, "dd"), mark, F.date_format(new, "MM")))
    shown = F.when(iso, F.date_format(new, "yyyy-MM-dd")).otherwise(F.concat_ws("", two, mark, F.date_format(new, "yyyy")))
    return F.when(day.isNotNull() & (at >= 0) & (at < DAY_A * DAY_B), shown).otherwise(s)


def pseudonym(key: str, s: Column) -> Column:
    """The pseudonym of one value that is no card."""
    whole = lambda pattern: s.rlike(f"^(?:{pattern})$")
    numbers = (
        F.when(whole(IPV4), _ipv4(key, s))
        .when(whole(DATE), _date(key, s))
        .when(whole(SSN), _ssn(key, s))
        .when(whole(PHONE) | whole(r"\+1(?:[ .-]?\d){10}"), _phone(key, s))
        .otherwise(_abroad(key, s))
    )
    return F.coalesce(_lettered(key, s), numbers)


def pseudonymise(docs: DataFrame, key: str, counts: bool = False) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; with ``counts`` also n_found and n_changed, which replace columns of those names."""
    if not key:
        raise ValueError("a secret key is asked for")
    work = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("r"), as_text("text").alias("t"))
    # rest, value, run of cards, rest, ...: one scan, but for texts that hold the sentinel
    marked = F.split(F.regexp_replace("t", PATTERN, f"{SENTINEL}$1{SENTINEL}$2{SENTINEL}"), SENTINEL, -1)
    rest, value, run = F.split("t", PATTERN, -1), F.regexp_extract_all("t", F.lit(PATTERN), F.lit(1)), F.regexp_extract_all("t", F.lit(PATTERN), F.lit(2))
    apart = F.slice(F.flatten(F.transform(rest, lambda x, i: F.array(x, F.coalesce(F.get(value, i), F.lit("")), F.coalesce(F.get(run, i), F.lit(""))))), 1, 3 * F.size(rest) - 2)
    work = work.withColumn("parts", F.when(F.col("t").contains(SENTINEL), apart).otherwise(marked))
    some = F.size("parts") > 1

    def new(p: Column, i: Column) -> Column:
        kept = F.struct(p.alias("text"), F.lit(0).alias("n"))
        return F.when((i % 3 == 0) | (p == ""), kept).when(i % 3 == 1, F.struct(pseudonym(key, p).alias("text"), F.lit(1).alias("n"))).otherwise(_card(key, p))

    work = work.withColumn("new", F.when(some, F.transform("parts", new)))
    text = F.when(some, F.array_join(F.transform("new", lambda x: x["text"]), "")).otherwise(F.col("t"))
    out = [text.alias(c) if c == "text" else F.col(f"r.`{c}`").alias(c) for c in docs.columns if not (counts and c in ("n_found", "n_changed"))]
    if counts:
        total = lambda c: F.aggregate(c, F.lit(0), lambda x, y: x + y)
        n_found = total(F.transform("new", lambda x, i: F.when((i % 3 == 2) & (x["text"] != ""), F.greatest(x["n"], F.lit(1))).otherwise(x["n"])))
        changed = total(F.zip_with("parts", "new", lambda a, b: F.when(a != b["text"], b["n"]).otherwise(0)))
        out += [F.when(some, n).otherwise(F.lit(0)).cast("long").alias(c) for n, c in ((n_found, "n_found"), (changed, "n_changed"))]
    return work.select(*out)
