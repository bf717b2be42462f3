"""A plain pseudonymiser, place by place and character by character: what the operator is held against."""

import datetime as dt
import hashlib
import re

from zonalis.llm.pii import DATED, IBAN_LENGTHS, PHONE_LENGTHS

RUN = re.compile(r"[A-Za-z0-9._%+-]+")
NAMES = ("password", "passwd", "pwd", "token", "secret", "api_key", "api-key")
DAY0 = dt.date(1800, 1, 1)


def sha(*x):
    return hashlib.sha256("|".join(map(str, x)).encode()).hexdigest()


def feistel(key, tweak, a, m, b, n):
    for i in range(10):
        if i % 2 == 0:
            a = (a + int(sha(key, tweak, i, b)[:15], 16) % m) % m
        else:
            b = (b + int(sha(key, tweak, i, a)[:15], 16) % n) % n
    return a, b


def number(key, tweak, d):
    k = len(d) // 2
    a, b = feistel(key, tweak, int(d[:k]), 10**k, int(d[k:]), 10 ** (len(d) - k))
    return str(a).zfill(k) + str(b).zfill(len(d) - k)


def lay(shape, core):
    """``shape`` with its ASCII letters and digits replaced by those of ``core`` in turn."""
    it = iter(core)
    return "".join(next(it) if re.match("[A-Za-z0-9]", c) else c for c in shape)


def one(key, tweak, s):
    core = re.sub("[^A-Za-z0-9]", "", s)
    halves = [core[: len(core) // 2], core[len(core) // 2 :]]
    for i in range(10):
        digest = sha(key, tweak, i, halves[(i + 1) % 2])
        moved = ""
        for k, c in enumerate(halves[i % 2]):
            low, size = (48, 10) if c.isdigit() else (65, 26) if c.isupper() else (97, 26)
            moved += chr(low + (ord(c) - low + int(digest[k % 32 * 2 :][:2], 16)) % size)
        halves[i % 2] = moved
    return lay(s, halves[0] + halves[1])


def scramble(key, tweak, s):
    shape = re.sub("[A-Z]", "A", re.sub("[a-z]", "a", re.sub("[0-9]", "0", s)))
    tweak = f"{tweak}|{shape if len(s) <= 64 else sha(shape)}"
    parts = [s[i : i + 64] for i in range(0, len(s), 64)]
    return "".join(one(key, f"{tweak}|{i}|{sha(parts[i - 1])}" if i else tweak, p) for i, p in enumerate(parts))


def luhn_ok(s):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(s))) % 10 == 0


def issuer(d):
    n, two = len(d), int(d[:2])
    return bool(
        d[0] == "4" and n in (13, 16, 19)
        or n == 16 and (51 <= two <= 55 or 22 <= two <= 27)
        or n == 15 and two in (34, 37)
        or 14 <= n <= 19 and two in (30, 36, 38, 39)
        or 16 <= n <= 19 and two == 35
        or 13 <= n <= 19 and (d[0] == "6" or two in (50, 56, 57, 58, 59))
    )


def usual(text):
    sizes, marks = [len(x) for x in re.split("[ -]", text)], set(re.findall("[ -]", text))
    return len(sizes) == 1 or sizes == [6, 13] or len(marks) == 1 and (sizes in ([4] * 4, [4, 6, 4], [4, 6, 5]) or len(sizes) == 5 and sizes[:4] == [4] * 4 and 1 <= sizes[4] <= 3)


def card(key, text):
    d = re.sub("[ -]", "", text)
    new = number(key, f"card{len(d)}", d[:-1])
    return lay(text, new + next(c for c in "0123456789" if luhn_ok(new + c)))


def cards(key, run):
    """A run of digit groups."""
    groups = re.findall("[0-9]+[ -]?", run)

    def best(i):
        found = []
        for size in range(1, min(7, len(groups) - i) + 1):
            text = re.sub("[ -]$", "", "".join(groups[i : i + size]))
            d = re.sub("[ -]", "", text)
            if 13 <= len(d) <= 19 and issuer(d) and luhn_ok(d):
                found.append((0 if usual(text) else 1, size, text))
        return min(found, default=None)

    out, i = "", 0
    while i < len(groups):
        got = best(i)
        if got and got[0] == 1 and any((best(j) or (1,))[0] == 0 for j in range(i + 1, i + got[1])):
            got = None
        out += card(key, got[2]) + re.search("[ -]?$", groups[i + got[1] - 1])[0] if got else groups[i]
        i += got[1] if got else 1
    return out


def date(key, s):
    if s[4] == "-":
        y, m, d, show = s[:4], s[5:7], s[8:], "%Y-%m-%d"
    elif s[2] == "/" and int(s[3:5]) > 12:
        m, d, y, show = s[:2], s[3:5], s[6:], "%m/%d/%Y"
    else:
        d, m, y, show = s[:2], s[3:5], s[6:], f"%d{s[2]}%m{s[2]}%Y"
    try:
        at = (dt.date(int(y), int(m), int(d)) - DAY0).days
    except ValueError:
        return s
    if not 0 <= at < 189 * 773:
        return s
    a, b = feistel(key, "date", at // 773, 189, at % 773, 773)
    return (DAY0 + dt.timedelta(a * 773 + b)).strftime(show)


def ssn(key, s):
    area, group, serial = int(s[:3]), int(s[4:6]), int(s[7:])
    if not (1 <= area <= 899 and area != 666 and group and serial):
        return s
    a, b = feistel(key, "ssn", area - 2 if area > 666 else area - 1, 898, (group - 1) * 9999 + serial - 1, 99 * 9999)
    return f"{a + 2 if a >= 665 else a + 1:03}-{b // 9999 + 1:02}-{b % 9999 + 1:04}"


def mod97(s):
    return int("".join(str(int(c, 36)) for c in s)) % 97


def iban(key, s):
    c = s.replace(" ", "")
    if mod97(c[4:] + c[:4]) != 1:
        return s
    new = scramble(key, f"iban{c[:2]}", c[4:])
    return lay(s, f"{c[:2]}{98 - mod97(new + c[:2] + '00'):02}{new}")


def match(key, t, i, with_cards=True):
    """(end, pseudonym) of the value that begins at ``i``, or None."""
    before, c = t[max(0, i - 40) : i], t[i]
    if re.match("[A-Za-z0-9._%+-]", c) and not re.search(r"[A-Za-z0-9._%+-]\Z", before):
        if m := re.compile("AKIA[0-9A-Z]{16}(?![A-Za-z0-9_])").match(t, i):
            return m.end(), "AKIA" + scramble(key, "key", m[0][4:])
        if m := re.compile(r"([A-Z]{2})\d\d", re.A).match(t, i):
            if size := IBAN_LENGTHS.get(m[1]):
                if x := re.compile(r"[A-Z]{2}\d\d(?: ?[A-Z0-9]){%d}(?![A-Za-z0-9])" % (size - 4), re.A).match(t, i):
                    return x.end(), iban(key, x[0])
        run = RUN.match(t, i)
        if x := re.compile(r"@(?:[A-Za-z0-9-]{1,63}\.){1,126}[A-Za-z]{2,24}").match(t, run.end()):
            name = run[0]
            new = scramble(key, "email", name.lower())
            return x.end(), "".join(a.upper() if "A" <= b <= "Z" else a for a, b in zip(new, name)) + x[0]
        if run[0].lower().endswith(NAMES) and (x := re.compile(r"[\"']?\s?[=:]\s?", re.A).match(t, run.end())):
            for form in (r'"(?:[^"\\\r\n]|\\.)*"', r"'(?:[^'\\\r\n]|\\.)*'", r"[\"']?[^\s\"']{8,}", r"(?:(?<==)|(?<==[\"'])|[\"'](?<==[\"']))[^\s\"']+", r"[\"']?(?=[^\s\"'0-9]*[0-9])[^\s\"']+"):
                if v := re.compile(form, re.A).match(t, x.end()):
                    head = re.match(r"[A-Za-z0-9._%+-]+[\"']?\s?[=:]\s?[\"']?", t[i : v.end()], re.A)[0]
                    return v.end(), head + scramble(key, "secret", t[i + len(head) : v.end()])
    if not re.match("[0-9+(]", c):
        return None
    at = lambda p: re.compile(p, re.A).match(t, i)
    if not re.search(r"[\d.]\Z", before, re.A) and (m := at(r"(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)")) and not at(r"\d\.\d\.\d\.\d(?!\d)"):
        if not re.search(r"\b(?:version|ver|release|build|v)[ .:#]{0,2}\Z", before, re.I | re.A):
            p = [int(x) for x in m[0].split(".")]
            if max(p) > 255:
                return m.end(), m[0]
            a, b = feistel(key, "ipv4", p[0] * 256 + p[1], 65536, p[2] * 256 + p[3], 65536)
            return m.end(), f"{a // 256}.{a % 256}.{b // 256}.{b % 256}"
    if not re.search(r"[\d/.-]\Z", before, re.A) and (m := at(r"(?:\d{4}-\d\d-\d\d|\d\d/\d\d/\d{4}|\d\d\.\d\d\.\d{4})(?![\d/-]|\.\d)")):
        if not re.search(rf"\b(?:{DATED})(?: on| in| at)?:? \Z", before, re.I | re.A):
            return m.end(), date(key, m[0])
    if not re.search(r"[\d-]\Z", before, re.A) and (m := at(r"\d{3}-\d\d-\d{4}(?![\d-])")):
        return m.end(), ssn(key, m[0])
    if not re.search(r"[\d+]\Z", before, re.A):
        m = at(r"(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[ .-]\d{4}(?!\d)")
        if not m and c == "+":
            for code, (low, high) in PHONE_LENGTHS.items():
                if x := at(rf"\+{code}((?: ?\(0\))?)((?:[ .()-]{{0,2}}\d){{{low},{high}}})(?!\d)"):
                    d = re.sub(r"\D", "", x[2], flags=re.A)
                    return x.end(), f"+{code}{x[1]}" + lay(x[2], d[0] + number(key, f"phone{code}{d[0]}", d[1:]))
            m = at(r"\+1(?:[ .-]?\d){10}(?!\d)")
        if m:
            d = re.sub(r"\D", "", m[0], flags=re.A)
            return m.end(), lay(m[0], d[:-10] + number(key, "phone", d[-10:]))
    if with_cards and not re.search(r"\d\Z", before, re.A) and at(r"\d(?:[ -]?\d){12}") and (m := at(r"\d{1,19}(?!\d)")):
        end = m.end()
        while (x := re.compile(r"[ -](\d{1,19})(?!\d)", re.A).match(t, end)) and not match(key, t, end + 1, False):
            end = x.end()
        return end, cards(key, t[i:end])
    return None


def plain(t, key):
    if t is None:
        return None
    out, i = "", 0
    while i < len(t):
        got = match(key, t, i)
        out += got[1] if got else t[i]
        i = got[0] if got else i + 1
    return out
