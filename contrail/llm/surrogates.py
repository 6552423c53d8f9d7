"""Personal data replaced by surrogates: keyed, of the same type and format, distinct, and the same everywhere.

Patterns find mail addresses, telephone numbers, payment cards, IBANs, social security numbers, IPv4 and IPv6 and MAC
addresses, access keys, labelled secrets, passport numbers, dates of birth, street addresses and names after a title, with initials or in
capitals too; a name that is known
so is also found where it stands without its title, alone or after a given name. A surrogate is a keyed permutation of the
values of the entity's own format (digits stay digits, letters keep case and script, separators stay), so it needs no
table: equal entities get equal surrogates in every document, different ones get different ones by construction. The
permutation is D(E(x) + 1), a single cycle, so no value keeps itself; where only some values of a format will do, the
cycle is walked on to the next of them, which leaves it one to one. Payment cards and IBANs keep right check digits;
octets stay below 256; dates stay dates. A common given name becomes another of its gender and script. Other words of names are
permuted among words with vowels and consonants in the same places and the same last letter, which tells the gender in many
languages, and become no common given name; the title stays, an initial becomes another, and capitals stay capitals. So the
surrogates of Anna Berg, Berg, BERG and Karl Berg agree in the family name. A surrogate may be a value that someone else bears, as any value
of a format may. `collisions` checks a corpus for entities that share a surrogate; there are none.

Nulls: a null text stays null; an empty text stays empty. Where two types begin at one place, the first in `PATTERNS` wins.
Repeated rows are treated alike, empty tables give empty results and other columns pass through, but for one named
`entities`. Texts are read whole, in time in proportion to their length. A user supplies the key; the default is for
tests only.
"""

from __future__ import annotations

import functools
import hmac
import math
import re
import struct
import unicodedata
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import lean, without

#: Key of the surrogates unless the caller gives another.
KEY = b"contrail-surrogates"

# Titles that tell the gender, and common given names.
FEMALE = "Mrs Ms Miss Mme Madame Mlle Frau Señora Sra Srta Doña Signora Госпожа Κυρία".split()
MALE = "Mr Herr Monsieur Señor Sr Don Signor Господин Κύριος".split()
EITHER = "Dr Prof Professor Доктор".split()
GIVEN_FEMALE = (
    "Alice Ana Anna Anne Barbara Carmen Charlotte Clara Claire Elena Elizabeth Emily Emma Eva Giulia Hannah Helen Ida Ines Isabel "
    "Jane Jennifer Johanna Julia Katharina Laura Linda Lisa Lucia Maria Marie Mary Nora Olivia Patricia Paula Rachel Rosa Sara "
    "Sarah Sofia Sophie Susan Ursula Vera",
    "Анна Вера Елена Ирина Мария Наталья Нина Ольга Юлия",
    "Άννα Ελένη Μαρία Σοφία",
)
GIVEN_MALE = (
    "Adam Andreas Andrew Antonio Anton Carlos Charles Christian Daniel David Emil Felix Fernando Francesco François Frank Georg "
    "George Hans Heinrich Henry Jack Jacques James Jan Javier Jean Johannes John Jorge José Juan Karl Leon Louis Lucas Luis Manuel "
    "Marco Marc Mark Martin Michael Miguel Oliver Oscar Pablo Paul Pedro Peter Philippe Pierre Richard Robert Stefan Thomas Tomas "
    "Victor William",
    "Андрей Борис Дмитрий Иван Максим Олег Павел Сергей Юрий",
    "Γιάννης Γιώργος Κώστας Νίκος Πέτρος",
)
#: Given names of one gender and script each, and where a name stands among them.
_GROUPS = [names.split() for names in GIVEN_FEMALE + GIVEN_MALE]
_PLACE = {name: (g, i) for g, names in enumerate(_GROUPS) for i, name in enumerate(names)}
GIVEN = frozenset(_PLACE)

_UPPER, _LOWER = "A-ZÀ-ÖØ-ÞĀΑ-ΩΆΈΉΊΌΎΏА-ЯЁ", "a-zß-öø-ÿα-ωά-ώςа-яё"
#: A word of a name: Berg, O'Brien, Jean-Luc, McDonald.
_WORD = rf"[{_UPPER}](?:['’][{_UPPER}])?[{_LOWER}]+(?:(?:['’\-][{_UPPER}]?|[{_UPPER}])[{_LOWER}]{{2,}})*"
#: The same in capitals.
_CAPS = rf"[{_UPPER}]{{2,}}(?:['’\-][{_UPPER}]{{2,}})*"
#: Words before a telephone number without an area code, and before the number of a passport.
_CALL = "call|phone|telephone|tel|mobile|cell|fax|telefon|téléphone|tél|teléfono"
_PASSPORT = r"(?:passport|reisepass|passeport|pasaporte)(?:[ ]?(?:no\.?|number|nr\.?|nummer|n°|numéro|número))?"
_MARKS = r"AKIA|ASIA|gh[pos]_|sk-|xox[abp]-"
_LABELS = r"token|secret|password|passwd|pwd|api[_\-]?key|access[_\-]?key"
_HEX = "[0-9A-Fa-f]{1,4}"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_BORN = r"date of birth|dob|born(?: on)?|geboren(?: am)?|geburtsdatum|née? le|date de naissance|nacid[oa] el|fecha de nacimiento"
_STREET = "Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Drive|Boulevard|Blvd|Court|Square|Terrace|Crescent"
_STRASSE = "straße|strasse|str\\.|weg|platz|allee|gasse"
_RUE = "rue|avenue|boulevard|place|chemin|allée|impasse"
_CALLE = r"Calle|Avenida|Avda\.|Plaza|Paseo"
#: Patterns by type, tried in this order where they begin at the same place.
PATTERNS: dict[str, str] = {
    "key": r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b|\b(?:ghp|gho|ghs)_[A-Za-z0-9]{36}\b|\bsk-[A-Za-z0-9]{20,}\b|\bxox[abp]-[A-Za-z0-9\-]{10,}",
    "secret": r"(?i:\b(?:" + _LABELS + r")\b\s*[=:]\s*[\"']?)(?P<secret>[A-Za-z0-9_\-+/=.]{6,})",
    "birth": rf"(?i:\b(?:{_BORN})\b[: ]{{1,3}})(?P<birth>[0-9]{{1,2}}(?P<_dot>[./\-])[0-9]{{1,2}}(?P=_dot)[0-9]{{4}}|[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})(?![0-9])",
    "document": rf"(?i:\b{_PASSPORT}[:# ]{{1,3}})(?P<document>[A-Z]{{0,2}}[0-9]{{6,9}})\b",
    "email": r"(?<![\w.+%\-])[\w.+%\-]++@[^\W_](?:[\w.\-]*[^\W_])?\.[^\W\d_]{2,}",
    "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "mac": r"\b(?:[0-9A-Fa-f]{2}[:\-]){5}[0-9A-Fa-f]{2}\b",
    "ipv6": rf"(?<![:\w])(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}:){{1,6}}(?::{_HEX}){{1,6}}|(?:{_HEX}:){{1,7}}:|:(?::{_HEX}){{1,7}})(?![:\w])",
    "ipv4": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?![\d]|\.\d)",
    "card": r"(?<![\d.])(?:\d{4}[ \-]?){3}\d{4}(?!\d)|(?<![\d.])3[47]\d{2}[ \-]?\d{6}[ \-]?\d{5}(?!\d)",
    "ssn": r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
    "phone": r"(?<![\w.])\+\d{1,3}[ .\-]?(?:\(\d{1,4}\)[ .\-]?)?\d{2,4}(?:[ .\-]?\d{2,4}){1,4}(?!\d)|(?<![\w.])\(\d{3}\)[ .\-]?\d{3}[ .\-]\d{4}(?!\d)"
    r"|(?<![\w.\-])\d{3}[.\-]\d{3}[.\-]\d{4}(?![\d\-])|(?<![\w.+\-/])(?:0\d{1,4}|\(0\d{1,4}\))[ /\-]\d{3,4}[ \-]?\d{3,5}(?![\w\-])|(?<![\w.])0\d(?:[ .]\d{2}){4}(?![\w.])"
    rf"|(?i:\b(?:{_CALL})\b\.?[: ]{{1,2}})(?P<local>\d{{3}}[\-. ]\d{{4}})(?![\d\-])",
    "address": rf"\b\d{{1,5}}[A-Za-z]?[ ](?:{_WORD}[ ]){{1,3}}(?:{_STREET})\b|\b[{_UPPER}][{_LOWER}]+?(?:{_STRASSE})[ ]\d{{1,4}}[a-z]?\b"
    rf"|\b\d{{1,4}},?[ ](?:{_RUE})[ ](?:(?:de[ ]la|des|du|de)[ ]|de[ ]l['’]|d['’])?{_WORD}(?:[ \-]{_WORD})?|\b(?:{_CALLE})[ ](?:de[ ](?:la[ ]|los[ ]|las[ ])?)?{_WORD}(?:[ ]{_WORD})?,?[ ]\d{{1,4}}\b",
    "name": rf"\b(?P<title>{'|'.join(FEMALE + MALE + EITHER)})\.?[ ](?P<name>(?:[{_UPPER}]\.[ ]){{0,2}}(?:{_WORD}(?:[ ](?:[{_UPPER}]\.[ ])?{_WORD}){{0,2}}|{_CAPS}(?:[ ]{_CAPS}){{0,2}}))",
}
_ANY = re.compile("|".join(f"(?P<t_{k}>{p})" for k, p in PATTERNS.items()))
#: A text without any of these holds no entity.
_HINT = re.compile(r"[\d@]|:[0-9A-Fa-f]{0,4}:|-[0-9A-Fa-f]{2}-|" + "|".join(FEMALE + MALE + EITHER) + rf"|{_MARKS}|(?i:{_LABELS})")
_WORDS = re.compile(_WORD)
#: Parts of a name: words, words in capitals, initials.
_PARTS = re.compile(rf"{_WORD}|{_CAPS}|[{_UPPER}](?=\.)")


def luhn(digits: str) -> bool:
    """Whether a card number's check digit is right."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


class Permutation:
    """A keyed permutation of 0..n-1 in one cycle: D(E(x) + 1), E a Feistel network with cycle walking."""

    def __init__(self, key: bytes, tweak: str, n: int):
        self.key, self.n = hmac.digest(key, tweak.encode("utf-8", "surrogatepass"), "sha256"), n
        self.a = max(1, math.isqrt(n - 1) + 1)
        self.b = -(-n // self.a)

    def _f(self, i: int, x: int, mod: int) -> int:
        raw = hmac.digest(self.key, struct.pack(">B", i) + x.to_bytes(40, "big"), "sha512")
        return int.from_bytes(raw, "big") % mod

    def _walk(self, x: int, rounds: range, sign: int) -> int:
        while True:
            u, v = divmod(x, self.b)
            for i in rounds:
                if i % 2 == 0:
                    u = (u + sign * self._f(i, v, self.a)) % self.a
                else:
                    v = (v + sign * self._f(i, u, self.b)) % self.b
            x = u * self.b + v
            if x < self.n:
                return x

    def next(self, x: int) -> int:
        return self._walk((self._walk(x, range(8), 1) + 1) % self.n, range(7, -1, -1), -1)


_LATIN, _CYRILLIC, _GREEK = "abcdefghijklmnopqrstuvwxyz", "абвгдежзийклмнопрстуфхцчшщъыьэюя", "αβγδεζηθικλμνξοπρστυφχψω"
_SETS = tuple(x for s in (_LATIN, _CYRILLIC, _GREEK) for x in (s, s.upper()))
_SET_OF = {c: s for s in _SETS for c in s}
#: Vowels; of a name's letters, vowels and consonants are permuted apart.
_VOWELS = frozenset("aeiou" + "аеиоуыэюя" + "αεηιουω")


@functools.lru_cache(100_000)
def alphabet(c: str) -> str:
    """The characters that `c` may become: digits of its script, letters of its script and case; empty for others."""
    if c in _SET_OF:
        return _SET_OF[c]
    if c.isdecimal():
        return "".join(chr(ord(c) - unicodedata.decimal(c) + i) for i in range(10))
    if not c.isalpha():
        return ""
    block, kind = ord(c) // 32 * 32, unicodedata.category(c)
    near = (chr(x) for x in range(block, block + 32))
    return "".join(x for x in near if x.isalpha() and x not in _SET_OF and unicodedata.category(x) == kind)


@functools.lru_cache(100_000)
def _sound(c: str) -> str:
    """As `alphabet`, vowels and consonants apart."""
    return "".join(x for x in alphabet(c) if (x.lower() in _VOWELS) == (c.lower() in _VOWELS))


def permuted(value: str, key: bytes, tweak: str, of: Callable[[str], str] = alphabet, good: Callable[[str], bool] = lambda _: True) -> str:
    """The next value, along the cycle, with characters of the same alphabets, for which `good` holds as it does for
    `value`; all else in it stays. Long values are permuted in pieces of 40 characters."""
    new = value
    while True:
        new = "".join(_permuted(new[i : i + 40], key, f"{tweak}{i or ''}", of) for i in range(0, len(new), 40))
        if new == value or good(new):
            return new


def _permuted(value: str, key: bytes, tweak: str, of: Callable[[str], str]) -> str:
    sets = [of(c) for c in value]
    x, n = 0, 1
    for c, s in zip(value, sets, strict=True):
        if len(s) > 1:
            x, n = x * len(s) + s.index(c), n * len(s)
    if n < 2:
        return value
    shape = "".join(s[0] if s else c for c, s in zip(value, sets, strict=True))
    x = Permutation(key, f"{tweak}|{shape}", n).next(x)
    out = list(value)
    for i in reversed(range(len(value))):
        if len(sets[i]) > 1:
            x, d = divmod(x, len(sets[i]))
            out[i] = sets[i][d]
    return "".join(out)


def _card(value: str, key: bytes) -> str:
    """Permutes the digits between the first, which names the network, and the last, the check digit.

    A right check digit stays right, and a wrong one as far from right as it was.
    """
    spots = [i for i, c in enumerate(value) if c.isdecimal()]
    digits = "".join(str(int(value[i])) for i in spots)
    off = next(d for d in range(10) if luhn(digits[:-1] + str((int(digits[-1]) + d) % 10)))
    body = digits[0] + permuted(digits[1:-1], key, "card" + digits[0])
    right = next(d for d in range(10) if luhn(body + str(d)))
    out = list(value)
    for i, c in zip(spots, body + str((right - off) % 10), strict=True):
        out[i] = alphabet(value[i])[int(c)]
    return "".join(out)


def iban_check(country: str, rest: str) -> int:
    """The check digits of an IBAN without them."""
    return 98 - int("".join(str(int(c, 36)) for c in rest + country + "00")) % 97


def _iban(value: str, key: bytes) -> str:
    """Permutes the account and sets the check digits: right ones stay right, wrong ones as far off as they were."""
    country, check, rest = value[:2], int(value[2:4]), value[4:]
    new = permuted(rest, key, "iban" + country)
    off = check - iban_check(country, rest.replace(" ", ""))
    return f"{country}{(iban_check(country, new.replace(' ', '')) + off) % 100:02}{new}"


def _ipv4(value: str, key: bytes) -> str:
    x = int.from_bytes(bytes(map(int, value.split("."))), "big")
    return ".".join(map(str, Permutation(key, "ipv4", 2**32).next(x).to_bytes(4, "big")))


def _birth(value: str, key: bytes) -> str:
    """A date of the same form: numbers that may be a day or a month stay such; the century stays; after the 28th only the
    year changes."""
    parts = re.split("[^0-9]", value)
    marks = re.findall("[^0-9]", value)
    year = next(i for i, p in enumerate(parts) if len(p) == 4)
    late = any(int(p) > 28 for i, p in enumerate(parts) if i != year)
    ranges = []
    for i, p in enumerate(parts):
        number = int(p)
        if i == year:
            years = range(number // 100 * 100, number // 100 * 100 + 100)
            ranges.append([y for y in years if not late or (y % 4 == 0) == (number % 4 == 0)])
        elif late:
            ranges.append([number])
        elif len(p) == 1:
            ranges.append(list(range(1, 10)) if number else [0])
        else:
            ranges.append(list(range(1, 13)) if 1 <= number <= 12 else list(range(13, 29)) if number else [0])
    x = n = 0
    for p, r in zip(parts, ranges, strict=True):
        x, n = x * len(r) + r.index(int(p)), (n or 1) * len(r)
    shape = "|".join(f"{len(p)}:{r[0]}:{len(r)}" for p, r in zip(parts, ranges, strict=True)) + "".join(marks)
    x = Permutation(key, "birth" + shape, n).next(x)
    out = []
    for p, r in zip(reversed(parts), reversed(ranges), strict=True):
        x, d = divmod(x, len(r))
        out.append(f"{r[d]:0{len(p)}}")
    return "".join(a + b for a, b in zip(reversed(out), [*marks, ""], strict=True))


_HEXES = ("0123456789abcdef", "0123456789ABCDEF")


def _case(value: str) -> str:
    """How the letters of hexadecimal digits are written."""
    small, large = any("a" <= c <= "f" for c in value), any("A" <= c <= "F" for c in value)
    return "mixed" if small and large else "upper" if large else "lower"


def _hex(value: str, key: bytes, tweak: str) -> str:
    """Permutes hexadecimal digits within their way of writing."""
    case = _case(value)

    def of(c: str) -> str:
        if case == "mixed" and "A" <= c <= "F":
            return "ABCDEF"
        digits = _HEXES[case == "upper"]
        return digits if c in digits else ""

    return permuted(value, key, tweak + case, of, lambda v: _case(v) == case)


_ALL_HEX = re.compile(r"[0-9a-f:\-]+|[0-9A-F:\-]+")
#: What stays of a value because it tells the type: country codes, the nought before an area code, the marks of access keys.
_HEADS = {"key": re.compile(_MARKS), "phone": re.compile(r"\+\d{1,3}(?=[ .\-(])|\(?0|")}


def _plain(kind: str) -> Callable[[str, bytes], str]:
    def make(value: str, key: bytes) -> str:
        found = _HEADS[kind].match(value) if kind in _HEADS else None
        head = found.group() if found else ""
        return head + permuted(value[len(head) :], key, kind + head)

    return make


def _secret(value: str, key: bytes) -> str:
    if _ALL_HEX.fullmatch(value):
        return _hex(value, key, "secret")
    return permuted(value, key, "secret", good=lambda v: not _ALL_HEX.fullmatch(v))


def _email(value: str, key: bytes) -> str:
    user, _, host = value.rpartition("@")
    name, dot, top = host.rpartition(".")
    return permuted(user + "@" + name, key, "email") + dot + top


#: Words of addresses that stay, and ends of words that do.
_STAY = frozenset(re.sub(r"\\", "", f"{_STREET}|{_RUE}|{_CALLE}").replace(".", "").split("|"))
_END = re.compile(rf"(?:{_STRASSE})$")


def _word(word: str, key: bytes) -> str:
    """A word of a name. A common given name becomes another of its gender and script; of any other word the last letter stays,
    unless nothing else could change, and it becomes no common given name. Words in capitals go as the same words without."""
    if word in _PLACE:
        group, at = _PLACE[word]
        return _GROUPS[group][Permutation(key, f"given{group}", len(_GROUPS[group])).next(at)]
    plain = word[:1] + word[1:].lower()
    if len(word) > 1 and word.isupper() and plain.upper() == word and "-" not in word:
        return _word(plain, key).upper()
    if "-" in word:
        return "-".join(_word(part, key) for part in word.split("-"))
    body, last = word[:-1], word[-1:]
    free = lambda w: w not in _STAY and w not in _PLACE
    if not any(len(_sound(c)) > 1 for c in body):
        return permuted(word, key, "word", _sound, free)
    return permuted(body, key, "word" + last, _sound, lambda b: free(b + last)) + last


def _named(value: str, key: bytes) -> str:
    return _PARTS.sub(lambda m: permuted(m.group(), key, "initial") if len(m.group()) == 1 else _word(m.group(), key), value)


def _address(value: str, key: bytes) -> str:
    """Street names as words of names, house numbers as digits; the kind of street stays."""

    def one(found: re.Match[str]) -> str:
        word = found.group()
        if word[0].isdecimal():
            return permuted(word, key, "house")
        end = _END.search(word)
        at = end.start() if end else len(word)
        return word if word in _STAY else _word(word[:at], key) + word[at:]

    return re.sub(rf"\d+|[{_UPPER}][{_LOWER}'’{_UPPER}\-]*(?:(?<=str)\.)?", one, value)


_MAKERS: dict[str, Callable[[str, bytes], str]] = {
    "card": _card, "iban": _iban, "ipv4": _ipv4, "email": _email, "birth": _birth, "secret": _secret, "name": _named, "address": _address,
    "mac": lambda v, k: _hex(v, k, "mac"), "ipv6": lambda v, k: _hex(v, k, "ipv6"), **{k: _plain(k) for k in ("key", "ssn", "phone", "document")},
}


def surrogate(kind: str, value: str, key: bytes = KEY) -> str:
    """The surrogate of an entity; the kind of a name is `name:f`, `name:m` or `name:x`."""
    return _MAKERS[kind.partition(":")[0]](value, key)


def _gender(title: str) -> str:
    return "f" if title in FEMALE else "m" if title in MALE else "x"


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) of the entities of a text, in order and apart from each other."""
    if not _HINT.search(text):
        return []
    out = []
    family: dict[str, str] = {}
    given: dict[str, str] = {}
    for m in _ANY.finditer(text):
        kind = next(k for k in PATTERNS if m["t_" + k] is not None)
        if kind == "card" and not luhn("".join(str(int(c)) for c in m.group() if c.isdecimal())):
            continue  # a number whose check digit is wrong is no card
        if kind == "name":
            gender = _gender(m["title"])
            out.append((m.start("name"), m.end("name"), "name:" + gender, m["name"]))
            *first, last = _PARTS.findall(m["name"])
            family.setdefault(last, gender)
            given |= {w: gender for w in first}
        elif kind in ("secret", "birth", "document") or m["local"]:
            group = "local" if m["local"] else kind
            out.append((m.start(group), m.end(group), kind, m[group]))
        else:
            out.append((m.start(), m.end(), kind, m.group()))
    return _with_names(text, out, family, given) if family else out


def _with_names(text: str, found: list[tuple[int, int, str, str]], family: dict[str, str], given: dict[str, str]) -> list[tuple[int, int, str, str]]:
    """`found` with the places where known names stand without their titles."""
    out, at, end, bare = [], 0, 0, -1  # bare: the end of the last name that stands without its title
    before: re.Match[str] | None = None
    for m in _WORDS.finditer(text):
        while at < len(found) and found[at][0] < m.end():
            out.append(found[at])
            end, at = found[at][1], at + 1
        word = m.group()
        if m.start() >= end:
            gender = family.get(word) or given.get(word)
            if gender:
                start = m.start()
                if before and before.end() + 1 == start and text[start - 1] == " ":
                    if before.end() == end == bare:  # the given name has been found alone: take both
                        start = out.pop()[0]
                    elif before.start() >= end and before.group() in GIVEN:
                        start = before.start()
                out.append((start, m.end(), "name:" + gender, text[start : m.end()]))
                end = bare = m.end()
        before = m
    return sorted([*out, *found[at:]])


def replaced(text: str, key: bytes = KEY) -> tuple[str, list[tuple[int, int, str, str, str]]]:
    """The text with surrogates, and (start, end, kind, value, surrogate) of each entity; places are in the input."""
    given: dict[tuple[str, str], str] = {}
    out, at = [], 0
    rows = []
    for start, end, kind, value in entities(text):
        if (kind, value) not in given:
            given[kind, value] = surrogate(kind, value, key)
        new = given[kind, value]
        out += [text[at:start], new]
        at = end
        rows.append((start, end, kind, value, new))
    return "".join([*out, text[at:]]), rows


_ROW = "array<struct<start:int, end:int, kind:string, value:string, surrogate:string>>"


def pseudonymize(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """`docs` with its text replaced and `entities`, what was found and put in its place."""

    @F.pandas_udf(f"struct<text:string, entities:{_ROW}>")
    def work(lots: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for lot in lots:
            rows = [(None, []) if t is None else replaced(t, key) for t in lot]
            yield pd.DataFrame(
                {"text": [t for t, _ in rows], "entities": [[dict(zip(("start", "end", "kind", "value", "surrogate"), e, strict=True)) for e in es] for _, es in rows]}
            )

    docs = without(lean(docs), "entities", "_w")
    found = docs.withColumn("_w", work("text"))
    rest = [F.col("_w.text").alias("text") if c == "text" else found[c] for c in docs.columns]
    return found.select(*rest, F.col("_w.entities").alias("entities"))


def collisions(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """Surrogates of the corpus that stand for several entities of one kind: (kind, surrogate, entities)."""
    rows = pseudonymize(docs, key).select(F.explode("entities").alias("e")).select(F.split_part("e.kind", F.lit(":"), F.lit(1)).alias("kind"), "e.value", "e.surrogate").distinct()
    return rows.groupBy("kind", "surrogate").agg(F.count("*").alias("entities")).where("entities > 1")
