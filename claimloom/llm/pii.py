"""Surrogate generation for personal data: keyed, type-consistent replacements.

Each kind of entity has a keyed bijection on its own forms, so distinct originals get
distinct surrogates and one original gets one surrogate everywhere, in any document,
without a table and without a shuffle. A bijection is P⁻¹(P(x) + s): P is a keyed
Feistel permutation of the form's values and s is not zero, so nothing stays as it is.

* Letters keep their script, case and kind (vowel or consonant, in the scripts that have
  an alphabet below), digits stay digits of their script, and every other character stays, so formats hold. Numbers
  are the same entity in digits of any script. Signs of a secret with fewer than eight letters and digits change as well.
* A bare run of digits is a card number only if its check digit is right, a grouped one in
  any case; card numbers keep their check digit right, or as wrong as it was; IBANs
  keep their country and get the check digits that belong to the new number.
* Addresses of private networks stay within theirs; public ones stay public.
* Given names are replaced by names of the same gender and script; titles stay.
* Phone numbers that differ in punctuation alone are one entity, as are e-mail addresses
  and names that differ in case alone.
* A name's words are replaced wherever they stand in its text, also without title or given name.

Collision checks: families of forms never map into each other (no surname becomes a listed
given name, no plain secret a prefixed or hexadecimal one, no domain a reserved one).
``surrogates`` still compares all entities of a text, and one that would share another's
surrogate takes the next under a key of its own. What no alphabet can change (a name in a script without one) becomes its kind
and a keyed hash, so nothing that is found stays. ``audit`` counts, for a corpus and by
kind, distinct originals, distinct surrogates, entities left unchanged, and surrogates that
are also originals.

The key is the caller's secret: who holds it can undo the bijections, so it has no default.
People are found by titles and listed given names; a lone given name is not.

Defined results: a null text stays null; a text without entities stays as it is, byte for
byte; repeated rows change alike; null ``doc_id`` rows are kept; an empty table gives no
rows; further columns are kept by ``replaced``.
"""

from __future__ import annotations

import hmac
import re
import unicodedata
from bisect import bisect
from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from claimloom.llm.common import OWN, portions, text_of

# Given names by script and gender.
GIVEN_NAMES: dict[tuple[str, str], str] = {
    ("latin", "f"): "Aisha Alice Amelia Anita Anna Anne Barbara Beatriz Camille Carla Carmen Caroline Catherine Charlotte Clara Claudia Daniela Diana Elena Elizabeth Emily Emma Eva Fatima Fiona Francesca Gabriela Hanna Helena Ingrid Isabel Jane Jennifer Jessica Joanna Julia Karen Laura Linda Lucia Magdalena Margaret Maria Marie Marta Mary Monica Natalia Olivia Patricia Paula Rachel Rebecca Rosa Sandra Sarah Silvia Sofia Sophie Susan Teresa Ursula Valentina Victoria",
    ("latin", "m"): "Adam Ahmed Alan Albert Alexander Andrew Anthony Antonio Arthur Bernard Brian Carlos Charles Christian Daniel David Diego Dominik Edward Eric Felix Fernando Francisco Frank George Gregory Hans Henry Hugo James Javier John Jonas Joseph Juan Julian Karl Kevin Leonard Lewis Louis Luis Manuel Marco Mark Martin Matthew Michael Miguel Nicholas Oliver Oscar Patrick Paul Peter Philip Rafael Richard Robert Samuel Sebastian Stefan Steven Thomas Victor Walter William",
    ("cyrillic", "f"): "Анна Валентина Вера Галина Екатерина Елена Ирина Ксения Людмила Мария Надежда Наталья Ольга Полина Светлана Татьяна",
    ("cyrillic", "m"): "Алексей Андрей Борис Виктор Владимир Дмитрий Иван Константин Максим Михаил Николай Олег Павел Пётр Сергей Юрий",
    ("greek", "f"): "Αγγελική Αικατερίνη Άννα Βασιλική Γεωργία Δήμητρα Ειρήνη Ελένη Ευαγγελία Κωνσταντίνα Μαρία Σοφία",
    ("greek", "m"): "Αθανάσιος Αλέξανδρος Αντώνιος Βασίλειος Γεώργιος Δημήτριος Εμμανουήλ Ιωάννης Κωνσταντίνος Νικόλαος Παναγιώτης Χρήστος",
}
# Titles before a name.
TITLES = "Mr Mrs Ms Miss Dr Prof Sir Madam Herr Frau Señor Señora Sr Sra Don Doña Monsieur Madame Mme Mlle Г-н Г-жа Κος Κα".split()
# Domains reserved for examples, which name nobody.
RESERVED = ("example.com", "example.net", "example.org", "example", "invalid", "localhost", "test")
# Vowels and consonants by script; each letter maps to a letter of its own string.
_ALPHABETS = (
    "aeiou", "bcdfghjklmnpqrstvwxyz", "AEIOU", "BCDFGHJKLMNPQRSTVWXYZ", "0123456789",
    "àáâãäåèéêëìíîïòóôõöùúûü", "çñšž", "ÀÁÂÃÄÅÈÉÊËÌÍÎÏÒÓÔÕÖÙÚÛÜ", "ÇÑŠŽ",
    "аеёиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "АЕЁИОУЭЮЯ", "БВГДЖЗЙКЛМНПРСТФХЦЧШЩ",
    "αεηιουωάέήίόύώ", "βγδζθκλμνξπρστφχψ", "ΑΕΗΙΟΥΩΆΈΉΊΌΎΏ", "ΒΓΔΖΘΚΛΜΝΞΠΡΣΤΦΧΨ",
)
# First and last code points of further letters, by script: Latin, Greek, Cyrillic, Armenian, Hebrew, Arabic, Devanagari, Georgian, kana, Han, Hangul.
_FURTHER_LETTERS = ((0xC0, 0x24F), (0x1E00, 0x1EFF), (0x370, 0x3FF), (0x400, 0x52F), (0x531, 0x587), (0x5D0, 0x5EA), (0x620, 0x64A), (0x904, 0x939), (0x10D0, 0x10FF), (0x3041, 0x3096), (0x30A1, 0x30FA), (0x4E00, 0x9FFF), (0xAC00, 0xD7A3))


def _letter_classes() -> dict[str, str]:
    """The alphabet of each letter: those above, and for further ones the letters of their range with their case."""
    found = {c: a for a in _ALPHABETS for c in a}
    for first, last in _FURTHER_LETTERS:
        groups: dict[str, list[str]] = {}
        for c in map(chr, range(first, last + 1)):
            # Letters whose case does not turn back to them would not survive a name's capitals.
            if c not in found and c.isalpha() and c.lower().upper() == c.upper() and c.upper().lower() == c.lower() and c in (c.lower(), c.upper()) and len(c.upper()) == 1:
                groups.setdefault(unicodedata.category(c), []).append(c)
        # Small letters and capitals in the same order, so that a name is one entity in any case.
        for category, letters in groups.items():
            if category == "Lu":
                letters = [c.upper() for c in groups.get("Ll", []) if c.upper() in letters]
            if category == "Ll" and "Lu" in groups:
                letters = [c for c in letters if c.upper() in groups["Lu"]]
            found |= dict.fromkeys(letters, "".join(letters))
    for zero in (c for c in map(chr, range(0x80, 0x110000)) if unicodedata.decimal(c, None) == 0):
        digits = "".join(chr(ord(zero) + n) for n in range(10))
        if all(unicodedata.decimal(c, None) == n for n, c in enumerate(digits)):
            found |= dict.fromkeys(digits, digits)
    return found


_CLASS = _letter_classes()
_PLACES: dict[str, dict[str, int]] = {a: {c: n for n, c in enumerate(a)} for a in set(_CLASS.values())}


def _cipher(key: bytes, tweak: bytes, size: int) -> tuple[Callable[[int], int], Callable[[int], int]]:
    """A keyed permutation of range(size) and its inverse: Feistel rounds, walked back into the range."""
    half = max(1, (max(2, size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    length = (half + 7) // 8

    def mix(number: int, right: int) -> int:
        message = bytes([number]) + right.to_bytes(length, "big")
        out = b"".join(blake2b(message + bytes([k]), key=key, person=tweak[:16], digest_size=64).digest() for k in range(length // 64 + 1))
        return int.from_bytes(out[:length], "big") & mask

    def forth(x: int) -> int:
        left, right = x >> half, x & mask
        for number in range(6):
            left, right = right, left ^ mix(number, right)
        return left << half | right

    def back(x: int) -> int:
        left, right = x >> half, x & mask
        for number in reversed(range(6)):
            left, right = right ^ mix(number, left), left
        return left << half | right

    def walked(step: Callable[[int], int]) -> Callable[[int], int]:
        def walk(x: int) -> int:
            x = step(x)
            while x >= size:
                x = step(x)
            return x

        return walk

    return walked(forth), walked(back)


def permuted(key: bytes, tweak: str, value: int, size: int, allowed: Callable[[int], bool] | None = None) -> int:
    """A keyed bijection of range(size) that maps nothing to itself; with ``allowed``, one of its allowed values."""
    if size < 2:
        return value
    name = blake2b(tweak.encode(), key=key, digest_size=16).digest()
    forth, back = _cipher(key, name, size)
    shift = 1 + int.from_bytes(name, "big") % (size - 1)
    start = value
    while True:
        value = back((forth(value) + shift) % size)
        if value == start or allowed is None or allowed(value):
            return value


def reshaped(key: bytes, kind: str, text: str, allowed: Callable[[str], bool] | None = None, signs: str = "") -> str:
    """``text`` with each letter, digit and sign of ``signs`` replaced within its alphabet, as one bijection on (allowed) texts of its form."""
    value, size, form = 0, 1, []
    for c in text:
        own = _CLASS.get(c) or (signs if c in signs else None)
        form.append(own or c)
        if own:
            value, size = value * len(own) + (own.index(c) if own is signs else _PLACES[own][c]), size * len(own)

    def spelled(value: int) -> str:
        out = []
        for c, own in zip(reversed(text), reversed(form), strict=True):
            if c in _CLASS or c in signs:
                value, digit = divmod(value, len(own))
                c = own[digit]
            out.append(c)
        return "".join(reversed(out))

    shape = "|".join(form)
    if len(shape) > 256:  # alphabets of large scripts
        shape = blake2b(shape.encode(), digest_size=16).hexdigest()
    return spelled(permuted(key, f"{kind}:{shape}", value, size, allowed and (lambda x: allowed(spelled(x)))))


def _plain(text: str) -> str:
    """The digits of ``text``, in whatever script, as ASCII digits."""
    return "".join(str(unicodedata.decimal(c)) for c in text if c.isdecimal())


def _laid(digits: str, like: str) -> str:
    """ASCII ``digits`` put where ``like`` has digits, in their scripts."""
    rest = iter(digits)
    return "".join(chr(ord(c) - unicodedata.decimal(c) + int(next(rest))) if c.isdecimal() else c for c in like)


def _luhn(digits: str) -> int:
    """The check digit that belongs after ``digits``."""
    total = sum(sum(divmod(2 * int(d), 10)) if k % 2 == 0 else int(d) for k, d in enumerate(reversed(digits)))
    return -total % 10


def card(key: bytes, text: str) -> str:
    digits = _plain(text)
    wrong = (int(digits[-1]) - _luhn(digits[:-1])) % 10
    head = reshaped(key, "card", digits[:-1])
    return _laid(head + str((_luhn(head) + wrong) % 10), text)


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def iban(key: bytes, text: str) -> str:
    plain = text.replace(" ", "").upper()
    head = reshaped(key, "iban" + plain[:2], plain[4:])
    check = lambda body: 98 - _mod97(body + plain[:2] + "00")
    wrong = (int(plain[2:4]) - check(plain[4:])) % 100
    new = iter(f"{plain[:2]}{(check(head) + wrong) % 100:02d}{head}")
    return "".join(c if c == " " else next(new) for c in text)


# Country codes of one and two digits; all others have three (ITU-T E.164).
_COUNTRY_CODES = re.compile(r"[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9]\d\d")


def phone(key: bytes, text: str) -> str:
    """The country code after a plus stays; it follows from the digits, whatever signs stand between them."""
    digits = _plain(text)
    code = _COUNTRY_CODES.match(digits) if text.startswith("+") else None
    kept = code[0] if code else ""
    return _laid(kept + reshaped(key, "phone" + kept, digits[len(kept) :]), text)


def ssn(key: bytes, text: str) -> str:
    return _laid(_plain(reshaped(key, "ssn", re.sub(r"\d", lambda d: str(unicodedata.decimal(d[0])), text))), text)


#: Networks with their length: addresses in one stay there, all others stay outside of all.
_NETWORKS = ((0x0A000000, 8), (0x7F000000, 8), (0xAC100000, 12), (0xC0A80000, 16), (0xA9FE0000, 16), (0x00000000, 8), (0xE0000000, 3))


def _network(address: int) -> tuple[int, int] | None:
    return next(((n, bits) for n, bits in _NETWORKS if address >> (32 - bits) == n >> (32 - bits)), None)


def ipv4(key: bytes, text: str) -> str:
    address = 0
    for part in text.split("."):
        address = address << 8 | int(part)
    own = _network(address)
    if own:
        size = 1 << (32 - own[1])
        new = own[0] | permuted(key, f"ip{own[0]}", address & (size - 1), size)
    else:
        new = permuted(key, "ip", address, 1 << 32, lambda x: _network(x) is None)
    zero = ord(text[0]) - unicodedata.decimal(text[0])  # of the script that the address begins in
    return ".".join(str(new >> s & 255) for s in (24, 16, 8, 0)).translate({48 + n: zero + n for n in range(10)})


def email(key: bytes, text: str) -> str:
    local, _, domain = text.lower().rpartition("@")
    labels = domain.split(".")
    own = next((r for r in RESERVED if domain == r or domain.endswith("." + r)), labels[-1])
    head = domain[: len(domain) - len(own)].rstrip(".")
    # One bijection over the local part and the labels that change; no other domain becomes a reserved one.
    free = own in RESERVED or all(not r.endswith("." + own) for r in RESERVED)
    new = reshaped(key, "email" + own, f"{local}@{head}", None if free else lambda x: not f"{x}.{own}".replace("@", ".").endswith(tuple("." + r for r in RESERVED)))
    return new + ("." if head else "") + own


@lru_cache(maxsize=1)
def _names() -> dict[str, tuple[str, str, int]]:
    return {name: (*group, n) for group, names in GIVEN_NAMES.items() for n, name in enumerate(names.split())}


def given_name(key: bytes, name: str) -> str:
    script, gender, at = _names()[name.title()]
    names = GIVEN_NAMES[script, gender].split()
    return names[permuted(key, f"given{script}{gender}", at, len(names))]


def person(key: bytes, text: str) -> str:
    """Titles stay; given names by list; other words by their letters. Words are told apart without case."""
    out = []
    for word in re.split(r"(\s+)", text):
        bare = word.rstrip(".")
        if not word.strip() or bare in TITLES:
            out.append(word)
            continue
        # No surname becomes a given name, so that the two never share a surrogate.
        new = given_name(key, bare) if bare.title() in _names() else reshaped(key, "surname", bare.lower(), lambda w: w.title() not in _names()).title()
        out.append((new.upper() if bare.isupper() and len(bare) > 1 else new) + word[len(bare) :])
    return "".join(out)


# Signs that secrets may have.
_SIGNS = "_-+/"
_HEXADECIMAL = re.compile(r"[0-9a-f]+|[0-9A-F]+")
# Prefixes by which services mark their secrets.
_PREFIX = re.compile(r"AKIA|gh[pousr]_|sk-|xox[abpr]-")


def secret(key: bytes, text: str) -> str:
    """Hexadecimal secrets stay hexadecimal; others keep their form after a known prefix."""
    if _HEXADECIMAL.fullmatch(text):
        new = f"{permuted(key, f'hex{len(text)}', int(text, 16), 16 ** len(text)):0{len(text)}x}"
        return new.upper() if text != text.lower() else new
    prefix = _PREFIX.match(text)
    kept = prefix[0] if prefix else ""
    rest = text[len(kept) :]
    signs = _SIGNS if sum(c not in _SIGNS for c in rest) < 8 else ""
    return kept + reshaped(key, "secret" + kept, rest, None if kept else lambda x: not (_PREFIX.match(x) or _HEXADECIMAL.fullmatch(x)), signs)


_NAME = r"[^\W\d_]+(?:[-'’][^\W\d_]+)*"
_TITLED = re.compile(rf"(?<!\w)(?:{'|'.join(sorted(map(re.escape, TITLES), key=len, reverse=True))})\.?[ ]+({_NAME}(?:[ ]+{_NAME})?)")
_GIVEN = re.compile(rf"(?<!\w)(?:{'|'.join(sorted((n for names in GIVEN_NAMES.values() for n in names.split()), key=len, reverse=True))})[ ]+({_NAME})")
_FURTHER = re.compile(rf"[ ]+({_NAME})")
_POSSESSIVE = re.compile(r"['’]s(?!\w)")
#: Kind, pattern, and what turns an original into its surrogate, in order of precedence.
PATTERNS: tuple[tuple[str, re.Pattern, Callable[[bytes, str], str]], ...] = (
    ("email", re.compile(r"[A-Za-z0-9](?:[A-Za-z0-9._%+-]*[A-Za-z0-9_%+-])?@(?:[A-Za-z0-9](?:[A-Za-z0-9-]*[A-Za-z0-9])?\.)+[A-Za-z]{2,}"), email),
    ("secret", re.compile(r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9-]{16,}|xox[abpr]-[A-Za-z0-9-]{10,}|(?=[0-9a-f]*[a-f])(?=[0-9a-f]*\d)[0-9a-f]{32,}|(?=[0-9A-F]*[A-F])(?=[0-9A-F]*\d)[0-9A-F]{32,})(?![A-Za-z0-9])"), secret),
    ("secret", re.compile(r"(?i:\b(?:password|passwd|secret|token|api[_-]?key)\b\s*[=:]\s*[\"']?)([A-Za-z0-9_\-+/]{8,})"), secret),
    ("iban", re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"), iban),
    ("ip", re.compile(r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d]|\.\d)"), ipv4),
    ("card", re.compile(r"(?<!\d)(?:\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7}|\d{13,19})(?!\d)"), card),
    ("ssn", re.compile(r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"), ssn),
    ("phone", re.compile(r"(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}|\d{3}[ .-]\d{3}[ .-]\d{4})(?!\d)"), phone),
    ("person", _TITLED, person),
    ("person", _GIVEN, person),
)
_TITLE_WORD = re.compile(rf"(?<!\w)(?:{'|'.join(map(re.escape, TITLES))})\.?[ ]")


def _canonical(kind: str, text: str) -> str:
    if kind in ("phone", "card", "ssn"):
        return "+" * text.startswith("+") + _plain(text)
    if kind == "iban":
        return text.replace(" ", "")
    return text.lower() if kind in ("email", "person") else text


def _capital(word: str) -> bool:
    return word[0].isupper() and not word.isupper()


def _whole_name(text: str, start: int, end: int) -> int:
    """The end of the name that begins with ``text[start:end]``: all given names and the surname, three words at least if they are there; less a possessive."""
    words = text[start:end].split()
    while not (owner := _POSSESSIVE.search(text, start, end)) and (words[-1].title() in _names() or len(words) < 3):
        further = _FURTHER.match(text, end)
        if not further or not _capital(further[1]):
            break
        words.append(further[1])
        end = further.end()
    return owner.start() if owner else end


_WORD, _JOINT = re.compile(r"\w+(?:[-'’]\w+)*"), re.compile(r"[-'’]")


def _repeats(text: str, taken: list[tuple[int, int, str, Callable]]) -> Iterator[tuple[int, int, str, Callable[[bytes, str], str]]]:
    """Words of the names in ``taken`` that stand elsewhere in the text, capitalized or in capitals; of joined words the longest."""
    words = {w for start, end, kind, _ in taken if kind == "person" for w in text[start:end].split() if len(w) > 1 and w not in TITLES}
    forms = {f for w in words for f in (w, w.title(), w.upper())}
    most = max((len(_JOINT.split(f)) for f in forms), default=0)
    for match in _WORD.finditer(text) if forms else ():
        joints = [match.start() - 1, *(j.start() for j in _JOINT.finditer(text, *match.span())), match.end()]
        at = 0
        while at < len(joints) - 1:
            start = joints[at] + 1
            last = next((n for n in range(min(at + most, len(joints) - 1), at, -1) if text[start : joints[n]] in forms), None)
            if last:
                yield start, joints[last], "person", person
            at = last or at + 1


def entities(text: str) -> list[tuple[int, int, str, Callable[[bytes, str], str]]]:
    """(start, end, kind, surrogate function) of every entity, in order and without overlaps: what an earlier pattern takes, a later one leaves."""
    numbers = re.search(r"\d", text) is not None
    taken: list[tuple[int, int, str, Callable]] = []

    def take(found: Iterator[tuple[int, int, str, Callable]]) -> None:
        starts, more, behind = [s for s, _, _, _ in taken], [], 0
        for one in found:
            at = bisect(starts, one[0])
            if one[0] >= behind and (not at or taken[at - 1][1] <= one[0]) and (at == len(starts) or one[1] <= starts[at]):
                more.append(one)
                behind = one[1]
        if more:
            taken.extend(more)
            taken.sort(key=lambda x: x[0])

    for kind, pattern, change in PATTERNS:
        if kind == "email" and "@" not in text or kind in ("iban", "ip", "card", "ssn", "phone") and not numbers:
            continue
        if pattern is _TITLED and not _TITLE_WORD.search(text):
            continue
        take(_matches(text, kind, pattern, change))
    take(_repeats(text, list(taken)))
    return taken


def _matches(text: str, kind: str, pattern: re.Pattern, change: Callable[[bytes, str], str]) -> Iterator[tuple[int, int, str, Callable]]:
    for match in pattern.finditer(text):
        start, end = match.span()
        if pattern is _TITLED or pattern.groups and kind == "secret":
            start, end = match.span(1)
        if kind == "person":
            words = text[start:end].split()
            if not all(map(_capital, words)):
                if pattern is not _TITLED or not _capital(words[0]):
                    continue
                end = start + len(words[0])
            end = _whole_name(text, start, end)
        own = text[start:end]
        if kind == "iban" and _mod97(own.replace(" ", "")[4:] + own[:4]) != 1:
            continue
        if kind == "ip" and not all(int(part) < 256 and len(str(int(part))) == len(part) for part in own.split(".")):
            continue
        if kind == "card" and own.isdecimal() and _luhn(own[:-1]) != int(own[-1]):
            continue
        if kind == "phone" and not 7 <= sum(map(str.isdecimal, own)) <= 15:
            continue
        yield start, end, kind, change


def surrogates(text: str, key: bytes) -> tuple[str, list[tuple[str, str, str]]]:
    """The text with surrogates, and (kind, original, surrogate) of each entity in order."""
    found = entities(text)
    if not found:
        return text, []
    at, parts, changed = 0, [], []
    owners: dict[tuple[str, str], str] = {}
    for start, end, kind, change in found:
        old = text[start:end]
        name, new, tries = _canonical(kind, old), change(key, old), 0
        while owners.setdefault((kind, _canonical(kind, new)), name) != name:
            tries += 1
            new = change(blake2b(key, person=b"retry", salt=tries.to_bytes(8, "big"), digest_size=32).digest(), old)
        if new == old:
            new = f"{kind}-{blake2b(name.encode(), key=key, digest_size=8).hexdigest()}"
        parts += [text[at:start], new]
        changed.append((kind, old, new))
        at = end
    return "".join(parts) + text[at:], changed


def replaced(docs: DataFrame, key: bytes) -> DataFrame:
    """The rows of ``docs`` with surrogates in ``text``, and ``__llm_entities``: how many there are."""
    place, schema = docs.columns.index("text"), StructType([*docs.schema.fields, StructField(f"{OWN}entities", LongType())])
    names = schema.names

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            done = [(None, []) if t is None else surrogates(t, key) for t in batch.column(place).to_pylist()]
            columns = batch.columns
            columns[place] = pa.array([t for t, _ in done], batch.schema.types[place])
            yield pa.RecordBatch.from_arrays([*columns, pa.array([len(c) for _, c in done], pa.int64())], names)

    return docs.mapInArrow(rows, schema)


def pseudonymized(docs: DataFrame, key: bytes) -> DataFrame:
    """doc_id, text with surrogates, n_entities and changed, a row per document."""
    source = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    count = F.col(f"{OWN}entities")
    return replaced(source, key).select("doc_id", "text", count.alias("n_entities"), (count > 0).alias("changed"))


def audit(docs: DataFrame, key: bytes) -> DataFrame:
    """kind, n_originals, n_surrogates, n_unchanged and n_reused (surrogates that are originals too), over keyed hashes."""

    def digest(kind: str, text: str) -> int:
        return int.from_bytes(hmac.digest(key, f"{kind}:{_canonical(kind, text)}".encode(), "blake2b")[:8], "big", signed=True)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            pairs = {(k, digest(k, a), digest(k, b)) for t in batch.column(0).to_pylist() for k, a, b in surrogates(t, key)[1]}
            kinds, old, new = zip(*pairs, strict=True) if pairs else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(old, pa.int64()), pa.array(new, pa.int64())], ["kind", "old", "new"])

    pairs = docs.select(text_of().alias("text")).mapInArrow(rows, "kind string, old bigint, new bigint").distinct()
    sides = pairs.select("kind", F.explode(F.array(F.struct(F.col("old").alias("h"), F.lit(1).alias("o"), F.lit(0).alias("n")), F.struct(F.col("new").alias("h"), F.lit(0).alias("o"), F.lit(1).alias("n")))).alias("s"))
    each = sides.groupBy("kind", "s.h").agg(F.max("s.o").alias("o"), F.max("s.n").alias("n"))
    counted = each.groupBy("kind").agg(F.sum("o").alias("n_originals"), F.sum("n").alias("n_surrogates"), F.sum(F.col("o") * F.col("n")).alias("n_reused"))
    same = pairs.groupBy("kind").agg(F.count_if(F.col("old") == F.col("new")).alias("n_unchanged"))
    return counted.join(same, "kind").select("kind", "n_originals", "n_surrogates", "n_unchanged", "n_reused")
