"""Personal data in text: where it is, of which kind, and how a keyed surrogate of it looks.

A surrogate keeps what the format says: separators, the case and script of letters, the country code of
a phone number, the first digit and check digit of a card number, the gender of a name. What is left is
permuted by a keyed Feistel network over exactly the strings of that format, so two originals of one
format never get one surrogate, and the same original gets the same one everywhere. Where originals fill
a format, later attempts make longer surrogates, so that there is always room.
"""

from __future__ import annotations

import hashlib
import math
import re
import unicodedata
from dataclasses import dataclass
from functools import cache

EMAIL = re.compile(r"(?<![\w.+%-])[\w.+%-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}(?![\w-])")
IP = re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|\d?\d)(?!\.?\w)")
IBAN = re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)")
CARD = re.compile(r"(?<![\w.-])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3})(?![\w-])")
PHONE = re.compile(
    r"(?<![\w+(])(?:(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\) ?|\d{3}[ .-])\d{3}[ .-]?\d{4}|\+\d{1,3}(?:[ .-]?\d{2,4}){2,5})(?!\w)"
)
NUMBER = re.compile(r"(?<![\w.-])(?:\d{9}|\d{3}-\d{2}-\d{4})(?![\w-])")

#: Forms of address that tell the gender of the name after them.
TITLES = {
    "m": ["Mr", "Mister", "Sir", "Herr", "Monsieur", "Señor", "Don"],
    "f": ["Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mademoiselle", "Señora", "Señorita", "Doña"],
}

#: Frequent given names by script and gender. They stand for each other.
GIVEN = {
    ("latin", "m"): (
        "James John Robert Michael William David Richard Joseph Thomas Charles Christopher Daniel Matthew Anthony "
        "Hans Klaus Jürgen Wolfgang Stefan Pierre Jacques Philippe Laurent Carlos José Miguel Javier Alejandro"
    ).split(),
    ("latin", "f"): (
        "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Margaret Sandra Emily Michelle "
        "Ursula Sabine Monika Brigitte Katharina Nathalie Isabelle Françoise Sylvie Carmen Dolores Pilar Lucía Mónica"
    ).split(),
    ("cyrillic", "m"): "Иван Дмитрий Сергей Алексей Андрей Михаил Николай Владимир".split(),
    ("cyrillic", "f"): "Ольга Елена Наталья Татьяна Ирина Светлана Екатерина Людмила".split(),
    ("greek", "m"): "Γιώργος Δημήτρης Κώστας Νίκος".split(),
    ("greek", "f"): "Ελένη Κατερίνα Βασιλική Σοφία".split(),
}
_GIVEN = {name: group for group, names in GIVEN.items() for name in names}
_TITLE = {title: gender for gender, titles in TITLES.items() for title in titles}
_CAPITAL = r"[^\W\d_a-zß-öø-ÿа-яё]\w*(?:[-'’][^\W\d_]\w*)*"
TITLED = re.compile(rf"(?<!\w)({'|'.join(sorted(_TITLE, key=len, reverse=True))})\.? ({_CAPITAL})(?: ({_CAPITAL}))?")
NAMED = re.compile(rf"(?<!\w)({'|'.join(sorted(_GIVEN, key=len, reverse=True))}) ({_CAPITAL})")

#: Letters that stand for each other, so that words stay pronounceable. Other letters stand for the letters
#: of their half block of Unicode; those that change when written in capitals and back stay.
CLASSES = (
    "0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "аеиоу", "бвгджзклмнпрстфх", "αεηιο", "βγδζθκλμνπρτφχ",
    "àáâãäåæèéêëìíîïòóôõöøùúûüýÿ", "çðñþ", "āăąēĕėęěīĭįōŏőœũūŭůűų", "ćĉċčďđĝğġģĥħĵķĺļľłńņňŋŕŗřśŝşšţťŧŵźżž",
    "ыэюяё", "йцчшщ", "άέήίόύώ", "".join(map(chr, range(0x4E00, 0xA000))), "".join(map(chr, range(0xAC00, 0xD7A4))),
)
_CLASS = {char: members for members in CLASSES for char in members}
#: What longer surrogates begin with, by script, before it is permuted.
_SYLLABLE = {"LATIN": "ba", "CYRILLIC": "ба", "GREEK": "βα"}

KINDS = ("email", "ip", "iban", "card", "phone", "number", "name")


@dataclass(frozen=True)
class Entity:
    start: int
    end: int
    kind: str
    canonical: str  # the same for every mention of one person, account or machine
    gender: str = ""


@cache
def _members(char: str) -> str:
    """The characters that ``char`` stands among; none if it stays."""
    if char in _CLASS or not char.isalpha():
        return _CLASS.get(char, "")
    low = ord(char) & ~127
    block = [c for c in map(chr, range(low, low + 128)) if c not in _CLASS and unicodedata.category(c) in ("Ll", "Lo")]
    block = [c for c in block if c not in "ªºσ" and c.lower() == c and c.upper().lower() == c]
    return "".join(block) if char in block and len(block) > 1 else ""


def _longer(word: str, syllables: int) -> str:
    """``word`` behind so many syllables of its script."""
    letter = next((c for c in word if c.isalpha() and _members(c)), "b")
    return _SYLLABLE.get(unicodedata.name(letter, "").split(" ")[0], _members(letter)[0]) * syllables + word


def digits(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def luhn(number: str) -> bool:
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(number))) % 10 == 0


def _script(word: str) -> str:
    return "cyrillic" if "Ѐ" <= word[0] <= "ӿ" else "greek" if "Ͱ" <= word[0] <= "Ͽ" else "latin"


def phone_parts(text: str) -> tuple[str, str]:
    """Country code with its plus, and the national digits."""
    if not text.startswith("+"):
        return "", digits(text)
    code = re.match(r"\+\d{1,3}(?=[ .(-])", text)
    # Without a separator the country code cannot be told from the rest; the last ten digits are national.
    code = code.group() if code else "+" + digits(text)[: max(1, len(digits(text)) - 10)]
    return code, digits(text)[len(code) - 1 :]


def canonical(kind: str, text: str) -> str:
    if kind in ("email", "name"):
        return text.lower()
    if kind == "ip":
        return ".".join(str(int(part)) for part in text.split("."))
    if kind == "phone":
        return phone_parts(text)[1]
    return text.replace(" ", "").replace("-", "")


def find_entities(text: str | None) -> list[Entity]:
    """Entities that do not overlap, by start; where two kinds claim a place, the earlier kind has it."""
    if not text:
        return []
    claims: list[Entity] = []
    if "@" in text:
        claims += [Entity(*m.span(), "email", canonical("email", m.group())) for m in EMAIL.finditer(text)]
    if re.search(r"\d", text):
        for kind, pattern in (("ip", IP), ("iban", IBAN), ("card", CARD), ("phone", PHONE), ("number", NUMBER)):
            claims += [Entity(*m.span(), kind, canonical(kind, m.group())) for m in pattern.finditer(text)]
    claims += _names(text)
    taken, found = bytearray(len(text)), []
    for claim in claims:
        if not any(taken[claim.start : claim.end]):
            taken[claim.start : claim.end] = b"\1" * (claim.end - claim.start)
            found.append(claim)
    return sorted(found, key=lambda e: e.start)


def _names(text: str) -> list[Entity]:
    """Every word of a full name, and later mentions of a surname that was met with a title or given name."""
    found: list[Entity] = []
    if any(title in text for title in _TITLE):
        for m in TITLED.finditer(text):
            gender = _TITLE[m[1]]
            found += [Entity(*m.span(g), "name", canonical("name", m[g]), gender) for g in (2, 3) if m[g]]
    if any(name in text for name in _GIVEN):
        for m in NAMED.finditer(text):
            gender = _GIVEN[m[1]][1]
            found += [Entity(*m.span(g), "name", canonical("name", m[g]), gender) for g in (1, 2)]
    known = {text[e.start : e.end]: e.gender for e in found}
    # One look at each word of the text finds the names that begin with it, however many are known.
    begins: dict[str, list[str]] = {}
    for word in sorted(known):
        begins.setdefault(_RUN.match(word).group(), []).append(word)
    for run in _RUN.finditer(text) if begins else ():
        for word in begins.get(run.group(), ()):
            end = run.start() + len(word)
            if text.startswith(word, run.start()) and not _RUN.match(text, end):
                found.append(Entity(run.start(), end, "name", canonical("name", word), known[word]))
    return found


_RUN = re.compile(r"\w+")


class Surrogates:
    """Keyed surrogates. ``attempt`` is 0 but for originals whose surrogate met another's."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key, digest_size=32).digest()

    def _round(self, tweak: str, number: int, half: int) -> int:
        message = f"{tweak}|{number}|{half}".encode()
        return int.from_bytes(hashlib.blake2b(message, key=self.key, digest_size=16).digest(), "big")

    def permuted(self, value: int, size: int, tweak: str) -> int:
        """A keyed permutation of ``range(size)``: a Feistel network, walked on until back inside."""
        if size < 2:
            return value
        bits = max(1, ((size - 1).bit_length() + 1) // 2)
        mask = (1 << bits) - 1
        while True:
            left, right = value >> bits, value & mask
            for number in range(8):
                left, right = right, left ^ (self._round(tweak, number, right) & mask)
            value = left << bits | right
            if value < size:
                return value

    def spelled(self, text: str, tweak: str, fixed: int = 0) -> str:
        """Another string of the same format; the first ``fixed`` characters stay."""
        places = [(i, own) for i, c in enumerate(text) if i >= fixed and (own := _members(c))]
        value, size = 0, 1
        for i, members in places:
            value, size = value * len(members) + members.index(text[i]), size * len(members)
        pattern = "".join(own[0] if i >= fixed and (own := _members(c)) else c for i, c in enumerate(text))
        value, out = self.permuted(value, size, f"{tweak}|{pattern}"), list(text)
        for i, members in reversed(places):
            value, at = divmod(value, len(members))
            out[i] = members[at]
        return "".join(out)

    def _numbered(self, format: str, value: int) -> str:
        """The string of that number among those of one format."""
        out = []
        for members in map(_members, reversed(format)):
            value, at = divmod(value, len(members))
            out.append(members[at])
        return "".join(reversed(out))

    def of(self, kind: str, text: str, gender: str = "", attempt: int = 0) -> str:
        """The surrogate of a canonical form.

        From the third attempt on names and e-mail addresses get one syllable more each time. Phone and
        nine-digit numbers and IBANs get a digit more after as many attempts as they have characters. There
        are far more card numbers and addresses than a corpus holds.
        """
        tweak, more = f"{kind}|{attempt}", max(0, attempt - 1)
        if kind == "email":
            local, _, domain = text.partition("@")
            body, _, top = domain.rpartition(".")
            local = _longer(local, more)
            return f"{self.spelled(local, f'{tweak}|{domain}')}@{self.spelled(body, f'{tweak}|domain')}.{top}"
        if kind == "ip":
            value = int.from_bytes(bytes(map(int, text.split("."))), "big")
            return ".".join(map(str, self.permuted(value, 2**32, tweak).to_bytes(4, "big")))
        if kind == "iban":
            body = self.spelled(text[4:].lower() + "0" * (attempt - len(text)), f"{tweak}|{text[:2]}").upper()
            number = int("".join(str(int(c, 36)) for c in f"{body}{text[:2]}00"))
            return f"{text[:2]}{98 - number % 97:02d}{body}"
        if kind == "card":
            if luhn(text):
                body = self.spelled(text[:-1], f"{tweak}|valid", 1)
                return next(body + d for d in "0123456789" if luhn(body + d))
            while luhn(text := self.spelled(text, tweak, 1)):
                pass
            return text
        if kind == "name":
            proper = text[:1].upper() + text[1:]
            if group := _GIVEN.get(proper):
                # More syllables go before another listed name, whose end shows the gender.
                names, before = GIVEN[group], _longer(text, more)[: -len(text)]
                size = math.prod(len(_members(c)) for c in before)
                value, at = divmod(self.permuted(names.index(proper), size * len(names), f"{tweak}|{group}"), len(names))
                return self._numbered(before, value) + names[at].lower()
            if not any(map(_members, text)):
                # Nothing can be permuted: a word made from the hash; those that meet try again.
                made = _longer("", 3 + more)
                return self._numbered(made, self._round(f"{tweak}|{text}", 0, 0))
            # A last vowel stays: it often shows gender or case.
            stem, end = (text[:-1], text[-1]) if len(text) > 2 and text[-1] in "aeiouаеиоуαεηιο" else (text, "")
            return self.spelled(_longer(stem, more), f"{tweak}|{end}") + end
        return self.spelled(text + "0" * (attempt - len(text)), tweak)

    def written(self, entity: Entity, text: str, attempt: int = 0) -> str:
        """The surrogate in the format of this mention."""
        own = self.of(entity.kind, entity.canonical, entity.gender, attempt)
        if entity.kind == "ip":
            return own
        if entity.kind == "name":
            return own.upper() if text.isupper() and len(text) > 1 else own[:1].upper() + own[1:] if text[:1].isupper() else own
        if entity.kind == "email":
            cased = [n.upper() if o.isupper() else n for o, n in zip(text, own, strict=False)]
            return "".join(cased) if len(own) == len(text) else own
        keep = len(phone_parts(text)[0]) if entity.kind == "phone" else 0
        letters = iter(own)
        return "".join([text[:keep], *[next(letters) if c.isalnum() else c for c in text[keep:]], *letters])
