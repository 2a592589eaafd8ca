"""Keyed, type-consistent replacements of personal information.

A replacement is made letter by letter and digit by digit: the characters of an
entity are a number in a mixed base, each place being the place of a character
among those of its kind (vowels, two sets of consonants, the same with accents,
of each script; digits).  A keyed permutation of the numbers of that shape gives
the replacement.  So it has the entity's length, script, letter case, syllables
and format, a final vowel, which marks the gender of many given names, stays,
and no table, pool or counter is needed, however many entities there are.

Different entities of a kind never get the same replacement, in the whole corpus
and in every run with the same key, because a permutation can't collide: that
takes the place of collision checks.  An entity never gets itself either, as the
permutation is one cycle.  Mentions of an entity that differ in letter case,
spacing, disguise or the order of names get replacements that differ likewise.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

# Kinds of letters that stand for each other, by script.
LETTER_KINDS = (
    "aeiouy",
    "bcdfgkptvz",
    "lmnrs",
    "hjqwx",
    "àáâãäåæèéêëìíîïòóôõöøœùúûüýÿąęėēīōūőű",
    "çñßðþćčďđĺľłńňŕřśšťźżžğ",
    "аеёиоуыэюя",
    "бвгджзкпстфхцчшщ",
    "лмнрй",
    "ьъ",
    "0123456789",
)
_KIND = {c: kind for kind in LETTER_KINDS for c in kind}
_LATIN = "abcdefghijklmnopqrstuvwxyz"
_FIRST_DIGITS = "123456789"
_VOWELS = set("aeiouyаеёиоуыэюя")
# What an address keeps, whole words and the ends of compound ones.
STREET_WORDS = frozenset(
    "street st road rd lane ln avenue ave drive dr wynd court ct close crescent row terrace way place pl square boulevard blvd trail gardens apt unit suite apartment flat p o po box "
    "postfach rue chemin impasse allée quai route bp bis ter quater de la le les las los del du des calle avda avenida plaza paseo camino apdo apartado correos c via viale piazza corso vicolo "
    "rua travessa praça ul ул д".split()
)
_COMPOUND = re.compile(r"(?i)(.+?)(straße|strasse|str|weg|gasse|platz|allee|vägen|gatan|gränd|stigen|torget|straat|laan|plein|gracht|pad|katu|tie|polku)$")
_PIECE = re.compile(r"\d+|[^\W\d_]+")
_AT = re.compile(r"\s?[\[(]\s?(?:at|a|@)\s?[\])]\s?|\s+at\s+|@", re.IGNORECASE)
_DOTS = re.compile(r"(\s?[\[(]\s?dot\s?[\])]\s?|\s+dot\s+|\.)", re.IGNORECASE)
ROUNDS = 6


@lru_cache(maxsize=4096)
def _block(c: str) -> str:
    """The lower-case letters of a character's block of 64, for scripts without kinds of their own."""
    start = ord(c) & ~63
    own = [chr(k) for k in range(start, start + 64)]
    return "".join(x for x in own if x.isalpha() and x.lower() == x and len(x.upper()) == 1)


class Cipher:
    """Keyed permutations; the key is the only secret."""

    def __init__(self, secret: bytes):
        self.secret = hashlib.blake2b(secret, digest_size=32).digest()
        self.token = lru_cache(maxsize=200_000)(self._token)

    def _round(self, tweak: bytes, number: int, half: int, size: int) -> int:
        data = tweak + b"|%d|%d" % (number, half)
        return int.from_bytes(hashlib.blake2b(data, key=self.secret, digest_size=16).digest(), "big") & (size - 1)

    def _walk(self, x: int, size: int, tweak: bytes, backwards: bool) -> int:
        """A Feistel network on twice so many bits as a half has, repeated until the number is below ``size`` again."""
        bits = max(1, ((size - 1).bit_length() + 1) // 2)
        half = 1 << bits
        while True:
            a, b = x >> bits, x & (half - 1)
            for number in range(ROUNDS):
                if backwards:
                    a, b = b ^ self._round(tweak, ROUNDS - 1 - number, a, half), a
                else:
                    a, b = b, a ^ self._round(tweak, number, b, half)
            x = a << bits | b
            if x < size:
                return x

    def permute(self, x: int, size: int, tweak: bytes) -> int:
        """Another number below ``size``: the next one of a keyed cycle through all of them."""
        if size < 2:
            return x
        return self._walk((self._walk(x, size, tweak, False) + 1) % size, size, tweak, True)

    def characters(self, chars: str, kinds: list[str | None], tweak: str) -> str:
        """``chars`` (in lower case) with those that have a kind replaced by others of it."""
        number, size = 0, 1
        for c, kind in zip(chars, kinds, strict=True):
            if kind:
                number, size = number * len(kind) + kind.index(c), size * len(kind)
        shape = "".join(f"<{kind[0]}{len(kind)}>" if kind else c for c, kind in zip(chars, kinds, strict=True))
        number = self.permute(number, size, f"{tweak}|{shape}".encode())
        out = []
        for c, kind in zip(reversed(chars), reversed(kinds), strict=True):
            if kind:
                number, place = divmod(number, len(kind))
                c = kind[place]
            out.append(c)
        return "".join(reversed(out))

    def _token(self, lowered: str, tweak: str) -> str:
        kinds = [_KIND.get(c) or (_block(c) if c.isalpha() and c in _block(c) else None) for c in lowered]
        if tweak == "name" and len(lowered) > 2 and lowered[-1] in _VOWELS:
            kinds[-1] = None
        if tweak == "number" and lowered[0] != "0":
            kinds[0] = _FIRST_DIGITS
        return self.characters(lowered, kinds, tweak)

    def word(self, word: str, tweak: str) -> str:
        """A word or number in its letter case; characters that change their length with their case stay."""
        lowered = "".join(c.lower() if len(c.lower()) == 1 else c for c in word)
        new = self.token(lowered, tweak)
        return "".join(n.upper() if c.isupper() and len(n.upper()) == 1 else n for c, n in zip(word, new, strict=True))

    def surrogate(self, entity: str, kind: str, particles: frozenset[str] = frozenset()) -> str:
        """The replacement of an entity as it stands; ``particles`` are parts of names that stay."""
        if kind == "person_name":
            return self._name(entity, particles)
        if kind == "email":
            return self._email(entity)
        if kind == "street_address":
            return _PIECE.sub(lambda m: self._street(m.group()), entity)
        return self._number(entity, kind)

    def _name(self, name: str, particles: frozenset[str]) -> str:
        def part(m: re.Match) -> str:
            own, after = m.group(), name[m.end() : m.end() + 1]
            if own.lower() in particles and own.lower() != name.lower() or len(own) == 1 and after in ("'", "’") and after:
                return own
            return self.word(own, "initial" if len(own) == 1 else "name")

        return re.sub(r"[^\W\d_]+", part, name)

    def _email(self, mail: str) -> str:
        """Labels one by one, so a domain keeps its mails together; it goes under .invalid, which leads nowhere."""
        at = _AT.search(mail)
        if at is None:
            return self.word(mail, "mail")
        dots = _DOTS.split(mail[at.end() :])
        labels = [self.word(x, "mail") if i % 2 == 0 and i < len(dots) - 1 else x for i, x in enumerate(dots)]
        dot = dots[-2] if len(dots) > 1 else "."
        end = "INVALID" if mail.isupper() else "invalid"
        local = "".join(self.word(x, "mail") if i % 2 == 0 else x for i, x in enumerate(re.split(r"([.+])", mail[: at.start()])))
        return f"{local}{at.group()}{''.join(labels)}{dot}{end}"

    def _street(self, piece: str) -> str:
        if piece.isdigit():
            return self.word(piece, "number")
        if piece.lower() in STREET_WORDS or len(piece) < 3 and piece.isupper() or len(piece) == 1:
            return piece
        if m := _COMPOUND.match(piece):
            return self.word(m[1], "street") + m[2]
        return self.word(piece, "street")

    def _number(self, entity: str, kind: str) -> str:
        """Digits and letters are one number, whatever stands between them; a phone keeps its first digits, which tell the country."""
        skipped = {m.start() + 1 for m in re.finditer(r"\(0\)", entity)} if kind == "phone" else set()
        places = [i for i, c in enumerate(entity) if (c.isdigit() or c.isalpha() and kind != "phone") and i not in skipped and c.isascii()]
        kept = 0 if kind != "phone" or not places else 2 if entity.startswith("+") else 4 if entity.startswith("00") else 1 if entity.startswith("0") else 0
        chars = "".join(entity[i].lower() for i in places)
        kinds = [None if n < kept else "0123456789" if c.isdigit() else _LATIN for n, c in enumerate(chars)]
        out = list(entity)
        for i, new in zip(places, self.characters(chars, kinds, kind), strict=True):
            out[i] = new.upper() if entity[i].isupper() else new
        return "".join(out)
