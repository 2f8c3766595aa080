"""Personal data replaced by keyed surrogates of the same type and format.

An entity is read as a number in the domain of its format: every digit, letter or octet that may change is a place of a mixed
radix. A keyed Feistel network p permutes that domain, and the surrogate of x is the first of q(x), q(q(x)), ... that is of x's own
class (a public address, a number without leading zero), where q(x) = p(p^-1(x) + 1) is a single cycle through the
domain. So equal entities have equal surrogates in every document and on every machine, different ones different
surrogates, and none is its own. Names are drawn from lists by script and gender in the same way, and surnames are spelled
in syllables of their script. `collisions` checks the two promises over a whole corpus.

Numbers are cards by their issuer's first digits and check digit; numbers to call by a country code, brackets, a known grouping or a word before
them; keys by their marks, or by a word before them and a value that is no plain word. Names are found after titles, and
where a listed given name comes first, in Latin, Cyrillic and Greek; those of other scripts are not.
"""

from __future__ import annotations

import functools
import hashlib
import hmac
import ipaddress
import math
import re
import unicodedata
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Given names by script and gender, titles by gender, and syllables that surnames are spelled in.
GIVEN = {
    ("latin", "f"): ["Alice", "Amélie", "Andrea", "Anna", "Anne", "Astrid", "Beatriz", "Brigitte", "Camille", "Carmen", "Catherine", "Charlotte", "Chloé", "Clara", "Claudia", "Daniela", "Elena", "Elisabeth", "Emily", "Emma", "Erika", "Eva", "Florence", "Gabriela", "Hannah", "Heidi", "Helena", "Ingrid", "Isabel", "Jane", "Jennifer", "Jessica", "Johanna", "Julia", "Karin", "Katharina", "Laura", "Lena", "Lucía", "Manon", "Lucia", "Margaret", "María", "Maria", "Marie", "Martina", "Mary", "Mónica", "Monica", "Monika", "Natalie", "Nicole", "Olivia", "Patricia", "Paula", "Petra", "Pilar", "Rebecca", "Renate", "Rosa", "Sabine", "Sandra", "Sarah", "Sofia", "Sophie", "Susan", "Ursula", "Valérie", "Victoria"],
    ("latin", "m"): ["Alain", "Alejandro", "Andreas", "Anthony", "Antoine", "Bernd", "Carlos", "Charles", "Christian", "Christophe", "Daniel", "David", "Diego", "Dieter", "Edward", "Enrique", "Fernando", "François", "Frank", "Friedrich", "Georg", "George", "Gérard", "Guillaume", "Günter", "Hans", "Heinrich", "Hugo", "Jacques", "Jaime", "Javier", "Jean", "Johannes", "John", "Jorge", "José", "Jose", "Juan", "Julien", "Jürgen", "Karl", "Klaus", "Lorenzo", "Louis", "Luis", "Manfred", "Manuel", "Martin", "Matthias", "Michael", "Miguel", "Nicolas", "Oliver", "Pablo", "Paul", "Pedro", "Peter", "Philippe", "Pierre", "Rafael", "Ralf", "Robert", "Sergio", "Stefan", "Thomas", "Wilhelm"],
    ("cyrillic", "f"): ["Александра", "Алина", "Анастасия", "Вера", "Виктория", "Дарья", "Екатерина", "Елена", "Ирина", "Ксения", "Людмила", "Мария", "Надежда", "Наталья", "Ольга", "Полина", "Светлана", "Татьяна", "Юлия"],
    ("greek", "f"): ["Αθηνά", "Αικατερίνη", "Άννα", "Βασιλική", "Γεωργία", "Ελένη", "Ειρήνη", "Ευαγγελία", "Κωνσταντίνα", "Μαρία", "Παναγιώτα", "Σοφία"],
    ("greek", "m"): ["Αθανάσιος", "Αλέξανδρος", "Ανδρέας", "Βασίλειος", "Γεώργιος", "Δημήτριος", "Ευάγγελος", "Ιωάννης", "Κωνσταντίνος", "Νικόλαος", "Παναγιώτης", "Χρήστος"],
    ("cyrillic", "m"): ["Александр", "Алексей", "Андрей", "Борис", "Виктор", "Владимир", "Григорий", "Дмитрий", "Евгений", "Иван", "Игорь", "Константин", "Михаил", "Николай", "Олег", "Павел", "Роман", "Сергей", "Юрий"],
}
TITLES = {"f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Srta", "Doña", "Г-жа", "Госпожа", "Κυρία"], "m": ["Mr", "Herr", "Monsieur", "Señor", "Sr", "Don", "Г-н", "Господин", "Κύριος"], "": ["Dr", "Prof"]}
#: Consonants, vowels, and vowels that no plain name is spelled with.
SYLLABLES = {"latin": ("bcdfghjklmnprstvwz", "aeiou", "áéíóúäëïöü"), "cyrillic": ("бвгдзклмнпрст", "аеиоу", "ыэюя"), "greek": ("βγδζθκλμνπρστφχ", "αεηιου", "άέήίόύ")}
#: What ends a spelled given name, and a spelled surname, by gender.
GIVEN_ENDS = {"latin": {"f": "na", "m": "n", "": ""}, "cyrillic": {"f": "на", "m": "н", "": ""}, "greek": {"f": "να", "m": "νος", "": ""}}
CUES = "tel|phone|mobile|cell|fax|call|sms|whatsapp|ring|dial|telefon|telefono|teléfono|móvil|movil|llame|tél|téléphone|telephone|appelez|portable|handy|mobil|rufen|anruf|тел|телефон|τηλ"
SECRET_CUES = "password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|bearer|credential|auth"
NOT_SECRET = frozenset(["required", "optional", "string", "number", "boolean", "integer", "none", "null", "true", "false", "undefined", "example", "changeme", "password", "secret", "token", "here", "below", "above", "missing", "invalid", "expired"])
#: First digits of card numbers and how many digits they have.
ISSUERS = (("4", (13, 16, 19)), ("5[1-5]", (16,)), ("2(2[2-9]|[3-6]|7[01]|720)", (16,)), ("3[47]", (15,)), ("3(0[0-5]|[68])", (14,)), ("6(011|4[4-9]|5)", (16, 19)), ("35", (16,)), ("62", (16, 17, 18, 19)), ("(50|5[6-8]|6[0-9])", (12, 13, 15, 16, 18, 19)))

_NAME = r"\p{Lu}\p{L}+(?:[-'’]\p{Lu}\p{L}+)?"
_ALL_GIVEN = "|".join(sorted({form for names in GIVEN.values() for n in names for form in (n, n.upper())}, key=lambda n: (-len(n), n)))
_ALL_TITLES = "|".join(sorted({regex.escape(form) for ts in TITLES.values() for t in ts for form in (t, t.upper())}, key=lambda n: (-len(n), n)))
_PHONE = r"(?<![\w.+/-])(?:(?:\+|00)\d{1,3}[ .-]?)?(?:\(\d{1,5}\)[ .-]?)?\d{2,12}(?:[ ]\d{2,8}){0,5}(?:[./-]\d{2,8}){0,4}(?![\w-]|[.,]\d)"
PATTERN = regex.compile(
    rf"""
    (?P<email>(?<![\w.+%-])[\w.+%-]+@[\w-]+(?:\.[\w-]+)*\.\p{{L}}{{2,}}(?![\w-]))
  | (?P<secret>(?<![\w])(?:AKIA|ASIA)[A-Z0-9]{{16}}(?!\w) | (?<!\w)(?:gh[pousr]_|sk-|xox[abprs]-|glpat-)[A-Za-z0-9_-]{{16,}}
      | (?<!\w)(?i:{SECRET_CUES})["']?\s*[:=]\s*["']?(?P<value>[^\s"',;]{{6,}})
      | (?<!\w)(?:[0-9a-f]{{32,128}}|[0-9A-F]{{32,128}})(?!\w))
  | (?P<ipv6>(?<![\w:.])(?:(?:[0-9A-Fa-f]{{1,4}}:){{7}}[0-9A-Fa-f]{{1,4}} | (?=:{{0,2}}[0-9A-Fa-f])(?:[0-9A-Fa-f]{{1,4}}(?::[0-9A-Fa-f]{{1,4}}){{0,6}})?::(?:[0-9A-Fa-f]{{1,4}}(?::[0-9A-Fa-f]{{1,4}}){{0,6}})?)(?![\w:]))
  | (?P<ipv4>(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){{3}}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?![\w]|\.\d))
  | (?P<iban>(?<!\w)[A-Z]{{2}}\d{{2}}(?:[ ]?[A-Z0-9]{{4}}){{3,7}}(?:[ ]?[A-Z0-9]{{1,3}})?(?!\w))
  | (?P<card>(?<![\w.-])(?:\d[ -]?){{12,18}}\d(?![\w-]|\.\d))
  | (?P<ssn>(?<![\w.-])\d{{3}}-\d{{2}}-\d{{4}}(?![\w-]))
  | (?P<phone>{_PHONE})
  | (?P<name>(?<!\w)(?:(?:{_ALL_TITLES})\.?[ ](?P<titled>{_NAME}(?:[ ]{_NAME}){{0,2}}) | (?P<plain>(?:{_ALL_GIVEN})(?:[ ]{_NAME}){{1,2}}))(?!\w))
    """,
    regex.X | regex.V1,
)
NAME = regex.compile(_NAME)
PHONE = regex.compile(_PHONE)
#: Spans of years and dates, which look like numbers to call.
NO_PHONE = regex.compile(r"\d{4}[ ./-]\d{4}|\d{4}[ ./-]\d{1,2}[ ./-]\d{1,2}|\d{1,2}[ ./-]\d{1,2}[ ./-]\d{4}")
INTERNATIONAL = regex.compile(r"00[1-9]\d{0,2}[ ./(-]")
#: Written as numbers to call are in North America, France, Britain and Germany.
GROUPED = regex.compile(r"(?:1[ .-])?[2-9]\d{2}[.-]\d{3}[.-]\d{4}|0\d(?:[ .]\d{2}){4}|0\d{2,4} \d{3,4} \d{4}|0\d{4} \d{6}|0\d{2,4}[/-]\d{5,8}")
CUE = regex.compile(rf"(?i)(?<!\w)(?:{CUES})[\w.]*(?:\W+\w+){{0,3}}?\W*$")
SECRET_CUE = regex.compile(rf"(?i)(?:{SECRET_CUES}|(?<!\w)key)\W*(?:\w+\W+)?$")

#: Around what an entity has, so many characters are searched, and on to the next blank.
REACH = 80
_NUMERIC = re.compile(r"[0-9@][0-9@ ().+-]*")
_KEYWORDS = ("bearer", "credential", "auth", "private", "akia", "asia", "ghp_", "gho_", "ghu_", "ghs_", "ghr_", "sk-", "xox", "glpat-", "passw", "pwd", "secret", "token", "api", "access", ":")
_SIGNS = re.compile(r"bearer|credential|auth|private[_-]?key|akia|asia|gh[pousr]_|sk-|xox|glpat-|passw|pwd|secret|token|api[_-]?key|access[_-]?key|[0-9a-f]:[0-9a-f]|[0-9a-f]::|::[0-9a-f]")
_WORDS = frozenset(form for names in GIVEN.values() for n in names for form in (n, n.upper())) | frozenset(form + dot for ts in TITLES.values() for t in ts for form in (t, t.upper()) for dot in ("", "."))
_WORD = regex.compile(r"\w", regex.V1)
#: The listed names and titles by their first run of word characters.
_BY_START: dict[str, list[str]] = {}
for _word in sorted(_WORDS):
    _BY_START.setdefault(regex.findall(r"\w+", _word)[0], []).append(_word)


class _Edges(dict):
    """Blanks for the characters at which PATTERN may begin a name, all that are not of words."""

    def __missing__(self, c: int) -> int:
        self[c] = c if _WORD.match(chr(c)) else 32
        return self[c]


_EDGES = _Edges()


def windows(text: str) -> list[tuple[int, int]]:
    """The parts of a text that can hold an entity, by cheap signs that each entity has: a digit or @, a key's mark, a listed name or title."""
    spots = [m.span() for m in _NUMERIC.finditer(text)]
    low = text.lower()
    if any(k in low for k in _KEYWORDS) and len(low) == len(text):
        spots += [m.span() for m in _SIGNS.finditer(low)]
    elif len(low) != len(text):
        return [(0, len(text))]
    for word in [w for start in _BY_START.keys() & set(text.translate(_EDGES).split(" ")) for w in _BY_START[start]]:
        at = text.find(word)
        while at >= 0:
            spots.append((at, at + len(word)))
            at = text.find(word, at + 1)
    out: list[tuple[int, int]] = []
    for a, b in sorted(spots):
        if out and b <= out[-1][1] - REACH:
            continue
        a, b = max(0, text.rfind(" ", 0, max(0, a - REACH)) + 1), text.find(" ", b + REACH)
        b = len(text) if b < 0 else b
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


class Cycle:
    """Keyed single cycles through 0..n-1, by balanced Feistel networks with cycle walking."""

    def __init__(self, key: bytes):
        self.key = key

    def _round(self, tweak: str, r: int, half: int, bits: int) -> int:
        n = (bits + 7) // 8
        mark = hmac.new(self.key, f"{tweak}|{r}|{half}|{bits}".encode(), hashlib.sha256).digest()
        while len(mark) < n:
            mark += hashlib.sha256(mark).digest()
        return int.from_bytes(mark[:n], "big") & ((1 << bits) - 1)

    def _network(self, tweak: str, n: int, x: int, back: bool) -> int:
        bits = max(1, ((n - 1).bit_length() + 1) // 2)
        while True:
            left, right = x >> bits, x & (1 << bits) - 1
            for r in range(7, -1, -1) if back else range(8):
                if back:
                    left, right = right ^ self._round(tweak, r, left, bits), left
                else:
                    left, right = right, left ^ self._round(tweak, r, right, bits)
            x = left << bits | right
            if x < n:
                return x

    def step(self, tweak: str, n: int, x: int) -> int:
        if n < 2:
            return x
        return self._network(tweak, n, (self._network(tweak, n, x, True) + 1) % n, False)

    def walk(self, tweak: str, n: int, x: int, fits: Callable[[int], bool] = lambda x: True) -> int:
        """The next place of x's own class along the cycle."""
        own, y = fits(x), self.step(tweak, n, x)
        while fits(y) != own:
            y = self.step(tweak, n, y)
        return y


def _to_number(digits: Sequence[int], radices: Sequence[int]) -> int:
    x = 0
    for d, r in zip(digits, radices, strict=True):
        x = x * r + d
    return x


def _to_digits(x: int, radices: Sequence[int]) -> list[int]:
    out = []
    for r in reversed(radices):
        x, d = divmod(x, r)
        out.append(d)
    return out[::-1]


_ALPHABETS = {"9": "0123456789", "a": "abcdefghijklmnopqrstuvwxyz", "A": "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "h": "0123456789abcdef", "H": "0123456789ABCDEF", "α": "αβγδεζηθικλμνξοπρσςτυφχψω", "б": "абвгдежзиклмнопрстуфхцчшэюя", "Б": "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ"}


#: Places of a number that are permuted together; longer values go in blocks.
BLOCK_PLACES = 64
#: Longest name that is numbered, and longest value that is remembered.
LONGEST_NAME, LONGEST_KNOWN = 64, 256
# Country calling codes of one and two digits; all others have three.
SHORT_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split())


@functools.lru_cache(maxsize=4096)
def _kin(c: str) -> str:
    """The letters or digits that c may become, c among them: those of its 256 code points and of its kind, ASCII apart. Empty if c is neither."""
    kind = unicodedata.category(c)
    if kind[0] != "L" and kind != "Nd":
        return ""
    start = ord(c) & ~0xFF
    return "".join(x for x in map(chr, range(start, start + 256)) if unicodedata.category(x) == kind and x.isascii() == c.isascii())


def _alphabet(mark: str) -> str:
    """The alphabet that a place of a shape names: one of _ALPHABETS, or the kin of a letter outside them."""
    return _ALPHABETS.get(mark) or ("" if mark.isascii() else _kin(mark))


_PLAIN = {"latin": "a", "cyrillic": "б", "greek": "α"}


def _letters(*ranges: tuple[int, int]) -> str:
    return "".join(chr(c) for a, b in ranges for c in range(a, b) if chr(c).islower()) + "'’-"


_LETTERS_OF = {"latin": _letters((0x61, 0x7B), (0xDF, 0x180)), "cyrillic": _letters((0x430, 0x460)), "greek": _letters((0x3AC, 0x3CF))}


def _script(name: str) -> str:
    return "cyrillic" if 0x400 <= ord(name[0]) < 0x530 else "greek" if 0x370 <= ord(name[0]) < 0x400 else "latin"


#: A run of word characters, or a single mark.
_RUN = regex.compile(r"\w+|\W")


class Surrogates:
    """Replaces entities. One key gives one mapping, everywhere."""

    def __init__(self, key: bytes):
        self.cycle = Cycle(key)
        self.known: dict[tuple[str, str], str] = {}

    def _spell(self, kind: str, text: str, shape: str, fits: Callable[[str], bool] = lambda s: True) -> str:
        """Changes the places of text whose shape names an alphabet, the others stay.

        Over BLOCK_PLACES places are cut into blocks, each a domain of its own that depends on all before it: whoever has the key can read the blocks one
        after another, so that different values stay different.
        """
        spots = [(i, a) for i, s in enumerate(shape) if (a := _alphabet(s)) and text[i] in a]
        if not spots:
            return text
        places = {i for i, _ in spots}
        fixed = "".join(s if i in places else c for i, (c, s) in enumerate(zip(text, shape, strict=True)))
        if len(spots) <= BLOCK_PLACES:
            return self._block(f"{kind}|{fixed}", text, spots, fits)
        out, before = list(text), hashlib.sha256(f"{kind}|{fixed}".encode())
        for k in range(0, len(spots), BLOCK_PLACES):
            part = spots[k : k + BLOCK_PLACES]
            plain = "".join(text[i] for i, _ in part)
            whole = self._block(f"{kind}|{before.hexdigest()}", plain, [(i, a) for i, (_, a) in enumerate(part)], fits if not k else lambda s: True)
            for (i, _), c in zip(part, whole, strict=True):
                out[i] = c
            before.update(plain.encode())
        return "".join(out)

    def _block(self, tweak: str, text: str, spots: Sequence[tuple[int, str]], fits: Callable[[str], bool]) -> str:
        radices = [len(a) for _, a in spots]

        def write(x: int) -> str:
            out = list(text)
            for (i, alphabet), d in zip(spots, _to_digits(x, radices), strict=True):
                out[i] = alphabet[d]
            return "".join(out)

        x = _to_number([a.index(text[i]) for i, a in spots], radices)
        return write(self.cycle.walk(tweak, math.prod(radices), x, lambda y: fits(write(y))))

    @staticmethod
    def shape(text: str) -> str:
        """The alphabet of each character, '.' for those that stay."""
        return "".join("9" if c in _ALPHABETS["9"] else "a" if c in _ALPHABETS["a"] else "A" if c in _ALPHABETS["A"] else "б" if c in _ALPHABETS["б"] else "Б" if c in _ALPHABETS["Б"] else "." for c in text)

    def every_letter(self, text: str) -> str:
        """A shape that lets no letter and no digit of any script stay, unless it has no kin."""
        return "".join(s if s != "." or c.isascii() else kin[0] if len(kin := _kin(c)) > 1 else "." for c, s in zip(text, self.shape(text), strict=True))

    def _digits(self, kind: str, text: str, keep: int = 0, last: int = 0) -> str:
        """Changes the digits of text but for the first `keep` and the last `last`, whatever stands between them."""
        at = [i for i, c in enumerate(text) if c in _ALPHABETS["9"]]
        inner = "".join(text[i] for i in at)
        body = inner[keep : len(inner) - last]
        new = self._spell(kind if kind == "phone" else f"{kind}|{inner[:keep]}", body, "9" * len(body), lambda s: s[:1] != "0")
        out = list(text)
        for i, c in zip(at[keep : len(at) - last], new, strict=True):
            out[i] = c
        return "".join(out)

    def email(self, text: str) -> str:
        low = text.lower()
        local, _, domain = low.rpartition("@")
        new = self._spell("email", local, self.every_letter(local))
        labels = domain.split(".")
        reserved = labels[-1] in ("example", "test", "invalid", "localhost") or labels[-2:-1] == ["example"]
        if not reserved:
            head = self._spell("domain", ".".join(labels[:-1]), self.every_letter(".".join(labels[:-1])))
            domain = f"{head}.{labels[-1]}.example"
        if new == local and reserved:  # nothing in it can change
            new = hmac.new(self.cycle.key, low.encode(), hashlib.sha256).hexdigest()[:16]
        return f"{new}@{domain}"

    def ipv4(self, text: str) -> str:
        x = int(ipaddress.IPv4Address(".".join(str(int(p)) for p in text.split("."))))
        return str(ipaddress.IPv4Address(self.cycle.walk("ipv4", 1 << 32, x, lambda y: ipaddress.IPv4Address(y).is_global)))

    def ipv6(self, text: str) -> str:
        low = text.lower()
        return self._spell("ipv6", low, "".join("h" if c != ":" else "." for c in low))

    def card(self, text: str) -> str:
        """The first digit, which names the brand, stays, and the check digit is as right or wrong as before."""
        digits = [int(c) for c in text if c.isdigit()]
        new = self._digits("card", text, keep=1, last=1)
        changed = [int(c) for c in new if c.isdigit()]
        check = (changed[-1] - _luhn(digits[:-1]) + _luhn(changed[:-1])) % 10
        at = max(i for i, c in enumerate(new) if c.isdigit())
        return new[:at] + str(check) + new[at + 1 :]

    def phone(self, text: str) -> str:
        """The country code stays, behind + or 00; the rest, or the last ten digits, are one number however they are written."""
        inner = "".join(c for c in text if c in _ALPHABETS["9"])
        digits, code = len(inner), 0
        if text[0] == "+" or text[:2] == "00":
            at = 0 if text[0] == "+" else 2
            code = at + next((n for n in (1, 2) if inner[at : at + n] in SHORT_CODES), 3)
        return self._digits("phone", text, keep=min(max(code, digits - 10), digits - 4) if digits > 4 else 0)

    def ssn(self, text: str) -> str:
        return self._digits("ssn", text)

    def iban(self, text: str) -> str:
        """Country stays; the account changes, and the two check digits are as right or wrong as before."""
        plain = text.replace(" ", "")
        body = self._spell("iban" + plain[:2], plain[4:], self.shape(plain[4:]))

        def check(account: str) -> int:
            return 98 - int("".join(str(int(c, 36)) for c in f"{account}{plain[:2]}00")) % 97

        off = (int(plain[2:4]) - check(plain[4:])) % 97
        number = (check(body) + off - 2) % 97 + 2
        it = iter(f"{plain[:2]}{number:02d}{body}")
        return "".join([c if c == " " else next(it) for c in text])

    def secret(self, text: str) -> str:
        m = regex.match(r"(AKIA|ASIA|gh[pousr]_|sk-|xox[abprs]-|glpat-)", text)
        head = m[0] if m else ""
        body = text[len(head) :]
        shape = "h" * len(body) if regex.fullmatch(r"[0-9a-f]+", body) else "H" * len(body) if regex.fullmatch(r"[0-9A-F]+", body) else self.shape(body)
        new = self._spell("secret" + head, body, shape)
        if new == body:  # nothing in it can change
            new = hmac.new(self.cycle.key, f"secret|{body}".encode(), hashlib.sha256).hexdigest()[: max(8, len(body))]
        return head + new

    def given(self, name: str, gender: str = "") -> str:
        """Another name of the list, or a spelled one that ends as its gender has it. The case of a name in capitals stays."""
        plain = name if name in _LISTED else name.title()
        for group, names in GIVEN.items():
            if plain in names:
                new = names[self.cycle.walk(f"given|{group}", len(names), names.index(plain))]
                break
        else:
            new = self._syllables("given", name.lower()) + GIVEN_ENDS[_script(name)][gender]
        return new.upper() if name.isupper() else new.capitalize()

    given_f = functools.partialmethod(given, gender="f")
    given_m = functools.partialmethod(given, gender="m")

    def surname(self, name: str) -> str:
        """A spelled name of the same script; a Slavic one has the ending of its gender."""
        low, script = name.lower(), _script(name)
        new = self._syllables("surname", low) + (("ова" if low[-1] in "ая" else "ов") if script == "cyrillic" else "")
        return new.upper() if name.isupper() else new.capitalize()

    def _syllables(self, kind: str, low: str) -> str:
        """Names are numbered and the number is spelled in syllables of the script, one spelling for each name.

        Names of up to 9 letters of the script's plain alphabet are numbered together. Others, of all letters of the script, are
        by length: they have as many syllables, and the first vowel is one that no plain name has. Names with letters of several scripts take a
        keyed digest's spelling, longer than all.
        """
        script = _script(low)
        consonants, vowels, marked = SYLLABLES[script]
        alphabet, every = _ALPHABETS[_PLAIN[script]], _LETTERS_OF[script]
        tweak = f"{kind}|{script}"
        if len(low) <= 9 and all(c in alphabet for c in low):
            base, n = len(consonants) * len(vowels), len(alphabet)
            first = sum(n**k for k in range(1, len(low)))  # shorter names come before
            total = sum(n**k for k in range(1, 10))
            x = self.cycle.walk(tweak, total, first + _to_number([alphabet.index(c) for c in low], [n] * len(low)))
            digits = _to_digits(x, [base] * (math.ceil(math.log(total, base)) + 1))
            while len(digits) > 2 and digits[0] == 0:  # leading zeros
                digits = digits[1:]
            return "".join(consonants[d // len(vowels)] + vowels[d % len(vowels)] for d in digits)
        spots = {c: k for k, c in enumerate(every)}
        all_vowels = marked + vowels
        size = min(len(low), LONGEST_NAME)
        radices = [len(consonants) * len(all_vowels)] * (size - 1)
        if 1 < len(low) <= LONGEST_NAME and all(c in spots for c in low):
            x = self.cycle.walk(f"{tweak}|{len(low)}", len(every) ** len(low), _to_number([spots[c] for c in low], [len(every)] * len(low)))
        else:
            radices = [len(consonants) * len(all_vowels)] * (2 * size + 23)
            digest = hmac.new(self.cycle.key, f"{tweak}|{low}".encode(), hashlib.sha256).digest()
            x = int.from_bytes(digest, "big") % (len(consonants) * len(marked) * math.prod(radices))
        head, *rest = _to_digits(x, [len(consonants) * len(marked), *radices])
        return consonants[head // len(marked)] + marked[head % len(marked)] + "".join(consonants[d // len(all_vowels)] + all_vowels[d % len(all_vowels)] for d in rest)

    def replace(self, kind: str, text: str) -> str:
        if len(text) > LONGEST_KNOWN:
            return getattr(self, kind)(text)
        at = (kind, text)
        if at not in self.known:
            if len(self.known) > 200_000:
                self.known.clear()
            self.known[at] = getattr(self, kind)(text)
        return self.known[at]

    def _accepted(self, text: str, m) -> list[tuple[str, int, int]]:
        """What a match names: type and span of each part that is replaced."""
        kind = next(k for k in _KINDS if m[k] is not None)
        if kind == "name":
            start, end = m.span("titled" if m["titled"] else "plain")
            names = list(NAME.finditer(text, start, end))
            title = text[m.start() : start].strip(" .").lower()
            gender = next((g for g, titles in TITLES.items() if title in (t.lower() for t in titles)), "")
            listed = [word[0] in _LISTED or word[0].title() in _LISTED for word in names]
            return [("given" if known else f"given_{gender}" if gender and k < len(names) - 1 else "surname", *word.span()) for k, (word, known) in enumerate(zip(names, listed, strict=True))]
        if kind == "secret":
            return [("secret", *(m.span("value") if m["value"] else m.span()))] if _is_secret(text, m) else []
        if kind == "phone" or kind == "card" and not _is_card(m[0]):
            # Numbers may follow one another: the longest that is one, up to a blank.
            call = m if kind == "phone" else PHONE.match(text, m.start())
            ends = [call.end(), *(call.start() + k for k in range(len(call[0]) - 1, 0, -1) if call[0][k] == " ")] if call else []
            return next(([("phone", call.start(), end)] for end in ends if _is_phone(text, call.start(), end)), [])
        return [(kind, *m.span())]

    def rewrite(self, text: str) -> tuple[str, list[tuple[str, str, str]]]:
        """The text with surrogates, and (type, entity, surrogate) in order."""
        out, at, found = [], 0, []

        def put(kind: str, start: int, end: int) -> None:
            nonlocal at
            new = self.replace(kind, text[start:end])
            found.append((kind[:5] if kind.startswith("given") else kind, text[start:end], new))
            out.extend((text[at:start], new))
            at = end

        for a, b in windows(text):
            while m := PATTERN.search(text, a, b):
                spans = self._accepted(text, m)
                for kind, start, end in spans:
                    put(kind, start, end)
                # What is no entity may begin before one.
                a = spans[-1][2] if spans else _RUN.match(text, m.start()).end()
        out.append(text[at:])
        return "".join(out), found


_LISTED = frozenset(n for names in GIVEN.values() for n in names)
_KINDS = ("email", "secret", "ipv6", "ipv4", "iban", "card", "ssn", "phone", "name")


def _luhn(body: Sequence[int]) -> int:
    """The check digit after these digits."""
    total = sum(d if i % 2 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(reversed(body)))
    return -total % 10


def _is_card(text: str) -> bool:
    """Whether digits begin and end as those of a card do."""
    digits = "".join(c for c in text if c.isdigit())
    return _luhn([int(c) for c in digits[:-1]]) == int(digits[-1]) and any(len(digits) in sizes and regex.match(start, digits) for start, sizes in ISSUERS)


def _is_phone(text: str, start: int, end: int) -> bool:
    """Whether digits are a number to call: by a country code, a bracketed area code, a known grouping, or a word before them that says so."""
    said = text[start:end]
    if not 7 <= sum(c.isdigit() for c in said) <= 15 or NO_PHONE.fullmatch(said):
        return False
    return said[0] in "+(" or "(" in said or bool(INTERNATIONAL.match(said)) or bool(GROUPED.fullmatch(said)) or bool(CUE.search(text[max(0, start - 40) : start]))


def _is_secret(text: str, m) -> bool:
    """Whether what looks like a key is one: a known mark, a value that is no plain word, or long hex behind a word that says so."""
    if m["value"]:
        value = m["value"]
        plain = value.strip(".()[]{}<>").lower()
        return plain not in NOT_SECRET and (not plain.isalpha() or not value[1:].islower() and not value.isupper() or "=" in m[0] and m[0].lower().startswith("p") and "= " not in m[0])
    return not regex.fullmatch(r"[0-9a-fA-F]+", m[0]) or bool(SECRET_CUE.search(text[max(0, m.start() - 40) : m.start()]))


ENTITIES = "array<struct<type:string,entity:string,surrogate:string>>"


def replace_entities(docs: DataFrame, key: bytes, text_col: str = "text", entities_out: str = "entities") -> DataFrame:
    """docs with surrogates in the text column and one more column, the entities found: type, entity, surrogate, in order.

    A null text stays null, and no text without entities changes. All other columns pass as they are; one named like
    entities_out is replaced. Rows are judged one by one: equal texts get equal surrogates, nothing is shuffled.
    The entities column holds what the text hides; drop it, or feed it to `collisions`.
    """
    kept = [c for c in docs.columns if c.lower() != entities_out.lower()]
    at = [c.lower() for c in kept].index(text_col.lower())
    kind = pa.list_(pa.struct([("type", pa.string()), ("entity", pa.string()), ("surrogate", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Surrogates(key)
        for batch in batches:
            texts, found = [], []
            for text in batch.column(at).cast(pa.string()).to_pylist():
                new, entities = make.rewrite(text) if text is not None else (None, [])
                texts.append(new)
                found.append([{"type": t, "entity": e, "surrogate": s} for t, e, s in entities])
            columns = [batch.column(k) if k != at else pa.array(texts, pa.string()) for k in range(len(kept))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, kind)], [*(f"c{k}" for k in range(len(kept))), "e"])

    read = docs.select(*[(F.col(f"`{c}`").cast("string") if k == at else F.col(f"`{c}`")).alias(f"c{k}") for k, c in enumerate(kept)])
    ddl = ", ".join(f"c{k} {f.dataType.simpleString()}" for k, f in enumerate(read.schema.fields))
    done = read.mapInArrow(run, f"{ddl}, e {ENTITIES}")
    return done.select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(kept)], F.col("e").alias(entities_out))


def collisions(replaced: DataFrame, entities: str = "entities") -> DataFrame:
    """(type, surrogate, entities) where one surrogate stands for several entities, or an entity for itself: no rows, if all is well.

    Upper and lower case of an entity count as one, but for secrets. Entities may also be given as SHA-256 digests (hex, of lower case but for secrets).
    """
    entity = F.when(F.col("e.type") == "secret", F.col("e.entity")).otherwise(F.lower("e.entity"))
    own = F.when(F.col("e.type") == "secret", F.col("e.surrogate")).otherwise(F.lower("e.surrogate"))
    each = replaced.select(F.explode(entities).alias("e")).select("e.type", entity.alias("entity"), own.alias("surrogate")).distinct()
    itself = (F.col("entity") == F.col("surrogate")) | (F.col("entity") == F.sha2("surrogate", 256))
    return each.groupBy("type", "surrogate").agg(F.count("*").alias("entities"), F.max(itself.cast("int")).alias("own")).filter("entities > 1 OR own = 1").select("type", "surrogate", "entities")
