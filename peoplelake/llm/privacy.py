"""Surrogates for personal data: keyed, of the same type and format, distinct for distinct originals.

Entities are found in whole texts by pattern, names by titles, known first names and words that introduce a person. A
surrogate comes from a keyed permutation of all strings with the same format (a Feistel network that adds in mixed radix,
turned into one cycle, so that nothing stays what it was), so equal originals get equal surrogates everywhere
(coreference), different ones never share one, and no table of originals is needed. Letters keep their script and kind
(vowel or consonant), digits stay digits, separators and the public part of numbers and domains stay. Names and e-mail
addresses are the same in any case, and a surrogate takes over the case of the place it stands at. First names that the
lists know are permuted within their gender and script. ``collisions`` checks the result over all documents.
"""

from __future__ import annotations

import functools
import hashlib
import ipaddress
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peoplelake.llm.common import written

ROUNDS = 6
#: Characters that one Feistel network takes; longer ones are chained, there and back.
BLOCK = 256
#: Longest local part of an address.
LOCAL = 64

# First names by script and gender, titles by gender, letters.
FIRST_NAMES = {
    "latin male": "James John Robert Michael William David Richard Thomas Daniel Paul Peter Hans Klaus Jürgen Stefan Pierre Jean François Carlos José Miguel Luis",
    "latin female": "Mary Anna Elizabeth Susan Sarah Karen Emma Laura Julia Maria Petra Ursula Sabine Monika Marie Claire Sophie Camille Carmen Lucía Elena Isabel",
    "cyrillic male": "Иван Алексей Дмитрий Сергей Николай Михаил Андрей Павел Олег Виктор",
    "cyrillic female": "Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана Екатерина Юлия",
}
MALE_TITLES = "Mr Herr Señor Sr Monsieur Don Господин"
FEMALE_TITLES = "Mrs Ms Miss Frau Señora Sra Madame Mme Doña Госпожа"
OTHER_TITLES = "Dr Prof Doctor Professor"
ALPHABETS = ("0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "áéíóúàèìòùâêîôûäëïöü", "ñçßšžčř", "аеиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "αεηιουω", "βγδζθκλμνξπρστφχψ")
HEX = ("0123456789abcdef",)

_NAME = r"[^\W\d_][^\W\d_'’]*[^\W\d_]"
_TITLES = {t: g for g, ts in (("male", MALE_TITLES), ("female", FEMALE_TITLES), ("", OTHER_TITLES)) for t in ts.split()}
_TITLE_OF = {t.lower(): g for t, g in _TITLES.items()}
_KNOWN = {n: group for group, names in FIRST_NAMES.items() for n in names.split()}
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_PART = re.compile(r"\w[\w.+-]*\Z")
NUMBERS = {
    "iban": re.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)"),
    "ssn": re.compile(r"(?<!\d)\d{3}-\d{2}-\d{4}(?!\d)"),
    "phone": re.compile(
        r"(?<!\w)\+?\d{0,3}[ .-]?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)|(?<!\w)\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\d)"
        r"|(?<![\w.-])\d{3}[ .-]\d{3}[ .-]\d{4}(?![\d-])"
    ),
    "ip": re.compile(rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\w|\.\d)"),
    "card": re.compile(r"(?<!\d)\d(?:[ -]?\d){12,18}(?!\d)"),
    "secret": re.compile(r"(?<!\w)[0-9a-fA-F]{32,}(?!\w)"),
}
SECRET = re.compile(r"\b(?:token|secret|password|passwd|api[_-]?key|access[_-]?key|auth)\b[\"']?\s*[:=]\s*[\"']?([A-Za-z0-9_\-/+.=]{8,})", re.I)
#: Words after which a person is named, and capitalised words that are none.
CUES = (
    "my name is", "his name is", "her name is", "name:", "named", "called", "signed by", "written by", "posted by", "sent by", "contact", "dear", "regards,",
    "sincerely,", "attn:", "author:", "patient:", "customer:", "employee:", "mein name ist", "ich heiße", "geschrieben von", "ansprechpartner:", "liebe", "lieber",
    "me llamo", "mi nombre es", "escrito por", "firmado por", "estimado", "estimada", "je m'appelle", "écrit par", "signé par", "cher", "chère",
)
NO_NAMES = frozenset(
    "The A An And Or Of In On At To For From By With This That These Those It We You They He She I Our Your Their All Sir Madam Team Customer Customers Friend Friends "
    "Support Service Services Sales Us Me Him Her Them Der Die Das Ein Eine Und Oder Mit Von Zu Kunde Kundin Herren Damen El La Los Las Un Una Y O Con De Del Señores Le Les "
    "Des Et Ou Avec Pour Monday Tuesday Wednesday Thursday Friday Saturday Sunday January February March April May June July August September October November December".split()
)
PARTICLES = frozenset("El La De Del Le Des Los Las Von Van Der Da Di Al Y".split())
_CAPITAL = "A-ZÀ-ÖØ-ÞŠŽČĆŁŚŹŻĐŐŰŞĞİА-ЯЁΑ-Ω"
BEFORE_CAPITAL = re.compile(rf"(?<![\w'’])([^\W\d_]+(?:['’][^\W\d_]+)?[,:.]?)\s(?=[{_CAPITAL}])")
NAME = re.compile(rf"{_NAME}(?: {_NAME}){{0,2}}")
_CUES_BY_END: dict[str, list[str]] = {}
for _cue in CUES:
    _CUES_BY_END.setdefault(_cue.split(" ")[-1], []).append(_cue)
DIGIT = re.compile(r"\d")


def _hash(key: bytes, *parts: bytes | str | int, below: int = 1 << 256) -> int:
    """A keyed number below a bound; parts are framed by their lengths, and numbers go as bytes whatever their size."""
    out = hashlib.shake_256(len(key).to_bytes(8, "big") + key)
    for part in parts:
        if isinstance(part, int):
            part = part.to_bytes((part.bit_length() + 7) // 8, "big")
        data = part.encode() if isinstance(part, str) else part
        out.update(len(data).to_bytes(8, "big") + data)
    return int.from_bytes(out.digest((below.bit_length() + 7) // 8 + 8), "big") % below


def _feistel(value: int, a: int, b: int, key: bytes, tweak: bytes, back: bool = False) -> int:
    """A permutation of 0 .. a * b - 1, or its inverse."""
    left, right = divmod(value, b)
    for r in reversed(range(ROUNDS)) if back else range(ROUNDS):
        if back:
            right = (right - _hash(key, tweak, r, b"r", left, below=b)) % b
            left = (left - _hash(key, tweak, r, b"l", right, below=a)) % a
        else:
            left = (left + _hash(key, tweak, r, b"l", right, below=a)) % a
            right = (right + _hash(key, tweak, r, b"r", left, below=b)) % b
    return left * b + right


def _cycle(value: int, a: int, b: int, key: bytes, tweak: bytes) -> int:
    """The next number on one keyed cycle through all of 0 .. a * b - 1: none stays where it is, and walking on visits all."""
    size = a * b
    if size == 1:
        return value
    step = _hash(key, tweak, b"step", below=size)
    while math.gcd(step, size) != 1:
        step = (step + 1) % size
    return _feistel((_feistel(value, a, b, key, tweak) + step) % size, a, b, key, tweak, back=True)


@functools.cache
def _letters(alphabets: tuple[str, ...], any_case: bool) -> dict[str, tuple[int, int, int, bool, str]]:
    """Letter to (alphabet, place in it, size of it, whether it is a capital, what it adds to the format)."""
    out = {}
    for i, a in enumerate(alphabets):
        for at, c in enumerate(a):
            if len(c.upper()) == 1 and c.upper().lower() == c:
                out[c.upper()] = (i, at, len(a), True, f"{i}l" if any_case else f"{i}u")
            out[c] = (i, at, len(a), False, f"{i}l")
    return out


def permuted(text: str, key: bytes, kind: str, alphabets: tuple[str, ...] = ALPHABETS, fixed: frozenset[int] = frozenset(), any_case: bool = False) -> str:
    """The image of ``text`` under a permutation of all texts of its format: characters of an alphabet change within it and
    keep their case; others, and those at ``fixed`` places, stay and are part of the format. With ``any_case`` texts that
    differ in case only have images that do."""
    letters = _letters(alphabets, any_case)
    found = [letters.get(c) for c in text]
    for i in fixed:
        found[i] = None
    places = [i for i, f in enumerate(found) if f is not None]
    if not places:
        return text
    plain = (lambda c: c.lower()) if any_case else (lambda c: c)
    form = [plain(c) if f is None else f[4] for c, f in zip(text, found, strict=True)]
    values, sizes = [found[i][1] for i in places], [found[i][2] for i in places]
    tweak = hashlib.blake2b("\0".join([kind, *form]).encode(), digest_size=16).digest()
    blocks = range(0, len(values), BLOCK)

    def one(low: int, chain: bytes) -> bytes:
        """Move a block on; returns what the next one is chained to."""
        before, bases = values[low : low + BLOCK], sizes[low : low + BLOCK]
        half = len(bases) // 2
        value = 0
        for v, size in zip(before, bases, strict=True):
            value = value * size + v
        value = _cycle(value, math.prod(bases[:half]), math.prod(bases[half:]), key, tweak + chain)
        after = []
        for size in reversed(bases):
            value, v = divmod(value, size)
            after.append(v)
        values[low : low + BLOCK] = after[::-1]
        return hashlib.blake2b(chain + bytes(before), digest_size=16).digest()

    # a block's image depends on all blocks before it, and on the way back on all behind it
    chain = b"there"
    for low in blocks:
        chain = one(low, chain)
    if len(blocks) > 1:
        chain = b"back"
        for low in reversed(blocks):
            chain = one(low, chain)
    out = list(text)
    for i, value in zip(places, values, strict=True):
        letter = alphabets[found[i][0]][value]
        out[i] = letter.upper() if found[i][3] and len(letter.upper()) == 1 else letter
    return "".join(out)


def _walk(text: str, step, same) -> str:
    """The first image on the way of ``step`` that is ``same`` as the text in kind: again a permutation."""
    out = step(text)
    while not same(out):
        out = step(out)
    return out


def luhn(digits: str) -> bool:
    total = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def iban_check(text: str) -> int:
    """Remainder of the account number by 97, which is 1 if its check digits are right."""
    plain = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97


def _iban(text: str, key: bytes) -> str:
    """Right numbers stay right: the account is permuted and gets its own check digits. Wrong ones are permuted among the wrong."""
    if iban_check(text) != 1:
        return _walk(text, lambda x: permuted(x, key, "iban", fixed=frozenset({0, 1})), lambda x: iban_check(x) != 1)
    new = permuted(text[:2] + "00" + text[4:], key, "iban account", fixed=frozenset(range(4)))
    return f"{new[:2]}{98 - iban_check(new):02d}{new[4:]}"


def _cased_like(text: str, like: str) -> str:
    """``text`` in the case of a word: all capitals, a capital first, or none."""
    return text.upper() if len(like) > 1 and like.isupper() else text.lower() if like.islower() else text


def _name_word(word: str, key: bytes) -> str:
    """A listed first name for a listed one of its gender and script; other names keep their last letter, which often
    tells the gender. Words that differ in case only get the same name."""
    known = word.capitalize() if word.capitalize() in _KNOWN else word
    group = _KNOWN.get(known)
    if group:
        names = sorted(FIRST_NAMES[group].split(), key=lambda n: _hash(key, "name", n))
        return _cased_like(names[(names.index(known) + 1) % len(names)], word)
    step = lambda w: permuted(w, key, "name", fixed=frozenset({len(word) - 1}), any_case=True)
    return _walk(word, step, lambda w: w.capitalize() not in _KNOWN)


def canonical(kind: str, original: str) -> str:
    """What two spellings of one entity have in common: names and addresses are the same in any case."""
    if kind == "email" or kind.startswith("name"):
        return "".join(c.lower() if len(c.lower()) == 1 else c for c in original)
    return original


@functools.lru_cache(maxsize=100_000)
def surrogate(kind: str, original: str, key: bytes) -> str:
    """The surrogate of one entity; formats that hold one string only map to themselves."""
    if kind == "email":
        local, _, domain = original.partition("@")
        host, _, top = domain.rpartition(".")
        return f"{permuted(local, key, 'local', any_case=True)}@{permuted(host, key, 'domain', any_case=True)}.{top}"
    if kind == "ip":
        inside = ipaddress.ip_address(original).is_private
        number = lambda x: int(ipaddress.ip_address(x))
        step = lambda x: str(ipaddress.ip_address(_cycle(number(x), 1 << 16, 1 << 16, key, b"ip")))
        return _walk(str(ipaddress.ip_address(original)), step, lambda x: ipaddress.ip_address(x).is_private == inside)
    if kind == "card":
        valid = luhn(re.sub(r"\D", "", original))
        return _walk(original, lambda x: permuted(x, key, "card", fixed=frozenset({0})), lambda x: luhn(re.sub(r"\D", "", x)) == valid)
    if kind == "phone":
        country = re.match(r"\+\d{1,3}(?=\D)", original)
        return permuted(original, key, "phone", fixed=frozenset(range(country.end() if country else 0)))
    if kind == "iban":
        return _iban(original, key)
    if kind == "secret" and re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", original):
        return permuted(original, key, "secret", HEX)
    if kind.startswith("name"):
        return " ".join(_name_word(w, key) for w in original.split(" "))
    return permuted(original, key, kind)


def addresses(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, "email") of every address: each @ with the local part before it, of LOCAL characters at most, and the domain."""
    at = text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        if domain:
            low = max(0, at - LOCAL)
            while low < at and not re.fullmatch(r"[\w.+-]", text[low]):
                low += 1
            before = text[low:at]
            cut = max((i for i, c in enumerate(before) if not (c.isalnum() or c in "_.+-")), default=-1)
            local = LOCAL_PART.search(before, cut + 1)
            if local:
                yield low + local.start(), domain.end(), "email"
        at = text.find("@", at + 1)


def _named(text: str, start: int) -> int:
    """Where the capitalised words from ``start`` on end, three at most; ``start`` if there are none, or a word that is no name."""
    m = NAME.match(text, start)
    words = m[0].split(" ") if m else []
    ends = lambda i, w: not w[0].isupper() or (w.capitalize() in NO_NAMES and not (0 < i < len(words) - 1 and w in PARTICLES and words[i + 1][0].isupper()))
    named = next((i for i, w in enumerate(words) if ends(i, w)), len(words))
    return start + len(" ".join(words[:named]))


def names(text: str) -> Iterator[tuple[int, int, str]]:
    """(start, end, "name" and gender) of names after a title, with a known first name, or of two words after a cue."""
    for m in BEFORE_CAPITAL.finditer(text):
        word, at = m[1], m.end()
        plain = word.rstrip(",:.").lower()
        if plain in _TITLE_OF and word[-1] not in ",:":
            if (end := _named(text, at)) > at:
                yield at, end, f"name {_TITLE_OF[plain]}".strip()
        elif word.capitalize() in _KNOWN and word[0].isupper():
            last = NAME.match(text, at)
            if last and text[m.end(1)] == " ":
                yield m.start(), at + len(last[0].split(" ")[0]), f"name {_KNOWN[word.capitalize()].split()[1]}"
        for cue in _CUES_BY_END.get(word.lower(), ()):
            begin = m.end(1) - len(cue)
            if begin >= 0 and text[begin : m.end(1)].lower() == cue and not text[begin - 1 : begin].isalnum() and " " in text[at : (end := _named(text, at))]:
                yield at, end, "name"


def entities(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of what a text holds, in its order and without overlap: the earlier, then the longer, wins."""
    found = []
    found += addresses(text)
    if DIGIT.search(text):
        for kind, pattern in NUMBERS.items():
            for m in pattern.finditer(text):
                if kind != "phone" or sum(c.isdigit() for c in m[0]) >= 7:
                    found.append((m.start(), m.end(), kind))
    if "=" in text or ":" in text:
        found += [(m.start(1), m.end(1), "secret") for m in SECRET.finditer(text)]
    found += names(text)
    found.sort(key=lambda f: (f[0], -f[1], f[2]))
    out, last = [], 0
    for f in found:
        if f[0] >= last:
            out.append(f)
            last = f[1]
    return out


def replaced(text: str, key: bytes) -> tuple[str, list[dict]]:
    """The text with surrogates, and kind, place in the original, digest of the original and surrogate of every entity."""
    parts, spans, last = [], [], 0
    for start, end, kind in entities(text):
        original = text[start:end]
        new = surrogate(kind, original, key)
        digest = hashlib.blake2b(canonical(kind, original).encode(), key=key[:64], digest_size=16).hexdigest()
        parts += [text[last:start], new]
        spans.append({"kind": kind, "start": start, "end": end, "original": digest, "surrogate": new})
        last = end
    return "".join([*parts, text[last:]]), spans


SPANS = "array<struct<kind: string, start: long, end: long, original: string, surrogate: string>>"


def with_surrogates(docs: DataFrame, key: bytes) -> DataFrame:
    """doc_id, text with surrogates, n_entities and entities of every document.

    A null text stays null and has none. Originals are named by a keyed digest only. Rows that repeat get the same
    result; other columns are left out. Distinct surrogates of distinct originals are checked over all documents. Whoever
    has the key can undo every surrogate, so it is the caller's to choose and to keep (up to 64 bytes count).
    """
    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("original", pa.string()), ("surrogate", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                rows = [(None, []) if t is None else replaced(t, key) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([r[0] for r in rows], pa.string()), pa.array([len(r[1]) for r in rows], pa.int32()), pa.array([r[1] for r in rows], spans)],
                    names=["doc_id", "text", "n_entities", "entities"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"doc_id long, text string, n_entities int, entities {SPANS}")
    rows = written(rows, "surrogates")
    clash = collisions(rows).limit(5).collect()
    if clash:
        raise ValueError(f"surrogates that stand for several originals: {[tuple(c) for c in clash]}")
    return rows


def collisions(rows: DataFrame) -> DataFrame:
    """(kind, surrogate) that stand for more than one original; a partial step keeps one row per task and surrogate."""
    every = rows.select(F.explode("entities").alias("e")).select("e.*").withColumn("kind", F.split("kind", " ")[0])
    every = every.groupBy("kind", "surrogate").agg(F.min("original").alias("a"), F.max("original").alias("b"))
    return every.filter("a <> b").select("kind", "surrogate")
