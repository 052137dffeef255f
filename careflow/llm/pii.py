"""Personal data replaced by surrogates (operator 9).

Detected entities receive replacements of the same kind and format: a valid
address for an address, a card number of the same brand with a right check
digit, a name of the same gender and script.  A surrogate is a keyed function
of the kind and the canonical form, so one entity has one surrogate wherever
and however it is written (coreference).  A name is one that follows a title
somewhere in the text; its capitalised words are replaced in the whole text.

Distinctness is checked over the whole corpus: all distinct entities get their
first surrogate; where two have the same one, or a surrogate is itself a real
entity, all but the first entity move to their next surrogate, until no two
meet.  Every text is searched once and gets the first surrogates at once; only
texts that mention an entity which moved are replaced again.
"""

from __future__ import annotations

import hashlib
import ipaddress
import re
import secrets
import unicodedata
from bisect import bisect
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from careflow.llm.common import materialise

# --- fixed values: issuer prefixes by length, titles by gender, name parts by script ---
CARD_PREFIXES = {13: r"4", 14: r"3(?:6|8|0[0-5])", 15: r"3[47]", 19: r"4",
                 16: r"4|5[1-5]|2(?:22[1-9]|2[3-9]|[3-6]|7[01]|720)|6(?:011|5|4[4-9])|35(?:2[89]|[3-8])"}
LEAST_IBAN = 12
TITLES = {"m": ["Mr", "Mister", "Sir", "Herr", "Monsieur", "Señor", "Don", "г-н", "господин", "κύριος"],
          "f": ["Mrs", "Ms", "Miss", "Madam", "Frau", "Madame", "Mademoiselle", "Mme", "Señora", "Señorita",
                "Doña", "г-жа", "госпожа", "κυρία"]}
DEGREES = ["Dr", "Prof", "Professor", "Doktor", "Doctor", "Docteur"]
PARTICLES = ["von", "vom", "zu", "zum", "zur", "der", "den", "dem", "van", "de", "del", "della", "di", "da", "do", "dos", "das",
             "du", "des", "la", "le", "las", "los", "y", "e", "af", "av", "ter", "ten", "bin", "ibn", "al", "el"]
#: Particles that are articles too, so open no name right after a title.
ARTICLES = ["der", "den", "dem", "das", "la", "le", "las", "los", "el", "al", "du", "des", "y", "e"]
PHONE_CUES = ["tel", "tél", "telefon", "telephone", "teléfono", "téléphone", "phone", "fax", "call", "mobile", "mobil", "móvil",
              "portable", "handy", "cell", "rufnummer", "whatsapp"]
SYLLABLES = {"LATIN": ["ba", "den", "fi", "gor", "hal", "ki", "lo", "mar", "nel", "ro", "sen", "ta", "ver", "wi"],
             "CYRILLIC": ["ба", "ден", "фи", "гор", "ка", "ли", "мар", "нел", "ро", "сен", "та", "вер"],
             "GREEK": ["βα", "δεν", "φι", "γορ", "κα", "λι", "μαρ", "νελ", "ρο", "σεν", "τα"]}
GIVEN_ENDS = {"LATIN": {"m": ["don", "ric", "bert"], "f": ["na", "lia", "ra"]},
              "CYRILLIC": {"m": ["мир", "слав"], "f": ["на", "лия"]}, "GREEK": {"m": ["νος", "ρος"], "f": ["να", "λια"]}}
ALPHABETS = {"LATIN": "abcdefghijklmnopqrstuvwxyz", "CYRILLIC": "абвгдежзиклмнопрстуфхцчшэюя",
             "GREEK": "αβγδεζηθικλμνξοπρστυφχψω"}
# --- end of fixed values ---

_TITLE_GENDER = {t.casefold(): g for g, ts in TITLES.items() for t in ts}
_TITLE = "|".join(sorted(_TITLE_GENDER, key=len, reverse=True))
_KEYWORD = r"\b(?:token|secret|password|passwd|pwd|passwort|api[_-]?key|access[_-]?key)\b"
_CUE = "|".join(sorted(map(re.escape, PHONE_CUES), key=len, reverse=True))
_WORD = r"[^\W\d_]+(?:['’-][^\W\d_]+)*"

_PATTERNS: list[tuple[str, re.Pattern]] = [
    ("secret", re.compile(r"(?<!\w)(?P<v>AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,})(?!\w)")),
    ("email", re.compile(r"(?<![\w.+%-])(?P<v>\w[\w.+%-]*@(?:[\w-]+\.)+[^\W\d_]{2,})")),
    ("iban", re.compile(r"(?<!\w)(?P<v>[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?!\w)")),
    ("ipv6", re.compile(r"(?<![\w:])(?P<v>(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4})(?![\w:]|\.\d)")),
    ("mac", re.compile(r"(?<![\w:-])(?P<v>(?:[0-9A-Fa-f]{2}[:-]){5}[0-9A-Fa-f]{2})(?![\w:-])")),
    ("ip", re.compile(r"(?<![\w.])(?P<v>(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d))(?!\w|\.\d)")),
    ("ssn", re.compile(r"(?<![\w-])(?P<v>\d{3}-\d{2}-\d{4})(?![\w-])")),
    ("phone", re.compile(r"(?<![\w.])(?P<v>\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4})(?!\w)")),
    ("phone", re.compile(r"(?<![\w.])(?P<v>(?:\(\d{3}\) ?|\d{3}[-.])\d{3}[-.]\d{4})(?!\w)")),
    # national numbers: five pairs, an area code and the rest, or any number after a word that announces one
    ("phone", re.compile(r"(?<![\w.,+-])(?P<v>0[1-9](?P<sep>[ .-])\d\d(?:(?P=sep)\d\d){3})(?!\w|[.,-]\d)")),
    ("phone", re.compile(r"(?<![\w.,+-])(?P<v>0[1-9]\d{1,3}[ /-]\d{5,8})(?!\w|[.,-]\d)")),
]
#: A secret's sign and value, and the word before the sign; a number, and the word that announces it.
_SIGN = re.compile("[=:]")
_VALUE = re.compile(r"\s*(?:(?P<quote>[\"'])(?P<q>[^\"'\n]+)(?P=quote)|(?P<v>[^\s\"'<>,;()\[\]{}]+))")
_BEFORE_SIGN = re.compile(rf"(?P<line>(?:\A|\n)[ \t]*)?(?i:{_KEYWORD})[\"']?\s*\Z")
_NUMBER = re.compile(r"(?<![\w.,])(?P<v>\(?\d{2,5}\)?(?:[ ./-]?\d{2,8}){1,5})(?!\w)")
_BEFORE_NUMBER = re.compile(rf"(?<!\w)(?i:{_CUE})\.?(?:\s?(?:[:=]|no\.?|nr\.?|n°))?\s?\Z")
_FIGURES = re.compile(r"\d+(?:[ -]\d+)*")
_TITLED = re.compile(rf"(?<!\w)(?P<title>(?i:{_TITLE}))\.? (?:(?:{'|'.join(DEGREES)})\.? )*(?=[^\W\d_])")
_NAME_PART = re.compile(_WORD)

_PARTICLE = set(PARTICLES)

#: What a text must hold to be looked at: a digit, an at sign, a word for a secret
#: with its sign, or a title.
WORTH_A_LOOK = (rf"[0-9@]|(?i:{_KEYWORD})[\"']?\s*[=:]"
                rf"|(?iu:(?<![\p{{L}}\p{{N}}_])(?:{_TITLE})\.? \p{{L}})")


def luhn_digit(digits: str) -> int:
    """The check digit that follows ``digits``."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 else d * 2 - 9 * (d > 4)
    return -total % 10


def _is_card(digits: str) -> bool:
    prefix = CARD_PREFIXES.get(len(digits))
    return bool(prefix and re.match(prefix, digits)) and luhn_digit(digits[:-1]) == int(digits[-1])


def _cards(text: str) -> Iterator[tuple[int, int, str, str]]:
    """Card numbers in runs of figures.  A run may hold more than the number (a date, a
    check code, a room): all spans of whole groups are tried, the longest first."""
    for run in _FIGURES.finditer(text):
        if run.end() - run.start() < min(CARD_PREFIXES):
            continue
        groups = [(run.start() + m.start(), run.start() + m.end()) for m in re.finditer(r"\d+", run[0])]
        spans = []
        for i, (a, _) in enumerate(groups):
            if re.match(r"[\w.]", text[a - 1:a]):
                continue
            digits = ""
            for c, b in groups[i:]:
                digits += text[c:b]
                if len(digits) > max(CARD_PREFIXES):
                    break
                if _is_card(digits) and not re.match(r"\w", text[b:b + 1]):
                    spans.append((-len(digits), a, b, digits))
        taken: list[tuple[int, int]] = []
        for _, a, b, digits in sorted(spans):
            if all(b <= x or a >= y for x, y in taken):
                taken.append((a, b))
                yield a, b, "card", digits


def _ibans(text: str, pattern: re.Pattern) -> Iterator[tuple[int, int, str, str]]:
    """Account numbers.  A match may hold words that follow the number: it is cut at
    spaces, the longest span first, and the search goes on after what was accepted."""
    at = 0
    while m := pattern.search(text, at):
        a, b = m.span("v")
        at = a + 1
        while b > a:
            plain = text[a:b].replace(" ", "")
            if len(plain) >= LEAST_IBAN and _iban_number(plain) % 97 == 1:
                yield a, b, "iban", plain
                at = b
                break
            b = max(a, text.rfind(" ", a, b))


def _iban_number(s: str) -> int:
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4]))


def _secrets(text: str) -> Iterator[tuple[int, int, str, str]]:
    """Values after a word for a secret.  After ``=`` and in quotes every value counts,
    after a colon one that is no word of a sentence: it has a figure, a sign or a
    capital inside, or it has eight letters or more and its line holds nothing else
    than the word for the secret and it."""
    for sign in _SIGN.finditer(text):
        word = _BEFORE_SIGN.search(text[max(0, sign.start() - 24):sign.start()])
        m = word and _VALUE.match(text, sign.end())
        if not m:
            continue
        if m["q"]:
            yield *m.span("q"), "secret", m["q"]
            continue
        value = m["v"].rstrip(".!?:-")
        a = m.start("v")
        if value and sign[0] == ":" and value.isalpha() and value[1:] == value[1:].lower():
            rest = text[a + len(value):].partition("\n")[0]
            starts_line = word["line"] is not None and (word["line"].startswith("\n") or sign.start() <= 24)
            if len(value) < 8 or rest.strip(" \t\r.!?") or not starts_line:
                continue
        if value:
            yield a, a + len(value), "secret", value


def _announced(text: str) -> Iterator[tuple[int, int, str, str]]:
    """Numbers of 7 to 15 figures after a word that announces a phone number."""
    for m in _NUMBER.finditer(text):
        digits = re.sub(r"\D", "", m["v"])
        if 7 <= len(digits) <= 15 and _BEFORE_NUMBER.search(text[max(0, m.start() - 24):m.start()]):
            yield *m.span("v"), "phone", digits


def _ipv6(written: str) -> str | None:
    """The compressed form of an address; None if it is none, or has no figure (as
    names joined by two colons have)."""
    if "::" in written and not re.search("[0-9]", written):
        return None
    try:
        return ipaddress.IPv6Address(written).compressed if written.strip(":") else None
    except ValueError:
        return None


def _script(text: str) -> str:
    for c in text:
        name = unicodedata.name(c, "")
        for script in ALPHABETS:
            if name.startswith(script):
                return script
    return "LATIN"


def _after_particles(text: str, at: int, opens: bool) -> int:
    """The place after particles such as ``von der``, if a capitalised word follows
    them; else ``at``.  ``opens``: a title stands before them."""
    end = at
    if opens and (w := _NAME_PART.match(text, at)) and w[0] in ARTICLES:
        return at
    while (w := _NAME_PART.match(text, end)) and w[0] in _PARTICLE and text[w.end():w.end() + 1] == " ":
        end = w.end() + 1
    return end if end > at and (w := _NAME_PART.match(text, end)) and w[0][0].isupper() else at


def _names(text: str) -> list[tuple[int, int, str, str]]:
    """Names, word by word.  After a title stands a name: the whole run of capitalised
    words, initials with their dots and particles among them (particles stay), to the
    next title.  Its last word is the family name, those before it given names.  Every other capitalised mention of
    such a word in the text, before or after, is the same name; initials are names
    only within a run."""
    titled: list[tuple[int, int, str, str]] = []
    alone: dict[int, str] = {}  # gender of names of one word, by place in titled
    for m in _TITLED.finditer(text):
        at, words = m.end(), []
        while True:
            at = _after_particles(text, at, not words)
            w = _NAME_PART.match(text, at)
            if not w or not w[0][0].isupper() or w[0].casefold() in _TITLE_GENDER:
                break
            word = re.sub(r"['’][sS]$", "", w[0])
            words.append((at, at + len(word), word))
            at = w.end()
            if word == w[0] and len(word) == 1 and text[at:at + 1] == ".":
                at += 1
            elif word != w[0] or text[at:at + 1] != " ":
                break
            at += text[at:at + 1] == " "
        gender = _TITLE_GENDER[m["title"].casefold()]
        if len(words) == 1:
            alone[len(titled)] = gender
        for i, (a, b, word) in enumerate(words):
            kind = f"family {_script(word)}" if i == len(words) - 1 else f"given {gender} {_script(word)}"
            titled.append((a, b, kind, word.casefold()))
    if not titled:
        return []
    known = {x[2:] for i, x in enumerate(titled) if i not in alone}
    for i, gender in alone.items():  # 'Sir Arthur' is the Arthur of 'Sir Arthur Doyle'
        a, b, kind, word = titled[i]
        given = f"given {gender} {kind.split()[1]}"
        if (kind, word) not in known and (given, word) in known:
            titled[i] = a, b, given, word
    kinds: dict[str, str] = {}
    forms = set()  # a folded ß is no ß any more
    for a, b, kind, word in titled:
        if b - a > 1:
            kinds.setdefault(word, kind)
            forms |= {word, text[a:b]}
    if not kinds:
        return titled
    parts = "|".join(re.escape(w) for w in sorted(forms, key=lambda w: (-len(w), w)))
    again = [(m.start(), m.end(), kinds[m[0].casefold()], m[0].casefold())
             for m in re.finditer(rf"(?<!\w)(?:{parts})(?!\w)", text, re.I)
             if m[0][0].isupper() and m[0].casefold() in kinds]
    return titled + again


def find(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical form) of the entities of a text, in order,
    without overlap."""
    found: list[tuple[int, int, str, str]] = []
    found.extend(_secrets(text))
    if re.search("[0-9]", text) or "@" in text:
        for kind, pattern in _PATTERNS:
            if (kind == "email" and "@" not in text) or (kind == "ipv6" and text.count(":") < 2):
                continue
            if kind == "iban":
                found.extend(_ibans(text, pattern))
                continue
            for m in pattern.finditer(text):
                a, b = m.span("v")
                value = m["v"]
                if kind == "secret":
                    found.append((a, b, kind, value))
                elif kind == "phone":
                    while len(digits := re.sub(r"\D", "", value)) > 15 and (cut := re.search(r"[ .-]\d+$", value)):
                        value = value[:cut.start()]  # figures that follow the number
                    if 7 <= len(digits) <= 15:
                        found.append((a, a + len(value), kind, digits))
                elif kind == "ipv6":
                    if address := _ipv6(value):
                        found.append((a, b, kind, address))
                else:
                    found.append((a, b, kind, value.lower()))
        found.extend(_announced(text))
        found.extend(_cards(text))
    found.extend(_names(text))
    out: list[tuple[int, int, str, str]] = []
    taken: list[tuple[int, int]] = []  # the order of the patterns decides overlaps
    for x in found:
        i = bisect(taken, (x[0], x[1]))
        if (not i or taken[i - 1][1] <= x[0]) and (i == len(taken) or taken[i][0] >= x[1]):
            taken.insert(i, x[:2])
            out.append(x)
    return sorted(out)


class _Draw:
    """Numbers from a keyed hash of kind, canonical form and attempt."""

    def __init__(self, secret: bytes, kind: str, canonical: str, attempt: int):
        self.seed = f"{kind}\0{attempt}\0{canonical}".encode()
        self.secret, self.block, self.pool = secret, 0, 0
        self.left = 0

    def below(self, n: int) -> int:
        if self.left < 8:
            digest = hashlib.blake2b(self.seed + self.block.to_bytes(4, "big"), key=self.secret, digest_size=64).digest()
            self.pool, self.left, self.block = int.from_bytes(digest, "big"), 64, self.block + 1
        value, self.left = self.pool & (2**64 - 1), self.left - 8
        self.pool >>= 64
        return value % n

    def alike(self, c: str) -> str:
        """A character of the same class and script."""
        if c.isdigit():
            return str(self.below(10))
        if c.isalpha():
            letters = ALPHABETS[_script(c)]
            new = letters[self.below(len(letters))]
            return new.upper() if c.isupper() else new
        return c


def surrogate(secret: bytes, kind: str, canonical: str, attempt: int = 0) -> str:
    """The replacement of a canonical form, itself in canonical form.

    Later attempts have a wider format, so there is always another surrogate,
    however many entities of a narrow format the corpus holds."""
    draw = _Draw(secret, kind, canonical, attempt)
    wider = attempt // 4
    more = "".join(str(draw.below(10)) for _ in range(wider))
    if kind == "card":
        if wider:  # the longest numbers
            canonical = "4" * 19
        body = canonical[:2] if canonical[0] in "356" else canonical[0]
        keep = next(p for p in (4, 3, 2, 1) if re.match(CARD_PREFIXES[len(canonical)], canonical[:p]))
        body = canonical[:max(keep, len(body))]
        body += "".join(str(draw.below(10)) for _ in range(len(canonical) - 1 - len(body)))
        return body + str(luhn_digit(body))
    if kind == "ip":
        if wider > 3:  # a corpus that fills the short addresses
            return ":".join("%x" % draw.below(2**16) for _ in range(8))
        span = {1: (1, 9), 2: (10, 90), 3: (100, 156), 4: (1, 255)}  # 4: any octet
        return ".".join(str(span[n][0] + draw.below(span[n][1])) for n in (
            len(o) + wider if wider < 2 else 4 for o in canonical.split(".")))
    if kind == "ipv6":  # no leading zeros, so that the form is the canonical one
        if wider > 3:
            canonical = ":".join(["ffff"] * 8)
        return re.sub("[0-9a-f]+", lambda g: "%x" % (16 ** (len(g[0]) - 1) + draw.below(15 * 16 ** (len(g[0]) - 1))), canonical)
    if kind == "mac":
        return "".join("0123456789abcdef"[draw.below(16)] if c.isalnum() else c for c in canonical)
    if kind == "phone":
        return (canonical[0] + "".join(str(draw.below(10)) for _ in canonical[1:]) + more)[:max(15, len(canonical))]
    if kind == "iban":
        body = canonical[:2] + "00" + "".join(draw.alike(c) for c in canonical[4:]) + more
        return f"{body[:2]}{98 - _iban_number(body) % 97:02d}{body[4:]}"
    if kind == "secret":
        if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", canonical):
            figures = "0123456789ABCDEF" if re.search("[A-F]", canonical) else "0123456789abcdef"
            return "".join(figures[draw.below(16)] for _ in canonical) + more
        return "".join(draw.alike(c) for c in canonical) + more
    if kind == "email":
        local, _, domain = canonical.rpartition("@")
        labels = domain.split(".")
        mask = lambda s: "".join(draw.alike(c) for c in s)
        # the top level stays, and the domains that are reserved for examples
        kept = 2 if len(labels) > 2 and labels[-2] == "example" and labels[-1] in ("com", "net", "org") else 1
        return mask(local) + more + "@" + ".".join([*map(mask, labels[:-kept]), *labels[-kept:]])
    if kind.startswith(("family", "given")):
        script = kind.split()[-1]
        parts = SYLLABLES[script]
        name = "".join(parts[draw.below(len(parts))] for _ in range(2 + wider))
        ends = GIVEN_ENDS[script][kind.split()[1]] if kind.startswith("given") else parts
        return name + ends[draw.below(len(ends))]
    return "".join(draw.alike(c) for c in canonical) + more  # national numbers and the like


def _written_like(mention: str, kind: str, new: str) -> str:
    """The surrogate in the mention's format: punctuation, spacing and case."""
    if kind in ("card", "phone", "iban"):
        rest = iter(new)
        return "".join(next(rest) if c.isalnum() else c for c in mention) + "".join(rest)
    if kind.startswith(("family", "given")):
        if mention.isupper() and len(mention) > 1:
            return new.upper()
        return new[:1].upper() + new[1:]
    if kind == "secret":
        return new
    if mention.isupper():
        return new.upper()
    return "".join(n.upper() if m.isupper() else n for m, n in zip(mention, new, strict=True)) \
        if len(mention) == len(new) else new


def replace(text: str, secret: bytes, attempts: dict[tuple[str, str], int] | None = None) -> tuple[str, int]:
    """The text with all entities replaced, and how many mentions there were."""
    new, found = replaced(text, secret, attempts)
    return new, len(found)


def replaced(text: str, secret: bytes, attempts: dict[tuple[str, str], int] | None = None) -> tuple[str, list]:
    """The text with all entities replaced, and their mentions (as of ``find``)."""
    found = find(text)
    parts, at = [], 0
    for a, b, kind, canonical in found:
        new = surrogate(secret, kind, canonical, (attempts or {}).get((kind, canonical), 0))
        parts += [text[at:a], _written_like(text[a:b], kind, new)]
        at = b
    return "".join([*parts, text[at:]]), found


def _worth(text: str) -> Column:
    return F.col(text).rlike(WORTH_A_LOOK)


#: Spark setting that holds the secret of the surrogates.
SECRET_SETTING = "spark.careflow.pii.secret"
_DRAWN: dict[str, str] = {}    # application -> secret


def session_secret(spark: SparkSession) -> str:
    """The secret from the Spark configuration.  Without that setting one is drawn
    for this application: its surrogates agree with each other and cannot be
    computed by anyone else, nor again by a later run."""
    return spark.conf.get(SECRET_SETTING, None) or _DRAWN.setdefault(spark.sparkContext.applicationId, secrets.token_hex(32))


def _surrogates(entities: DataFrame, secret: bytes) -> DataFrame:
    """Add the surrogate of each entity's present attempt."""

    @F.pandas_udf("string")
    def make(kind: pd.Series, canonical: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([surrogate(secret, k, c, a) for k, c, a in
                          zip(kind.tolist(), canonical.tolist(), attempt.tolist(), strict=True)], dtype=object)

    return entities.withColumn("surrogate", make("kind", "canonical", "attempt"))


def moved_entities(entities: DataFrame, secret: bytes,
                   make: Callable[[DataFrame, bytes], DataFrame] = _surrogates) -> DataFrame:
    """(kind, canonical, attempt) of the entities whose first surrogate was
    another's, or a real entity.  ``entities``: distinct (kind, canonical)."""
    current = entities.withColumn("attempt", F.lit(0))
    while True:
        drawn = materialise(make(current, secret), "surrogates")
        # of entities with one surrogate, the one with fewest attempts keeps it, then the smallest
        first = drawn.groupBy("kind", "surrogate").agg(F.min(F.struct("attempt", "canonical")).alias("first"))
        real = entities.select("kind", F.col("canonical").alias("surrogate"), F.lit(True).alias("real"))
        checked = materialise(
            drawn.join(first, ["kind", "surrogate"]).join(real, ["kind", "surrogate"], "left")
            .select("kind", "canonical", "attempt",
                    (F.coalesce("real", F.lit(False)) | (F.col("first.canonical") != F.col("canonical"))).alias("move")),
            "checked")
        if not checked.filter("move").count():
            return checked.filter("attempt > 0").select("kind", "canonical", "attempt")
        current = checked.select("kind", "canonical", (F.col("attempt") + F.col("move").cast("int")).alias("attempt"))


def with_surrogates(docs: DataFrame, secret: str, key: str = "doc_id", text: str = "text",
                    count: str | None = None) -> DataFrame:
    """The rows of ``docs`` with personal data in the text replaced.

    All columns and rows stay, repeated ones too; null and empty texts stay as
    they are, and null keys make no difference.  ``count`` names a further
    column for the number of replaced mentions (0 for null texts).  The secret
    keys the surrogates: the same secret gives the same surrogates."""
    keyed = hashlib.blake2b(secret.encode(), digest_size=32).digest()
    others = [c for c in docs.columns if c != text]

    @F.pandas_udf("text string, n int, entities array<struct<kind: string, canonical: string>>")
    def first_try(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows: list[tuple] = []
            for t in texts.tolist():
                new, found = replaced(t, keyed) if t else (t, [])
                entities = [{"kind": k, "canonical": c} for k, c in dict.fromkeys(x[2:] for x in found)]
                rows.append((new if found else None, len(found), entities or None))
            yield pd.DataFrame(rows, columns=["text", "n", "entities"]).astype({"n": "int32", "text": object, "entities": object})

    @F.pandas_udf("string")
    def again(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, moves in batches:
            yield pd.Series([None if t is None else replace(t, keyed, {(m["kind"], m["canonical"]): m["attempt"] for m in move})[0]
                             for t, move in zip(texts.tolist(), moves.tolist(), strict=True)], dtype=object)

    own = F.struct(*others) if others else F.lit(0)
    tried = materialise(docs.select(own.alias("own"), F.col(text).alias("text"),
                                    first_try(F.when(_worth(text), F.col(text))).alias("first"))
                        .select("own", "text", "first.n", "first.entities", F.col("first.text").alias("new"),
                                F.monotonically_increasing_id().alias("row")), "tried")
    mentioned = tried.filter("entities is not null").select("row", F.inline("entities"))
    entities = materialise(mentioned.select("kind", "canonical").distinct(), "entities")
    moved = moved_entities(entities, keyed)
    # what a row has to know: the attempts of moved entities that it mentions
    told = materialise(mentioned.join(moved, ["kind", "canonical"]).groupBy("row")
                       .agg(F.collect_list(F.struct("kind", "canonical", "attempt")).alias("moved")), "told")
    done = tried.join(told, "row", "left")
    redone = again(F.when(F.col("moved").isNotNull(), F.col("text")), F.col("moved"))
    result = {c: F.col("own").getField(c) for c in others} | {text: F.coalesce(redone, "new", "text")}
    if count:
        result[count] = F.coalesce("n", F.lit(0))
    order = [*docs.columns, *([count] if count and count not in docs.columns else [])]
    return done.select(*(result[c].alias(c) for c in order))
