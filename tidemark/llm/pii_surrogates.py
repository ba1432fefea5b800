"""PII surrogates (2): detected entities get keyed, type-consistent replacements.

Entities: e-mail addresses, phone numbers, payment card numbers (Luhn), IPv4 and IPv6 addresses, IBANs (mod 97), US social security
numbers, and persons named after a courtesy title (before a Chinese one); other national numbers are not known here. The full names and
surnames of a document's titled persons are entities wherever they stand in it. A card is
also found among neighbouring numbers (a CVV, an expiry), at the ends of its digit groups. Phones are grouped forms with
an area code, a trunk prefix ``1`` or ``0``, or an international ``+`` form, in groups or not. The normalised entity (letter case, separators and titles aside) is the unit of
coreference: one entity has one surrogate in the whole corpus, and different entities of a type
have different surrogates.

* Digits are replaced by a keyed Feistel permutation of the digit strings of their length, so different
  numbers can't collide; grouping, separators and the country code stay, a card keeps its issuer digit and passes Luhn, the
  octets of an address stay within 0-255, an IBAN keeps country and letters and gets valid check digits. E-mail local parts keep their shape (letters, digits, marks); their domains go to ``example.*``.
* A person's given name comes from a list of the person's gender and the name's script, family names are built from
  syllables of that script, in the letter case of the original. Each family name has one surrogate in the corpus, so "Ms Doe", "Jane Doe" and "Doe"
  agree; the first name is keyed on the whole name, without its title. The gender is settled per name over the corpus: a title that tells it
  wins over one that doesn't, two that differ leave it open. Each attempt is keyed.
* Collision check: surrogates are grouped over the corpus (map-side first). An entity whose surrogate is also
  another entity's, or is itself an entity of the corpus, takes the next attempt; the least entity stays. Each attempt draws names and
  mail hosts from a space 256 and 100 times as large, so a few rounds leave no collision at any corpus size, and distinctness and coreference
  hold exactly; an error is raised if ``MAX_ATTEMPTS`` don't do (numbers of a length, nearly all of which occur).

Defined results: in scripts without case up to two words after a title count as the name, in Chinese up to four characters that stand
between a break and the title (none if there are more); a person's first name alone, initials and names
that no title introduces in the document are not found; a null text stays null, an empty text stays empty, both with no entities; repeated rows get equal replacements; an
empty table gives an empty result; a null key is refused; other columns are carried, whatever their names.

Plan: one pass finds the distinct entities (reduced in each slice and map-side); only entities, never texts, are
shuffled for the collision check; entities that needed a later attempt are few and reach their documents by a join on the
document, the others are computed in place.
"""

from __future__ import annotations

import bisect
import hashlib
import hmac
import ipaddress
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import boxed, mapped, ship, stage, unboxed

ship(__name__)

#: Courtesy titles and the gender they tell (m, f, or x for either).
TITLES = {"Mr": "m", "Mister": "m", "Sir": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Madam": "f", "Dr": "x", "Prof": "x",
          "Herr": "m", "Frau": "f", "Señor": "m", "Señora": "f", "Señorita": "f", "Monsieur": "m", "Madame": "f", "Mademoiselle": "f",
          "Господин": "m", "Госпожа": "f", "Κύριος": "m", "Κυρία": "f",
          "السيد": "m", "السيدة": "f", "الدكتور": "m", "الدكتورة": "f", "מר": "m", "גברת": "f", "श्री": "m", "श्रीमती": "f"}
#: Chinese titles, which follow the name.
SUFFIXES = {"先生": "m", "女士": "f", "小姐": "f", "太太": "f"}
#: Given names by script and gender.
GIVEN = {("latin", "m"): "Adrian Bruno Cedric Daniel Emil Felix Gregor Hugo Ivan Julian".split(),
         ("latin", "f"): "Alice Bianca Clara Diana Elena Flora Greta Helena Irene Julia".split(),
         ("cyrillic", "m"): "Антон Борис Виктор Глеб Денис".split(), ("cyrillic", "f"): "Анна Вера Дарья Елена Ирина".split(),
         ("greek", "m"): "Αντώνης Γιώργος Δημήτρης Νίκος Πέτρος".split(), ("greek", "f"): "Άννα Βασιλική Ελένη Μαρία Σοφία".split(),
         ("arabic", "m"): "أحمد خالد سامي عمر يوسف".split(), ("arabic", "f"): "أمل سارة ليلى مريم هدى".split(),
         ("hebrew", "m"): "אברהם דוד יוסף משה שמואל".split(), ("hebrew", "f"): "אסתר דינה לאה מרים רבקה".split(),
         ("devanagari", "m"): "अजय करण मोहन राजन विजय".split(), ("devanagari", "f"): "अनिता कविता गीता मीरा सीता".split(),
         ("han", "m"): "伟 强 军 勇 杰".split(), ("han", "f"): "芳 娜 敏 静 丽".split()}
#: Syllables of family names by script.
SYLLABLES = {"latin": "ba den for gal hin kor lem mar nor pel ras sol tam ver win zel".split(),
             "cyrillic": "ба ве гор дем жал зор кор лан мир нов пол рад сол тар фед шум".split(),
             "greek": "βα γε δη ζα θο κα λε μα νι πα ρο σα τε φω χα ψι".split(),
             "arabic": "با تا جا حا دا را سا شا صا طا فا قا كا لا ما نا".split(),
             "hebrew": "בא גא דא הא זא חא טא כא לא מא נא סא פא צא קא רא".split(),
             "devanagari": "का खा गा चा जा ता दा ना पा बा मा या रा ला वा सा".split(),
             "han": "安 白 程 丁 方 高 何 江 林 马 宁 石 唐 文 谢 叶".split()}

MAX_ATTEMPTS = 24

_DIGIT = re.compile("[0-9]")
_MARK = "\u0300-\u036f\u0591-\u05bd\u064b-\u065f\u0900-\u0903\u093a-\u094f\u0951-\u0957"  # combining marks aren't \\w
_WORD = rf"[^\W\d_](?:[^\W\d_]|[{_MARK}]|[’'-](?=[^\W\d_]))*"
_HAN = "\u3400-\u9fff"
_NAME = re.compile(rf"(?<![\w{_MARK}]){_WORD}")
_SUFFIXED = re.compile(rf"(?<![{_HAN}])([{_HAN}]{{1,4}}?)({'|'.join(SUFFIXES)})")
PATTERNS = [
    ("email", re.compile(r"(?<![\w.+-])[A-Za-z0-9](?:[\w.+-]{0,62}[\w+-])?@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,24}(?![\w-])", re.ASCII)),
    ("ip", re.compile(r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)", re.ASCII)),
    ("ip6", re.compile(r"(?<![\w:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![\w:]|\.\d)", re.ASCII)),
    ("iban", re.compile(r"(?<![\w-])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\w-])", re.ASCII)),
    ("card", re.compile(r"(?<![\w.-])\d+(?:[ -]\d+)*(?![\w-])", re.ASCII)),
    ("ssn", re.compile(r"(?<![\w.+-])(?!000|666|9)\d{3}([- ])(?!00)\d{2}\1(?!0000)\d{4}(?![\w-])", re.ASCII)),
    ("phone", re.compile(r"(?<![\w.+-])(?:"
                         r"(?:\+\d{1,3}[ .-]?|1[ .-])?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}"
                         r"|\+\d{7,15}"
                         r"|\+\d{1,3}[ .-]?(?:\(0\)[ .-]?)?(?:\(\d{1,5}\)|\d{1,5})(?:(?:[ .-]\d{2}){3,5}|[ .-]?\d{2,4}[ .-]\d{3,4}|[ .-]\d{5,9})"
                         r"|0\d(?:[ .-]\d{2}){4}"
                         r")(?![\w-])", re.ASCII)),
    ("person", re.compile(rf"\b({'|'.join(sorted(TITLES, key=len, reverse=True))})\.? ({_WORD}(?: {_WORD}){{0,2}})")),
]


def luhn_ok(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


#: Country codes of one and two digits; the others have three.
_COUNTRY = re.compile("1|7|2[07]|3[0123469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]")


def _cards(m: re.Match[str]) -> list[tuple[int, int]]:
    """Places of card numbers in a run of digit groups: 13 to 19 digits that pass Luhn, from its first group, or from a later one in groups like a card's."""
    groups = [(g.start() + m.start(), g.end() + m.start()) for g in re.finditer(r"\d+", m.group(), re.ASCII)]
    out, i = [], 0
    while i < len(groups):
        total, ends, plain = 0, [], True
        for j in range(i, len(groups)):
            n = groups[j][1] - groups[j][0]
            total += n
            plain &= n >= 3
            if total > 19:
                break
            if total >= 13 and (i == 0 or plain and m.string[groups[i][0]] in "23456"):
                ends.append(j)
        j = next((j for j in reversed(ends) if luhn_ok("".join(m.string[a:b] for a, b in groups[i:j + 1]))), None)
        if j is not None:
            out.append((groups[i][0], groups[j][1]))
        i = i + 1 if j is None else j + 1
    return out


def _iban(raw: str) -> str | None:
    """The longest part at a group end that passes mod 97."""
    while True:
        body = raw.replace(" ", "")
        if 15 <= len(body) <= 34 and int("".join(str(int(c, 36)) for c in body[4:] + body[:4])) % 97 == 1:
            return raw
        raw, blank, _ = raw.rpartition(" ")
        if not blank:
            return None


def _ip6(raw: str) -> str | None:
    groups = [g for g in raw.split(":") if g]
    if "::" in raw and len(groups) < 3 and not re.match("(?i)fe[89ab]|f[cd]|[23]", groups[0] if groups and len(groups[0]) == 4 else ""):
        return None  # like a::b in a program
    try:
        return ipaddress.IPv6Address(raw).exploded
    except ValueError:
        return None


def _phone(raw: str) -> str:
    """``+country rest`` if the country is told, else the digits."""
    digits = re.sub(r"\D", "", raw, flags=re.ASCII)
    if raw[0] != "+":
        return "+1 " + digits[1:] if len(digits) == 11 and digits[0] == "1" else digits
    told = re.match(r"\+(\d{1,3})\D", raw, re.ASCII)
    country = told.group(1) if told else (_COUNTRY.match(digits) or re.match("...", digits)).group()
    return f"+{country} {digits[len(country):]}"


def _names(words: list[str]) -> list[str]:
    """The leading words that can be a name: capitalised, or in a script without case (two at most)."""
    out: list[str] = []
    for w in words:
        if w[0].islower() or len(w) == 1 and w.isascii() or (out and not w[0].isupper() and len(out) == 2):
            break
        out.append(re.sub("[’']s$", "", w))
        if out[-1] != w:
            break
    return out


def _mentions(text: str, persons: set[str]) -> list[tuple[int, int, str]]:
    """Full names and surnames of the document's titled persons, wherever they stand."""
    wanted: dict[str, str] = {}
    for norm in sorted(persons):  # of f, m and x the last is kept where a title tells nothing
        gender, _, name = norm.partition("|")
        words = name.split(" ")
        if wanted.get(name, "x|")[0] == "x":
            wanted[name] = norm
        wanted.setdefault(words[-1], f"x|{words[-1]}")
    if not wanted:
        return []
    han = sorted((n for n in wanted if _script(n) == "han"), key=len, reverse=True)
    out = [(m.start(), m.end(), wanted[m.group()]) for m in re.finditer("|".join(map(re.escape, han)), text)] if han else []
    tokens = [(m.start(), m.end()) for m in _NAME.finditer(text)]
    i = 0
    while i < len(tokens):
        step = 1
        if not text[tokens[i][0]].islower():
            for n in (3, 2, 1):
                if i + n > len(tokens) or any(text[tokens[j][1]:tokens[j + 1][0]].strip() or text[tokens[j + 1][0]].islower() for j in range(i, i + n - 1)):
                    continue
                (a, _), (_, b) = tokens[i], tokens[i + n - 1]
                norm = wanted.get(" ".join(text[a:b].split()).casefold())
                possessive = re.search("[’']s$", text[a:b]) if norm is None else None
                if possessive:
                    b = a + possessive.start()
                    norm = wanted.get(" ".join(text[a:b].split()).casefold())
                if norm is not None:
                    out.append((a, b, norm))
                    step = n
                    break
        i += step
    return out


def find(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, type, normalised entity) in order, without overlaps; earlier types win."""
    taken: list[tuple[int, int, str, str]] = []

    def take(a: int, b: int, kind: str, norm: str) -> None:
        at = bisect.bisect(taken, (a,))
        if (at == len(taken) or b <= taken[at][0]) and (at == 0 or taken[at - 1][1] <= a):
            taken.insert(at, (a, b, kind, norm))

    numbers = _DIGIT.search(text)
    for kind, pattern in PATTERNS:
        if (kind == "email" and "@" not in text) or (kind in ("ip", "iban", "card", "ssn", "phone") and not numbers) or (kind == "ip6" and ":" not in text):
            continue
        for m in pattern.finditer(text):
            a, b, raw = m.start(), m.end(), m.group()
            digits = re.sub(r"\D", "", raw, flags=re.ASCII)
            if kind == "card":
                for a, b in _cards(m) if len(digits) > 12 else ():
                    take(a, b, kind, re.sub(r"\D", "", text[a:b], flags=re.ASCII))
                continue
            if kind == "ip" and any(int(x) > 255 or x != str(int(x)) for x in raw.split(".")):
                continue
            if kind == "person":
                names = _names(m.group(2).split(" "))
                if not names:
                    continue
                a, b = m.start(2), m.start(2) + len(" ".join(names))
                norm = TITLES[m.group(1)] + "|" + " ".join(names).casefold()
            elif kind == "ip6":
                norm = _ip6(raw)
            elif kind == "iban":
                raw = _iban(raw)
                norm, b = raw and raw.replace(" ", ""), a + len(raw or "")
            else:
                norm = raw.lower() if kind in ("email", "ip") else _phone(raw) if kind == "phone" else digits
            if norm:
                take(a, b, kind, norm)
    for m in _SUFFIXED.finditer(text) if any(x in text for x in SUFFIXES) else ():
        take(m.start(1), m.end(1), "person", SUFFIXES[m.group(2)] + "|" + m.group(1))
    for a, b, norm in _mentions(text, {n for _, _, k, n in taken if k == "person"}):
        take(a, b, "person", norm)
    return taken


def _prf(key: bytes, *parts: object) -> int:
    return int.from_bytes(hmac.new(key, "\x1f".join(map(str, parts)).encode(), hashlib.sha256).digest(), "big")


def permute(key: bytes, tweak: str, value: int, size: int) -> int:
    """A keyed permutation of 0 .. size - 1: four Feistel rounds on two halves, walked until the result is in range."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    mask = (1 << half) - 1
    while True:
        left, right = value >> half, value & mask
        for r in range(4):
            left, right = right, left ^ _prf(key, tweak, r, right) & mask
        value = left << half | right
        if value < size:
            return value


def _digits(key: bytes, tweak: str, digits: str) -> str:
    return str(permute(key, f"{tweak}{len(digits)}", int(digits), 10 ** len(digits))).zfill(len(digits)) if digits else ""


_SCRIPTS = (("Ͱ", "Ͽ", "greek"), ("ἀ", "῿", "greek"), ("Ѐ", "ӿ", "cyrillic"), ("\u0590", "\u05ff", "hebrew"), ("\u0600", "\u06ff", "arabic"),
            ("\u0900", "\u097f", "devanagari"), ("\u3400", "\u9fff", "han"))


def _script(name: str) -> str:
    return next((script for c in name for low, high, script in _SCRIPTS if low <= c <= high), "latin")


def _family(n: int, script: str, attempt: int) -> str:
    part = SYLLABLES[script]
    out = ""
    for _ in range(4 + 2 * attempt):
        out, n = out + part[n % 16], n // 16
    return out.capitalize()


def surrogate(key: bytes, kind: str, norm: str, attempt: int, gender: str = "x") -> str:
    """The normalised surrogate of an entity; distinct for distinct numbers, checked over the corpus for all.

    ``family`` is one family name. A ``person`` has a first name, given here with the unchanged family names: their surrogates differ for
    different names, so two persons' surrogates are equal just if these are.
    """
    tweak = f"{kind}/{attempt}"
    if kind == "ip":
        n = 0
        for octet in norm.split("."):
            n = n * 256 + int(octet)
        n = permute(key, tweak, n, 2**32)
        return ".".join(str(n >> s & 255) for s in (24, 16, 8, 0))
    if kind == "ip6":
        return ipaddress.IPv6Address(permute(key, tweak, int(ipaddress.IPv6Address(norm)), 2**128)).exploded
    if kind == "phone":
        country, blank, number = norm.rpartition(" ")
        return country + blank + number[:-10] + _digits(key, tweak, number[-10:])
    if kind == "ssn":
        area, group, serial = int(norm[:3]), int(norm[3:5]), int(norm[5:])
        n = permute(key, tweak, ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1, 898 * 99 * 9999)
        area = n // (99 * 9999) + 1
        return f"{area + (area > 665):03}{n // 9999 % 99 + 1:02}{n % 9999 + 1:04}"
    if kind == "iban":
        made = iter(_digits(key, tweak + re.sub("[0-9]", "0", norm[4:]), re.sub("[^0-9]", "", norm[4:])))
        body = "".join(next(made) if c.isdigit() else c for c in norm[4:])
        return norm[:2] + f"{98 - int(''.join(str(int(c, 36)) for c in body + norm[:2] + '00')) % 97:02}" + body
    if kind == "card":
        body = norm[0] + _digits(key, tweak, norm[1:-1])
        return next(body + d for d in "0123456789" if luhn_ok(body + d))
    if kind == "email":
        local, _, domain = norm.partition("@")
        n, out = _prf(key, tweak, norm), []
        for c in local:
            size = 26 if c.isalpha() else 10 if c.isdigit() else 1
            out.append(chr(ord("a") + n % 26) if size == 26 else str(n % 10) if size == 10 else c)
            n //= size
        host = f"host{n % 10 ** (4 + 2 * attempt)}.example." + (domain.rpartition(".")[2] if domain.rpartition(".")[2] in ("com", "net", "org") else "com")
        return "".join(out) + "@" + host
    n = _prf(key, tweak, norm)
    if kind == "family":
        return _family(n % 16 ** (4 + 2 * attempt), _script(norm), attempt).casefold()
    first, *rest = norm.split(" ")
    script = _script(first)
    pool = GIVEN[script, gender] if gender != "x" else GIVEN[script, "m"] + GIVEN[script, "f"]
    given = pool[n % len(pool)]
    for _ in range(2 * attempt):
        n //= 16
        given += SYLLABLES[script][n % 16]
    return "\x1f".join([given.casefold(), *rest])


def parts(norm: str) -> list[tuple[str, str, str]]:
    """(kind, norm, gender) of what a person's name is made of: its first name beside the others, and each family name."""
    gender, _, name = norm.partition("|")
    words = name.split(" ")
    return ([("person", name, gender)] if len(words) > 1 else []) + [("family", w, "x") for w in (words[1:] or words)]


def units(entities: list[tuple[int, int, str, str]]) -> set[tuple[str, str, str]]:
    """(kind, norm, gender) of all that gets a surrogate of its own."""
    return {u for _, _, kind, norm in entities for u in (parts(norm) if kind == "person" else [(kind, norm, "x")])}


def made_for(key: bytes, kind: str, norm: str, later: dict[str, dict]) -> str:
    """The settled surrogate; a person's is its first name's and its family names'."""
    def one(kind: str, norm: str, gender: str) -> str:
        at = later.get(f"{kind}\x1f{norm}")
        return surrogate(key, kind, norm, at["attempt"] if at else 0, at["gender"] if at else gender)

    if kind != "person":
        return one(kind, norm, "x")
    return " ".join(one(*p).partition("\x1f")[0] for p in parts(norm))


def rendered(raw: str, kind: str, made: str) -> str:
    """The surrogate in the format of the original: grouping and separators, or letter case."""
    if kind == "iban":
        it = iter(made)
        return "".join(c if c == " " else next(it) for c in raw)
    if kind in ("phone", "card", "ssn"):
        it = iter(re.sub("[^0-9]", "", made))
        return "".join(next(it) if c.isdigit() else c for c in raw)
    if kind == "ip6":
        made = str(ipaddress.IPv6Address(made)) if len(raw) < 39 else made
        return made.upper() if re.search("[A-F]", raw) else made
    if kind == "person":
        names = iter(made.split(" "))
        return "".join(r if r.isspace() else (lambda n: n.upper() if r.isupper() and len(r) > 1 else n[0].upper() + n[1:])(next(names)) for r in re.split(r"(\s+)", raw))
    return made.upper() if raw.isupper() else made


def _settle(found: DataFrame, key: bytes) -> DataFrame:
    """(kind, norm, attempt, gender) of the entities that need a later attempt than the first, or a gender that not all their titles tell."""
    def make(cols: dict[str, list]) -> dict[str, list]:
        each = zip(cols["kind"], cols["norm"], cols["attempt"], cols["gender"], strict=True)
        return {c: cols[c] for c in ("kind", "norm", "gender", "mixed", "attempt")} | {"made": [surrogate(key, k, n, a, g) for k, n, a, g in each]}

    fields = "kind string, norm string, gender string, mixed boolean, attempt int, made string"
    table = stage(mapped(found.withColumn("attempt", F.lit(0)), make, fields), "pii-made")
    for _ in range(MAX_ATTEMPTS):
        least = table.groupBy("kind", "made").agg(F.min(F.struct("attempt", "norm")).alias("first"))
        real = found.select("kind", F.col("norm").alias("made"), F.lit(True).alias("real"))
        judged = table.join(least, ["kind", "made"]).join(real, ["kind", "made"], "left")
        judged = judged.withColumn("again", F.col("real").isNotNull() | (F.col("first") != F.struct("attempt", "norm")))
        judged = stage(judged.select("kind", "norm", "gender", "mixed", "attempt", "made", "again"), "pii-judged")
        if judged.where("again").isEmpty():
            return judged.where("attempt > 0 or mixed").select("kind", "norm", "attempt", "gender")
        table = stage(judged.where("not again").drop("again").unionByName(
            mapped(judged.where("again").select("kind", "norm", "gender", "mixed", (F.col("attempt") + 1).alias("attempt")), make, fields)), "pii-made")
    raise RuntimeError(f"surrogates still collide after {MAX_ATTEMPTS} attempts")


def pseudonymise(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """The documents in their own columns with surrogates in ``text``; then ``n_entities`` and ``entities`` (start, end in the original, kind, surrogate).

    Columns of the documents with these two names are left out, as the result's stand in their place."""
    if not key:
        raise ValueError("a key is needed")
    docs = docs.drop("n_entities", "entities")
    place = f"c{docs.columns.index(text)}"

    def entities(cols: dict[str, list]) -> dict[str, list]:
        got = {u for t in cols["text"] if t for u in units(find(t))}
        return {c: [u[i] for u in got] for i, c in enumerate(("kind", "norm", "gender"))}

    told = mapped(docs.select(docs[text].alias("text")), entities, "kind string, norm string, gender string").groupBy("kind", "norm").agg(
        F.collect_set("gender").alias("told"))
    known = F.array_remove("told", "x")
    found = stage(told.select("kind", "norm", F.when(F.size(known) == 1, known[0]).otherwise("x").alias("gender"), (F.size("told") > 1).alias("mixed")), "pii-found")
    later = stage(_settle(found, key), "pii-later")
    box = boxed(docs)
    if later.isEmpty():
        ready = box.withColumn("later", F.lit(None).cast("map<string,struct<attempt:int,gender:string>>"))
    else:
        box = stage(box, "pii-docs")

        def holders(cols: dict[str, list]) -> dict[str, list]:
            rows = [(r, k, n) for r, t in zip(cols["rid"], cols["text"], strict=True) if t for k, n in {u[:2] for u in units(find(t))}]
            return {"rid": [x[0] for x in rows], "kind": [x[1] for x in rows], "norm": [x[2] for x in rows]}

        mine = (mapped(box.select("rid", F.col(place).alias("text")), holders, "rid long, kind string, norm string").join(later, ["kind", "norm"])
                .groupBy("rid").agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws("\x1f", "kind", "norm"), F.struct("attempt", "gender")))).alias("later")))
        ready = box.join(mine, "rid", "left")
    kinds = {f.name: f.dataType.simpleString() for f in ready.schema if f.name not in ("rid", "later")}

    def replace(cols: dict[str, list]) -> dict[str, list]:
        out = {c: list(cols[c]) for c in kinds} | {"entities": []}
        for i, (t, late) in enumerate(zip(cols[place], cols["later"], strict=True)):
            got, at, parts = [], 0, []
            settled = dict(late or ())
            for a, b, kind, norm in find(t) if t else ():
                made = rendered(t[a:b], kind, made_for(key, kind, norm, settled))
                parts += [t[at:a], made]
                at = b
                got.append({"start": a, "end": b, "kind": kind, "surrogate": made})
            if got:
                out[place][i] = "".join(parts) + t[at:]
            out["entities"].append(got)
        return out

    fields = ", ".join(f"{c} {k}" for c, k in kinds.items()) + ", entities array<struct<start:int,end:int,kind:string,surrogate:string>>"
    return mapped(ready.drop("rid"), replace, fields).select(*unboxed(docs.columns), F.size("entities").cast("long").alias("n_entities"), "entities")
