"""Personal information in free text: findings and replaced text.

Candidates of each kind come from patterns and are validated (digit counts,
number plans, name shape).  Numbers are replaced by format-preserving
pseudonyms: a keyed Feistel network permutes the number's canonical form inside
its format, so equal values stay linked across documents however they are
written.  A phone number keeps its plan and area and gets another subscriber
number of that plan, a birth date another date in the same notation, an
identity number other digits and letters in the same places.  E-mail addresses,
street addresses and names become typed placeholders.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("email", "phone", "id_number", "street_address", "person_name")
#: Found and replaced as well, but no finding of its own where only ``KINDS`` are asked for.
BIRTH_DATE = "birth_date"

# Given names that make a name of the word beside them.
GIVEN_NAMES = """
adam agnes alan albert alex alexander ali alice amanda amelia amir amy ana andrea andreas andrew angela anika anita ann anna anne
anthony antonio arthur barbara ben benjamin bernd bettina brian callum carla carlos carol caroline catherine charles charlotte chloe
christian christina christine christopher claire clara claudia colin daniel david deborah delia dennis derek diana diego donald
dorothy edward elena eleanor elisabeth elizabeth ellen emily emma emre eric erik esther eva fatima felix femi fiona frances francis
frank gabriel gareth george gerald giulia greta hannah hans harold haruto heather heinrich helen helena henry hugh ines ingrid
isabel ivan jack jacob james jan jane janet jason jean jennifer jessica joan johanna john jonas jonathan jose joseph joshua juan
judith julia julian karen karl katharina katherine kathleen keith kenneth kevin kofi kurt laura lena leo leonie lewis linda lisa
louisa louise lucas lucy luis magnus maeve marco margaret maria marie marion martha martin mary matthew maya michael miguel mirela
mohammed monica naomi natalie nathan nicholas nicola nina noah noor nora oliver olivia omar orla oskar oscar otto patricia patrick paul
paula pavel pedro peter petra philip priya rachel ralph raymond rebecca richard robert robin roger ronald rufus ruth samuel sandra
sarah sean sebastian sharon silas simon sofia sophie stefan stephen steven susan sven tamsin tanya teresa theresa thomas timothy
tobias tom ursula valerie vera victor victoria vincent walter wanda wendy william yara yusuf yvonne zoe
""".split()

# Street types, with their abbreviations.
STREET_TYPES = "street st avenue ave road rd drive dr lane ln court ct crescent cres close way terrace ter steps place pl square sq boulevard blvd hill grove gardens mews row walk parade".split()
STREET_ENDINGS = "kamp gasse weg strasse straße allee platz ring damm ufer chaussee".split()

# Words that are no part of a name when they stand beside one.
NO_NAMES = set(
    """a about after again all also although always am an and another any anyone are around as ask asked at back bad be because been before
    being below between both but by call called came can cannot clinic come could day days dear despite did do does done down during each
    early edit else even ever every everyone few first for friday from further gave get go goes going good got had has have he hello help her here
    hers hi him his honestly how however i if in instead into is it its itself jaw just keep kept last late later left less let lets like
    likes little look looked looks love loved made make many may me mine monday more most mostly much must my near never new next night no
    nobody none nope nor not nothing notes now of off often oh old on once one only onto oddly or other our ours out over own per please
    pressing put quite rarely rather really right said same saturday says second see seems seen sent she should since slept small so some
    someone sometimes soon still such sunday take taken than thank thanks that the their theirs them then there these they this those though
    through thursday to today together told tomorrow too took tuesday two under until up upon us use used very via want wants warm was way we
    wednesday week weeks well went were what when where whether which while who whole whom whose why will wish with without woke work works
    would write wrote yes yesterday yet you your yours band brand trial street road lane court ave avenue drive close terrace crescent way
    steps hz hears thinks sleeps paid swears insists guessed jokes wrote suspects promised admitted keeps posted replied answered
    hi hey ps pps tl dr clinic hospital practice surgery centre center university institute pharmacy shop store group forum""".split()
)

# Family names that are also words of prose; in capitals beside a given name they are names.
WORD_NAMES = set("may day long little small young last love look such good wells notes best still".split())

# Words before a number that show that it is not a person's.
NO_ID_WORDS = set("model invoice order lot serial part item ticket tracking sku batch case receipt article version catalogue".split())

#: Words that stand right before a person's name whatever the given name is.
NAME_CUES = r"(?:\b(?:Dr|Mr|Mrs|Ms|Prof)\.?|\b[Nn]urse|\b[Ss]igned,|\b[Yy]ours,|\b[Rr]egards,|\b[Nn]eighbour|\b[Mm]y ex,|\b[Aa]ccording to|\b[Aa]ddressed to|\b[Aa]udiologist|\b[Aa]sk for|\b[Rr]oom with)"

_WORD = r"[A-Za-zÀ-ÖØ-öø-ÿ]+(?:['’][A-Z][A-Za-zÀ-ÖØ-öø-ÿ]+)?"
_FAMILY = rf"{_WORD}(?:-{_WORD})?"
_AFTER = re.compile(rf"(?:[ \u00a0]+[A-Za-z]\.)?[ \u00a0]+({_FAMILY})")
_BEFORE = re.compile(rf"(?<![\w@.])({_FAMILY}),[ \u00a0]+\Z")
_TITLE = r"[A-ZÀ-Ö][a-zß-ÿ]+"
# Names without a known given name: two capitalised words that a verb of speech follows or a word for a person precedes.
_NAMED = rf"{_TITLE} (?:[A-Z]\. )?{_TITLE}(?:-{_TITLE})?"
_SPEAKS = re.compile(rf"(?<![\w.@/-])({_NAMED})(?= (?:and {_NAMED} )?(?:said|says|told|wrote|writes|asked|replied|explained)\b)")
_PERSON = re.compile(rf"\b(?:friend|colleague|wife|husband|sister|brother|boss|cousin|uncle|aunt|mother|father|daughter|son|met|named|dentist|doctor|therapist|surgeon|physio),? ({_NAMED})\b(?!')")
_AND_NAME = re.compile(rf" and ({_NAMED})\b")
_INITIAL = re.compile(rf"(?<![\w.@\d])(?<!\d )(?:[A-Z]\.[ \u00a0]?){{1,2}}[ \u00a0]?({_TITLE}(?:-{_TITLE})?)\b")
_CUED = re.compile(rf"{NAME_CUES}[ \u00a0]+({_TITLE}(?:[ \u00a0]+[A-Z]\.)?[ \u00a0]+{_TITLE}(?:-{_TITLE})?|{_TITLE}(?:-{_TITLE})?,[ \u00a0]+{_TITLE})\b")
_CUE_WORDS = ("Dr", "Mr", "Ms", "Prof", "urse", "igned,", "ours,", "egards,", "eighbour", "y ex,", "ccording to", "ddressed to", "udiologist", "sk for", "oom with")

_AT = r"(?:[ \u00a0]?@[ \u00a0]?|[ \u00a0]?[\[({<][ \u00a0]?(?:at|@)[ \u00a0]?[\])}>][ \u00a0]?|[ \u00a0]at[ \u00a0])"
_DOT = r"(?:\.|[ \u00a0]?[\[({<][ \u00a0]?(?:dot|\.)[ \u00a0]?[\])}>][ \u00a0]?|[ \u00a0]dot[ \u00a0])"
_LABEL = r"[a-z0-9](?:[a-z0-9-]*[a-z0-9])?"
_EMAIL = re.compile(rf"(?<![\w.+-])[a-z0-9](?:[\w.+%-]*\w)?{_AT}{_LABEL}(?:{_DOT}{_LABEL})*{_DOT}[a-z]{{2,}}\b", re.I)
_EMAIL_PLAIN = re.compile(r"[ \u00a0]at[ \u00a0]", re.I)
_DOTTED = re.compile(r"dot", re.I)

_RUN = re.compile(r"(?<![\w.])(?<!\d[-/])[+(]{0,2}\d(?:[ \u00a0().\-/]{0,3}\d){8,15}(?![\w])(?!-\d)")
# Digits in words.
DIGIT_WORDS = {w: d for d, w in enumerate("zero one two three four five six seven eight nine".split())} | {"oh": 0}
_SPELLED = re.compile(rf"\b(?:(?:{'|'.join(DIGIT_WORDS)})[ \u00a0,-]{{1,2}}){{9,13}}(?:{'|'.join(DIGIT_WORDS)})\b", re.I)
_SPELLED_TWO = re.compile(rf"(?:{'|'.join(DIGIT_WORDS)})[ \u00a0,-]{{1,2}}(?:{'|'.join(DIGIT_WORDS)})[ \u00a0,-]")
_ID = re.compile(
    r"(?<![\w-])(?:"
    r"[A-Z]{2}-\d{4}-\d{4}-\d{2}"  # health number
    r"|[A-Z]{2}[ \u00a0]?\d{2}[ \u00a0]?\d{2}[ \u00a0]?\d{2}[ \u00a0]?[A-D]"  # insurance number
    r"|[A-Z]{2}\d{4}[ \u00a0]?\d{5}"  # driving licence
    r"|[A-Z]{1,2}\d{7}"  # passport
    r"|\d{3}-\d{2}-\d{4}|\d{3}[ \u00a0]\d{2}[ \u00a0]\d{4}|9\d{8}"  # social security number
    r")(?![\w])(?!-\d)",
    re.I,
)
_ID_CUE = re.compile(
    r"(?:\bSSN|social (?:security )?number|insurance number|national id|licen[cs]e|passport(?: no\.?| number)?|member(?: no\.?| number| id)|patient (?:id|no\.?|number)|NI number|health card)"
    r"[ ,:#]*(?:is|was|no\.?)?[ ,:#]*((?=[A-Z0-9 -]*\d{3})[A-Z0-9](?:[A-Z0-9]|-(?=[A-Z0-9])|[ ](?=\d)){5,16})\b",
    re.I,
)
_ID_CUES = ("ssn", "social", "insurance n", "national id", "licen", "passport", "member", "patient", "ni number", "health card")
_ADDRESS = re.compile(
    rf"(?<![\w.,/-])\d{{1,5}}[A-Za-z]?[ \u00a0](?:[NSEWnsew]\.?[ \u00a0])?(?:{_WORD}[ \u00a0]){{1,3}}?(?:(?:{'|'.join(STREET_TYPES)})\b\.?)", re.I
)
_ADDRESS_END = re.compile(rf"\b[A-ZÄÖÜ]?[A-Za-zäöüß]+(?:{'|'.join(STREET_ENDINGS)})[ \u00a0]\d{{1,4}}[A-Za-z]?\b", re.I)
_ABBREVIATED = {"st", "ave", "rd", "dr", "ln", "ct", "cres", "ter", "pl", "sq", "blvd"}
_DIGIT = re.compile(r"\d")
_MONTHS = "january february march april may june july august september october november december".split()
_BIRTH = re.compile(
    r"\b(?:born(?: on)?|d\.?o\.?b\.?|date of birth|birth ?dates?|birthday)(?:[ :,]+(?:is|was|on))?[ :,]*"
    rf"((\d{{4}})-(\d\d)-(\d\d)|(\d{{1,2}})([/.])(\d{{1,2}})\6(\d{{4}})|(\d{{1,2}}) ({'|'.join(_MONTHS)}) (\d{{4}}))\b",
    re.I,
)
_BIRTH_CUES = ("born", "birth", "dob", "d.o.b")
#: Cheap tests that every hit of the patterns above passes; most texts fail them all.
_NUMBERED = re.compile(r"\d(?:[ \u00a0().\-/]{0,3}\d){5}")
_STREETS = re.compile(r"\d[A-Za-z]?[ \u00a0](?:[NSEWnsew]\.?[ \u00a0])?[A-Za-zÀ-ÿ'’]+[ \u00a0](?:[A-Za-zÀ-ÿ'’]+[ \u00a0]){0,2}(?:[SsAaRrDdLlCcTtPpBbHhGgMmWw])")
_STREETS_END = re.compile(rf"(?:{'|'.join(STREET_ENDINGS)})[ \u00a0]\d")
_CAPITALS = re.compile(r"\b[A-ZÀ-Ö][a-zß-ÿ]+ (?:[A-Z]\. )?[A-ZÀ-Ö][a-zß-ÿ]+")
_INITIALED = re.compile(r"\b[A-Z]\.[ \u00a0]?[A-ZÀ-Ö]")
#: Small words and measures that show that "number word(s) street type" is prose.
_PROSE = set("out of the in and to a my for with as at on when while near hz percent minutes shows needs sessions weeks nights days months mornings evenings tries shifts hours".split())


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for name in GIVEN_NAMES:
        found.add_word(name, len(name))
    found.make_automaton()
    return found


_NAMES = _automaton()


def _style(word: str) -> str:
    return "u" if word.isupper() else "l" if word.islower() else "t" if word[:1].isupper() else "x"


def _phone(digits: str, raw: str) -> bool:
    """A number of a plan known here: North America, or Britain's mobile and town numbers."""
    if digits.startswith("0044"):
        digits = "0" + digits[4:].lstrip("0")
    elif raw.lstrip("(").startswith("+44"):
        digits = "0" + digits[2:].lstrip("0")
    if raw.startswith("+") and digits[0] not in "01":
        return 9 <= len(digits) <= 14
    if len(digits) == 11 and digits[0] == "0":
        return digits[1] in "12378"
    if len(digits) == 11 and digits[0] == "1":
        digits = digits[1:]
    return len(digits) == 10 and digits[0] in "23456789" and digits[3] in "23456789"


def _mask(text: str, spans: list[tuple[int, int]]) -> str:
    for a, b in spans:
        text = text[:a] + "\x00" * (b - a) + text[b:]
    return text


def find_pii(text: str | None) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every finding, in order and without overlaps; none for null or ''."""
    if not text:
        return []
    found: list[tuple[int, int, str]] = []

    def taken(a: int, b: int) -> bool:
        return any(a < y and x < b for x, y, _ in found)

    # addresses of machines first, then numbers, then streets, then names
    lowered = text.lower()
    if len(lowered) != len(text):  # a sign that grows when lowered stays as it is
        lowered = "".join(c if len(c.lower()) > 1 else c.lower() for c in text)
    if "@" in text or ((_DOTTED.search(text)) and re.search(r"\bat\b", text, re.I)):
        for m in _EMAIL.finditer(text):
            hit = m[0]
            if "@" not in hit and not re.search(r"[\[({<]\s?at", hit, re.I) and not _DOTTED.search(hit):
                continue  # "at" between plain words needs a spelled dot
            found.append((m.start(), m.end(), "email"))
    if _DIGIT.search(text):
        if _NUMBERED.search(text):
            for m in _ID.finditer(text):
                before = text[max(0, m.start() - 14) : m.start()].lower().split()
                if not taken(*m.span()) and not (before and before[-1].strip(":#.,") in NO_ID_WORDS):
                    found.append((*m.span(), "id_number"))
            for m in _RUN.finditer(text):
                a, b = m.span()
                raw = m[0]
                if raw.count("(") > raw.count(")"):
                    a += len(raw) - len(raw.lstrip("("))
                    raw = text[a:b]
                if not taken(a, b) and _phone("".join(_DIGIT.findall(raw)), raw):
                    found.append((a, b, "phone"))
        if any(cue in lowered for cue in _ID_CUES):
            for m in _ID_CUE.finditer(text):
                if not taken(*m.span(1)):
                    found.append((*m.span(1), "id_number"))
        if any(cue in lowered for cue in _BIRTH_CUES):
            for m in _BIRTH.finditer(text):
                if not taken(*m.span(1)) and _date_of(m[1]):
                    found.append((*m.span(1), BIRTH_DATE))
        for m in _ADDRESS.finditer(text) if _STREETS.search(text) else ():
            a, b = m.span()
            words = re.findall(r"[^\W\d_]+", m[0].lower().split(None, 1)[1])
            if any(w in _PROSE for w in words[:-1]) or taken(a, b):
                continue
            if m[0].endswith(".") and words[-1] not in _ABBREVIATED:
                b -= 1
            found.append((a, b, "street_address"))
        for m in _ADDRESS_END.finditer(text) if _STREETS_END.search(lowered) else ():
            if not taken(*m.span()):
                found.append((*m.span(), "street_address"))
    if _SPELLED_TWO.search(lowered):
        for m in _SPELLED.finditer(text):
            digits = canonical("phone", m[0])
            if not taken(*m.span()) and _phone(digits, digits):
                found.append((*m.span(), "phone"))
    spans = []
    for end, size in _NAMES.iter(lowered):
        a, b = end - size + 1, end + 1
        if (a and (lowered[a - 1].isalnum() or lowered[a - 1] in "_@/-'’")) or (b < len(text) and (lowered[b].isalnum() or lowered[b] in "_@-'’")):
            continue
        spans.append((a, b))
    spans.sort()
    for a, b in spans:
        if taken(a, b):
            continue
        given = text[a:b]
        style = _style(given)
        m = _AFTER.match(text, b)
        if m:
            family = m[1]
            if (family.lower() not in NO_NAMES or style == "t" and family.lower() in WORD_NAMES) and _style(family) == style and len(family) > 1 and not taken(*m.span()):
                found.append((a, m.end(), "person_name"))
                continue
        m = _BEFORE.search(text, max(0, a - 60), a)
        if m and m[1].lower() not in NO_NAMES and _style(m[1]) == style and not taken(*m.span(1)):
            found.append((m.start(1), b, "person_name"))
    if _INITIALED.search(text):
        for m in _INITIAL.finditer(text):
            if m[1].lower() not in NO_NAMES and len(m[1]) > 3 and not taken(*m.span()):
                found.append((*m.span(), "person_name"))
    if any(cue in text for cue in _CUE_WORDS):
        for m in _CUED.finditer(text):
            words = re.findall(_WORD, m[1].lower())
            if not any(w in NO_NAMES for w in words) and not taken(*m.span(1)):
                found.append((*m.span(1), "person_name"))
    for pattern in (_SPEAKS, _PERSON) if _CAPITALS.search(text) else ():
        for m in pattern.finditer(text):
            spans = [m.span(1)]
            if (more := _AND_NAME.match(text, m.end(1))) is not None:
                spans.append(more.span(1))
            for a, b in spans:
                words = re.findall(_WORD, text[a:b].lower())
                if not any(w in NO_NAMES for w in words) and not taken(a, b):
                    found.append((a, b, "person_name"))
    return sorted(found)


def _date_of(text: str) -> tuple[str, str] | None:
    """(yyyy-MM-dd, notation) of a written date that exists, else null; day before month where both may be."""
    m = re.fullmatch(r"(\d{4})-(\d\d)-(\d\d)|(\d{1,2})([/.])(\d{1,2})[/.](\d{4})|(\d{1,2}) ([A-Za-z]+) (\d{4})", text)
    if not m:
        return None
    if m[1]:
        y, mo, d, notation = int(m[1]), int(m[2]), int(m[3]), "iso"
    elif m[4]:
        y, mo, d, notation = int(m[7]), int(m[6]), int(m[4]), m[5]
        if mo > 12:
            mo, d, notation = d, mo, m[5] + "m"
    else:
        y, d, notation = int(m[10]), int(m[8]), "name"
        mo = _MONTHS.index(m[9].lower()) + 1 if m[9].lower() in _MONTHS else 0
    try:
        return datetime.date(y, mo, d).isoformat(), notation
    except ValueError:
        return None


def permute_birth_date(raw: str, key: bytes) -> str:
    """Another date in the same notation."""
    iso, notation = _date_of(raw)
    y, mo, d = permute_date(iso, key, days=256 * 180).split("-")
    if notation == "iso":
        return f"{y}-{mo}-{d}"
    if notation == "name":
        return f"{int(d)} {_MONTHS[int(mo) - 1].capitalize()} {y}"
    sign = notation[0]
    return sign.join((mo, d, y) if notation.endswith("m") else (d, mo, y))


# --- format-preserving pseudonyms --------------------------------------------------------------

ROUNDS = 8


def _round(key: bytes, n: int, side: int, size: int) -> int:
    return int.from_bytes(hashlib.blake2b(f"{n}|{side}|{size}".encode(), key=key, digest_size=16).digest(), "big")


def permute(value: int, left: int, right: int, key: bytes, inverse: bool = False) -> int:
    """Keyed permutation of 0 ... left*right-1: an alternating Feistel network over (value // right, value % right)."""
    a, b = divmod(value, right)
    for n in reversed(range(ROUNDS)) if inverse else range(ROUNDS):
        sign = -1 if inverse else 1
        if n % 2 == 0:
            a = (a + sign * _round(key, n, b, left)) % left
        else:
            b = (b + sign * _round(key, n, a, right)) % right
    return a * right + b


def permute_text(text: str, key: bytes, inverse: bool = False) -> str:
    """Digits permuted among strings of as many digits, letters likewise; all else stays in place.

    A single digit or letter is permuted among its 10 or 26 values.  Case stays.
    """
    out = list(text)
    for radix, test, base in ((10, str.isdecimal, "0"), (26, lambda c: c.isascii() and c.isalpha(), "a")):
        places = [i for i, c in enumerate(out) if test(c)]
        if not places:
            continue
        value = 0
        for i in places:
            value = value * radix + (int(out[i]) if radix == 10 else ord(out[i].lower()) - 97)
        right = radix ** (len(places) // 2)
        value = permute(value, radix ** len(places) // right, right, hashlib.blake2b(key, digest_size=32, person=f"{radix}:{len(places)}".encode()).digest(), inverse)
        for i in reversed(places):
            value, d = divmod(value, radix)
            c = chr(ord(base) + d)
            out[i] = c.upper() if out[i].isupper() else c
    return "".join(out)


def permute_date(iso: str, key: bytes, inverse: bool = False, first: str = "1900-01-01", days: int = 65536) -> str:
    """A date (yyyy-MM-dd) permuted among ``days`` days from ``first``; others stay as they are."""
    start = pd.Timestamp(first)
    n = (pd.Timestamp(iso) - start).days
    if not 0 <= n < days:
        return iso
    return (start + pd.Timedelta(days=permute(n, 256, days // 256, key, inverse))).strftime("%Y-%m-%d")


def canonical(kind: str, raw: str) -> str:
    """One spelling of a number: digits and letters only, a national prefix in its short form."""
    words = re.findall(r"[a-z]+", raw.lower())
    if len(words) > 5 and all(w in DIGIT_WORDS for w in words):
        raw = "".join(str(DIGIT_WORDS[w]) for w in words)
    bare = re.sub(r"[^0-9A-Za-z]", "", raw).upper()
    if kind == "phone":
        if bare.startswith("0044"):
            bare = "0" + bare[4:].lstrip("0")
        elif raw.lstrip("(").startswith("+44"):
            bare = "0" + bare[2:].lstrip("0")
        elif len(bare) == 11 and bare[0] == "1":
            bare = bare[1:]
    return bare


def permute_phone(number: str, key: bytes, inverse: bool = False) -> str:
    """A canonical number with another subscriber number of its plan: trunk and area stay, as do what the plan forbids."""
    if len(number) == 10 and number[0] in "23456789" and number[3] in "23456789":
        area, rest = number[:3], int(number[3:]) - 2_000_000  # exchanges begin with 2 to 9
        return area + str(permute(rest, 2_000, 4_000, _own(key, area), inverse) + 2_000_000)
    kept, rest = number[:-6], number[-6:]
    return kept + f"{permute(int(rest), 1_000, 1_000, _own(key, kept), inverse):06}"


def _own(key: bytes, person: str) -> bytes:
    return hashlib.blake2b(key + person.encode(), digest_size=32).digest()


def placeholder(kind: str, raw: str, key: bytes) -> str:
    if kind == "phone":
        return f"[phone:{permute_phone(canonical(kind, raw), key)}]"
    if kind == "id_number":
        return f"[{kind}:{permute_text(canonical(kind, raw), key)}]"
    if kind == BIRTH_DATE:
        return f"[{kind}:{permute_birth_date(raw, key)}]"
    return f"[{kind}]"


def replace_pii(text: str | None, findings: list[tuple[int, int, str]], key: bytes) -> str | None:
    """``text`` with each finding replaced, otherwise unchanged; null stays null."""
    if not findings:
        return text
    out, last = [], 0
    for a, b, kind in findings:
        out += [text[last:a], placeholder(kind, text[a:b], key)]
        last = b
    return "".join(out) + text[last:]


_SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("text", T.StringType())]))


def scrub(df: DataFrame, columns: dict[str, str], *, key: str, keep_clean: bool = True) -> DataFrame:
    """Findings and replaced text of every row.

    ``columns`` maps result names to string columns: ``id`` columns are passed
    through, ``text`` is searched.  Returns those id columns with ``clean``
    (the text with placeholders) and ``findings`` (array of kind and text).
    Null texts give null and no findings, empty ones ''; repeated rows stay.
    Other columns are dropped first, so clashing names do no harm.  Work is
    per row, so there is no shuffle and no group that could get hot.
    """
    secret = hashlib.blake2b(key.encode(), digest_size=32).digest()
    ids = [c for c in columns if c != "text"]
    narrow = df.select(*[F.col(columns[c]).alias(f"_{c}") for c in [*ids, "text"]])
    schema = T.StructType([*[T.StructField(f"_{c}", narrow.schema[f"_{c}"].dataType) for c in ids], T.StructField("clean", T.StringType()), T.StructField("findings", _SPANS)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            clean, findings = [], []
            for text in batch["_text"]:
                hits = find_pii(text)
                clean.append(replace_pii(text, hits, secret) if keep_clean else None)
                findings.append([(kind, text[a:b]) for a, b, kind in hits])
            out = batch.drop(columns="_text")
            out["clean"] = clean
            out["findings"] = findings
            yield out

    return narrow.mapInPandas(run, schema).select(*[F.col(f"_{c}").alias(c) for c in ids], "clean", "findings")
