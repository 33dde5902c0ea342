"""Personal data and secrets replaced by surrogates, with DataFrame functions alone.

Detected: e-mail addresses, phone numbers, payment card numbers, IPv4 and IPv6 addresses, bank account
numbers (IBAN), secret tokens (long hexadecimal or
mixed strings, also after a key name and an equals sign) and persons named after a title. A person is known by the name
without title; a shorter name is that of the fullest name in the document that holds all its words, if no title speaks
against it, and names found by a title, whole or their first or last word, are also found without one in that document;
one that is also an ordinary word (Will, May, or any that the text has in small letters) only within a sentence, after a word in
small letters that isn't an article or a word of time or place.
An entity is known in all its forms: numbers without their separators, mail addresses without capitals; each mention keeps
its own separators and capitals. A surrogate is derived from a keyed hash of the entity, so one entity has one surrogate
in all documents, without a table of them; the key is an argument. It keeps the type and the format: digits stay digits
and letters stay letters of their case and script, separators and lengths stay, the last label of a mail domain and a
phone's country code stay, octets stay octets of as many digits, card numbers keep a valid check digit if they had one,
and a person gets a name of the title's gender and the name's script.

Collision check: distinct entities are compared once over the whole corpus. Where two entities of a type would get the
same surrogate, or a surrogate is an entity that occurs, the entities after the first (in order) are derived anew with
a further attempt until all surrogates of the type differ and none occurs. From attempt ``WIDE`` on mail addresses, address
octets, secrets and phone numbers may grow, since a format of few signs can be used up.

Edge cases: a null text stays null, an empty one empty; texts without an entity stay as they are; repeated rows are
rewritten alike; very long texts are rewritten whole in one pass; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut_lineage, shared_path, table

#: The setting that holds the secret which surrogates are derived from, and what queries take where it isn't set.
KEY_SETTING, OPEN_KEY = "spark.voltaria.surrogates.key", "open key: for tests"
#: Attempt from which on a surrogate may be longer than its entity, as its format has no free value left.
WIDE = 6

_TITLES_F = "Mrs|Ms|Miss|Madame|Mme|Frau|Señora|Sra|г-жа|[Гг]оспожа|[Κκ]υρία|[Κκ]α"
_TITLES_M = "Mr|Sir|Monsieur|Herr|Señor|Sr|г-н|[Гг]осподин|[Κκ]ύριος|[Κκ]ος"
_TITLES_N = "Dr|Prof"
#: One or more titles, and a name: words with inner capitals, apostrophes and hyphens, initials, particles before a word.
#: Signs that a title begins with: what can't begin one is passed over at little cost, as in the other patterns' first looks ahead.
_BEGIN = "(?=[MSFDPгГκΚ])"
_TITLE = rf"{_BEGIN}(?<![\p{{L}}])(?:(?:{_TITLES_F}|{_TITLES_M}|{_TITLES_N})(?:\.\s{{0,2}}|\s{{1,2}}))++"
_PARTICLE = r"(?:[Vv]an|[Vv]on|[Dd]er|[Dd]en|[Dd]e|[Dd]el|[Dd]ella|[Dd]i|[Dd]a|[Dd]as|[Dd]os|[Dd]u|[Ll]a|[Ll]e|[Ee]l|[Aa]l|[Bb]in|[Ii]bn|[Bb]en|[Zz]u|[Zz]ur|[Tt]er|[Tt]en|af|av|y)"
_WORD = r"(?:\p{Lu}\.|(?:[dl]['’])?\p{Lu}[\p{L}\p{M}]*+(?:-\p{L}[\p{L}\p{M}]*+|['’](?:\p{Lu}|\p{L}{3})[\p{L}\p{M}]*+)*)"
_NAME = rf"(?:{_PARTICLE}[ \u00a0]){{0,3}}{_WORD}(?:[ \u00a0](?:{_PARTICLE}[ \u00a0]){{0,3}}{_WORD}){{0,5}}"
#: Length of a bank account number (IBAN) -> its countries (fixed values).
_IBAN = {
    15: "NO", 16: "BE", 18: "DK|FI|FK|FO|GL|NL|SD", 19: "MK|SI", 20: "AT|BA|EE|KZ|LT|LU|MN|XK", 21: "CH|HR|LI|LV", 22: "BG|BH|CR|DE|GB|GE|IE|ME|RS|VA", 23: "AE|GI|IL|IQ|OM|SO|TL", 24: "AD|CZ|ES|MD|PK|RO|SA|SE|SK|TN|VG",
    25: "LY|PT|ST", 26: "IS|TR", 27: "BI|DJ|FR|GR|IT|MC|MR|SM", 28: "AL|AZ|BY|CY|DO|GT|HU|LB|NI|PL|SV", 29: "BR|EG|PS|QA|UA", 30: "JO|KW|MU|YE", 31: "MT|SC", 32: "LC", 33: "RU",
}
_H = "[0-9A-Fa-f]"
#: Card numbers by their check digit alone: 13 to 15 and 17 to 19 digits together, or in the groups of 13, 14, 15 and 19 digits.
_CARD = r"(?<![0-9A-Za-z])(?<![0-9][.,])(?:[2-6][0-9]{12,13}|[1-6][0-9]{14}|[2-6][0-9]{16,18}|[2-6][0-9]{3}[ -](?:[0-9]{6}[ -][0-9]{4,5}|[0-9]{4}[ -][0-9]{5}|[0-9]{3}[ -][0-9]{3}[ -][0-9]{3})|[2-6][0-9]{5}[ -][0-9]{13})(?![0-9A-Za-z]|[.,][0-9])"
#: National phone numbers: North American ones, then those with the trunk prefix 0 (or 00 before a country code).
_PHONE = "|".join(
    [
        r"(?<![0-9A-Za-z.,+-])(?:1[ .-])?[2-9][0-9]{2}(?:\.[0-9]{3}\.| [0-9]{3} |-[0-9]{3}-)[0-9]{4}(?![0-9A-Za-z]|[.,-][0-9])",
        r"(?<![0-9A-Za-z.,+-])(?:00[1-9][0-9]{0,2}(?:[ .-]?[0-9]{2,4}){2,4}|0[1-9](?:(?: [0-9]{2}){4}|(?:\.[0-9]{2}){4}|(?:-[0-9]{2}){4})|0[1-9][0-9]{0,3}[ .-][0-9]{3,4}[ .-][0-9]{3,4}|0[1-9][0-9]{1,3}[ /-][0-9]{2,4}(?: [0-9]{2,4}){1,3}|0[1-9][0-9]{1,4}[ /-][0-9]{5,8}|0[1-9][0-9]{8,9})(?![0-9A-Za-z]|[.,-][0-9])",
        r"(?<![0-9A-Za-z(])\(0[0-9]{1,4}\)[ -]?[0-9]{2,8}(?:[ -][0-9]{2,4}){0,3}(?![0-9A-Za-z])",
    ]
)
#: Type -> pattern. A mention's type is the first that matches it whole, else it is a secret known by its key.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[._%+-]*+[\p{L}\p{N}][\p{L}\p{N}._%+-]*+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}",
    "secret": r"(?<![0-9A-Za-z])(?:(?:AKIA|ghp_|sk_live_|xox[bp]-)[0-9A-Za-z-]{12,}|[0-9a-f]{32,}|[0-9A-F]{32,})(?![0-9A-Za-z])",
    "iban": r"(?=[A-Z]{2}[0-9]{2})(?<![0-9A-Za-z])(?:" + "|".join(f"(?:{c})[0-9]{{2}}(?: ?[0-9A-Z]){{{n - 4}}}" for n, c in _IBAN.items()) + ")(?![0-9A-Za-z])",
    "ipv6": rf"(?<![0-9A-Za-z:.])(?={_H}{{0,4}}:)(?:(?=[0-9A-Fa-f:]*?{_H}:{{1,2}}{_H}++:{{1,2}}{_H})|(?=[A-Fa-f:]*+[0-9])(?=[0-9A-Fa-f:]*?{_H}{{3}}))(?:(?:{_H}{{1,4}}:){{7}}{_H}{{1,4}}|(?=(?:{_H}{{0,4}}:){{2,7}}(?:{_H}{{1,4}})?(?![0-9A-Za-z:]))(?:{_H}{{1,4}}(?::{_H}{{1,4}})*+)?::(?:{_H}{{1,4}}(?::{_H}{{1,4}})*+)?)(?![0-9A-Za-z:]|\.[0-9])",
    "card": r"(?<![0-9])[0-9]{4}(?:(?:[ -][0-9]{4}){3}[ -][0-9]{3}|(?:[ -]?[0-9]{4}){3})(?![0-9])",
    "ip": r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?![0-9]|\.[0-9])",
    "phone": r"(?<![0-9+])\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,4}(?![0-9])|(?<![0-9(])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])|(?<![0-9-])[0-9]{3}-[0-9]{3}-[0-9]{4}(?![0-9-])|" + _PHONE,
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "person": rf"{_TITLE}{_NAME}(?![\p{{L}}])",
}
#: A value with a digit after a key name that tells a secret; alone, without its key, it may match no pattern.
_KEYS = "password|passwd|passphrase|pwd|secret|token|api_?key|access_?key"
KEYED = (
    r"(?<=[=:\"'\s])(?=[^\s\"'&;,<>=:])(?<=[=:]\s?[\"']?)"  # bounded looks first: long runs of signs are passed over
    rf"(?<=(?i:{_KEYS})[\"']?\s?[=:]\s?[\"']?)(?=[^\s\"'&;,<>0-9]*+[0-9])[^\s\"'&;,<>]{{6,}}+"
)
#: The one numbered group holds what is a card number only if its check digit is right.
_SIGNS = "|".join(f"(?:{PATTERNS[k]})" for k in ("card", "ip", "phone", "ssn"))
ANY = "|".join([*(f"(?:{p})" for p in (KEYED, *(PATTERNS[k] for k in ("email", "secret", "iban", "ipv6")))), f"(?=[0-9+(])(?:{_SIGNS})", f"(?:{PATTERNS['person']})", f"(?=[1-6])({_CARD})"])
#: What every mention has something of; texts without are left alone at little cost.
TITLED = rf"{_BEGIN}(?:{_TITLES_F}|{_TITLES_M}|{_TITLES_N})[.\s]"
HINT = rf"[0-9@]|::|{TITLED}"

#: Given names by gender and family names, by script (fixed values).
NAMES = {
    "latin": (["Anna", "Clara", "Elena", "Julia", "Laura", "Maria", "Nina", "Sofia"], ["Adam", "David", "Felix", "Jonas", "Lukas", "Martin", "Oscar", "Victor"], ["Berger", "Costa", "Duval", "Fischer", "Garcia", "Hansen", "Keller", "Lopez", "Moreau", "Novak", "Rossi", "Weber"]),
    "cyrillic": (["Анна", "Елена", "Мария", "Ольга"], ["Борис", "Виктор", "Иван", "Павел"], ["Белых", "Дубко", "Живаго", "Коваль", "Черных"]),
    "greek": (["Άννα", "Ελένη", "Μαρία", "Σοφία"], ["Γιώργος", "Νίκος", "Πέτρος", "Τάσος"], ["Βλάχου", "Μακρή", "Ράλλη", "Σταύρου"]),
}
#: Names that are also ordinary words, months, days or places (fixed values).
ORDINARY = (
    "amber april art august autumn bill bishop black bond brook brown carol chance chase china christian church cook crystal dale dawn day dean drew england faith field flora forest frank "
    "france friday gene georgia gold grace grant gray green guy hall harmony heath hill holiday hope hunter iris ivy jack jade jasmine jean jersey jordan joy june king knight lane little long "
    "major march marine mark mason may mercy miles monday moon noble north olive paris park pat peace pearl penny pope price prince ray reed rich rob rock rose royal ruby rush sandy savannah "
    "sky smart south spring stone storm strong sue summer sunday troy victoria victory violet virginia wade ward west white will winter wood woods young"
).split()
#: Words after which an ordinary word is taken as such: of time and place, articles (fixed values).
_AFTER = "in|of|since|until|till|by|during|last|next|this|every|each|early|late|mid|from|to|on|before|after|between|and|or|a|an|the|der|die|das|dem|den|ein|eine|einem|einen"
_LOWER, _UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_CYR = "абвгдежзиклмнопрстуфхцчшэюя"
_GRE = "αβγδεζηθικλμνξοπρστυφχψω"
#: Letters of scripts without case (fixed values).
_SCRIPTS = {"IsHebrew": "אבגדהוזחטילמנסעפצקרשת", "IsArabic": "ابتثجحخدذرزسشصضطظعغفقكلمنهوي", "IsDevanagari": "कखगघचछजझटठडढणतथदधनपफबभमयरलवसह", "IsHan": "山川田林水火木金石天日月星雲雪花", "IsHiragana": "あいうえおかきくけこさしすせそ", "IsKatakana": "アイウエオカキクケコサシスセソ", "IsHangul": "가나다라마바사아자차카타파하"}


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def kind_of(mention: Column) -> Column:
    # a mention of no pattern is a value known by its key, which has a digit, or a name without its title
    out = F.when(mention.rlike("[0-9]"), "secret").otherwise("person")
    for name, pattern in reversed(PATTERNS.items()):
        # the mention was found with its surroundings in view; alone it is matched from its start to its end
        out = F.when(mention.rlike(f"^(?:{pattern})$"), name).otherwise(out)
    return out


def _number(digest: Column, at: Column) -> Column:
    """A number from the keyed digest for the position ``at`` (from 0)."""
    return F.conv(F.substr(digest, F.pmod(at * 5, F.lit(58)) + 1, F.lit(6)), 16, 10).cast("long") + at * 7


def _under(number: Column, below: int) -> Column:
    return F.pmod(number, F.lit(below)).cast("int")


def _draw(digest: Column, at: Column, below: int) -> Column:
    return _under(_number(digest, at), below)


def _pick(letters: str, k: Column) -> Column:
    return F.substr(F.lit(letters), k + 1, F.lit(1))


def _like(text: Column, digest: Column, letters: Column) -> Column:
    """Every letter and digit of a text replaced by another of its kind; the rest stays. ``letters``: how many of the Latin alphabet are drawn from."""

    def drawn(c: Column, r: Column) -> Column:
        latin = F.pmod(r, letters).cast("int")
        out = F.when(c.rlike("[0-9]"), _pick("0123456789", _under(r, 10))).when(c.rlike("[A-Za-z]"), _case(_LOWER, c, latin)).when(~c.rlike(r"\p{L}"), c)
        for script, signs in {"IsCyrillic": _CYR, "IsGreek": _GRE, **_SCRIPTS}.items():
            out = out.when(c.rlike(rf"\p{{{script}}}"), _case(signs, c, _under(r, len(signs))))
        return out.otherwise(_case(_LOWER, c, latin))

    return F.array_join(F.transform(F.split(text, ""), lambda c, i: _let(_number(digest, i), lambda r: drawn(c, r))), "")


def _case(letters: str, like: Column, k: Column) -> Column:
    return F.when(like.rlike(r"\p{Lu}"), F.upper(_pick(letters, k))).otherwise(_pick(letters, k))


def _luhn(digits: Column) -> Column:
    """Sum of the check rule over all digits, the last included."""
    d = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 1, F.when(c.cast("int") > 4, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)).otherwise(c.cast("int")))
    return F.aggregate(d, F.lit(0), lambda a, b: a + b)


def _plain(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _card(text: Column, made: Column) -> Column:
    """A check digit that was right is right again."""
    body = F.substr(made, F.lit(1), F.length(made) - 1)
    check = F.pmod(10 - F.pmod(_luhn(F.concat(body, F.lit("0"))), F.lit(10)), F.lit(10)).cast("string")
    return F.when(F.pmod(_luhn(text), F.lit(10)) == 0, F.concat(body, check)).otherwise(made)


def _mod97(iban: Column) -> Column:
    """The check rule of bank account numbers; 1 if the check digits are right."""
    plain = F.regexp_replace(iban, " ", "")
    chars = F.split(F.concat(F.substr(plain, F.lit(5), F.length(plain)), F.substr(plain, F.lit(1), F.lit(4))), "")
    return F.aggregate(chars, F.lit(0), lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + c.cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97))


def _iban(text: Column, made: Column) -> Column:
    """Check digits that were right are right again."""
    country, rest = F.substr(made, F.lit(1), F.lit(2)), F.substr(made, F.lit(5), F.length(made))
    check = F.lpad((98 - _mod97(F.concat(country, F.lit("00"), rest))).cast("string"), 2, "0")
    return F.when(_mod97(text) == 1, F.concat(country, check, rest)).otherwise(made)


def _ip(text: Column, digest: Column, attempt: Column) -> Column:
    def octet(o: Column, i: Column) -> Column:
        k = i * 11
        return F.when(attempt >= WIDE, 1 + _draw(digest, k, 254)).when(F.length(o) == 3, 100 + _draw(digest, k, 156)).when(F.length(o) == 2, 10 + _draw(digest, k, 90)).otherwise(1 + _draw(digest, k, 9)).cast("string")

    return F.array_join(F.transform(F.split(text, r"\."), octet), ".")


#: Country codes of one or two digits, all others have three; a trunk prefix (fixed values).
_CODE = r"^(\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})|0+|1(?=[0-9]{10}$))"


def canonical(kind: Column, mention: Column) -> Column:
    """What all forms of an entity have in common: numbers without separators, mail addresses without capitals."""
    out = F.when(kind == "phone", F.concat(F.regexp_extract(mention, r"^\+", 0), _plain(mention))).when(kind == "card", _plain(mention))
    return out.when(kind == "iban", F.regexp_replace(mention, " ", "")).when(kind == "email", F.lower(mention)).otherwise(mention)


def as_written(kind: Column, mention: Column, made: Column) -> Column:
    """A canonical entity's surrogate in the form of a mention: its separators, its capitals."""

    def spread(signs: Column) -> Column:
        before = lambda i: F.length(F.regexp_replace(F.substr(mention, F.lit(1), i + 1), "[^0-9A-Za-z]", ""))
        out = F.array_join(F.transform(F.split(mention, ""), lambda c, i: F.when(c.rlike("[0-9A-Za-z]"), F.substr(signs, before(i), F.lit(1))).otherwise(c)), "")
        return F.concat(out, F.substr(signs, F.length(F.regexp_replace(mention, "[^0-9A-Za-z]", "")) + 1, F.length(signs)))

    capitals = F.array_join(F.transform(F.split(mention, ""), lambda c, i: F.when(c.rlike(r"\p{Lu}"), F.upper(F.substr(made, i + 1, F.lit(1)))).otherwise(F.substr(made, i + 1, F.lit(1)))), "")
    out = F.when(kind.isin("phone", "card", "iban"), _let(F.regexp_replace(made, "[^0-9A-Za-z]", ""), spread))
    return out.when((kind == "email") & (F.length(mention) == F.length(made)), capitals).otherwise(made)


def _choose(names: list[str], k: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), k + 1)


def _words(name: Column) -> Column:
    return F.split(name, "[ \u00a0]")


def _person(name: Column, digest: Column, gender: Column) -> Column:
    """Word by word, so that a part of a name has the same part of its surrogate; particles stay, initials stay initials."""

    def named(script: str) -> Column:
        women, men, family = NAMES[script]
        n = min(len(women), len(men))
        # a family name is completed by drawn syllables, so that there are as many names as entities need
        letters = {"latin": ("bdfglmnrst", "aeiou"), "cyrillic": ("бвдзклмнрс", "аеиоу"), "greek": ("βγδκλμνρστ", "αειου")}[script]
        rest = F.concat(*(_pick(letters[k % 2], _draw(digest, F.lit(3 + k), len(letters[k % 2]))) for k in range(6)))
        last = F.concat(_choose(family, _draw(digest, F.lit(2), len(family))), rest)
        count = F.size(_words(name))

        def one(w: Column, i: Column) -> Column:
            k = _draw(digest, i * 13, n)
            given = F.when(gender == "f", _choose(women[:n], k)).when(gender == "m", _choose(men[:n], k)).otherwise(_choose(women[:n] + men[:n], _draw(digest, i * 13, 2 * n)))
            initial = F.concat(_case({"latin": _LOWER, "cyrillic": _CYR, "greek": _GRE}[script], w, _draw(digest, i * 17 + 1, 20)), F.lit("."))
            return F.when(w.rlike(f"^{_PARTICLE}$") & (i < count - 1), w).when(w.rlike(r"^\p{Lu}\.$"), initial).when(i == count - 1, last).otherwise(given)

        return F.array_join(F.transform(_words(name), one), " ")

    return F.when(name.rlike(r"\p{IsCyrillic}"), named("cyrillic")).when(name.rlike(r"\p{IsGreek}"), named("greek")).otherwise(named("latin"))


def surrogate(kind: Column, text: Column, attempt: Column, key: str, gender: Column | None = None) -> Column:
    """The surrogate of an entity: a function of key, type, text and attempt, and of a person's gender for given names."""
    # what stays in front and behind: a vendor's prefix, a country; the last label of a mail domain
    start = F.when(kind == "secret", F.regexp_extract(text, "^(AKIA|ghp_|sk_live_|xox[bp]-)", 1)).when(kind == "phone", F.regexp_extract(text, _CODE, 1)).when(kind == "iban", F.substr(text, F.lit(1), F.lit(2))).otherwise("")
    end = F.when(kind == "email", F.concat(F.lit("."), F.substring_index(text, ".", -1))).otherwise("")
    hexa = (kind == "ipv6") | ((kind == "secret") & text.rlike("^[0-9a-fA-F]+$"))

    def by(x: Column) -> Column:
        digest = x["digest"]
        middle = F.substr(text, F.length(x["start"]) + 1, F.length(text) - F.length(x["start"]) - F.length(x["end"]))
        like = F.concat(x["start"], _like(middle, digest, x["letters"]), x["end"])
        wide = F.substr(digest, F.lit(40), F.lit(8))

        def checked(made: Column) -> Column:
            out = F.when(kind == "card", _card(text, made)).when(kind == "iban", _iban(text, made))
            # a format with very few signs to draw has no free value left: it grows
            out = out.when((attempt >= WIDE) & (kind == "secret"), F.concat(made, wide)).when((attempt >= WIDE) & (kind == "phone"), F.concat(made, F.regexp_replace(wide, "[a-f]", "7")))
            return out.when((attempt >= WIDE) & (kind == "email"), F.concat(wide, made)).otherwise(made)

        person = _person(text, digest, F.lit("") if gender is None else gender)
        return F.when(kind == "ip", _ip(text, digest, attempt)).when(kind == "person", person).otherwise(_let(like, checked))

    digest = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, text, attempt.cast("string")), 256)
    return _let(F.struct(digest.alias("digest"), start.alias("start"), end.alias("end"), F.when(hexa, 6).otherwise(26).alias("letters")), by)


def _gender(titles: Column) -> Column:
    return F.when(titles.rlike(rf"(?<!\p{{L}})(?:{_TITLES_F})(?!\p{{L}})"), "f").when(titles.rlike(rf"(?<!\p{{L}})(?:{_TITLES_M})(?!\p{{L}})"), "m").otherwise("")


def persons(text: Column) -> Column:
    """The names after titles in a text, once per name and gender of the title, as (name, gender); null without any."""
    found = F.regexp_extract_all(text, F.lit(PATTERNS["person"]), 0)
    pair = lambda m: F.struct(F.regexp_replace(m, f"^{_TITLE}", "").alias("name"), _gender(F.regexp_extract(m, f"^{_TITLE}", 0)).alias("gender"))
    return F.when(text.rlike(TITLED), _let(F.array_distinct(F.transform(found, pair)), lambda names: F.when(F.size(names) > 0, names)))


def _in_words(word: Column, words: Column) -> Column:
    """The place (from 1) of a word in others: the same word, or for an initial the first that begins so; 0 if none."""
    begins = F.array_position(F.transform(words, lambda w: F.substr(w, F.lit(1), F.lit(1))), F.substr(word, F.lit(1), F.lit(1)))
    same = F.array_position(words, word)
    return F.when((same == 0) & word.rlike(r"^\p{Lu}\.$"), begins).otherwise(same).cast("int")


def _places(words: Column, of: Column) -> Column:
    return F.transform(words, lambda w: _in_words(w, of))


def _holds(of: Column, words: Column) -> Column:
    return F.forall(words, lambda w: _in_words(w, of) > 0)


def _fullest(p: Column, people: Column) -> Column:
    """The longest name of the document that holds all words of a name and no other gender; the name itself if none does."""
    agree = lambda q: (q["gender"] == "") | (p["gender"] == "") | (q["gender"] == p["gender"])
    more = F.filter(people, lambda q: (F.size(q["words"]) > F.size(p["words"])) & agree(q) & _holds(q["words"], p["words"]))
    ranked = F.transform(more, lambda q: F.struct((-F.size(q["words"])).alias("n"), q["place"].alias("place"), q["name"].alias("name")))
    return F.coalesce(F.array_min(ranked)["name"], p["name"])


def linked(names: Column) -> Column:
    """The persons of a document: (name, gender, full: the fullest form of the name, words: its words, place, known: the gender of any of its forms)."""
    split = F.transform(names, lambda p, i: F.struct(p["name"].alias("name"), p["gender"].alias("gender"), _words(p["name"]).alias("words"), i.alias("place")))
    each = lambda people: F.transform(people, lambda p: F.struct(p["name"].alias("name"), p["gender"].alias("gender"), p["place"].alias("place"), _fullest(p, people).alias("full")))
    known = lambda p, people: F.array_max(F.transform(F.filter(people, lambda q: q["full"] == p["full"]), lambda q: q["gender"]))
    told = lambda people: F.transform(people, lambda p: F.struct(p["name"].alias("name"), p["gender"].alias("gender"), p["full"].alias("full"), _words(p["full"]).alias("words"), p["place"].alias("place"), known(p, people).alias("known")))
    return _let(_let(split, each), told)


def any_of(names: Column, text: Column) -> Column:
    """The pattern of all entities of a document: ``ANY``, and its persons' names and their first and last words without a title.

    A word alone that is also an ordinary word (one of ``ORDINARY``, or one that the text has without its capital) needs a
    second signal: it stands within a sentence, after a word in small letters that isn't one of ``_AFTER``.
    """
    ends = lambda p: F.array(p["name"], F.element_at(_words(p["name"]), 1), F.element_at(_words(p["name"]), -1))
    forms = F.filter(F.array_distinct(F.flatten(F.transform(names, ends))), lambda w: (F.length(w) > 1) & ~w.rlike(rf"^(?:\p{{Lu}}\.|{_PARTICLE})$"))
    small = F.split(text, r"[^\p{L}\p{M}'’-]+")
    common = lambda fs: F.array_intersect(F.transform(fs, F.lower), F.concat(F.array(*map(F.lit, ORDINARY)), small))
    # the longest first
    quoted = lambda ws: F.array_join(F.transform(F.array_sort(F.transform(ws, lambda w: F.struct((-F.length(w)).alias("n"), w.alias("w")))), lambda x: F.concat(F.lit(r"\Q"), x["w"], F.lit(r"\E"))), "|")
    begin, after = r"|(?<![\p{L}\p{M}\p{N}_])(?<!\p{L}['’-])", r")(?![\p{L}\p{M}\p{N}_]|-\p{L}|['’]\p{Lu})"
    within = rf"(?<=\p{{Ll}} )(?<!(?<![\p{{L}}])(?:{_AFTER}) )"
    part = lambda ws, signal: F.when(F.size(ws) > 0, F.concat(F.lit(f"{begin}{signal}(?:"), quoted(ws), F.lit(after))).otherwise("")

    def pattern(x: Column) -> Column:
        doubtful = lambda w: F.array_contains(x["common"], F.lower(w))
        return F.concat(F.lit(ANY), part(F.filter(x["forms"], lambda w: ~doubtful(w)), ""), part(F.filter(x["forms"], doubtful), within))

    return _let(_let(forms, lambda fs: F.struct(fs.alias("forms"), common(fs).alias("common"))), pattern)


def mentions(text: Column, people: Column, pattern: Column) -> Column:
    """The entities of a text in order, as (kind, text, gender, lead, at, raw): the entity in its canonical form (a person's
    fullest name) and as written; ``lead``: a person's titles, ``at``: the words meant."""
    found = F.when(text.rlike(HINT), F.regexp_extract_all(text, pattern, 0)).otherwise(F.array().cast("array<string>"))

    def mention(kind: Column, text: Column, gender: Column, lead: Column, at: Column, raw: Column) -> Column:
        return F.struct(kind.alias("kind"), text.alias("text"), gender.alias("gender"), lead.alias("lead"), at.cast("array<int>").alias("at"), raw.alias("raw"))

    def person(m: Column) -> Column:
        lead = F.regexp_extract(m, f"^{_TITLE}", 0)
        parts = F.struct(lead.alias("lead"), F.regexp_replace(m, f"^{_TITLE}", "").alias("name"), _gender(lead).alias("gender"))
        return _let(_let(parts, lambda x: F.struct(x["lead"].alias("lead"), x["name"].alias("name"), _words(x["name"]).alias("words"), who(x).alias("who"))), meant)

    def who(x: Column) -> Column:
        titled = F.filter(people, lambda p: (x["lead"] != "") & (p["name"] == x["name"]) & (p["gender"] == x["gender"]))
        # without a title: the person with the fullest name that has all the words
        bare = F.filter(people, lambda p: _holds(p["words"], _words(x["name"])))
        best = F.array_min(F.transform(bare, lambda p: F.struct((-F.size(p["words"])).alias("n"), p["place"].alias("place"), p.alias("p"))))["p"]
        return F.coalesce(F.get(titled, F.lit(0)), best)

    def meant(x: Column) -> Column:
        at = F.when(x["who"]["full"] != x["name"], _places(x["words"], x["who"]["words"]))
        return mention(F.lit("person"), F.coalesce(x["who"]["full"], x["name"]), F.coalesce(x["who"]["known"], F.lit("")), x["lead"], at, x["name"])

    def one(x: Column) -> Column:
        return F.when(x["kind"] == "person", person(x["m"])).otherwise(mention(x["kind"], canonical(x["kind"], x["m"]), F.lit(""), F.lit(""), F.lit(None), x["m"]))

    # numbers that only their check digit makes card numbers; those without it have no type and stay
    asked = F.when(F.exists(found, lambda m: m.rlike(f"^(?:{_CARD})$")), F.regexp_extract_all(text, pattern, 1))
    checked = lambda m: F.when(F.pmod(_luhn(_plain(m)), F.lit(10)) == 0, "card")
    kind = lambda m, guarded: F.when(F.length(guarded) > 0, checked(m)).otherwise(kind_of(m))
    typed = F.zip_with(found, F.coalesce(asked, F.array().cast("array<string>")), lambda m, g: F.struct(kind(m, g).alias("kind"), m.alias("m")))
    return F.transform(typed, one)


def _found(docs: DataFrame) -> DataFrame:
    """The documents with their pattern (``__any``) and mentions (``__m``)."""
    text = F.col("text")
    people = docs.withColumn("__names", persons(text)).withColumn("__any", F.when(F.col("__names").isNotNull(), any_of(F.col("__names"), text)).otherwise(F.lit(ANY)))
    return people.withColumn("__who", linked(F.col("__names"))).withColumn("__m", mentions(text, F.col("__who"), F.col("__any")))


def resolved(entities: DataFrame, key: str, rounds: int = 50) -> DataFrame:
    """Entities (kind, text, distinct; gender, mixed) that need a further attempt, with their surrogates, so that all of a kind differ and none occurs.

    ``mixed`` ones, whose gender is not known in every document, are given too.
    """
    rule = surrogate(F.col("kind"), F.col("text"), F.col("attempt"), key, F.col("gender"))
    made = lambda df: df.withColumn("surrogate", rule)
    now = cut_lineage(made(entities.withColumn("attempt", F.lit(0))))
    real = now.select("kind", F.col("text").alias("surrogate"), F.lit(True).alias("real"))
    again: DataFrame | None = None
    for _ in range(rounds):
        w = Window.partitionBy("kind", "surrogate").orderBy("attempt", "text")
        judged = now.withColumn("place", F.row_number().over(w)).join(real, ["kind", "surrogate"], "left")
        bad = judged.filter("place > 1 OR real").select("kind", "text", "gender", "mixed", "attempt")
        again = cut_lineage(bad)
        if again.isEmpty():
            return now.filter("attempt > 0 OR mixed").select("kind", "text", "surrogate")
        moved = made(again.withColumn("attempt", F.col("attempt") + 1))
        now = cut_lineage(now.join(again, ["kind", "text"], "left_anti").unionByName(moved.select(now.columns)))
    raise RuntimeError("surrogates still collide: the format of a type has too few values for its entities")


def replace_entities(docs: DataFrame, key: str) -> DataFrame:
    """The documents with every entity replaced, their columns as they came (n_chars anew), and ``n_entities`` (a column of
    that name is replaced). ``key``: the secret that surrogates are derived from.

    Texts are matched once: documents, mentions and what lies between them are written to the shared folder. Only entities
    whose surrogate isn't the first attempt go back to the documents that mention them, as rows; nothing of the texts is
    collected or written into a plan.
    """
    spark, cols = docs.sparkSession, [c for c in docs.columns if c != "n_entities"]
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in cols)).alias("d"), F.col("text"))
    some = F.size("__m") > 0
    made = _found(whole).withColumn("__parts", F.when(some, F.split("text", F.col("__any"), -1))).withColumn("__row", F.monotonically_increasing_id())
    at = shared_path(spark, "mentions")
    made.select("d", "__m", "__parts", "__row").write.option("compression", "zstd").parquet(at)
    saved = spark.read.parquet(at)
    found = saved.select(F.explode("__m").alias("m")).filter("m.kind IS NOT NULL")
    entities = found.groupBy("m.kind", "m.text").agg(F.max("m.gender").alias("gender"), (F.min("m.gender") < F.max("m.gender")).alias("mixed"))
    moved = resolved(entities, key)

    named = lambda kind, text: F.concat_ws("\x1f", kind, text)
    hit = saved.select("__row", F.explode("__m").alias("m")).filter("m.kind IS NOT NULL").select("__row", "m.kind", "m.text").distinct().join(moved, ["kind", "text"])
    maps = cut_lineage(hit.groupBy("__row").agg(F.map_from_entries(F.collect_list(F.struct(named(F.col("kind"), F.col("text")), "surrogate"))).alias("__other")))
    loud = saved.filter(some).join(maps, "__row", "left")
    first = lambda m: surrogate(m["kind"], m["text"], F.lit(0), key, m["gender"])
    # a shorter mention has the words of the surrogate that stand where its words stand in the full name
    part = lambda m, words: F.array_join(F.transform(m["at"], lambda k: F.try_element_at(words, k)), " ")
    woven_name = lambda m, made: _let(made, lambda s: F.concat(m["lead"], F.when(m["at"].isNull(), as_written(m["kind"], m["raw"], s)).otherwise(part(m, _words(s)))))
    meant = lambda m, made: F.when(m["kind"].isNull(), m["raw"]).otherwise(woven_name(m, made))
    shown = F.transform("__m", lambda m: meant(m, F.coalesce(F.try_element_at("__other", named(m["kind"], m["text"])), first(m))))
    woven = F.concat(F.array_join(F.zip_with(F.slice("__parts", 1, F.size("__m")), shown, lambda p, s: F.concat(p, s)), ""), F.element_at("__parts", -1))
    loud = loud.withColumn("__new", woven).withColumn("n_entities", F.size(F.filter("__m", lambda m: m["kind"].isNotNull())).cast("long"))
    quiet = saved.filter(~some | F.col("__m").isNull()).select("d", F.col("d.text").alias("__new"), F.lit(0).cast("long").alias("n_entities"))
    out = {"text": F.col("__new"), "n_chars": F.length("__new").cast("long")}
    both = quiet.unionByName(loud.select("d", "__new", "n_entities"))
    return both.select(*(out.get(c, F.col("d")[c]).alias(c) for c in cols), "n_entities")


def key_of(spark: SparkSession) -> str:
    """The secret named in the session's settings; where there is none, the open one, whose surrogates anyone can derive."""
    return spark.conf.get(KEY_SETTING, OPEN_KEY)


def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_entities(table(spark, sf_dir, "documents").select("doc_id", "text"), key_of(spark))
