"""PII surrogates, by DataFrame and SQL functions only.

Detected entities receive keyed replacements of their own kind: digits stay
digits and letters stay letters of their script, e-mail addresses, numbers,
addresses and tokens keep their format, cards and account numbers keep valid
check digits, names keep their title, script and gender. What is replaced is an
*atom*, the entity without its formatting (a phone number's digits, an address
in lower case, one word of a name), so one person or number has one surrogate
wherever and however it is written. A surrogate that two atoms share, or that is
itself an atom of the input, is drawn again until all are distinct.

A name is found by a title or by a common given name before a capitalised word;
its words are then found again wherever they stand alone in the same text. A
given name's gender is that of its title, else that of a title before the same
name in the text, else the list's it is in, else by its ending.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.lineage import materialize
from .common import table, unused

KEY = "surrogate-key-1"
#: From this draw on a surrogate gets longer with each draw, so that a kind whose format is used up still ends distinct.
CROWDED = 24
MOST_ATTEMPTS = 64

#: Titles before names.
MALE_TITLES = "Mr|Herr|Herrn|Monsieur|Señor|Sr|Signor|Господин|Κύριος"
FEMALE_TITLES = "Mrs|Ms|Miss|Frau|Madame|Mme|Mlle|Señora|Señorita|Sra|Signora|Госпожа|Κυρία"
OPEN_TITLES = "Dr|Prof|Dra|Доктор|Δρ"
TITLES = f"{MALE_TITLES}|{FEMALE_TITLES}|{OPEN_TITLES}"
#: Common given names by gender and script. Surrogates are drawn from them, and they show names that have no title.
GIVEN = {
    ("m", "l"): "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jakob Karl Leo Martin Nils Oscar Paul Robert Simon Thomas Victor James John Michael William Richard Joseph Charles Daniel Peter Hans Jürgen Stefan Pierre Jean Jacques Louis José Juan Carlos Luis",
    ("f", "l"): "Anna Berta Clara Diana Emma Flora Greta Helena Irene Julia Karin Laura Maria Nora Olivia Paula Rosa Sara Teresa Vera Mary Patricia Jennifer Linda Elizabeth Susan Jessica Sarah Karen Nancy Sabine Petra Ursula Marie Sophie Camille María Carmen Lucía Isabel",
    ("m", "c"): "Антон Борис Виктор Глеб Денис Егор Захар Игорь Кирилл Лев Максим Никита Олег Павел Роман Семён",
    ("f", "c"): "Анна Вера Галина Дарья Елена Жанна Зоя Ирина Ксения Лидия Мария Нина Ольга Полина Раиса Софья",
    ("m", "g"): "Αλέξανδρος Βασίλης Γιώργος Δημήτρης Ηλίας Κώστας Μιχάλης Νίκος Πέτρος Σταύρος",
    ("f", "g"): "Άννα Βασιλική Γεωργία Δήμητρα Ελένη Κατερίνα Μαρία Νίκη Σοφία Χριστίνα",
}
SYLLABLES = {
    "l": "bal ber bor dan der dor fal fen gar gel hal hen kal kel lan len mar mel nor pal per ral ren sal ser tan ter val ven wal",
    "c": "бал бер бор дан дер дор гар гел кал кел лан лен мар мел нор пал пер рал рен сал сер тан тер вал вен",
    "g": "βαλ βερ γαλ γερ δαν δερ καλ κελ λαν λεν μαρ μελ νορ παλ περ ραν ρεν σαλ σερ ταν τερ φαλ φεν χαρ",
}
#: Scripts whose names are drawn letter by letter.
LETTERS = {"z": "王李张刘陈杨黄赵周吴徐孙马朱胡林郭何高罗", "a": "بتثجحخدرزسشصطعفقكلمنهوي", "h": "אבגדהוזחטיכלמנסעפצקרשת"}
SCRIPTS = {"c": "IsCyrillic", "g": "IsGreek", "z": "IsHan", "a": "IsArabic", "h": "IsHebrew"}

LATIN, ACCENTED, CYRILLIC, GREEK = "abcdefghijklmnopqrstuvwxyz", "àáâäçèéêëíîïñóôöùúûü", "абвгдежзиклмнопрстуфхцчшэюя", "αβγδεζηθικλμνξοπρστυφχψω"
MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December|Januar|Februar|März|Mai|Juni|Juli|Oktober|Dezember|janvier|février|mars|avril|mai|juin|juillet|août|septembre|octobre|novembre|décembre|enero|febrero|marzo|abril|mayo|junio|julio|agosto|septiembre|octubre|noviembre|diciembre"

# Every pattern stands behind ENTITY's own lookbehind: no letter or digit before it.
_END = r"(?![\p{L}\p{N}])"
EMAIL = r"(?<![._+-])[\p{L}\p{N}_][\p{L}\p{N}._+-]*+@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++){0,120}\.(?:\p{L}{2,}+|xn--[\p{L}\p{N}-]++)"
SECRET = r"""(?i:(?:auth_|access_|api_)?token|(?:client_)?secret|password|passwd|api[_-]?key|(?:access|secret|private)_key)["']?\s{0,2}[:=]\s{0,2}["']?(?:[\p{L}\p{N}+/_.~-]{11,}+[\p{L}\p{N}=]{0,3}|(?=\p{L}*+\p{N})[\p{L}\p{N}+/_-]{6,})"""
TOKEN = rf"(?:[0-9a-f]{{32,}}+|[0-9A-F]{{32,}}+|(?:AKIA|ASIA)[0-9A-Z]{{16}}|gh[pousr]_[0-9A-Za-z]{{20,}}+|sk-[0-9A-Za-z_-]{{20,}}+|xox[baprs]-[0-9A-Za-z-]{{10,}}+|AIza[0-9A-Za-z_-]{{35}}|eyJ[0-9A-Za-z_-]{{8,}}+\.[0-9A-Za-z_-]{{8,}}+\.[0-9A-Za-z_-]{{8,}}+){_END}"
KEY_PREFIX = r"^(?:AKIA|ASIA|gh[pousr]_|sk-|xox[baprs]-|AIza|eyJ)"
IP = r"(?=\d)(?<![.])(?<!(?i:version|release|build|ver\.|ver|v\.)\s)(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)\.){3}(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?!\p{N}|\.\p{N})"
IPV6 = r"(?=[0-9A-Fa-f:]{0,39}\d)(?<![:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![\p{L}\p{N}:])"
PHONE = r"(?:(?<!\+)\+\d{1,3}(?:[ .-]?\(\d{1,4}\))?(?:[ .-]?\d{1,4}){2,7}|00[1-9]\d{0,2}[ .-]\(?\d{1,4}\)?(?:[ .-]?\d{1,4}){1,6}|\(\d{3}\) ?\d{3}[ .-]\d{4}|(?<![.-])\d{3}[.-]\d{3}[.-]\d{4}|0[1-9](?:[ .]\d{2}){4}|\(?0[1-9]\d{1,3}\)?[ /]\d{5,8})(?![\p{N}-])"
SSN = r"(?<!-)\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}-])"
IBAN = rf"[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{3,7}}(?: ?[A-Z0-9]{{1,3}})?{_END}"
CARD = rf"(?:\d{{16}}|[3-6]\d{{12,18}}|\d{{4}}-\d{{4}}-\d{{4}}-\d{{4}}|\d{{4}} \d{{4}} \d{{4}} \d{{4}}|3\d{{3}} \d{{6}} \d{{5}}){_END}"
BIRTH_MARK = r"(?i:born(?: on)?|date of birth|dob|geboren(?: am)?|geb\.|née? le|nacid[oa] el|fecha de nacimiento)[\s:]{1,3}"
BIRTH = rf"{BIRTH_MARK}(?:\d{{4}}-\d{{2}}-\d{{2}}|\d{{1,2}}[./-]\d{{1,2}}[./-]\d{{4}}|\d{{1,2}}\.?(?: de)? (?:{MONTHS})(?: de)? \d{{4}}|(?:{MONTHS}) \d{{1,2}}, \d{{4}}){_END}"
_STREETS = r"Street|St\.|Avenue|Ave\.|Road|Rd\.|Lane|Drive|Boulevard|Blvd\."
_WEGE = r"straße|strasse|str\.|weg|platz|gasse|allee"
_CALLES = r"rue|avenue|boulevard|calle|Calle|avenida|Avenida|plaza|Plaza"
ADDRESS = rf"(?:\d{{1,5}}[a-z]? \p{{Lu}}\p{{Ll}}++ (?:{_STREETS})|\p{{Lu}}\p{{Ll}}+?(?:{_WEGE}) \d{{1,4}}[a-z]?{_END}|\d{{1,4}},? (?:{_CALLES})(?: d(?:e|u|el)(?: la)?)? \p{{Lu}}\p{{Ll}}++|(?:{_CALLES})(?: d(?:e|u|el)(?: la)?)? \p{{Lu}}\p{{Ll}}++,? \d{{1,4}}{_END})"
STREET_NAME = rf"\p{{Lu}}\p{{Ll}}+?(?=(?:{_WEGE}) \d)|\p{{Lu}}\p{{Ll}}+(?= (?:{_STREETS}))|(?<=(?:{_CALLES}| la| de| du| del) )\p{{Lu}}\p{{Ll}}+"
_WORD = r"(?:\p{Lu}\p{L}++(?:[-'’]\p{Lu}\p{L}++)*+|\p{Lu}['’]\p{Lu}\p{L}++|[\p{IsHan}\p{IsArabic}\p{IsHebrew}]{2,}+)"
PARTICLES = "von|van|der|den|de|del|di|da|la|du"
_NAMED = "|".join(n for names in GIVEN.values() for n in names.split())
NAME = rf"(?:(?:{TITLES})\.?\s{_WORD}(?:(?:\s(?:{PARTICLES})){{0,2}}\s{_WORD}){{0,3}}|(?=\p{{Lu}})(?:{_NAMED})(?:(?:\s(?:{PARTICLES})){{0,2}}\s{_WORD}){{1,2}}){_END}"
KINDS = {"email": EMAIL, "secret": SECRET, "birth": BIRTH, "ipv6": IPV6, "ip": IP, "ssn": SSN, "card": CARD, "phone": PHONE, "iban": IBAN, "token": TOKEN, "address": ADDRESS, "name": NAME}
ENTITY = rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join(KINDS.values())})"
_TITLED = rf"(?:{TITLES}|{_NAMED})"
#: An entity has an at-sign, a digit, an assignment or a name; most texts have none of the first and are looked through once.
HINT = rf"[@0-9:=]|(?=\p{{Lu}})(?<!\p{{L}}){_TITLED}(?:\.\s|\s)"


#: Where a string is split into its characters.
CHARACTERS = "(?s)(?<=.)(?=.)"


def _list(words: str) -> Column:
    return F.split(F.lit(words), " ")


def entities(text: Column, pattern: Column | None = None) -> Column:
    """All entities of a text, from left to right, without overlaps, those among them that are none by their check digits."""
    held = F.regexp_extract_all(text, F.lit(ENTITY) if pattern is None else pattern, F.lit(0))
    return F.when(text.rlike(HINT), held).otherwise(F.array().cast("array<string>"))


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum of a string of digits."""
    d = F.reverse(F.split(digits, CHARACTERS))
    doubled = F.transform(d, lambda c, i: F.when(i % 2 == 0, c.try_cast("int")).otherwise(2 * c.try_cast("int") - F.when(c.try_cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(doubled, F.lit(0), lambda s, x: s + x)


def iban_rest(value: Column) -> Column:
    """The remainder by 97 of an account number written without blanks."""
    moved = F.concat(F.substring(value, F.lit(5), F.length(value)), F.substring(value, 1, 4))
    return F.aggregate(F.split(moved, CHARACTERS), F.lit(0), lambda a, c: F.when(c.rlike("[0-9]"), (a * 10 + c.try_cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97).cast("int"))


def kind_of(entity: Column) -> Column:
    """The first kind whose pattern the whole entity has; a lone word of a name is what is left.

    Digits that have the form of a card or a phone number but not its check digit
    or length are ``none``.
    """
    digits = F.regexp_replace(entity, r"\D", "")
    out = F.lit("name")
    for kind, pattern in reversed(KINDS.items()):
        fits = entity.rlike(f"^(?:{pattern})$")
        if kind == "card":
            out = F.when(fits, F.when(luhn_sum(digits) % 10 == 0, F.lit("card")).otherwise(F.lit("none"))).otherwise(out)
        elif kind == "phone":
            out = F.when(fits, F.when(F.length(digits).between(7, 17), F.lit("phone")).otherwise(F.lit("none"))).otherwise(out)
        else:
            out = F.when(fits, F.lit(kind)).otherwise(out)
    return out


def _title(entity: Column) -> Column:
    return F.regexp_extract(entity, rf"^(?:(?:{TITLES})\.?\s+)?", 0)


def _plain(word: Column) -> Column:
    """A word of a name however it is written: with capitals at its start only."""
    return F.initcap(word)


def _in_lists(word: Column, gender: str | None = None) -> Column:
    return _plain(word).isin([n.lower().capitalize() for (g, _), names in GIVEN.items() if gender in (None, g) for n in names.split()])


def names_of(found: Column) -> Column:
    """Names among the entities: structs of the title's gender (m, f or null) and the words without particles."""

    def parsed(e: Column) -> Column:
        entity = e["entity"]
        gender = F.when(entity.rlike(rf"^(?:{FEMALE_TITLES})\b"), "f").when(entity.rlike(rf"^(?:{MALE_TITLES})\b"), "m")
        words = F.filter(F.split(F.regexp_replace(entity, rf"^(?:(?:{TITLES})\.?\s+)?", ""), r"\s+"), lambda w: ~w.rlike(rf"^(?:{PARTICLES})$"))
        return F.struct(gender.alias("gender"), F.transform(words, _plain).alias("words"), words.alias("written"))

    return F.transform(F.filter(found, lambda e: e["kind"] == "name"), parsed)


def _families(names: Column) -> Column:
    return F.array_distinct(F.flatten(F.transform(names, lambda n: F.when(F.size(n["words"]) > 1, F.slice(n["words"], -1, 1)).otherwise(F.array().cast("array<string>")))))


def _givens(names: Column) -> Column:
    """Structs of each given name and its title's gender."""
    own = lambda n: F.when(F.size(n["words"]) > 1, F.slice(n["words"], 1, F.size(n["words"]) - 1)).otherwise(F.filter(n["words"], lambda w: _in_lists(w)))
    return F.flatten(F.transform(names, lambda n: F.transform(own(n), lambda w: F.named_struct(F.lit("word"), w, F.lit("gender"), n["gender"]))))


def lone_pattern(names: Column) -> Column:
    """The pattern of a text's entities and of the words of its names."""
    words = F.array_distinct(F.flatten(F.transform(names, lambda n: n["written"])))
    written = F.array_sort(F.array_distinct(F.concat(words, F.transform(words, F.upper), F.transform(words, _plain))))
    return F.when(F.size(words) == 0, F.lit(ENTITY)).otherwise(F.concat(F.lit(ENTITY + r"|(?<![\p{L}\p{N}])(?:"), F.array_join(written, "|"), F.lit(r")(?![\p{L}\p{N}])")))


def _script(word: Column) -> Column:
    out = F.lit("l")
    for code, name in SCRIPTS.items():
        out = F.when(word.rlike(rf"\p{{{name}}}"), code).otherwise(out)
    return out


def _gender(word: Column, title: Column, givens: Column) -> Column:
    told = F.filter(givens, lambda g: (g["word"] == _plain(word)) & g["gender"].isNotNull())
    return F.coalesce(title, F.get(told, F.lit(0))["gender"], F.when(_in_lists(word, "f"), "f").when(_in_lists(word, "m"), "m"), F.when(word.rlike("[aаяαηάή]$"), "f").otherwise("m"))


def atoms_of(kind: Column, entity: Column, families: Column, givens: Column) -> Column:
    """The atoms of an entity: structs of kind and value; ``same`` stays as it is."""
    digits = F.regexp_replace(entity, r"\D", "")
    title = F.when(entity.rlike(rf"^(?:{FEMALE_TITLES})\b"), "f").when(entity.rlike(rf"^(?:{MALE_TITLES})\b"), "m")
    words = F.split(F.regexp_replace(entity, rf"^(?:(?:{TITLES})\.?\s+)?", ""), r"\s+")
    last = F.size(words) - 1
    particle = lambda w: w.rlike(rf"^(?:{PARTICLES})$")
    alone = F.when(F.array_contains(families, _plain(words[0])), False).otherwise(F.exists(givens, lambda g: g["word"] == _plain(words[0])) | _in_lists(words[0]))

    def named(w: Column, i: Column) -> Column:
        is_given = F.when(last == 0, alone).otherwise(i < last)
        label = F.when(particle(w), "same").when(is_given, F.concat(F.lit("given_"), _gender(w, title, givens), _script(w))).otherwise(F.concat(F.lit("family_"), _script(w)))
        return F.struct(label.alias("kind"), F.when(particle(w), w).otherwise(_plain(w)).alias("value"))

    one = (
        F.when(kind.isin("ssn", "card"), digits)
        .when(kind == "phone", F.regexp_replace(digits, "^00", ""))
        .when(kind == "iban", F.replace(entity, F.lit(" "), F.lit("")))
        .when(kind.isin("email", "ipv6"), F.lower(entity))
        .when(kind == "secret", F.regexp_extract(entity, _SECRET_SPLIT, 2))
        .when(kind == "birth", F.regexp_replace(entity, rf"^{BIRTH_MARK}", ""))
        .otherwise(entity)
    )
    label = F.when(kind == "secret", "token").otherwise(kind)
    return F.when(kind == "name", F.transform(words, named)).otherwise(F.array(F.struct(label.alias("kind"), one.alias("value"))))


_SECRET_SPLIT = r"""(?s)^([^:=]*[:=]\s{0,2}["']?)(.*)$"""


def _byte(stream: Column, at: Column) -> Column:
    """One of the 64 bytes of a digest in hex; a long value turns the digest round."""
    return (F.conv(F.substring(stream, 1 + 2 * (at % 64).cast("int"), F.lit(2)), 16, 10).cast("int") + 37 * F.floor(at / 64).cast("int")) % 256


def _drawn(value: Column, stream: Column, keep: Column) -> Column:
    """``value`` with each letter and digit drawn anew from its own class, after the first ``keep`` characters."""
    classes = [("[0-9]", "0123456789"), ("[a-z]", LATIN), ("[A-Z]", LATIN.upper())]
    classes += [(f"[{low}]", low) for low in (ACCENTED, CYRILLIC, GREEK)] + [(f"[{low.upper()}]", low.upper()) for low in (ACCENTED, CYRILLIC, GREEK)]
    classes += [(rf"\p{{{SCRIPTS[s]}}}", letters) for s, letters in LETTERS.items()]

    def one(c: Column, i: Column) -> Column:
        out = c
        for of, among in reversed(classes):
            out = F.when(c.rlike(of), F.substring(F.lit(among), 1 + _byte(stream, i) % len(among), F.lit(1))).otherwise(out)
        return F.when(i < keep, c).otherwise(out)

    return F.array_join(F.transform(F.split(value, CHARACTERS), one), "")


def _hex(value: Column, stream: Column) -> Column:
    return F.array_join(F.transform(F.split(value, CHARACTERS), lambda c, i: F.substring(F.lit("0123456789abcdef"), 1 + _byte(stream, i) % 16, F.lit(1))), "")


def _dated(value: Column, stream: Column) -> Column:
    """A date in the same form: day and month at most 12, so that both orders are dates; a year from 1940 on."""
    number = lambda at, low, n: (low + _byte(stream, F.lit(at)) % n).cast("string")

    def part(x: Column, i: Column) -> Column:
        small = F.when(i <= 1, number(1, 1, 12)).otherwise(number(2, 1, 12))
        return F.when(x.rlike(r"^\d{4}$"), number(0, 1940, 65)).when(x.rlike(r"^\d{2}$"), F.lpad(small, 2, "0")).when(x.rlike(r"^\d$"), F.substring(F.lit("123456789"), 1 + _byte(stream, i) % 9, F.lit(1))).otherwise(x)

    return F.array_join(F.transform(F.regexp_extract_all(value, F.lit(r"\d+|\D+"), F.lit(0)), part), "")


def with_surrogate(atoms: DataFrame, key: str = KEY) -> DataFrame:
    """Add ``surrogate`` to rows of (kind, value, attempt)."""
    value, kind, attempt = F.col("value"), F.col("kind"), F.col("attempt")
    h = F.sha2(F.concat_ws("|", F.lit(key), "kind", "value", attempt.cast("string")), 512)
    df = atoms.withColumn("h", h).withColumn("hd", F.sha2(F.concat_ws("|", F.lit(key), F.lit("domain"), F.substring_index("value", "@", -1)), 512))
    h, hd = F.col("h"), F.col("hd")
    keep = F.when(kind == "phone", 1).when(kind == "iban", 4).when(kind == "token", F.length(F.regexp_extract("value", KEY_PREFIX, 0))).otherwise(0)
    df = df.withColumn("drawn", F.when(kind.isin("email", "ip", "birth", "address") | kind.rlike("_[lcg]$|_.[lcg]$"), F.lit("")).otherwise(_drawn(value, h, keep)))
    drawn = F.col("drawn")
    body = F.expr("substring(drawn, 1, length(drawn) - 1)")
    card = F.concat(body, ((10 - luhn_sum(F.concat(body, F.lit("0"))) % 10) % 10).cast("string"))
    account = F.concat(F.substring(value, 1, 2), F.lit("00"), F.expr("substring(drawn, 5)"))
    checked = F.concat(F.substring(value, 1, 2), F.lpad((98 - iban_rest(account)).cast("string"), 2, "0"), F.expr("substring(drawn, 5)"))
    iban = F.when(iban_rest(value) == 1, checked).otherwise(F.concat(F.substring(value, 1, 2), _drawn(F.substring(value, 3, 2), hd, F.lit(0)), F.expr("substring(drawn, 5)")))
    local, host = F.substring_index("value", "@", 1), F.substring_index("value", "@", -1)
    top = F.substring_index(host, ".", -1)
    inner = F.substring(host, F.lit(1), F.length(host) - F.length(top))
    email = F.concat(_drawn(local, h, F.lit(0)), F.lit("@"), _drawn(inner, hd, F.lit(0)), top)
    ip = F.concat_ws(".", (1 + _byte(h, F.lit(0)) % 223).cast("string"), *((_byte(h, F.lit(k)) % 255).cast("string") for k in (1, 2, 3)))
    ipv6 = F.array_join(F.transform(F.split(value, CHARACTERS), lambda c, i: F.when(c == ":", c).otherwise(F.substring(F.lit("123456789abcdef"), 1 + _byte(h, i) % 15, F.lit(1)))), "")
    token = F.when(value.rlike("^[0-9a-f]+$"), _hex(value, h)).when(value.rlike("^[0-9A-F]+$"), F.upper(_hex(value, h))).otherwise(drawn)
    syllable = lambda s, k: F.get(_list(SYLLABLES[s]), _byte(h, F.lit(k)) % len(SYLLABLES[s].split()))
    out = F.when(kind == "card", card).when(kind == "iban", iban).when(kind == "email", email).when(kind == "ip", ip).when(kind == "ipv6", ipv6).when(kind == "token", token).when(kind == "birth", _dated(value, h))
    for (g, s), names in GIVEN.items():
        # A given name is one of a short list while it is free, then gets syllables too.
        longer = F.concat(F.get(_list(names), _byte(h, F.lit(0)) % len(names.split())), F.lit("-"), F.initcap(F.concat(*(syllable(s, k) for k in (1, 2, 3)))))
        out = out.when(kind == f"given_{g}{s}", F.when(attempt >= 4, longer).otherwise(F.get(_list(names), _byte(h, F.lit(0)) % len(names.split()))))
    for s in SYLLABLES:
        out = out.when(kind == f"family_{s}", F.initcap(F.concat(*(syllable(s, k) for k in (1, 2, 3)), *(F.when(attempt >= k, syllable(s, 3 + k)).otherwise("") for k in (1, 2, 3)))))
    street = F.initcap(F.concat(*(syllable("l", k) for k in (1, 2, 3))))
    house = (1 + (_byte(h, F.lit(5)) * 256 + _byte(h, F.lit(6))) % 999).cast("string")
    out = out.when(kind == "address", F.regexp_replace(F.regexp_replace(value, F.lit(STREET_NAME), street), F.lit(r"\d+"), house)).otherwise(drawn)
    more = F.when(kind.rlike("^(?:given|family)_"), F.translate(h, "0123456789", "ghijklmnop")).otherwise(F.regexp_replace(h, "[a-f]", ""))
    crowded = F.when(attempt >= CROWDED, F.substring(more, F.lit(1), attempt - (CROWDED - 1))).otherwise("")
    return df.withColumn("surrogate", F.concat(out, crowded)).drop("h", "hd", "drawn")


def assign_surrogates(atoms: DataFrame, key: str = KEY) -> DataFrame:
    """``(kind, value, surrogate)`` for distinct rows of (kind, value).

    Within a kind no two values share a surrogate and no surrogate is a value.
    Of values that draw the same surrogate the smallest keeps it; the others, and
    those that draw an existing value, draw again. The values left shrink by
    orders of magnitude each time, and where a format has no free value left,
    surrogates become longer.
    """
    atoms = materialize(atoms.select("kind", "value").distinct(), "atoms")
    taken = None
    waiting = atoms
    for attempt in range(MOST_ATTEMPTS):
        drawn = materialize(with_surrogate(waiting.select("kind", "value", F.lit(attempt).alias("attempt")), key), "drawn")
        real = atoms.select("kind", F.col("value").alias("surrogate"))
        free = drawn.join(real, ["kind", "surrogate"], "left_anti")
        if taken is not None:
            free = free.join(taken.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        won = materialize(free.groupBy("kind", "surrogate").agg(F.min("value").alias("value")).select("kind", "value", "surrogate"), "won")
        taken = won if taken is None else taken.unionByName(won)
        waiting = materialize(drawn.select("kind", "value").join(won.select("kind", "value"), ["kind", "value"], "left_anti"), "waiting")
        if waiting.limit(1).count() == 0:
            return taken
    raise RuntimeError(f"surrogates still collide after {MOST_ATTEMPTS} draws")


def _filled(entity: Column, slots: str, drawn: Column) -> Column:
    """The characters of ``drawn`` in the entity's slots, what is between them kept; what is left over comes last."""
    blanks = F.split(entity, slots, -1)
    return F.array_join(F.zip_with(blanks, F.split(drawn, CHARACTERS), lambda gap, c: F.concat(F.coalesce(gap, F.lit("")), F.coalesce(c, F.lit("")))), "")


def _put(kind: Column, entity: Column, drawn: Column) -> Column:
    """The surrogate in the entity's own format. ``drawn``: the surrogates of its atoms."""
    first = F.element_at(drawn, 1)
    zeros = F.when(entity.rlike("^00[1-9]"), "00").otherwise("")
    phone = F.concat(zeros, _filled(F.regexp_replace(entity, "^00(?=[1-9])", ""), "[0-9]", first))
    words = F.split(F.regexp_replace(entity, rf"^(?:(?:{TITLES})\.?\s+)?", ""), r"\s+")
    shout = lambda w: (F.upper(w) == w) & (F.lower(w) != w)
    name = F.concat(_title(entity), F.array_join(F.zip_with(drawn, words, lambda d, w: F.when(shout(w), F.upper(d)).otherwise(d)), " "))
    cased = F.when(shout(entity), F.upper(first)).otherwise(first)
    return (
        F.when(kind.isin("ssn", "card"), _filled(entity, "[0-9]", first))
        .when(kind == "iban", _filled(entity, "[0-9A-Z]", first))
        .when(kind == "phone", phone)
        .when(kind == "name", name)
        .when(kind.isin("email", "ipv6"), cased)
        .when(kind == "secret", F.concat(F.regexp_extract(entity, _SECRET_SPLIT, 1), first))
        .when(kind == "birth", F.concat(F.regexp_extract(entity, rf"^{BIRTH_MARK}", 0), first))
        .otherwise(first)
    )


def _kinds(found: Column) -> Column:
    return F.transform(found, lambda e: F.named_struct(F.lit("entity"), e, F.lit("kind"), kind_of(e)))


def replace_pii(docs: DataFrame, text_column: str = "text", key: str = KEY) -> DataFrame:
    """The rows of ``docs`` with entities replaced; ``pii_kinds`` lists what was replaced, in order.

    Rows without entities, null and empty texts among them, stay as they are
    with an empty list, and are not shuffled. Texts and entities may have any
    length. Repeated rows stay repeated, and equal entities get equal surrogates
    in all of them. A column named ``pii_kinds`` is replaced, all others stay.
    """
    docs = docs.drop("pii_kinds")
    columns = docs.columns
    x = unused("pii", columns)
    text = F.col(f"`{text_column}`")
    # Detected once: both branches read what is written here.
    seen = materialize(docs.withColumn(x, F.struct(F.monotonically_increasing_id().alias("row"), _kinds(entities(text)).alias("found"))), "pii-seen")
    found = F.coalesce(F.exists(f"{x}.found", lambda e: e["kind"] != "none"), F.lit(False))
    names = [f"`{c}`" for c in columns]
    clean = seen.where(~found).select(*names, F.array().cast("array<string>").alias("pii_kinds"))
    held = seen.where(found).withColumn(x, F.struct(F.col(f"{x}.row"), F.col(f"{x}.found"), names_of(F.col(f"{x}.found")).alias("names")))
    held = held.withColumn(x, F.struct(F.col(f"{x}.row"), F.col(f"{x}.names"), F.col(f"{x}.found"), lone_pattern(F.col(f"{x}.names")).alias("pattern")))
    again = F.when(F.size(f"{x}.names") > 0, _kinds(entities(text, F.col(f"{x}.pattern")))).otherwise(F.col(f"{x}.found"))
    held = materialize(held.withColumn(x, F.struct(F.col(f"{x}.row"), F.col(f"{x}.names"), again.alias("found"), F.col(f"{x}.pattern"))), "pii-docs")

    each = held.select(F.col(f"{x}.row").alias("row"), _families(F.col(f"{x}.names")).alias("families"), _givens(F.col(f"{x}.names")).alias("givens"), F.posexplode(f"{x}.found").alias("at", "e"))
    each = each.select("row", "at", F.col("e.entity").alias("entity"), F.col("e.kind").alias("sort"), "families", "givens")
    parts = each.select("row", "at", "entity", "sort", F.posexplode(F.when(F.col("sort") == "none", F.array(F.struct(F.lit("same").alias("kind"), F.col("entity").alias("value")))).otherwise(atoms_of(F.col("sort"), F.col("entity"), F.col("families"), F.col("givens")))).alias("part", "atom"))
    parts = materialize(parts.select("row", "at", "entity", "sort", "part", F.col("atom.kind").alias("kind"), F.col("atom.value").alias("value")), "pii-atoms")
    surrogates = materialize(assign_surrogates(parts.where("kind <> 'same'"), key), "surrogates")
    drawn = parts.where("kind <> 'same'").join(surrogates, ["kind", "value"]).unionByName(parts.where("kind = 'same'").withColumn("surrogate", F.col("value")))
    in_order = F.array_sort(F.collect_list(F.struct("part", "surrogate")))
    by_entity = drawn.groupBy("row", "at", "entity", "sort").agg(F.transform(in_order, lambda p: p["surrogate"]).alias("drawn"))
    put = by_entity.select("row", F.struct("at", _put(F.col("sort"), F.col("entity"), F.col("drawn")).alias("put"), F.col("sort").alias("kind")).alias("put"))
    by_row = put.groupBy("row").agg(F.array_sort(F.collect_list("put")).alias("puts"))
    y = unused("puts", [*columns, x])
    gaps = F.expr(f"split(`{text_column}`, `{x}`.pattern, -1)")
    joined = F.array_join(F.zip_with(gaps, F.col(f"{y}.put"), lambda gap, p: F.concat(F.coalesce(gap, F.lit("")), F.coalesce(p, F.lit("")))), "")
    by_row = by_row.select(F.col("row").alias(unused("row", [*columns, x, y])), F.col("puts").alias(y))
    replaced = held.join(by_row, F.col(f"{x}.row") == F.col(by_row.columns[0])).withColumn(text_column, joined)
    kinds = F.filter(F.col(f"{y}.kind"), lambda k: k != "none")
    return clean.unionByName(replaced.select(*names, kinds.alias("pii_kinds")))


def op5_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its entities replaced, and the number of entities."""
    found = replace_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "text", F.size("pii_kinds").cast("long").alias("n_entities"), F.array_join("pii_kinds", ",").alias("kinds"))


QUERIES = {"op5_pii_surrogates": op5_pii_surrogates}
ORACLE_SQL: dict[str, str] = {}
