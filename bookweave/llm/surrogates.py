"""Surrogates for personal data, in DataFrame operations only.

Entities are found by patterns and replaced by keyed values of their own type and format: digits by
a keyed permutation of numbers of equal length (cards keep their Luhn remainder), address octets by
a permutation of addresses, letters by a keyed permutation of the texts of their format (letters of the same
case and kind in the same script), known given names by names of the same gender and script, family names with
endings for men and women by such names with the same ending. Titles, separators, prefixes of secrets, country
codes, trunk zeros and top-level domains stay. One entity has one surrogate everywhere, however it is written
(``+44 20 7946 0958`` and ``020 7946 0958`` agree, and so do ``Mr. Smith`` and ``John Smith``). A name that
stands alone is replaced where its document has it with a title or a given name too. Long numbers are cards
only with an issuer's length and beginning and a right check digit; others stay and don't count.

All distinct entities meet in a collision check: where a surrogate equals its original, another
original of its type or the surrogate of a lesser entity, the entity is keyed anew, until none does.
If six rounds don't free a type of clashes with originals (its format is nearly used up), only
distinct surrogates that differ from their own original are asked for. A format that still clashes after
all rounds is turned as a whole: each letter and digit moves on by a keyed step within its kind, so distinct
originals of the format stay distinct. Secrets without a letter or digit become ``*`` of the same length; only
they may be equal to each other or to their original, with names and mails in scripts that have no kinds
here (their letters become Latin ones) where even the turned format leaves no other value. The key is a
parameter.

Null texts stay null; texts without entities stay as they are; equal texts become equal. Of overlapping
matches the leftmost counts. Extra columns pass through. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bookweave.llm.common import boxed, settle

# Titles and common given names by gender and script.
TITLES = "Mrs Mr Miss Ms Mx Dr Prof Herr Frau Monsieur Madame Mme Señora Señor Sra Sr".split()
CYRILLIC_TITLES = "господин госпожа г-н г-жа".split()
GIVEN = {
    "GIVEN_M": "James John Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew Anthony Mark Paul Steven Andrew Peter Hans Karl Jean Pierre Carlos Juan".split(),
    "GIVEN_F": "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Nancy Lisa Margaret Sandra Ashley Emily Anna Laura Greta Ingrid Marie Claire Carmen Lucia".split(),
    "GIVEN_CM": "Иван Дмитрий Сергей Алексей Николай Михаил Андрей Павел".split(),
    "GIVEN_CF": "Анна Мария Ольга Елена Наталья Татьяна Ирина Светлана".split(),
}
#: Letters that stand for each other: vowels and consonants of a script.
KINDS = ["aeiou", "bcdfghjklmnpqrstvwxyz", "áéíóúàèìòùâêîôûäëïöü", "çñß", "аеиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "αεηιουω", "βγδζθκλμνξπρστφχψ", "0123456789", "āăąēĕėęěīĭįōŏőøæœūŭůűųýÿãõåı", "ćĉċčďđĝğġģĥħĵķĺļľłńņňŕŗřśŝşšţťŧŵźżžðþ", "ёіїєўъьґђјљњћџ", "άέήίόύώς"]
#: Scripts without case whose letters stand for each other, by code points: Hebrew, Arabic (two runs), Devanagari, Thai, Georgian, Hiragana, Katakana, Han, Hangul.
RANGES = [(0x5D0, 0x5EA), (0x621, 0x63A), (0x641, 0x64A), (0x905, 0x939), (0xE01, 0xE2E), (0x10D0, 0x10F0), (0x3041, 0x3096), (0x30A1, 0x30FA), (0x3400, 0x4DBF), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3)]

# Words that begin sentences and are no second names, and the country codes of one and two digits.
STOP = """A An And As At But By For From He Her Here His However I If In It Its My No Not Now Of On Or Our She So That The Their Then There These They This Those To We What When Where Which While Who Why With You Your
Aber Als Das Dann Der Die Doch Ein Eine Er Es Ich Ihr Im In Ist Mit Nicht Oder Sie Und Von Wenn Wir Zu Avec Ce Ces Dans De Des Elle En Et Il Ils Je La Le Les Mais Nous Ou Pour Que Qui Sur Un Une Vous
Como Con Cuando Del El Ella En Es Este La Las Los Muy No Para Pero Por Que Se Si Son Su Un Una Y А Без Был Была В Все Где Для До Его Ее Если Же За И Из Как Когда Мы На Не Но Он Она Они От По При С Так То Ты У Что Это Я""".split()
CODES = r"1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3}"
ISSUED = r"^(?:4[0-9]{12}(?:[0-9]{3}){0,2}|(?:5[1-5]|2[2-7]|35)[0-9]{14}|3[47][0-9]{13}|3[0689][0-9]{12}|(?=6(?:011|4[4-9]|5|2))[0-9]{16,19})$"
#: Endings of family names, as men and women have them.
ENDINGS = [(r"(ов|ев|ёв|ин|ын)а$", "$1"), (r"([сц]к)ая$", "$1ий"), (r"([oe]v)a$", "$1"), (r"([sc]k)a$", "$1i"), (r"(\p{L}{2})ová$", "$1")]
ENDING = r"(ов|ев|ёв|ин|ын|ov|ev|[сц]кий|[sc]ki)$"
#: Where a word begins and ends, in any script.
_B, _E = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"

EMAIL = r"[\p{L}0-9._%+-]+@[\p{L}0-9-]+(?:\.[\p{L}0-9-]+)*\.\p{L}{2,}"
AWS = rf"{_B}AKIA[0-9A-Z]{{16}}{_E}"
# What stands before the key word (client_secret, DB_PASSWORD) stays outside of the match.
SECRET = r"""(?i:(?:password|passwd|pwd|secret|token|api[_-]?key)["']?\s{0,3}[=:]\s{0,3})["']?[^\s"']{6,}"""
IPV4 = rf"{_B}(?:(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])\.){{3}}(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9]){_E}"
IBAN = rf"{_B}[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{3,7}}(?: ?[A-Z0-9]{{1,3}})?{_E}"
SSN = rf"{_B}[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}{_E}"
CARD = rf"{_B}(?:[0-9]{{13,19}}|[0-9]{{4}}(?:[ -][0-9]{{4}}){{3}}(?:[ -][0-9]{{3}}(?!\.[0-9]))?|[0-9]{{4}}[ -][0-9]{{6}}[ -][0-9]{{4,5}}){_E}"
PHONE = rf"(?:\+[0-9]{{1,3}}[ .-]?)?(?:\([0-9]{{2,4}}\)[ .-]?|{_B}[0-9]{{2,4}}[ .-])[0-9]{{3,4}}[ .-][0-9]{{3,4}}{_E}|\+[0-9]{{1,3}}(?:[ .-]?[0-9]{{2,5}}){{2,4}}{_E}"
_NAME = r"\p{Lu}(?:\p{L}|-(?=\p{L})|['’](?=\p{Lu}))+"
_SECOND = rf"(?!(?:{'|'.join(STOP)}){_E}){_NAME}"
PERSON = rf"{_B}(?:(?:{'|'.join(TITLES)})\.?|(?:{'|'.join(CYRILLIC_TITLES)})) {_NAME}(?: {_SECOND})?|{_B}(?:{'|'.join(n for names in GIVEN.values() for n in names)}) {_SECOND}"
ENTITY = "|".join(f"(?:{p})" for p in (EMAIL, SECRET, AWS, IPV4, IBAN, SSN, CARD, PHONE, PERSON))
#: What every text with an entity has.
HINT = rf"[0-9@=:]|{_B}(?=[\p{{Lu}}г])(?:" + "|".join([*TITLES, *CYRILLIC_TITLES, *(n for names in GIVEN.values() for n in names)]) + r")\.? \p{Lu}"


def kind(raw: Column) -> Column:
    """The type of a match of ENTITY."""
    whole = lambda p: raw.rlike(f"^(?:{p})$")
    found = F.when(raw.contains("@") & whole(EMAIL), "EMAIL")
    for name, pattern in (("SECRET", SECRET), ("AWS", AWS), ("IPV4", IPV4), ("IBAN", IBAN), ("SSN", SSN), ("CARD", CARD), ("PHONE", PHONE)):
        found = found.when(whole(pattern), name)
    return found.otherwise("PERSON")


def _card(raw: Column) -> Column:
    """Whether a long number has an issuer's form and a right check digit."""
    digits = F.regexp_replace(raw, "[^0-9]", "")
    return digits.rlike(ISSUED) & (_luhn(F.substr(digits, F.lit(1), F.length(digits) - 1)) == F.substr(digits, F.length(digits)).cast("int"))


def _pieces(raw: Column) -> Column:
    """(type, raw) of what is replaced apart: a person's title and names, else the match."""
    word = lambda w: F.struct(_name_kind(w).alias("type"), w.alias("raw"))
    found = kind(raw)
    found = F.when((found == "CARD") & ~_card(raw), "KEEP").otherwise(found)
    return F.when(found == "PERSON", F.transform(F.split(raw, " "), word)).otherwise(F.array(F.struct(found.alias("type"), raw.alias("raw"))))


def _name_kind(word: Column) -> Column:
    found = F.when(word.rlike(rf"^(?:(?:{'|'.join(TITLES)})\.?|{'|'.join(CYRILLIC_TITLES)})$"), "KEEP")
    for name, names in GIVEN.items():
        found = found.when(word.isin(names), name)
    return found.otherwise("NAME")


def identity(type_: Column, raw: Column) -> Column:
    """What all ways to write an entity share."""
    digits = F.regexp_replace(raw, "[^0-9]", "")
    national = F.regexp_replace(F.when(raw.startswith("+"), F.regexp_replace(digits, f"^(?:{CODES})", "")).otherwise(F.regexp_replace(digits, "^1(?=[0-9]{10}$)", "")), "^0+", "")
    bare = F.when((type_ == "PHONE") & (F.length(national) >= 4), national).otherwise(digits)
    family = F.lower(raw)
    for ending, base in ENDINGS:
        family = F.regexp_replace(family, ending, base)
    return F.when(type_ == "NAME", family).when(type_.isin("PHONE", "CARD", "SSN"), bare).when(type_ == "IBAN", F.replace(raw, F.lit(" "), F.lit(""))).when(type_ == "EMAIL", F.lower(raw)).otherwise(raw)


def _draw(key: str, below: Column, *parts: Column) -> Column:
    """A keyed number from 0 to below - 1."""
    text = F.concat_ws("\x1f", F.lit(key), *(p.cast("string") for p in parts))
    return F.pmod(F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long"), below)


def _feistel(key: str, left: Column, right: Column, a: Column, b: Column, turn: Column) -> Column:
    """A keyed permutation of pairs of numbers below a and below b."""

    def round_(s: Column, i: Column) -> Column:
        l, r = s["l"], s["r"]  # noqa: E741
        return F.when(i % 2 == 0, F.struct(F.pmod(l + _draw(key, a, turn, i, r), a).alias("l"), r.alias("r"))).otherwise(F.struct(l.alias("l"), F.pmod(r + _draw(key, b, turn, i, l), b).alias("r")))

    return F.aggregate(F.sequence(F.lit(0), F.lit(7)), F.struct(left.alias("l"), right.alias("r")), round_)


def _power(n: Column) -> Column:
    return F.element_at(F.array(*(F.lit(10**i) for i in range(19))), n + 1)


def _digits(key: str, type_: Column, digits: Column, turn: Column) -> Column:
    """Digits of the same number; the whole is a permutation of the numbers of that length."""
    n = F.length(digits)
    half = F.when(type_ == "PHONE", 1).otherwise(F.floor(n / 2)).cast("int")
    zero = (type_ == "PHONE") & ~digits.startswith("0")  # national numbers begin with 1 to 9
    left, right = F.substr(digits, F.lit(1), half), F.substr(digits, half + 1)
    lead = F.when(zero, 1).otherwise(0).cast("long")
    out = _feistel(key, left.cast("long") - lead, right.cast("long"), _power(half) - lead, _power((n - half).cast("int")), F.concat(type_, n.cast("string"), turn.cast("string")))
    return F.concat(F.lpad((out["l"] + lead).cast("string"), half, F.lit("0")), F.lpad(out["r"].cast("string"), (n - half).cast("int"), F.lit("0")))


def _luhn(digits: Column) -> Column:
    """The check digit of digits."""
    value = lambda c, i: F.when(i % 2 == 0, F.pmod(c.cast("int") * 2, F.lit(10)) + F.when(c.cast("int") > 4, 1).otherwise(0)).otherwise(c.cast("int"))
    total = F.aggregate(F.transform(F.split(F.reverse(digits), ""), value), F.lit(0), lambda a, x: a + x)
    return F.pmod(F.lit(10) - F.pmod(total, F.lit(10)), F.lit(10))


def _char(code: Column) -> Column:
    """The character of a code point below 65536."""
    return F.decode(F.unhex(F.lpad(F.hex(code.cast("long")), 4, F.lit("0"))), "UTF-16BE")


def _each(text: Column, step, kinds: list[str] = KINDS, other=lambda c, low: c) -> Column:
    """Every letter and digit becomes the one that step(place in its kind, size of the kind, place in the text) names."""

    def one(c: Column, i: Column) -> Column:
        low, code = F.lower(c), F.ascii(c)
        rest = other(c, low)
        for a, b in RANGES:
            rest = F.when(code.between(a, b), _char(step(code - a, b - a + 1, i) + a)).otherwise(rest)
        out = F.when(c.rlike(r"\p{L}"), rest).otherwise(c)
        for letters in reversed(kinds):
            pick = F.substr(F.lit(letters), (step(F.position(low, F.lit(letters)) - 1, len(letters), i) + 1).cast("int"), F.lit(1))
            out = F.when(F.lit(letters).contains(low), F.when(c == low, pick).otherwise(F.upper(pick))).otherwise(out)
        return out

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _letters(key: str, text: Column, *keys: Column, kinds: list[str] = KINDS) -> Column:
    """Every letter and digit becomes one of the same kind and case, by a keyed permutation of all texts of the same format; letters without a kind become Latin ones.

    A Feistel network on the text's halves: the letters of one move on within their kinds by draws from the other's.
    """

    def latin(c: Column, low: Column) -> Column:
        pick = F.substr(F.lit(KINDS[1]), (_draw(key, F.lit(len(KINDS[1])), F.lit("other"), c, *keys) + 1).cast("int"), F.lit(1))
        return F.when(c == low, pick).otherwise(F.upper(pick))

    half = F.floor(F.length(text) / 2).cast("int")

    def round_(cells: Column, places: Column, r: Column) -> Column:
        first = r % 2 == 0
        other = F.when(first, F.array_join(F.slice(places, half + 1, F.size(places) - half), ",")).otherwise(F.array_join(F.slice(places, F.lit(1), half), ","))

        def move(said: Column, place: Column, i: Column) -> Column:
            size = F.element_at(cells, i + 1)["size"]
            return F.when(((i < half) == first) & (size > 0), F.pmod(place + _draw(key, size, r, i, said, *keys), size).cast("int")).otherwise(place)

        return _let(other, lambda said: F.transform(places, lambda place, i: move(said, place, i)))

    moved = lambda cells: F.aggregate(F.sequence(F.lit(0), F.lit(3)), F.transform(cells, lambda c: c["place"]), lambda places, r: round_(cells, places, r))
    cells = F.transform(F.split(text, ""), lambda c: _cell(c, kinds))
    return _let(_let(cells, moved), lambda places: _each(text, lambda place, size, i: F.element_at(places, i + 1), kinds, latin))


def _let(value: Column, body) -> Column:
    """body of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _cell(c: Column, kinds: list[str]) -> Column:
    """(place, size): where a character stands in its kind, and the kind's size; 0 where it has none."""
    low, code = F.lower(c), F.ascii(c)
    place, size = F.lit(0), F.lit(0)
    for a, b in RANGES:
        place, size = F.when(code.between(a, b), code - a).otherwise(place), F.when(code.between(a, b), b - a + 1).otherwise(size)
    for letters in reversed(kinds):
        inside = F.lit(letters).contains(low)
        place, size = F.when(inside, F.position(low, F.lit(letters)) - 1).otherwise(place), F.when(inside, len(letters)).otherwise(size)
    return F.struct(place.cast("int").alias("place"), size.cast("int").alias("size"))


def _format(text: Column) -> Column:
    """What all texts share that differ only in letters and digits of like kinds and cases."""
    return _each(text, lambda place, size, i: F.lit(0))


def _turned(key: str, type_: Column, text: Column) -> Column:
    """text with each letter and digit moved on within its kind; a permutation of each format without fixed points."""
    return _each(text, lambda place, size, i: F.pmod(place + 1 + _draw(key, F.lit(size - 1), F.lit("turn"), type_, i), F.lit(size)))


#: What stays of a secret, key or account, and what is replaced.
_HIDDEN = r"""^((?:AKIA|[^=:]*[=:]\s*["']?|[A-Z]{2}))(.*)$"""


def masked(type_: Column, entity: Column) -> Column:
    """Whether a secret has nothing that is replaced by its like."""
    return (type_ == "SECRET") & ~F.regexp_extract(entity, _HIDDEN, 2).rlike(r"[\p{L}0-9]")


def _mask(entity: Column) -> Column:
    return F.concat(F.regexp_extract(entity, _HIDDEN, 1), F.repeat(F.lit("*"), F.length(F.regexp_extract(entity, _HIDDEN, 2))))


def _parts(type_: Column, entity: Column) -> tuple[Column, Column, Column]:
    """What stays before, what is turned, what stays after."""
    hidden = type_.isin("SECRET", "AWS", "IBAN")
    head = F.when(hidden, F.regexp_extract(entity, _HIDDEN, 1)).otherwise("")
    tail = F.when(type_ == "EMAIL", F.regexp_extract(entity, r"(\.[^.]*)$", 1)).when(type_ == "NAME", _ending(entity)).otherwise("")
    return head, F.substr(entity, F.length(head) + 1, F.length(entity) - F.length(head) - F.length(tail)), tail


def _ending(name: Column) -> Column:
    """The ending that a family name keeps; two letters stand before it at least."""
    found = F.regexp_extract(name, ENDING, 1)
    return F.when(F.length(name) >= F.length(found) + 2, found).otherwise("")


def surrogate(key: str, type_: Column, entity: Column, turn: Column) -> Column:
    """The surrogate of an entity in the turn-th keying, written as its identity is; on entities of one format a permutation, but for given names."""
    base = F.substr(entity, F.lit(1), F.length(entity) - 1)
    body = _digits(key, type_, base, turn)
    last = F.pmod(_luhn(body) + F.substr(entity, F.length(entity)).cast("int") - _luhn(base), F.lit(10))
    octets = F.split(entity, r"\.")
    pair = lambda i: octets[i].cast("long") * 256 + octets[i + 1].cast("long")
    address = _feistel(key, pair(0), pair(2), F.lit(1 << 16), F.lit(1 << 16), F.concat(F.lit("ip"), turn.cast("string")))
    dotted = F.concat_ws(".", *(F.floor(address[h] / d).cast("long") % 256 for h in ("l", "r") for d in (256, 1)))
    domain = F.regexp_extract(entity, r"@(.*)\.[^.]*$", 1)
    mail = F.concat(_letters(key, F.regexp_extract(entity, "^([^@]*)@", 1), F.lit("local"), domain, turn), F.lit("@"), _letters(key, domain, F.lit("domain")), F.regexp_extract(entity, r"(\.[^.]*)$", 1))
    start, value = F.regexp_extract(entity, _HIDDEN, 1), F.regexp_extract(entity, _HIDDEN, 2)
    hidden = F.when(value.rlike("^[0-9a-f]+$"), _letters(key, value, type_, start, turn, kinds=["abcdef", "0123456789"])).otherwise(_letters(key, value, type_, start, turn))
    hidden = F.concat(start, hidden)
    found = F.when(type_ == "CARD", F.concat(body, last.cast("string"))).when(type_.isin("PHONE", "SSN"), _digits(key, type_, entity, turn))
    found = found.when(type_ == "IPV4", dotted).when(type_ == "EMAIL", mail).when(type_.isin("SECRET", "AWS", "IBAN"), hidden)
    for name, names in GIVEN.items():
        pool = F.array(*map(F.lit, names))
        pick = lambda i, pool=pool, names=names: F.element_at(pool, (_draw(key, F.lit(len(names)), F.lit("given"), entity, turn, F.lit(i)) + 1).cast("int"))
        found = found.when(type_ == name, F.when(turn == 0, pick(0)).otherwise(F.concat(pick(0), F.lit("-"), pick(1))))
    _, stem, ending = _parts(type_, entity)
    return found.otherwise(F.concat(_letters(key, stem, type_, ending, turn), ending))


def written(type_: Column, raw: Column, value: Column) -> Column:
    """The surrogate in the format of the original."""
    digits, low = F.regexp_replace(raw, "[^0-9]", ""), F.lower(raw)
    if_family = F.when(low.rlike("(?:ов|ев|ёв|ин|ын)а$"), F.concat(value, F.lit("а"))).when(low.rlike("[oe]va$"), F.concat(value, F.lit("a"))).when(low.rlike("[сц]кая$"), F.regexp_replace(value, "ий$", "ая")).when(low.rlike("[sc]ka$"), F.regexp_replace(value, "i$", "a")).when(low.rlike(r"\p{L}{2}ová$"), F.concat(value, F.lit("ová")))
    value = F.when((type_ == "NAME") & (identity(type_, raw) != low), if_family).otherwise(value)
    fill = F.when(type_.isin("PHONE", "CARD", "SSN"), F.concat(F.substr(digits, F.lit(1), F.length(digits) - F.length(value)), value)).otherwise(value)

    def step(s: Column, c: Column) -> Column:
        new = F.substr(fill, s["k"] + 1, F.lit(1))
        slot = F.when(type_.isin("PHONE", "CARD", "SSN"), c.between("0", "9")).when(type_ == "IBAN", c != " ").otherwise(F.lit(True))
        new = F.when((c != F.lower(c)) & type_.isin("EMAIL", "NAME"), F.upper(new)).otherwise(new)
        return F.struct(F.concat(s["o"], F.when(slot, new).otherwise(c)).alias("o"), (s["k"] + slot.cast("int")).alias("k"))

    folded = F.aggregate(F.split(raw, ""), F.struct(F.lit("").alias("o"), F.lit(0).alias("k")), step)["o"]
    return F.when(type_ == "KEEP", raw).when(type_.isin("IPV4", "SECRET", "AWS", *GIVEN), value).otherwise(folded)


def settle_collisions(entities: DataFrame, key: str, rounds: int = 10, strict: int = 6) -> DataFrame:
    """entities: distinct type, entity. Adds value, distinct within each type and unlike its original (and, in the first rounds, unlike any)."""
    entities = settle(entities.select("type", "entity"))
    type_, entity, value = F.col("type"), F.col("entity"), surrogate(key, F.col("type"), F.col("entity"), F.col("turn"))
    fixed = entities.where(masked(type_, entity)).select("type", "entity", _mask(entity).alias("value"))
    entities = entities.where(~masked(type_, entity))
    rows = settle(entities.withColumn("turn", F.lit(0)).withColumn("value", value).withColumn("free", F.lit(False)))
    for turn in range(1, rounds + 1):
        originals = rows.select(F.col("type").alias("_t"), F.col("entity").alias("_e"))
        order = Window.partitionBy("type", "value").orderBy(F.desc("free"), "turn", "entity")
        ranked = rows.withColumn("_rank", F.row_number().over(order))
        met = ranked.join(originals, (F.col("type") == F.col("_t")) & (F.col("value") == F.col("_e")), "left")
        clash = (F.col("_rank") > 1) | (F.col("value") == F.col("entity"))
        if turn <= strict:
            clash = clash | F.col("_e").isNotNull()
        checked = settle(met.select("type", "entity", "turn", "value", (~clash).alias("free")))
        if checked.where("NOT free").isEmpty():
            return checked.select("type", "entity", "value").union(fixed)
        again = checked.where("NOT free").withColumn("turn", F.lit(turn)).withColumn("value", value)
        rows = settle(checked.where("free").union(again))
    head, middle, tail = _parts(type_, entity)
    shaped = settle(checked.select("type", "entity", "value", "free", F.md5(F.concat_ws("\x1f", head, _format(middle), tail)).alias("_shape")))
    tight = shaped.where("NOT free").select("type", "_shape").distinct()
    easy = shaped.join(tight, ["type", "_shape"], "left_anti").select("type", "entity", "value")
    turned = shaped.join(tight, ["type", "_shape"], "left_semi").select("type", "entity", F.concat(head, _turned(key, type_, middle), tail).alias("value"))
    return easy.union(turned).union(fixed)


def replace_entities(docs: DataFrame, key: str = "example-key") -> DataFrame:
    """docs with surrogates in text, and n_entities."""
    text = F.col("text")
    may = F.coalesce(text.rlike(HINT), F.lit(False))
    found = docs.where(may).select("text").withColumn("_raw", F.regexp_extract_all("text", F.lit(ENTITY), F.lit(0))).where(F.size("_raw") > 0)
    places = found.select(F.md5("text").alias("_key"), F.posexplode("_raw").alias("i", "raw"))
    places = places.select("_key", "i", F.posexplode(_pieces(F.col("raw"))).alias("j", "p")).select("_key", "i", "j", "p.type", "p.raw", identity(F.col("p.type"), F.col("p.raw")).alias("entity"))
    places = settle(places.distinct())
    values = settle_collisions(places.where("type <> 'KEEP'").select("type", "entity").distinct(), key)
    done = places.join(values, ["type", "entity"], "left")
    done = done.select("_key", "i", "j", "type", "raw", written(F.col("type"), F.col("raw"), F.col("value")).alias("new"))
    name = F.when(F.col("type").isin("NAME", *GIVEN), F.struct("raw", "new"))
    done = done.groupBy("_key", "i").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("j", "new"))), lambda x: x["new"]), " ").alias("new"), F.collect_list(name).alias("names"), F.max((F.col("type") != "KEEP").cast("int")).alias("n"))
    done = done.groupBy("_key").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "new"))), lambda x: x["new"]).alias("_new"), F.array_distinct(F.flatten(F.collect_list("names"))).alias("_names"), F.sum("n").cast("int").alias("_n")).withColumnRenamed("_key", "_met")
    joined = boxed(docs.where(may), "text", F.md5("text").alias("_key")).join(done, F.col("_key") == F.col("_met"), "left")
    between = F.transform(F.split(text, ENTITY, -1), lambda part: F.when(F.size("_names") > 0, renamed(part, F.col("_names"))).otherwise(part))
    woven = F.array_join(F.flatten(F.zip_with(between, F.concat("_new", F.array(F.lit(""))), lambda a, b: F.array(a, b))), "")
    new = F.when(F.col("_new").isNull(), text).otherwise(woven)
    kept = [c for c in docs.columns if c != "n_entities"]
    changed = joined.select(*(new.alias(c) if c == "text" else F.col(f"_row.`{c}`") for c in kept), F.coalesce("_n", F.lit(0)).alias("n_entities"))
    return changed.union(docs.where(~may).select(*(F.col(f"`{c}`") for c in kept), F.lit(0).alias("n_entities")))


def renamed(part: Column, names: Column) -> Column:
    """part with the names that stand alone in it replaced; names: array of (raw, new)."""
    capitals = F.transform(names, lambda x: F.struct(F.upper(x["raw"]).alias("raw"), F.upper(x["new"]).alias("new")))
    known = F.array_distinct(F.concat(names, F.filter(capitals, lambda x: ~F.exists(names, lambda y: y["raw"] == x["raw"]))))
    table = F.map_from_entries(known)
    word = r"(?<=\p{L})(?!\p{L}|-\p{L}|['’]\p{Lu})|(?<!\p{L}|\p{L}-|\p{L}['’])(?=\p{Lu})"
    return F.array_join(F.transform(F.split(part, word, -1), lambda w: F.coalesce(F.try_element_at(table, w), w)), "")


def op1_surrogates(docs: DataFrame) -> DataFrame:
    return replace_entities(docs.select("doc_id", "text"))
