"""Surrogate generation for personal data, by DataFrame functions alone.

Entities are found by one pattern. Each gets a surrogate that depends on a key and on the entity's normal form alone, so
that all its mentions in all documents change alike (coreference), whatever their punctuation:

- card, phone, social-security and account numbers: a keyed Feistel permutation of their digits, written into the
  original's punctuation; a number with a valid Luhn digit gets a valid one.
- IPv4 addresses: a keyed permutation of their 32 bits; IPv6 addresses: keyed ones in 2001:db8::/32, the range for documents.
- e-mail addresses, secrets, hexadecimal digests, account codes: keyed letters for letters (in their case and script),
  keyed digits for digits; mail domains become names below the reserved example.org, and a name that still collides at
  the fourth attempt (short names have few forms) is made longer.
- persons (after a title, or with a known given name): known given names become ones of the same gender, permuted by the
  key; other names are spelled of syllables in their own script, given names with an ending of the title's gender. A
  surname is an entity of its own, so that "John Doe" and "Mr Doe" keep one surname. The title stays.

Collision checks: the distinct entities of all documents and their surrogates are compared; where two share a surrogate,
or one equals an original, all but the first of them are keyed anew, until none is left. Numbers whose format is so dense
in the corpus that LATE attempts find no free place go back to the first permutation: surrogates stay distinct there, but
may equal the original of another entity. What still collides after ATTEMPTS keeps its last surrogate. Only the exceptions are joined back to the documents that hold them: by a
broadcast if there are BROADCAST_ROWS such documents at most, by a sort-merge join beyond that.

Defined cases: a null text stays null with no entities; an empty text stays empty; a very long text is treated whole.
Repeated rows change alike, one row each; of entities that tie, the least normal form keeps its surrogate. Rows with a
null doc_id are treated as the others, with the surrogates of the first attempt. An empty table gives an empty one. Other
columns stay as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import cut, discard, stored

#: Attempts at a surrogate that collides with none; the number of those left falls by orders of magnitude with each. From LATE on, formats of permuted digits that are too dense go back to the first.
ATTEMPTS, LATE = 24, 8
#: Documents with exceptions that may be broadcast.
BROADCAST_ROWS = 100_000
PERMUTED = ("card", "phone", "ssn", "ip")

# Titles and given names by gender, and the syllables of surnames by script.
MALE_TITLES = ("Mr", "Herr", "Monsieur", "Señor", "Sir")
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mademoiselle", "Señora", "Señorita")
PLAIN_TITLES = ("Dr", "Prof")
MALE_NAMES = ("James", "George", "Paul", "Mark", "Frank", "Robert", "John", "Michael", "David", "William", "Richard", "Joseph", "Thomas", "Daniel", "Hans", "Klaus", "Jürgen", "Wolfgang", "Pierre", "François", "Philippe", "Carlos", "Miguel", "Fernando", "Charles", "Christopher", "Matthew", "Anthony", "Steven", "Andrew", "Kenneth", "Brian", "Kevin", "Timothy", "Jeffrey", "Gary", "Nicholas", "Eric", "Stephen", "Jonathan", "Benjamin", "Samuel", "Alexander", "Peter", "Stefan", "Andreas", "Jens", "Uwe", "Matthias", "Jean", "Jacques", "Michel", "Alain", "Juan", "José", "Antonio", "Luis", "Javier", "Ivan", "Dmitri", "Ahmed", "Mohammed")
FEMALE_NAMES = ("Mary", "Jane", "Alice", "Emma", "Julia", "Patricia", "Jennifer", "Linda", "Elizabeth", "Barbara", "Susan", "Jessica", "Karen", "Sarah", "Ursula", "Monika", "Petra", "Brigitte", "Nathalie", "Isabelle", "Sylvie", "Carmen", "Dolores", "Lucía", "Margaret", "Nancy", "Lisa", "Sandra", "Ashley", "Emily", "Michelle", "Amanda", "Melissa", "Deborah", "Stephanie", "Rebecca", "Laura", "Cynthia", "Kathleen", "Amy", "Angela", "Anna", "Nicole", "Samantha", "Katherine", "Sabine", "Claudia", "Andrea", "Heike", "Birgit", "Marie", "Catherine", "Françoise", "Monique", "Ana", "Pilar", "Teresa", "Olga", "Tatiana", "Fatima", "Aisha", "Helen")
LATIN_SYLLABLES = ("bel", "car", "dor", "fen", "gar", "hol", "jun", "kas", "lim", "mar", "nor", "pel", "quin", "ros", "sal", "tor", "van", "wes", "yar", "zim")
GREEK_SYLLABLES = ("βα", "γε", "δη", "ζο", "θα", "κα", "λι", "μα", "νι", "πα", "ρο", "σα", "το", "φι", "χρι", "ψα", "λου", "μπου", "ντι", "ξε")
HAN_SYLLABLES = ("安", "白", "陈", "丁", "方", "高", "何", "江", "孔", "林", "马", "宁", "钱", "任", "石", "田", "王", "徐", "杨", "周")
DEVANAGARI_SYLLABLES = ("अम", "कर", "खन", "गुप", "चन", "जय", "तन", "देव", "नाग", "पाल", "भट", "मान", "यश", "राज", "लाल", "वर", "शर", "सिंह", "हर", "मित")
ARABIC_SYLLABLES = ("بد", "تم", "جم", "حس", "خل", "دا", "رض", "زي", "سا", "شر", "صا", "طا", "عا", "فا", "قا", "كر", "ما", "نا", "وا", "يا")
CYRILLIC_SYLLABLES = ("бел", "вар", "гор", "дан", "жар", "зим", "кал", "лаз", "мар", "нов", "пол", "рос", "сав", "тар", "фед", "хар", "чер", "шул", "юр", "яр")

_LOCAL = r"[\p{L}\p{N}._%+-]"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
_GROUP = "[0-9a-fA-F]{1,4}"
#: Eight groups, or fewer around one double colon with a digit somewhere.
_IP6 = rf"(?<![\w:.])(?:(?:{_GROUP}:){{7}}{_GROUP}|(?=[0-9a-fA-F:]*\d)(?:{_GROUP}(?::{_GROUP}){{0,5}})?::{_GROUP}(?::{_GROUP}){{0,5}})(?![\w:]|\.\d)"
#: What stands before a secret: a keyword, alone or at the end of a longer name, and its sign.
_SECRET_HEAD = r"(?:[A-Za-z0-9]{1,30}[_-]){0,4}(?i:token|secret(?:[_-]?(?:access[_-]?)?key)?|password|passwd|(?:api|access|private)[_-]?key)[\"']?\s{0,3}[=:]\s{0,3}[\"']?"


def _by_first_letter(words: tuple[str, ...]) -> str:
    """An alternation that is decided by the first letter."""
    return "|".join(f"{first}(?:{'|'.join(sorted((w[1:] for w in words if w[0] == first), key=lambda x: (-len(x), x)))})" for first in sorted({w[0] for w in words}))


_TITLE = _by_first_letter((*MALE_TITLES, *FEMALE_TITLES, *PLAIN_TITLES))
_GIVEN = _by_first_letter((*MALE_NAMES, *FEMALE_NAMES))
_NAME = r"\p{Lu}[\p{L}'’-]{1,40}"
#: After a title also a name in a script without capital letters.
_TITLED = r"(?:\p{Lu}[\p{L}'’-]{1,40}|\p{Lo}[\p{L}\p{M}]{0,20})"
PATTERNS = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}++@(?:[A-Za-z0-9-]++\.)+[A-Za-z]{{2,24}}",
    "secret": r"(?<!\p{L})" + _SECRET_HEAD + r"[A-Za-z0-9+/_-]{8,}+|(?<![A-Za-z0-9])[0-9a-fA-F]{32,}+(?![A-Za-z0-9])",
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\d)|{_IP6}",
    "account": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": r"(?<![\w+])\d(?:[ -]?\d){12,18}(?![\w@])",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": r"(?<![\w+(])(?:\+?\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\w)|(?<![\w+.-])(?:\+\d{1,3}[ .-])?(?:\d{3}[ .-])?\d{3}[.-]\d{4}(?![\w-])|(?<![\w+])\+\d{7,15}(?!\w)"
    # international and national numbers in groups parted by blanks, dots or hyphens
    r"|(?<![\w+])\+(?=(?:[ .()-]{0,2}\d){7,15}(?![ .-]?\d))\d{1,3}(?:[ .-]?\(?\d{1,8}\)?){2,6}(?!\w)"
    r"|(?<![\w+.-])(?:\d{3} \d{3} \d{4}|0\d{2,4} \d{3,4} \d{3,4}|0\d{1,4}[ /]\d{5,8}|0\d(?:[ .]\d{2}){4})(?![\w-])(?! ?\d)",
    "person": rf"(?<!\p{{L}})(?:(?:{_TITLE})\.? {_TITLED}(?: {_TITLED})?|(?:{_GIVEN}) {_NAME})",
}
#: All of them, tried at starts of words alone, and there by the first character.
PATTERN = (
    r"(?<![\p{L}\p{N}_])(?:(?=[\d+(])(?:" + "|".join(PATTERNS[k] for k in ("ip", "card", "ssn", "phone")) + r")|(?=[a-fA-F:])(?:" + _IP6 + r")|(?=[A-Za-z0-9])(?:" + PATTERNS["secret"]
    + r")|(?=\p{Lu})(?:" + PATTERNS["account"] + "|" + PATTERNS["person"] + ")|" + PATTERNS["email"] + ")"
)
KINDS = tuple(PATTERNS)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body names it."""
    return F.element_at(F.transform(F.array(value), lambda v: body(v)), 1)


def kind_of(found: Column) -> Column:
    """The kind of a match: the first pattern that it is a whole match of."""
    out = F.lit("person")
    for kind in reversed(KINDS[:-1]):
        out = F.when(found.rlike(f"^(?:{PATTERNS[kind]})$"), F.lit(kind)).otherwise(out)
    return out


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"\D", "")


def _groups(found: Column) -> Column:
    """All eight groups of an IPv6 address, in four lower-case digits each."""

    def of(x: Column) -> Column:
        listed = lambda part: F.filter(F.split(part, ":"), lambda g: g != "")
        left, right = listed(F.substring_index(x, "::", 1)), listed(F.when(F.contains(x, F.lit("::")), F.substring_index(x, "::", -1)).otherwise(""))
        zeros = F.array_repeat(F.lit("0"), F.greatest(F.lit(0), 8 - F.size(left) - F.size(right)))
        return F.array_join(F.transform(F.concat(left, zeros, right), lambda g: F.lpad(g, 4, "0")), ":")

    return let(F.lower(found), of)


def normal_form(kind: Column, found: Column) -> Column:
    """What mentions of one entity share."""
    bare = F.regexp_replace(found, "^" + _SECRET_HEAD, "")
    return (
        F.when(kind.isin("card", "ssn", "phone"), _digits(found))
        .when(kind == "email", F.lower(found))
        .when(kind == "secret", bare)
        .when(kind == "account", F.replace(found, F.lit(" "), F.lit("")))
        .when((kind == "ip") & F.contains(found, F.lit(":")), _groups(found))
        .when(kind.isin("person", "given"), F.lower(F.element_at(F.split(found, " "), -1)))
        .otherwise(found)
    )


def _hash(*parts: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", *[p.cast("string") for p in parts]), 256)


def _number(digest: Column) -> Column:
    """The first 60 bits of a hexadecimal digest."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def _permuted(digits: Column, key: Column, attempt: Column) -> Column:
    """A keyed permutation of all digit strings of this one's length, up to 19: four Feistel rounds with sums modulo powers of ten."""
    ten = lambda size: F.pow(F.lit(10.0), size).cast("long")

    def of(x: Column) -> Column:
        n, left_size, right_size = x["n"], x["k"], x["n"] - x["k"]
        state = F.struct(F.substr(x["d"], F.lit(1), left_size).cast("long").alias("l"), F.coalesce(F.try_to_number(F.substr(x["d"], left_size + 1, right_size), F.lit("9" * 19)).cast("long"), F.lit(0)).alias("r"))
        for turn in (1, 2, 3, 4):

            def step(v: Column, turn: int = turn) -> Column:
                new = lambda own, other, size: F.pmod(own + _number(_hash(key, F.lit(turn), attempt, n, other)) % ten(size), ten(size))
                return F.struct(new(v["l"], v["r"], left_size).alias("l"), v["r"].alias("r")) if turn % 2 else F.struct(v["l"].alias("l"), new(v["r"], v["l"], right_size).alias("r"))

            state = let(state, step)
        return let(state, lambda v: F.concat(F.lpad(v["l"].cast("string"), left_size, "0"), F.when(right_size > 0, F.lpad(v["r"].cast("string"), right_size, "0")).otherwise("")))

    n = F.length(digits)
    return let(F.struct(digits.alias("d"), n.alias("n"), F.greatest(F.lit(1), F.floor(n / 2).cast("int")).alias("k")), of)


def _luhn(text: Column) -> Column:
    """The Luhn sum of a digit string, modulo 10."""

    def of(digits: Column) -> Column:
        n = F.length(digits)

        def worth(i: Column) -> Column:
            d = F.substr(digits, i, F.lit(1)).cast("int")
            return F.when((n - i) % 2 == 1, F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)).otherwise(d)

        return F.aggregate(F.transform(F.sequence(F.lit(1), n), worth), F.lit(0), lambda a, x: a + x) % 10

    return let(text, of)


def _card(text: Column, key: Column, attempt: Column) -> Column:
    def of(digits: Column) -> Column:
        ending = lambda front: F.concat(front, ((10 - _luhn(F.concat(front, F.lit("0")))) % 10).cast("string"))
        return F.when(_luhn(digits) == 0, let(_permuted(F.substr(digits, F.lit(1), F.length(digits) - 1), key, attempt), ending)).otherwise(_permuted(digits, key, attempt))

    return let(text, of)


def _written(form: Column, new: Column, taken: str = "[0-9]") -> Column:
    """The characters of new put in place of those of form that `taken` matches, whose others stay."""

    def of(new: Column) -> Column:
        def at(i: Column) -> Column:
            ch = F.substr(form, i, F.lit(1))
            return F.when(ch.rlike(taken), F.substr(new, F.regexp_count(F.substr(form, F.lit(1), i), F.lit(taken)), F.lit(1))).otherwise(ch)

        return F.array_join(F.transform(F.sequence(F.lit(1), F.length(form)), at), "")

    return let(new, of)


def _spelled(form: Column, digest: Column) -> Column:
    """Keyed letters for letters and digits for digits, in the form's case and script; other characters stay."""

    def at(i: Column) -> Column:
        return let(F.substr(form, i, F.lit(1)), lambda ch: letter(i, ch))

    def letter(i: Column, ch: Column) -> Column:
        v = F.conv(F.substr(digest, 1 + 2 * ((i - 1) % 32), F.lit(2)), 16, 10).cast("int") + F.floor((i - 1) / 32).cast("int")
        pick = lambda letters: F.substr(F.lit(letters), 1 + v % len(letters), F.lit(1))
        return (
            F.when(ch.rlike("[0-9]"), pick("0123456789"))
            .when(ch.rlike(r"\p{IsCyrillic}") & ch.rlike(r"\p{Lu}"), pick("АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ"))
            .when(ch.rlike(r"\p{IsCyrillic}"), pick("абвгдежзиклмнопрстуфхцчшэюя"))
            .when(ch.rlike(r"\p{IsGreek}") & ch.rlike(r"\p{Lu}"), pick("ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"))
            .when(ch.rlike(r"\p{IsGreek}"), pick("αβγδεζηθικλμνξοπρστυφχψω"))
            .when(ch.rlike(r"\p{Lu}"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
            .when(ch.rlike(r"\p{L}"), pick("abcdefghijklmnopqrstuvwxyz"))
            .otherwise(ch)
        )

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(form)), at), "")


def _hexed(form: Column, digest: Column) -> Column:
    """Hexadecimal digits in the form's length and case."""
    long = F.substr(F.repeat(digest, F.floor(F.length(form) / 64).cast("int") + 1), F.lit(1), F.length(form))
    return F.when(form.rlike("[A-F]"), F.upper(long)).otherwise(long)


def _address(text: Column, key: Column, attempt: Column) -> Column:
    part = lambda octets, k: F.element_at(octets, k).cast("long") * 256 + F.element_at(octets, k + 1).cast("long")
    state = let(F.split(text, r"\."), lambda octets: F.struct(part(octets, 1).alias("l"), part(octets, 3).alias("r")))
    for turn in (1, 2, 3, 4):

        def step(v: Column, turn: int = turn) -> Column:
            new = lambda own, other: F.pmod(own + _number(_hash(key, F.lit(turn), attempt, other)), F.lit(65536))
            return F.struct(new(v["l"], v["r"]).alias("l"), v["r"].alias("r")) if turn % 2 else F.struct(v["l"].alias("l"), new(v["r"], v["l"]).alias("r"))

        state = let(state, step)
    return let(state, lambda v: F.concat_ws(".", *[x.cast("string") for x in (F.floor(v["l"] / 256), v["l"] % 256, F.floor(v["r"] / 256), v["r"] % 256)]))


def _words(names: tuple[str, ...]) -> Column:
    """A constant array, in one node of the plan."""
    return F.split(F.lit(" ".join(names)), " ")


def _syllables(word: Column, digest: Column, attempt: Column, least: int = 4) -> Column:
    """A name of `least` syllables in the word's script, of more from the second attempt on; fewer are enough where a sign is a syllable."""

    def spelled(x: Column) -> Column:
        pick = lambda k: F.element_at(x["names"], (1 + F.conv(F.substr(x["digest"], 1 + 4 * k, F.lit(4)), 16, 10).cast("int") % F.size(x["names"])).cast("int"))
        return F.initcap(F.array_join(F.transform(F.sequence(F.lit(0), x["n"] - 1), pick), ""))

    han, few = word.rlike(r"\p{IsHan}|\p{IsHiragana}|\p{IsKatakana}|\p{IsHangul}"), word.rlike(r"\p{IsDevanagari}|\p{IsArabic}")
    names = (
        F.when(word.rlike(r"\p{IsLatin}"), _words(LATIN_SYLLABLES))
        .when(word.rlike(r"\p{IsCyrillic}"), _words(CYRILLIC_SYLLABLES))
        .when(word.rlike(r"\p{IsGreek}"), _words(GREEK_SYLLABLES))
        .when(han, _words(HAN_SYLLABLES))
        .when(word.rlike(r"\p{IsDevanagari}"), _words(DEVANAGARI_SYLLABLES))
        .when(word.rlike(r"\p{IsArabic}"), _words(ARABIC_SYLLABLES))
        .otherwise(_words(LATIN_SYLLABLES))
    )
    n = F.when(han, 2).when(few, least - 1).otherwise(least) + F.when(attempt > 2, 3).when(attempt > 0, 1).otherwise(0)
    return let(F.struct(names.alias("names"), n.alias("n"), digest.alias("digest")), spelled)


def _given(name: Column, key: Column, seed: str) -> Column:
    """A given name of the same gender: the list shifted by a keyed step, so that two names stay two; null if it isn't listed."""
    out = F.lit(None).cast("string")
    for names in (MALE_NAMES, FEMALE_NAMES):
        step = 1 + _number(_hash(key, F.lit(seed))) % (len(names) - 1)
        place = F.array_position(_words(names), name)
        out = F.coalesce(out, F.when(place > 0, F.element_at(_words(names), (1 + (place - 1 + step) % len(names)).cast("int"))))
    return out


def _unlisted(first: Column, title: Column, key: Column, attempt: Column) -> Column:
    """A given name that isn't listed, with an ending of the title's gender: a listed one could be another person's."""
    gender = lambda latin, cyrillic: F.when(first.rlike(r"\p{IsCyrillic}"), cyrillic).when(first.rlike(r"\p{IsLatin}"), latin).otherwise("")
    bare = F.regexp_replace(title, r"\.? $", "")
    ending = F.when(bare.isin(*FEMALE_TITLES), gender("a", "а")).when(bare.isin(*MALE_TITLES), gender("o", "ий")).otherwise("")
    return F.concat(_syllables(first, _hash(key, F.lit("given"), F.lower(first), attempt), attempt, 3), ending)


def _parts(found: Column) -> Column:
    """title (with its blank), first (null if there is none) and surname of a mention of a person."""
    rest = lambda t: F.split(F.substr(found, F.length(t) + 1), " ")
    named = lambda x: F.struct(x["title"].alias("title"), F.when(F.size(x["rest"]) > 1, F.element_at(x["rest"], 1)).alias("first"), F.element_at(x["rest"], -1).alias("surname"))
    title = F.regexp_extract(found, rf"^((?:{_TITLE})\.? )", 1)
    return let(let(title, lambda t: F.struct(t.alias("title"), rest(t).alias("rest"))), named)


def _person(found: Column, key: Column, attempt: Column, of_given: Column) -> Column:
    def of(x: Column) -> Column:
        new = _syllables(x["surname"], _hash(key, F.lit("surname"), F.lower(x["surname"]), attempt), attempt)
        first = F.coalesce(_given(x["first"], key, "names"), _unlisted(x["first"], x["title"], key, of_given))
        return F.concat(x["title"], F.when(x["first"].isNotNull(), F.concat(first, F.lit(" "))).otherwise(""), new)

    return let(_parts(found), of)


def _account(found: Column, normal: Column, digest: Column) -> Column:
    """Letters and digits of the same form; where the check digits were right (modulo 97), they are right again."""

    def rest(a: Column, ch: Column) -> Column:
        return F.when(ch == "", a).when(ch.rlike("[0-9]"), (a * 10 + F.ascii(ch) - 48) % 97).otherwise((a * 100 + F.ascii(ch) - 55) % 97)

    value = lambda country, check, body: F.aggregate(F.split(F.concat(body, country, check), ""), F.lit(0), rest)
    country, old = F.substring(normal, 1, 2), F.substring(normal, 3, 2)
    right = value(country, old, F.substr(normal, F.lit(5))) == 1
    check = lambda body: F.when(right, F.lpad((98 - value(country, F.lit("00"), body)).cast("string"), 2, "0")).otherwise(_spelled(old, F.sha2(digest, 256)))
    return _written(found, let(_spelled(F.substr(normal, F.lit(5)), digest), lambda body: F.concat(country, check(body), body)), "[A-Z0-9]")


def surrogate(kind: Column, found: Column, normal: Column, key: Column, attempt: Column, of_given: Column | None = None) -> Column:
    """The replacement of a mention, in its own format. normal: its normal form; attempt: of the entity, for persons of the surname, and of_given that of an unlisted given name."""
    of_given = F.lit(0) if of_given is None else of_given

    def of(digest: Column) -> Column:
        return (
            F.when(kind == "email", F.concat(_spelled(F.substring_index(found, "@", 1), digest), F.when(attempt > 3, F.concat(F.lit("."), F.substring(digest, 1, 8))).otherwise(""), F.lit("@d"), F.substring(_hash(key, F.lit("domain"), F.lower(F.substring_index(found, "@", -1))), 1, 8), F.lit(".example.org")))
            .when(kind == "secret", F.concat(F.substr(found, F.lit(1), F.length(found) - F.length(normal)), F.when(normal.rlike("^[0-9a-fA-F]+$"), _hexed(normal, digest)).otherwise(_spelled(normal, digest))))
            .when((kind == "ip") & F.contains(found, F.lit(":")), F.concat(F.lit("2001:0db8"), *[F.concat(F.lit(":"), F.substring(digest, 1 + 4 * i, 4)) for i in range(6)]))
            .when(kind == "ip", _address(found, key, attempt))
            .when(kind == "account", _account(found, normal, digest))
            .when(kind == "card", _written(found, _card(normal, key, attempt)))
            .when(kind.isin("ssn", "phone"), _written(found, _permuted(normal, key, attempt)))
            .when(kind == "given", _unlisted(found, F.lit(""), key, attempt))
            .otherwise(_person(found, key, attempt, of_given))
        )

    return let(_hash(key, kind, normal, attempt), of)


def entities(docs: DataFrame) -> DataFrame:
    """doc_id, kind, normal and the mention, a row for each mention in the documents; an unlisted given name is one more, of kind `given`."""
    found = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))).alias("found"))
    kinds = found.withColumn("kind", kind_of(F.col("found")))
    first = F.when(F.col("kind") == "person", _parts(F.col("found"))["first"])
    unlisted = F.when(~first.isin(*MALE_NAMES, *FEMALE_NAMES), first)
    each = kinds.select("doc_id", F.explode(F.filter(F.array(F.struct("kind", "found"), F.struct(F.lit("given").alias("kind"), unlisted.alias("found"))), lambda x: x["found"].isNotNull())).alias("_e")).select("doc_id", "_e.kind", "_e.found")
    return each.withColumn("normal", normal_form(F.col("kind"), F.col("found")))


def exceptions(found: DataFrame, key: str) -> DataFrame | None:
    """kind, normal and attempt of the entities whose first surrogate collides; None if none does.

    The form that stands for an entity is its least mention. Each round compares all surrogates with each other and with
    all originals; of those that share one, the least normal form keeps it.
    """
    k, kind, attempt = F.lit(key), F.col("kind"), F.col("attempt")
    all_ = cut(found.groupBy("kind", "normal").agg(F.min("found").alias("form")).withColumns({"attempt": F.lit(0), "fixed": F.lit(False)}))
    if all_.isEmpty():
        return None
    originals = all_.select("kind", F.col("normal").alias("_made"), F.lit(True).alias("_taken"))
    changed = False
    for turn in range(1, ATTEMPTS + 1):
        # stored, so that the long expressions stand in one plain projection, and what follows has columns alone
        made = stored(all_.withColumn("_new", surrogate(kind, F.col("form"), F.col("normal"), k, attempt)).withColumn("_made", normal_form(kind, F.col("_new"))).drop("_new"))
        first = made.groupBy("kind", "_made").agg(F.min(F.struct("attempt", "normal")).alias("_first"), F.count("*").alias("_sharing")).where("_sharing > 1")
        judged = made.join(first, ["kind", "_made"], "left").join(originals, ["kind", "_made"], "left")
        shared = F.col("_sharing").isNotNull() & (F.struct("attempt", "normal") != F.col("_first"))
        bad = ~F.col("fixed") & (F.coalesce(F.col("_taken"), F.lit(False)) | shared)
        judged = cut(judged.select("kind", "normal", "form", "fixed", F.when(bad, F.lit(turn)).otherwise(attempt).alias("attempt"), bad.alias("_bad")))
        discard(made)
        all_ = judged.drop("_bad")
        if judged.where("_bad").isEmpty():
            break
        changed = True
        if turn == LATE:  # a format of permuted digits (kind and length: a few dozen) without free places: one permutation of all of them
            dense = judged.where(F.col("_bad") & kind.isin(*PERMUTED)).select("kind", F.length("normal").alias("_n")).distinct().withColumn("_dense", F.lit(True))
            marked = all_.withColumn("_n", F.length("normal")).join(F.broadcast(dense), ["kind", "_n"], "left").withColumn("_dense", F.coalesce("_dense", F.lit(False)))
            all_ = cut(marked.select("kind", "normal", "form", (F.col("fixed") | F.col("_dense")).alias("fixed"), F.when(F.col("_dense"), 0).otherwise(attempt).alias("attempt")))
    return all_.where("attempt > 0").select("kind", "normal", "attempt") if changed else None


def replace(docs: DataFrame, key: str, kinds: str | None = "_pii") -> DataFrame:
    """docs with surrogates in text and, if `kinds` names a column, an array of the kinds found, last."""
    k = F.lit(key)
    if kinds in docs.columns:
        raise ValueError(f"there is a column {kinds} already")
    found = stored(entities(docs))
    odd = exceptions(found, key)
    # columns of this function's own lie in structs, so that they clash with no other
    own, rows = F.lit(None).cast("map<string,int>"), docs.select(F.struct("*").alias("d"))
    if odd is not None:
        held = found.where("doc_id is not null").join(odd, ["kind", "normal"]).groupBy("doc_id").agg(F.map_from_entries(F.collect_set(F.struct(F.concat_ws("\x1f", "kind", "normal").alias("name"), "attempt"))).alias("odd"))
        held = stored(held)
        few = held.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
        discard(found)
        rows = rows.join(F.broadcast(held) if few else held, F.col("d.doc_id") == F.col("doc_id"), "left").select("d", "odd")
        own = F.col("odd")

    def changed(mention: Column) -> Column:
        def attempt(kind: Column | str, normal: Column) -> Column:
            return F.coalesce(F.try_element_at(own, F.concat_ws("\x1f", F.lit(kind) if isinstance(kind, str) else kind, normal)), F.lit(0)) if odd is not None else F.lit(0)

        def of(x: Column) -> Column:
            return surrogate(x["kind"], mention, x["normal"], k, attempt(x["kind"], x["normal"]), attempt("given", F.lower(_parts(mention)["first"])))

        return let(let(kind_of(mention), lambda kind: F.struct(kind.alias("kind"), normal_form(kind, mention).alias("normal"))), of)

    text = F.col("d.text")
    mentions = rows.withColumn("found", F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)))
    parts = F.zip_with(F.split(text, PATTERN, -1), F.transform("found", changed), lambda a, b: F.concat(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))))
    new = F.when(F.size("found") > 0, F.array_join(parts, "")).otherwise(text).alias("text")
    last = [F.coalesce(F.transform("found", kind_of), F.array().cast("array<string>")).alias(kinds)] if kinds else []
    return mentions.select(*[new if c == "text" else F.col("d")[c].alias(c) for c in docs.columns], *last)
