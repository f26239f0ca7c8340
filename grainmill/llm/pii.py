"""Personal data replaced by keyed surrogates of the same kind and format.

Kinds: e-mail addresses, payment cards, phone numbers (grouped by signs or spaces), IPv4 addresses, social security numbers, bank accounts
(in groups of four or not), access keys, secrets (``token = "..."`` with at least one letter or digit, and hexadecimal strings of 32 digits or
more) and names after a form of address or ``Name:``. A surrogate is a function of a key and the normalised entity (digits of a phone
number, lower-case e-mail address ...), rendered in the format of each occurrence: separators and letter case stay, cards keep their first
digit and whether their check digit holds, phone numbers their first digit, bank accounts their country, IPv4 octets stay octets,
hexadecimal stays hexadecimal, names keep the gender of the form of address (none for ``Dr``, ``Prof`` and ``Name:``, unless the same
name stands after a gendered form elsewhere), their script and their number of words. The same entity gets the same surrogate
everywhere, and a family name keeps its surrogate with and without a given name: family names are entities of their own, of any gender.

The distinct entities of all documents are one table, and so are their surrogates, computed kind by kind. Collision check: of entities
that share a surrogate all but the first, and entities whose surrogate is itself an entity of the corpus, take the next attempt, until
none is left. Late attempts add characters, so a format whose values are all taken grows (a card or a phone number then has more digits)
rather than repeat one. The replacements of a text depend on the text only: they are found once per distinct text, by its digest, joined
to the table of surrogates, and meet the texts again by digest. Texts without entities are not moved.

Defined results: null text stays null; text without entities stays as it is, byte for byte; repeated rows get equal texts, also with a
null or repeated doc_id; an empty table gives no rows; other columns stay.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .common import stored

KEY = "surrogate-1"
#: Attempts after which a surrogate grows by a character each.
MORE = 8

# Forms of address by gender, given names by script and gender, syllables of family names by script.
MALE = ("Mr", "Mister", "Sir", "Herr", "Herrn", "Señor", "Signor", "Monsieur", "Господин", "Κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Madam", "Frau", "Señora", "Señorita", "Signora", "Madame", "Mademoiselle", "Госпожа", "Κυρία")
ANY = ("Dr", "Doctor", "Doktor", "Prof", "Professor", "Доктор", "Профессор", "Name:", "name:")
GIVEN = {
    ("latin", "m"): ("Alan", "Bruno", "Carl", "David", "Erik", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karl", "Leon", "Marc", "Nils", "Oscar", "Paul"),
    ("latin", "f"): ("Anna", "Berta", "Clara", "Diana", "Emma", "Frida", "Greta", "Helen", "Ines", "Julia", "Karin", "Laura", "Maria", "Nora", "Olga", "Petra"),
    ("latin", "u"): ("Alex", "Bente", "Charlie", "Dominique", "Eli", "Finn", "Gerry", "Jess", "Kim", "Luca", "Mika", "Nicola", "Robin", "Sascha", "Toni", "Valentine"),
    ("cyrillic", "m"): ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Захар", "Иван", "Кирилл", "Лев", "Максим", "Никита", "Олег", "Павел", "Роман", "Семен"),
    ("cyrillic", "f"): ("Алла", "Белла", "Вера", "Галина", "Дарья", "Елена", "Жанна", "Зоя", "Ирина", "Клара", "Лидия", "Мария", "Нина", "Ольга", "Полина", "Раиса"),
    ("cyrillic", "u"): ("Саша", "Женя", "Валя", "Слава", "Паша", "Тоша", "Шура", "Миша"),
    ("greek", "m"): ("Ανδρέας", "Βασίλης", "Γιώργος", "Δημήτρης", "Ηλίας", "Κώστας", "Νίκος", "Πέτρος"),
    ("greek", "f"): ("Άννα", "Βασιλική", "Ελένη", "Ζωή", "Ιωάννα", "Κατερίνα", "Μαρία", "Σοφία"),
    ("greek", "u"): ("Αγαθή", "Αρίς", "Θέμις", "Φώτις"),
}
SYLLABLES = {
    "latin": ("ba", "del", "fo", "gar", "hin", "ka", "lem", "mo", "nar", "pel", "ro", "sen", "ta", "ver", "wi", "zan"),
    "cyrillic": ("ба", "дел", "фо", "гар", "хин", "ка", "лем", "мо", "нар", "пел", "ро", "сен", "та", "вер", "ви", "зан"),
    "greek": ("βα", "δελ", "φο", "γαρ", "χιν", "κα", "λεμ", "μο", "ναρ", "πελ", "ρο", "σεν", "τα", "βερ", "θι", "ζαν"),
}
#: Letters of scripts without case: first and last code point.
UNCASED = ((0x5D0, 0x5EA), (0x628, 0x63A), (0x915, 0x939), (0xE01, 0xE2E), (0x10D0, 0x10F0), (0x3042, 0x3093), (0x30A2, 0x30F3), (0x4E00, 0x9FA5), (0xAC00, 0xD7A3))
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
NAMED = "|".join(MALE + FEMALE + ANY)
SECRET = r"(?i:token|password|passwd|pwd|secret|api[_-]?key)\s{0,3}[=:]\s{0,3}[\"']?"
WORD = r"[\p{Lu}\p{Lo}][\p{L}\p{M}'-]{0,40}"
#: By what may stand before them, so that most places in a text fail one test for many kinds. Fixed order: the first kind that fits wins.
AFTER_WORDS = {
    "email": r"(?<![._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}",
    "secret": rf"{SECRET}(?=[+/_-]{{0,64}}[A-Za-z0-9])[A-Za-z0-9+/_-]{{8,}}+",
    "hex": r"(?=[0-9]{0,256}[a-fA-F])[0-9a-fA-F]{32,}+(?![A-Za-z0-9])",
    "key": r"AKIA[0-9A-Z]{16}(?![A-Za-z0-9])",
    "iban": r"[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}+|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
}
SIGNED_EMAIL = r"(?<![A-Za-z0-9._%+-])[._%+-][A-Za-z0-9._%+-]*+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}"
NAME = rf"(?:{NAMED})\.? {WORD}(?: {WORD})?"
NUMBERS = {
    "ip": rf"(?<![\d.]){OCTET}(?:\.{OCTET}){{3}}(?!\.?\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?<![\d+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\) ?|\d{3}[.-])\d{3,4}[ .-]\d{3,4}(?![\d-])|(?<![\d+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d)"
    r"|(?<![\d+.,-])(?<!\d )(?:\d{3} \d{3} \d{4}|0\d{2,4} \d{3,4} \d{3,4})(?! ?\d|[.,-]\d)",
    "card": r"(?<![\d.,-])\d(?:[ -]?\d){12,18}(?![\d-])",
}
#: Every kind holds a digit, an ``@``, a sign after a word for secrets, a run of hexadecimal letters, or a form of address.
ENTITY = (
    rf"(?<![A-Za-z0-9])(?:(?=[A-Za-z0-9])(?:{'|'.join(f'(?:{p})' for p in AFTER_WORDS.values())})|(?=[._%+-]){SIGNED_EMAIL})"
    rf"|(?=[+(\d])(?:{'|'.join(f'(?:{p})' for p in NUMBERS.values())})|(?<!\p{{L}})(?=\p{{L}}){NAME}"
)
MARKS = rf"[0-9@]|[=:]|[a-fA-F]{{32}}|{NAMED}"
KINDS = ("email", "secret", "key", "iban", "ip", "ssn", "phone", "card")
NAMES = ("name_m", "name_f", "name_u")


def has_entity(text: Column) -> Column:
    """Whether a text holds an entity; false for null."""
    return F.coalesce(F.rlike(text, F.lit(MARKS)) & F.rlike(text, F.lit(ENTITY)), F.lit(False))


def kind_of(match: Column) -> Column:
    """Kind of a match, told by its own text."""
    digits = F.length(F.regexp_replace(match, r"\D", ""))
    titles = lambda words: F.rlike(match, F.lit(rf"^(?:{'|'.join(words)})[. ]"))
    return (
        F.when(F.contains(match, F.lit("@")), "email")
        .when(titles(MALE), "name_m")
        .when(titles(FEMALE), "name_f")
        .when(titles(ANY), "name_u")
        .when(F.rlike(match, F.lit(rf"^{SECRET}")), "secret")
        .when(F.rlike(match, F.lit(r"^AKIA[0-9A-Z]{16}$")), "key")
        .when(F.rlike(match, F.lit(r"^\d{1,3}(?:\.\d{1,3}){3}$")), "ip")
        .when(F.rlike(match, F.lit(r"^\d{3}-\d{2}-\d{4}$")), "ssn")
        .when(F.rlike(match, F.lit(r"^[0-9a-fA-F]{32,}$")), "secret")
        .when(F.rlike(match, F.lit(r"^[A-Z]{2}\d{2}[A-Z0-9 ]+$")), "iban")
        .when((digits >= 13) & ~F.startswith(match, F.lit("+")) & ~F.startswith(match, F.lit("(")), "card")
        .otherwise("phone")
    )


def value_of(kind: Column, match: Column) -> Column:
    """The part of a match that is replaced: secrets without what names them, names without the form of address."""
    return (
        F.when(kind == "secret", F.regexp_extract(match, r"[A-Za-z0-9+/_-]+$", 0))
        .when(F.startswith(kind, F.lit("name")), F.regexp_extract(match, r"^\p{L}+[.:]? (.*)$", 1))
        .otherwise(match)
    )


def normal(kind: Column, value: Column) -> Column:
    """What makes two occurrences the same entity."""
    return (
        F.when(kind.isin("card", "ssn", "phone"), F.regexp_replace(value, r"\D", ""))
        .when(kind == "iban", F.replace(value, F.lit(" "), F.lit("")))
        .when(kind.isin("email", "family", *NAMES), F.lower(value))
        .otherwise(value)
    )


def _stream(key: str, *parts: Column) -> Column:
    """256 keyed hexadecimal digits."""
    return F.concat(*[F.sha2(F.concat_ws("\n", F.lit(f"{key}{n}"), *parts), 512) for n in range(2)])


def _number(stream: Column, at: int, most: int) -> Column:
    """0 .. most - 1 from four digits of the stream."""
    return F.pmod(F.conv(F.substring(stream, 1 + 4 * at, 4), 16, 10).cast("int"), F.lit(most))


def _pick(stream: Column, i: Column, most: int) -> Column:
    """0 .. most - 1 for the i-th character, from four digits of the stream."""
    return F.pmod(F.conv(F.substr(stream, F.pmod(3 * i, F.lit(250)) + 1, F.lit(4)), 16, 10).cast("int"), F.lit(most))


def _filled(shape: Column, stream: Column) -> Column:
    """The shape with every digit, small and capital letter replaced by one of its kind."""
    letter = lambda i: F.substr(F.lit("abcdefghijklmnopqrstuvwxyz"), _pick(stream, i, 26) + 1, F.lit(1))
    one = lambda c, i: (
        F.when(F.rlike(c, F.lit("[0-9]")), _pick(stream, i, 10).cast("string"))
        .when(F.rlike(c, F.lit("[a-z]")), letter(i))
        .when(F.rlike(c, F.lit("[A-Z]")), F.upper(letter(i)))
        .otherwise(c)
    )
    return F.array_join(F.transform(F.split(shape, ""), one), "")


def _digits(stream: Column, n: Column) -> Column:
    """n decimal digits."""
    return F.array_join(F.transform(F.sequence(F.lit(1), n), lambda i: _pick(stream, i, 10).cast("string")), "")


def _hexadecimal(stream: Column, n: Column) -> Column:
    return F.substr(F.repeat(stream, F.ceil(n / 256).cast("int")), F.lit(1), n)


def _luhn(digits: Column) -> Column:
    """Sum of the check over digits whose last one is not doubled."""
    size = F.length(digits)

    def worth(c: Column, i: Column) -> Column:
        d = c.cast("int")
        twice = 2 * d - F.when(d > 4, 9).otherwise(0)
        return F.when(F.pmod(size - i, F.lit(2)) == 1, d).otherwise(twice)

    return F.aggregate(F.transform(F.split(digits, ""), worth), F.lit(0), lambda a, x: a + x)


def _card(norm: Column, stream: Column) -> Column:
    middle = F.concat(F.substring(norm, 1, 1), _digits(stream, F.length(norm) - 2))
    check = F.pmod(F.pmod(_luhn(norm), F.lit(10)) - _luhn(F.concat(middle, F.lit("0"))), F.lit(10))
    return F.concat(middle, check.cast("string"))


def _secret(norm: Column, stream: Column) -> Column:
    return (
        F.when(F.rlike(norm, F.lit("^[0-9a-f]+$")), _hexadecimal(stream, F.length(norm)))
        .when(F.rlike(norm, F.lit("^[0-9A-F]+$")), F.upper(_hexadecimal(stream, F.length(norm))))
        .otherwise(_filled(norm, stream))
    )


def _email(norm: Column, stream: Column, key: str) -> Column:
    domain = F.substring_index(norm, "@", -1)
    host = F.translate(F.substring(_stream(key, F.lit("domain"), domain), 1, 10), "0123456789", "ghijklmnop")
    return F.concat(_filled(F.substring_index(norm, "@", 1), stream), F.lit("@"), host, F.lit(".example"))


def _syllables(script: str, stream: Column, at: int, n: Column) -> Column:
    """n syllables from the stream, of MORE + 5 at most."""
    table = F.array(*map(F.lit, SYLLABLES[script]))
    return F.array_join(F.slice(F.array(*[F.get(table, _number(stream, at + k, 16)) for k in range(MORE + 5)]), 1, n), "")


def _uncased(word: Column, stream: Column, attempt: Column) -> Column:
    """Letters of the same script, as many as the word has and one for each attempt."""

    def one(c: Column, i: Column) -> Column:
        out = c
        for first, last in UNCASED:
            code = F.lit(first) + _pick(stream, i, last - first + 1)
            out = F.when(F.ascii(c).between(first, last), F.decode(F.unhex(F.lpad(F.hex(code), 4, "0")), "UTF-16BE")).otherwise(out)
        return out

    return F.array_join(F.transform(F.split(F.rpad(word, F.length(word) + F.least(attempt, F.lit(40)), F.substring(word, 1, 1)), ""), one), "")


def _in_script(word: Column, uncased: Column, of) -> Column:
    return (
        F.when(F.rlike(word, F.lit(r"\p{IsCyrillic}")), of("cyrillic"))
        .when(F.rlike(word, F.lit(r"\p{IsGreek}")), of("greek"))
        .when(F.rlike(word, F.lit(r"[\p{Lo}&&[^\p{IsLatin}]]")), uncased)
        .otherwise(of("latin"))
    )


def _family(norm: Column, stream: Column, attempt: Column) -> Column:
    """Surrogate of a family name; more syllables with each attempt."""
    n = 5 + F.least(attempt, F.lit(MORE))
    return _in_script(norm, _uncased(norm, stream, attempt), lambda script: F.initcap(_syllables(script, stream, 0, n)))


def _given(gender: str, norm: Column, stream: Column, attempt: Column) -> Column:
    """Surrogate of a given name: one of the table, with a syllable more for each attempt."""

    def of(script: str) -> Column:
        names = GIVEN[script, gender]
        first = F.get(F.array(*map(F.lit, names)), _number(stream, 7, len(names)))
        return F.concat(first, _syllables(script, stream, 8, F.least(attempt, F.lit(MORE))))

    return _in_script(norm, _uncased(norm, stream, attempt), of)


def family_of(name: Column) -> Column:
    """The family name of a name: its last word."""
    return F.substring_index(name, " ", -1)


def _made(kind: str, key: str) -> Column:
    """Surrogate of the column ``norm`` of one kind, from the columns ``stream`` and ``attempt``, and ``family`` for names."""
    norm, stream, attempt = F.col("norm"), F.col("stream"), F.col("attempt")
    size = F.length(norm)
    late = F.substring(_stream(key, F.lit("late"), stream), 1, 40)
    letters = F.substr(F.translate(late, "0123456789", "ghijklmnop"), F.lit(1), F.greatest(attempt - MORE, F.lit(0)))
    digits = F.substr(F.translate(late, "abcdef", "012345"), F.lit(1), F.greatest(attempt - MORE, F.lit(0)))
    if kind == "email":
        return F.concat(F.substr(F.translate(late, "0123456789", "ghijklmnop"), F.lit(1), F.least(attempt, F.lit(40))), _email(norm, stream, key))
    if kind == "card":
        return F.concat(_card(norm, stream), digits)
    if kind == "phone":
        return F.concat(F.substring(norm, 1, 1), _digits(stream, size - 1), digits)
    if kind == "ssn":
        return F.concat(F.lit("9"), _digits(stream, size - 1), digits)
    if kind == "ip":
        return F.concat(F.concat_ws(".", *[(1 + _number(stream, k, 254)).cast("string") for k in range(4)]), digits)
    if kind == "secret":
        return F.concat(_secret(norm, stream), letters)
    if kind in ("key", "iban"):
        fixed = 4 if kind == "key" else 2
        return F.concat(F.substring(norm, 1, fixed), _filled(F.substr(norm, F.lit(fixed + 1), size), stream), F.upper(letters))
    if kind == "family":
        return _family(norm, stream, attempt)
    first = _given(kind[-1], F.substring_index(norm, " ", 1), stream, attempt)
    return F.concat_ws(" ", first, F.col("family"))


def with_made(entities: DataFrame, kinds: tuple[str, ...], key: str = KEY) -> DataFrame:
    """The rows (kind, norm, attempt ...) of these kinds with their surrogate ``given``: a branch with one expression for each kind."""

    def branch(kind: str) -> DataFrame:
        rows = entities.where(F.col("kind") == kind).withColumn("stream", _stream(key, F.lit(kind), F.col("norm"), F.col("attempt").cast("string")))
        return rows.withColumn("given", _made(kind, key)).drop("stream")

    return reduce(DataFrame.unionByName, map(branch, kinds))


def _in_slots(shape: Column, chars: Column, slot: str) -> Column:
    """The shape with the characters that the pattern fits replaced in order; what is left over follows at the end."""
    start = F.struct(F.lit("").alias("s"), F.lit(1).alias("k"))

    def step(acc: Column, c: Column) -> Column:
        here = F.rlike(c, F.lit(slot))
        return F.struct(
            F.concat(acc["s"], F.when(here, F.substr(chars, acc["k"], F.lit(1))).otherwise(c)).alias("s"),
            (acc["k"] + F.when(here, 1).otherwise(0)).alias("k"),
        )

    return F.aggregate(F.split(shape, ""), start, step, lambda acc: F.concat(acc["s"], F.substr(chars, acc["k"], F.length(chars))))


def _cased(shape: Column, text: Column) -> Column:
    return F.when((shape == F.upper(shape)) & (shape != F.lower(shape)) & (F.length(shape) > 1), F.upper(text)).otherwise(text)


def _like_local(value: Column, given: Column) -> Column:
    """A small-letter address with the letter case of the local part of the value, from its end on."""
    local, new = F.substring_index(value, "@", 1), F.substring_index(given, "@", 1)
    shape = F.lpad(local, F.length(new), "x")
    out = F.zip_with(F.split(shape, ""), F.split(new, ""), lambda s, c: F.when(F.rlike(s, F.lit("[A-Z]")), F.upper(c)).otherwise(c))
    return F.concat(F.array_join(out, ""), F.lit("@"), F.substring_index(given, "@", -1))


def rendered(kind: Column, value: Column, given: Column) -> Column:
    """A surrogate in the format of an occurrence."""
    return (
        F.when(kind.isin("card", "phone", "ssn"), _in_slots(value, given, "[0-9]"))
        .when(kind == "iban", _in_slots(value, given, "[A-Z0-9]"))
        .when(kind == "email", _like_local(value, given))
        .when(kind.isin(*NAMES), _cased(value, given))
        .otherwise(given)
    )


def matches(text: Column) -> Column:
    """All entities of a text in order, as (kind, match, value)."""
    with_kind = F.transform(F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)), lambda m: F.struct(kind_of(m).alias("kind"), m.alias("match")))
    return F.transform(
        with_kind, lambda x: F.struct(x["kind"].alias("kind"), x["match"].alias("match"), value_of(x["kind"], x["match"]).alias("value"))
    )


def found(docs: DataFrame) -> DataFrame:
    """(digest, at, kind, match, value, norm): all entities of each distinct text."""
    texts = docs.select("text").where(has_entity(F.col("text"))).select(F.sha2("text", 256).alias("digest"), matches(F.col("text")).alias("e"))
    each = texts.groupBy("digest").agg(F.first("e").alias("e")).select("digest", F.posexplode("e").alias("at", "e"))
    return each.select("digest", "at", "e.*", normal(F.col("e.kind"), F.col("e.value")).alias("norm"))


def settled(entities: DataFrame, kinds: tuple[str, ...], key: str = KEY) -> DataFrame:
    """(kind, norm, given, attempt) of all entities of these kinds: no two surrogates of a kind are equal, and none is an entity.

    ``entities`` is a stored table (kind, norm, and family for names). Each round settles all that do not clash; the others try again.
    """
    extra = [c for c in entities.columns if c not in ("kind", "norm", "attempt")]
    # A handful of kinds: those that do not occur need no branch.
    there = {r["kind"] for r in entities.select("kind").distinct().collect()}
    kinds = tuple(k for k in kinds if k in there) or kinds[:1]
    real = entities.select("kind", F.col("norm").alias("value"), F.lit(True).alias("taken"))
    open_, done = entities.withColumn("attempt", F.lit(0)), None
    while True:
        tried = stored(with_made(open_, kinds, key).withColumn("value", normal(F.col("kind"), F.col("given"))), "tried")
        # Of equal surrogates the first entity in order keeps it.
        first = tried.groupBy("kind", "value").agg(F.min("norm").alias("first"))
        taken = real if done is None else real.union(done.select("kind", "value", F.lit(True)))
        tried = tried.join(first, ["kind", "value"]).join(taken, ["kind", "value"], "left")
        clash = (F.col("norm") != F.col("first")) | F.col("taken").isNotNull()
        tried = stored(tried.select("kind", "norm", *extra, "attempt", "given", "value", clash.alias("clash")), "surrogates")
        fine = tried.where("not clash").select("kind", "norm", "attempt", "given", "value")
        done = fine if done is None else done.union(fine)
        if tried.where("clash").isEmpty():
            return done.select("kind", "norm", "given", "attempt")
        open_ = tried.where("clash").select("kind", "norm", *extra, (F.col("attempt") + 1).alias("attempt"))


def surrogates(entities: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, norm, given, attempt) for a table of distinct entities (kind, norm): family names settled first, then full names with them."""
    is_name = F.col("kind").isin(*NAMES)
    families = entities.where(is_name).select(F.lit("family").alias("kind"), family_of(F.col("norm")).alias("norm")).distinct()
    families = stored(families, "entities")
    others = settled(entities.where(~is_name), KINDS, key)
    if families.isEmpty():
        return others
    families = stored(settled(families, ("family",), key).select(F.col("norm").alias("f_norm"), F.col("given").alias("family"), "attempt"), "families")
    names = entities.where(is_name).join(families.drop("attempt"), family_of(F.col("norm")) == F.col("f_norm")).drop("f_norm")
    names = stored(names, "entities")
    # A name of one word is its family name.
    alone = names.where(~F.contains("norm", F.lit(" "))).select("kind", "norm", F.col("family").alias("given"), F.lit(0).alias("attempt"))
    full = names.where(F.contains("norm", F.lit(" ")))
    # A name without gender is the same person as one with gender, if there is one.
    known = full.where("kind <> 'name_u'").groupBy(F.col("norm").alias("k_norm")).agg(F.max("kind").alias("of"))
    neutral = full.where("kind = 'name_u'").join(known, full.norm == known.k_norm, "left").drop("k_norm")
    own = full.where("kind <> 'name_u'").unionByName(neutral.where("of is null").drop("of"))
    made = stored(settled(stored(own, "entities"), NAMES, key), "full-names")
    same = made.select(F.col("kind").alias("of"), "norm", "given", "attempt")
    same = neutral.where("of is not null").select("kind", "norm", "of").join(same, ["of", "norm"]).drop("of")
    return others.unionByName(alone).unionByName(made).unionByName(same)


def replacements(docs: DataFrame, key: str = KEY) -> DataFrame:
    """(digest, new): what takes the place of each entity, in order, for each distinct text that holds one."""
    hits = stored(found(docs), "found")
    entities = stored(hits.select("kind", "norm").distinct(), "entities")
    given = stored(surrogates(entities, key).select("kind", "norm", "given"), "given")
    stem = F.substr("match", F.lit(1), F.length("match") - F.length("value"))
    new = F.concat(stem, rendered(F.col("kind"), F.col("value"), F.col("given")))
    new = hits.join(given, ["kind", "norm"]).select("digest", F.struct("at", new.alias("new")).alias("r"))
    return new.groupBy("digest").agg(F.transform(F.sort_array(F.collect_list("r")), lambda x: x["new"]).alias("new"))


def with_surrogates(docs: DataFrame, key: str = KEY) -> DataFrame:
    """The rows with every entity in ``text`` replaced, and ``n_entities``."""
    new = stored(replacements(docs, key), "replacements").select(F.col("digest").alias("e_digest"), F.col("new").alias("e_new"))
    has = has_entity(F.col("text"))
    clean = docs.where(~has).withColumn("n_entities", F.lit(0).cast("long"))
    rows = docs.where(has).withColumn("e_own", F.sha2("text", 256))
    rows = rows.join(new, F.col("e_own") == F.col("e_digest"))
    text = F.array_join(F.zip_with(F.split("text", ENTITY), F.concat("e_new", F.array(F.lit(""))), lambda gap, put: F.concat(gap, put)), "")
    rows = rows.withColumns({"text": text, "n_entities": F.size("e_new").cast("long")})
    return clean.unionByName(rows.select(*clean.columns))
