"""PII replacement by keyed, type-consistent surrogates, in DataFrame operations only.

Entities are found by one pattern. Each distinct entity, in its canonical
form, gets one surrogate for the whole corpus, so mentions stay coreferent
whatever their spelling or case; surrogates that two entities share, or that
equal a real entity, are drawn anew until none is left. A surrogate is then
written in each mention's own format: digits stay digits, letters keep their
case and script, separators stay, and names keep the gender of their title.
Names are replaced word by word, so a family name alone and one after a given
name stay the same person's. Card numbers and IBANs get valid check digits;
a bare run of 13 to 19 digits without one is no card and is left alone.

Where the values of a shape run out, addresses and names grow; numbers of a
fixed length are permuted among the real ones by a keyed order, so two
entities never share a surrogate and no job ends for want of one.

Names are found by their titles only. What stands in the shared folder while
the job runs is keyed digests, texts encrypted with the key, and new texts.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paceline.llm.spread import discard, stored

_EDGE = r"(?<![\p{L}\p{N}._%+-])"
_MALE = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин")
_FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Госпожа")
_NEUTRAL = ("Dr", "Prof", "Doctor", "Professor", "Doktor", "Docteur", "Доктор")
_NAME = r"\p{Lu}[\p{L}'’-]++"
_TITLE = r"\b(?:%s)\.? "
# Lengths of IBANs and the countries that use them.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_IBANS = "|".join(rf"(?:{'|'.join(c.split())})\d{{2}}(?: ?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}" + (rf" ?[A-Z0-9]{{{n % 4}}}" if n % 4 else "") for n, c in IBAN_LENGTHS.items())
# Telephone numbers by groups of three and four digits (with a plus, a bracket or a zero before them, or of three, three and four), in one piece, by pairs, and with a long subscriber number.
_PHONES = (
    r"(?<![\d+])\+\d{1,3}[ .-]?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?!\d)",
    r"(?<![\d+])\(\d{2,4}\)[ .-]?\d{3,4}[ .-]\d{3,4}(?!\d)",
    r"(?<![\d+.,])(?<!\d[ -])0[1-9]\d{0,2}[ .-]\d{3,4}[ .-]\d{3,4}(?!\d|[.,-]\d)",
    r"(?<![\d+.,-])(?<!\d )(?:\d{3}-\d{3}-\d{4}|\d{3}\.\d{3}\.\d{4}|\d{3} \d{3} \d{4})(?!\d|[.,-]\d)",
    r"(?<![\d+])\+\d{8,15}(?!\d)",
    r"(?<![\d+])(?:\+\d{1,3}[ .-]?(?:\(0\)[ .-]?)?|0)[1-9](?:[ .-]?\d{2}){4}(?!\d)",
    r"(?<![\d+])\+\d{1,3}(?:[ .-]?\(\d{1,4}\)[ .-]?\d{2,4})?(?:[ .-]\d{2,4}){3,5}(?!\d)",
    r"(?<![\d+])(?:[6-9]\d{2}[ .-]\d{2}|9\d[ .-]\d{3})(?:[ .-]\d{2}){2}(?![\d.-]\d|\d)",
    r"(?<![\d+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,5}[ ./-]\d{4,9}(?:-\d{1,4})?(?!\d)",
    r"(?<![\d+])\+\d{1,3}[ .-]?\(\d{1,5}\)[ ./-]?\d{4,9}(?:-\d{1,4})?(?!\d)",
    r"(?<![\d+])(?:\(0[1-9]\d{1,4}\) ?|0[1-9]\d{1,3} ?[ /-] ?)(?:\d{5,8}(?:-\d{1,4})?|\d{2,3}(?: \d{2,3}){1,3})(?!\d)",
)
# IPv6 addresses in full and with one run of zero groups left out.
_SIX = r"(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}|[0-9a-fA-F]{3,4}(?::[0-9a-fA-F]{1,4}){0,5}::(?:[0-9a-fA-F]{1,4}:){0,5}[0-9a-fA-F]{1,4}"
# Patterns of the entity types, tried in this order at each place. A name is matched with its title.
PATTERNS = {
    "email": _EDGE + r"[\p{L}\p{N}._%+-]++@(?:[A-Za-z0-9-]++\.)+[A-Za-z]{2,}",
    "secret": r"(?<![0-9A-Za-z])(?:[0-9a-fA-F]{32,}+|(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{20,}+|sk-[0-9A-Za-z_-]{20,}+)(?![0-9A-Za-z])",
    "iban": rf"(?<![0-9A-Za-z])(?=[A-Z]{{2}}\d{{2}})(?:{_IBANS}|[A-Z]{{2}}\d{{2}}(?: ?\d{{4}}){{3,7}}(?: ?\d{{1,4}})?)(?![0-9A-Za-z])",
    "ip": rf"(?=\d)(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){{3}}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)|(?=[0-9a-fA-F])(?<![\w:.])(?:{_SIX})(?![\w:])",
    "ssn": r"(?=\d)(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?=\d)(?:(?<![\d-])(?:\d{4}[ -]){3}\d{4}(?![\d-])|(?<!\d)\d{13,19}(?!\d))",
    "phone": rf"(?=[\d+(])(?:{'|'.join(_PHONES)})",
    "male": rf"(?=\p{{Lu}}){_TITLE % '|'.join(_MALE)}{_NAME}(?: {_NAME}){{0,2}}",
    "female": rf"(?=\p{{Lu}}){_TITLE % '|'.join(_FEMALE)}{_NAME}(?: {_NAME}){{0,2}}",
    "person": rf"(?=\p{{Lu}}){_TITLE % '|'.join(_NEUTRAL)}{_NAME}(?: {_NAME}){{0,2}}",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
NAMES = ("male", "female", "person")
#: No entity is without one of these.
HINT = r"[0-9@]|\b(?:Dr|Prof|Do[ck]t|Доктор)|[HMSFГ](?:rs?|s|iss|me|lle|onsieur|adame|err|rau|eñora?|ra?|осподин|оспожа)\b|A[KS]IA|gh[pousr]_|sk-|[a-fA-F]{32}"
# Syllables of surrogate names by script, and endings of given names by script and gender.
SYLLABLES = {"latin": "ba be da do ka le li ma mi na ne no ra re ri ro sa se ta ti va vi".split(), "cyrillic": "ба ва да ка ле ли ма ми на не ра ро са та ти".split(), "greek": "βα δα κα λε λι μα μι να νε ρα ρο σα τα τι".split()}
ENDINGS = {"latin": {"male": "n", "female": "a", "person": "e"}, "cyrillic": {"male": "н", "female": "а", "person": "е"}, "greek": {"male": "ς", "female": "α", "person": "ε"}}
#: Ending of a family name in Cyrillic after a woman's title.
FEMALE_FAMILY = "а"
#: Rounds in which entities in conflict draw again, and the one from which addresses and names grow by a letter or a syllable a round.
MAX_ROUNDS, GROWS_FROM = 12, 4


def _kind(value: Column) -> Column:
    """The first type whose pattern makes up the whole value."""
    first, *rest = PATTERNS.items()
    out = F.when(value.rlike(f"^(?:{first[1]})$"), first[0])
    for kind, pattern in rest:
        out = out.when(value.rlike(f"^(?:{pattern})$"), kind)
    return out


def _title(value: Column) -> Column:
    """The title of a name with the space after it; empty for other values."""
    return F.regexp_extract(value, "^(" + _TITLE.replace("\\b", "") % "|".join(_MALE + _FEMALE + _NEUTRAL) + ")", 1)


def _bare(value: Column) -> Column:
    return F.substring(value, F.length(_title(value)) + 1, F.length(value))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Luhn sum of a run of digits; 0 if its last digit is the check digit of the rest."""

    def weight(c: Column, i: Column) -> Column:
        twice = c.cast("int") * (i % 2 + 1)
        return twice - F.when(twice > 9, 9).otherwise(0)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), weight), F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0))) % 10


def _mod97(text: Column) -> Column:
    """Remainder by 97 of digits and capitals read as numbers from A = 10."""
    step = lambda a, c: F.when(c.between("0", "9"), a * 10 + c.cast("int")).otherwise(a * 100 + F.ascii(c) - 55) % 97
    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0), step)


def _canonical(kind: Column, value: Column) -> Column:
    return F.when(kind.isin("phone", "card", "ssn"), _digits(value)).when(kind == "iban", F.replace(value, F.lit(" "), F.lit(""))).when((kind == "secret") & ~value.rlike("[G-Zg-z_-]"), F.lower(value)).when(kind.isin("email", "ip"), F.lower(value)).otherwise(value)


def _units(kind: Column, value: Column) -> Column:
    """The parts of a mention that get surrogates: a name's words, or all of it (j, unit, canonical, part)."""
    words = F.split(_bare(value), " ")
    last = F.size(words) - 1
    of_name = F.transform(words, lambda w, j: F.struct(j.alias("j"), F.when(j == last, F.lit("family")).otherwise(F.concat(F.lit("given_"), kind)).alias("unit"), F.lower(w).alias("canonical"), w.alias("part")))
    whole = F.array(F.struct(F.lit(0).alias("j"), kind.alias("unit"), _canonical(kind, value).alias("canonical"), value.alias("part")))
    return F.when(kind.isin(*NAMES), of_name).otherwise(whole)


def _byte(digest: Column, i: Column) -> Column:
    """Byte i of a hex digest of 128 characters, used in rotation."""
    return F.conv(F.substring(digest, F.pmod(i * 2, F.lit(126)) + 1, F.lit(3)), 16, 10).cast("int")


def _same_class(value: Column, digest: Column) -> Column:
    """Each letter and digit replaced by one of its class, case and script."""

    def one(c: Column, i: Column) -> Column:
        b = _byte(digest, i)
        pick = lambda letters: F.substring(F.lit(letters), F.pmod(b, F.lit(len(letters))) + 1, F.lit(1))
        return (
            F.when(c.between("0", "9"), pick("0123456789"))
            .when(c.between("a", "z"), pick("abcdefghijklmnopqrstuvwxyz"))
            .when(c.between("A", "Z"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
            .when(c.rlike(r"^\p{IsCyrillic}$"), pick("абвгдежзиклмнопрстуфхцчшэюя"))
            .when(c.rlike(r"^\p{IsGreek}$"), pick("αβγδεζηθικλμνξοπρστυφχψω"))
            .when(c.rlike(r"^\p{IsLatin}$"), pick("áâäåçèéêëìíîïñòóôöùúûü"))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(value, ""), one), "")


def _surrogate(kind: Column, canonical: Column, digest: Column, grown: int = 0) -> Column:
    """The surrogate of a canonical value, in canonical form; addresses, keys with a prefix and names are ``grown`` by so many letters or syllables."""
    digits = F.array_join(F.transform(F.split(canonical, ""), lambda c, i: F.pmod(_byte(digest, i), F.lit(10)).cast("string")), "")
    code = F.when((kind == "phone") & (F.length(canonical) > 10), F.length(canonical) - 10).otherwise(F.lit(0))
    phone = F.concat(F.substring(canonical, F.lit(1), code), F.substring(digits, code + 1, F.length(canonical)))
    octets = F.array_join(F.array(*((F.pmod(_byte(digest, F.lit(3 * k)), F.lit(254)) + 1).cast("string") for k in range(4))), ".")
    hexes = F.array_join(F.transform(F.split(canonical, ""), lambda c, i: F.substring(digest, F.pmod(i, F.lit(127)) + 1, F.lit(1))), "")
    at, at_colon = F.instr(canonical, F.lit("@")), F.instr(canonical, F.lit(":"))
    dot = F.length(canonical) - F.length(F.substring_index(canonical, ".", -1))
    more = F.translate(F.substring(digest, F.lit(65), F.lit(grown)), "0123456789", "ghijklmnop")
    email = F.concat(more, _same_class(F.substring(canonical, F.lit(1), dot - 1), digest), F.substring(canonical, dot, F.length(canonical)))
    email = F.when(at > 0, email)
    country, account = F.substring(canonical, 1, 2), F.substring(_same_class(canonical, digest), F.lit(5), F.length(canonical))
    iban = F.concat(country, F.lpad((98 - _mod97(F.concat(account, country, F.lit("00")))).cast("string"), 2, "0"), account)
    card = F.concat(F.substring(canonical, 1, 1), F.substring(digits, F.lit(2), F.length(canonical) - 2))
    card = F.concat(card, ((10 - _luhn(F.concat(card, F.lit("0")))) % 10).cast("string"))
    six = F.array_join(F.transform(F.split(canonical, ""), lambda c, i: F.when(c == ":", c).otherwise(F.substring(digest, F.pmod(i, F.lit(127)) + 1, F.lit(1)))), "")
    prefix = F.regexp_extract(canonical, r"^(AKIA|ASIA|gh[pousr]_|sk-)", 1)
    keyed = F.concat(prefix, F.substring(_same_class(canonical, digest), F.length(prefix) + 1, F.length(canonical)), more)
    script = F.when(canonical.rlike(r"\p{IsCyrillic}"), "cyrillic").when(canonical.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")

    def name(of: str) -> Column:
        bank = F.array(*map(F.lit, SYLLABLES[of]))
        pick = lambda k: F.get(bank, F.pmod(_byte(digest, F.lit(k)), F.lit(len(SYLLABLES[of]))))
        end = F.lit("")
        for gender, x in ENDINGS[of].items():
            end = F.when(kind == f"given_{gender}", x).otherwise(end)
        return F.concat(*(pick(k) for k in range(5 + grown)), end)

    names = F.when(script == "cyrillic", name("cyrillic")).when(script == "greek", name("greek")).otherwise(name("latin"))
    return F.when(kind == "email", email).when(kind == "secret", F.when(canonical.rlike("^[0-9a-f]+$"), hexes).otherwise(keyed)).when(kind == "iban", iban).when(kind == "ip", F.when(at_colon > 0, six).otherwise(octets)).when(kind == "phone", phone).when(kind == "card", card).when(kind == "ssn", digits).otherwise(names)


def _written(kind: Column, unit: Column, value: Column, surrogate: Column) -> Column:
    """A canonical surrogate in the format of the part of a mention that it replaces."""
    chars = F.split(value, "")
    digits = F.array_join(F.transform(chars, lambda c, i: F.when(c.between("0", "9"), F.substring(surrogate, F.length(_digits(F.substring(value, F.lit(1), i + 1))), F.lit(1))).otherwise(c)), "")
    spaced = F.array_join(F.transform(chars, lambda c, i: F.when(c == " ", c).otherwise(F.substring(surrogate, F.length(F.replace(F.substring(value, F.lit(1), i + 1), F.lit(" "), F.lit(""))), F.lit(1)))), "")
    capital = (value == F.upper(value)) & (value != F.lower(value))
    word = F.concat(surrogate, F.when((unit == "family") & (kind == "female") & value.rlike(r"\p{IsCyrillic}"), FEMALE_FAMILY).otherwise(""))
    named = F.when(capital, F.upper(word)).otherwise(F.initcap(word))
    return F.when(kind.isin("phone", "card", "ssn"), digits).when(kind == "iban", spaced).when(kind.isin(*NAMES), named).when((kind == "secret") & surrogate.rlike("[G-Zg-z_-]"), surrogate).when(capital, F.upper(surrogate)).otherwise(surrogate)


def _digest(key: str, kind: Column, value: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), kind, value), 256)


def _shape(kind: Column, canonical: Column) -> Column:
    """What a surrogate keeps of a value of fixed length: its length and what stands before the part that is drawn."""
    kept = F.when(kind == "phone", F.substring(canonical, F.lit(1), F.greatest(F.length(canonical) - 10, F.lit(0)))).when(kind == "card", F.substring(canonical, 1, 1)).when(kind == "iban", F.substring(canonical, 1, 2)).when(kind == "ip", F.regexp_replace(canonical, "[^:.]+", "x")).otherwise("")
    return F.concat_ws("|", kept, F.when(kind != "ip", F.length(canonical).cast("string")))


def permuted(members: DataFrame) -> DataFrame:
    """entity, kind and as ``surrogate`` the canonical value of the entity that follows in its (kind, shape), by the order of their keyed digests; after the last comes the first.

    Digests are dealt to buckets by their first digits, so no task needs all
    entities of a shape; the last of a bucket takes the first of the next one,
    from a table of at most 4096 rows a shape.
    """
    rows = members.withColumn("bucket", F.substring("entity", 1, 3))
    within = Window.partitionBy("kind", "shape", "bucket").orderBy("entity")
    led = rows.withColumn("next", F.lead("canonical").over(within))
    firsts = rows.groupBy("kind", "shape", "bucket").agg(F.min_by("canonical", "entity").alias("own"))
    along = Window.partitionBy("kind", "shape").orderBy("bucket")
    whole = along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = firsts.select("kind", "shape", "bucket", F.coalesce(F.lead("own").over(along), F.first("own").over(whole)).alias("after"))
    return led.join(after, ["kind", "shape", "bucket"]).select("entity", "kind", F.coalesce("next", "after").alias("surrogate"))


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """entity (keyed digest), surrogate of distinct entities (kind, canonical); within a kind no two share one, and none is a real value while there are others.

    Rounds draw again only for entities in conflict, all but the first of
    those that share a surrogate. A drawn surrogate depends on the entity's
    digest and shape, so each round goes back to the entities for those that
    it redraws; the table in the shared folder has digests and surrogates.
    Shapes in which conflicts are left after the last round are so full that
    their real values are permuted.
    """
    kind, canonical = F.col("kind"), F.col("canonical")
    first = entities.select("kind", "canonical").distinct().withColumn("entity", _digest(key, kind, canonical))
    drawn = lambda n: _surrogate(kind, canonical, F.sha2(F.concat_ws("|", F.lit(key), "kind", "canonical", F.lit(str(n))), 512), max(0, n - GROWS_FROM + 1))
    mapping = stored(first.select("entity", "kind", drawn(0).alias("surrogate")), "pii-map")
    for n in range(1, MAX_ROUNDS):
        shared = mapping.groupBy("kind", "surrogate").agg(F.min("entity").alias("owner"), F.count(F.lit(1)).alias("n")).where("n > 1").select("kind", "surrogate", "owner")
        real = mapping.withColumn("as_entity", _digest(key, kind, F.col("surrogate"))).join(mapping.select(F.col("entity").alias("as_entity")), "as_entity", "left_semi").select("kind", "surrogate").distinct()
        clash = shared.unionByName(real.withColumn("owner", F.lit(None).cast("string"))).groupBy("kind", "surrogate").agg(F.min("owner").alias("owner"), F.count_if(F.col("owner").isNull()).alias("real"))
        redo = stored(mapping.join(clash, ["kind", "surrogate"]).where((F.col("real") > 0) | (F.col("entity") != F.col("owner"))).select("entity"), "pii-clash")
        if redo.isEmpty():
            discard(redo)
            return mapping
        if n == MAX_ROUNDS - 1:
            shaped = first.withColumn("shape", _shape(kind, canonical))
            full = shaped.join(redo, "entity").select("kind", "shape").distinct()
            swapped = permuted(shaped.join(full, ["kind", "shape"], "left_semi"))
            last, mapping = mapping, stored(mapping.join(swapped.select("entity"), "entity", "left_anti").unionByName(swapped), "pii-map")
            discard(last, redo)
            return mapping
        again = first.join(redo, "entity").select("entity", "kind", drawn(n).alias("surrogate"))
        last, mapping = mapping, stored(mapping.join(redo, "entity", "left_anti").unionByName(again), "pii-map")
        discard(last, redo)
    return mapping


def row_key() -> Column:
    """A digest of a row's id and text; rows that agree in both share it."""
    name = F.col("id").cast("string")
    return F.md5(F.concat(F.coalesce(F.length(name).cast("string"), F.lit("-")), F.lit("|"), F.coalesce(name, F.lit("")), F.lit("|"), F.coalesce("text", F.lit(""))))


def _found(rows: DataFrame) -> DataFrame:
    """Rows with an entity hint: key, rest of the row, pieces of text between entities, and these (i, kind, value, canonical)."""

    def entity(v: Column, i: Column) -> Column:
        return F.struct(i.alias("i"), v.alias("value"))

    values = F.transform(F.regexp_extract_all("text", F.lit(f"({ANY})"), 1), entity)
    return rows.select("row", row_key().alias("key"), F.split("text", ANY, -1).alias("pieces"), values.alias("entities"))


def _sealed(found: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """``found`` kept in the shared folder with its texts encrypted by the job's key, and the stored table itself."""
    secret = F.unhex(F.lit(hashlib.sha256(f"sealed|{key}".encode()).hexdigest()))
    sealed = ["pieces", "entities"]
    kinds = {c: found.schema[c].dataType.simpleString() for c in sealed}
    kept = stored(found.withColumns({c: F.aes_encrypt(F.to_json(c), secret) for c in sealed}), "pii-found")
    return kept.withColumns({c: F.from_json(F.aes_decrypt(c, secret).cast("string"), kinds[c]) for c in sealed}), kept


def replaced(docs: DataFrame, key: str, id_col: str, text_col: str) -> DataFrame:
    """Every row's other columns as ``row`` with its new ``text`` and its ``kinds`` of entities.

    Rows with a hint of an entity are searched once and kept in the shared folder in pieces.
    """
    others = F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in docs.columns if c != text_col))
    rows = docs.select(others.alias("row"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    hinted = F.coalesce(F.col("text").rlike(HINT), F.lit(False))
    plain = rows.where(~hinted).select("row", "text", F.array().cast("array<string>").alias("kinds"))
    found, opened = _sealed(_found(rows.where(hinted)), key)
    kind = _kind(F.col("value"))
    bare = F.col("value").rlike("^[0-9]+$") & (_luhn(F.col("value")) != 0)
    raw = found.select("key", F.explode("entities").alias("e")).select("key", "e.*").withColumn("kind", kind).withColumn("kind", F.when((F.col("kind") == "card") & bare, None).otherwise(F.col("kind")))
    mentions = raw.dropDuplicates(["key", "i"])
    units = mentions.where("kind is not null").withColumn("u", F.explode(_units(F.col("kind"), F.col("value")))).select("key", "i", "kind", "value", "u.*")
    mapping = surrogates(units.select(F.col("unit").alias("kind"), "canonical"), key)
    joined = units.withColumn("entity", _digest(key, F.col("unit"), F.col("canonical"))).join(mapping.select("entity", "surrogate"), "entity")
    parts = joined.select("key", "i", "kind", "value", F.struct("j", _written(F.col("kind"), F.col("unit"), F.col("part"), F.col("surrogate")).alias("new")).alias("p"))
    whole = parts.groupBy("key", "i").agg(F.first("kind").alias("kind"), F.first("value").alias("value"), F.sort_array(F.collect_list("p")).alias("p"))
    written = whole.select("key", F.struct("i", "kind", F.concat(_title(F.col("value")), F.array_join("p.new", " ")).alias("new")).alias("m"))
    others = mentions.where("kind is null").select("key", F.struct("i", "kind", F.col("value").alias("new")).alias("m"))
    per_row = written.unionByName(others).groupBy("key").agg(F.sort_array(F.collect_list("m")).alias("m"))
    joined = found.select("key", "row", "pieces").join(per_row, "key", "left")
    text = F.array_join(F.zip_with("pieces", F.coalesce(F.col("m.new"), F.array().cast("array<string>")), lambda p, s: F.concat(F.coalesce(p, F.lit("")), F.coalesce(s, F.lit("")))), "")
    kinds = F.filter(F.coalesce(F.col("m.kind"), F.array().cast("array<string>")), lambda k: k.isNotNull())
    masked = stored(joined.select("row", text.alias("text"), kinds.alias("kinds")), "pii-masked")
    discard(opened, mapping)
    return plain.unionByName(masked)


def replace_pii(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Texts with their entities replaced: doc_id, text, n_entities and counts by kind.

    ``key`` is the job's secret: who has it can draw a surrogate again.

    Null texts stay null and empty ones empty, with no entities. Rows with a
    null or repeated id are replaced like any other; all mentions of one
    entity get one surrogate in the whole table. Other columns are ignored;
    an empty table gives an empty result.
    """
    out = replaced(docs.select(id_col, text_col), key, id_col, text_col)
    n = lambda k: F.size(F.filter("kinds", lambda x: x == k)).cast("long").alias(f"n_{k}")
    return out.select(F.col(f"row.{id_col}").alias("doc_id"), "text", F.size("kinds").cast("long").alias("n_entities"), *map(n, PATTERNS))


def without_pii(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """The documents with replaced texts and their other columns, the length column following the new text."""
    out = replaced(docs, key, id_col, text_col)
    fresh = {text_col: F.col("text"), length_col: F.length("text").cast("long")}
    return out.select(*(fresh[c].alias(c) if c in fresh else F.col(f"row.`{c}`").alias(c) for c in docs.columns))
