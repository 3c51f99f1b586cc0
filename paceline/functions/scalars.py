"""Scalar column functions: binning, text cleaning, dates, odds, arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Distance bands by name (upper cuts in metres, closed on the right or left, labels).
DISTANCE_BANDS = {
    "A": ((1200, 1600, 2200, 3000), "right", ("sprint", "short", "middle", "long", "marathon")),
    "B": ((1300, 1800, 2200, 2800), "left", ("sprint", "mile", "middle", "long", "marathon")),
    "C": ((1400, 1800, 2200, 2800), "right", ("sprint", "mile", "middle", "long", "marathon")),
    "D": ((1400, 1800, 2400), "left", ("sprint", "mile", "middle", "long")),
    "E": ((1400, 1800, 2200, 2800), "left", ("sprint", "mile", "middle", "long", "marathon")),
}
# Texts that stand for a missing value.
NULL_TOKENS = ("", "[]", "none", "n/a", "-", "?", "inconnu", "nan", "null")
# Accented letters and their bare forms.
ACCENTED, BARE = "àâäáãåçéèêëíìîïñóòôöõúùûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy"


def binned(x: Column, cuts: tuple, labels: tuple, closed: str = "left") -> Column:
    """Label of the bin of x: closed left puts a cut into the bin above it, closed right into the one below. Null stays null."""
    out = None
    for cut, label in zip(cuts, labels, strict=False):
        inside = x < cut if closed == "left" else x <= cut
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return F.when(x.isNotNull(), out.otherwise(labels[-1]))


def distance_band(x: Column, name: str) -> Column:
    cuts, closed, labels = DISTANCE_BANDS[name]
    return binned(x, cuts, labels, closed)


def bare(x: Column) -> Column:
    """Lower case without accents."""
    return F.translate(F.lower(x), ACCENTED, BARE)


def name_key(x: Column) -> Column:
    """Upper case letters, digits and single spaces, for matching names."""
    return F.nullif(F.trim(F.regexp_replace(F.upper(bare(x)), "[^A-Z0-9]+", " ")), F.lit(""))


def slug(x: Column) -> Column:
    return F.trim(F.regexp_replace(bare(x), "[^a-z0-9]+", "-"), F.lit("-"))


def clean_null(x: Column) -> Column:
    return F.when(~F.lower(F.trim(x)).isin(*NULL_TOKENS), x)


def repaired(x: Column) -> Column:
    """UTF-8 that was read as Latin-1, read anew; texts that aren't such stay as they are."""
    anew = F.try_validate_utf8(F.encode(x, "ISO-8859-1").cast("string"))
    return F.when(x.rlike(r"^[\x{00}-\x{FF}]*$"), F.coalesce(anew, x)).otherwise(x)


def alias(x: Column, table: dict[str, str]) -> Column:
    """The canonical form of a value, or the value itself."""
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(v) for kv in table.items() for v in kv)), x), x)


def first_int(*columns: Column) -> Column:
    """The first column that reads as a whole number."""
    return F.coalesce(*(c.try_cast("int") for c in columns))


def parsed_date(x: Column) -> Column:
    """A date from the formats in use: ISO (with or without a time), day/month/year, eight digits."""
    t = F.trim(x)
    iso = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(F.substring(t, 1, 10), F.lit("yyyy-MM-dd")))
    slashed = F.when(t.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_timestamp(t, F.lit("d/M/yyyy")))
    digits = F.when(t.rlike(r"^\d{8}$"), F.try_to_timestamp(t, F.lit("ddMMyyyy")))
    return F.coalesce(iso, slashed, digits).cast("date")


def season(d: Column) -> Column:
    m = F.month(d)
    return F.when(m.isin(12, 1, 2), "winter").when(m.isin(3, 4, 5), "spring").when(m.isin(6, 7, 8), "summer").when(m.isNotNull(), "autumn")


def cyclic(x: Column, period: int) -> tuple[Column, Column]:
    angle = 2 * F.pi() * x / period
    return F.sin(angle), F.cos(angle)


def money(x: Column) -> Column:
    """Amount of a text such as 1.234,56 €."""
    return F.replace(F.replace(F.regexp_extract(x, r"(\d[\d. ]*(?:,\d+)?)\s*(?:€|euros?|eur)", 1), F.lit("."), F.lit("")), F.lit(","), F.lit(".")).try_cast("double")


def missing_as(x: Column, other: Column) -> Column:
    """x unless it is null or zero, as odds are when unknown."""
    return F.coalesce(F.nullif(x, F.lit(0)), other)


def clv_implied(taken: Column, closing: Column) -> Column:
    """Closing line value as a difference of implied probabilities."""
    return F.try_divide(F.lit(1.0), closing) - F.try_divide(F.lit(1.0), taken)


def clv_ratio(taken: Column, closing: Column) -> Column:
    return F.try_divide(taken, closing) - 1


def minutes_text(ms: Column) -> Column:
    """Time in milliseconds as m'ss"d."""
    return F.format_string("%d'%02d\"%d", F.floor(ms / 60000), F.floor(ms / 1000) % 60, F.floor(ms / 100) % 10)


def lexicon_score(text: Column, good: list[str], bad: list[str]) -> Column:
    """(good - bad) / (good + bad) of the words, 0 without any."""
    words = F.split(F.lower(text), r"\s+")
    n = lambda lex: F.size(F.filter(words, lambda w: w.isin(lex)))
    return F.coalesce(F.try_divide((n(good) - n(bad)).cast("double"), n(good) + n(bad)), F.lit(0.0))


def form_string(x: Column) -> Column:
    """Results of a form text such as 1a2pDa(23)3h, newest first: place (null if none) and discipline letter."""
    plain = F.regexp_replace(x, r"\([^)]*\)", "")
    tokens = F.regexp_extract_all(plain, F.lit(r"((?:\d+|[DTAR])[amphsc])"), 1)
    return F.transform(tokens, lambda t: F.struct(F.nullif(F.regexp_extract(t, r"^(\d+)", 1), F.lit("")).try_cast("int").alias("place"), F.substring(t, -1, 1).alias("discipline")))


def row_key(*parts: Column) -> Column:
    """Parts joined by |, a missing one as an empty text, so that keys with gaps stay apart."""
    return F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts))


def picks(x: Column) -> Column:
    """Whole numbers of a combination such as 4-5-15; what isn't one is null."""
    return F.transform(F.split(x, "-"), lambda n: n.try_cast("int"))


def hour_minute(ms: Column) -> Column:
    """UTC time of day of milliseconds since the epoch."""
    return F.format_string("%02d:%02d", F.floor(ms / 3600000) % 24, F.floor(ms / 60000) % 60)


def form_runs(x: Column) -> Column:
    """Runs of a form text with the year that the last token such as (23) before them names: place (null if none), outcome, discipline, year."""
    tokens = F.regexp_extract_all(x, F.lit(r"(\(\d{2}\)|(?:\d+|[DTAR])[amphsc])"), 1)
    named = lambda t: F.startswith(t, F.lit("("))
    year = lambda t: 2000 + F.substring(t, 2, 2).cast("int")
    # Only the years are carried from token to token; runs are made once, beside them.
    years = lambda ts: F.aggregate(ts, F.array().cast("array<int>"), lambda seen, t: F.concat(seen, F.array(F.when(named(t), year(t)).otherwise(F.try_element_at(seen, F.lit(-1))))))
    outcome = lambda t: F.substring(t, F.lit(1), F.length(t) - 1)
    # A cast that fails is slow, as it makes its error's text first: letters aren't tried.
    place = lambda t: F.when(~outcome(t).isin("D", "T", "A", "R"), outcome(t).try_cast("int"))
    run = lambda t, y: F.when(~named(t), F.struct(place(t).alias("place"), outcome(t).alias("outcome"), F.substring(t, -1, 1).alias("discipline"), y.alias("year")))
    # An array of one binds the tokens, so that the text is searched once.
    return F.get(F.transform(F.array(tokens), lambda ts: F.filter(F.zip_with(ts, years(ts), run), lambda r: r.isNotNull())), F.lit(0))


# Bins by name (upper cuts, closed on the right or left, labels).
BANDS = {
    "distance F": ((1400, 1800, 2200, 2800, 3500), "left", ("sprint", "mile", "moyenne", "classique", "longue", "marathon")),
    "going A": ((2.5, 3.2, 3.8, 4.5), "right", ("sec", "bon", "souple", "lourd", "tres_lourd")),
    "going B": ((2.3, 2.7, 3.1, 3.5, 4.0, 4.5, 5.0), "left", ("tres_sec", "leger", "bon", "bon_souple", "souple", "tres_souple", "lourd", "tres_lourd")),
    "field A": ((8, 14), "right", ("small", "medium", "large")),
    "field B": ((8, 12, 16), "right", ("petit", "moyen", "grand", "tres_grand")),
    "field C": ((8, 13), "left", ("petit", "moyen", "grand")),
    "odds A": ((3.0, 6.0, 10.0, 20.0, 50.0), "left", ("grand_favori", "favori", "deuxieme_favori", "outsider", "longshot", "extreme")),
    "odds B": ((3.0, 6.0, 15.0), "left", ("favori", "deuxieme_plan", "outsider", "longshot")),
    "rest": ((7, 21, 60, 180), "right", ("enchaine", "frais", "repose", "longue_absence", "tres_longue_absence")),
}


def band(x: Column, name: str) -> Column:
    """Bin of a field size, days of rest, odds, a penetrometer reading or a distance, by the name of its cuts."""
    cuts, closed, labels = BANDS[name]
    return binned(x, cuts, labels, closed)


def started(status: Column) -> Column:
    """Whether an entrant took part: anything but a declared non-starter, an unknown status too."""
    return ~status.eqNullSafe(F.lit("non_partant"))


def dosage(text: Column) -> Column:
    """Dosage of a pedigree text such as ``DP = 6-2-10-2-0 (20) DI = 1.86 CD = 0.60``: profile, total, index and centre; null without one."""
    pattern = r"DP\s*=\s*([\d\-\s]+?)\s*\((\d+)\)\s*DI\s*=\s*([\d.]+)\s*CD\s*=\s*([\-\d.]+)"
    part = lambda i: F.regexp_extract(text, pattern, i)
    return F.when(text.rlike(pattern), F.struct(F.trim(part(1)).alias("profile"), F.try_to_number(part(2), F.lit("999999")).cast("int").alias("total"), part(3).try_cast("double").alias("index"), part(4).try_cast("double").alias("centre")))


def hour_of(text: Column) -> Column:
    """Hour of the first time in a text, such as ``14h05`` or ``9:30``; null without one."""
    return F.regexp_extract(text, r"(\d{1,2})[hH:]\d{2}", 1).try_cast("int")
