"""Fields of a contest's conditions text, by regular expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paceline.functions.scalars import bare, money


def _int(x: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(x, pattern, group), F.lit("")).try_cast("int")


def conditions(text: Column) -> Column:
    """Age range, distance, weight, prize, category flags of a conditions text; absent fields are null."""
    t = bare(text)
    lo = F.coalesce(_int(t, r"(\d{1,2})\s*(?:a|-)\s*\d{1,2}\s*ans"), _int(t, r"(\d{1,2})\s*ans"))
    hi = F.coalesce(_int(t, r"\d{1,2}\s*(?:a|-)\s*(\d{1,2})\s*ans"), F.when(~t.rlike(r"ans\s*et\s*(?:plus|au-dessus)"), _int(t, r"(\d{1,2})\s*ans")))
    group = F.nullif(F.regexp_extract(t, r"groupe?\s*(i{1,3}|[123])\b", 1), F.lit(""))
    category = F.when(group.isNotNull(), F.concat(F.lit("group "), F.when(group.rlike("i"), F.length(group).cast("string")).otherwise(group))).when(t.rlike(r"\blisted?\b"), "listed").when(t.rlike("handicap"), "handicap").when(t.rlike("reclamer|vente"), "claiming").when(t.rlike("apprenti"), "apprentices").otherwise("ordinary")
    start = F.when(t.rlike("autostart"), "autostart").when(t.rlike("volte"), "volte").when(t.rlike("stalle|boite"), "stalls")
    return F.struct(lo.alias("age_min"), hi.alias("age_max"), _int(F.regexp_replace(t, r"(\d)[ .](\d{3})\s*m", "$1$2 m"), r"(\d{3,4})\s*m(?:etres)?\b").alias("distance"), _int(t, r"(\d{2})(?:[,.]\d)?\s*kg").alias("weight"), money(text).alias("prize"), category.alias("category"), start.alias("start"), t.rlike("femelles|pouliches|juments").alias("females_only"))
