"""Quality rules: base counts and divergence from language references.

Every text is measured once per pass: base counts, a histogram of character
classes and one of common words. The references are the mean histograms
of each language over all long enough documents that pass the base rules; a text whose
Jensen-Shannon distance from its language's reference is too large is
rejected, unless it is too short for the histogram to mean anything.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paceline.llm import textnum as tn
from paceline.llm.spread import stored

MIN_WORDS, REPEAT_WINDOW, MAX_REPEAT_PERCENT = 10, 5, 20
SYMBOLS = b"#*$%&|<>"
CLASSES = ("lower", "upper", "other_letter", "digit", "space", "punctuation", "symbol", "other")
#: A text is rejected above base + noise / sqrt(length), since a short text's histogram strays from any reference by about
#: 1 / sqrt(length) by chance alone; below the least length (characters, words) a histogram doesn't count at all.
CLASS_LIMIT, MIN_CHARS = (0.10, 2.8), 200
WORD_LIMIT, MIN_COMMON_WORDS = (0.10, 2.2), 40
#: Documents a language needs for a reference of its own; others use the pooled one.
MIN_DOCS = 20
#: Languages up to which the references are broadcast; beyond it they are joined by a shuffle.
MAX_BROADCAST_LANGS = 1000

# The commonest function words of English, French, German and Spanish.
COMMON_WORDS = (
    "the of and to in a is that it for on was be with as this by are at from or an not have which "
    "de la le les et des en un une du que est pour dans qui sur au pas par il ce ne "
    "der die das und von zu den mit sich auf ist im dem nicht ein eine als auch es für "
    "el y los las se del con una su para lo como más pero sus"
).split()


def _hash_of(word: str) -> int:
    raw = np.frombuffer(word.encode(), np.uint8)
    return int(tn.words(raw, np.array([0, len(raw)])).hashes[0])


def _class_table() -> np.ndarray:
    kind = {"Ll": 0, "Lu": 1, "Lt": 1, "Lm": 2, "Lo": 2, "Nd": 3, "Zs": 4, "Zl": 4, "Zp": 4, "Cc": 7}
    out = np.full(65537, 7, np.uint8)
    for c in range(65536):
        cat = unicodedata.category(chr(c))
        out[c] = kind.get(cat, 5 if cat[0] == "P" else 6 if cat[0] == "S" else 3 if cat[0] == "N" else 2 if cat[0] == "M" else 7)
    out[[9, 10, 11, 12, 13]] = 4
    out[list(SYMBOLS)] = 6
    out[65536] = 2
    return out


_TABLES: dict[str, np.ndarray] = {}


def _tables() -> dict[str, np.ndarray]:
    if not _TABLES:
        forms = {_hash_of(f): i for i, w in enumerate(dict.fromkeys(COMMON_WORDS)) for f in (w, w.capitalize(), w.upper())}
        codes = np.array(list(forms), np.uint64)
        order = np.argsort(codes)
        symbols = np.zeros(256, bool)
        symbols[list(SYMBOLS)] = True
        _TABLES.update(classes=_class_table(), symbols=symbols, codes=codes[order], column=np.array(list(forms.values()))[order])
    return _TABLES


N_COMMON = len(dict.fromkeys(COMMON_WORDS))
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
STATS = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS] + [T.StructField("classes", T.ArrayType(T.IntegerType())), T.StructField("common", T.ArrayType(T.IntegerType()))])
_STATS = pa.struct([(c, pa.int64()) for c in COUNTS] + [("classes", pa.list_(pa.int32())), ("common", pa.list_(pa.int32()))])


def _sums(flags: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[cuts])


def _measure_slice(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, t = len(offsets) - 1, _tables()
    w = tn.words(data, offsets)
    raw, cuts = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    counts = np.zeros((5, n), np.int64)
    counts[0] = w.counts
    solid = ~tn._SPACE[raw]
    counts[1] = _sums(solid & ((raw & 0xC0) != 0x80), cuts)
    counts[2] = _sums(t["symbols"][raw], cuts)
    # lines start at a text's start or after a line feed, and end at the next line feed or the text's end
    feeds = np.flatnonzero(raw == 10)
    starts = np.union1d(cuts[:-1], feeds + 1)
    starts = starts[starts < len(raw)]
    line_text = np.searchsorted(cuts, starts, side="right") - 1
    ends = np.minimum(np.append(feeds, len(raw))[np.searchsorted(feeds, starts)], cuts[line_text + 1])
    solids = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(solid, out=solids[1:])
    keep = solids[ends] > solids[starts]
    starts, ends, line_text = starts[keep], ends[keep], line_text[keep]
    up, down = tn._powers(tn._BYTE_BASE, len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(tn._BYTE_CODE[raw] * up[: len(raw)], out=total[1:])
    lines = tn.mix((total[ends] - total[starts]) * down[starts])
    salt = tn.mix(np.arange(1, n + 1, dtype=np.uint64))
    distinct = np.unique(lines ^ salt[line_text], return_index=True)[1]
    counts[3] = np.bincount(line_text, minlength=n) - np.bincount(line_text[distinct], minlength=n)
    at, h = tn.windows(w, REPEAT_WINDOW)
    _, which, many = np.unique(h ^ salt[w.text[at]], return_inverse=True, return_counts=True)
    hit = tn.covered(at[many[which] > 1], REPEAT_WINDOW, len(w.starts))
    counts[4] = np.bincount(w.text[hit], minlength=n)
    points = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    owner = np.repeat(np.arange(n), _sums((raw & 0xC0) != 0x80, cuts))
    kinds = t["classes"][np.minimum(points, 65536)]
    classes = np.bincount(owner * len(CLASSES) + kinds[: len(owner)], minlength=n * len(CLASSES)).reshape(n, -1)
    spot = np.minimum(np.searchsorted(t["codes"], w.hashes), len(t["codes"]) - 1)
    found = t["codes"][spot] == w.hashes
    common = np.bincount(w.text[found] * N_COMMON + t["column"][spot[found]], minlength=n * N_COMMON).reshape(n, -1)
    return counts, classes, common


def measure(texts) -> pa.Array:
    """Arrow structs of the base counts and histograms of a column of texts."""
    data, offsets = tn.text_buffers(texts)
    parts = [_measure_slice(data, offsets[a : b + 1]) for a, b in tn.slices(offsets)]
    n = len(offsets) - 1
    counts = np.concatenate([p[0] for p in parts], axis=1) if parts else np.zeros((5, 0), np.int64)
    grid = lambda k, width: pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * width, pa.int32()), pa.array((np.concatenate([p[k] for p in parts]) if parts else np.zeros((0, width))).astype(np.int32).ravel()))
    arrays = [pa.array(c) for c in counts] + [grid(1, len(CLASSES)), grid(2, N_COMMON)]
    return pa.StructArray.from_arrays(arrays, fields=list(_STATS))


def js_distances(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Square roots of the Jensen-Shannon divergences (base 2) of the rows of two count matrices; NaN where one is empty."""
    with np.errstate(divide="ignore", invalid="ignore"):
        p, q = p / p.sum(axis=1, keepdims=True), q / q.sum(axis=1, keepdims=True)
        m = (p + q) / 2
        terms = np.where(p > 0, p * np.log2(p / m), 0) + np.where(q > 0, q * np.log2(q / m), 0)
        out = np.sqrt(np.maximum(terms.sum(axis=1) / 2, 0))
    return np.where(np.isfinite(p.sum(axis=1) + q.sum(axis=1)), out, np.nan)


DISTANCES = ("class_distance", "word_distance")


def with_stats(docs: DataFrame, text_col: str = "text", refs: tuple[Column, Column] | None = None) -> DataFrame:
    """Each row as ``row`` with its ``stats``, and its distances if ``docs`` has references (columns of arrays)."""
    columns = [c for c in docs.columns if c not in ("_ref_classes", "_ref_words")]
    text = docs.select(F.col(text_col).cast("string").alias("text"), F.struct(*(F.col(f"`{c}`") for c in columns)).alias("row"), *(refs or ()))
    schema = T.StructType([text.schema["row"], T.StructField("stats", STATS), *(T.StructField(d, T.DoubleType()) for d in (DISTANCES if refs else ()))])

    judged, names = bool(refs), schema.names

    def grid(column, width: int) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            stats = measure(b.column("text"))
            out = [b.column("row"), stats]
            if judged:
                classes, common = grid(stats.field("classes"), len(CLASSES)), grid(stats.field("common"), N_COMMON)
                rest = stats.field("n_words").to_numpy() - common.sum(axis=1)
                out += [pa.array(js_distances(classes.astype(float), grid(b.column(2), len(CLASSES))), from_pandas=True), pa.array(js_distances(np.column_stack([common, rest]).astype(float), grid(b.column(3), N_COMMON + 1)), from_pandas=True)]
            yield pa.RecordBatch.from_arrays(out, names=names)

    return text.mapInArrow(run, schema)


def base_failed(stats: str = "stats") -> Column:
    s = F.col(stats)
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"])


def references(measured: DataFrame, lang: Column) -> DataFrame:
    """One row per language: mean histograms of its texts that pass the base rules and are long enough, each text counting alike."""
    share = lambda x, i, n: F.avg(F.col(x)[i] / F.col(n))
    means = [share("stats.classes", i, "n_chars").alias(f"c{i}") for i in range(len(CLASSES))]
    means += [share("stats.common", i, "stats.n_words").alias(f"w{i}") for i in range(N_COMMON)]
    long_enough = measured.withColumn("n_chars", F.aggregate("stats.classes", F.lit(0), lambda a, v: a + v)).where(~base_failed() & (F.col("n_chars") >= MIN_CHARS))
    by_lang = long_enough.select(lang.alias("lang"), "stats", "n_chars").groupBy("lang").agg(*means, F.count(F.lit(1)).alias("n_docs"))
    common = [F.col(f"w{i}") for i in range(N_COMMON)]
    rest = F.greatest(F.lit(0.0), F.lit(1.0) - sum(common, F.lit(0.0)))
    return by_lang.select("lang", "n_docs", F.array(*(F.col(f"c{i}") for i in range(len(CLASSES)))).alias("ref_classes"), F.array(*common, rest).alias("ref_words"))


def _judged(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """``row``, ``stats``, distances, base_failed and kept of every document."""
    spark, own = docs.sparkSession, docs.columns
    aside = {c: f"{c}_{max(map(len, own)) * '_'}" for c in ("_lang", "_ref_classes", "_ref_words") if c in own}
    docs = docs.withColumnsRenamed(aside)
    lang = lambda of: F.coalesce(F.col(f"{of}{lang_col}").cast("string"), F.lit("")) if lang_col in docs.columns else F.lit("")
    refs = stored(references(with_stats(docs.select(text_col, *([lang_col] if lang_col in docs.columns else [])), text_col), lang("row.")), "quality-refs")
    rows = refs.limit(MAX_BROADCAST_LANGS + 1).collect()
    sums = refs.agg(*(F.array(*(F.coalesce(F.sum(F.col(k)[i] * F.col("n_docs")), F.lit(0.0)) for i in range(n))).alias(k) for k, n in (("ref_classes", len(CLASSES)), ("ref_words", N_COMMON + 1)))).first()
    pooled = [list(sums[k]) for k in ("ref_classes", "ref_words")]
    known = refs.where(F.col("n_docs") >= MIN_DOCS).select(F.col("lang").alias("_lang"), F.col("ref_classes").alias("_ref_classes"), F.col("ref_words").alias("_ref_words"))
    if len(rows) <= MAX_BROADCAST_LANGS:
        known = F.broadcast(spark.createDataFrame([(r["lang"], r["ref_classes"], r["ref_words"]) for r in rows if r["n_docs"] >= MIN_DOCS], known.schema))
    joined = docs.join(known, lang("") == F.col("_lang"), "left").drop("_lang")
    arrays = (F.coalesce("_ref_classes", F.array(*map(F.lit, pooled[0]))).alias("_ref_classes"), F.coalesce("_ref_words", F.array(*map(F.lit, pooled[1]))).alias("_ref_words"))
    s = F.col("stats")
    n_chars = F.aggregate(s["classes"], F.lit(0), lambda a, v: a + v)
    out = with_stats(joined, text_col, arrays).withColumn("base_failed", base_failed())
    if aside:
        out = out.withColumn("row", F.struct(*(F.col(f"row.`{aside.get(c, c)}`").alias(c) for c in own)))
    over = lambda distance, n, least, limit: (n >= least) & (F.col(distance) > limit[0] + limit[1] / F.sqrt(n))
    odd = over("class_distance", n_chars, MIN_CHARS, CLASS_LIMIT) | over("word_distance", s["n_words"], MIN_COMMON_WORDS, WORD_LIMIT)
    return out.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(odd, F.lit(False)))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Base counts, distances and verdict of every document.

    Returns one row per input row: doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed, kept, class_distance and
    word_distance (null where a histogram is empty).

    Null and empty texts have no words and fail the base rules. A null or
    missing language counts as a language of its own; languages with few
    documents are held against the pooled reference. Repeated rows and null
    ids are judged like any other; an empty table gives an empty result.
    """
    judged = _judged(docs, text_col, lang_col)
    return judged.select(F.col(f"row.{id_col}").alias("doc_id"), *(F.col(f"stats.{c}") for c in COUNTS), "base_failed", "kept", "class_distance", "word_distance")


def quality_filter(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents that the rules keep, with their own columns."""
    return _judged(docs, text_col, lang_col).where("kept").select("row.*")
