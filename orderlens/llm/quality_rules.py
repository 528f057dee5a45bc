"""Document quality rules from distribution divergence, in DataFrame functions only.

A document's characters fall into classes and its words onto the common words of its
language.  Both histograms are compared with the language's own, taken as the mean over
all its documents, by Jensen-Shannon distance (0 to 1).  A language's mean is drawn towards that
of all documents as if ``prior_docs`` more had been seen, so that one with few documents is
judged too.  Documents shorter than ``min_words`` are not judged by distance.

One pass over the texts makes a row of counts for each document, which is written; the
references are a partial aggregate of those rows, and joining them back moves counts,
never texts.

Defined results: a NULL text has no words and fails the base rules; a NULL language is one
with the empty name; a language of no list has no common words, so its words are at distance
0 and its characters decide; equal rows have equal results.  ``assess`` replaces columns named
like an output (OUT) or a histogram (``char_counts``, ``word_counts``) and passes on all others;
``drop_poor`` returns every column as it was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import free_name, without, written

#: Frequent function words by language.
COMMON = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "for"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "del"],
}
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
OUT = [*BASE, "base_failed", "char_distance", "word_distance", "kept"]


def _common_counts(lang: Column, words: Column) -> Column:
    """Counts of the language's common words, in the order of its list."""
    every = sorted({w for ws in COMMON.values() for w in ws})
    of = F.create_map(*[x for k, ws in COMMON.items() for x in (F.lit(k), F.array(*map(F.lit, ws)))])
    mine = F.coalesce(F.try_element_at(of, lang), F.array(*[F.lit("")] * 8))
    few = F.filter(words, lambda w: w.isin(every))
    return F.struct(few.alias("few"), mine.alias("mine"))


def _language(df: DataFrame, lang_col: str) -> Column:
    return F.coalesce(df[f"`{lang_col}`"], F.lit(""))


def counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """The rows, without their text, with BASE, ``char_counts`` and ``word_counts`` (arrays)."""
    docs = without(docs, [*OUT, "char_counts", "word_counts"])
    keep = [c for c in docs.columns if c != text_col]
    n = {k: free_name(docs, k) for k in ("t", "w", "hw", "h", "lines", "found", "at", "letters", "upper", "digits", "common", "counted")}
    col = {k: F.col(v) for k, v in n.items()}
    df = docs.withColumn(n["t"], F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    df = df.withColumn(n["w"], F.filter(F.split("`%s`" % n["t"], r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    df = df.withColumn(n["lines"], F.filter(F.split("`%s`" % n["t"], "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    df = df.withColumn(n["hw"], F.transform(col["w"], lambda w: F.xxhash64(w)))
    windows = F.when(
        F.size(col["hw"]) >= 3,
        F.transform(F.slice(col["hw"], F.lit(1), F.size(col["hw"]) - 2), lambda x, i: F.xxhash64(x, F.get(col["hw"], i + 1), F.get(col["hw"], i + 2))),
    ).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn(n["h"], windows)
    pairs = F.sort_array(F.transform(col["h"], lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn(n["at"], F.when(F.size(F.array_distinct(col["h"])) < F.size(col["h"]), pairs))
    same = lambda z, k: F.coalesce(F.get(col["at"], k)["h"] == z["h"], F.lit(False))
    twice = F.filter(col["at"], lambda z, k: F.when(k > 0, same(z, k - 1)).otherwise(F.lit(False)) | same(z, k + 1))
    df = df.withColumn(n["found"], F.sort_array(F.transform(twice, lambda z: z["i"])))
    step = F.transform(col["found"], lambda p, k: F.least(F.lit(3), F.coalesce(F.get(col["found"], k + 1) - p, F.lit(3))))
    letters = F.length(F.regexp_replace(col["t"], r"\P{L}+", ""))
    upper = F.length(F.regexp_replace(col["t"], r"\P{Lu}+", ""))
    digits = F.length(F.regexp_replace(col["t"], r"\P{N}+", ""))
    df = df.select(
        *[F.col(f"`{c}`") for c in keep],
        F.size(col["w"]).cast("long").alias("n_words"),
        F.length(F.array_join(col["w"], "")).cast("long").alias("word_chars"),
        F.regexp_count(col["t"], F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size(col["lines"]) - F.size(F.array_distinct(col["lines"]))).cast("long").alias("n_dup_lines"),
        F.coalesce(F.aggregate(step, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long").alias("n_repeat_words"),
        letters.alias(n["letters"]), upper.alias(n["upper"]), digits.alias(n["digits"]),
        _common_counts(F.col(f"`{lang_col}`"), col["w"]).alias(n["common"]),
    )
    few = col["common"]["few"]
    word_counts = F.transform(col["common"]["mine"], lambda m: F.size(F.filter(few, lambda w: w == m)).cast("double"))
    total = F.aggregate(col["counted"], F.lit(0.0), lambda a, x: a + x)
    return (
        df.withColumn(n["counted"], word_counts)
        .select(
            *[F.col(f"`{c}`") for c in keep], *BASE,
            F.array(
                col["letters"] - col["upper"], col["upper"], col["digits"], F.col("n_symbols"),
                F.greatest(F.lit(0), F.col("word_chars") - col["letters"] - col["digits"] - F.col("n_symbols")),
            ).cast("array<double>").alias("char_counts"),
            F.concat(col["counted"], F.array(F.col("n_words") - total)).alias("word_counts"),
        )
    )


def shares(histogram: Column) -> Column:
    total = F.aggregate(histogram, F.lit(0.0), lambda a, x: a + x)
    return F.transform(histogram, lambda x: F.when(total > 0, x / total).otherwise(F.lit(0.0)))


def js_distance(p: Column, q: Column) -> Column:
    """Square root of the Jensen-Shannon divergence in bits: 0 for equal, 1 for disjoint histograms."""
    part = lambda a, b: F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))
    total = F.aggregate(F.zip_with(p, q, lambda a, b: part(a, b) + part(b, a)), F.lit(0.0), lambda s, x: s + x)
    return F.sqrt(F.greatest(F.lit(0.0), total / 2))


def references(counted: DataFrame, lang_col: str = "lang", min_words: int = 50, prior_docs: float = 5.0) -> DataFrame:
    """(ref_lang, ref_docs, ref_c, ref_w), one row per language: mean shares over its documents of at least ``min_words`` words.

    Means are those of the language's documents and of ``prior_docs`` more that are the mean of
    all documents; for words, of all documents of a listed language.
    """
    lang = _language(counted, lang_col).alias("ref_lang")
    shared = counted.filter(F.col("n_words") >= min_words).select(lang, shares(F.col("char_counts")).alias("c"), shares(F.col("word_counts")).alias("w"))
    sums = lambda name, size: F.array(*[F.sum(F.get(F.col(name), F.lit(k))) for k in range(size)])
    of = shared.groupBy("ref_lang").agg(F.count("*").alias("ref_docs"), sums("c", 5).alias("c"), sums("w", 9).alias("w"))
    of = of.withColumn("listed", F.col("ref_lang").isin(list(COMMON)))
    total = lambda name, size, mine: F.array(*[F.sum(F.when(mine, F.get(F.col(name), F.lit(k)))) for k in range(size)])
    every = of.agg(
        F.sum("ref_docs").alias("n"), total("c", 5, F.lit(True)).alias("all_c"),
        F.sum(F.when(F.col("listed"), F.col("ref_docs"))).alias("n_listed"), total("w", 9, F.col("listed")).alias("all_w"),
    )
    drawn = lambda own, all_, n: F.zip_with(own, all_, lambda x, y: (x + prior_docs * y / n) / (F.col("ref_docs") + prior_docs))
    own = F.transform(F.col("w"), lambda x: x / F.col("ref_docs"))
    return of.crossJoin(every).select(  # with one row
        "ref_lang", "ref_docs", drawn(F.col("c"), F.col("all_c"), F.col("n")).alias("ref_c"),
        F.when(F.col("listed"), drawn(F.col("w"), F.col("all_w"), F.col("n_listed"))).otherwise(own).alias("ref_w"),
    )


def judge(
    counted: DataFrame, reference: DataFrame, lang_col: str = "lang", min_words: int = 50, max_distance: float = 0.29, noise: float = 0.75,
) -> DataFrame:
    """Counted rows with ``base_failed``, both distances (NULL where not judged) and ``kept``.

    The Euclidean length of the two distances may reach ``max_distance`` plus ``noise`` over
    the root of the number of words, since a short clean document strays further.
    """
    name = {c: free_name(counted, c) for c in ("ref_lang", "ref_c", "ref_w")}
    ref = reference.select(*[F.col(c).alias(x) for c, x in name.items()])
    judged = (F.col("n_words") >= min_words) & F.col(name["ref_lang"]).isNotNull()
    df = counted.join(ref, _language(counted, lang_col) == ref[name["ref_lang"]], "left")
    df = df.withColumns({
        "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        "char_distance": F.when(judged, js_distance(shares(F.col("char_counts")), F.col(name["ref_c"]))),
        "word_distance": F.when(judged, js_distance(shares(F.col("word_counts")), F.col(name["ref_w"]))),
    })
    # One comparison with columns of both sides: a filter on it stays above the join and
    # is not unfolded into the counting expressions.
    excess = F.coalesce(F.hypot("char_distance", "word_distance") - noise / F.sqrt("n_words"), F.lit(0.0))
    kept = F.when(F.col("base_failed"), F.lit(2.0)).otherwise(excess) <= max_distance
    out = [*counted.columns, "base_failed", "char_distance", "word_distance"]
    return df.select(*[F.col(f"`{c}`") for c in out if c not in ("char_counts", "word_counts")], kept.alias("kept"))


def assess(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", **limits) -> DataFrame:
    """One row per document without its text: BASE, ``base_failed``, the distances and ``kept``."""
    counted = written(counts(docs, lang_col, text_col), "quality_counts")
    return judge(counted, references(counted, lang_col), lang_col, **limits)


def drop_poor(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", **limits) -> DataFrame:
    """The documents that are kept, with their own columns.

    Texts are read twice, once for the references and once to filter, and never shuffled.
    """
    packed = docs.select(F.struct("*").alias("own"), F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text"))
    reference = written(references(counts(packed.select("lang", "text"))), "quality_references")
    judged = judge(counts(packed), reference, **limits)
    return judged.filter("kept").select("own.*")
