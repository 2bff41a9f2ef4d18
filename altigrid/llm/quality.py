"""Quality rules with a divergence verdict, in DataFrame functions only.

Base rules count words, code points in words, symbols, repeated lines and words
in repeated five-word windows. The verdict compares two histograms of each
document with those of its language by Jensen-Shannon distance: characters by
class, and words by the common words of the languages. The reference of a
language is the sum over all its documents, each with the same weight.

Lengths guard the comparison: under `least_words` words the common-word part is
left out, under `least_chars` characters both, and such a document keeps its
base verdict. Null text has no words; null language is a language of its own.
An empty table gives an empty result. Rows with equal or null doc_id are judged
each for itself. Columns other than doc_id, text and lang are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from altigrid.llm.common import saved

# Common words of the languages.
COMMON = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del"],
}
WORDS = sorted({w for words in COMMON.values() for w in words})

# Character classes as Java patterns, in this order; "other" is what remains.
CLASSES = {
    "lower": r"\p{Ll}", "space": r"[\x20\x09-\x0D]", "upper": r"\p{Lu}", "digit": r"\p{Nd}", "stop": r"[.,;:!?'\"()-]", "symbol": r"[#*$%&|<>]",
}
_SPACE = "[\\x20\\x09-\\x0D]+"
_WORD = "(?<![^\\x20\\x09-\\x0D])(?:" + "|".join(sorted(WORDS, key=len, reverse=True)) + ")(?![^\\x20\\x09-\\x0D.,;:!?])"


def base_counts(docs: DataFrame) -> DataFrame:
    """doc_id, lang, text, the counts of the base rules, n_chars and classes (characters by CLASSES, then other).

    Each class is taken out of what the ones before it have left, so that only
    the first patterns see the whole text.
    """
    text = F.coalesce("text", F.lit(""))
    cut = docs.select("doc_id", "lang", text.alias("text")).withColumn("left_0", F.col("text"))
    for k, pattern in enumerate(CLASSES.values()):
        cut = cut.withColumn(f"left_{k + 1}", F.regexp_replace(f"left_{k}", f"(?:{pattern})+", ""))
    sizes = [F.length(f"left_{k}") for k in range(len(CLASSES) + 1)]
    classes = F.array(*(a - b for a, b in zip(sizes, sizes[1:])), sizes[-1])
    listed = cut.select("doc_id", "lang", "text", sizes[0].cast("long").alias("n_chars"), classes.alias("classes")).withColumn("words", F.array_remove(F.split("text", _SPACE), ""))
    lines = F.filter(F.split("text", "\n", -1), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    marked = listed.withColumn("lines", lines).withColumn(
        "marks", F.when(F.size("words") >= 5, F.expr(
            "transform(sequence(0, size(words) - 5), i -> xxhash64(words[i], words[i + 1], words[i + 2], words[i + 3], words[i + 4]))"))
    )
    sorted_at = F.expr("sort_array(transform(marks, (m, i) -> struct(m AS m, i AS i)))")
    repeating = marked.withColumn("order", F.when(F.size(F.array_distinct("marks")) < F.size("marks"), sorted_at))
    starts = F.expr(
        "sort_array(filter(transform(order, (p, k) -> CASE WHEN p.m = get(order, k + 1).m OR p.m = get(order, k - 1).m THEN p.i END), i -> i IS NOT NULL))"
    )
    covered = F.expr("aggregate(zip_with(starts, slice(starts, 2, size(starts)), (a, b) -> least(coalesce(b - a, 5), 5)), 0L, (s, d) -> s + d)")
    of_class = {name: F.col("classes")[k].cast("long") for k, name in enumerate(CLASSES)}
    return repeating.withColumn("starts", starts).select(
        "doc_id", "lang", "text", "n_chars", "classes",
        F.size("words").cast("long").alias("n_words"),
        (F.col("n_chars") - of_class["space"]).alias("word_chars"), of_class["symbol"].alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def histograms(counted: DataFrame) -> DataFrame:
    """Adds the shares chars (by class, then other) and common (WORDS, then other words)."""
    found = counted.withColumn("hits", F.regexp_extract_all(F.lower("text"), F.lit(_WORD), F.lit(0))).withColumn(
        # |the||of||and|: a word is counted by the bytes that taking it out removes, in one short call for each.
        "marked", F.concat(F.lit("|"), F.array_join("hits", "||"), F.lit("|")))
    n, hits = F.greatest("n_chars", F.lit(1)).cast("double"), F.size("hits")
    taken = lambda w: F.octet_length("marked") - F.octet_length(F.replace("marked", F.lit(f"|{w}|"), F.lit("")))
    words = [*(taken(w) / F.lit(float(len(w) + 2)) for w in WORDS), F.col("n_words") - hits]
    share = F.greatest("n_words", F.lit(1)).cast("double")
    return found.select(
        *(c for c in counted.columns if c not in ("text", "classes")),
        F.array(*(F.col("classes")[k] / n for k in range(len(CLASSES) + 1))).alias("chars"), F.array(*(c / share for c in words)).alias("common"),
    )


def references(shares: DataFrame) -> DataFrame:
    """Mean shares of each language over all its documents with a word: lang, ref_chars, ref_common."""
    sizes = {"chars": len(CLASSES) + 1, "common": len(WORDS) + 1}
    means = [F.avg(F.col(c)[i]).alias(f"{c}_{i}") for c, n in sizes.items() for i in range(n)]
    wide = shares.where("n_words > 0").groupBy("lang").agg(*means)
    return wide.select("lang", *(F.array(*(f"{c}_{i}" for i in range(n))).alias(f"ref_{c}") for c, n in sizes.items()))


def divergence(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (root, base 2) of two arrays of shares."""
    def part(a: Column, b: Column) -> Column:
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

    terms = F.zip_with(p, q, lambda a, b: part(a, b) + part(b, a))
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda s, t: s + t) / 2, F.lit(0.0)))


def judge(
    docs: DataFrame, most_chars: float = 0.3, most_common: float = 0.45, most_both: float = 0.4, least_chars: int = 200, least_words: int = 50
) -> DataFrame:
    """doc_id, counts, base_failed, distances to the language (null under the guards) and kept."""
    shares = saved(histograms(base_counts(docs)))
    refs = references(shares)
    near = shares.join(refs, shares.lang.eqNullSafe(refs.lang), "left").drop(refs.lang)
    far = near.withColumn("chars_distance", F.when(F.col("n_chars") >= least_chars, divergence(F.col("chars"), F.col("ref_chars")))).withColumn(
        "common_distance", F.when(F.col("n_words") >= least_words, divergence(F.col("common"), F.col("ref_common")))
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    chars, common = F.coalesce("chars_distance", F.lit(0.0)), F.coalesce("common_distance", F.lit(0.0))
    close = (chars <= most_chars) & (common <= most_common) & (chars + common <= most_both)
    return far.select(
        "doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & close).alias("kept"), "chars_distance", "common_distance",
    )
