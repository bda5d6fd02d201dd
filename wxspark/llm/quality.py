"""Quality rules: counts of a text, and how far its histograms are from those of the
languages (DataFrame functions only).

A document has two histograms: character classes, and common words (with a bin for all
others). The reference of a language is the sum of its documents' histograms. A document
is rejected if its Jensen-Shannon distance to the nearest reference is over a limit, for
either histogram; texts under a minimum length are not held to that histogram.
"""

from __future__ import annotations

import math
import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wxspark.llm.common import WORD, read, without, written

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Common words of the languages that have a reference.
COMMON = {
    "en": "the of and to in is that it for on as was with be by are this from or at".split(),
    "de": "der die das und in den von zu mit sich des auf für ist im dem nicht ein eine als".split(),
    "fr": "de la le les et des en un une du que est pour dans qui sur au par plus pas".split(),
    "es": "de la que el en y a los se del las un por con una su para es al lo".split(),
}
VOCABULARY = sorted({w for ws in COMMON.values() for w in ws})
CLASSES = ["lower", "upper", "digit", "symbol", "space", "punct"]
WINDOW, MIN_WORDS, MAX_REPEAT_PERCENT = 5, 10, 20
#: Limits of the distances, and the least code points and words that they need.
MAX_CLASS_DISTANCE, MIN_CHARS = 0.30, 120
MAX_WORD_DISTANCE, MIN_COMMON_WORDS = 0.30, 60


def _count(text: str, chars: str) -> Column:
    """Code points of ``text`` in the character class ``chars``: taken out, not kept, since
    a class of a few ranges is far cheaper to match than its complement."""
    return (F.length(text) - F.length(F.regexp_replace(text, f"[{chars}]+", ""))).cast("bigint")


def _without_space(text: str) -> Column:
    out = F.col(text)
    for c in SPACE:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def _codes() -> tuple[Column, Column, int, list[str]]:
    """A word's code letter by a table without collisions: slots by crc32."""
    letters = [chr(ord("!") + i) for i in range(len(VOCABULARY))]  # one byte each
    slots = next(m for m in range(len(VOCABULARY), 100_000) if len({zlib.crc32(w.encode()) % m for w in VOCABULARY}) == len(VOCABULARY))
    words, codes = [""] * slots, [""] * slots
    for w, c in zip(VOCABULARY, letters, strict=True):
        words[zlib.crc32(w.encode()) % slots], codes[zlib.crc32(w.encode()) % slots] = w, c
    return F.array(*map(F.lit, words)), F.array(*map(F.lit, codes)), slots, letters


def histograms(docs: DataFrame) -> DataFrame:
    """``docs`` with __wx_text (null: empty), __wx_words, n_words, word_chars, n_symbols,
    class_counts and word_counts (arrays of long, the last word bin for all other words)."""
    d = docs.withColumn("__wx_text", F.coalesce("text", F.lit(""))).withColumn("__wx_words", F.regexp_extract_all("__wx_text", F.lit(WORD), F.lit(0)))
    words, codes, slots, letters = _codes()
    longest = max(map(len, VOCABULARY))

    def code(w):
        low = F.lower(w)
        slot = F.pmod(F.crc32(low.cast("binary")), F.lit(slots)).cast("int")
        return F.when((F.length(w) <= longest) & (F.get(words, slot) == low), F.get(codes, slot)).otherwise("")

    d = d.withColumn("n_words", F.size("__wx_words").cast("bigint"))
    d = d.withColumn("__wx_codes", F.array_join(F.transform("__wx_words", code), ""))
    d = d.withColumn("word_chars", F.length(_without_space("__wx_text")).cast("bigint"))
    d = d.withColumn("n_symbols", _count("__wx_text", SYMBOLS))
    d = d.withColumn("__wx_n", F.length("__wx_text").cast("bigint"))
    # ASCII ranges only: what is neither space nor an ASCII mark or digit counts as a letter.
    d = d.withColumn("__wx_marks", _count("__wx_text", r"\x21-\x40\x5B-\x60\x7B-\x7E"))
    d = d.withColumn("__wx_upper", _count("__wx_text", "A-Z")).withColumn("__wx_digits", _count("__wx_text", "0-9"))
    known = F.length("__wx_codes").cast("bigint")
    each = [known - F.length(F.replace("__wx_codes", F.lit(c), F.lit(""))) for c in letters]
    classes = [
        F.col("word_chars") - F.col("__wx_marks") - F.col("__wx_upper"),
        F.col("__wx_upper"),
        F.col("__wx_digits"),
        F.col("n_symbols"),
        F.col("__wx_n") - F.col("word_chars"),
        F.col("__wx_marks") - F.col("__wx_digits") - F.col("n_symbols"),
    ]
    d = d.withColumn("class_counts", F.array(*classes)).withColumn("word_counts", F.array(*each, F.col("n_words") - known))
    return d.drop("__wx_codes", "__wx_n", "__wx_marks", "__wx_upper", "__wx_digits")


def language_references(measures: DataFrame) -> dict[str, tuple[list[float], list[float]]]:
    """Class and word shares of all rows of ``measures`` (lang, n_words and the counts of
    ``histograms``) in each language of COMMON, and of all rows together under the empty
    name: at most ``len(COMMON) + 1`` rows of sums. Empty for a table without words."""
    h = measures.filter("n_words > 0")
    n, m = len(CLASSES), len(VOCABULARY) + 1
    parts = h.select(
        F.when(F.col("lang").isin(*COMMON), F.col("lang")).alias("lang"),
        *[F.col("class_counts")[i].alias(f"c{i}") for i in range(n)],
        *[F.col("word_counts")[i].alias(f"w{i}") for i in range(m)],
    )
    sums = {r["lang"]: list(r)[1:] for r in parts.groupBy("lang").agg(*[F.sum(c).alias(c) for c in parts.columns[1:]]).collect()}
    if sums:
        sums[""] = [sum(x) for x in zip(*sums.values(), strict=True)]
    share = lambda xs: [x / max(1, sum(xs)) for x in xs]
    return {k: (share(v[:n]), share(v[n:])) for k, v in sums.items() if k is not None}


def divergence(counts: str, references: list[list[float]], total: str | None = None, shares: str | None = None) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of a histogram to the nearest reference:
    half of sum(p log p) + sum(q log q) - sum((p + q) log((p + q) / 2)), so that only one
    logarithm an element is left for each reference. ``total`` and ``shares`` name columns
    that hold them already."""
    count = F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, x: a + x) if total is None else F.col(total)
    p = F.transform(counts, lambda x: x / F.nullif(count, F.lit(0))) if shares is None else F.col(shares)

    def x_log_x(xs):
        return F.aggregate(xs, F.lit(0.0), lambda a, x: a + F.when(x > 0, x * F.log2(x)).otherwise(0.0))

    def one(q):
        own = sum(x * math.log2(x) for x in q if x > 0) + 1 + sum(q)
        return F.lit(own) - x_log_x(F.zip_with(p, F.array(*map(F.lit, q)), lambda a, b: a + b))

    nearest = F.least(*[one(q) for q in references]) if len(references) > 1 else one(references[0])
    return F.when(count > 0, F.sqrt(F.greatest((nearest + x_log_x(p)) / 2, F.lit(0.0))))


def with_divergence(d: DataFrame, name: str, counts: str, references: list[list[float]]) -> DataFrame:
    """Adds ``name``: the divergence, null without references. The histogram's total and its
    shares are columns, both used more than once: inside the functions of the elements they
    would be worked out anew for each."""
    if not references:
        return d.withColumn(name, F.lit(None).cast("double"))
    d = d.withColumn("__wx_total", F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, x: a + x))
    d = d.withColumn("__wx_share", F.transform(counts, lambda x: x / F.nullif("__wx_total", F.lit(0))))
    return without(d.withColumn(name, divergence(counts, references, "__wx_total", "__wx_share")), "__wx_total", "__wx_share")


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "class_counts", "word_counts"]
VERDICT = ["class_distance", "word_distance", "base_failed", "kept"]


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` (text) with COUNTS: all that needs the text."""
    d = histograms(without(docs, *COUNTS, *VERDICT))
    blank = lambda line: F.length(F.btrim(line, F.lit(SPACE))) == 0
    d = d.withColumn("__wx_lines", F.filter(F.split("__wx_text", "\n", -1), lambda line: ~blank(line)))
    d = d.withColumn("n_dup_lines", (F.size("__wx_lines") - F.size(F.array_distinct("__wx_lines"))).cast("bigint"))

    # Words in windows that occur twice: positions of windows whose 64-bit hash is not
    # unique in the text, found by sorting (hash, position); then the length of their union.
    at = F.sequence(F.lit(0), F.size("__wx_words") - WINDOW)
    d = d.withColumn("__wx_each", F.transform("__wx_words", lambda w: F.xxhash64(w)))
    hashed = F.transform(at, lambda i: F.xxhash64(*[F.get("__wx_each", i + k) for k in range(WINDOW)]))
    d = d.withColumn("__wx_h", F.when(F.size("__wx_words") >= WINDOW, hashed).otherwise(F.array().cast("array<bigint>")))
    d = d.withColumn("__wx_again", F.size(F.array_distinct("__wx_h")) < F.size("__wx_h"))
    d = d.withColumn("__wx_s", F.when(F.col("__wx_again"), F.sort_array(F.transform("__wx_h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    twins = F.zip_with("__wx_s", F.slice("__wx_s", 2, F.greatest(F.size("__wx_s") - 1, F.lit(0))), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    d = d.withColumn("__wx_p", F.sort_array(F.array_distinct(F.flatten(F.filter(twins, lambda x: x.isNotNull())))))
    gaps = F.zip_with("__wx_p", F.slice("__wx_p", 2, F.greatest(F.size("__wx_p") - 1, F.lit(0))), lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    repeated = F.aggregate(gaps, F.lit(0).cast("bigint"), lambda s, x: s + x)
    d = d.withColumn("n_repeat_words", F.when(F.col("__wx_again"), repeated).otherwise(F.lit(0).cast("bigint")))

    return without(d, "__wx_text", "__wx_words", "__wx_lines", "__wx_each", "__wx_h", "__wx_again", "__wx_s", "__wx_p")


def quality_rules(docs: DataFrame, references: dict | None = None, carry: list[str] | None = None) -> DataFrame:
    """``docs`` (text, and lang where the references are to be counted) with n_words,
    word_chars, n_symbols, n_dup_lines, n_repeat_words, class_distance, word_distance (null
    without characters or words), base_failed and kept. ``carry`` names the columns of
    ``docs`` to return, all unless given.

    Where the references are to be counted, the counts are written once, with the columns
    to carry: the references are summed and the verdicts given from that table, and every
    text is read and measured once.

    Null text is empty; an empty text fails (fewer than 10 words). Input columns with the
    names of computed ones are replaced; repeated rows are judged alike.
    """
    own = [c for c in docs.columns if c.lower() not in {n.lower() for n in (*COUNTS, *VERDICT)}]
    own = [F.col(f"`{c}`") for c in own if carry is None or c in carry]
    d = measured(docs)
    if references is None:
        row = F.struct(*own) if own else F.lit(None)
        d = written(d.select(row.alias("__wx_own"), "lang", *COUNTS), "quality-counts")
        references = language_references(d)
        d = d.select(*(["__wx_own.*"] if own else []), *COUNTS)
    else:
        d = d.select(*own, *COUNTS)
    d = d.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    refs = list(references.values())
    for name, counts, k in (("class_distance", "class_counts", 0), ("word_distance", "word_counts", 1)):
        d = with_divergence(d, name, counts, [r[k] for r in refs])
    far = ((F.col("word_chars") >= MIN_CHARS) & (F.col("class_distance") > MAX_CLASS_DISTANCE)) | (
        (F.col("n_words") >= MIN_COMMON_WORDS) & (F.col("word_distance") > MAX_WORD_DISTANCE)
    )
    # A condition that isn't a function of the row alone (it always holds) keeps a filter on
    # the verdict above the columns it is made of: pushed below, it would repeat all of them
    # inside each other, and work them out anew for every word.
    settled = F.monotonically_increasing_id() >= 0
    d = d.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(far, F.lit(False)) & settled)
    return without(d, "class_counts", "word_counts")


def op5_quality(spark, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality_rules(docs, carry=["doc_id"]).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
