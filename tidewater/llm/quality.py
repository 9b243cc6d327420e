"""Quality rules with thresholds from the data, with DataFrame functions only.

Each document gets a few counts. Their ratios, in thousandths, go into one sketch per
language, source and ratio: a count for each value, which merges by addition, is exact
to a thousandth and never exceeds ``TOP`` + 1 entries however many documents there are.

Most documents have ratio 0, so quartiles over all of them say nothing. Two kinds of
threshold that do not degenerate are read off a sketch. Symbols form two populations,
texts with hardly any and garbage: the threshold is the middle of the gap where the
magnitudes (powers of two) split best, by the largest variance between the two parts.
Repeated lines and words have one long tail: the threshold is the quantile ``TAIL`` of the
values above 0. A group with fewer than ``ENOUGH`` values above 0 uses the sketch of its
language, a language with fewer that of all documents; without any, nothing is rejected.
``NOISE`` only keeps thresholds above what a few characters make. Documents are then joined
with their thresholds: kept are those that pass the base rules and no ratio above its threshold.

Null texts have no words and fail; null languages and sources are groups of their own.
Repeated rows count as often as they occur, and an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import written

# Fixed values of the base rules.
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
LEAST_WORDS, MOST_REPEATED = 50, 50

TOP = 4000
ENOUGH = 20
RATIOS = ["symbol", "line", "repeat"]
TAIL = {"line": 90, "repeat": 95}  # percent of the values above 0
NOISE = {"symbol": 10, "line": 30, "repeat": 30}
BROADCAST_GROUPS, SALTS = 20_000, 32
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once for each row."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _repeat_words(words: Column) -> Column:
    """Words in three-word windows that occur at least twice in the text.

    Windows are compared by a 64-bit hash inside one document: sorted, equal ones are
    neighbours; their places, sorted again, cover up to three words each.
    """
    windows = F.when(F.size(words) > 2, F.transform(
        F.sequence(F.lit(0), F.size(words) - 3),
        lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")),
    )).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))

    def places(s: Column) -> Column:
        twice = lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(s, twice), lambda x: x["i"]))

    def covered(p: Column) -> Column:
        steps = F.transform(p, lambda x, k: F.least(F.coalesce(F.get(p, k + 1) - x, F.lit(3)), F.lit(3)))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    return let(F.sort_array(windows), lambda s: let(places(s), covered))


def scored(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with one struct ``_q`` of the counts, ``base_failed`` and the ratios."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    drop = lambda chars: F.translate(text, chars, "")
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(SPACE))) > 0)
    counts = let(words, lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), _repeat_words(w).alias("n_repeat_words"),
    ))
    return docs.withColumn("_q", let(counts, lambda c: let(lines, lambda x: F.struct(
        c["n_words"].alias("n_words"),
        F.length(drop(SPACE)).cast("long").alias("word_chars"),
        (F.length(text) - F.length(drop(SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        c["n_repeat_words"].alias("n_repeat_words"),
        F.size(x).cast("long").alias("n_lines"),
    ))))


def _measured(df: DataFrame) -> DataFrame:
    """Adds ``base_failed`` and the ratios in thousandths to rows with ``_q``."""
    q = F.col("_q")
    share = lambda a, b: F.when(b > 0, F.floor(1000 * a / b)).otherwise(0).cast("int")
    return df.withColumns({
        "_failed": (q["n_words"] < LEAST_WORDS) | (100 * q["n_repeat_words"] > MOST_REPEATED * q["n_words"]),
        "_symbol": share(q["n_symbols"], q["word_chars"]),
        "_line": share(q["n_dup_lines"], q["n_lines"]),
        "_repeat": share(q["n_repeat_words"], q["n_words"]),
    })


def sketches(measured: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, ratio, value, n): sketches of documents that pass the base rules.
    Sketches of two tables merge by adding n."""
    cells = F.explode(F.array(*[F.struct(F.lit(r).alias("ratio"), F.least(F.col(f"_{r}"), F.lit(TOP)).alias("value")) for r in RATIOS]))
    return (
        measured.where("NOT _failed").select(F.col(lang).alias("lang"), F.col(source).alias("source"), cells.alias("c"))
        .groupBy("lang", "source", "c.ratio", "c.value").agg(F.count("*").alias("n"))
    )


def _cuts(sketch: DataFrame, by: list[str]) -> DataFrame:
    """(by, ratio, some, cut) from sketches merged to the level ``by``: how many values are above 0,
    and the threshold, null where there is none."""
    keys = [*by, "ratio"]
    merged = sketch.groupBy(*keys, "value").agg(F.sum("n").alias("n")).withColumn("m", F.length(F.bin(F.col("value") + 1)))
    some = F.when(F.col("value") > 0, F.col("n")).otherwise(0)
    whole = Window.partitionBy(*keys)
    ranked = merged.select("*", F.sum(some).over(whole).alias("some"), F.sum(some).over(whole.orderBy("value")).alias("seen"))
    share = F.when(F.col("ratio") == "line", TAIL["line"]).otherwise(TAIL["repeat"])
    tail = ranked.groupBy(*keys).agg(
        F.max("some").alias("some"), F.min(F.when((F.col("value") > 0) & (100 * F.col("seen") >= share * F.col("some")), F.col("value"))).alias("tail")
    )
    parts = merged.groupBy(*keys, "m").agg(F.sum("n").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    number = lambda c: c.cast("double")
    upto = whole.orderBy("m")
    left, weight = number(F.sum("n").over(upto)), number(F.sum(F.col("n") * F.col("m")).over(upto))
    docs, total = number(F.sum("n").over(whole)), number(F.sum(F.col("n") * F.col("m")).over(whole))
    apart = docs * weight - left * total
    split = parts.select(
        *keys, "m", (apart * apart / (left * (docs - left))).alias("apart"),
        F.floor((F.col("high") + F.lead("low").over(upto)) / 2).cast("int").alias("middle"), (docs - left).alias("above"),
    ).where("above > 0")
    middle = split.groupBy(*keys).agg(F.max_by("middle", F.struct("apart", -F.col("m"))).alias("middle"))
    found = tail.join(middle.select(*[F.col(k).alias(f"_{k}") for k in keys], "middle"), [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], "left")
    cut = F.when(F.col("ratio") == "symbol", F.col("middle")).otherwise(F.col("tail"))
    return found.select(*keys, "some", cut.alias("cut"))


def thresholds(sketch: DataFrame) -> DataFrame:
    """(lang, source, symbol, line, repeat): one row for each group of the sketch."""
    own, language, every = (_cuts(sketch, by) for by in (["lang", "source"], ["lang"], []))
    language = language.select(F.col("lang").alias("l"), F.col("ratio").alias("r"), F.col("some").alias("l_some"), F.col("cut").alias("l_cut"))
    every = every.select(F.col("ratio").alias("a"), F.col("cut").alias("a_cut"))
    best = (
        own.join(language, F.col("lang").eqNullSafe(F.col("l")) & (F.col("ratio") == F.col("r")))
        .join(F.broadcast(every), F.col("ratio") == F.col("a"))  # three rows
        .withColumn("cut", F.when(F.col("some") >= ENOUGH, F.col("cut")).when(F.col("l_some") >= ENOUGH, F.col("l_cut")).otherwise(F.col("a_cut")))
    )
    limit = lambda r: F.max(F.when(F.col("ratio") == r, F.coalesce("cut", F.lit(TOP))))
    return best.groupBy("lang", "source").agg(*[F.greatest(limit(r), F.lit(NOISE[r])).alias(r) for r in RATIOS])


def judged(measured: DataFrame, limits: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """``measured`` with ``_kept``. The limits are broadcast if they are counted to be few;
    otherwise both sides are joined by group and a salt, so no group meets in one task."""
    limits = limits.select(F.col("lang").alias("_l"), F.col("source").alias("_s"), *[F.col(r).alias(f"_max_{r}") for r in RATIOS])
    same = F.col(lang).eqNullSafe(F.col("_l")) & F.col(source).eqNullSafe(F.col("_s"))
    if limits.count() <= BROADCAST_GROUPS:
        joined = measured.join(F.broadcast(limits), same, "left")
    else:
        salted = limits.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        row_salt = F.pmod(F.xxhash64("_q"), F.lit(SALTS)).cast("int")
        joined = measured.withColumn("_row", row_salt).join(salted, same & (F.col("_row") == F.col("_salt")), "left").drop("_row", "_salt")
    within = [F.coalesce(F.col(f"_{r}") <= F.col(f"_max_{r}"), F.lit(True)) for r in RATIOS]
    return joined.withColumn("_kept", ~F.col("_failed") & within[0] & within[1] & within[2])


def verdicts(docs: DataFrame) -> DataFrame:
    """(doc_id, counts, base_failed, kept) of every document; the texts are read once."""
    counts = written(_measured(scored(docs)).select("doc_id", "lang", "source", "_q", "_failed", *[f"_{r}" for r in RATIOS]), "quality-counts")
    rows = judged(counts, written(thresholds(sketches(counts)), "quality-limits"))
    return rows.select("doc_id", *[F.col("_q")[c].alias(c) for c in COUNTS], F.col("_failed").alias("base_failed"), F.col("_kept").alias("kept"))


def kept(docs: DataFrame) -> DataFrame:
    """The documents that pass, with the columns they came with. They are written once with
    their counts, which are the dear part; sketches and verdicts are read from that."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "lang", "source", "text")
    measured = written(_measured(scored(rows)).drop("text"), "quality-measured")
    limits = written(thresholds(sketches(measured)), "quality-limits")
    return judged(measured, limits).where("_kept").select("_row.*")
