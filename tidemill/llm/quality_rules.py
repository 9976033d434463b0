"""Quality rules with limits that adapt to each language and source. DataFrame functions only.

Every document gets integer measures. Per language and source, each rate and each size is gathered
in a mergeable quantile sketch over the documents that pass the base rule: counts by bin, where
a bin keeps the eight leading bits of a value (relative error under 1/128). The limit of a rate is
a fence above its upper quartile, in steps of the distance of the quartiles. Where most documents
have none of what is counted, that distance is zero; then a step is the smallest event there can
be (one symbol, one repeated line, ...) in a document of the group's size, by the sketch of sizes.

The group's sketch is merged with a weighted one of the whole table, so that a small group leans on
all documents and a large one on its own. A group's fence may exceed the table's by no more than
that lies above the table's upper quartile, so that a source full of junk doesn't switch its
rules off. No fence is a constant. Documents beyond one are filtered by a join with the limits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.session import written

# Fences are sent to every task up to so many groups, and joined by shuffle beyond.
SMALL = 20_000
WHITE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
GROUP = ["lang", "source"]
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Rate -> what is counted, per how much of what, the least event, and the quartile of that size at
# which the event is taken: of few lines a single repeated one is a large share.
RATES = {
    "symbol_rate": ("n_symbols", "word_chars", 100_000, 1, 1),
    "word_length": ("word_chars", "n_words", 1_000, 0, 1),
    "dup_line_rate": ("n_dup_lines", "n_lines", 100_000, 1, 3),
    "repeat_rate": ("n_repeat_words", "n_words", 100_000, 6, 1),  # two windows of three words
    "upper_rate": ("n_upper", "word_chars", 100_000, 1, 1),
}
SIZES = ("word_chars", "n_words", "n_lines")
MEASURES = (*RATES, *SIZES)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))


def measured(docs: DataFrame, carried: list[str], lang: str, source: str, text: str) -> DataFrame:
    """A struct ``row`` of the carried columns, the group, and the measures of the whole texts."""
    whole = F.coalesce(F.col("text"), F.lit(""))
    plain = F.translate(whole, WHITE, " " * len(WHITE))
    lines = F.filter(F.split(whole, "\n"), lambda x: F.translate(x, WHITE, "") != "")
    cut = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row"), F.col(lang).alias("lang"),
        F.col(source).alias("source"), F.col(text).alias("text"),
    ).select(
        *GROUP, "row",
        F.array_remove(F.split(plain, " "), "").alias("words"),
        lines.alias("lines"),
        F.length(F.translate(plain, " ", "")).cast("long").alias("word_chars"),
        (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length(whole) - F.length(F.translate(whole, UPPER, ""))).cast("long").alias("n_upper"),
    )
    # Windows are compared by their 64-bit hashes; only texts that repeat one are sorted.
    hashes = F.slice(
        F.transform(
            "words",
            lambda w, i: F.xxhash64(w, F.get("words", i + 1), F.get("words", i + 2)),
        ),
        1, F.greatest(F.size("words") - 2, F.lit(0)),
    )
    hashed = cut.select(
        *GROUP, "row", "word_chars", "n_symbols", "n_upper",
        F.size("words").cast("long").alias("n_words"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        hashes.alias("hashes"),
    )
    ordered = F.when(
        F.size(F.array_distinct("hashes")) < F.size("hashes"),
        F.array_sort(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
    )
    sorted_ = hashed.select(
        *GROUP, "row", "word_chars", "n_symbols", "n_upper", "n_words", "n_lines", "n_dup_lines",
        ordered.alias("ordered"),
    )
    repeated = F.filter(
        "ordered",
        lambda p, i: (F.when(i > 0, F.get("ordered", i - 1).h) == p.h)
        | (F.get("ordered", i + 1).h == p.h),
    )
    starts = sorted_.withColumn(
        "starts", F.sort_array(F.transform(repeated, lambda p: p.i))
    ).drop("ordered")
    # A repeated window covers three words, fewer if the next repeated one starts within.
    covered = F.transform(
        "starts", lambda s, i: F.least(F.lit(3), F.coalesce(F.get("starts", i + 1) - s, F.lit(3)))
    )
    return starts.withColumn(
        "n_repeat_words", F.coalesce(_sum(covered), F.lit(0).cast("long"))
    ).drop("starts")


def with_rates(docs: DataFrame) -> DataFrame:
    """Integer rates and the base rule's verdict beside the measures."""

    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rates = [
        F.expr(f"{scale} * {part} div greatest({size}, 1)").alias(rate)
        for rate, (part, size, scale, _, _) in RATES.items()
    ]
    return docs.select("*", *rates, base.alias("base_failed"))


def bin_of(value: Column) -> Column:
    """The sketch's bin of a value from 0: its eight leading bits and how many follow them."""
    more = F.greatest(F.length(F.bin(value)) - 8, F.lit(0))
    return F.call_function("shiftright", value, more) + 128 * more


def least_of(number: Column) -> Column:
    """The least value in a bin."""
    more = F.greatest(F.floor(number / 128).cast("int") - 1, F.lit(0))
    return F.call_function("shiftleft", number - 128 * more, more)


def sketches(docs: DataFrame) -> DataFrame:
    """Counts per group, measure and bin: sketches merge by adding the counts of a bin."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(m).alias("measure"), bin_of(F.col(m)).alias("bin")) for m in MEASURES])
    )
    return (
        docs.where(~F.col("base_failed")).select(*GROUP, pairs.alias("p")).groupBy(*GROUP, "p.measure", "p.bin")
        .agg(F.count("*").alias("n"))
    )


def _quartiles(bins: Column, every: Column) -> Column:
    """The quartiles (low, high) of bins (bin, w) that weigh ``every``, by the running sum of weights."""
    start = F.struct(F.lit(0.0).alias("upto"), F.lit(None).cast("long").alias("low"), F.lit(None).cast("long").alias("high"))

    def step(at: Column, x: Column) -> Column:
        upto = at.upto + x.w
        reached = [F.coalesce(at[c], F.when(4 * upto >= k * every, x.bin)) for c, k in (("low", 1), ("high", 3))]
        return F.struct(upto.alias("upto"), reached[0].alias("low"), reached[1].alias("high"))

    return F.aggregate(
        bins, start, step, lambda at: F.struct(least_of(at.low).alias("low"), least_of(at.high).alias("high"))
    )


def limits(sketch: DataFrame, *, steps: int = 9, prior: int = 200) -> DataFrame:
    """A row per group with a fence for each rate, named ``most_<rate>``.

    The table's sketch enters each group's with the weight of ``prior`` documents. It is one array
    of bins for each measure, which is merged with the group's own inside its row.
    """
    bins = F.array_sort(F.collect_list(F.struct("bin", "n")))
    whole = (
        sketch.groupBy("measure", "bin").agg(F.sum("n").alias("n"))
        .groupBy("measure").agg(bins.alias("all_bins"), F.sum("n").alias("total"))
    )

    def weighed(bins: str, weight: Column) -> Column:
        return F.transform(bins, lambda x: F.struct(x.bin.cast("long").alias("bin"), (x.n * weight).cast("double").alias("w")))

    merged = F.array_sort(F.concat(weighed("own_bins", F.col("total")), weighed("all_bins", F.lit(prior))))
    # A row per measure: at most eight, of bounded size.
    table = whole.select(
        "*", _quartiles(weighed("all_bins", F.lit(1)), F.col("total").cast("double")).alias("table")
    )
    every = (F.col("total") * (F.col("own_n") + prior)).cast("double")
    found = (
        sketch.groupBy(*GROUP, "measure").agg(bins.alias("own_bins"), F.sum("n").alias("own_n"))
        .join(F.broadcast(table), "measure")
        .select(*GROUP, "measure", _quartiles(merged, every).alias("own"), "table")
    )
    row = found.groupBy(*GROUP).agg(
        *[F.max(F.when(F.col("measure") == m, F.struct("own", "table"))).alias(m) for m in MEASURES]
    )

    def fence(rate: str, of: str) -> Column:
        _, size, scale, unit, quarter = RATES[rate]
        at = f"{rate}.{of}"
        event = f"{scale * unit} div greatest({size}.{of}.{'low' if quarter == 1 else 'high'}, 1)"
        return F.expr(f"{at}.high + {steps} * greatest({at}.high - {at}.low, {event}, 1)")

    return row.select(*GROUP, *[
        F.least(fence(r, "own"), 2 * fence(r, "table") - F.col(f"{r}.table.high")).alias(f"most_{r}") for r in RATES
    ])


def judged(
    docs: DataFrame, carried: list[str], lang: str = "lang", source: str = "source",
    text: str = "text",
) -> DataFrame:
    """Each document's carried columns (struct ``row``), measures, ``base_failed`` and ``kept``.

    A document is kept if it passes the base rule (50 words, and at most half of them in
    repeated windows of three) and no rate lies beyond its group's fence; a rate at the fence
    stays. A null or empty text has no words and fails; texts of any length are measured whole; a
    null language or source is a group like any other; repeated rows count each and get the same
    verdict; an empty table stays empty, and so does one where no document passes the base rule. Columns that aren't carried are
    left out, whatever their names. The measured rows are written to the shared folder, since
    they are read twice.
    """
    rows = written(with_rates(measured(docs, carried, lang, source, text)), "quality-rules")
    fences = written(limits(sketches(rows)), "quality-limits")
    if fences.count() <= SMALL:
        fences = F.broadcast(fences)
    fences = fences.withColumnsRenamed({c: f"of_{c}" for c in GROUP})
    same = [F.col(c).eqNullSafe(F.col(f"of_{c}")) for c in GROUP]
    over = F.lit(False)
    for r in RATES:
        over |= F.col(r) > F.col(f"most_{r}")
    return (
        rows.join(fences, same[0] & same[1], "left")
        .withColumn("kept", ~F.col("base_failed") & ~F.coalesce(over, F.lit(False)))
        .drop(*[f"of_{c}" for c in GROUP])
    )


def quality_filter(docs: DataFrame, **columns: str) -> DataFrame:
    """The documents that the rules keep, with their columns as they came."""
    return judged(docs, docs.columns, **columns).where("kept").select("row.*")
