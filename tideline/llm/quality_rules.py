"""Quality rules whose cutoffs come with a bound on how often they reject good documents.

Each rule rejects a document whose measure exceeds a cutoff. Cutoffs are not
set by hand. Per stratum (language) there is one walk over settings of all
rules together: each step makes one rule stricter. A quarter of the labelled
good documents and the bad ones put the steps in order (what costs no good
ones comes first); steps that catch nothing bad are left out. The other good
documents are the holdout: after each step, those that any rule rejects are
counted, and a setting is used only if the exact binomial tail shows, at the
corrected level, that all rules together reject at most
``max_false_rejection`` of the good documents. The order is fixed before the
holdout is looked at and the walk ends at the first step that fails, so the
walk needs no correction; strata are corrected by Bonferroni. With too few
labels (see ``labels_needed``) no step passes and only the base rules reject.

Everything is a DataFrame expression. A null text has no words and fails the
base rules, null strata form a stratum of their own, strata without labels
reject by the base rules only, repeated rows are judged alike, and columns of
the input keep their names (new ones are added beside them).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.text import NOT_SPACE, SPACE_CHAR, free_name, let, words_of
from tideline.operators.joins import is_small
from tideline.session import written

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = "[#*$%&|<>]"
MAX_FALSE_REJECTION = 0.02
CONFIDENCE = 0.95
#: One in so many labelled documents orders the steps; the others certify them.
ORDERING = 4

#: Rule, its measure as SQL over the base columns, and its candidate cutoffs from mild to strict.
RULES = (
    ("symbols", "n_symbols / greatest(word_chars, 1)", (0.5, 0.4, 0.3, 0.25, 0.2, 0.16, 0.13, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03)),
    ("dup_lines", "n_dup_lines / greatest(n_lines, 1)", (0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2)),
    ("capitals", "n_capitals / greatest(word_chars, 1)", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15)),
    ("repeats", "n_repeat_words / greatest(n_words, 1)", (0.3, 0.28, 0.26, 0.24, 0.22, 0.2, 0.18, 0.15, 0.12, 0.1)),
    ("long_words", "word_chars / greatest(n_words, 1)", (200.0, 100.0, 60.0, 40.0, 30.0, 25.0, 20.0, 17.0, 15.0, 13.0, 12.0)),
)

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _repeat_words(words: Column) -> Column:
    """Words inside 8-word windows that occur twice or more in the text.

    Texts whose window hashes all differ have none. In the others the windows
    themselves are sorted, equal neighbours are marked, and the words under
    marked windows are counted once each.
    """
    last = F.size(words) - F.lit(WINDOW) + 1

    def window(words: Column, i: Column) -> list[Column]:
        # One by one: slice() copies the whole array at every call.
        return [F.get(words, i - 1 + j) for j in range(WINDOW)]

    def exact(words: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(1), last), lambda i: F.struct(F.concat_ws(" ", *window(words, i)).alias("w"), i.alias("i"))
        )
        return let(F.array_sort(windows), covered)

    def covered(ordered: Column) -> Column:
        marked = F.filter(
            F.transform(ordered, lambda s, k: F.when(
                (F.get(ordered, k - 1)["w"] == s["w"]) | (F.get(ordered, k + 1)["w"] == s["w"]), s["i"]
            )),
            lambda i: i.isNotNull(),
        )
        return F.aggregate(
            F.array_sort(marked),
            F.struct(F.lit(0).alias("total"), F.lit(0).alias("end")),
            lambda acc, i: F.struct(
                (acc["total"] + i + F.lit(WINDOW) - F.greatest(acc["end"], i)).alias("total"),
                (i + F.lit(WINDOW)).alias("end"),
            ),
        )["total"]

    def joined(hashes: Column, width: int) -> Column:
        # Hashes of 2 * width words from those of width words.
        return let(hashes, lambda h: F.zip_with(
            F.slice(h, 1, F.greatest(F.size(h) - width, F.lit(0))), F.slice(h, width + 1, F.size(h)), lambda a, b: F.xxhash64(a, b)
        ))

    # Three rounds of pairs make hashes of 8 words; only texts with equal ones spell their windows out.
    hashes = joined(joined(joined(F.transform(words, lambda word: F.xxhash64(word)), 1), 2), 4)
    return F.when(last < 2, F.lit(0)).when(F.size(F.array_distinct(hashes)) == last, F.lit(0)).otherwise(exact(words)).cast("long")


def measured(docs: DataFrame, text: str = "text", measures: str = "measures") -> DataFrame:
    """``docs`` with a struct ``measures`` of the base counts and what the rules need besides."""
    words, lines = free_name(docs, "words"), free_name(docs, "lines")
    content = F.coalesce(F.col(text), F.lit(""))

    def count(pattern: str) -> Column:
        return F.regexp_count(content, F.lit(pattern)).cast("long")

    with_words = docs.withColumns({
        words: words_of(text),
        lines: F.filter(F.split(content, "\n"), lambda line: line.rlike(NOT_SPACE)),
    })
    counts = F.struct(
        F.size(words).cast("long").alias("n_words"),
        (F.length(content) - count(SPACE_CHAR)).alias("word_chars"),
        count(SYMBOLS).alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        let(F.col(words), _repeat_words).alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        count("[A-Z]").alias("n_capitals"),
    )
    return with_words.withColumn(measures, counts).drop(words, lines)


def base_failed(measures: Column) -> Column:
    return (measures["n_words"] < MIN_WORDS) | (100 * measures["n_repeat_words"] > MAX_REPEAT_PERCENT * measures["n_words"])


def _measure(rule: str, measures: str) -> Column:
    sql = next(expression for name, expression, _ in RULES if name == rule)
    for name in (*BASE, "n_lines", "n_capitals"):
        sql = sql.replace(name, f"{measures}.{name}")
    return F.expr(sql).cast("double")


def binomial_tail(k: Column, n: Column, rate: float) -> Column:
    """P(X <= k) for X binomial with ``n`` trials of ``rate``, summed term by term in logarithms."""
    step = F.lit(rate / (1 - rate))
    first = n * F.log(F.lit(1 - rate))
    summed = F.aggregate(
        F.sequence(F.lit(1).cast("long"), F.greatest(k, F.lit(1).cast("long"))),
        F.struct(first.alias("term"), first.alias("total")),
        lambda acc, i: F.struct(
            F.when(i <= k, acc["term"] + F.log((n - i + 1) / i * step)).otherwise(acc["term"]).alias("term"),
            F.when(
                i <= k,
                F.greatest(acc["total"], acc["term"] + F.log((n - i + 1) / i * step))
                + F.log1p(F.exp(-F.abs(acc["total"] - acc["term"] - F.log((n - i + 1) / i * step)))),
            ).otherwise(acc["total"]).alias("total"),
        ),
    )
    return F.least(F.lit(1.0), F.exp(summed["total"]))


def _level(rule: str, cutoffs: tuple[float, ...], measures: str) -> Column:
    """How many of a rule's cutoffs a document exceeds: with n of m, it is the n strictest."""
    return sum((_measure(rule, measures) > F.lit(c)).cast("int") for c in cutoffs)


def thresholds(labelled: DataFrame, stratum: str, good: str, measures: str = "measures", key: str = "doc_id",
               max_false_rejection: float = MAX_FALSE_REJECTION, confidence: float = CONFIDENCE) -> DataFrame:
    """One row per stratum with a map of the certified cutoffs, from measured, labelled documents.

    Rows whose ``good`` is 1 and that the base rules keep count as good. Those
    of a quarter of the keys (and the bad ones) order the steps, the others certify them.
    Rules without a certified cutoff are missing from the map; a stratum needs ``labels_needed`` good documents for one.
    """
    levels = [_level(rule, cutoffs, measures).alias(f"l{r}") for r, (rule, cutoffs) in enumerate((n, c) for n, _, c in RULES)]
    names = [f"l{r}" for r in range(len(RULES))]
    base = labelled.filter(~base_failed(F.col(measures))).select(
        F.col(stratum).alias("stratum"), (F.col(good) == 1).alias("good"), (F.pmod(F.xxhash64(key), F.lit(ORDERING)) == 0).alias("orders"), *levels
    )
    # Written: a row per stratum and combination of levels, few whatever the number of documents.
    counted = written(base.groupBy("stratum", "good", "orders", *names).agg(F.count(F.lit(1)).alias("n")), "strata")

    # Step (r, j) sets rule r to its j-th cutoff. Its cost and catch, of that rule alone, place it in the walk.
    each = F.explode(F.array(*[
        F.struct(F.lit(r).alias("r"), (F.lit(len(cutoffs)) - F.col(f"l{r}")).alias("j"), F.lit(len(cutoffs)).alias("m"))
        for r, (_, _, cutoffs) in enumerate(RULES)
    ]))
    exceeding = counted.select("stratum", "good", "orders", "n", each.alias("s")).select("*", "s.*").filter("j < m")
    per_step = exceeding.groupBy("stratum", "r", "j").agg(
        F.sum(F.when(F.col("good") & F.col("orders"), F.col("n")).otherwise(0)).alias("cost"),
        F.sum(F.when(~F.col("good"), F.col("n")).otherwise(0)).alias("added"),
    )
    milder = Window.partitionBy("stratum", "r").orderBy("j")
    walk = Window.partitionBy("stratum").orderBy("cost", F.desc("caught"), "r", "j")
    steps = per_step.select(
        "stratum", "r", "j", "added", F.sum("cost").over(milder).alias("cost"), F.sum("added").over(milder).alias("caught")
    ).filter("added > 0").withColumn("at", F.row_number().over(walk))
    steps = steps.groupBy(F.col("stratum").alias("of")).agg(F.collect_list(F.struct("r", "j", "at")).alias("steps"))

    # The step at which a combination of levels is rejected first, by whatever rule.
    hits = lambda s: F.exists(F.array(*[
        F.struct(F.lit(r).alias("r"), F.lit(len(cutoffs)).alias("m"), F.col(f"l{r}").alias("l")) for r, (_, _, cutoffs) in enumerate(RULES)
    ]), lambda own: (own["r"] == s["r"]) & (own["l"] > 0) & (s["j"] >= own["m"] - own["l"]))
    reached = counted.join(steps, F.col("stratum").eqNullSafe(F.col("of")), "left").withColumn(
        "first", F.array_min(F.transform(F.filter("steps", hits), lambda s: s["at"]))
    )
    certifies = F.col("good") & ~F.col("orders")
    by_first = reached.groupBy("stratum", "first").agg(
        F.sum(F.when(certifies, F.col("n")).otherwise(0)).alias("good"), F.sum(F.when(~F.col("good"), F.col("n")).otherwise(0)).alias("bad")
    )
    whole, so_far = Window.partitionBy("stratum"), Window.partitionBy("stratum").orderBy(F.asc_nulls_last("first"))
    sums = by_first.select(
        "stratum", "first", F.sum("good").over(whole).alias("n_good"), F.sum("good").over(so_far).alias("k"), F.sum("bad").over(so_far).alias("caught")
    ).filter("first IS NOT NULL AND n_good > 0")
    corrected = (1 - confidence) / max(1, counted.select("stratum").distinct().count())
    # A count above the expected one fails by itself; below it the tail is summed.
    passes = F.when(F.col("k") > F.col("n_good") * max_false_rejection, F.lit(False)).otherwise(
        binomial_tail(F.col("k"), F.col("n_good"), max_false_rejection) <= corrected
    )
    # Rejections only grow along the walk, so the steps that pass are its head. Of them the first
    # that catches as many bad documents as the last is taken.
    best = sums.filter(passes).groupBy("stratum").agg(F.max(F.struct("caught", (-F.col("first")).alias("earliest"))).alias("best"))
    taken = best.join(steps, F.col("stratum").eqNullSafe(F.col("of"))).select("stratum", F.filter("steps", lambda s: s["at"] <= -F.col("best.earliest")).alias("taken"))
    cutoffs = F.map_from_entries(F.array_compact(F.array(*[
        F.when(F.exists("taken", lambda s: s["r"] == r), F.struct(F.lit(rule).alias("key"), F.element_at(
            F.array(*[F.lit(c) for c in cutoffs]),
            F.array_max(F.transform(F.filter("taken", lambda s: s["r"] == r), lambda s: s["j"])).cast("int") + 1,
        ).alias("value"))) for r, (rule, _, cutoffs) in enumerate(RULES)
    ])))
    return taken.select("stratum", cutoffs.alias("cutoffs"))


def labels_needed(strata: int, max_false_rejection: float = MAX_FALSE_REJECTION, confidence: float = CONFIDENCE) -> int:
    """Certifying good documents, none of them rejected, that a stratum needs for its first cutoff."""
    return math.ceil(math.log((1 - confidence) / strata) / math.log(1 - max_false_rejection))


def judged(measured_docs: DataFrame, cutoffs: DataFrame, stratum: str, measures: str = "measures",
           verdict: str = "verdict") -> DataFrame:
    """Add the struct ``verdict``: ``base_failed``, ``rejected_by`` (names of rules) and ``kept``."""
    cut = free_name(measured_docs, "cut")
    named = cutoffs.select(F.struct("*").alias(cut))
    joined = measured_docs.join(named, F.col(f"{cut}.stratum").eqNullSafe(F.col(stratum)), "left")
    broken = F.array_compact(F.array(*[
        F.when(_measure(rule, measures) > F.col(f"{cut}.cutoffs")[rule], F.lit(rule)) for rule, _, _ in RULES
    ]))
    failed = base_failed(F.col(measures))
    return joined.withColumn(verdict, F.struct(
        failed.alias("base_failed"), broken.alias("rejected_by"), (~failed & (F.size(broken) == 0)).alias("kept")
    )).drop(cut)


def good_labels(labels: DataFrame, good: str = "quality") -> DataFrame:
    """One row per labelled document; where labels disagree it does not count as good."""
    return labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(good).alias("good"))


def filtered(docs: DataFrame, labels: DataFrame, text: str = "text", stratum: str = "lang") -> DataFrame:
    """The documents that no rule rejects, with the columns they came with; cutoffs come from the labelled ones of ``docs``.

    Texts are measured once: the measures are written beside them, and labels,
    cutoffs and verdicts are read from there.
    """
    measures, verdict = free_name(docs, "measures"), free_name(docs, "verdict")
    beside = written(measured(docs, text, measures), "measured")
    narrow = beside.select("doc_id", F.col(stratum).alias("stratum"), F.col(measures).alias("measures"))
    cutoffs = written(thresholds(narrow.join(good_labels(labels), "doc_id"), "stratum", "good"), "cutoffs")
    # A row per stratum: sent to the documents, whose texts then stay where they are.
    cutoffs = F.broadcast(cutoffs) if is_small(cutoffs) else cutoffs
    return judged(beside, cutoffs, stratum, measures, verdict).filter(F.col(f"{verdict}.kept")).select(*docs.columns)
