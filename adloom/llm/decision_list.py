"""Quality rules as a learned decision list, native Spark throughout.

Statistics are column expressions over the whole text. The learner sees at most
``sample_rows`` labelled rows, already reduced to bins of the statistics (quantile bins, counted
per cell by Spark). Sequential covering then grows one conjunction of thresholds after another:
each condition is the one with the best information gain on two thirds of the rows, conditions
are pruned backwards by (good - bad) / (good + bad) on the other third, and a rule is kept
while it is right on both parts; what it covers is taken out before the next rule. The list
becomes one ordered ``CASE WHEN`` expression.

Null texts have no words and fail the base rules, as do empty ones. Without labels of both
kinds the list has no rules. Repeated rows are judged alike; extra columns do not matter.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.llm.labels import labelled_sample
from adloom.session import scratch_dir

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
SAMPLE_ROWS = 20_000
BINS = 32


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _repeated_words(words: Column) -> Column:
    """Words lying in a window of ``WINDOW`` words that occurs twice or more in the text.

    Every array is bound before a lambda reads it, so moving this expression (say, into a
    pushed-down filter) never makes it compute an array once per element."""

    def starts(s: Column) -> Column:
        twice = F.filter(s, lambda x, k: (F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
                                          | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))))
        return F.array_sort(F.transform(twice, lambda x: x["i"]))

    def widths(d: Column) -> Column:
        return F.transform(d, lambda at, k: F.least(F.lit(WINDOW), F.coalesce(F.get(d, k + 1) - at, F.lit(WINDOW))))

    def covered(found: Column) -> Column:
        ordered = F.array_sort(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.aggregate(_let(_let(ordered, starts), widths), F.lit(0), lambda a, b: a + b)

    def counted(w: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(1), F.size(w) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(w, i, WINDOW)))
        repeats = _let(windows, lambda x: F.when(F.size(F.array_distinct(x)) < F.size(x), covered(x)).otherwise(F.lit(0)))
        return F.when(F.size(w) > WINDOW, repeats).otherwise(F.lit(0))

    return _let(words, counted)


STATISTICS = {"n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_lines"}


def base_statistics(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (longs) and
    n_upper, n_lines (for the learner) at the end, the text left out. Columns of the input that are named
    like one of these are replaced by it."""
    kept = [c for c in docs.columns if c != text_col and c.lower() not in STATISTICS]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    # Positional names: extra columns may bear any name.
    split = docs.select(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)), text.alias("_text"), words.alias("_words"), lines.alias("_lines"))
    without = lambda signs: F.length(F.translate("_text", signs, ""))
    n_lines = F.size("_lines")
    return split.select(
        *(F.col(f"c{i}").alias(c) for i, c in enumerate(kept)),
        F.size("_words").cast("long").alias("n_words"), without(BLANKS).cast("long").alias("word_chars"),
        (F.length("_text") - without(SYMBOLS)).cast("long").alias("n_symbols"),
        (n_lines - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _repeated_words(F.col("_words")).cast("long").alias("n_repeat_words"),
        (F.length("_text") - without("ABCDEFGHIJKLMNOPQRSTUVWXYZ")).cast("long").alias("n_upper"),
        n_lines.cast("long").alias("n_lines"))




def measures() -> dict[str, Column]:
    """What thresholds apply to, over the base statistics."""
    words, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    return {
        "n_words": F.col("n_words").cast("double"), "word_length": F.col("word_chars") / words,
        "symbol_share": F.col("n_symbols") / chars, "dup_line_share": F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        "repeat_share": F.col("n_repeat_words") / words, "upper_share": F.col("n_upper") / chars,
    }


@dataclass(frozen=True)
class Condition:
    measure: str
    above: bool  # measure > threshold, else measure <= threshold
    threshold: float
    bin: int


@dataclass(frozen=True)
class Rule:
    """Rejects what meets all conditions."""

    conditions: tuple[Condition, ...]
    right: int
    wrong: int

    def __str__(self) -> str:
        return " and ".join(f"{c.measure} {'>' if c.above else '<='} {c.threshold:.6g}" for c in self.conditions)


Cell = tuple[tuple[int, ...], int, int]  # bins, bad rows, good rows


def _totals(cells: list[Cell]) -> tuple[int, int]:
    return sum(c[1] for c in cells), sum(c[2] for c in cells)


def _meets(bins: tuple[int, ...], tests: list[tuple[int, bool, int]]) -> bool:
    return all((bins[m] > b) == above for m, above, b in tests)


def _best_condition(cells: list[Cell], n_measures: int) -> tuple[int, bool, int] | None:
    bad, good = _totals(cells)
    now = math.log2(bad / (bad + good))
    best, found = 1e-9, None
    for m in range(n_measures):
        hist: dict[int, list[int]] = {}
        for bins, b, g in cells:
            at = hist.setdefault(bins[m], [0, 0])
            at[0] += b
            at[1] += g
        low = [0, 0]
        for cut in sorted(hist)[:-1]:
            low[0] += hist[cut][0]
            low[1] += hist[cut][1]
            for above, (b, g) in ((False, low), (True, (bad - low[0], good - low[1]))):
                gain = b * (math.log2(b / (b + g)) - now) if b else 0
                if gain > best:
                    best, found = gain, (m, above, cut)
    return found


def learn_rules(grow: list[Cell], prune: list[Cell], names: list[str], edges: dict[str, list[float]], *,
                max_rules: int = 12, max_conditions: int = 4, least_right: float = 0.8) -> list[Rule]:
    """Ordered rules from two lists of cells (bins of the measures, bad rows, good rows)."""
    rules: list[Rule] = []
    while len(rules) < max_rules and _totals(grow)[0]:
        tests: list[tuple[int, bool, int]] = []
        left = grow
        while len(tests) < max_conditions and _totals(left)[1]:
            best = _best_condition(left, len(names))
            if best is None:
                break
            tests.append(best)
            left = [c for c in left if _meets(c[0], [best])]

        def worth(some: list[tuple[int, bool, int]]) -> float:
            b, g = _totals([c for c in prune if _meets(c[0], some)])
            return (b - g) / (b + g) if b + g else -1.0

        while len(tests) > 1 and worth(tests[:-1]) >= worth(tests):
            tests.pop()
        b, g = _totals([c for c in grow if _meets(c[0], tests)])
        pb, pg = _totals([c for c in prune if _meets(c[0], tests)])
        if not tests or b < least_right * (b + g) or pb < least_right * (pb + pg) or b + pb < 5:
            break
        rules.append(Rule(tuple(Condition(names[m], above, edges[names[m]][cut], cut) for m, above, cut in tests), b + pb, g + pg))
        grow = [c for c in grow if not _meets(c[0], tests)]
        prune = [c for c in prune if not _meets(c[0], tests)]
    return rules


def _midway(sample: DataFrame, rules: list[Rule]) -> list[Rule]:
    """Thresholds moved half way to the next value of the sample."""
    used = sorted({(c.measure, c.threshold) for r in rules for c in r.conditions})
    if not used:
        return rules
    ends = sample.agg(*(F.max(F.when(F.col(m) <= t, F.col(m))).alias(f"a{i}") for i, (m, t) in enumerate(used)),
                      *(F.min(F.when(F.col(m) > t, F.col(m))).alias(f"b{i}") for i, (m, t) in enumerate(used))).first()
    moved = {x: (ends[f"a{i}"] + ends[f"b{i}"]) / 2 if None not in (ends[f"a{i}"], ends[f"b{i}"]) else x[1] for i, x in enumerate(used)}
    return [replace(r, conditions=tuple(replace(c, threshold=moved[c.measure, c.threshold]) for c in r.conditions)) for r in rules]


def fit_rules(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", grade_col: str = "quality",
              sample_rows: int = SAMPLE_ROWS, bins: int = BINS) -> list[Rule]:
    """Rules that reject rows of grade 0, from at most ``sample_rows`` labelled documents;
    learned on those that pass the base rules, as the list comes after them."""
    spark = docs.sparkSession
    path = scratch_dir(spark, "rule-sample")
    rows = labelled_sample(docs, labels, id_col, grade_col, sample_rows, [F.col(text_col).alias("_text")])
    named = measures()
    stats = base_statistics(rows, "_text")
    stats.select("grade", base_failed().alias("failed"), F.pmod(F.xxhash64("_id"), F.lit(3)).alias("fold"), *(v.alias(k) for k, v in named.items())).write.parquet(path)
    sample = spark.read.parquet(path).where("not failed")
    names = list(named)
    quantiles = sample.agg(*(F.percentile_approx(k, [i / bins for i in range(1, bins)], F.lit(10_000)).alias(k) for k in names)).first()
    edges = {k: sorted(set(quantiles[k] or [])) for k in names}
    # The bin of a value is the number of edges below it.

    def bin_of(name: str) -> Column:
        return sum((F.when(F.col(name) > e, 1).otherwise(0) for e in edges[name]), F.lit(0)).alias(name)

    binned = [bin_of(k) for k in names]
    cells = (sample.select("fold", (F.col("grade") == 0).alias("bad"), *binned).groupBy("fold", *names)
             .agg(F.count_if("bad").alias("b"), F.count_if(~F.col("bad")).alias("g")).collect())  # sample_rows at most
    cells.sort(key=tuple)
    parts: dict[bool, list[Cell]] = {False: [], True: []}
    for r in cells:
        parts[r.fold == 0].append((tuple(r[k] for k in names), r.b, r.g))
    return _midway(sample, learn_rules(parts[False], parts[True], names, edges))


def base_failed() -> Column:
    """The fixed rules that come before the list."""
    return (F.col("n_words") < 20) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 30)


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule met (from 1), null if none: one ordered CASE WHEN."""
    named = measures()
    out = None
    for k, rule in enumerate(rules, 1):
        met = F.lit(True)
        for c in rule.conditions:
            met = met & (named[c.measure] > c.threshold if c.above else named[c.measure] <= c.threshold)
        out = F.when(met, F.lit(k)) if out is None else out.when(met, F.lit(k))
    return F.lit(None).cast("int") if out is None else out


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rules = fit_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return (base_statistics(docs)
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    base_failed().alias("base_failed"), verdict(rules).alias("rule"))
            .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()))
