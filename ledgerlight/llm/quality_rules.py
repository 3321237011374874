"""Quality rules: cutoffs whose false rejections are bounded on labelled holdouts."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.common import slices, stored, text_bytes

SYMBOLS = b"#*$%&|<>"
#: Each rule rejects a document whose rate is above the cutoff of its stratum.
RULES = ("symbol_rate", "repeat_rate", "dup_line_rate", "upper_rate")
#: Cutoffs of a rule: LEVELS / LEVELS, which rejects nobody, ..., 0 / LEVELS.
LEVELS = 100
STATS = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, n_lines bigint, n_upper bigint"
)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window which the text has twice or more."""
    if len(words) < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:], strict=False))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered = end = 0
    for start, window in enumerate(windows):
        if counts[window] > 1:
            covered += start + 3 - max(start, end)
            end = start + 3
    return covered


def text_stats(text: bytes) -> tuple[int, ...]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper."""
    words = text.split()
    joined = b"".join(words)
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        len(joined.decode("utf-8", "replace")),
        len(joined) - len(joined.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(joined) - len(joined.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")),
    )


def _stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 1 << 22):
        rows = [text_stats(text) for text in text_bytes(batch.column("text"))]
        names = [part.split()[0] for part in STATS.split(", ")]
        columns = [batch.column("doc_id").cast(pa.int64())]
        columns += [pa.array(values, pa.int64()) for values in zip(*rows, strict=True)]
        rest = [name for name in batch.schema.names if name not in ("doc_id", "text")]
        yield pa.RecordBatch.from_arrays([*columns, *map(batch.column, rest)], names=[*names, *rest])


def document_stats(docs: DataFrame, stratum: str | None = "lang", whole_row: bool = False) -> DataFrame:
    """One row of counts per document over its whole text; null text has no words.

    ``whole_row`` adds the row of ``docs`` as the struct ``row``.
    """
    label = F.coalesce(F.col(stratum).cast("string"), F.lit("")) if stratum else F.lit("")
    picked = docs.select(
        F.col("doc_id").cast("bigint"),
        "text",
        label.alias("stratum"),
        *([F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if whole_row else []),
    )
    made = STATS + ", stratum string"
    return picked.mapInArrow(_stats, made + f", row {picked.schema['row'].dataType.simpleString()}" if whole_row else made)


def with_rates(stats: DataFrame) -> DataFrame:
    """The rates the rules look at and the fixed floor every document must pass."""
    chars, words, lines = (F.greatest(F.col(c), F.lit(1)) for c in ("word_chars", "n_words", "n_lines"))
    return stats.withColumns(
        {
            "symbol_rate": F.col("n_symbols") / chars,
            "repeat_rate": F.col("n_repeat_words") / words,
            "dup_line_rate": F.col("n_dup_lines") / lines,
            "upper_rate": F.col("n_upper") / chars,
            "base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
        }
    )


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial (n, p), summed from the largest term below the mean."""
    if n <= 0 or k >= n:
        return 1.0
    if k > n * p:
        return 1.0  # above the mean there is no evidence for a smaller rate
    log = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    term = total = math.exp(log)
    for i in range(k, 0, -1):
        term *= i * (1 - p) / ((n - i + 1) * p)
        total += term
        if term < total * 1e-16:
            break
    return min(1.0, total)


def ladder(bad: dict[str, list[int]], others: dict[str, list[int]]) -> dict[str, list[int]]:
    """Cutoffs of all rules, step by step from none to strict: a level of each rule by step.

    ``bad`` and ``others`` have, by rule and level, the bad holdouts and the documents
    without a label.  A step lowers the cutoff of one rule: where it catches most bad
    holdouts for each unlabelled document, and no further than that.  Good holdouts have
    no say in it, so that they can test each step.
    """
    now = {rule: LEVELS for rule in RULES}
    made = {rule: [LEVELS] for rule in RULES}
    while True:
        best = None
        for rule in RULES:
            caught = passed = 0
            for level in range(now[rule] - 1, -1, -1):
                caught, passed = caught + bad[rule][level + 1], passed + others[rule][level + 1]
                worth = caught / (passed + 1)
                if caught and (best is None or worth > best[0]):
                    best = worth, rule, level
        if best is None:
            return made
        now[best[1]] = best[2]
        for rule in RULES:
            made[rule].append(now[rule])


def chosen_step(good: list[int], bad: list[int], risk: float, error: float, price: float) -> int:
    """Step of a ladder, from how many good and bad holdouts each step rejects first; 0 rejects nobody.

    Steps are tested in order.  One passes when the exact binomial upper bound of the
    good holdouts rejected by then, at confidence 1 - ``error``, is at most ``risk``; the
    first that fails ends the sequence, so its tests share ``error``.  Of those that
    passed, the one with the largest share of bad holdouts rejected counts, less
    ``price`` times the share of good ones, and the most lenient of equals.
    """
    all_good, all_bad = sum(good), sum(bad)
    best, most, good_gone, bad_gone = 0, 0.0, 0, 0
    for step in range(1, len(good)):
        good_gone, bad_gone = good_gone + good[step], bad_gone + bad[step]
        if binomial_tail(good_gone, all_good, risk) > error:
            break
        gain = bad_gone / max(all_bad, 1) - price * good_gone / max(all_good, 1)
        if gain > most:
            best, most = step, gain
    return best


def choose_cutoffs(
    rated: DataFrame, labels: DataFrame, risk: float = 0.02, error: float = 0.05, price: float = 5.0
) -> DataFrame:
    """Cutoffs of each stratum with holdouts: stratum and one double column per rule.

    Holdouts are the labelled documents that pass the floor.  All rules of a stratum
    make one region that grows along a :func:`ladder`, and ``risk`` bounds the share of
    good documents in it; ``error``, the chance that the bound of any stratum is wrong,
    is shared by the strata (Bonferroni).  The first step can pass with
    log(error / strata) / log(1 - risk) good holdouts, 217 for four strata; a stratum
    with fewer gets cutoffs of 1, which reject nobody.  What is grouped are counts by
    stratum, rule and level, and by stratum and step, however many documents there are.
    """
    marked = labels.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.min("quality").alias("_good"))
    known = rated.where(~F.col("base_failed")).join(marked, "doc_id", "left")
    levels = {rule: F.least(F.ceil(F.col(rule) * LEVELS), F.lit(LEVELS)).cast("int") for rule in RULES}
    known = stored(known.select("stratum", F.when(F.col("_good").isin(0, 1), F.col("_good")).alias("_good"), *[c.alias(r) for r, c in levels.items()]))
    level = [F.struct(F.lit(rule).alias("rule"), F.col(rule).alias("level")) for rule in RULES]
    told = known.where("_good is null or _good = 0").select("stratum", "_good", F.explode(F.array(*level)).alias("x"))
    counts = told.groupBy("stratum", "x.rule", "x.level", "_good").agg(F.count("*").alias("n"))
    strata = known.where("_good is not null").select("stratum").distinct()
    each = error / max(1, strata.count())

    def steps(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        by_level = {good: {rule: [0] * (LEVELS + 1) for rule in RULES} for good in (True, False)}
        for rule, at, good, n in zip(rows["rule"], rows.level, rows["_good"], rows.n, strict=True):
            by_level[good == 0][rule][int(at)] += int(n)
        return pd.DataFrame({"stratum": [key[0]], **{rule: [cuts] for rule, cuts in ladder(by_level[True], by_level[False]).items()}})

    kinds = ", ".join(f"{rule} array<int>" for rule in RULES)
    ladders = counts.join(strata, "stratum", "left_semi").groupBy("stratum").applyInPandas(steps, f"stratum string, {kinds}")
    ladders = stored(ladders.select("stratum", *[F.col(rule).alias(f"_{rule}") for rule in RULES]))
    # cutoffs fall along a ladder: a rule first rejects after all steps whose cutoff is not below the level
    first = F.least(*[F.expr(f"size(filter(_{rule}, cut -> cut >= {rule}))") for rule in RULES])
    held = known.where("_good is not null").join(ladders, "stratum")
    rejected = held.select("stratum", "_good", first.alias("step")).groupBy("stratum", "_good", "step").agg(F.count("*").alias("n"))
    rejected = rejected.join(ladders.select("stratum", F.size(f"_{RULES[0]}").alias("steps")), "stratum")

    def of_stratum(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        by_step = {1: [0] * (int(rows.steps.iloc[0]) + 1), 0: [0] * (int(rows.steps.iloc[0]) + 1)}
        for good, at, n in zip(rows["_good"], rows.step, rows.n, strict=True):
            by_step[int(good)][int(at)] += int(n)
        all_good = sum(by_step[1])
        good, bad = by_step[1][:-1], by_step[0][:-1]
        good[0] += all_good - sum(good)  # those that no step rejects stand beside those of step 0, which is none
        bad[0] += sum(by_step[0]) - sum(bad)
        return pd.DataFrame({"stratum": [key[0]], "step": [chosen_step(good, bad, risk, each, price)]})

    chosen = rejected.groupBy("stratum").applyInPandas(of_stratum, "stratum string, step int")
    cut = [(F.get(f"_{rule}", F.col("step")) / float(LEVELS)).alias(rule) for rule in RULES]
    return chosen.join(ladders, "stratum").select("stratum", *cut)


def judged(rated: DataFrame, cutoffs: DataFrame) -> DataFrame:
    """Rated documents with the cutoffs of their stratum and ``kept``."""
    cut = cutoffs.select("stratum", *[F.col(rule).alias(f"max_{rule}") for rule in RULES])
    broken = F.lit(False)
    for rule in RULES:
        above = F.ceil(F.col(rule) * LEVELS) > F.round(F.col(f"max_{rule}") * LEVELS)
        broken = broken | F.coalesce(above, F.lit(False))
    return rated.join(cut, "stratum", "left").withColumn("kept", ~F.col("base_failed") & ~broken)


def quality_verdicts(
    docs: DataFrame, labels: DataFrame, stratum: str | None = "lang", risk: float = 0.02, error: float = 0.05
) -> DataFrame:
    """Counts, base_failed and kept of each document.

    ``docs`` has doc_id and text; further columns are ignored.  Rows of an id that
    comes twice are judged one by one.  A null text has no words and fails the floor;
    a stratum without holdouts is judged by the floor alone, and null counts as a
    stratum.  Empty tables give an empty result.
    """
    rated = with_rates(stored(document_stats(docs, stratum)))
    return judged(rated, choose_cutoffs(rated, labels, risk, error))


def quality_filter(
    docs: DataFrame, labels: DataFrame, stratum: str | None = "lang", risk: float = 0.02, error: float = 0.05
) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns."""
    rated = with_rates(stored(document_stats(docs, stratum)))
    cutoffs = stored(choose_cutoffs(rated, labels, risk, error))
    rows = judged(with_rates(document_stats(docs, stratum, whole_row=True)), cutoffs)
    return rows.where("kept").select("row.*")
