"""Mixing sources to target weights by Efraimidis-Spirakis sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.common import WORD, prefix_sums, stored

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (1, 2, 3)
#: A source gives at most so many times its size, a document too.
MOST_EPOCHS = 3
SEED = 11


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("bigint"), F.lit(0).cast("bigint"))


def text_quality(text: Column) -> Column:
    """Between 0.25 and 1: less where more of the characters are symbols."""
    chars = F.greatest(F.length(text), F.lit(1))
    symbols = F.length(text) - F.length(F.translate(text, "#*$%&|<>{}", ""))
    return F.coalesce(F.greatest(F.lit(0.25), 1 - 5 * symbols / chars), F.lit(0.25))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """source, source_size and target of each row of (source, source_size).

    All words are shared by weight.  A target that is above ``most`` times the size of
    its source stops there, and what that frees is shared anew among the others, until
    none is above.  Each round is an aggregate; only sums reach the driver.
    """
    named = sizes.select("source", F.col("source_size").cast("bigint"), F.col("source").isNull().alias("last"), F.lit(1).alias("one"))
    ranked = prefix_sums(stored(named), [], ["last", "source"], "one", "rank")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    ranked = stored(
        ranked.select(
            "source",
            "source_size",
            F.element_at(cycle, (F.col("rank") % len(weights) + 1).cast("int")).alias("weight"),
            (F.col("source_size") * most).cast("double").alias("ceiling"),
        )
    )
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, full = None, None
    while True:
        above = F.lit(False) if level is None else F.col("weight") * level > F.col("ceiling")
        held, weight, count = ranked.agg(
            F.sum(F.when(above, F.col("ceiling")).otherwise(0.0)),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))),
            F.count(F.when(above, 1)),
        ).first()
        if count == full or not weight:
            break
        level, full = (total - held) / weight, count
    share = F.lit(0.0) if level is None else F.least(F.col("weight") * level, F.col("ceiling"))
    return ranked.select("source", "source_size", share.alias("target"))


def mixed(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_EPOCHS,
    quality: Column | None = None,
    seed: int = SEED,
    row: str | None = None,
) -> DataFrame:
    """What a mix takes of each row of ``docs``: doc_id, source and ``same``, a hash of the text.

    Further columns: size (words), source_size, target (of the source), epochs (times
    the whole document is taken) and rest (words of the last, partial epoch; at most
    the size).  A source whose target is n times its size and a bit gives n whole
    epochs first.  For the bit its documents come in the order of exponential keys
    -ln(u) / quality, u drawn from the id, the text and ``seed``, so a rerun agrees; the
    document in which the budget ends gives the words up to there.  Null text has no
    words and gives none, a null source is a source and comes last, and rows of one id
    are drawn one by one (rows that are equal in id and text in an order of no
    consequence).  ``row`` names a column of ``docs`` that tells such rows apart, and
    comes back as ``row``; columns but it, doc_id, source and text are ignored.  An empty
    table gives an empty result.

    The prefix sums run over ranges of (source, key): a source with a third of all
    rows spreads over a third of the tasks.
    """
    quality = text_quality(F.col("text")) if quality is None else quality
    drawn = (F.xxhash64("doc_id", "text", F.lit(seed)).bitwiseAND((1 << 52) - 1) + 0.5) / float(1 << 52)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("source").cast("string").alias("source"),
        word_count(F.col("text")).alias("size"),
        (-F.ln(drawn) / quality).alias("key"),
        F.xxhash64("text").alias("same"),
        *([] if row is None else [F.col(row).alias("row")]),
    )
    rows = stored(rows)
    by_source = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    order = ["key", "doc_id", "same"] + ([] if row is None else ["row"])
    placed = prefix_sums(rows, ["source"], order, "size", "before")
    by_source = by_source.withColumnRenamed("source", "_source")
    placed = placed.join(by_source, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    placed = placed.withColumn("epochs", epochs.cast("bigint"))
    budget = F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("bigint")
    rest = F.greatest(F.lit(0), F.least(F.col("size"), budget - F.col("before")))
    return placed.withColumn("rest", rest.cast("bigint")).drop("key", "before")


def taken(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target and taken, the words that the mix takes."""
    rows = mixed(docs, **options)
    words = F.col("epochs") * F.col("size") + F.col("rest")
    return rows.select("doc_id", "size", "source_size", "target", words.alias("taken"), "epochs", "rest")


def remixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them.

    A whole epoch repeats the row.  The document in which a budget ends comes whole when
    the budget has room for half of it or more, and not otherwise: texts are not cut.
    Rows of one id and text are taken as the mix says of each.
    """
    names = [f"_{k}" for k in range(len(docs.columns))]
    own = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names, strict=True)])
    own = stored(own.withColumn("_row", F.monotonically_increasing_id()))
    known = {c: F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True) if c in ("doc_id", "source", "text")}
    rows = mixed(own.select(*known.values(), "_row"), row="_row", **options)
    part = F.when((F.col("rest") > 0) & (2 * F.col("rest") >= F.col("size")), 1).otherwise(0)
    rows = rows.select(F.col("row").alias("_taken"), (F.col("epochs") + part).cast("int").alias("_copies")).where("_copies > 0")
    found = own.join(rows, F.col("_row") == F.col("_taken")).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return found.select(*[F.col(n).alias(c) for c, n in zip(docs.columns, names, strict=True)])
