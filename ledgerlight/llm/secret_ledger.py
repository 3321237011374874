"""Secrets in every version of every path, each distinct text scanned once for each version of a rule."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.llm.common import slices, stored, text_bytes

#: A text that more than one in so many rows hold is hot; there are fewer such texts than this.
HOT_SHARE = 1000
#: Rows of a hot text that one task joins.
ROWS_A_PART = 20_000
#: Bytes of text that a task scans at once.
AT_ONCE = 1 << 21
FINDINGS = "array<struct<rule:string,kind:string,start:bigint,end:bigint>>"
LEDGER = f"blob binary, rules array<string>, findings {FINDINGS}"


@dataclass(frozen=True)
class Rule:
    """A pattern over UTF-8 bytes; matches whose ``group`` has fewer than ``least`` characters are dropped.

    A change of the pattern needs a new ``version``: the ledger knows rules by both.
    Patterns run to the end of what they match, so that a search is linear.
    """

    kind: str
    version: int
    pattern: bytes
    least: int
    group: int = 0
    either_case: bool = False

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"

    def spans(self, text: bytes) -> list[tuple[int, int]]:
        found = re.finditer(self.pattern, text, re.IGNORECASE if self.either_case else 0)
        return [m.span() for m in found if m.end(self.group) - m.start(self.group) >= self.least]


# The forms of secrets.
ASSIGN = rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = (
    Rule("assign", 1, ASSIGN, 8, group=2, either_case=True),
    Rule("access", 1, rb"AKIA[A-Z0-9]+", 16),
    Rule("hex", 1, rb"[0-9a-f]{32,}", 32),
)
MORE = (
    Rule("pem", 1, rb"-----BEGIN [A-Z ]*PRIVATE KEY-----[A-Za-z0-9+/=\x20\x09-\x0D]*", 64),
    Rule("bearer", 1, rb"[Bb]earer\x20[A-Za-z0-9._~+/=-]+", 32),
    Rule("forge", 1, rb"gh[pousr]_[A-Za-z0-9]+", 40),
)


def in_characters(text: bytes, spans: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of bytes as spans of code points; one pass over the text."""
    at, upto, places = 0, 0, {}
    for place in sorted({p for span in spans for p in span}):
        upto += len(text[at:place].decode("utf-8", "replace"))
        at = place
        places[place] = upto
    return [(places[a], places[b]) for a, b in spans]


def _scanned(rules: Sequence[Rule]):
    kinds = pa.list_(
        pa.struct([("rule", pa.string()), ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    )

    def of_text(text: bytes, todo: list[str]) -> list[dict]:
        found = []
        for rule in rules:
            if rule.key in todo:
                spans = in_characters(text, rule.spans(text))
                found += [{"rule": rule.key, "kind": rule.kind, "start": a, "end": b} for a, b in spans]
        return found

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", AT_ONCE):
            todo = batch.column("rules").to_pylist()
            found = [of_text(t, r) for t, r in zip(text_bytes(batch.column("text")), todo, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("blob"), batch.column("rules"), pa.array(found, kinds)], names=["blob", "rules", "findings"]
            )

    return emit


def address(text: Column) -> Column:
    """What a text is stored under: the sha256 of its UTF-8; null text is empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """(blob, rules, findings, load) of all loads; none before the first."""
    try:
        return spark.read.schema(f"{LEDGER}, load int").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{LEDGER}, load int")


def unseen(versions: DataFrame, ledger: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(blob, text, rules) of each distinct text that the ledger lacks a rule of: the rules it lacks.

    ``versions`` has blob and text.  Copies meet in their own task first, so that at most
    one text of each task and blob is shuffled.
    """
    wanted = F.array(*[F.lit(rule.key) for rule in rules])
    texts = versions.groupBy("blob").agg(F.first("text").alias("text"))
    seen = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("_seen"))
    todo = F.array_except(wanted, F.coalesce("_seen", F.array().cast("array<string>")))
    return texts.join(seen, "blob", "left").select("blob", "text", todo.alias("rules")).where(F.size("rules") > 0)


def record(versions: DataFrame, path: str, rules: Sequence[Rule], load: int) -> None:
    """Scan what the ledger at ``path`` has not seen and write it there under ``load``.

    A load that is repeated replaces what it has written, and reads the ledger of the
    other loads alone.
    """
    spark = versions.sparkSession
    others = read_ledger(spark, path).where(F.col("load") != load)
    found = unseen(versions, others, rules).mapInArrow(_scanned(rules), LEDGER)
    found.write.mode("overwrite").parquet(f"{path}/load={load}")


def findings_of(ledger: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(blob, findings) under the given rules, where there are any; in the order of start, rule, end."""
    order = F.create_map(*[F.lit(x) for k, rule in enumerate(rules) for x in (rule.key, k)])
    keys = [rule.key for rule in rules]
    own = F.filter("findings", lambda x: x["rule"].isin(keys))
    sort = F.transform(own, lambda x: F.struct(x["start"].alias("start"), order[x["rule"]].alias("k"), x["end"].alias("end"), x["kind"].alias("kind")))
    some = ledger.select("blob", sort.alias("f")).where(F.size("f") > 0)
    # scanned twice where a load was repeated under another number: told once
    found = some.groupBy("blob").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("f")))).alias("f"))
    return found.select(
        "blob", F.transform("f", lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))).alias("findings")
    )


def scan_history(versions: DataFrame, path: str, rules: Sequence[Rule] = BASE + MORE, load: int = 0) -> DataFrame:
    """(row, blob, findings) of every version: its columns but the text, its address and what was found in it.

    ``versions`` has a ``text`` and any columns, of any names, that tell paths and
    versions.  Each text is addressed by its content, and only texts that the ledger at
    ``path`` (in a shared folder) lacks a version of a rule for are scanned, by the rules
    that it lacks; findings are then joined back to all rows.  A finding is (kind, start,
    end) in code points, by start, then by the order of ``rules``.

    Null text is empty; a row without findings has an empty list; rows that repeat are
    kept; an empty table gives an empty result and an empty load.  Texts are scanned
    whole.  A text of very many rows is split over many tasks in the last join: the
    texts of more than one in HOT_SHARE rows, fewer than HOT_SHARE of them, are known to
    every task.
    """
    spark = versions.sparkSession
    kept = [F.col(f"`{c}`") for c in versions.columns if c != "text"]
    record(versions.select(address(F.col("text")).alias("blob"), F.col("text").cast("string").alias("text")), path, rules, load)
    rows = stored(versions.select(F.struct(*kept).alias("row"), address(F.col("text")).alias("blob")))

    copies = rows.groupBy("blob").agg(F.count("*").alias("n"))
    total = rows.count()
    parts = F.ceil(F.col("n") / ROWS_A_PART).cast("int").alias("parts")
    hot = stored(copies.where(F.col("n") * HOT_SHARE > total).select("blob", parts))
    found = findings_of(read_ledger(spark, path), rules).join(F.broadcast(hot), "blob", "left")
    found = found.select("blob", "findings", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part"))
    place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.coalesce("parts", F.lit(1))).cast("int")
    spread = rows.join(F.broadcast(hot), "blob", "left").select("row", "blob", place.alias("part"))
    nothing = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    return spread.join(found, ["blob", "part"], "left").select("row", "blob", F.coalesce("findings", nothing).alias("findings"))


def as_text(findings: Column) -> Column:
    """kind:start:end of each finding, joined by commas."""
    told = F.transform(findings, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")))
    return F.array_join(told, ",")
