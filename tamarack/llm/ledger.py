"""Secret scans with an incremental blob ledger, in DataFrame operations only.

Every version of a text is addressed by its SHA-256. The ledger names the (blob, rule, rule version) triples that have been
scanned; a run scans only blobs with unseen triples, each blob once however many paths hold it, appends its findings and the
triples, and joins all findings back to every path. Regular expressions give no positions in SQL, so a text is split at the
matches: the lengths of the pieces and of the matches, summed up in order, are the positions in code points.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tamarack.llm.common import new_path, written


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``regex`` finds leftmost non-overlapping matches, ``hint`` is true for every text with one;
    a match counts when group ``group`` has ``least`` characters or more. A change asks for a new ``version``."""

    kind: str
    version: int
    regex: str
    group: int
    least: int
    hint: str


#: Fixed values of the query's contract; the order is the order of kinds.
RULES = (
    Rule(
        "assign",
        1,
        r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
        r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        6,
        r"([Ww][Dd]|[Oo][Rr][Dd]|[Rr][Ee][Tt]|[Kk][Ee][NnYy])[\"']?\x20*[:=]",
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20, r"AKIA[A-Z0-9]{16}"),
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24, r"[0-9a-f]{24}"),
)


def blob_id(text: Column) -> Column:
    """Content address of a text; null counts as the empty text."""
    return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)


def _hits(rule: Rule) -> Column:
    """Length of the text before each match since the last one, the match's length, and whether it counts."""
    pattern = F.lit(rule.regex)
    before = F.transform(F.split("text", rule.regex, -1), lambda s: F.length(s))
    whole = F.transform(F.regexp_extract_all("text", pattern, 0), lambda s: F.length(s))
    part = whole if rule.group == 0 else F.transform(F.regexp_extract_all("text", pattern, rule.group), lambda s: F.length(s))
    zipped = F.arrays_zip(before, whole, part)  # the text after the last match has no match beside it
    found = F.transform(
        zipped,
        lambda h: F.struct(
            F.lit(rule.kind).alias("kind"),
            F.lit(rule.version).alias("version"),
            h["0"].alias("before"),
            h["1"].alias("size"),
            h["2"].alias("part"),
        ),
    )
    none = F.array().cast("array<struct<kind:string,version:int,before:int,size:int,part:int>>")
    return F.when(F.array_contains("pending", f"{rule.kind}:{rule.version}") & F.rlike("text", F.lit(rule.hint)), found).otherwise(none)


def find_secrets(blobs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Findings of the pending rules in each row of (blob, text, pending): blob, kind, version, start, stop (exclusive)."""
    hits = F.concat(*[_hits(r) for r in rules])
    flat = blobs.select("blob", F.posexplode(hits).alias("at", "hit")).where(F.col("hit.size").isNotNull())
    passed = W.partitionBy("blob", "hit.kind").orderBy("at")
    flat = flat.withColumn("stop", F.sum(F.col("hit.before") + F.col("hit.size")).over(passed))
    least = F.lit(0)
    for r in rules:
        least = F.when(F.col("hit.kind") == r.kind, F.lit(r.least)).otherwise(least)
    return flat.where(F.col("hit.part") >= least).select(
        "blob",
        F.col("hit.kind").alias("kind"),
        F.col("hit.version").alias("version"),
        (F.col("stop") - F.col("hit.size")).alias("start"),
        "stop",
    )


class BlobLedger:
    """A ledger in a folder that all executors reach: what has been scanned, and all findings.

    The tables only grow. Findings are written before the triples that vouch for them, so a run that is lost between the two is
    repeated, and repeated findings are dropped on reading.
    """

    def __init__(self, spark, folder: str | None = None):
        self.spark = spark
        self.folder = folder or new_path(spark, "ledger")

    def _read(self, name: str, schema: str) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        there = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)
        return self.spark.read.schema(schema).parquet(f"{self.folder}/{name}") if there else self.spark.createDataFrame([], schema)

    def seen(self) -> DataFrame:
        return self._read("seen", "blob string, rule string")

    def findings(self) -> DataFrame:
        return self._read("findings", "blob string, kind string, version int, start long, stop long").distinct()

    def scan(self, versions: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> None:
        """Scan what is new in ``versions``, one row per path and historical version."""
        content = versions.select(blob_id(F.col(text)).alias("blob"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        blobs = content.groupBy("blob").agg(F.first("text").alias("text"))
        active = F.array(*[F.lit(f"{r.kind}:{r.version}") for r in rules])
        seen = self.seen().groupBy("blob").agg(F.collect_set("rule").alias("known"))
        pending = F.coalesce(F.array_except(active, F.col("known")), active)
        unseen = blobs.join(seen, "blob", "left").select("blob", "text", pending.alias("pending")).where(F.size("pending") > 0)
        find_secrets(unseen, rules).write.mode("append").parquet(f"{self.folder}/findings")
        triples = content.select("blob").distinct().select("blob", F.explode(active).alias("rule"))
        triples.join(self.seen(), ["blob", "rule"], "left_anti").write.mode("append").parquet(f"{self.folder}/seen")


def spans_by_blob(findings: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per blob with findings of the active rule versions: its spans in order, and the counts per kind."""
    order = F.lit(None).cast("int")
    for n, r in enumerate(rules):
        order = F.when((F.col("kind") == r.kind) & (F.col("version") == r.version), F.lit(n)).otherwise(order)
    rows = findings.withColumn("order", order).where(F.col("order").isNotNull())
    return rows.groupBy("blob").agg(
        F.array_sort(F.collect_list(F.struct("start", "order", "stop", "kind"))).alias("found"),
        *[F.count(F.when(F.col("kind") == r.kind, 1)).alias(f"n_{r.kind}") for r in rules],
    )


def scan_documents(
    docs: DataFrame, ledger: BlobLedger | None = None, rules: Sequence[Rule] = RULES, text: str = "text"
) -> DataFrame:
    """Scan ``docs`` through the ledger and add to every row: blob, found (array of start, order, stop, kind) and n_<kind>.

    A null text is empty and has no findings. Equal texts share one scan. Existing columns of the added names are replaced; an
    empty table gives an empty result. Without a ledger a new one is begun in the shared folder.
    """
    ledger = ledger or BlobLedger(docs.sparkSession)
    kept = docs.drop("blob", "found", *[f"n_{r.kind}" for r in rules])
    ledger.scan(kept, rules, text)
    spans = written(spans_by_blob(ledger.findings(), rules), "spans")
    out = kept.withColumn("blob", blob_id(F.col(text))).join(spans, "blob", "left")
    empty = F.array().cast(spans.schema["found"].dataType)
    return out.withColumns(
        {"found": F.coalesce("found", empty), **{f"n_{r.kind}": F.coalesce(f"n_{r.kind}", F.lit(0).cast("long")) for r in rules}}
    ).select(*kept.columns, "blob", "found", *[f"n_{r.kind}" for r in rules])


def span_text(found: str = "found") -> Column:
    """kind:start:end of the spans, comma-joined."""
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ","
    )


def masked(text: str = "text", found: str = "found", mask: str = "[SECRET]") -> Column:
    """The text with every found span replaced by ``mask``; overlapping spans are masked as one."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc, s):
        gap = F.substring(F.col(text), acc["at"].cast("int") + 1, (s["start"] - acc["at"]).cast("int"))
        fresh = s["start"] >= acc["at"]
        return F.struct(
            F.greatest(acc["at"], s["stop"]).alias("at"),
            F.when(fresh, F.concat(acc["out"], F.array(gap, F.lit(mask)))).otherwise(acc["out"]).alias("out"),
        )

    def finish(acc):
        rest = F.substring(F.col(text), acc["at"].cast("int") + 1, F.length(text))
        return F.concat(F.array_join(acc["out"], ""), rest)

    return F.when(F.size(found) > 0, F.aggregate(found, start, step, finish)).otherwise(F.col(text))
