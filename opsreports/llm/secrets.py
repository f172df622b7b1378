"""Secret scanning with an incremental ledger of content-addressed blobs. DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opsreports.llm.common import settle


@dataclass(frozen=True)
class Rule:
    """A kind of secret: a pattern, its least length (of ``group``), and a text without which it can't match."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    needs: str | None = None


# The three base kinds, in the order in which spans of one start are listed.
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20, 0, "AKIA"),
    # A run of hex digits is matched from its start to its end, so the least length can be in the pattern.
    Rule("hex", r"[0-9a-f]{24,}", 24),
)
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0, "PRIVATE KEY-----"),
    Rule("forge", r"\bgh[opsru]_[A-Za-z0-9]{36,}", 0, 0, "gh"),
    Rule("webtoken", r"\beyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 0, "eyJ"),
)
RULES = (*BASE, *MORE)
RULE_VERSION = "1"
FINDING = "blob string, kind string, rank int, start long, end long"


def address(text: Column) -> Column:
    """The content address of a text; null counts as empty."""
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def find(blobs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Findings (blob, kind, rank, start, end) in rows (blob, text): code points, end exclusive, leftmost non-overlapping per kind.

    A text is split by the pattern; the lengths of what lies between the matches and of the matches add
    up to their places, by a running sum within the blob.
    """
    out = None
    for rank, rule in enumerate(rules):
        rows = blobs if rule.needs is None else blobs.where(F.contains("text", F.lit(rule.needs)))
        pattern = F.lit(rule.pattern)
        hits = rows.select("blob", "text", F.regexp_extract_all("text", pattern, F.lit(rule.group)).alias("judged")).where(F.size("judged") > 0)
        whole = F.col("judged") if rule.group == 0 else F.regexp_extract_all("text", pattern, F.lit(0))
        lengths = F.arrays_zip(
            F.transform(F.split("text", rule.pattern, -1), F.length).alias("between"),
            F.transform(whole, F.length).alias("own"), F.transform("judged", F.length).alias("judged"),
        )
        each = hits.select("blob", F.posexplode(lengths).alias("at", "n")).where("n.own IS NOT NULL")
        before = F.sum(F.col("n.between") + F.col("n.own")).over(Window.partitionBy("blob").orderBy("at"))
        found = each.select("blob", before.alias("end"), F.col("n.own").alias("own"), F.col("n.judged").alias("judged")).where(F.col("judged") >= rule.least)
        found = found.select(
            "blob", F.lit(rule.kind).alias("kind"), F.lit(rank).alias("rank"), (F.col("end") - F.col("own")).alias("start"), F.col("end").cast("long").alias("end"),
        )
        out = found if out is None else out.union(found)
    return out


class BlobLedger:
    """What has been scanned under which version of the rules, and what was found, as parquet below ``path``.

    Both tables are only appended to, findings first; a run that dies between the two is repeated by the next,
    and readers drop the repeats.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _read(self, name: str, schema: str) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        there = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}") if there else self.spark.createDataFrame([], schema)

    def scanned(self) -> DataFrame:
        return self._read("scanned", "blob string, rule_version string").distinct()

    def findings(self) -> DataFrame:
        return self._read("findings", f"{FINDING}, rule_version string").distinct()

    def update(self, df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES, version: str = RULE_VERSION) -> int:
        """Scans the blobs of ``df`` not yet scanned under ``version``; returns how many these were.

        One row that holds a blob lends its text (the one with the smallest id; null last). Null and empty
        texts are blobs without findings.
        """
        rows = df.select(F.col(id_col).alias("id"), address(F.col(text_col)).alias("blob"), F.col(text_col).alias("text"))
        done = self.scanned().where(F.col("rule_version") == version).select("blob")
        holders = settle(
            rows.groupBy("blob").agg(F.min("id").alias("holder")).join(done, "blob", "left_anti"), "unseen"
        )
        held = (rows["blob"] == holders["blob"]) & rows["id"].eqNullSafe(holders["holder"])
        texts = rows.where(F.length("text") > 0).join(holders.hint("shuffle_merge"), held, "left_semi").select("blob", "text").dropDuplicates(["blob"])
        find(texts, rules).withColumn("rule_version", F.lit(version)).write.mode("append").parquet(f"{self.path}/findings")
        holders.select("blob", F.lit(version).alias("rule_version")).write.mode("append").parquet(f"{self.path}/scanned")
        return holders.count()

    def spans(self, df: DataFrame, id_col: str = "doc_id", text_col: str = "text", version: str = RULE_VERSION) -> DataFrame:
        """Rows (id, spans array<struct<start, rank, kind, end>>), one per row of ``df``: its blob's findings, in order of start, then rank.

        Rows whose blob was never scanned get null; blobs without findings an empty list.
        """
        listed = self.findings().where(F.col("rule_version") == version).groupBy("blob").agg(
            F.sort_array(F.collect_list(F.struct("start", "rank", "kind", "end"))).alias("found")
        )
        seen = self.scanned().where(F.col("rule_version") == version).select("blob", F.lit(True).alias("seen"))
        paths = df.select(F.col(id_col).alias("id"), address(F.col(text_col)).alias("blob"))
        none = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
        return paths.join(seen.join(listed, "blob", "left"), "blob", "left").select(
            F.col("id").alias(id_col), F.when(F.col("seen"), F.coalesce("found", none)).alias("spans")
        )


def joined(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
