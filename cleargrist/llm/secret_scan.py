"""Secret scans over an incremental blob ledger, with built-in expressions only.

A version of a file is a path and a text; its blob is the SHA-256 of the text. The ledger has, for
each blob, which rules (with their versions) have been run over it and what they found. A scan
runs only the pairs of blob and rule that the ledger lacks, each over one copy of the blob, and
appends what it did; findings are then joined back to every path of every version.

Positions come from the pieces around the matches: ``split`` and ``regexp_extract_all`` with one
pattern give pieces and matches in turn, and their lengths add up to code-point offsets.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cleargrist.llm.tables import sized, stored


@dataclass(frozen=True)
class Rule:
    """What to look for. A change of a rule needs a new version, or old blobs are not rescanned.

    Matches are the leftmost non-overlapping ones of ``pattern``; those whose ``group`` has fewer
    than ``min_chars`` code points are dropped. ``hint`` is a text without which there is no match.
    """

    kind: str
    pattern: str
    group: int = 0
    min_chars: int = 0
    hint: str | None = None
    version: int = 1

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


# The base rules, and further ones for well-known kinds of secrets.
BASE_RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        min_chars=6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", min_chars=20, hint="AKIA"),
    # Shorter runs cannot hold a longer match, so the length may stand in the pattern.
    Rule("hex", r"[0-9a-f]{24,}+"),
)
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", hint="PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}+", hint="gh"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}+\.eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+", hint="eyJ"),
)
RULES = BASE_RULES + MORE_RULES

_SPANS = "array<struct<rule:string,start:int,end:int>>"
_COLUMNS = (("blob", "binary"), ("rules", "array<string>"), ("spans", _SPANS))


# So many matches are positioned at a time, as arrays that grow are copied at every step.
_STRETCH = 256


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body has it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _placed(items: Column, rule: Rule) -> Column:
    """Spans of (piece, match, kept) in turn: running sums within stretches, then of stretches."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))

    def step(done: Column, item: Column) -> Column:
        begin = done["at"] + F.length(item["piece"])
        end = begin + F.length(item["match"])
        span = F.struct(F.lit(rule.name).alias("rule"), begin.alias("start"), end.alias("end"))
        spans = F.when(
            F.length(item["kept"]) >= rule.min_chars, F.concat(done["spans"], F.array(span))
        ).otherwise(done["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    def stretches(own: Column) -> Column:
        last = F.floor((F.size(own) - 1) / _STRETCH).cast("int")
        return F.transform(
            F.sequence(F.lit(0), last),
            lambda k: F.aggregate(F.slice(own, k * _STRETCH + 1, _STRETCH), start, step),
        )

    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("offsets"))

    def pass_on(done: Column, part: Column) -> Column:
        offsets = F.concat(done["offsets"], F.array(done["at"]))
        return F.struct((done["at"] + part["at"]).alias("at"), offsets.alias("offsets"))

    def shifted(parts: Column, offsets: Column) -> Column:
        def one(part: Column, k: Column) -> Column:
            by = F.get(offsets, k)
            return F.transform(
                part["spans"],
                lambda s: F.struct(s["rule"], (s["start"] + by).alias("start"), (s["end"] + by).alias("end")),
            )

        return F.flatten(F.transform(parts, one))

    def whole(parts: Column) -> Column:
        offsets = F.aggregate(parts, first, pass_on, lambda done: done["offsets"])
        return _bound(offsets, lambda o: shifted(parts, o))

    return _bound(items, lambda own: _bound(stretches(own), whole))


def find(rule: Rule, text: Column) -> Column:
    """Spans of one rule in a text, an array of (rule, start, end) in order; null for none.

    The time is all but in proportion to the number of matches, whatever their number.
    """
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    pieces = F.split(text, rule.pattern, -1)
    kept = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else matches
    items = F.arrays_zip(
        F.slice(pieces, 1, F.size(matches)).alias("piece"), matches.alias("match"), kept.alias("kept")
    )
    there = F.rlike(text, pattern)
    if rule.hint:
        there = F.contains(text, F.lit(rule.hint)) & there
    return F.when(there, _placed(items, rule))


def _part(blob: Column) -> Column:
    """The folder of the ledger that a blob is in, by its first four bits."""
    return F.substring(F.hex(blob), 1, 1)


@dataclass(frozen=True)
class Ledger:
    """The ledger at a path: rows (blob, rules, spans), a row for each scan of a blob.

    They lie in 16 folders by the blob's first digit. A scan opens only the folders of its own
    blobs, and leaves all other blobs' rows behind before it shuffles anything.
    """

    spark: SparkSession
    path: str

    def create(self) -> None:
        """Write an empty ledger, unless there is one."""
        none = self.spark.range(0).selectExpr(*(f"cast(null as {t}) as {c}" for c, t in _COLUMNS))
        none.withColumn("part", F.lit("0")).write.partitionBy("part").mode("ignore").parquet(self.path)

    def append(self, scanned: DataFrame) -> None:
        dealt = scanned.withColumn("part", _part(F.col("blob"))).hint("rebalance", "part")
        dealt.write.partitionBy("part").mode("append").parquet(self.path)

    def table(self) -> DataFrame:
        schema = ", ".join(f"{c} {t}" for c, t in (*_COLUMNS, ("part", "string")))
        return self.spark.read.schema(schema).parquet(self.path)

    def about(self, blobs: DataFrame) -> DataFrame:
        """The rows of some blobs, a stored table without repeats."""
        parts = [r[0] for r in blobs.select(_part(F.col("blob"))).distinct().collect()]  # 16 at most
        rows = self.table().filter(F.col("part").isin(parts)).drop("part")
        return rows.join(sized(blobs.withColumnRenamed("blob", "own"), 48), F.col("blob") == F.col("own")).drop("own")

    def scanned(self, blobs: DataFrame) -> DataFrame:
        """(blob, done): the rules that have been run over each of some blobs."""
        runs = self.about(blobs).groupBy("blob")
        return runs.agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("done"))

    def findings(self, rules: Sequence[Rule], blobs: DataFrame) -> DataFrame:
        """(blob, spans): what these versions of the rules found in some blobs, if anything."""
        scans = self.about(blobs).filter(F.size("spans") > 0).groupBy("blob")
        scans = scans.agg(F.collect_list(F.struct("rules", "spans")).alias("scans"))

        def own(rule: Rule, rank: int) -> Column:
            # A retried or concurrent scan may have entered a pair twice; it found the same.
            having = F.filter("scans", lambda s: F.array_contains(s["rules"], F.lit(rule.name)))
            spans = F.filter(F.get(having, F.lit(0))["spans"], lambda s: s["rule"] == rule.name)
            listed = F.transform(
                spans, lambda s: F.struct(s["start"], F.lit(rank).alias("rank"), s["end"], s["rule"])
            )
            none = F.array().cast("array<struct<start:int,rank:int,end:int,rule:string>>")
            return F.coalesce(listed, none)

        all_spans = F.flatten(F.array(*(own(rule, i) for i, rule in enumerate(rules))))
        found = scans.select("blob", F.array_sort(all_spans).alias("spans")).filter(F.size("spans") > 0)
        plain = F.transform(
            "spans",
            lambda s: F.struct(
                F.substring_index(s["rule"], "@", 1).alias("kind"), s["start"], s["end"]
            ),
        )
        return found.select("blob", plain.alias("spans"))


def scan_versions(
    versions: DataFrame,
    ledger_path: str,
    rules: Sequence[Rule] = RULES,
    path_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per version: path, ``blob`` (hex) and ``spans``, an array of (kind, start, end).

    Spans are in order of start, then of the rules as listed; offsets count code points, end
    exclusive. A null text counts as empty. A null path and repeated rows are versions like any
    other, and get the findings of their blob; an empty table gives an empty table; columns other
    than the two named are not read. If the scan fails, the ledger is as it was, and a later scan
    does what is missing.
    """
    spark = versions.sparkSession
    ledger = Ledger(spark, ledger_path)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    texts = versions.select(F.col(f"`{path_col}`").alias("path"), text.alias("text"))
    blob = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    paths = stored(texts.select("path", blob.alias("blob")), "versions")

    # A blob is scanned where its smallest path has it; a null path counts as the largest. The
    # rules that it lacks are a bit set.
    ledger.create()
    first = F.min_by("path", F.struct(F.col("path").isNull(), "path")).alias("at")
    own = stored(paths.groupBy("blob").agg(first), "blobs")
    blobs = own.select("blob")
    todo = own.join(ledger.scanned(blobs), "blob", "left")
    lacks = [
        F.when(F.array_contains("done", F.lit(r.name)), 0).otherwise(1 << i)
        for i, r in enumerate(rules)
    ]
    todo = todo.select("blob", "at", reduce(add, lacks).alias("missing"))
    todo = stored(todo.filter("missing > 0"), "unseen-blobs")

    candidates = texts.withColumn("own", blob)
    due = (F.col("own") == F.col("blob")) & F.col("path").eqNullSafe(F.col("at"))
    unseen = candidates.join(sized(todo, 72), due)
    runs, spans = [], []
    for i, rule in enumerate(rules):
        wanted = F.col("missing").bitwiseAND(1 << i) > 0
        runs.append(F.when(wanted, F.lit(rule.name)))
        spans.append(F.when(wanted, find(rule, F.col("text"))))
    scanned = unseen.select(
        "blob",
        F.array_compact(F.array(*runs)).alias("rules"),
        F.flatten(F.array_compact(F.array(*spans))).cast(_SPANS).alias("spans"),
    )
    ledger.append(scanned)

    found = paths.join(ledger.findings(rules, blobs), "blob", "left")
    return found.select(
        F.col("path").alias(path_col),
        F.lower(F.hex("blob")).alias("blob"),
        F.coalesce("spans", F.array().cast("array<struct<kind:string,start:int,end:int>>")).alias(
            "spans"
        ),
    )


def span_list(spans: Column) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
