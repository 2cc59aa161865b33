"""The whole job: read under the contract, split, quarantine, clean, aggregate, write."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field, replace
from datetime import datetime, timezone
from hashlib import sha256

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cleargrist.functions import named
from cleargrist.operators.observed import PATIENCE, observed_metrics
from cleargrist.operators.quality import (
    FLAG,
    LOAD_TIME,
    MATERIALS_RULES,
    VALID,
    CleaningRules,
    Profile,
    cleaning_summary,
    drop_sparse,
    flag_rows,
    profile,
    profile_measures,
    quarantine_rows,
    stamp,
    tag,
    valid_rows,
)
from cleargrist.operators.reuse import input_fingerprint, materialize
from cleargrist.operators.stats import (
    MATERIALS_KEYS,
    MATERIALS_VALUE,
    group_states,
    merge_states,
    price_stats,
    stats_of_states,
)
from cleargrist.plans.releases import (
    Part,
    Release,
    StoredTable,
    latest,
    new_run,
    publish,
    read_stored,
)
from cleargrist.sinks.writers import partitioned_schema, restore_keys, write_table
from cleargrist.sources.contract import MATERIALS_CONTRACT
from cleargrist.sources.tables import ReadOptions, read_watched
from cleargrist.workspace import scratch_path

#: Part of a checkpoint's key; to be raised when rows are cleaned in another way than before.
CLEANING_VERSION = 3


@dataclass(frozen=True)
class Staged:
    """Tagged rows stored once: the two halves, and their profile."""

    valid: DataFrame
    quarantine: DataFrame
    profile: Profile
    reused: bool


def stage(
    df: DataFrame,
    path: str,
    key: str,
    rules: CleaningRules = MATERIALS_RULES,
    still_true: Callable[[], bool] | None = None,
    patience: float = PATIENCE,
    split: bool = True,
) -> Staged:
    """Tag rows and store them in one pass over the source, counting rows and nulls on the way.

    Everything after works on the stored table, as does a later run with the same key. Worth
    its write when the source is slow to read or runs repeat. A column that only one half uses
    is stored as null in the other, so a text is stored once, raw or cleaned. The halves lie in
    folders of their own, so that reading one does not read the other; without ``split`` they lie
    together, which saves sorting the rows for a table that is read once or twice.
    """
    tagged = tag(df, rules)
    output = rules.output_names
    shared = set(df.columns) & set(output)
    is_valid = named(FLAG) == VALID
    halves = tagged.select(
        *(named(c) if c in shared else F.when(~is_valid, named(c)).alias(c) for c in df.columns),
        *(F.when(is_valid, named(c)).alias(c) for c in output if c not in shared),
        named(FLAG),
    )
    measures = profile_measures({c: named(c) for c in output})
    by = FLAG if split else None
    stored = materialize(halves, path, key, measures, still_true, patience, partition_by=by)
    return Staged(
        valid=valid_rows(stored.table, rules),
        quarantine=quarantine_rows(stored.table, rules),
        profile=Profile(stored.metrics, rules),
        reused=stored.reused,
    )


def write_quarantine(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    mode: str = "overwrite",
    rules: CleaningRules = MATERIALS_RULES,
    patience: float = PATIENCE,
) -> Profile:
    """Write the invalid rows and profile all rows in the same pass; return the profile.

    The pass parses numbers and looks at nulls, but normalises no text. If the profile does not
    arrive within ``patience`` seconds after the pass, another pass computes it, with a warning.
    """
    flagged = flag_rows(df, rules)

    def profile_again() -> Row:
        return profile(flagged, rules).first()

    if mode.lower() == "ignore":  # may write nothing, and then there is nothing to observe
        write_table(quarantine_rows(flagged, rules), path, fmt, mode)
        return Profile(profile_again().asDict(), rules)
    counts = Observation()
    watched = flagged.observe(counts, *profile_measures(rules.null_probes()))
    write_table(quarantine_rows(watched, rules), path, fmt, mode)
    return Profile(observed_metrics(counts, profile_again, patience), rules)


@dataclass(frozen=True)
class CurationOptions:
    """What ``curate`` reads, how it treats it, and where it writes.

    The outputs go to ``clean_path``, ``quarantine_path`` and ``stats_path``, one after the other. Or
    they go to ``publish_path`` as releases, which change together: every run writes into a folder
    of its own there, and its tables become the current ones at the end, all at once; see
    ``current_release``.

    ``checkpoint_path`` stores the tagged rows, so that the source is read once, and not at all
    by a later run over the same input. The columns that the statistics need are never dropped
    as sparse. Each run adds a row to the JSON tables at ``schema_report_path`` and
    ``summary_path``, where given. With ``mode="append"`` every run adds its rows to the outputs:
    the clean table is read back with the columns of all runs. The statistics at ``stats_path`` are
    those of each run side by side; those of a release are about all rows together, as mergeable
    states of all groups are stored along with them. CSV files cannot differ in their columns, so
    an appended CSV keeps its sparse ones. Quoted line breaks in CSV input need
    ``ReadOptions(multiline=True)``, or such a row becomes two bad ones. Rows that do not fit the
    table go to the quarantine with their raw line if ``ReadOptions(bad_lines=...)`` names a column.
    """

    input_path: str | Sequence[str]
    clean_path: str | None = None
    quarantine_path: str | None = None
    stats_path: str | None = None
    read: ReadOptions = field(default_factory=ReadOptions)
    contract: StructType | None = field(default_factory=lambda: MATERIALS_CONTRACT)
    rules: CleaningRules = MATERIALS_RULES
    null_threshold: float = 0.9
    include_metadata: bool = False
    stats_keys: Sequence[str] = MATERIALS_KEYS
    stats_value: str = MATERIALS_VALUE
    stats_partition: str | None = "category_cleaned"
    exact_stats: bool = True
    write_format: str = "parquet"
    mode: str = "overwrite"
    checkpoint_path: str | None = None
    schema_report_path: str | None = None
    summary_path: str | None = None
    patience: float = PATIENCE
    publish_path: str | None = None

    def __post_init__(self):
        paths = (self.clean_path, self.quarantine_path, self.stats_path)
        if all(paths) == bool(self.publish_path) or any(paths) != all(paths):
            raise ValueError("give the paths of all three outputs, or a path for releases")

    @property
    def row_rules(self) -> CleaningRules:
        """The rules, with the column that rows of bad lines are told by."""
        return replace(self.rules, bad_lines=self.read.bad_lines) if self.read.bad_lines else self.rules

    def checkpoint_key(self, spark: SparkSession) -> str:
        """Changes with the input files, how they are read, and how rows are cleaned."""
        contract = self.contract.json() if self.contract else ""
        settings = repr((CLEANING_VERSION, asdict(self.read), contract, self.row_rules))
        files = input_fingerprint(spark, self.input_path)
        return f"{files}-{sha256(settings.encode()).hexdigest()}"


@dataclass(frozen=True)
class Curated:
    """The outputs of ``curate`` as read back; no clean rows and no statistics if none is valid."""

    summary: DataFrame
    quarantine: DataFrame
    clean: DataFrame | None
    stats: DataFrame | None


def curate(spark: SparkSession, options: CurationOptions) -> Curated:
    """Run the job and write its outputs.

    Which columns the clean table has depends on all rows, so the source is scanned twice:
    once for the quarantine and the profile, once for the clean rows. The second scan reads
    and normalises only the columns that stay. Statistics come from the stored clean table, where
    it holds just these rows unchanged. For CSV output, and where rows are added to others in one
    folder, the clean rows are stored as Parquet first, in the scratch folder. A release in CSV, whose
    outputs all wait to be published, scans the source once instead: its tagged rows are stored there
    (see ``stage``), and the outputs come from them. The
    field names of JSON input are gathered by the first scan, and what it writes waits for them.

    If no row is valid, there is no clean table and there are no statistics; in overwrite mode
    empty ones replace those of an earlier run.
    """
    if options.publish_path:
        return _curate_release(spark, options, options.publish_path)
    return _run(spark, options).curated


def current_release(spark: SparkSession, path: str) -> Curated | None:
    """The outputs of the last run that ``curate`` has published under a path, or None.

    The summary is about that run, the tables hold the rows of all runs that were appended.
    """
    release = latest(spark, path)
    return _released(spark, path, release) if release else None


def _released(spark: SparkSession, path: str, release: Release) -> Curated:
    tables = release.tables

    def read(name: str) -> DataFrame | None:
        return tables[name].read(spark, path) if name in tables else None

    return Curated(read("summary"), read("quarantine"), read("clean"), read("stats"))


def _curate_release(spark: SparkSession, options: CurationOptions, path: str) -> Curated:
    mode, fmt = options.mode.lower(), options.write_format.lower()
    before = latest(spark, path)
    if before and mode == "errorifexists":
        raise ValueError(f"there is a release under {path} already")
    if before and mode == "ignore":
        return _released(spark, path, before)
    older = before.tables if before and mode == "append" else {}
    run = new_run()
    folder = f"runs/{run}"

    def at(name: str) -> str:
        return f"{path}/{folder}/{name}"

    own = replace(
        options,
        publish_path=None,
        clean_path=at("clean"),
        quarantine_path=at("quarantine"),
        stats_path=at("stats"),
        mode="overwrite",
    )
    states = older["states"].read(spark, path) if "states" in older else None
    found = _run(spark, own, _Release(at("states"), states))
    write_table(found.curated.summary, at("summary"), "json")

    def table(name: str, schema: StructType, how: str, keys: Sequence[str] = ()) -> StoredTable:
        stored = partitioned_schema(schema, keys) if keys else schema
        empty = found.curated.clean is None and name in ("clean", "stats", "states")
        part = Part(None if empty else f"{folder}/{name}", stored.json())
        return StoredTable(how, tuple(schema.names), (part,), tuple(keys))

    tables = {
        "summary": table("summary", found.curated.summary.schema, "json"),
        "quarantine": table("quarantine", found.curated.quarantine.schema, fmt).after(older.get("quarantine")),
    }
    if found.clean is None or (mode == "append" and found.curated.clean is None):
        tables |= {name: older[name] for name in ("clean", "stats", "states") if name in older}
    else:
        keys = [options.stats_partition] if options.stats_partition else []
        clean = table("clean", found.clean, fmt).after(older.get("clean"))
        place = {c: i for i, c in enumerate(found.full_order)}
        columns = sorted(clean.columns, key=lambda c: place.get(c, len(place)))
        tables["clean"] = replace(clean, columns=tuple(columns))
        tables["stats"] = table("stats", found.stats, fmt, keys)
        tables["states"] = table("states", found.states, "parquet")
    published = publish(spark, path, run, tables, before)
    result = _released(spark, path, published)
    if found.curated.clean is None and mode != "append":
        return replace(result, clean=None, stats=None)
    return result


@dataclass(frozen=True)
class _Release:
    """For a run whose outputs nobody reads before they are published: where states go, and older ones."""

    states_path: str
    older: DataFrame | None


@dataclass(frozen=True)
class _Found:
    """What a run has written: its outputs, and the schemas of the stored tables."""

    curated: Curated
    full_order: Sequence[str]
    clean: StructType | None = None
    stats: StructType | None = None
    states: StructType | None = None


class _OtherNotation(Exception):
    """Rows have been stored that are not to the letter those of the source."""


def _run(spark: SparkSession, options: CurationOptions, release: _Release | None = None) -> _Found:
    rules, threshold = options.row_rules, options.null_threshold
    started = datetime.now(timezone.utc)
    appends = options.mode.lower() == "append"
    fmt = options.write_format.lower()
    keys = [options.stats_partition] if options.stats_partition else []
    # Before the source is listed: a file that arrives later is not covered by this key.
    key = options.checkpoint_key(spark) if options.checkpoint_path else ""
    watched = read_watched(
        spark,
        options.input_path,
        options.contract,
        options.read,
        options.schema_report_path,
        options.patience,
    )

    def store(df: DataFrame, path: str) -> DataFrame:
        write_table(df, path, fmt, options.mode)
        return read_stored(spark, path, fmt, df.schema)

    def staged_in_parquet(df: DataFrame, label: str) -> DataFrame:
        path = scratch_path(spark, label)
        write_table(df, path)
        return read_stored(spark, path, "parquet", df.schema)

    def store_clean(df: DataFrame) -> DataFrame:
        rows = df
        if fmt == "csv":  # the load time as the writer would put it, but put so once for all rows
            moment = F.lit(started).cast("timestamp").alias(LOAD_TIME)
            rows = df.withColumn(LOAD_TIME, F.to_csv(F.struct(moment)))
        write_table(rows, options.clean_path, fmt, options.mode)
        return read_stored(spark, options.clean_path, fmt, df.schema)

    def write_stats(clean: DataFrame) -> tuple[StructType, StructType | None]:
        states = None
        if release is None:
            stats = price_stats(clean, options.stats_keys, options.stats_value, options.exact_stats)
        else:
            states = group_states(clean, options.stats_keys, options.stats_value)
            if release.older is not None:
                states = merge_states(states.unionByName(release.older), options.stats_keys)
            write_table(states, release.states_path)
            states = read_stored(spark, release.states_path, "parquet", states.schema)
            stats = stats_of_states(states, options.stats_keys, options.exact_stats)
        write_table(stats, options.stats_path, fmt, options.mode, keys, key_copies=True)
        return stats.schema, states.schema if states else None

    # The stored clean table serves for the statistics, if it holds just these rows unchanged:
    # other modes leave older rows, and CSV cannot tell an empty text from a missing one.
    reusable = fmt != "csv" and not appends and options.mode.lower() != "ignore"
    one_scan = options.checkpoint_path is not None or (release is not None and not reusable)
    if not one_scan:
        # Rows of JSON records may still be refused, so they replace nothing yet.
        waits = watched.waits and release is None
        first = scratch_path(spark, "quarantine") if waits else options.quarantine_path
        first_fmt, first_mode = ("parquet", "overwrite") if waits else (fmt, options.mode)
        profiled = write_quarantine(
            watched.rows, first, first_fmt, first_mode, rules, options.patience
        )
        if not watched.judge():
            profiled = write_quarantine(
                watched.again, first, first_fmt, first_mode, rules, options.patience
            )
        source = watched.again
        rejected = quarantine_rows(flag_rows(source, rules), rules)
        quarantine = read_stored(spark, first, first_fmt, rejected.schema)
        if waits:
            quarantine = store(quarantine, options.quarantine_path)
        valid = valid_rows(tag(source, rules), rules)
    else:

        kept_for_later = options.checkpoint_path is not None

        def still_true() -> bool:
            return not kept_for_later or options.checkpoint_key(spark) == key

        def judged() -> bool:
            if not watched.judge():
                raise _OtherNotation
            return still_true()

        where = (options.checkpoint_path or scratch_path(spark, "tagged"), key, rules)
        try:
            staged = stage(watched.rows, *where, judged, options.patience, split=kept_for_later)
        except _OtherNotation:
            staged = stage(watched.again, *where, still_true, options.patience, split=kept_for_later)
        profiled, valid = staged.profile, staged.valid
        quarantine = store(staged.quarantine, options.quarantine_path)

    full = stamp(valid, started)
    protect = (*options.stats_keys, options.stats_value)
    summary = cleaning_summary(
        profiled.frame(spark), threshold, rules, options.include_metadata, protect
    )
    if options.summary_path is not None:
        write_table(stamp(summary, started), options.summary_path, "json", "append")
    ratios = profiled.ratios
    if ratios is None:
        found = _Found(Curated(summary, quarantine, None, None), full.columns)
        if options.mode.lower() == "overwrite":
            none = full.limit(0)
            kept = none if options.include_metadata else none.drop(FLAG)
            write_table(kept, options.clean_path, fmt, options.mode)
            stats, states = write_stats(none)
            found = replace(found, clean=kept.schema, stats=stats, states=states)
        return found

    if appends and fmt == "csv":
        protect = valid.columns
    kept = stamp(drop_sparse(valid, ratios, threshold, options.include_metadata, protect), started)
    if not reusable and not one_scan:
        kept = staged_in_parquet(kept, "clean")
    clean = store_clean(kept)
    if appends:
        clean = _all_runs(spark, options.clean_path, fmt, full.schema)
    stats, states = write_stats(clean if reusable else kept)
    stored_stats = read_stored(spark, options.stats_path, fmt, partitioned_schema(stats, keys))
    curated = Curated(summary, quarantine, clean, restore_keys(stored_stats, keys))
    return _Found(curated, full.columns, kept.schema, stats, states)


def _all_runs(spark: SparkSession, path: str, fmt: str, schema: StructType) -> DataFrame:
    """An appended table with every column that some run has stored."""
    if fmt in ("parquet", "orc"):
        stored = spark.read.format(fmt).option("mergeSchema", True).load(path).schema
        schema = StructType([f for f in schema.fields if f.name in stored.names])
    return read_stored(spark, path, fmt, schema)
