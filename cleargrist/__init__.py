"""Batch data-quality operators for PySpark.

Read tables against a schema contract, clean and flag rows, quarantine the bad ones, drop
sparse columns, compute grouped statistics, and write the results.
"""

from cleargrist.operators.quality import (
    MATERIALS_RULES,
    CleaningRules,
    Profile,
    clean,
    cleaning_summary,
    drop_sparse,
    flag_rows,
    null_ratios,
    profile,
    quarantine_rows,
    stamp,
    tag,
    valid_rows,
)
from cleargrist.operators.reuse import checkpoint, input_fingerprint, materialize
from cleargrist.operators.stats import group_states, merge_states, price_stats, stats_of_states
from cleargrist.plans.curate import (
    CurationOptions,
    Curated,
    Staged,
    curate,
    current_release,
    stage,
    write_quarantine,
)
from cleargrist.sinks.writers import partitioned_schema, restore_keys, write_jdbc, write_table
from cleargrist.sources.contract import (
    MATERIALS_CONTRACT,
    ContractError,
    SchemaReport,
    compare_schema,
)
from cleargrist.sources.tables import (
    ReadOptions,
    Watched,
    contract_report,
    preview_schema,
    read_table,
    read_watched,
)

__all__ = [
    "MATERIALS_CONTRACT",
    "MATERIALS_RULES",
    "CleaningRules",
    "ContractError",
    "Curated",
    "CurationOptions",
    "Profile",
    "ReadOptions",
    "SchemaReport",
    "Staged",
    "Watched",
    "checkpoint",
    "clean",
    "cleaning_summary",
    "compare_schema",
    "contract_report",
    "curate",
    "current_release",
    "drop_sparse",
    "flag_rows",
    "group_states",
    "input_fingerprint",
    "materialize",
    "merge_states",
    "null_ratios",
    "partitioned_schema",
    "preview_schema",
    "price_stats",
    "profile",
    "quarantine_rows",
    "read_table",
    "read_watched",
    "restore_keys",
    "stage",
    "stamp",
    "stats_of_states",
    "tag",
    "valid_rows",
    "write_jdbc",
    "write_quarantine",
    "write_table",
]
