from tilewright.operators.compare import compare_buckets, compare_rows, compare_tables
from tilewright.operators.keys import leading_key_column
from tilewright.operators.lob import dedup_profile, lob_columns, lob_profile, lob_split
from tilewright.operators.names import (
    name_search,
    user_databases,
    user_pg_databases,
    user_schemas,
)
from tilewright.operators.partitions import partition_info
from tilewright.operators.report import final_report, rollup_by_table, table_report
from tilewright.operators.stats import column_stats, distinct_counts, sequence_positions
from tilewright.operators.tiles import assign_slices, range_boundaries, slice_balance

__all__ = [
    "assign_slices",
    "column_stats",
    "compare_buckets",
    "compare_rows",
    "compare_tables",
    "dedup_profile",
    "distinct_counts",
    "final_report",
    "leading_key_column",
    "lob_columns",
    "lob_profile",
    "lob_split",
    "name_search",
    "partition_info",
    "range_boundaries",
    "rollup_by_table",
    "sequence_positions",
    "slice_balance",
    "table_report",
    "user_databases",
    "user_pg_databases",
    "user_schemas",
]
