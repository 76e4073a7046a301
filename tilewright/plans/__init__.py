from tilewright.plans.analyze import Analysis, analyze, analyze_databases, profile_tables
from tilewright.plans.rules import (
    apply_rules,
    case1_plain,
    case2_ranges,
    case3_partitions,
    case4_lob_ranges,
    case5_lob_partitions,
    case6_lob_plain,
    load_rules,
)
from tilewright.plans.sinks import (
    dump_result,
    read_report,
    read_rules,
    read_slice,
    update_report,
    write_report,
    write_rules,
    write_slices,
)

__all__ = [
    "Analysis",
    "analyze",
    "analyze_databases",
    "apply_rules",
    "case1_plain",
    "case2_ranges",
    "case3_partitions",
    "case4_lob_ranges",
    "case5_lob_partitions",
    "case6_lob_plain",
    "dump_result",
    "load_rules",
    "profile_tables",
    "read_report",
    "read_rules",
    "read_slice",
    "update_report",
    "write_report",
    "write_rules",
    "write_slices",
]
