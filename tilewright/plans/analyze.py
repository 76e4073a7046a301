"""The whole analysis: profile, report, rules and the report with its rules."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tilewright.operators.lob import dedup_profile, lob_columns, lob_profiles, wide_columns
from tilewright.operators.report import final_report, table_report
from tilewright.params import PlanParams
from tilewright.plans.rules import apply_rules, load_rules
from tilewright.plans.sinks import dump_result
from tilewright.session import materialize
from tilewright.sources.catalog import Catalog

logger = logging.getLogger(__name__)


@dataclass(frozen=True)
class Analysis:
    report: DataFrame  # as profiled, without rules
    rules: DataFrame  # rules of all cases
    final: DataFrame  # report with rules, largest tables first


def profile_tables(
    spark: SparkSession,
    catalog: Catalog,
    tables: Mapping[str, DataFrame],
    small_bytes: int = 1024,
) -> DataFrame:
    """LOB profile of all tables of the catalog, one row per LOB column.

    Columns of a two-byte text type are sized as UTF-16, all others as UTF-8.
    """
    found = lob_columns(catalog.columns, catalog.tables, catalog.schemas, catalog.types)
    wide = wide_columns(catalog.columns, catalog.types).withColumn("wide", F.lit(True))
    lobs = found.join(wide, ["object_id", "column"], "left").collect()  # catalog-sized: names only
    utf16: dict[str, list[str]] = {}
    for r in lobs:
        if r.wide:
            utf16.setdefault(f"{r.schema}.{r.table}", []).append(r.column)
    named = [(r.object_id, r.schema, r.table, r.column) for r in lobs]
    return dedup_profile(lob_profiles(spark, named, tables, small_bytes, utf16))


def analyze(
    spark: SparkSession,
    catalog: Catalog,
    tables: Mapping[str, DataFrame],
    params: PlanParams = PlanParams(),
) -> Analysis:
    """Analyse every table of ``catalog``; ``tables`` maps ``schema.table`` to its DataFrame.

    The report and the rules are stored once in the shared folder, so each user
    table is scanned once for its profile and, if it is loaded by key range,
    for its boundaries.
    """
    profile = profile_tables(spark, catalog, tables, params.small_bytes)
    report = materialize(table_report(catalog, profile, params.size_bounds), "report")
    rules = materialize(load_rules(report, catalog, tables, params), "rules")
    return Analysis(report, rules, final_report(apply_rules(report, rules), params.report_name))


def analyze_databases(
    spark: SparkSession,
    databases: Mapping[str, Callable[[], tuple[Catalog, Mapping[str, DataFrame]]]],
    folder: str,
    params: PlanParams = PlanParams(),
) -> dict[str, str | Exception | None]:
    """Analyse several databases in turn and store each final report under ``folder``.

    Each entry opens one database. Returns, by database, the path of the stored
    report, None if it has no rows, or the error that stopped it; an error in
    one database does not stop the others.
    """
    outcome: dict[str, str | Exception | None] = {}
    for name, open_database in databases.items():
        try:
            catalog, tables = open_database()
            final = analyze(spark, catalog, tables, params).final
            outcome[name] = dump_result(final, folder, name)
            logger.info("analysed %s: %s", name, outcome[name] or "no rows")
        except Exception as error:
            logger.exception("analysis of %s failed", name)
            outcome[name] = error
    return outcome
