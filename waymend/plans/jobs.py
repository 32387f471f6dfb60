"""The five jobs end to end: DataFrames in, DataFrames out, writing left to the caller
or to the ``write_*`` functions at the end of the module."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymend.operators import audit as audit_rules
from waymend.operators import crossref, diff, distance, merge, repair, replace, schedules, validate
from waymend.operators.resolve import NAME_GROUPS
from waymend.roles import BASE, BASE_HEADERS, align_schema, to_headers, to_roles
from waymend.session import frozen
from waymend.sources import readers, writers


@dataclass
class Migration:
    status: DataFrame
    totals: DataFrame
    import_rows: DataFrame
    unresolved: DataFrame
    skipped: DataFrame


def migrate(old: DataFrame, new: DataFrame, master: DataFrame, groups: int = NAME_GROUPS) -> Migration:
    """Old per-stop rows against new per-train rows (both raw headers plus ``row_id``).

    Four outputs read the difference, so the new stops and the status are written to
    the shared folder once.
    """
    old_roles = to_roles(old, keep=["row_id"])
    old_stops = schedules.old_schedule(old_roles)
    new_stops = frozen(schedules.new_schedule(new, master, groups))
    status = frozen(diff.schedule_status(old_stops, new_stops))
    return Migration(
        status=status,
        totals=diff.status_totals(status),
        import_rows=diff.import_rows(new_stops, status),
        unresolved=schedules.unresolved_names(new_stops),
        skipped=schedules.skipped_rows(old_roles),
    )


def validate_tables(**tables: DataFrame) -> DataFrame:
    """One report row per named table."""
    reports = [validate.validate(df, label) for label, df in tables.items()]
    out = reports[0]
    for report in reports[1:]:
        out = out.unionByName(report)
    return out


@dataclass
class Cleaned:
    flags: DataFrame
    audit_summary: DataFrame
    station_crossref: DataFrame
    train_crossref: DataFrame
    cleaned: DataFrame
    repair_log: DataFrame
    repair_changes: DataFrame
    station_status: DataFrame
    train_status: DataFrame


def clean(stops: DataFrame, stations: DataFrame, trains: DataFrame, secondary: DataFrame) -> Cleaned:
    """Audit, cross-reference, repair and enrich one per-stop table (roles, row_id)."""
    flags = audit_rules.audit(stops)
    codes = crossref.station_crossref(stops, stations, secondary)
    numbers = crossref.train_crossref(stops, trains)
    return Cleaned(
        flags=flags,
        audit_summary=audit_rules.audit_summary(stops, flags),
        station_crossref=codes,
        train_crossref=numbers,
        cleaned=crossref.enrich(repair.repair_split_rows(stops), codes),
        repair_log=repair.repair_log(stops),
        repair_changes=repair.repair_changes(stops),
        station_status=crossref.status_counts(codes),
        train_status=crossref.status_counts(numbers),
    )


def normalize_second(stops: DataFrame, stations: DataFrame) -> DataFrame:
    """Second source to the common form: formats, adjacent duplicates, code suggestions."""
    settled = repair.merge_adjacent_duplicates(repair.normalize_format(stops))
    return repair.suggest_codes(settled, stations)


@dataclass
class Merged:
    filled1: DataFrame
    filled2: DataFrame
    decisions: DataFrame
    merged: DataFrame
    log: DataFrame


def fill_and_merge(ds1: DataFrame, ds2: DataFrame) -> Merged:
    """Cross-fill both tables from each other, then keep one table per train.

    The filled rows of both tables are written once; every output but the decisions reads
    the written ones.
    """
    rows = frozen(merge.united(ds1, ds2))

    def side(number, columns):
        return rows.where(F.col("side") == number).select(*columns, "timing_source", "filled")

    return Merged(
        side(1, ds1.columns), side(2, ds2.columns), merge.overlap_decisions(ds1, ds2), merge.merge_sources(rows),
        merge.merge_log(rows),
    )


@dataclass
class Replaced:
    table: DataFrame
    needed: DataFrame
    decisions: DataFrame
    log: DataFrame
    rejected: DataFrame


def gated_replacement(table, needed, routes, duplicates) -> Replaced:
    """Swap in routes whose two ends agree with the declared ones."""
    meta = readers.needed_meta(needed)
    decisions = frozen(replace.match_routes(meta, routes))
    new_table, still = replace.replace_trains(table, needed, routes, decisions)
    log = replace.replace_log(table, needed, meta, routes, duplicates, decisions)
    return Replaced(new_table, still, decisions, log, replace.rejected_sample(decisions))


@dataclass
class Filled:
    known: DataFrame
    needed: DataFrame
    rows: DataFrame
    chains: DataFrame
    log: DataFrame


def distance_fill(known: DataFrame, needed: DataFrame, verify_first: bool = False) -> Filled:
    """Fill distances between anchors and move the filled rows to ``known``."""
    lookup = frozen(distance.segment_lookup(known))
    chains = frozen(distance.chained(needed, known, lookup, verify_first))
    rows = distance.fill_distances(chains)
    new_known, still = distance.move_filled(known, rows)
    return Filled(
        new_known, still, rows, distance.chain_log(chains),
        distance.fill_log(chains, lookup),
    )


# ------------------------------------------------------------ files


def read_stops(spark: SparkSession, path) -> DataFrame:
    """Per-stop CSV as roles with ``row_id``; only the empty text is null."""
    return to_roles(readers.read_stops_with_row_id(spark, path), keep=["row_id"])


def read_with_row_id(spark: SparkSession, path) -> DataFrame:
    """Any schedule CSV as raw headers with ``row_id``; blanks are ''."""
    return readers.with_csv_row_id(readers.read_schedule_with_place(spark, path))


def write_migration(result: Migration, folder, mode="errorifexists"):
    writers.write_csv(result.import_rows, f"{folder}/import_ready", mode)
    writers.write_change_reports(result.status, folder, mode)
    writers.write_summary_json(result.totals, f"{folder}/migration_summary", mode)
    writers.write_csv(result.unresolved, f"{folder}/unresolved_stations", mode)
    writers.write_csv(result.skipped, f"{folder}/skipped_seq_values", mode)


def write_cleaned(result: Cleaned, folder, mode="errorifexists"):
    headers = {
        **BASE_HEADERS,
        "validation_status": "Validation Status",
        "reference_name": "Station Name (Community Reference)",
    }
    writers.write_csv(result.flags, f"{folder}/audit_flags", mode)
    writers.write_summary_json(result.audit_summary, f"{folder}/audit_summary", mode)
    writers.write_csv(result.station_crossref, f"{folder}/station_crossref", mode)
    writers.write_csv(result.train_crossref, f"{folder}/train_crossref", mode)
    writers.write_csv(to_headers(result.cleaned.drop("row_id"), headers), f"{folder}/cleaned", mode)
    writers.write_summary_json(result.repair_log, f"{folder}/cleaning_log", mode)
    writers.write_csv(result.repair_changes, f"{folder}/repair_changes", mode)
    writers.write_summary_json(result.station_status, f"{folder}/station_status", mode)
    writers.write_summary_json(result.train_status, f"{folder}/train_status", mode)


MERGED_HEADERS = {
    **BASE_HEADERS,
    "source_dataset": "Source Dataset",
    "timing_source": "Timing Source",
    "validation_status": "Validation Status",
    "reference_name": "Station Name (Community Reference)",
    "code_suggestion": "Station Code (Community Reference Suggestion)",
}


def write_merged(result: Merged, folder, mode="errorifexists"):
    for name, filled in (("dataset1_filled", result.filled1), ("dataset2_filled", result.filled2)):
        plain = align_schema(filled, BASE + ["timing_source"])
        writers.write_csv(to_headers(plain, MERGED_HEADERS), f"{folder}/{name}", mode)
    writers.write_csv(to_headers(result.merged, MERGED_HEADERS), f"{folder}/merged", mode)
    writers.write_summary_json(result.log, f"{folder}/merge_log", mode)
    sample = merge.decision_sample(result.decisions)
    writers.write_summary_json(sample, f"{folder}/merge_decisions_sample", mode)


def write_replacement(result: Replaced, folder, mode="errorifexists"):
    writers.write_summary_json(result.log, f"{folder}/replacement_log", mode)
    writers.write_csv(result.decisions, f"{folder}/replacement_decisions", mode)
    writers.write_summary_json(result.rejected, f"{folder}/replacement_rejected_sample", mode)


def write_new_tables(known: DataFrame, needed: DataFrame, folder, version: str):
    """Both rewritten tables under a new version, in the twelve base headers."""
    return [
        writers.write_new_version(to_headers(df.select(BASE)), f"{folder}/{name}", version)
        for name, df in (("known", known), ("needed", needed))
    ]

