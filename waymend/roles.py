"""Column roles: which header plays which part, and the table shape that follows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waymend.functions.fixed_values import COLUMN_CANDIDATES, REPORT_FIELDS, REQUIRED_FIELDS

# The twelve columns of a per-stop file, role name -> header.
BASE_HEADERS = {
    "train_no": "Train No",
    "train_name": "Train Name",
    "seq": "SEQ",
    "station_code": "Station Code",
    "station_name": "Station Name",
    "arrival": "Arrival time",
    "departure": "Departure Time",
    "distance": "Distance",
    "source_code": "Source Station",
    "source_name": "Source Station Name",
    "dest_code": "Destination Station",
    "dest_name": "Destination Station Name",
}
BASE = list(BASE_HEADERS)

# Role -> logical field of the candidate lists.
ROLE_FIELDS = {
    "train_no": "train_number",
    "train_name": "train_name",
    "seq": "sequence",
    "station_code": "station_code",
    "station_name": "station_name",
    "arrival": "arrival_time",
    "departure": "departure_time",
    "distance": "distance",
    "source_code": "source_station",
    "source_name": "source_name",
    "dest_code": "destination_station",
    "dest_name": "destination_name",
}


def find_column(df: DataFrame, field_or_candidates):
    """First candidate that is a column of ``df`` (exact case), or None. Runs no job."""
    candidates = (
        COLUMN_CANDIDATES[field_or_candidates]
        if isinstance(field_or_candidates, str)
        else field_or_candidates
    )
    present = set(df.columns)
    return next((c for c in candidates if c in present), None)


def detect_columns(df: DataFrame) -> dict:
    return {field: find_column(df, field) for field in REPORT_FIELDS}


def detect_shape(df: DataFrame):
    """'per_stop', 'per_train' or None, from the header alone."""
    found = detect_columns(df)
    for shape, fields in REQUIRED_FIELDS.items():
        if all(found[f] for f in fields):
            return shape
    return None


def quoted(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def to_roles(df: DataFrame, mapping: dict | None = None, keep=()) -> DataFrame:
    """Select the twelve roles as strings; roles without a column become null.

    ``mapping`` (role -> column name) overrides detection by header; ``keep`` names
    further columns to carry along.
    """
    mapping = mapping or {}
    out = []
    for role in BASE:
        column = mapping.get(role) or find_column(df, ROLE_FIELDS[role])
        source = quoted(column).cast("string") if column else F.lit(None).cast("string")
        out.append(source.alias(role))
    return df.select(*out, *[quoted(k) for k in keep])


def to_headers(df: DataFrame, headers: dict | None = None) -> DataFrame:
    """Role columns back to file headers; other columns keep their names."""
    headers = headers or BASE_HEADERS
    return df.select(*[quoted(c).alias(headers.get(c, c)) for c in df.columns])


def align_schema(df: DataFrame, columns: list, fill: str = "") -> DataFrame:
    """Fixed column order; columns the table lacks are added with ``fill``."""
    present = set(df.columns)
    return df.select(
        *[quoted(c) if c in present else F.lit(fill).alias(c) for c in columns]
    )


def rename_to_common(df: DataFrame, renames: dict) -> DataFrame:
    """Rename headers to the common schema; names that are absent are ignored."""
    return df.withColumnsRenamed({a: b for a, b in renames.items() if a in df.columns})
