"""Scalar column functions for landed security records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# They must equal the ones used by existing tables and messages.
SENTINEL_TIMESTAMP = "1970-01-01T00:00:00Z"
ERROR_TAIL_CHARS = 1000
CVE_IN_TEXT = r"CVE[-_ ](\d{4})[-_ ](\d{4,})"
HTTP_STATUS_IN_TEXT = r"HTTP Error (\d+)"
UNSAFE_SEGMENT_CHARS = r"[^A-Za-z0-9._-]+"
BASIC_URL = r"^https?://[^\s/$.?#][^\s]*$"

# The characters that count as white space at the edges of a landed value.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE))


def non_empty(text: Column) -> Column:
    """The text, or null when it is empty."""
    return F.nullif(text, F.lit(""))


# -- values inside a VARIANT ------------------------------------------------------------------------


def parsed(df: DataFrame, text: str, name: str) -> DataFrame:
    """Replace the text column by ``name``, its VARIANT; null where the text is not JSON.

    The value passes through a generator so that it is parsed once per row: a plain projection would be
    merged into the filters and projections above it and the parse repeated in each of them.
    """
    rest = [c for c in df.columns if c != text]
    return df.select(*rest, F.explode(F.array(F.try_parse_json(text))).alias(name))


def json_text(doc: Column, path: str) -> Column:
    """Text of the value at ``path``; null for a missing key or JSON null. Booleans read True/False."""
    value = F.try_variant_get(doc, path, "string")
    is_boolean = value.isin("true", "false") & (json_kind(doc, path) == "BOOLEAN")
    return F.when(is_boolean, F.initcap(value)).otherwise(value)


def json_kind(doc: Column, path: str) -> Column:
    """Type name of the value at ``path`` (``OBJECT<...>``, ``STRING``, ``VOID`` for JSON null); null if missing."""
    return F.schema_of_variant(F.try_variant_get(doc, path, "variant"))


def json_string(doc: Column, path: str) -> Column:
    """The value at ``path`` only if it is a JSON string."""
    return F.when(json_kind(doc, path) == "STRING", F.try_variant_get(doc, path, "string"))


def is_object(doc: Column) -> Column:
    return F.coalesce(F.schema_of_variant(doc).startswith("OBJECT"), F.lit(False))


def json_items(doc: Column, path: str = "$") -> Column:
    """Elements of the array at ``path`` as ``array<variant>``; null when it is not an array."""
    return F.try_variant_get(doc, path, "array<variant>")


def safe_str(doc: Column, path: str) -> Column:
    """Text of the value at ``path``, empty for null."""
    return F.coalesce(json_text(doc, path), F.lit(""))


def safe_int(doc: Column, path: str, default: int | None = None) -> Column:
    """Integer at ``path``: JSON numbers truncate, text must be a whole number, anything else is the default."""
    value = F.try_variant_get(doc, path, "bigint")
    return value if default is None else F.coalesce(value, F.lit(default).cast("bigint"))


def text_int(text: Column, default: int | None = None) -> Column:
    value = strip(text).try_cast("bigint")
    return value if default is None else F.coalesce(value, F.lit(default).cast("bigint"))


def canonical_json(doc: Column) -> Column:
    """JSON text with the keys sorted at every level."""
    return F.to_json(doc)


# -- numbers, dates, hashes -------------------------------------------------------------------------


def probability(text: Column) -> Column:
    """Score from text; unparsable, null and NaN give 0.0."""
    return F.coalesce(F.nanvl(strip(text).try_cast("double"), F.lit(0.0)), F.lit(0.0))


def sort_date_value(text: Column) -> Column:
    """``2026-03-12`` → 20260312; anything but digits and dashes gives 0."""
    digits = F.replace(text, F.lit("-"))
    return F.coalesce(
        F.when(digits.rlike("^[0-9]+$"), digits.try_cast("bigint")), F.lit(0).cast("bigint")
    )


def logical_time(*candidates: Column) -> Column:
    """First candidate text that reads as an ISO time; no offset means UTC (the session zone)."""
    return F.coalesce(*[c.try_cast("timestamp") for c in candidates])


def ingest_date(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd")


def hour_partition(moment: Column) -> Column:
    return F.date_format(moment, "HH")


def window_start(moment: Column, hours: int) -> Column:
    return moment - F.expr(f"interval {int(hours)} hours")


def window_bound_text(moment: Column) -> Column:
    """Bound of an incremental request window, milliseconds always zero."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'.000'")


def duration_seconds(start: Column, end: Column) -> Column:
    return F.round((F.unix_micros(end) - F.unix_micros(start)) / F.lit(1_000_000.0), 3)


def replay_run_id(moment: Column) -> Column:
    stamp = F.date_format(moment, "yyyyMMdd'T'HHmmss'Z'")
    return F.concat(stamp, F.lit("-"), F.substring(F.replace(F.uuid(), F.lit("-")), 1, 12))


def sha256(value: Column) -> Column:
    return F.sha2(value, 256)


# -- names and paths --------------------------------------------------------------------------------


def path_part(path: Column, name: str) -> Column:
    """Value of the hive part ``name=value`` in a path, empty when absent."""
    return F.regexp_extract(path, rf"(?:^|/)\Q{name}\E=([^/]+)", 1)


def artifact_format(name: Column) -> Column:
    suffix = F.regexp_extract(name, r"^.+\.([^.]+)$", 1)
    return (
        F.when(name.endswith(".pcap.bz2"), "pcap_bz2")
        .when(name.endswith(".pcap"), "pcap")
        .otherwise(F.coalesce(non_empty(suffix), F.lit("unknown")))
    )


def is_compressed(name: Column) -> Column:
    return name.endswith(".bz2")


def compression(name: Column) -> Column:
    return F.when(is_compressed(name), "bz2").otherwise("")


def sanitize_segment(text: Column) -> Column:
    clean = F.btrim(F.regexp_replace(text, UNSAFE_SEGMENT_CHARS, "_"), F.lit("_"))
    return F.coalesce(non_empty(clean), F.lit("adhoc"))


def error_tail(text: Column) -> Column:
    return F.right(text, F.lit(ERROR_TAIL_CHARS))


def http_status(message: Column) -> Column:
    return non_empty(F.regexp_extract(message, HTTP_STATUS_IN_TEXT, 1)).try_cast("int")


def padded(column: str, width: int) -> Column:
    """A number as text with leading zeros up to ``width``; a longer one stays whole."""
    text = F.col(column).cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def cve_in_signature(signature: Column) -> Column:
    """CVE id written in an alert signature (``CVE-2021-44228``, ``CVE_2021_44228``), else null."""
    upper = F.upper(signature)
    year, number = F.regexp_extract(upper, CVE_IN_TEXT, 1), F.regexp_extract(upper, CVE_IN_TEXT, 2)
    return F.when(year != "", F.concat_ws("-", F.lit("CVE"), year, number))


def looks_like_cve(text: Column) -> Column:
    return F.coalesce(text.startswith("CVE-"), F.lit(False))


def looks_like_url(text: Column) -> Column:
    return F.coalesce(text.rlike(BASIC_URL), F.lit(False))


def url_host(url: Column) -> Column:
    """Lower-cased host of a URL, null when the text is not one."""
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def url_join(base: Column, href: Column) -> Column:
    """Resolve a link against its page: absolute, scheme-relative, root-relative or beside the page."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)", 1)
    folder = F.regexp_extract(base, r"^(.*/)", 1)
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(origin, href))
        .otherwise(F.concat(folder, href))
    )


def first_where(items: Column, predicate) -> Column:
    """First array element that satisfies ``predicate``, else null."""
    return F.get(F.filter(items, predicate), F.lit(0))


# -- identities and keys ----------------------------------------------------------------------------


def _python_text(doc: Column, path: str) -> Column:
    """Text as a manifest writer forms it: missing → empty, JSON null → ``None``."""
    raw = F.try_variant_get(doc, path, "variant")
    return F.when(F.is_variant_null(raw), F.lit("None")).otherwise(safe_str(doc, path))


def manifest_identity(entry: Column) -> Column:
    relative = non_empty(strip(_python_text(entry, "$.relative_landing_path")))
    landing = non_empty(strip(_python_text(entry, "$.landing_path")))
    return F.coalesce(
        F.concat(F.lit("relative::"), relative),
        F.concat(F.lit("landing::"), landing),
        F.concat(F.lit("content::"), sha256(canonical_json(entry))),
    )


def message_key(*candidates: Column) -> Column:
    return F.coalesce(*[non_empty(c) for c in candidates])


def ioc_type_label(record: Column) -> Column:
    """Trimmed indicator type; missing or blank reads ``unknown``, JSON null reads ``None``."""
    raw = F.try_variant_get(record, "$.ioc_type", "variant")
    label = F.when(F.is_variant_null(raw), F.lit("None")).otherwise(strip(json_text(record, "$.ioc_type")))
    return F.coalesce(non_empty(label), F.lit("unknown"))
