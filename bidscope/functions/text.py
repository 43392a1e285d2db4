"""Text rules: spellings, group keys, names, titles, sentences and short reasons."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character counted as white space in page text, Java regex syntax. Visible ASCII
# is ruled out first, by one comparison.
SPACE = (
    r"[[^!-~]&&[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]]"
)
# The same characters.
_SPACES = "".join(
    chr(n) for a, b in ((9, 13), (28, 32), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
                        (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)) for n in range(a, b + 1)
)
# Download address of a tender's archive.
DOWNLOAD_PAGE = "entreprise.EntrepriseDownloadCompleteDce"
# Visible name of a tender.
UNTITLED = "Untitled tender"
TITLE_LENGTH = 120
# Markers looked for in a lower-cased error message, and the reason each stands for.
FAILURE_REASONS = (
    ("could not translate host name", "host does not resolve"),
    ("name or service not known", "host does not resolve"),
    ("nodename nor servname", "host does not resolve"),
    ("connection refused", "connection refused"),
    ("timeout expired", "connection timed out"),
    ("timed out", "connection timed out"),
    ("password authentication failed", "authentication failed"),
)


def spelling(value: Column) -> Column:
    """The value trimmed, each run of white space made one space."""
    return F.trim(F.regexp_replace(value, r"\s+", " "))


def group_key(value: Column) -> Column:
    """What values differing only in case or spacing share."""
    return F.lower(spelling(value))


def strip(value: Column) -> Column:
    """Remove leading and trailing white space, no-break spaces included."""
    return F.btrim(value, F.lit(_SPACES))


def collapse(value: Column) -> Column:
    """Trim, and make each run of white space one space, no-break spaces included."""
    return F.trim(F.regexp_replace(value, f"{SPACE}+", " "))


def clean(value: Column) -> Column:
    """The collapsed text; null when nothing is left."""
    return F.nullif(collapse(value), F.lit(""))


def has_text(value: Column) -> Column:
    return F.coalesce(strip(value) != "", F.lit(False))


def archive_name(tender_id: Column, organization: Column) -> Column:
    return F.concat(tender_id, F.lit("_"), organization, F.lit(".zip"))


def download_url(tender_id: Column, organization: Column) -> Column:
    return F.concat(
        F.lit(f"?page={DOWNLOAD_PAGE}&reference="),
        _form_encode(tender_id),
        F.lit("&orgAcronym="),
        _form_encode(organization),
    )


def _form_encode(value: Column) -> Column:
    # Java keeps "*" and encodes "~"; HTML form encoding as used by the platform does the reverse.
    return F.replace(F.replace(F.url_encode(value), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def file_type(path: Column) -> Column:
    """Lower-case last extension of a path; empty when there is none."""
    return F.lower(F.regexp_extract(path, r"[^/]\.([^./]+)$", 1))


def short_title(value: Column) -> Column:
    cut = F.regexp_replace(F.substring(value, 1, TITLE_LENGTH), f"{SPACE}+$", "")
    return (
        F.when(value.isNull() | (value == ""), F.lit(UNTITLED))
        .when(F.length(value) > TITLE_LENGTH, F.concat(cut, F.lit("…")))
        .otherwise(value)
    )


def plural(count: Column, noun: str) -> Column:
    return F.concat(count.cast("string"), F.when(count == 1, f" {noun}").otherwise(f" {noun}s"))


def days_text(days: Column) -> Column:
    """``1 day``, ``12 days``, ``11.5 days``: a whole number loses its decimals."""
    whole = days.cast("bigint")
    number = F.when(days == whole, whole.cast("string")).otherwise(days.cast("string"))
    return F.concat(number, F.when(days == 1, " day").otherwise(" days"))


def share_percent(count: Column, largest: Column) -> Column:
    """Length of a bar, in percent of the largest count (taken as at least one)."""
    return count * 100.0 / F.greatest(F.lit(1), largest)


def failure_reason(message: Column, kind: Column) -> Column:
    """A short reason that repeats nothing of the message, such as hosts or credentials."""
    lowered = F.lower(message)
    reason = None
    for marker, text in FAILURE_REASONS:
        test = lowered.contains(marker)
        reason = F.when(test, text) if reason is None else reason.when(test, text)
    return reason.otherwise(F.concat(F.lit("connection failed ("), kind, F.lit(")")))
