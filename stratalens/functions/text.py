"""Text and number cleaning, name normalisation and similarity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Region spellings and the short form each one stands for.
REGION_SHORT_FORMS = {
    "Region I (Ilocos Region)": "Region I",
    "Region II (Cagayan Valley)": "Region II",
    "Region III (Central Luzon)": "Region III",
    "Region IV-A (CALABARZON)": "Region IV-A",
    "MIMAROPA Region": "MIMAROPA",
    "Region V (Bicol Region)": "Region V",
    "Region VI (Western Visayas)": "Region VI",
    "Region VII (Central Visayas)": "Region VII",
    "Region VIII (Eastern Visayas)": "Region VIII",
    "Region IX (Zamboanga Peninsula)": "Region IX",
    "Region X (Northern Mindanao)": "Region X",
    "Region XI (Davao Region)": "Region XI",
    "Region XII (SOCCSKSARGEN)": "Region XII",
    "Region XIII (Caraga)": "Region XIII",
    "Cordillera Administrative Region (CAR)": "CAR",
    "National Capital Region (NCR)": "NCR",
    "Bangsamoro Autonomous Region In Muslim Mindanao (BARMM)": "BARMM",
    "Negros Island Region (NIR)": "NIR",
    "CARAGA": "Region XIII",
}
# Corrupted spellings of the letter n with tilde.
MOJIBAKE = ("Ã±", "¤")
PLACE_PREFIXES = ("city of ", "municipality of ")
PLACE_SUFFIX = " city"

_EDGE_SPACE = r"(?U)^\s+|\s+$"


def trimmed(text: Column) -> Column:
    """Strip white space of any kind from both ends."""
    return F.regexp_replace(text, _EDGE_SPACE, "")


def repaired(text: Column) -> Column:
    """Trim, then restore letters broken by a wrong encoding."""
    out = trimmed(text)
    for broken in MOJIBAKE:
        out = F.replace(out, F.lit(broken), F.lit("ñ"))
    return out


def to_number(text: Column) -> Column:
    """Number from text with thousands separators; anything else is NULL, never NaN.

    A cast from text strips white space by itself, but would also take a type
    letter at the end (``5d``) as part of the number.
    """
    value = F.replace(text, F.lit(","), F.lit("")).try_cast("double")
    return F.when(~text.rlike("[dDfF]\\s*$"), F.nullif(value, F.lit(float("nan"))))


def to_key(text: Column) -> Column:
    """Integer key from text; ``101.0`` and ``1,234`` are keys, other text is NULL."""
    return to_number(text).try_cast("bigint")


def region_short(name: Column) -> Column:
    """Short form of a region name; an unknown name is only trimmed."""
    clean = trimmed(name)
    table = F.create_map(*[F.lit(x) for pair in REGION_SHORT_FORMS.items() for x in pair])
    return F.coalesce(F.try_element_at(table, clean), clean)


def place_name(name: Column) -> Column:
    """Comparable form of a province or municipality name; '' for a missing one."""
    out = F.lower(trimmed(F.coalesce(name, F.lit(""))))
    for variant in ("ñ", "¤", "ã±"):
        out = F.replace(out, F.lit(variant), F.lit("n"))
    out = F.when(F.instr(out, "(") > 0, trimmed(F.substring_index(out, "(", 1))).otherwise(out)
    for prefix in PLACE_PREFIXES:
        out = F.when(out.startswith(prefix), F.substr(out, F.lit(len(prefix) + 1))).otherwise(out)
    stem = F.regexp_replace(out, f"{PLACE_SUFFIX}$", "")
    return trimmed(stem)


def edit_ratio(a: Column, b: Column) -> Column:
    """1 minus the Levenshtein distance over the longer length; two empty names are equal."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(1.0)).otherwise(1.0 - F.levenshtein(a, b) / longest)


def priority_band(pctile: Column) -> Column:
    """Band of a percentile rank."""
    # Band limits and labels.
    return (
        F.when(pctile >= 0.9, "90th+")
        .when(pctile >= 0.7, "70–90th")
        .when(pctile >= 0.5, "50–70th")
        .otherwise("Below 50th")
    )
