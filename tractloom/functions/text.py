"""Text normalisation for location rows, and the pattern predicates of task manifests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of governed identifiers and of content that a manifest must not carry.
TASK = "(?:GOV|DATA|MODEL|GEO|BI|PIPE|STORE|MARKETS|INTEGRATION|DEPLOY|VALIDATE)-[0-9]{2}[A-Z]?"
PATTERNS = {
    "task_id": rf"\A{TASK}\z",
    "branch": r"\Atask/[a-z]+-[0-9]{2}[a-z]?(?:-[a-z0-9]+)+\z",
    "commit_message": rf"\A{TASK}: [a-z].+\z",
    "pr_title": rf"\A{TASK}: \S.*\z",
    "logical_artifact": r"\A[A-Z]+[0-9]{2}[A-Z]?_[A-Z0-9_]+_V[1-9][0-9]*\z",
    "protected_logical_id": r"\APROTECTED_[A-Z0-9_]+(?:_V[1-9][0-9]*)?\z",
    "absolute_path": r"\A(?:[A-Za-z]:[\\/]|\\\\|/|~[\\/])",
    "sha256": r"\b[a-fA-F0-9]{64}\b",
    "coordinate_pair": r"\b-?[0-9]{1,3}\.[0-9]{4,}\s*,\s*-?[0-9]{1,3}\.[0-9]{4,}\b",
}


def text(c: Column) -> Column:
    """Trimmed text, '' for null."""
    return F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"\A\s+|\s+\z", "")


def normalised(c: Column) -> Column:
    """Lower case without anything but a-z and 0-9."""
    return F.regexp_replace(F.lower(text(c)), "[^a-z0-9]", "")


def header(c: Column) -> Column:
    return F.regexp_replace(F.lower(text(c)), "[^a-z0-9_]", "")


def first_year(c: Column) -> Column:
    """The first year from 1900 to 2099 anywhere in the text, null without one."""
    found = F.regexp_extract(text(c), "((?:19|20)[0-9]{2})", 1)
    return F.when(found != "", found.cast("int"))


def only_year(c: Column) -> Column:
    """The one year that stands apart from other digits; null if there is none or more than one."""
    found = F.regexp_extract_all(text(c), F.lit("(?<![0-9])((?:19|20)[0-9]{2})(?![0-9])"), 1)
    return F.when(F.size(found) == 1, found[0].cast("int"))


def market(source: Column, city: Column) -> Column:
    """milwaukee or madison by what the market and city say, the first if both; null if neither."""
    both = F.concat(normalised(source), normalised(city))
    return F.when(both.contains("milwaukee"), "milwaukee").when(both.contains("madison"), "madison")


def decimals(shown: Column) -> Column:
    """Decimal places of a number as shown, trailing zeros left out; 0 without a point."""
    s = text(shown)
    return F.when(s.contains("."), F.length(F.regexp_replace(F.substring_index(s, ".", -1), "0+\\z", ""))).otherwise(0)


def is_governed(c: Column, kind: str) -> Column:
    return F.coalesce(c.rlike(PATTERNS[kind]), F.lit(False))
