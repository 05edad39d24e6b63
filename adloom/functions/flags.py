"""The click and purchase flags. Sources spell them differently, and the spellings
are kept apart on purpose: each mart counts exactly what its source counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adloom.functions.text import strip

# Accepted spellings per dialect.
TRUTHY = ("1", "True", "true")
TRUTHY_STRICT = ("1", "True")
VERIFIED_ANY = ("1", "Y", "y")
VERIFIED_YES = "Y"


def clicked_truthy(flag: Column) -> Column:
    return F.coalesce(flag.isin(*TRUTHY), F.lit(False))


def clicked_strict(flag: Column) -> Column:
    return F.coalesce(flag.isin(*TRUTHY_STRICT), F.lit(False))


def clicked_word(flag: Column) -> Column:
    """Only the word true, in any case and padding; the digit 1 is no click here."""
    return F.coalesce(F.lower(strip(flag)) == "true", F.lit(False))


def verified_any(flag: Column) -> Column:
    return flag.isin(*VERIFIED_ANY)


def verified_yes(flag: Column) -> Column:
    return flag == VERIFIED_YES
