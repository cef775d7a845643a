"""String normalisation as JVM-side column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, functions as F

# Accented letters and their plain forms, and the markers that
# stand for "no value" in the source files.
ACCENTED = "áàâãéèêíìîóòôõúùûçÁÀÂÃÉÈÊÍÌÎÓÒÔÕÚÙÛÇ"
PLAIN = "aaaaeeeiiioooouuucAAAAEEEIIIOOOOUUUC"
SENTINELS = ("-", "...", "X")

# Marks that source spellings use but the table above leaves alone.
EXTRA_MARKED = "üÜªº´’"
EXTRA_PLAIN = "uUao''"


def strip_accents(col: Column, fold_marks: bool = False) -> Column:
    """Replace accented letters; ``fold_marks`` also folds ü, ª, º and acute quotes."""
    if fold_marks:
        return F.translate(col, ACCENTED + EXTRA_MARKED, PLAIN + EXTRA_PLAIN)
    return F.translate(col, ACCENTED, PLAIN)


def strip_accents_name(name: str) -> str:
    """The same idea for column names, which live on the driver."""
    decomposed = unicodedata.normalize("NFD", name)
    return "".join(ch for ch in decomposed if unicodedata.category(ch) != "Mn")


def collapse_spaces(col: Column) -> Column:
    """Runs of white space (no-break space included) become one blank; ends trimmed."""
    return F.trim(F.regexp_replace(col, r"[\s ]+", " "))


def slug(col: Column) -> Column:
    """Comparable form of a place name.

    One definition serves both the policies and the geography dimensions, so
    the two sides of a join cannot drift apart.
    """
    joined = F.regexp_replace(F.lower(F.trim(col)), r"\s+", "_")
    # Hyphens join like spaces; what has no counterpart (the apostrophe) goes.
    return F.regexp_replace(F.translate(joined, ACCENTED + "ü-'", PLAIN + "u_"), "th", "t")
