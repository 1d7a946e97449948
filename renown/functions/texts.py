"""Texts that feed the encoder and the region naming."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from renown.functions.titles import strip_blanks

# Shortest lead that stands alone, longest label document.
MIN_LEAD_CHARS = 40
LABEL_DOCUMENT_CHARS = 2000


def _filled(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def embed_text(title: Column, description: Column, lead: Column) -> Column:
    """The lead if long enough, else title and description, else the title."""
    lead = strip_blanks(_filled(lead))
    description = strip_blanks(_filled(description))
    return (
        F.when(F.char_length(lead) >= MIN_LEAD_CHARS, lead)
        .when(description != "", F.concat(title, F.lit(". "), description))
        .otherwise(title)
    )


def label_document(title: Column, description: Column, lead: Column) -> Column:
    """Title, description and lead in one text of bounded length."""
    head = F.when(
        _filled(description) != "", F.concat(title, F.lit(" -- "), description)
    ).otherwise(title)
    whole = F.when(_filled(lead) != "", F.concat(head, F.lit("\n"), lead)).otherwise(head)
    return F.substring(whole, 1, LABEL_DOCUMENT_CHARS)


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
