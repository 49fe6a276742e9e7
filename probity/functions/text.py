"""Text cleaning as Column functions: every one is built-in Spark SQL only."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ._args import ColumnOrName, as_column

# The forty accented vowels that are folded, and their plain forms.
# Ñ and ç are letters of their own and stay as they are.
ACCENTED_VOWELS = "ÁÀÄÂÉÈËÊÍÌÏÎÓÒÖÔÚÙÜÛáàäâéèëêíìïîóòöôúùüû"
PLAIN_VOWELS = "AAAAEEEEIIIIOOOOUUUUaaaaeeeeiiiioooouuuu"

# Legal-form words dropped from company names.
LEGAL_FORMS = ["SAC", "SA", "EIRL", "SRL", "SRLTDA", "S C R L", "SCRL"]

# (?U) makes \s and \b follow Unicode, so that no-break spaces count as spaces.
_SPACES = r"(?U)\s+"
_OUTER_SPACES = r"(?U)^\s+|\s+\z"
_LEGAL_FORM_WORD = r"(?U)\b(" + "|".join(LEGAL_FORMS) + r")\b"
_WORD_OR_GAP = r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"


def fold_accents(text: ColumnOrName) -> Column:
    return F.translate(as_column(text), ACCENTED_VOWELS, PLAIN_VOWELS)


def collapse_spaces(text: ColumnOrName) -> Column:
    """Runs of white space become one blank; none is left at either end."""
    return F.trim(F.regexp_replace(as_column(text), _SPACES, " "))


def strip_spaces(text: ColumnOrName) -> Column:
    """White space dropped at both ends; inner runs are kept."""
    return F.regexp_replace(as_column(text), _OUTER_SPACES, "")


def title_case(text: ColumnOrName) -> Column:
    """Capital after every character that is neither letter nor digit: ``O'Brien``."""

    def capitalize(piece: Column) -> Column:
        # not initcap, which would make "Ss" of a leading ß
        return F.concat(F.upper(F.substring(piece, 1, 1)), F.lower(F.substr(piece, F.lit(2))))

    pieces = F.regexp_extract_all(as_column(text), F.lit(_WORD_OR_GAP), F.lit(1))
    return F.array_join(F.transform(pieces, capitalize), "")


def standardize_text(text: ColumnOrName, casing: str = "upper") -> Column:
    """Null to empty, vowels folded, spaces collapsed, then ``upper``/``title``/``none``."""
    text = as_column(text).cast("string")
    clean = collapse_spaces(fold_accents(F.coalesce(text, F.lit(""))))
    casing = casing.lower()
    if casing == "upper":
        return F.upper(clean)
    if casing == "title":
        return title_case(clean)
    return clean


def flat_name(text: ColumnOrName) -> Column:
    """The lower-case form of a name that goes into a natural key."""
    return F.lower(standardize_text(text, casing="none"))


def normalize_company(name: ColumnOrName) -> Column:
    """Upper case without ``. , ;`` and legal-form words; null stays null."""
    plain = F.regexp_replace(F.upper(as_column(name)), "[.,;]", "")
    return collapse_spaces(F.regexp_replace(plain, _LEGAL_FORM_WORD, ""))


def join_context(*parts: ColumnOrName) -> Column:
    """Several text dimensions as one searchable text; null counts as empty."""
    return F.concat_ws(" \n ", *[F.coalesce(as_column(p), F.lit("")) for p in parts])
