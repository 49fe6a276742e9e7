"""Identifiers: padded ids, natural keys and name-based UUIDs, all without a UDF."""

from __future__ import annotations

from uuid import UUID

from pyspark.sql import Column, functions as F

from ._args import ColumnOrName, as_column
from .text import strip_spaces

# Identity namespace, widths of the two ids, base of the supplier page.
IDENTITY_NAMESPACE = "ff87d414-20d1-51d7-8722-661d1863e10e"
NATIONAL_ID_WIDTH = 8
TAX_ID_WIDTH = 11
SUPPLIER_PAGE = "https://apps.osce.gob.pe/perfilprov-ui/ficha"

_HEX = "0123456789abcdef"
_UUID_VARIANT = "89ab89ab89ab89ab"


def pad_zeros(text: Column, width: int) -> Column:
    """Zeros on the left up to ``width``; longer text is kept whole (lpad would cut it)."""
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def normalize_national_id(value: ColumnOrName) -> Column:
    """Null to empty, a trailing ``.0`` dropped, padded to eight."""
    text = F.coalesce(as_column(value).cast("string"), F.lit(""))
    return pad_zeros(F.regexp_replace(text, r"\.0\z", ""), NATIONAL_ID_WIDTH)


def normalize_tax_id(value: ColumnOrName) -> Column:
    """Digits only, padded to eleven; null stays null."""
    return pad_zeros(F.regexp_replace(as_column(value).cast("string"), r"[^\p{Nd}]", ""), TAX_ID_WIDTH)


def is_national_id(value: ColumnOrName) -> Column:
    return F.coalesce(as_column(value).rlike(r"^[0-9]{8}\z"), F.lit(False))


def is_tax_id(value: ColumnOrName) -> Column:
    """A request for a tax id is valid if, without white space around it, it has exactly eleven digits."""
    return F.coalesce(strip_spaces(value).rlike(r"^[0-9]{11}\z"), F.lit(False))


def names_company(tax_id: ColumnOrName) -> Column:
    """Whether a tax id says anything: junk without digits is padded to zeros only."""
    return F.coalesce(as_column(tax_id).rlike("[1-9]"), F.lit(False))


def natural_key(*parts: ColumnOrName) -> Column:
    return F.concat_ws("|", *[F.coalesce(as_column(p), F.lit("")) for p in parts])


def uuid5(seed: ColumnOrName, namespace: str = IDENTITY_NAMESPACE) -> Column:
    """RFC 4122 version-5 UUID of a text."""
    message = F.concat(F.unhex(F.lit(UUID(namespace).hex)), F.encode(as_column(seed), "UTF-8"))
    digest = F.sha1(message)
    return F.concat(
        F.substring(digest, 1, 8),
        F.lit("-"),
        F.substring(digest, 9, 4),
        F.lit("-5"),
        F.substring(digest, 14, 3),
        F.lit("-"),
        F.translate(F.substring(digest, 17, 1), _HEX, _UUID_VARIANT),
        F.substring(digest, 18, 3),
        F.lit("-"),
        F.substring(digest, 21, 12),
    )


def global_id(national_id: ColumnOrName, key: ColumnOrName, namespace: str = IDENTITY_NAMESPACE) -> Column:
    """Identity of a person: from the id where it has eight digits, else from the natural key."""
    seed = F.when(is_national_id(national_id), as_column(national_id)).otherwise(
        F.coalesce(as_column(key), F.lit(""))
    )
    return uuid5(seed, namespace)


def supplier_page(tax_id: ColumnOrName, base: str = SUPPLIER_PAGE) -> Column:
    return F.concat(F.lit(base + "/"), as_column(tax_id))
