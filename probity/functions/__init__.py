"""Column functions usable in any DataFrame."""

from .identifiers import (
    global_id,
    is_national_id,
    is_tax_id,
    names_company,
    natural_key,
    normalize_national_id,
    normalize_tax_id,
    pad_zeros,
    supplier_page,
    uuid5,
)
from .lists import list_count, list_sum, public_experience, sum_across, without_nulls
from .numbers import clean_money, parse_money, round_half_up, to_double, to_long
from .scoring import (
    is_cold_start,
    legal_score,
    risk_flags,
    risk_index,
    robust_score,
    stability_score,
    wealth_ratio,
)
from .text import (
    collapse_spaces,
    flat_name,
    fold_accents,
    join_context,
    normalize_company,
    standardize_text,
    strip_spaces,
    title_case,
)

