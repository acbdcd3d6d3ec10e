"""Column expressions used across the library."""

from stellata.functions.dates import parse_mixed_date
from stellata.functions.numbers import (
    avg_half_up,
    dash_to_zero,
    is_bad_number,
    locale_number,
    ratio_half_up,
    to_decimal,
    tolerant_float,
)
from stellata.functions.text import (
    accent_key,
    clean_clock,
    fold_accents,
    ibge_code,
    ibge_name,
    number_text,
    starts_with_code,
    strip_dot_zero,
    strip_ws,
    xml_element,
    xml_escape,
)

__all__ = [
    "accent_key", "avg_half_up", "clean_clock", "dash_to_zero", "fold_accents", "ibge_code",
    "ibge_name", "is_bad_number", "locale_number", "number_text", "parse_mixed_date",
    "ratio_half_up", "starts_with_code", "strip_dot_zero", "strip_ws",
    "to_decimal", "tolerant_float", "xml_element", "xml_escape",
]
