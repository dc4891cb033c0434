from stallkeep.functions.calendar import (
    date_key,
    iso_weekday,
    jalali_date,
    jalali_parts,
    with_gregorian_attributes,
    with_jalali_attributes,
)
from stallkeep.functions.flags import flag, flag_unless_null, matches
from stallkeep.functions.text import city_key, folded, is_blank, text_length

__all__ = [
    "city_key",
    "date_key",
    "flag",
    "flag_unless_null",
    "folded",
    "is_blank",
    "iso_weekday",
    "jalali_date",
    "jalali_parts",
    "matches",
    "text_length",
    "with_gregorian_attributes",
    "with_jalali_attributes",
]
