from stellate.functions.casts import cast_loss_report, tolerant_cast
from stellate.functions.dates import (
    DAY_NUMBER_EPOCH,
    date_parts,
    date_to_day_number,
    day_number_to_date,
    parse_date,
)

__all__ = [
    "DAY_NUMBER_EPOCH",
    "cast_loss_report",
    "date_parts",
    "date_to_day_number",
    "day_number_to_date",
    "parse_date",
    "tolerant_cast",
]
