from .scalar import (
    action,
    folder_value,
    instant,
    instant_of_millis,
    iso_utc,
    let,
    not_blank,
    number,
    row_hash,
    row_hash_plain,
    utc_day,
    wall_clock_utc,
)

__all__ = [
    "action", "folder_value", "instant", "instant_of_millis", "iso_utc", "let", "not_blank",
    "number",
    "row_hash", "row_hash_plain", "utc_day", "wall_clock_utc",
]
