from tidemark.functions.text import (
    NA_TOKENS,
    decoded_file_name,
    deletion_variants,
    fill_template,
    na_to_null,
    normalise_text,
    template_fields,
)
from tidemark.functions.time import day_of, hour_label, seconds_between

__all__ = [
    "NA_TOKENS",
    "day_of",
    "decoded_file_name",
    "deletion_variants",
    "fill_template",
    "hour_label",
    "na_to_null",
    "normalise_text",
    "seconds_between",
    "template_fields",
]
