"""Column functions."""

from cubelake.functions.columns import (  # noqa: F401
    blank_if_null,
    digits_only,
    file_name,
    format_release_time,
    in_uint8_range,
    is_null_spelling,
    parse_release_time,
    product_id_from_name,
    ref_year,
    scaled_delta_value,
    scaled_value,
    url_basename,
)
from cubelake.functions.typing import cast_text, guard, is_string_override, value_type  # noqa: F401
