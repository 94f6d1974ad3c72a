"""Column-to-column helpers: JSON nodes, codes and ids, timestamps, text."""

from .codes import (
    asset_name,
    codes_by_digits,
    codes_by_position,
    codes_by_type,
    federated_id,
    strip_at,
)
from .nodes import (
    as_node,
    class_int,
    elements_of,
    explode_elements,
    first_object,
    flag01,
    flag_text,
    input_sorted_text,
    is_number,
    is_object,
    is_text_or_absent,
    is_true_literal,
    json_or_default,
    json_or_null,
    json_text,
    member,
    open_keys,
    truthy,
    typed,
    value_to_string,
)
from .text import clean_name, join_pairs, join_texts, strip_space, text_or_empty
from .times import brazil_time, day_of, ts_from_iso, ts_from_millis, ts_from_xml

__all__ = [
    "as_node",
    "asset_name",
    "brazil_time",
    "class_int",
    "clean_name",
    "codes_by_digits",
    "codes_by_position",
    "codes_by_type",
    "day_of",
    "elements_of",
    "explode_elements",
    "federated_id",
    "first_object",
    "flag01",
    "flag_text",
    "input_sorted_text",
    "is_number",
    "is_object",
    "is_text_or_absent",
    "is_true_literal",
    "join_pairs",
    "join_texts",
    "json_or_default",
    "json_or_null",
    "json_text",
    "member",
    "open_keys",
    "strip_at",
    "strip_space",
    "text_or_empty",
    "truthy",
    "ts_from_iso",
    "ts_from_millis",
    "ts_from_xml",
    "typed",
    "value_to_string",
]
