"""Column expressions: all are built-in Spark functions, so they stay inside codegen."""

from logweir.functions.clocks import minute_stamp, numeric_stamp, source_label
from logweir.functions.fields import field_count, file_day, source_dir, split_fields
from logweir.functions.identity import canonical_body, content_id, dense_guid, stable_guid
from logweir.functions.pages import element_text, page_title, parse_price, price_text

__all__ = [
    "canonical_body",
    "content_id",
    "dense_guid",
    "element_text",
    "field_count",
    "file_day",
    "minute_stamp",
    "numeric_stamp",
    "page_title",
    "parse_price",
    "price_text",
    "source_dir",
    "source_label",
    "split_fields",
    "stable_guid",
]
