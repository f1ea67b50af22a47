from quayside.functions.quoting import (
    encode_columns, encode_csv, field_tokens, is_blank_record, quote_all, split_fields, split_pattern, split_quoted,
)
from quayside.functions.scalars import (
    comparable,
    comparable_number,
    compression_ratio,
    display_mtime,
    display_stamp,
    file_stamp,
    keyword_match,
    severity,
    size_label,
    size_mb_label,
)

__all__ = [
    "comparable", "comparable_number", "compression_ratio", "display_mtime", "display_stamp",
    "encode_columns", "encode_csv", "file_stamp", "is_blank_record", "keyword_match", "quote_all", "severity",
    "size_label", "size_mb_label", "field_tokens", "split_fields", "split_pattern", "split_quoted",
]
