"""Sources, sinks, casts and table schemas."""

from .csv_dialect import BadRowsError
from .io import (PANDAS_NA_TOKENS, cast_columns, null_tokens_to_null, read_table,
                 write_table)
from .ordinal import file_ordinal, first_rows
from .schemas import CREDIT_SCHEMAS

__all__ = ["BadRowsError", "PANDAS_NA_TOKENS", "cast_columns", "file_ordinal", "first_rows", "null_tokens_to_null",
           "read_table", "write_table", "CREDIT_SCHEMAS"]
