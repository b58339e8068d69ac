"""Column-level functions: casts, name/code cleaning, nested access, flattening."""

from terrapipe.functions.clean import (
    clean_code,
    clean_title,
    first_present,
    flatten,
    has_path,
    optional_path,
    to_int,
)

__all__ = [
    "clean_code", "clean_title", "first_present", "flatten", "has_path",
    "optional_path", "to_int",
]
