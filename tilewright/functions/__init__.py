from tilewright.functions.columns import (
    byte_length,
    contains_ignore_case,
    exact_kb,
    quoted,
    size_class,
    tile_count,
    whole_average,
)

__all__ = [
    "byte_length",
    "contains_ignore_case",
    "exact_kb",
    "quoted",
    "size_class",
    "tile_count",
    "whole_average",
]
