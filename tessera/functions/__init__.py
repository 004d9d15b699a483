"""Column-expression helpers: every one returns a built-in Spark Column, so
all of them stay inside whole-stage codegen (no Python UDFs)."""

from tessera.functions.expressions import (
    ALPHA_WORD,
    cosine_score,
    int_mean,
    is_alpha_word,
    jvm_trim,
    other_item,
    rstrip_ws,
    tenths_celsius_to_fahrenheit_f32,
    trimmed_split,
)

__all__ = [
    "ALPHA_WORD",
    "cosine_score",
    "int_mean",
    "is_alpha_word",
    "jvm_trim",
    "other_item",
    "rstrip_ws",
    "tenths_celsius_to_fahrenheit_f32",
    "trimmed_split",
]
