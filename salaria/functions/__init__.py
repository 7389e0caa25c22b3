"""Column expressions (built-in Spark functions only, whole-stage codegen)."""

from salaria.functions.numbers import strict_int, total_pay, wrap_int32
from salaria.functions.text import field, java_trim, split_fields

__all__ = ["field", "java_trim", "split_fields", "strict_int", "total_pay", "wrap_int32"]
