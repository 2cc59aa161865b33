"""Column expressions: text normalisation, tolerant number parsing, null predicates."""

from cleargrist.functions.columns import named
from cleargrist.functions.numbers import tolerant_double, tolerant_int
from cleargrist.functions.predicates import all_null, any_null
from cleargrist.functions.text import normalize_text

__all__ = ["all_null", "any_null", "named", "normalize_text", "tolerant_double", "tolerant_int"]
