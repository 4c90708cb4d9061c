from silvermill.functions.casts import lenient_cast, lenient_date
from silvermill.functions.checks import (
    all_known,
    any_unknown,
    equals,
    is_missing,
    typed_literal,
)
from silvermill.functions.json_arrays import element_type, is_malformed, parse_array
from silvermill.functions.parts import (
    part_date,
    part_glob,
    part_seq,
    part_time,
    today,
)

__all__ = [
    "all_known",
    "any_unknown",
    "element_type",
    "equals",
    "is_malformed",
    "is_missing",
    "lenient_cast",
    "lenient_date",
    "parse_array",
    "part_date",
    "part_glob",
    "part_seq",
    "part_time",
    "today",
    "typed_literal",
]
