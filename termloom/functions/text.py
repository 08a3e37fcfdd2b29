"""Column expressions on text, arrays, numbers and keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The token pattern, and the characters replaced by ``_`` in file names.
TOKEN_PATTERN = "[a-z]{3,}"
UNSAFE_FILE_CHARACTERS = "|?'\"#*%"

# Error texts with a code of their own.
ERROR_CODES = {
    "Could not abstract subset for checksum": "nodata-",
    "Too many duplicate records ": "duplicate-",
}


def tokens(text: Column) -> Column:
    """All runs of three or more ASCII letters of the lower-cased text."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))


def clean_name(name: Column) -> Column:
    """Letters, digits, ``_`` and ``-`` in lower case; never starts with ``_`` or ``-``."""
    kept = F.lower(F.regexp_replace(name, "[^A-Za-z0-9_-]", ""))
    return F.when(kept.rlike("^[_-]"), F.concat(F.lit("u"), kept)).otherwise(kept)


def file_safe(name: Column) -> Column:
    return F.translate(name, UNSAFE_FILE_CHARACTERS, "_" * len(UNSAFE_FILE_CHARACTERS))


def error_code(message: Column) -> Column:
    """Short folder name for an error text."""
    short = F.regexp_replace(F.lower(message), "[^a-z0-9]", "")
    long = F.regexp_replace(F.substring(message, 1, 24), "[^A-Za-z0-9]", "")
    code = F.when(F.length(message) < 25, short).otherwise(long)
    for text, known in ERROR_CODES.items():
        code = F.when(message == text, known).otherwise(code)
    return code


def between_marks(text: Column, start: str, end: str) -> Column:
    """The text between two marks, or null when either is missing."""
    found = F.regexp_extract(text, f"{_quoted(start)}(.*?){_quoted(end)}", 1)
    return F.when(text.contains(start) & text.contains(end), found)


def _quoted(mark: str) -> str:
    return "".join("\\" + ch if not ch.isalnum() else ch for ch in mark)


def any_of(predicates: Sequence[Column]) -> Column:
    """True when one of the predicates is; false for an empty list."""
    return reduce(or_, predicates, F.lit(False))


def try_number(value: Column, kind: str = "double") -> Column:
    return value.try_cast(kind)


def decimal_text(value: Column) -> Column:
    """A double as fixed text, equal in every engine."""
    return value.cast("decimal(18,6)").cast("string")


def valid_uuid(value: Column) -> Column:
    return F.coalesce(F.length(value) >= 12, F.lit(False))


def id_or_new(value: Column) -> Column:
    """Keep a usable id, else make a random one."""
    return F.when(F.length(F.trim(value)) > 0, value).otherwise(F.uuid())


def sorted_pairs(indices: Column, values: Column) -> Column:
    """Zip index and value arrays into structs ordered by index."""
    return F.array_sort(F.arrays_zip(indices.alias("idx"), values.alias("value")))


def value_at(indices: Column, values: Column, index: Column) -> Column:
    """The value stored for an index, null when the row does not hold it."""
    return F.try_element_at(F.map_from_arrays(indices, values), index)


def has_all(items: Column, wanted: Sequence) -> Column:
    return reduce(lambda a, b: a & b, [F.array_contains(items, w) for w in wanted], F.lit(True))


def label_without_dash(label: Column) -> Column:
    return F.regexp_replace(label, "-$", "")


def select_by_name(df: DataFrame, keep) -> DataFrame:
    """Project the columns whose name satisfies a predicate."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if keep(c)])


def cast_typed_columns(df: DataFrame, from_type: str, to_type: str) -> DataFrame:
    """Cast every column of one type to another."""
    kinds = dict(df.dtypes)
    return df.select(*[F.col(c).cast(to_type).alias(c) if kinds[c] == from_type else F.col(c) for c in df.columns])


def split_column(df: DataFrame, column: str, separator: str, names: Sequence[str]) -> DataFrame:
    """Replace a delimited column by one column per part."""
    parts = F.split(F.col(column), separator)
    others = [F.col(c) for c in df.columns if c != column]
    return df.select(*others, *[F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)])
