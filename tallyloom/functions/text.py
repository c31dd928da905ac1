"""String rules of the ledgers as native column expressions (no Python per row)."""

from pyspark.sql import Column, functions as F

from tallyloom.fixed_values import WHITESPACE

# A run of cased letters, the unit Python's str.title works on.
_CASED_RUN = r"[\p{IsLowercase}\p{IsUppercase}\p{Lt}]+|[^\p{IsLowercase}\p{IsUppercase}\p{Lt}]+"


def trim_py(text: Column) -> Column:
    """``str.strip``: Spark's plain ``trim`` removes blanks only."""
    return F.btrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    """True for null and for text of white space only."""
    return F.coalesce(F.length(trim_py(text)) == 0, F.lit(True))


def title_py(text: Column) -> Column:
    """``str.title``: every run of cased letters starts upper case (``initcap`` splits on blanks only)."""
    runs = F.regexp_extract_all(text, F.lit(_CASED_RUN), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")


def key_of(*parts, sep: str = ".") -> Column:
    """Composite key text such as ``tab.property`` or ``name::field``."""
    return F.concat_ws(sep, *[p if isinstance(p, Column) else F.lit(p) for p in parts])
