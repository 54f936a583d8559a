"""Scalar expressions. All are native; null in gives null out unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def none_if_nan(c: Column) -> Column:
    """NaN as null, so that comparisons with it are not true."""
    return F.when(~F.isnan(c), c)


def strain_number(c: Column) -> Column:
    """The number in the last parentheses' "(NT1234)"; null where there is none."""
    return F.nullif(F.regexp_extract(c, r"\((NT\d+)\)", 1), F.lit(""))


def clean_name(c: Column) -> Column:
    """A compound's name without what follows " (" or " [", trimmed on the right, in lower case."""
    return F.lower(F.regexp_replace(F.substring_index(F.substring_index(c, " (", 1), " [", 1), r"\s+$", ""))


def strip_quotes(c: Column) -> Column:
    """Without quotes and square brackets."""
    return F.translate(c, "'[]", "")


def capital_first_two(c: Column, whole_prefix: str) -> Column:
    """The first two words; names that begin with ``whole_prefix`` stay whole."""
    return F.when(c.startswith(whole_prefix), c).otherwise(F.concat_ws(" ", F.slice(F.split(c, " "), 1, 2)))


def fold_underscore(name: Column, suffix: str = "_OD.tsv.gz") -> Column:
    """A file's name without suffix; of three underscores in the name the first is taken out."""
    folded = F.when(F.regexp_count(name, F.lit("_")) == 3, F.regexp_replace(name, "^([^_]*)_", "$1")).otherwise(name)
    return F.regexp_replace(folded, suffix.replace(".", r"\.") + "$", "")


def first_letter(c: Column) -> Column:
    return F.substring(c, 1, 1)


def log_mean(p: Column, when: Column | None = None) -> Column:
    """Log of the geometric mean of ``p`` (an aggregate). A zero makes it -Infinity."""
    chosen = p if when is None else F.when(when, p)
    has_zero = F.coalesce(F.min(chosen), F.lit(1.0)) <= 0
    return F.when(has_zero, F.lit(float("-inf"))).otherwise(F.avg(F.ln(chosen)))


def generation_time(slope: Column) -> Column:
    """ln 2 / slope; 0 for no growth."""
    return F.coalesce(F.try_divide(F.lit(0.6931471805599453), slope), F.lit(0.0))


def logistic(x: Column, top: Column, rate: Column, middle: Column) -> Column:
    return top / (1 + F.exp(-rate * (x - middle)))


def safe_f1(precision: Column, recall: Column) -> Column:
    """Harmonic mean; null where both are zero."""
    return F.try_divide(2 * precision * recall, precision + recall)


def title_case(c: Column) -> Column:
    """Each word's first letter upper case, the rest lower case; words are parted by blanks."""
    return F.initcap(c)


def half_even(c: Column, digits: int = 2) -> Column:
    """Rounded to ``digits``, halves to the even neighbour."""
    return F.bround(c, digits)


def count_label(n: Column, text: str = "n = %d") -> Column:
    """A label such as "n = 12" for figures."""
    return F.format_string(text, n.cast("long"))


def to_params(c: Column) -> Column:
    """A struct or map of settings as JSON text."""
    return F.to_json(c)


def from_params(c: Column, schema: str = "map<string,string>") -> Column:
    """Settings from JSON text; text that is none gives null."""
    return F.from_json(c, schema)


def time_label(c: Column | None = None) -> Column:
    """A time as ``dd.MM.yyyy_HH.mm`` for names of files and models; the current one by default."""
    return F.date_format(F.current_timestamp() if c is None else c, "dd.MM.yyyy_HH.mm")
