"""Column functions, and their registration for SQL."""

from .scalars import (  # noqa: F401
    capital_first_two,
    clean_name,
    first_letter,
    fold_underscore,
    count_label,
    from_params,
    generation_time,
    half_even,
    log_mean,
    logistic,
    none_if_nan,
    safe_f1,
    strain_number,
    strip_quotes,
    time_label,
    title_case,
    to_params,
)
from .vectors import bit_distance, bits_of, cosine_distance, hamming_share, one_hot, set_bits  # noqa: F401


def register(spark) -> None:
    """Make the expressions available in SQL, as SQL functions (no Python in the plan)."""
    for text in (
        "create or replace temporary function strain_number(s string) returns string return nullif(regexp_extract(s, '\\\\((NT[0-9]+)\\\\)', 1), '')",
        "create or replace temporary function clean_name(s string) returns string return lower(regexp_replace(substring_index(substring_index(s, ' (', 1), ' [', 1), '\\\\s+$', ''))",
        "create or replace temporary function bit_similarity(a bigint, b bigint) returns double return coalesce(try_divide(cast(bit_count(a & b) as double), bit_count(a | b)), 1.0D)",
        "create or replace temporary function cosine_distance(a array<double>, b array<double>) returns double return 1 - try_divide(aggregate(zip_with(a, b, (x, y) -> x * y), 0.0D, (s, v) -> s + v), sqrt(aggregate(a, 0.0D, (s, v) -> s + v * v)) * sqrt(aggregate(b, 0.0D, (s, v) -> s + v * v)))",
        "create or replace temporary function generation_time(slope double) returns double return coalesce(try_divide(ln(2.0D), slope), 0.0D)",
        "create or replace temporary function logistic(x double, top double, rate double, middle double) returns double return top / (1 + exp(-rate * (x - middle)))",
    ):
        spark.sql(text)
