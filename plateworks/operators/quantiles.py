"""Exact quantiles by distributed selection.

An exact percentile aggregate holds every distinct value of a group in one buffer. Here each
wanted rank has an interval that is known to hold it. A pass over the rows takes a sketch of
fixed size of the values in the interval and picks two of them on either side of the rank;
the next pass counts the values below, at and between these two, which says exactly where
the rank is: at one of them, and then it is found, or in a part with few of the rows. When a
part has ``SMALL`` rows or fewer, these alone are gathered and sorted. Every pass is one
aggregation with partial results of bounded size, whatever the number of groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import stored

#: Rows of an interval that are gathered in one row at most.
SMALL = 2_000
#: One over the relative rank error of a sketch: each pass leaves some six in so many of the rows.
ACCURACY = 500


def _inside(x: Column, low: Column, high: Column) -> Column:
    """Whether a value is between two bounds, where null is no bound."""
    return (low.isNull() | (x > low)) & (high.isNull() | (x < high))


def quantiles(df: DataFrame, value: str, shares: dict[str, float], groups: list[str] | None = None, small: int | None = None, accuracy: int | None = None) -> DataFrame:
    """A row a group: the group columns, ``n``, and for each name in ``shares`` the exact quantile, interpolated.

    Null and NaN values are left out; a group without values has ``n`` 0 and null quantiles;
    null group keys are a group. Without ``groups`` there is one row, with ``n`` 0 for an empty table.
    """
    groups, small, accuracy = groups or [], SMALL if small is None else small, accuracy or ACCURACY
    keys = [f"_g{k}" for k in range(len(groups))]
    x = F.col(value).cast("double")
    slim = df.select(*(F.col(g).alias(k) for g, k in zip(groups, keys)), F.when(~F.isnan(x), x).alias("_x"))
    slim = stored(slim, "quantile-values")  # two columns, read again by every pass
    # Each quantile lies between two neighbouring ranks.
    sides = [(name, side) for name in shares for side in ("lower", "upper")]
    position = {name: F.lit(share) * (F.col("n") - 1) for name, share in shares.items()}
    rank = {(name, side): F.greatest(F.lit(0), (F.floor if side == "lower" else F.ceil)(position[name])).cast("long") for name, side in sides}
    names = {pair: f"_{pair[0]}_{pair[1]}" for pair in sides}
    state = slim.groupBy(*keys).agg(F.count("_x").alias("n"))
    # Of each rank: rows below the interval, rows in it, its open bounds, and the value once it is found.
    fresh = {}
    for pair, t in names.items():
        fresh |= {f"{t}_k": rank[pair], f"{t}_m": F.col("n"), f"{t}_low": F.lit(None).cast("double"), f"{t}_high": F.lit(None).cast("double"), f"{t}_is": F.lit(None).cast("double")}
    state = stored(state.withColumns(fresh), "quantile-state")

    def joined(state: DataFrame) -> DataFrame:
        if not keys:
            return slim.crossJoin(F.broadcast(state))  # one row
        there = state.withColumnsRenamed({k: f"{k}_" for k in keys})
        on = F.lit(True)
        for k in keys:
            on = on & F.col(k).eqNullSafe(F.col(f"{k}_"))
        return slim.join(there, on).drop(*(f"{k}_" for k in keys))

    def back(state: DataFrame, found: DataFrame) -> DataFrame:
        if not keys:
            return state.crossJoin(F.broadcast(found))
        there = found.withColumnsRenamed({k: f"{k}_" for k in keys})
        on = F.lit(True)
        for k in keys:
            on = on & F.col(k).eqNullSafe(F.col(f"{k}_"))
        return state.join(there, on, "left").drop(*(f"{k}_" for k in keys))

    open_ranks = lambda t: F.col(f"{t}_is").isNull() & (F.col(f"{t}_m") > small)
    while not state.where(" or ".join(f"({t}_is is null and {t}_m > {small})" for t in names.values())).isEmpty():
        # Pass one: two values on either side of the rank, from a sketch of the interval.
        picks = []
        for t in names.values():
            within = F.when(open_ranks(t) & _inside(F.col("_x"), F.col(f"{t}_low"), F.col(f"{t}_high")), F.col("_x"))
            picks.append(F.percentile_approx(within, F.array(*(F.lit(k / accuracy) for k in range(accuracy + 1))), F.lit(4 * accuracy)).alias(f"{t}_grid"))
        grid = joined(state).groupBy(*keys).agg(*picks)
        near = back(state, grid)
        for t in names.values():
            at = F.floor(F.lit(accuracy) * F.col(f"{t}_k") / F.greatest(F.col(f"{t}_m") - 1, F.lit(1))).cast("int")
            # get() counts from zero and gives null beyond the ends, where the interval's bounds hold.
            near = near.withColumns({f"{t}_p": F.get(f"{t}_grid", F.greatest(at - 1, F.lit(0))), f"{t}_q": F.get(f"{t}_grid", F.least(at + 2, F.lit(accuracy)))}).drop(f"{t}_grid")
        near = stored(near, "quantile-picks")
        # Pass two: exact counts of the parts.
        counts = []
        for t in names.values():
            p, q, within = F.col(f"{t}_p"), F.col(f"{t}_q"), _inside(F.col("_x"), F.col(f"{t}_low"), F.col(f"{t}_high"))
            counts += [F.count_if(within & (F.col("_x") < p)).alias(f"{t}_below"), F.count_if(F.col("_x") == p).alias(f"{t}_at_p"), F.count_if(F.col("_x") == q).alias(f"{t}_at_q"), F.count_if((F.col("_x") > p) & (F.col("_x") < q)).alias(f"{t}_between")]
        parts = back(near, joined(near).groupBy(*keys).agg(*counts))
        moved = {}
        for t in names.values():
            p, q, k = F.col(f"{t}_p"), F.col(f"{t}_q"), F.col(f"{t}_k")
            to_p = F.col(f"{t}_below")
            past_p = to_p + F.col(f"{t}_at_p")
            to_q = past_p + F.col(f"{t}_between")
            past_q = F.when(p == q, past_p).otherwise(to_q + F.col(f"{t}_at_q"))
            where = lambda a, b, c, d, e, t=t, k=k, to_p=to_p, past_p=past_p, to_q=to_q, past_q=past_q: F.when(~open_ranks(t), F.col(e)).when(k < to_p, a).when(k < past_p, b).when(k < to_q, c).otherwise(d)
            at_q = lambda found, past, k=k, past_q=past_q: F.when(k < past_q, found).otherwise(past)
            low, high, m = F.col(f"{t}_low"), F.col(f"{t}_high"), F.col(f"{t}_m")
            moved |= {
                f"{t}_k": where(k, k, k - past_p, at_q(k, k - past_q), f"{t}_k"),
                f"{t}_m": where(to_p, F.lit(1).cast("long"), F.col(f"{t}_between"), at_q(F.lit(1).cast("long"), m - past_q), f"{t}_m"),
                f"{t}_low": where(low, low, p, at_q(low, q), f"{t}_low"),
                f"{t}_high": where(p, high, q, at_q(high, high), f"{t}_high"),
                f"{t}_is": where(F.lit(None), p, F.lit(None), at_q(q, F.lit(None)), f"{t}_is"),
            }
        state = stored(parts.withColumns(moved).select(*state.columns), "quantile-state")
    # The few rows of intervals that are still open, sorted.
    rest = []
    for t in names.values():
        within = F.col(f"{t}_is").isNull() & _inside(F.col("_x"), F.col(f"{t}_low"), F.col(f"{t}_high"))
        rest.append(F.sort_array(F.collect_list(F.when(within, F.col("_x")))).alias(f"{t}_rest"))
    done = back(state, joined(state).groupBy(*keys).agg(*rest))
    value_of = {pair: F.coalesce(F.col(f"{t}_is"), F.get(f"{t}_rest", F.col(f"{t}_k").cast("int"))) for pair, t in names.items()}
    out = []
    for name in shares:
        lower, upper = value_of[name, "lower"], value_of[name, "upper"]
        out.append((lower + (upper - lower) * (position[name] - F.floor(position[name]))).alias(name))
    return done.select(*(F.col(k).alias(g) for g, k in zip(groups, keys)), "n", *out)
