"""Registered queries on running sums, exact quantiles, nearest times, pruned neighbours and bit sets, and on small functions; with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import scalars, tables, vectors
from ..operators import asof, bitjoin, compare, embedding, library, metrics, neighbours, ordered, plates, quantiles, reshape
from .catalog import DIST, QUERIES, curves, query, read, rounded

# ---- orders of all rows


@query("select o_orderkey, row_number() over (order by o_totalprice desc, o_orderkey) as place from orders")
def order_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered.ordered_ranks(read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")], "place").select("o_orderkey", "place")


@query("select o_orderkey, cast(sum(cents) over (order by o_orderdate, o_orderkey) - cents as bigint) as cents_before from (select *, cast(round(o_totalprice * 100) as bigint) as cents from orders)")
def running_revenue(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", F.round(F.col("o_totalprice") * 100).cast("long").alias("cents"))
    sums = ordered.ordered_sums(o, [F.asc("o_orderdate"), F.asc("o_orderkey")], {"before": F.col("cents")})
    return sums.select("o_orderkey", F.col("before").alias("cents_before"))


@query("select l_returnflag, l_linestatus, count(*) as n, round(quantile_cont(l_extendedprice, 0.1), 6) as p10, round(quantile_cont(l_extendedprice, 0.5), 6) as p50, round(quantile_cont(l_extendedprice, 0.9), 6) as p90, round(quantile_cont(l_extendedprice, 0.999), 6) as p999 from lineitem group by 1, 2")
def price_quantiles(spark, sf_dir):
    found = quantiles.quantiles(read(spark, sf_dir, "lineitem"), "l_extendedprice", {"p10": 0.1, "p50": 0.5, "p90": 0.9, "p999": 0.999}, ["l_returnflag", "l_linestatus"])
    return rounded(found, "p10", "p50", "p90", "p999")


# ---- nearest times

MOVED = "select o_orderkey, o_orderdate + (2024 - year(o_orderdate)) * interval 1 year as t from orders"


@query(f"""with o as ({MOVED}), b as (select o.o_orderkey, o.t, e.ts from o asof left join (select distinct ts from events) e on o.t >= e.ts),
  n as (select b.*, e.ts as ts2 from b asof left join (select distinct ts from events) e on b.t <= e.ts),
  d as (select *, epoch_us(t) - epoch_us(ts) as d1, epoch_us(ts2) - epoch_us(t) as d2 from n)
  select o_orderkey, event_id, cast(least(d1, d2) as bigint) as apart from d join events e on (e.ts = d.ts and d1 = least(d1, d2)) or (e.ts = d.ts2 and d2 = least(d1, d2) and d1 is distinct from 0)""")
def orders_nearest_event(spark, sf_dir):
    """The events nearest to every order's day, orders moved to the year of the events."""
    o = read(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderdate").cast("timestamp") + F.make_ym_interval(F.lit(2024) - F.year("o_orderdate"))).alias("t"))
    e = read(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    near = asof.nearest_time_join(o, e, "t", "ts")
    return near.select("o_orderkey", F.col("near_event_id").alias("event_id"), F.abs(F.unix_micros("near_ts") - F.unix_micros("t")).alias("apart"))


@query("""with p as (select event_id, user_id, ts from events where event_type = 'purchase'), c as (select event_id, user_id, ts from events where event_type = 'click'),
  b as (select p.event_id, p.user_id, c.ts from p asof left join (select distinct user_id, ts from c) c on p.user_id = c.user_id and p.ts >= c.ts)
  select b.event_id, coalesce(c.event_id, -1) as click_id from b left join c on b.user_id = c.user_id and b.ts = c.ts and epoch_us(b.ts) is not null""")
def purchase_last_click(spark, sf_dir):
    """Each purchase with the same user's last click at or before it, -1 without one."""
    e = read(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    near = asof.nearest_time_join(e.where("event_type = 'purchase'"), e.where("event_type = 'click'"), "ts", "ts", {"user_id": "user_id"}, "backward")
    return near.select("event_id", F.coalesce("near_event_id", F.lit(-1).cast("long")).alias("click_id"))


# ---- neighbours

NEAR_SQL = f"with {DIST.replace(' and r.vec_id <> q.vec_id', '')}, r as (select *, row_number() over (partition by query_id order by round(cosine_dist, 9), ref_id) as rank from dist) select query_id, ref_id, round(cosine_dist, 6) + 0.0 as cosine_dist, rank from r where rank <= 11"


@query(NEAR_SQL)
def neighbours_pruned(spark, sf_dir):
    """The ten nearest of every compound with an id divisible by 100, and itself."""
    e = read(spark, sf_dir, "embeddings")
    return rounded(neighbours.nearest_pruned(e.where("vec_id % 100 = 0"), e, "vec_id", "embedding", 11), "cosine_dist")


@query("""with b as (select vec_id, list_transform(embedding, lambda x: case when x > 0 then 1.0::double else 0.0::double end) as s from embeddings), n as (select *, cast(list_sum(s) as bigint) as n from b),
  p as (select a.vec_id as i, b.vec_id as j, a.n as n, b.n as m, list_dot_product(a.s, b.s) as c from n a, n b where a.n < b.n or (a.n = b.n and a.vec_id < b.vec_id))
  select i as first_id, j as second_id, round(c / (n + m - c), 6) as similarity from p where c >= 0.55 * (n + m - c) - 1e-9""")
def similar_fingerprints(spark, sf_dir):
    """All pairs of sign sets with a Tanimoto similarity of 0.55 or more."""
    bits = F.filter(F.transform("embedding", lambda x, k: F.when(x > 0, k)), lambda k: k.isNotNull())
    return rounded(bitjoin.similar_sets(read(spark, sf_dir, "embeddings"), "vec_id", bits, 0.55, 64), "similarity")


@query(f"""with {DIST}, h as (select d.*, list_dot_product(q.v, r.v) / (list_dot_product(q.v, q.v) + list_dot_product(r.v, r.v) - list_dot_product(q.v, r.v)) as tanimoto_dist from dist d join v q on q.vec_id = d.query_id join v r on r.vec_id = d.ref_id),
  k as (select *, {', '.join(f'row_number() over (partition by query_id order by round({m}_dist, 9), ref_id) as {m}_rank' for m in ('cosine', 'jaccard', 'tanimoto'))} from h)
  select query_id, ref_id, cosine_rank, jaccard_rank, tanimoto_rank, round(tanimoto_dist, 6) as tanimoto_dist, round(case when round(tanimoto_dist, 9) > 0 then log2(round(tanimoto_dist, 9)) end, 6) as tanimoto_log2 from k where cosine_rank <= 4 or jaccard_rank <= 4 or tanimoto_rank <= 4""")
def rank_compare_three(spark, sf_dir):
    """Ranks by three metrics side by side; the third is a similarity, ranked upwards as the others are."""
    e, names = read(spark, sf_dir, "embeddings"), ["cosine", "jaccard", "tanimoto"]
    top = compare.compare_vectors(e.where("vec_id % 100 = 0"), e, "vec_id", "embedding", names, 4)
    top = top.withColumn("tanimoto_log2", F.when(F.col("tanimoto_key") > 0, F.log2("tanimoto_key")))
    return rounded(top.select("query_id", "ref_id", *(f"{m}_rank" for m in names), "tanimoto_dist", "tanimoto_log2"), "tanimoto_dist", "tanimoto_log2")


# ---- models and functions


@query("""with o as (select o_custkey, count(*) as every, count(*) filter (o_orderstatus <> 'P') as settled from orders group by 1), m as (select c_acctbal > 0 as y, coalesce(every, 0) as every, coalesce(settled, 0) as settled from customer left join o on o_custkey = c_custkey),
  u as (unpivot m on every, settled into name model value n)
  select model, count(*) filter (y and n >= 10) as tp, count(*) filter (not y and n >= 10) as fp, count(*) filter (y and n < 10) as fn, count(*) filter (not y and n < 10) as tn from u group by 1""")
def model_counts(spark, sf_dir):
    """Two counts of a customer's orders as two models of a positive balance, each positive from ten on."""
    o = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("every"), F.count_if(F.col("o_orderstatus") != "P").alias("settled"))
    c = read(spark, sf_dir, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left").na.fill(0, ["every", "settled"])
    return metrics.counts_at_cut(c.withColumn("y", (F.col("c_acctbal") > 0).cast("int")), "y", ["every", "settled"], 10)


@query("select n_nationkey, upper(n_name[1]) || lower(n_name[2:]) as title from nation")
def nation_titles(spark, sf_dir):
    return read(spark, sf_dir, "nation").select("n_nationkey", scalars.title_case(F.lower("n_name")).alias("title"))


@query("select p_partkey, round_even(p_size / 8.0::double, 2) as eighths from part")
def half_even_eighths(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", scalars.half_even(F.col("p_size") / F.lit(8.0), 2).alias("eighths"))


@query("select o_orderpriority, 'n = ' || count(*) as label from orders group by 1")
def count_labels(spark, sf_dir):
    return read(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n")).select("o_orderpriority", scalars.count_label(F.col("n")).alias("label"))


@query("select event_id, round(10.0 / (1 + exp(-0.3::double * (value - 8.0))), 6) as height from events")
def logistic_values(spark, sf_dir):
    return rounded(read(spark, sf_dir, "events").select("event_id", scalars.logistic(F.col("value"), F.lit(10.0), F.lit(0.3), F.lit(8.0)).alias("height")), "height")


@query("select vec_id, array_to_string(list_transform(embedding, lambda x: case when x > 0 then 1 else 0 end), '') as bits from embeddings")
def bit_arrays(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings").select("vec_id", vectors.bits_of(F.col("embedding")).alias("packed"))
    return e.select("vec_id", F.array_join(vectors.set_bits(F.col("packed"), 64).cast("array<string>"), "").alias("bits"))


@query("select s_suppkey, 'strain' || (s_suppkey % 7) || '_' || s_nationkey as file from supplier")
def file_names(spark, sf_dir):
    name = F.concat(F.when(F.col("s_suppkey") % 2 == 0, "strain").otherwise("stra_in"), (F.col("s_suppkey") % 7).cast("string"), F.lit("_"), F.col("s_nationkey").cast("string"), F.lit("_OD.tsv.gz"))
    return read(spark, sf_dir, "supplier").select("s_suppkey", scalars.fold_underscore(name).alias("file"))


@query("select event_id, cast(json_extract(props, '$.k') as integer) as k from events")
def params_round_trip(spark, sf_dir):
    """Settings read from text, written as text and read again."""
    e = read(spark, sf_dir, "events").select("event_id", scalars.to_params(scalars.from_params(F.col("props"), "k int")).alias("text"))
    return e.select("event_id", scalars.from_params(F.col("text"), "k int")["k"].alias("k"))


@query("select c_custkey, coalesce(n_name, 'not_found') as n_name from customer left join nation on n_nationkey = case when c_custkey % 5 <> 0 then c_nationkey end")
def number_lookup(spark, sf_dir):
    """Nations by number, written in several ways and sometimes not at all."""
    k = F.col("c_nationkey").cast("string")
    written = F.when(F.col("c_custkey") % 5 == 0, "none").when(F.col("c_custkey") % 3 == 0, F.concat(k, F.lit(".0"))).otherwise(k)
    c = read(spark, sf_dir, "customer").select("c_custkey", written.alias("n_nationkey"))
    return library.lookup_by_number(c, read(spark, sf_dir, "nation"), "n_nationkey", "n_name").select("c_custkey", "n_name")


@query("""with o as (select o_custkey, count(*) as nk_total from orders group by 1) select o_custkey, nk_total, c_mktsegment, cast(nk_total >= 10 as integer) as broad_spectrum, n_name from o left join customer on c_custkey = o_custkey left join nation on n_nationkey = o_custkey""")
def enriched_library(spark, sf_dir):
    o = read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("key")).agg(F.count("*").alias("nk_total"))
    c = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), "c_mktsegment")
    n = read(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("key"), "n_name")
    return library.enrich(o, c, "key", n).withColumnRenamed("key", "o_custkey")


@query("""with s as (select o_orderstatus as k, cast(count(*) as double) as n, cast(sum(cast(round(o_totalprice * 100) as bigint)) as double) as cents from orders group by 1), u as (unpivot s on n, cents into name field value v)
  select field, max(v) filter (k = 'F') as "F", max(v) filter (k = 'O') as "O", max(v) filter (k = 'P') as "P" from u group by 1""")
def transposed_totals(spark, sf_dir):
    s = read(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents"))
    return reshape.transposed(s, "o_orderstatus", ["n", "cents"], ["F", "O", "P"])


@query("select c_nationkey, c_custkey from (select *, row_number() over (partition by c_nationkey order by c_acctbal desc, c_custkey) as k from customer) where k = 1")
def best_customers(spark, sf_dir):
    return reshape.best_of_group(read(spark, sf_dir, "customer"), "c_nationkey", "c_acctbal", "c_custkey").select("c_nationkey", "c_custkey")


WELLS = """w as (select event_id, event_type as organism, chr(65 + cast(user_id % 8 as integer)) || (1 + user_id % 12) as well, case user_id % 5 when 0 then 'Water' when 1 then 'DMSO' else 'C' || (user_id % 4) end as compound,
  case when user_id % 5 = 1 then 0.002::double * (1 + user_id % 3) else user_id % 3 end as concentration, case when user_id % 5 < 2 then 0.002::double * (1 + user_id % 3) when user_id % 4 = 0 then 0.0::double else 0.002::double * (user_id % 3) end as dmso_percentage,
  epoch_us(ts) // 86400000000 as timepoint, value as od from events)"""


def wells_of_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as readings of wells: the user's number gives well, compound, dose and share."""
    u = F.col("user_id")
    share = F.lit(0.002) * (1 + u % 3)
    return read(spark, sf_dir, "events").select(
        F.col("event_type").alias("organism"),
        F.concat(F.chr(65 + u % 8), (1 + u % 12).cast("string")).alias("well"),
        F.when(u % 5 == 0, "Water").when(u % 5 == 1, "DMSO").otherwise(F.concat(F.lit("C"), (u % 4).cast("string"))).alias("compound"),
        F.when(u % 5 == 1, share).otherwise((u % 3).cast("double")).alias("concentration"),
        F.when(u % 5 < 2, share).when(u % 4 == 0, 0.0).otherwise(F.lit(0.002) * (u % 3)).alias("dmso_percentage"),
        F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 86400000000).alias("timepoint"),
        F.col("value").alias("od"),
    )


@query(f"""with {WELLS}, o as (select * from w where compound not in ('Water', 'DMSO')), cases as (select distinct organism, compound, concentration from o),
  r as (select distinct organism, compound, unnest([well[1], 'H']) as l from o),
  s as (select distinct compound, concentration, cast(round(case when dmso_percentage = 0 then 0.002 else dmso_percentage end * 1e6) as bigint) as k from o),
  d as (select distinct cast(round(concentration * 1e6) as bigint) as k, well from w where compound = 'DMSO'),
  every as (select organism, compound, concentration, compound as curve_id, timepoint, od from o
    union all select c.organism, c.compound, c.concentration, 'Water', timepoint, od from w join r on w.compound = 'Water' and r.organism = w.organism and r.l = w.well[1] join cases c on c.organism = r.organism and c.compound = r.compound
    union all select c.organism, c.compound, c.concentration, 'DMSO', timepoint, od from cases c join s using (compound, concentration) join d using (k) join w on w.organism = c.organism and w.well = d.well)
  select organism, compound, concentration, curve_id, timepoint, round(avg(od), 6) as mean_od, round(stddev_samp(od), 6) as stdv from every group by 1, 2, 3, 4, 5""")
def panel_with_controls(spark, sf_dir):
    w = wells_of_events(spark, sf_dir)
    return rounded(plates.compound_panel(w, w.select("well", "compound", "concentration", "dmso_percentage").distinct()), "mean_od", "stdv")


@query(f"""with {WELLS}, p as (select organism, well, compound, concentration, dmso_percentage, max(od) as top from w group by 1, 2, 3, 4, 5), o as (select * from p where compound not in ('Water', 'DMSO')),
  m as (select distinct compound as for_compound, concentration as chem_conc, cast(round(dmso_percentage * 1e6) as bigint) as k from o), n as (select for_compound, max(k) > 0 as has from m group by 1),
  f as (select m.* from m join n using (for_compound) where has union all select n.for_compound, m.chem_conc, m.k from n, m where not has and m.for_compound = 'C1')
  select for_compound, chem_conc, organism, well, compound, top, 1 as role from p join f on compound = 'DMSO' and cast(round(dmso_percentage * 1e6) as bigint) = f.k
  union all select for_compound, chem_conc, organism, well, compound, top, 0 from p, (select distinct for_compound, chem_conc from m) where compound = 'Water' and well like 'H%'
  union all select compound, concentration, organism, well, compound, top, 2 from o""")
def parameters_with_controls(spark, sf_dir):
    p = wells_of_events(spark, sf_dir).groupBy("organism", "well", "compound", "concentration", "dmso_percentage").agg(F.max("od").alias("top"))
    return plates.compound_parameters(p, "C1").select("for_compound", "chem_conc", "organism", "well", "compound", "top", "role")


@query("select event_id, strftime(ts, '%d.%m.%Y_%H.%M') as label from events")
def time_labels(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", scalars.time_label(F.col("ts")).alias("label"))


def growth_by_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A logistic curve for each event series, by a table function called from SQL text. SQL alone has no form for the fit."""
    tables.register(spark)
    c = curves(spark, sf_dir)
    cumulative = F.sum("corrected").over(Window.partitionBy("event_type", "user_id").orderBy("point"))
    c.select("event_type", "user_id", "hours", (cumulative / 100).alias("od")).createOrReplaceTempView("plateworks_readings")
    # Some thousand curves a partition, and a partition a task at least.
    many = max(int(spark.conf.get("spark.sql.shuffle.partitions")), read(spark, sf_dir, "events").count() // 65_536)
    return spark.sql(f"select * from growth_parameters(table(plateworks_readings) partition by pmod(hash(event_type, user_id), {many}) order by hours)")


QUERIES["growth_by_sql"] = growth_by_sql


def neighbour_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of all compounds in two dimensions. SQL has no form for it; tests hold the graph and the kept neighbours against all pairs."""
    return embedding.embed(read(spark, sf_dir, "embeddings"), "vec_id", "embedding", epochs=15)


QUERIES["neighbour_embedding"] = neighbour_embedding
