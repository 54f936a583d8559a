"""Every registered query and its DuckDB SQL.

The tables stand in for screening data: ``embeddings`` are compounds with representations,
``nation`` the strains, ``lineitem`` the screening matrix (discount as p-value), ``part`` the
library, ``labels`` with ``documents`` the classified compounds, and ``events`` the plate series.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import capital_first_two, clean_name, first_letter, one_hot, strain_number, strip_quotes
from ..functions.vectors import bits_of, doubles, hamming_share
from ..operators import bitranks, compare, features, library, metrics, neighbours, plates, reshape, scoring, similarity, splits

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with SQL where there is one."""

    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in columns})


# ---- pairs and potential

PAIRS = """pairs as (
  select vec_id as chem_id, n_name || ' (NT' || (5000 + n_nationkey) || ')' as strain_name,
    case when n_regionkey in (0, 1) then 'negative' else 'positive' end as gram_stain,
    1 / (1 + exp(-(12 * cast(embedding[1 + n_nationkey % 64] as double) - 3.5))) as p
  from embeddings, nation)"""
HIT = "case when p >= 0.04374140128493309 then 1 else 0 end"


def strains(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read(spark, sf_dir, "nation")
    return n.select(
        F.concat("n_name", F.lit(" (NT"), (F.col("n_nationkey") + 5000).cast("string"), F.lit(")")).alias("strain_name"),
        (F.col("n_nationkey") % 64 + 1).alias("position"),
        F.when(F.col("n_regionkey").isin(0, 1), "negative").otherwise("positive").alias("gram_stain"),
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    compounds = read(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("chem_id"), "embedding")
    pairs = scoring.pair_all(compounds, strains(spark, sf_dir))
    return scoring.score_pairs(pairs, scoring.logistic_scorer("embedding", "position", 12.0, -3.5)).select("chem_id", "strain_name", "gram_stain", "p")


@query(f"""with {PAIRS} select chem_id, round(avg(ln(p)), 6) as apscore_total,
  round(avg(ln(p)) filter (gram_stain = 'negative'), 6) as apscore_gnegative, round(avg(ln(p)) filter (gram_stain = 'positive'), 6) as apscore_gpositive,
  cast(sum({HIT}) as bigint) as ginhib_total, cast(sum({HIT}) filter (gram_stain = 'negative') as bigint) as ginhib_gnegative,
  cast(sum({HIT}) filter (gram_stain = 'positive') as bigint) as ginhib_gpositive, cast(sum({HIT}) >= 10 as integer) as broad_spectrum
  from pairs group by chem_id order by chem_id""")
def flagship_potential(spark, sf_dir):
    return rounded(scoring.potential(scored(spark, sf_dir)), "apscore_total", "apscore_gnegative", "apscore_gpositive").orderBy("chem_id")


@query(f"with {PAIRS} select chem_id || ':' || strain_name as pred_id, round(p, 6) as probability, {HIT} as growth_inhibition from pairs")
def pairwise_scores(spark, sf_dir):
    return scored(spark, sf_dir).select(scoring.pair_id(F.col("chem_id"), F.col("strain_name")).alias("pred_id"), F.round("p", 6).alias("probability"), scoring.inhibited(F.col("p")).alias("growth_inhibition"))


@query(f"with {PAIRS} select 'a:b' || chem_id as chem_id, strain_name, regexp_extract(strain_name, '\\((NT\\d+)\\)', 1) as nt_number from pairs")
def pairwise_from_pred_id(spark, sf_dir):
    ids = scored(spark, sf_dir).select(scoring.pair_id(F.concat(F.lit("a:b"), F.col("chem_id").cast("string")), F.col("strain_name")).alias("pred_id"))
    return scoring.split_pair_id(ids).select("chem_id", "strain_name", "nt_number")


@query(f"with {PAIRS} select chem_id, round(avg(ln(p)), 6) as apscore_total from pairs group by 1")
def potential_total(spark, sf_dir):
    return scored(spark, sf_dir).groupBy("chem_id").agg(F.round(F.avg(F.ln("p")), 6).alias("apscore_total"))


@query(f"with {PAIRS} select chem_id, round(avg(ln(p)) filter (gram_stain = 'negative'), 6) as apscore_gnegative, round(avg(ln(p)) filter (gram_stain = 'positive'), 6) as apscore_gpositive from pairs group by 1")
def potential_by_gram_pivot(spark, sf_dir):
    return rounded(scoring.potential_pivot(scored(spark, sf_dir)), "apscore_gnegative", "apscore_gpositive")


@query(f"with {PAIRS} select chem_id, gram_stain, cast(sum({HIT}) as bigint) as ginhib from pairs group by 1, 2")
def inhibited_counts(spark, sf_dir):
    return scored(spark, sf_dir).groupBy("chem_id", "gram_stain").agg(F.sum(scoring.inhibited(F.col("p"))).alias("ginhib"))


# ---- screening matrix


@query("select l_partkey, cast(sum(case when l_discount <= 0.05 then 1 else 0 end) as bigint) as n_hits, count(*) as n_tests from lineitem group by 1")
def screen_binarise(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    return li.groupBy("l_partkey").agg(F.sum(F.coalesce((F.col("l_discount") <= 0.05).cast("int"), F.lit(0))).alias("n_hits"), F.count("*").alias("n_tests"))


@query("select l_returnflag, count(*) filter (l_linestatus = 'F') as n_f, count(*) filter (l_linestatus = 'O') as n_o from lineitem group by 1")
def screen_pivot(spark, sf_dir):
    wide = reshape.widen(read(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_linestatus", ["F", "O"], F.count(F.lit(1)))
    return wide.select("l_returnflag", F.coalesce("F", F.lit(0)).alias("n_f"), F.coalesce("O", F.lit(0)).alias("n_o"))


@query("select l_returnflag, l_linestatus as status, count(*) as n from lineitem group by 1, 2")
def screen_unpivot(spark, sf_dir):
    wide = reshape.widen(read(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_linestatus", ["F", "O"], F.count(F.lit(1)))
    return reshape.lengthen(wide, ["l_returnflag"], ["F", "O"], "status", "n").where("n is not null")


MEAN = "cast(sum(cast(l_extendedprice as decimal(18, 2))) filter (l_returnflag = '{0}') as double) / count(*) filter (l_returnflag = '{0}')"


@query(f"select cast(l_quantity as bigint) as quantity, {MEAN.format('A')} as a, {MEAN.format('N')} as n, {MEAN.format('R')} as r from lineitem group by 1")
def pivot_mean(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").withColumn("quantity", F.col("l_quantity").cast("long"))
    # Sums of decimals are exact, so the means do not depend on the order of rows.
    mean = F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double") / F.count("l_extendedprice")
    return reshape.widen(li, ["quantity"], "l_returnflag", ["A", "N", "R"], mean).toDF("quantity", "a", "n", "r")


# ---- library


@query("select p_partkey, p_name from part where p_size <= 25 and p_name not in (select p_name from part where p_size > 48)")
def library_anti_names(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    return library.without_names(part.where("p_size <= 25"), part.where("p_size > 48"), "p_name", "p_name").select("p_partkey", "p_name")


@query("select p_partkey, p_name from part where p_size <= 25 and p_name in (select p_name from part where p_size > 48)")
def library_semi(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    return library.with_names(part.where("p_size <= 25"), part.where("p_size > 48"), "p_name", "p_name").select("p_partkey", "p_name")


KNOWN_CODES = "select unnest(string_split(p_name, ' ')) from part where p_partkey < 3"


@query(f"select p_partkey from part where not list_has_any(list_filter(string_split(p_name, ' '), lambda x: x <> ''), (select list(c) from ({KNOWN_CODES}) t(c)))")
def library_anti_codes(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    codes = F.split("p_name", " ")
    return library.without_codes(part, part.where("p_partkey < 3"), codes, codes, "p_partkey").select("p_partkey")


@query(f"""select p_partkey from part where p_name not in (select p_name from part where p_partkey < 3)
  and not list_has_any(string_split(p_name, ' '), (select list(c) from ({KNOWN_CODES}) t(c))) and p_partkey not in (3, 5, 8, 13)""")
def library_filter_chain(spark, sf_dir):
    part = read(spark, sf_dir, "part")
    codes = F.split("p_name", " ")
    return library.drop_overlap(part, part.where("p_partkey < 3"), "p_name", codes, codes, "p_partkey", [3, 5, 8, 13]).select("p_partkey")


@query("select s_suppkey, n_name from supplier left join (select * from nation where n_regionkey < 3) on s_nationkey = n_nationkey")
def lookup_left_null(spark, sf_dir):
    s, n = read(spark, sf_dir, "supplier"), read(spark, sf_dir, "nation").where("n_regionkey < 3")
    return s.join(n, F.col("s_nationkey") == F.col("n_nationkey"), "left").select("s_suppkey", "n_name")


@query("select r_name, count(*) as n_orders, round(sum(o_totalprice), 2) as total from orders left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey group by 1")
def multi_left_join(spark, sf_dir):
    o, c, n, r = (read(spark, sf_dir, t) for t in ("orders", "customer", "nation", "region"))
    j = o.join(c, F.col("o_custkey") == F.col("c_custkey"), "left").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return j.groupBy("r_name").agg(F.count("*").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("select c_custkey, case when t.v is not null then t.v else 'not_found' end as value from customer left join (select n_name, 'n' || n_nationkey as v, n_nationkey k from nation where n_nationkey % 2 = 0) t on t.k = c_nationkey")
def lookup_not_found(spark, sf_dir):
    c, n = read(spark, sf_dir, "customer"), read(spark, sf_dir, "nation")
    names = c.withColumn("nation", F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string"), F.when(F.col("c_custkey") % 3 == 0, F.lit(" (salt)")).otherwise(F.lit(""))))
    lookup = n.where("n_nationkey % 2 = 0").select(F.col("n_name").alias("nation"), F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("value"))
    return library.lookup_with_fallback(names, lookup, "nation", "value").select("c_custkey", "value")


@query("select * from (values (0::bigint, 7), (1, 3), (2, 7), (3, 20)) k(ord, vec_id) join (select vec_id, label from embeddings) using (vec_id)")
def key_gather(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings").select("vec_id", "label")
    return library.gather(e, [7, 3, 7, 20], "vec_id").select("vec_id", "ord", "label")


# ---- metrics

JUDGED = "judged as (select l.doc_id, l.quality, l.toxic, cast(d.n_chars as double) as score from labels l join documents d using (doc_id))"
CURVE = f"""{JUDGED}, by_score as (select score as threshold, sum(quality) as pos, sum(1 - quality) as neg from judged group by 1),
 counts as (select threshold, pos, sum(pos) over w as tp, sum(neg) over w as fp, sum(pos) over () as total from by_score window w as (order by threshold desc rows unbounded preceding)),
 curve as (select threshold, cast(tp as double) / (tp + fp) as precision, cast(tp as double) / total as recall from counts where tp - pos < total union all select null, 1.0, 0.0)"""


def judged(spark, sf_dir):
    lab, doc = read(spark, sf_dir, "labels"), read(spark, sf_dir, "documents")
    return lab.join(doc.select("doc_id", F.col("n_chars").cast("double").alias("score")), "doc_id")


@query(f"""with {JUDGED}, c as (select sum(case when quality = 1 and score >= 1500 then 1 else 0 end) tp, sum(case when quality = 0 and score >= 1500 then 1 else 0 end) fp,
  sum(case when quality = 1 and score < 1500 then 1 else 0 end) fn, sum(case when quality = 0 and score < 1500 then 1 else 0 end) tn from judged)
  select cast(tp as bigint) tp, cast(fp as bigint) fp, cast(fn as bigint) fn, cast(tn as bigint) tn, round(tp / cast(tp + fp as double), 6) as precision, round(tp / cast(tp + fn as double), 6) as recall,
  round(2 * (tp / cast(tp + fp as double)) * (tp / cast(tp + fn as double)) / (tp / cast(tp + fp as double) + tp / cast(tp + fn as double)), 6) as f1 from c""")
def confusion_metrics(spark, sf_dir):
    return rounded(metrics.confusion(judged(spark, sf_dir), "quality", F.col("score") >= 1500), "precision", "recall", "f1")


@query(f"""with {JUDGED} select case when a <> b then 'Disagreement' when quality = 1 and a = 1 then 'TP' when quality = 0 and a = 1 then 'FP' when quality = 1 then 'FN' else 'TN' end as agreement, count(*) as n
  from (select quality, case when score >= 1500 then 1 else 0 end a, case when score >= 3000 then 1 else 0 end b from judged) group by 1""")
def agreement_class(spark, sf_dir):
    j = judged(spark, sf_dir).withColumns({"a": (F.col("score") >= 1500).cast("int"), "b": (F.col("score") >= 3000).cast("int")})
    return metrics.agreement(j, "quality", "a", "b").groupBy("agreement").agg(F.count("*").alias("n"))


@query(f"with {JUDGED}, r as (select quality, rank() over (order by score) + (count(*) over (partition by score) - 1) / 2.0 as r from judged) select round((sum(r) filter (quality = 1) - count(*) filter (quality = 1) * (count(*) filter (quality = 1) + 1) / 2.0) / (cast(count(*) filter (quality = 1) as double) * count(*) filter (quality = 0)), 6) as auroc from r")
def auroc(spark, sf_dir):
    return rounded(metrics.auroc(judged(spark, sf_dir), "quality", "score"), "auroc")


@query(f"with {CURVE} select threshold, round(precision, 6) as precision, round(recall, 6) as recall from curve")
def pr_curve(spark, sf_dir):
    return rounded(metrics.pr_curve(judged(spark, sf_dir), "quality", "score"), "precision", "recall")


@query(f"with {CURVE}, n as (select recall, precision, lead(recall) over w as r2, lead(precision) over w as p2 from curve window w as (order by recall desc, threshold asc nulls last)) select round(sum((recall - r2) * (precision + p2) / 2), 6) as pr_auc from n")
def pr_auc(spark, sf_dir):
    return rounded(metrics.pr_auc(metrics.pr_curve(judged(spark, sf_dir), "quality", "score")), "pr_auc")


@query(f"with {CURVE}, f as (select *, 2 * precision * recall / (precision + recall) as f1 from curve where threshold is not null and precision + recall > 0) select threshold, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1 from f order by f.f1 desc, threshold limit 1")
def best_f1_threshold(spark, sf_dir):
    return rounded(metrics.best_threshold(metrics.pr_curve(judged(spark, sf_dir), "quality", "score")), "precision", "recall", "f1")


@query(f"with {CURVE} select max(threshold) filter (precision < 0.75) as threshold from curve")
def hard_to_recall(spark, sf_dir):
    return metrics.hard_threshold(metrics.pr_curve(judged(spark, sf_dir), "quality", "score"))


@query("with m as (select l_shipmode_id as run, l_returnflag, avg(l_extendedprice) as v from (select l_linenumber as l_shipmode_id, l_returnflag, l_extendedprice from lineitem) group by 1, 2), r as (select *, rank() over (partition by l_returnflag order by round(v, 9) desc) k from m) select run, l_returnflag, round(v, 4) as mean_metric from r where k = 1")
def mean_by_experiment_best(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem").withColumnRenamed("l_linenumber", "run")
    return rounded(metrics.best_experiment(li, ["run"], "l_returnflag", "l_extendedprice"), "mean_metric", digits=4)


# ---- similarity

DIST = """v as (select vec_id, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings),
 b as (select vec_id, v, list_transform(v, lambda x: case when x > 0 then 1 else 0 end) as s from v),
 dist as (select q.vec_id as query_id, r.vec_id as ref_id, 1 - list_dot_product(q.v, r.v) / (sqrt(list_dot_product(q.v, q.v)) * sqrt(list_dot_product(r.v, r.v))) as cosine_dist,
  1 - cast(list_dot_product(cast(q.s as double[]), cast(r.s as double[])) as double) / (list_sum(q.s) + list_sum(r.s) - list_dot_product(cast(q.s as double[]), cast(r.s as double[]))) as jaccard_dist
  from b q, b r where q.vec_id % 100 = 0 and r.vec_id <> q.vec_id)"""


def dist(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings")
    return similarity.distances(e.where("vec_id % 100 = 0"), e, "vec_id", "embedding").where("query_id <> ref_id")


@query(f"with {DIST}, r as (select *, row_number() over (partition by query_id order by round(cosine_dist, 9), ref_id) as rank from dist) select query_id, ref_id, round(cosine_dist, 6) as cosine_dist, rank from r where rank <= 10")
def cosine_topk(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings")
    return rounded(neighbours.nearest_pruned(e.where("vec_id % 100 = 0"), e, "vec_id", "embedding", 10, others=True), "cosine_dist")


@query(f"with {DIST} select query_id, ref_id, row_number() over (partition by query_id order by round(jaccard_dist, 9), ref_id) as rank from dist")
def rank_first(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings")
    return bitranks.bit_ranks(e.where("vec_id % 100 = 0"), e, "vec_id", "embedding")


@query(f"with {DIST} select query_id, ref_id, rank() over (partition by query_id order by round(jaccard_dist, 9)) as rank from dist")
def rank_min_ties(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings")
    return bitranks.bit_ranks(e.where("vec_id % 100 = 0"), e, "vec_id", "embedding", shared=True)


@query(f"with {DIST} select query_id, round(min(jaccard_dist), 6) as min_distance from dist group by 1")
def min_distance(spark, sf_dir):
    return rounded(similarity.closest(dist(spark, sf_dir)), "min_distance")


@query(f"with {DIST} select query_id, ref_id, round(jaccard_dist, 6) as jaccard_dist from dist")
def jaccard_bits(spark, sf_dir):
    return rounded(dist(spark, sf_dir).drop("cosine_dist"), "jaccard_dist")


@query(f"with {DIST}, t as (select query_id, ref_id, round(1 - jaccard_dist, 6) as similarity, rank() over (partition by query_id order by round(1 - jaccard_dist, 9) desc) as rank from dist) select * from t where rank <= 5")
def tanimoto_rank(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings")
    ranked = bitranks.bit_ranks(e.where("vec_id % 100 = 0"), e, "vec_id", "embedding", shared=True, most=5)
    return rounded(ranked.select("query_id", "ref_id", (1 - F.col("jaccard_dist")).alias("similarity"), "rank"), "similarity")


@query(f"""with {DIST}, r as (select *, row_number() over (partition by query_id order by round(cosine_dist, 9), ref_id) as cosine_rank, row_number() over (partition by query_id order by round(jaccard_dist, 9), ref_id) as jaccard_rank from dist)
  select query_id, ref_id, cosine_rank, jaccard_rank, round(cosine_dist, 6) as cosine_dist, round(jaccard_dist, 6) as jaccard_dist, round(log2(round(cosine_dist, 9)), 6) as cosine_log2, round(log2(round(jaccard_dist, 9)), 6) as jaccard_log2 from r where cosine_rank <= 4 or jaccard_rank <= 4""")
def rank_compare(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings")
    found = compare.compare_vectors(e.where("vec_id % 100 = 0"), e, "vec_id", "embedding", ["cosine", "jaccard"], 4)
    logs = {f"{m}_log2": similarity.log_of(F.col(f"{m}_key")) for m in ("cosine", "jaccard")}
    return rounded(found.withColumns(logs).drop("cosine_key", "jaccard_key"), "cosine_dist", "jaccard_dist", *logs)


@query("""with b as (select vec_id, list_transform(embedding, lambda x: case when x > 0 then 1 else 0 end) as s from embeddings)
  select q.vec_id as query_id, r.vec_id as ref_id, round(list_sum(list_transform(list_zip(q.s, r.s), lambda x: case when x[1] <> x[2] then 1 else 0 end)) / 64.0, 6) as hamming from b q, b r where q.vec_id % 100 = 0 and r.vec_id <> q.vec_id""")
def hamming_pairs(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings").select("vec_id", bits_of(doubles(F.col("embedding"))).alias("bits"))
    q = e.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), F.col("bits").alias("q"))
    return similarity.against_all(q, e, "query_id").where("query_id <> vec_id").select("query_id", F.col("vec_id").alias("ref_id"), F.round(hamming_share(F.col("q"), F.col("bits")), 6).alias("hamming"))


# ---- features


@query("select pos, round(var_samp(x), 8) as variance from (select unnest(range(0, 64)) as pos, cast(unnest(embedding) as double) as x from embeddings) group by 1")
def feature_variance(spark, sf_dir):
    return rounded(features.variances(read(spark, sf_dir, "embeddings"), "embedding"), "variance", digits=8)


@query("with x as (select vec_id, unnest(range(0, 64)) as pos, cast(unnest(embedding) as double) as x from embeddings), c as (select a.pos as i, b.pos as j, corr(a.x, b.x) as r from x a join x b using (vec_id) where a.pos < b.pos group by 1, 2) select distinct j as pos from c where r >= 0.1")
def feature_corr_prune(spark, sf_dir):
    return features.correlated(read(spark, sf_dir, "embeddings"), "embedding", 64, 0.1)


@query("select pos, cast(sum(case when x > 0 then 1 else 0 end) as bigint) as n from (select unnest(range(0, 64)) as pos, unnest(embedding) as x from embeddings) group by 1")
def bit_frequency(spark, sf_dir):
    return features.bit_counts(read(spark, sf_dir, "embeddings"), "embedding")


@query("with x as (select vec_id, unnest(range(0, 64)) as pos, unnest(embedding) > 0 as x from embeddings) select a.pos as i, b.pos as j, round(avg(case when a.x <> b.x then 1.0 else 0.0 end), 6) as hamming from x a join x b using (vec_id) where a.pos < b.pos group by 1, 2")
def hamming_features(spark, sf_dir):
    return rounded(features.hamming_features(read(spark, sf_dir, "embeddings"), "embedding", 64), "hamming")


@query("with q as (select quantile_cont(p_retailprice, 0.25) as lo, quantile_cont(p_retailprice, 0.75) as hi from part) select p_partkey, round(greatest(lo, least(hi, p_retailprice)), 6) as clipped from part, q")
def quantile_clip(spark, sf_dir):
    return rounded(reshape.clip_to_quartiles(read(spark, sf_dir, "part"), "p_retailprice").select("p_partkey", "clipped"), "clipped")


@query("select n_nationkey, array_to_string(list_transform(range(0, 25), lambda i: case when i = n_nationkey then 1 else 0 end), '') as code from nation")
def one_hot_strains(spark, sf_dir):
    return read(spark, sf_dir, "nation").select("n_nationkey", F.array_join(one_hot(F.col("n_nationkey"), 25).cast("array<string>"), "").alias("code"))


# ---- plates

CURVES = """o as (select event_type, user_id, event_id, ts, value as od, row_number() over (partition by event_type, user_id order by ts, event_id) as point from events),
 c as (select *, greatest(0.0, od - min(case when point in (2, 3, 4) then od end) over (partition by event_type, user_id)) as corrected,
  (epoch_us(ts) - epoch_us(min(ts) over (partition by event_type, user_id))) / 3.6e9 as hours from o)"""
CURVE_KEYS = ["event_type", "user_id"]


def curves(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumnRenamed("value", "od").withColumn("ts", F.col("ts").cast("timestamp"))
    return plates.hours(plates.baseline(plates.number_points(e, CURVE_KEYS, "ts", "event_id"), CURVE_KEYS, "od"), CURVE_KEYS, "ts")


@query(f"with {CURVES} select event_id, point, round(corrected, 6) as corrected from c")
def od_baseline(spark, sf_dir):
    return rounded(curves(spark, sf_dir).select("event_id", "point", "corrected"), "corrected")


@query(f"with {CURVES} select event_id, round(hours, 6) as hours from c")
def od_hours(spark, sf_dir):
    return rounded(curves(spark, sf_dir).select("event_id", "hours"), "hours")


NEAR = "near as (select *, rank() over (partition by event_type, user_id order by round(abs(hours - 96), 9)) as r from c)"


@query(f"with {CURVES}, {NEAR} select event_type, user_id, event_id, round(od, 6) as od from near where r = 1")
def od_nearest(spark, sf_dir):
    return rounded(plates.nearest_time(curves(spark, sf_dir), CURVE_KEYS, 96.0).select(*CURVE_KEYS, "event_id", "od"), "od")


@query(f"with {CURVES}, {NEAR} select event_type, user_id % 10 as dose, count(*) as n, round(avg(od), 6) as mean_od, round(median(od), 6) as median_od, round(stddev_samp(od), 6) as sd_od from near where r = 1 group by 1, 2")
def od_dose_stats(spark, sf_dir):
    near = plates.nearest_time(curves(spark, sf_dir), CURVE_KEYS, 96.0).withColumn("dose", F.col("user_id") % 10)
    return rounded(plates.dose_stats(near, ["event_type", "dose"], "od"), "mean_od", "median_od", "sd_od")


@query(f"with {CURVES} select point, round(avg(hours), 6) as mean_hours from (select distinct point, hours from c) group by 1")
def od_time_avg(spark, sf_dir):
    return rounded(plates.mean_times(curves(spark, sf_dir)), "mean_hours")


@query(f"with {CURVES} select event_type, user_id, count(*) filter (corrected > 5) >= 2 as grown from c group by 1, 2")
def od_growth_check(spark, sf_dir):
    return plates.grown(curves(spark, sf_dir), CURVE_KEYS, "corrected", 5.0)


@query(f"with {CURVES}, s as (select event_type, user_id, regr_slope(case when corrected > 0 then ln(corrected) end, hours) as slope from c group by 1, 2) select event_type, user_id, round(coalesce(case when slope > 0 then ln(2) / slope end, 0), 4) as generation_time from s")
def gen_time(spark, sf_dir):
    return rounded(plates.slopes(curves(spark, sf_dir), CURVE_KEYS).drop("slope"), "generation_time", digits=4)


@query("select s_suppkey, p_size from supplier, (select distinct p_size from part)")
def control_replicate(spark, sf_dir):
    s, p = read(spark, sf_dir, "supplier").select("s_suppkey"), read(spark, sf_dir, "part")
    return plates.controls_for_each(s, p, "p_size")


@query("select l.l_discount + 0.0 as share, l.n, t.m from (select l_discount, count(*) n from lineitem group by 1) l join (select l_tax, count(*) m from lineitem group by 1) t on round(l.l_discount * 1e6) = round(t.l_tax * 1e6)")
def float_key_join(spark, sf_dir):
    li = read(spark, sf_dir, "lineitem")
    left = li.groupBy((F.col("l_discount") + 0.0).alias("share")).agg(F.count("*").alias("n"))
    right = li.groupBy((F.col("l_tax") + 0.0).alias("share")).agg(F.count("*").alias("m"))
    return plates.join_rounded(left, right, "share")


@query("select count(distinct event_type || '_' || user_id) as n_curves, count(distinct user_id) as n_wells from events")
def distinct_curves(spark, sf_dir):
    return read(spark, sf_dir, "events").agg(F.countDistinct(F.concat_ws("_", "event_type", "user_id")).alias("n_curves"), F.countDistinct("user_id").alias("n_wells"))


# ---- shapes, strings and ranks


@query("select 'part' as kind, p_partkey as id, p_brand as brand, null as market from part union all select 'customer', c_custkey, null, c_mktsegment from customer")
def union_missing(spark, sf_dir):
    p = read(spark, sf_dir, "part").select(F.lit("part").alias("kind"), F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"))
    c = read(spark, sf_dir, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("market"))
    return reshape.stack([p, c])


@query("with a as (select distinct c_nationkey k from customer where c_acctbal > 9000), b as (select distinct s_nationkey k from supplier where s_acctbal > 5000) select count(*) filter (b.k is null) as only_first, count(*) filter (a.k is not null and b.k is not null) as both, count(*) filter (a.k is null) as only_second from a full join b using (k)")
def venn_counts(spark, sf_dir):
    a = read(spark, sf_dir, "customer").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("k"))
    b = read(spark, sf_dir, "supplier").where("s_acctbal > 5000").select(F.col("s_nationkey").alias("k"))
    return reshape.venn(a, b, "k")


@query("select distinct p_brand, p_type from part")
def distinct_rows(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_brand", "p_type").distinct()


@query("select word, count(*) as n from (select unnest(string_split(p_name, ' ')) as word from part) group by 1")
def explode_codes(spark, sf_dir):
    return reshape.counted(read(spark, sf_dir, "part").select(F.explode(F.split("p_name", " ")).alias("word")), F.col("word"), "word")


@query("select cast(floor(value + 0.5) as bigint) as bin, count(*) as n from events group by 1")
def histogram_bin1(spark, sf_dir):
    return reshape.histogram(read(spark, sf_dir, "events"), "value")


@query("select o_orderstatus, o_orderpriority, count(*) as n, round(count(*) / sum(count(*)) over (partition by o_orderstatus), 6) as share from orders group by 1, 2")
def proportion_fill(spark, sf_dir):
    return rounded(reshape.shares(read(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority"), "share")


@query("select event_type, min(value) as low, round(quantile_cont(value, 0.25), 6) as q25, round(quantile_cont(value, 0.5), 6) as q50, round(quantile_cont(value, 0.75), 6) as q75, max(value) as high from events group by 1")
def box_stats(spark, sf_dir):
    return rounded(reshape.box_stats(read(spark, sf_dir, "events"), "event_type", "value"), "q25", "q50", "q75")


@query("select p_partkey, case when p_size < 10 then 'small' when p_size < 30 then 'medium' else 'large' end as label from part")
def case_labels(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") < 10, "small").when(F.col("p_size") < 30, "medium").otherwise("large").alias("label"))


@query("select s_suppkey, left(s_name, 1) as letter from supplier where regexp_matches(s_name, '^S.*[0-4]$')")
def regex_rows(spark, sf_dir):
    return read(spark, sf_dir, "supplier").where(F.col("s_name").rlike("^S.*[0-4]$")).select("s_suppkey", first_letter(F.col("s_name")).alias("letter"))


@query("select n_nationkey, lower(n_name) as cleaned, 'NT' || (5000 + n_nationkey) as nt_number, n_name as unquoted from nation")
def text_clean(spark, sf_dir):
    n = read(spark, sf_dir, "nation").withColumn("s", F.concat("n_name", F.lit("  (NT"), (F.col("n_nationkey") + 5000).cast("string"), F.lit(")")))
    quoted = F.concat(F.lit("['"), F.col("n_name"), F.lit("']"))
    return n.select("n_nationkey", clean_name(F.col("s")).alias("cleaned"), strain_number(F.col("s")).alias("nt_number"), strip_quotes(quoted).alias("unquoted"))


@query("select p_partkey, case when p_name like 'red%' then p_name || ' x y' else array_to_string(list_slice(string_split(p_name || ' x y', ' '), 1, 2), ' ') end as short from part")
def title_first_two(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", capital_first_two(F.concat("p_name", F.lit(" x y")), "red").alias("short"))


@query("with r as (select *, row_number() over (partition by o_custkey order by case o_orderpriority when '1-URGENT' then 3 when '5-LOW' then 2 else 1 end desc, o_orderkey) k from orders where o_orderpriority in ('1-URGENT', '5-LOW', '3-MEDIUM')) select o_custkey, case o_orderpriority when '1-URGENT' then 3 when '5-LOW' then 2 else 1 end as place from r where k = 1")
def category_last(spark, sf_dir):
    o = read(spark, sf_dir, "orders").where(F.col("o_orderpriority").isin("1-URGENT", "5-LOW", "3-MEDIUM")).select("o_custkey", "o_orderpriority")
    last = similarity.last_by_category(o, ["o_custkey"], "o_orderpriority", ["3-MEDIUM", "5-LOW", "1-URGENT"])
    return last.select("o_custkey", F.when(F.col("o_orderpriority") == "1-URGENT", 3).when(F.col("o_orderpriority") == "5-LOW", 2).otherwise(1).alias("place"))


@query("select vec_id, case when vec_id % 3 = 0 then 'mol' || (vec_id + 1) else 'c' || vec_id end as chem_id from embeddings")
def default_ids(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings").withColumn("given", F.when(F.col("vec_id") % 3 != 0, F.concat(F.lit("c"), F.col("vec_id").cast("string"))).when(F.col("vec_id") % 2 == 0, ""))
    return e.select("vec_id", F.coalesce(F.nullif("given", F.lit("")), F.concat(F.lit("mol"), (F.col("vec_id") + 1).cast("string"))).alias("chem_id"))


@query("select event_id, cast(json_extract(props, '$.k') as integer) as k from events")
def json_props(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query("select o_orderpriority, cast(sum(cnt) as bigint) as n from (select o_orderpriority, count(*) cnt from orders group by 1) group by 1 order by 2 desc, 1 limit 3")
def head_sorted(spark, sf_dir):
    return reshape.counted(read(spark, sf_dir, "orders"), F.col("o_orderpriority"), "o_orderpriority").orderBy(F.desc("n"), "o_orderpriority").limit(3)


# ---- splits

SPLIT = """with recursive g as (select p_brand, count(*) as n, min(p_partkey) as f from part group by 1),
 s as (select *, row_number() over (order by n desc, f desc) as k, sum(n) over () as total from g),
 w as (select 0::bigint as k, 0::hugeint as tr, 0::hugeint as va, ''::varchar as p_brand, ''::varchar as split
  union all select s.k, w.tr + case when w.tr + s.n <= 0.8 * s.total then s.n else 0 end,
   w.va + case when w.tr + s.n > 0.8 * s.total and w.tr + w.va + s.n <= 0.9 * s.total then s.n else 0 end, s.p_brand,
   case when w.tr + s.n <= 0.8 * s.total then 'train' when w.tr + w.va + s.n <= 0.9 * s.total then 'valid' else 'test' end from w join s on s.k = w.k + 1)
 select p_partkey, part.p_brand, split from part join w using (p_brand)"""


@query(SPLIT)
def scaffold_split_fold(spark, sf_dir):
    return splits.group_split(read(spark, sf_dir, "part"), "p_brand", "p_partkey").select("p_partkey", "p_brand", "split")


@query("with r as (select vec_id, row_number() over (order by md5('7:' || vec_id)) as k, count(*) over () as n from embeddings) select vec_id, case when k <= floor(0.1 * n) then 'valid' when k <= 2 * floor(0.1 * n) then 'test' else 'train' end as split from r")
def random_split_exact(spark, sf_dir):
    return splits.exact_split(read(spark, sf_dir, "embeddings").select("vec_id"), splits.seeded("vec_id", 7))


@query("select vec_id, case when vec_id % 5 = 0 then 'train' when vec_id % 3 = 0 then 'valid' else 'test' end as split from embeddings")
def split_labels(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings").select("vec_id")
    return splits.label_split(e, e.where("vec_id % 5 = 0"), e.where("vec_id % 3 = 0"), "vec_id")


@query("select cast(floor(l_quantity / 10) as bigint) as bin_a, cast(floor(l_extendedprice / 20000) as bigint) as bin_b, count(*) as n from lineitem group by 1, 2")
def histogram_joint(spark, sf_dir):
    return reshape.histogram2d(read(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice", (10, 20000))


@query("select p_brand, array_to_string(list_sort(list(p_partkey)), ',') as members from part group by 1")
def group_members(spark, sf_dir):
    lists = reshape.grouped_lists(read(spark, sf_dir, "part"), "p_brand", "p_partkey")
    return lists.withColumn("members", F.array_join(F.col("members").cast("array<string>"), ","))


@query("select o_orderkey, case o_orderstatus when 'F' then 'filled' when 'O' then 'open' else 'unknown' end as label from orders")
def label_map(spark, sf_dir):
    return reshape.labelled(read(spark, sf_dir, "orders"), "o_orderstatus", {"F": "filled", "O": "open"}, "unknown").select("o_orderkey", "label")


@query("select s_nationkey, s_suppkey from (select *, min(s_acctbal) over (partition by s_nationkey) as m from supplier) where s_acctbal = m")
def min_rank_rows(spark, sf_dir):
    return reshape.least_ranked(read(spark, sf_dir, "supplier"), "s_nationkey", "s_acctbal").select("s_nationkey", "s_suppkey")


@query("select coalesce(l_returnflag, 'all') as flag, coalesce(l_linestatus, 'all') as status, count(*) as n from lineitem group by rollup (l_returnflag, l_linestatus)")
def rollup_counts(spark, sf_dir):
    """An extension: subtotals."""
    r = read(spark, sf_dir, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"))
    return r.select(F.coalesce("l_returnflag", F.lit("all")).alias("flag"), F.coalesce("l_linestatus", F.lit("all")).alias("status"), "n")


@query("select event_type, epoch_us(time_bucket(interval 1 day, ts)) // 86400000000 as day, count(*) as n, round(avg(value), 6) as mean_value from events group by 1, 2")
def events_by_day(spark, sf_dir):
    """An extension: tumbling windows."""
    e = read(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    w = e.groupBy("event_type", F.window("ts", "1 day")).agg(F.count("*").alias("n"), F.avg("value").alias("mean_value"))
    return rounded(w.select("event_type", F.floor(F.unix_seconds("window.start") / 86400).alias("day"), "n", "mean_value"), "mean_value")


def projection(spark, sf_dir):
    """Two principal components of every compound. SQL has no form for it."""
    out = features.project(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding", 2)
    return out.select("vec_id", *(F.round(F.col("projection")[k], 4).alias(f"pc{k + 1}") for k in range(2)))


QUERIES["projection"] = projection


def growth_fits(spark, sf_dir):
    """A logistic curve for each event series. SQL has no form for it."""
    c = curves(spark, sf_dir).withColumn("curve_id", F.concat_ws("_", "event_type", "user_id"))
    cumulative = F.sum("corrected").over(Window.partitionBy("curve_id").orderBy("point"))
    return plates.fit_curves(c.select("curve_id", "hours", (cumulative / 100).alias("od")), "curve_id", "hours", "od")


QUERIES["growth_fits"] = growth_fits
