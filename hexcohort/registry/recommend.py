"""Plan recommendation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hexcohort import constants as K
from hexcohort.functions.expr import out
from hexcohort.functions.joins import join_small
from hexcohort.operators import recommend as R
from hexcohort.operators.name_rules import first_rules
from hexcohort.operators.numbering import number_rows
from hexcohort.registry import sql as Q
from hexcohort.registry.core import dimension, query
from hexcohort.sources.derive import subscribers, table

_DIM = Q.dim_ctes()
_RULE = Q.plans_by_name("segment_name", "plans")


@query("rule_recommend", Q.sub(**_DIM) + f"SELECT segment_id, segment_name, array_to_string({_RULE}[1:3], ',') AS plans FROM named "
       f"UNION ALL SELECT 999, NULL, {Q.txt(','.join(K.FALLBACK_PLANS))}")
def rule_recommend(spark: SparkSession, sf: str) -> DataFrame:
    dim = dimension(spark, sf).select("segment_id", "segment_name", "plans")
    unknown = dim.limit(1).select(F.lit(999).alias("segment_id"), F.lit(None).cast("string").alias("segment_name"),
                                  F.lit(None).cast("array<string>").alias("plans"))
    return dim.unionByName(unknown).select(
        "segment_id", "segment_name", F.array_join(R.rule_plans(F.col("segment_name"), F.col("plans")), ",").alias("plans"))


_REASON = Q.lookup("plan_id", K.PLAN_REASONS, Q.txt(K.FALLBACK_REASON))


@query("recommend_scores", Q.sub(**_DIM, r=f"SELECT segment_id, segment_name, unnest({_RULE}[1:3]) AS plan_id, generate_subscripts({_RULE}[1:3], 1) AS rank FROM named")
       + f"SELECT segment_id, cast(rank AS INT) AS rank, plan_id, {Q.plan_name('plan_id')} AS plan_name, {Q.plan_price('plan_id')} AS price, "
         f"{Q.rnd('1e0-(rank-1)*15e-2', 2)} AS match_score, replace({_REASON}, '{{name}}', segment_name) AS reason FROM r")
def recommend_scores(spark: SparkSession, sf: str) -> DataFrame:
    return R.scored_recommendations(dimension(spark, sf))


@query("plan_matrix", Q.sub(**_DIM) + "SELECT segment_id, segment_name, " + ", ".join(
    Q.lookup(f"plans[{i}]", {p: p.replace("_", " ").title() for p in K.PLAN_IDS}, "'—'") + f" AS plan_{i}" for i in (1, 2, 3)) + ", n_subscribers FROM named")
def plan_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return R.plan_matrix(dimension(spark, sf))


_BUY = {"cat": f"SELECT unnest({Q.strings(K.PLAN_IDS)}) AS plan_id, generate_subscripts({Q.strings(K.PLAN_IDS)}, 1) AS pos",
        "buy": f"SELECT 'SUB_' || lpad(cast(o_custkey AS VARCHAR), 8, '0') AS subscriber_id, ({Q.strings(K.PLAN_IDS)})[cast(l_partkey % 8 AS INT) + 1] AS plan_id, "
               "cast(count(*) AS DOUBLE) AS weight FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2",
        "im": "SELECT s.subscriber_id, s.segment_id, c.plan_id, c.pos, coalesce(b.weight, 0) AS weight FROM sub s CROSS JOIN cat c "
              "LEFT JOIN buy b ON b.subscriber_id = s.subscriber_id AND b.plan_id = c.plan_id"}


def purchases(spark: SparkSession, sf: str) -> DataFrame:
    """Given interactions: each line item is one purchase of the plan that its part stands for."""
    plan = F.element_at(F.array(*[F.lit(p) for p in K.PLAN_IDS]), (F.col("l_partkey") % 8 + 1).cast("int"))
    lines = table(spark, sf, "lineitem").groupBy("l_orderkey", plan.alias("plan_id")).agg(F.count(F.lit(1)).alias("weight"))
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.concat(
        F.lit("SUB_"), F.lpad(F.col("o_custkey").cast("string"), 8, "0")).alias("subscriber_id"))
    return lines.join(orders, "l_orderkey").select("subscriber_id", "plan_id", "weight")


@query("interaction_matrix", Q.with_(**_BUY) + "SELECT subscriber_id, plan_id, weight FROM buy")
def interaction_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return R.given_interactions(purchases(spark, sf))


def _ruled(spark: SparkSession, sf: str) -> DataFrame:
    df = join_small(subscribers(spark, sf).select("subscriber_id", "segment_id"),
                    dimension(spark, sf).select("segment_id", "segment_name", "plans"), "segment_id")
    return df.select("subscriber_id", R.rule_plans(F.col("segment_name"), F.col("plans")).alias("rule"))


@query("hybrid_merge", Q.sub(**_DIM, **_BUY, cf="SELECT subscriber_id, list(plan_id ORDER BY weight DESC, pos)[1:4] AS cf FROM im GROUP BY 1",
                             m=f"SELECT s.subscriber_id, coalesce({_RULE}, {Q.strings(K.FALLBACK_PLANS)})[1:3] AS rule, cf.cf FROM sub s JOIN cf USING (subscriber_id) LEFT JOIN named n USING (segment_id)")
       + "SELECT subscriber_id, array_to_string(list_concat(rule, list_filter(cf, lambda x: NOT list_contains(rule, x)))[1:5], ',') AS plans FROM m")
def hybrid_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Rule plans filled up to five from each subscriber's strongest given interactions."""
    prefs = R.preference_rows(R.given_interactions(purchases(spark, sf)))
    weights = F.coalesce("weights", F.array(*[F.lit(0.0)] * len(K.PLAN_IDS)))
    pos = [F.struct((-weights[i]).alias("w"), F.lit(i).alias("i"), F.lit(p).alias("p")) for i, p in enumerate(K.PLAN_IDS)]
    cf = F.transform(F.slice(F.array_sort(F.array(*pos)), 1, 4), lambda x: x["p"])
    return _ruled(spark, sf).join(prefs, "subscriber_id", "left").select(
        "subscriber_id", F.array_join(R.merge_plans(F.col("rule"), cf, 5), ",").alias("plans"))


@query("hybrid_als")
def hybrid_als(spark: SparkSession, sf: str) -> DataFrame:
    """Rule plans filled up to five from the factors trained on the given interactions."""
    rules = _ruled(spark, sf)
    cf = R.collaborative_top_n(R.given_interactions(purchases(spark, sf)), rules, 4)
    return rules.join(cf, "subscriber_id").select(
        "subscriber_id", F.array_join(R.merge_plans(F.col("rule"), F.col("cf_plans"), 5), ",").alias("plans"))


_REC = Q.sub(**_DIM, r=f"SELECT s.subscriber_id, coalesce({_RULE}, {Q.strings(K.FALLBACK_PLANS)})[1:3] AS rec, {Q.plans_by_name('s.true_persona_name', 'NULL')} AS truth FROM sub s LEFT JOIN named n USING (segment_id)")


def _recommended(spark: SparkSession, sf: str) -> DataFrame:
    df = join_small(subscribers(spark, sf).select("subscriber_id", "segment_id", "true_persona_name"),
                    dimension(spark, sf).select("segment_id", "segment_name", "plans"), "segment_id")
    return df.withColumn("recommended", R.rule_plans(F.col("segment_name"), F.col("plans")))


@query("precision_at_k", _REC + " UNION ALL ".join(
    f"SELECT {k} AS k, count(*) AS n_evaluated, {Q.out(f'avg(len(list_filter(rec[1:{k}], lambda x: list_contains(truth, x)))/{k}e0)')} AS precision FROM r WHERE truth IS NOT NULL" for k in (1, 3)))
def precision(spark: SparkSession, sf: str) -> DataFrame:
    rec = _recommended(spark, sf)
    one, three = [R.precision_at_k(rec, k=k).select(F.lit(k).alias("k"), "n_evaluated", out(F.col("precision")).alias("precision"))
                  for k in (1, 3)]
    return one.unionByName(three)


@query("plan_coverage", _REC + f"SELECT count(DISTINCT p) AS n_plans, {Q.out('count(DISTINCT p)/8e0')} AS coverage FROM (SELECT unnest(rec) AS p FROM r)")
def coverage(spark: SparkSession, sf: str) -> DataFrame:
    return R.plan_coverage(_recommended(spark, sf)).withColumn("coverage", out(F.col("coverage")))


@query("als_topn")
def als_topn(spark: SparkSession, sf: str) -> DataFrame:
    """Three plans per subscriber from implicit factorisation of all given interactions."""
    top = R.collaborative_top_n(R.given_interactions(purchases(spark, sf)), subscribers(spark, sf))
    return top.select("subscriber_id", F.array_join("cf_plans", ",").alias("plans"))


_BRANDS = "SELECT p_brand AS pattern, row_number() OVER (ORDER BY max(p_retailprice), p_brand) AS place FROM part GROUP BY p_brand"


@query("name_rules", f"WITH r AS ({_BRANDS}), n AS (SELECT DISTINCT p_name || ' ' || p_brand || p_size || ' ' || p_type AS name FROM part) "
       "SELECT name, min(place) AS place, arg_min(pattern, place) AS pattern FROM n JOIN r ON contains(name, pattern) GROUP BY name")
def name_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Which brand a product name belongs to; brands that begin other brands are settled by the order of the rules."""
    part = spark.read.parquet(f"{sf}/part.parquet")
    rules = number_rows(part.groupBy("p_brand").agg(F.max("p_retailprice").alias("top")), "at", ["top", "p_brand"])
    names = part.select(F.concat("p_name", F.lit(" "), "p_brand", F.col("p_size").cast("string"), F.lit(" "), "p_type").alias("name"))
    return first_rules(names, rules.select(F.col("p_brand").alias("pattern"), (F.col("at") + 1).alias("place")))
