"""Each operator on the driver's tables."""

from __future__ import annotations

from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression
from pyspark.sql import functions as F

from checks.registry import check
from tractwise.functions import clamp_at_zero, round_int, safe_divide
from tractwise.operators import attribution, columns, groups, joins, models
from tractwise.operators.effects import fit_absorbed
from tractwise.operators.tree_attribution import exact_attributions
from tractwise import sources
from tractwise.session import scratch_path

# ---- joins ---------------------------------------------------------------------


def _year_sql(year: int) -> str:
    return f"""select o_custkey, max(o_totalprice) as spent from orders
      where o_orderdate >= timestamp '{year}-01-01' and o_orderdate < timestamp '{year + 1}-01-01'
      group by o_custkey"""


def _year(t, year: int):
    inside = (F.col("o_orderdate") >= F.lit(f"{year}-01-01").cast("timestamp")) & (
        F.col("o_orderdate") < F.lit(f"{year + 1}-01-01").cast("timestamp")
    )
    return t.orders.where(inside).groupBy("o_custkey").agg(F.max("o_totalprice").alias("spent"))


@check("period_diff", f"""
  select a.o_custkey, a.spent as spent_1998, b.spent as spent_1995, a.spent - b.spent as spent_diff
  from ({_year_sql(1998)}) a join ({_year_sql(1995)}) b on a.o_custkey = b.o_custkey""")
def _(t):
    return joins.period_diff(
        _year(t, 1998), _year(t, 1995), key="o_custkey", measure="spent", labels=("1998", "1995")
    )


PADDED_NATION = "lpad(cast(n_nationkey as string), 2, '0') as code"
PADDED_CUSTOMER = (
    "lpad(cast(c_nationkey as string), 2, '0') || lpad(cast(c_custkey as string), 8, '0') as area"
)
PREFIX_SQL = f"""select area, c_custkey, n_name
  from (select {PADDED_CUSTOMER}, c_custkey from customer) c
  join (select {PADDED_NATION}, n_name from nation) n on c.area like concat(n.code, '%')"""


@check("prefix_join", PREFIX_SQL)
def _(t):
    return joins.prefix_join(
        t.customer.selectExpr(PADDED_CUSTOMER, "c_custkey"),
        t.nation.selectExpr(PADDED_NATION, "n_name"),
        column="area", prefix="code", keep=["n_name"], length=2,
    )


@check("prefix_join_general", """
  with starts as (select distinct left(p_type, n) as start, n
                  from part, (values (1), (2), (5)) l(n))
  select p_partkey, p_type, n as start_length from part join starts on starts_with(p_type, start)""")
def _(t):
    lengths = F.explode(F.array(F.lit(1), F.lit(2), F.lit(5)))
    starts = t.part.select("p_type", lengths.alias("start_length")).select(
        F.left("p_type", "start_length").alias("start"), "start_length"
    ).distinct()
    return joins.prefix_join(
        t.part.select("p_partkey", "p_type"), starts,
        column="p_type", prefix="start", keep=["start_length"],
    )


@check("cast_key_join", """select o_orderkey, o_totalprice, c_name
  from orders join customer on cast(o_custkey as varchar) = cast(c_custkey as varchar)""")
def _(t):
    return joins.cast_key_join(
        t.orders.select("o_orderkey", "o_custkey", "o_totalprice"), t.customer,
        left_key="o_custkey", right_key="c_custkey", keep=["c_name"],
    ).drop("o_custkey")


@check("multi_join", """select c_custkey, n_name, r_name from customer
  join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey""")
def _(t):
    return (
        t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "n_name", "r_name")
    )


@check("cross_dimension", """select n_nationkey, n_name, s_suppkey, s_acctbal
  from supplier cross join nation""")
def _(t):
    return joins.cross_dimension(
        t.supplier.select("s_suppkey", "s_acctbal"), t.nation.select("n_nationkey", "n_name")
    )


@check("cross_dimension_blocks", """select n_nationkey, n_name, s_suppkey, s_acctbal
  from supplier cross join nation""")
def _(t):
    return joins.cross_dimension(
        t.supplier.select("s_suppkey", "s_acctbal"), t.nation.select("n_nationkey", "n_name"),
        max_bytes=0, blocks=8,
    )


URGENT = "o_orderpriority = '1-URGENT'"


@check("semi_restrict", """select c_custkey, c_name, c_acctbal from customer
  where c_custkey in (select o_custkey from orders where o_orderpriority = '1-URGENT')""")
def _(t):
    urgent = t.orders.where(URGENT).select(F.col("o_custkey").alias("c_custkey"))
    return joins.restrict_to(
        t.customer.select("c_custkey", "c_name", "c_acctbal"), urgent, "c_custkey"
    )


@check("semi_restrict_inner", """select c_custkey, c_name, c_acctbal from customer
  join orders on c_custkey = o_custkey where o_orderpriority = '1-URGENT'""")
def _(t):
    urgent = t.orders.where(URGENT).select(F.col("o_custkey").alias("c_custkey"))
    return joins.restrict_to(
        t.customer.select("c_custkey", "c_name", "c_acctbal"), urgent, "c_custkey", how="inner"
    )


@check("union_all", """select c_custkey as key, c_name as name from customer
  union all select s_suppkey, s_name from supplier
  union all select p_partkey, p_name from part""")
def _(t):
    return joins.union_all(
        t.customer.selectExpr("c_custkey as key", "c_name as name"),
        t.supplier.selectExpr("s_name as name", "s_suppkey as key"),
        t.part.selectExpr("p_partkey as key", "p_name as name"),
    )


# ---- columns -------------------------------------------------------------------

LINE = ["l_orderkey", "l_linenumber"]


@check("weighted_exposure", """
  select *, tax_part + quantity_part + price_part as total from (
    select l_orderkey, l_linenumber, l_quantity * cast(0.38423645320197042 as double) as quantity_part,
           l_extendedprice * cast(0.51 as double) as price_part,
           l_tax * cast(0.20323178400562944 as double) as tax_part from lineitem)""")
def _(t):
    exposed = columns.weighted_exposure(
        t.lineitem,
        [("l_quantity", 0.38423645320197042, "quantity_part"),
         ("l_extendedprice", 0.51, "price_part"),
         ("l_tax", 0.20323178400562944, "tax_part")],
        total="total", total_of=["tax_part", "quantity_part", "price_part"],
    )
    return exposed.select(*LINE, "quantity_part", "price_part", "tax_part", "total")


RETURN_COLUMNS = {"A": "l_quantity", "R": "l_tax"}


@check("dispatch_measure", """
  select l_orderkey, l_linenumber, l_returnflag,
    case l_returnflag when 'A' then l_quantity * l_extendedprice
                      when 'R' then l_tax * l_extendedprice end as chosen
  from lineitem""")
def _(t):
    chosen = columns.dispatch_measure(
        t.lineitem, key="l_returnflag", mapping=RETURN_COLUMNS,
        factor="l_extendedprice", output="chosen",
    )
    return chosen.select(*LINE, "l_returnflag", "chosen")


STATUS_CASE = "case l_linestatus when 'F' then 'A' else 'R' end"


@check("dispatch_unpivot", f"""
  with rates as (
    select {STATUS_CASE} as label, max(l_discount) as rate from lineitem group by 1),
  long as (
    select l_orderkey, l_linenumber, 'A' as label, l_quantity as v from lineitem
    union all select l_orderkey, l_linenumber, 'R', l_tax from lineitem)
  select l_orderkey, l_linenumber, label, rate, v * rate as chosen from long join rates using (label)""")
def _(t):
    rates = t.lineitem.groupBy(F.expr(STATUS_CASE).alias("label")).agg(
        F.max("l_discount").alias("rate")
    )
    return columns.dispatch_unpivot(
        t.lineitem, rates, key="label", mapping=RETURN_COLUMNS, factor="rate",
        output="chosen", keep=LINE,
    )


@check("derived_population", """
  select c_custkey, case when raw < 0 then 0 when raw >= 0 then raw end as idle,
    case when raw / nullif(c_nationkey, 0) < 0 then 0
         when raw / nullif(c_nationkey, 0) >= 0 then raw / nullif(c_nationkey, 0) end as idle_share
  from (select c_custkey, c_nationkey, c_acctbal - 1000.0 as raw from customer)""")
def _(t):
    measured = columns.derived_population(
        t.customer, raw=F.col("c_acctbal") - F.lit(1000.0), total="c_nationkey",
        count="idle", share="idle_share",
    )
    return measured.select("c_custkey", "idle", "idle_share")


@check("safe_divide", """
  select l_orderkey, l_linenumber, l_extendedprice / nullif(l_discount, 0) as ratio,
    case when l_discount - l_tax < 0 then 0 when l_discount - l_tax >= 0 then l_discount - l_tax end as margin
  from lineitem""")
def _(t):
    return t.lineitem.select(
        *LINE, safe_divide("l_extendedprice", "l_discount").alias("ratio"),
        clamp_at_zero(F.col("l_discount") - F.col("l_tax")).alias("margin"),
    )


@check("round_cast", """
  select l_orderkey, l_linenumber,
    cast(round(l_extendedprice * (l_discount - l_tax)) as bigint) as net,
    cast(round(l_quantity * 0.5) as bigint) as half, cast(round(l_quantity * -0.5) as bigint) as minus_half
  from lineitem""")
def _(t):
    return t.lineitem.select(
        *LINE,
        round_int(F.col("l_extendedprice") * (F.col("l_discount") - F.col("l_tax"))).alias("net"),
        round_int(F.col("l_quantity") * F.lit(0.5)).alias("half"),
        round_int(F.col("l_quantity") * F.lit(-0.5)).alias("minus_half"),
    )


@check("training_frame", """
  select o_orderkey, o_orderstatus, o_totalprice / nullif(o_custkey, 0) as price_share from orders""")
def _(t):
    derived = t.orders.withColumn("price_share", safe_divide("o_totalprice", "o_custkey"))
    return columns.drop_columns(
        derived, ["o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority", "not_there"]
    )


@check("select_features", "select p_brand, p_size, p_retailprice from part")
def _(t):
    return columns.select_features(t.part, ["p_brand", "p_size", "p_retailprice"])


@check("replace_last", "select * exclude (p_retailprice), p_retailprice * 1.5::double as p_retailprice from part")
def _(t):
    return columns.replace_last(t.part, "p_retailprice", F.col("p_retailprice") * F.lit(1.5))


@check("scenario_grid", """
  select p_partkey, p_name, cast(j as integer) as step, p_retailprice * pow(1.5, j) as p_retailprice
  from part, generate_series(0, 5) g(j)""")
def _(t):
    return columns.scenario_grid(
        t.part.select("p_partkey", "p_retailprice", "p_name"), "p_retailprice", step="step"
    )


@check("random_claims", """
  select l_returnflag, count(*) as n, count(*) as in_range, cast(10 as bigint) as tenths
  from lineitem group by l_returnflag""")
def _(t):
    claims = columns.random_amount(t.lineitem, "num_claims", keys=LINE)
    return claims.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col("num_claims").between(0, 100), 1).otherwise(0)).alias("in_range"),
        F.countDistinct(F.floor(F.col("num_claims") / 10)).alias("tenths"),
    )


@check("struct_expand", """
  select l_orderkey, l_linenumber, l_quantity as quantity, l_extendedprice * l_discount as rebate
  from lineitem""")
def _(t):
    nested = t.lineitem.select(
        *LINE,
        F.struct(
            F.col("l_quantity").alias("quantity"),
            (F.col("l_extendedprice") * F.col("l_discount")).alias("rebate"),
        ).alias("parts"),
    )
    return attribution.expand_struct(nested, "parts", *LINE)


@check("state_filter", "select c_custkey, c_acctbal from customer where c_mktsegment = 'BUILDING'")
def _(t):
    return t.customer.where(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_acctbal")


@check("order_alias", """
  select cast(round(o_totalprice) as bigint) as o_totalprice, o_orderkey from orders
  order by o_totalprice, o_orderkey""")
def _(t):
    return t.orders.select(
        round_int("o_totalprice").alias("o_totalprice"), "o_orderkey"
    ).orderBy(F.asc("o_totalprice"), F.asc("o_orderkey"))


@check("order_by_abs", """
  select c_custkey, c_acctbal, abs(c_acctbal) as abs_value from customer order by abs(c_acctbal) desc""")
def _(t):
    return t.customer.select(
        "c_custkey", "c_acctbal", F.abs("c_acctbal").alias("abs_value")
    ).orderBy(F.desc("abs_value"))


# ---- groups --------------------------------------------------------------------

@check("group_max", f"""
  select left(area, 2) as code, max(c_acctbal) as c_acctbal
  from (select {PADDED_CUSTOMER}, c_acctbal from customer) group by 1""")
def _(t):
    areas = t.customer.selectExpr(PADDED_CUSTOMER, "c_acctbal")
    return groups.group_max(
        areas.select(F.left("area", F.lit(2)).alias("code"), "c_acctbal"), "code", "c_acctbal"
    )


@check("argmax_rows", """
  select c_custkey, c_nationkey, c_acctbal from customer
  join (select c_nationkey, max(c_acctbal) as c_acctbal from customer group by c_nationkey)
    using (c_nationkey, c_acctbal)""")
def _(t):
    return groups.argmax_rows(
        t.customer.select("c_custkey", "c_nationkey", "c_acctbal"), "c_nationkey", "c_acctbal"
    )


TIES_SQL = """
  select l_orderkey, l_linenumber, l_returnflag, l_quantity from lineitem
  join (select l_returnflag, max(l_quantity) as l_quantity from lineitem group by l_returnflag)
    using (l_returnflag, l_quantity)"""


@check("argmax_rows_ties", TIES_SQL)
def _(t):
    return groups.argmax_rows(
        t.lineitem.select(*LINE, "l_returnflag", "l_quantity"), "l_returnflag", "l_quantity"
    )


@check("argmax_rows_shuffled", TIES_SQL)
def _(t):
    return groups.argmax_rows(
        t.lineitem.select(*LINE, "l_returnflag", "l_quantity"), "l_returnflag", "l_quantity",
        max_bytes=0,
    )


def _top_sql(k: int) -> str:
    return f"""select o_orderkey, o_orderpriority, o_totalprice, cast(pop_rank as integer) as pop_rank from (
    select *, row_number() over (partition by o_orderpriority
      order by o_totalprice desc nulls last, o_orderkey) as pop_rank from orders)
  where pop_rank <= {k}"""


def _top(t, k: int):
    return groups.top_k_rows(
        t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice"),
        "o_orderpriority", "o_totalprice", k, tie_break="o_orderkey", rank="pop_rank",
    )


@check("top_k_rows", _top_sql(2))
def _(t):
    return _top(t, 2)


@check("top_k_rows_unique", """select * exclude (pop_rank) from (
    select *, row_number() over (partition by o_orderpriority
      order by o_totalprice desc nulls last, o_orderkey) as pop_rank from orders) where pop_rank <= 3""")
def _(t):
    return groups.top_k_rows(
        t.orders, "o_orderpriority", "o_totalprice", 3, tie_break="o_orderkey", unique=True
    )


@check("top_k_rows_large", _top_sql(1500))
def _(t):
    return _top(t, 1500)


# ---- models --------------------------------------------------------------------

FIT = """with fit as (
    select regr_slope(c_acctbal, c_nationkey) as slope, regr_intercept(c_acctbal, c_nationkey) as icpt,
           avg(c_nationkey) as mean from customer)"""


def _balance_model(t):
    return models.fit_linear(
        t.customer.withColumn("c_nationkey", F.col("c_nationkey").cast("double")),
        label="c_acctbal", numeric=["c_nationkey"],
    )


def _customers(t):
    return t.customer.select("c_custkey", F.col("c_nationkey").cast("double").alias("c_nationkey"), "c_acctbal")


@check("linear_fit", f"""{FIT} select round(slope, 6) as slope, round(icpt, 6) as intercept from fit""")
def _(t):
    regression = _balance_model(t).stages[-1]
    values = [(round(float(regression.coefficients[0]), 6), round(regression.intercept, 6))]
    return t.spark.createDataFrame(values, "slope double, intercept double")


@check("predict", f"""{FIT}
  select c_custkey, cast(c_nationkey as double) as c_nationkey, c_acctbal,
    round(icpt + slope * c_nationkey, 3) as predicted_label from customer, fit""")
def _(t):
    scored = models.predict(_customers(t), _balance_model(t))
    return scored.withColumn("predicted_label", F.round("predicted_label", 3))


@check("model_store", f"""{FIT}
  select c_custkey, round(icpt + slope * c_nationkey, 3) as predicted_label from customer, fit""")
def _(t):
    root = scratch_path(t.spark, "models")
    models.save_model(_balance_model(t), root, "balance")
    models.save_model(_balance_model(t), root, "balance")
    scored = models.predict(_customers(t), models.load_model(root, "balance"))
    return scored.select("c_custkey", F.round("predicted_label", 3).alias("predicted_label"))


@check("categorical_fit", """
  select o_orderkey, round(avg(o_totalprice) over (partition by o_orderpriority), 2) as predicted_label
  from orders""")
def _(t):
    model = models.fit_linear(
        t.orders, label="o_totalprice", numeric=[], categorical=["o_orderpriority"]
    )
    scored = models.predict(t.orders.select("o_orderkey", "o_orderpriority"), model)
    return scored.select("o_orderkey", F.round("predicted_label", 2).alias("predicted_label"))


@check("absorbed_effects", """
  with within as (
    select *, l_quantity - avg(l_quantity) over o as q, l_discount - avg(l_discount) over o as d,
      l_extendedprice - avg(l_extendedprice) over o as y
    from lineitem window o as (partition by l_orderkey)),
  sums as (select sum(q * q) as qq, sum(d * d) as dd, sum(q * d) as qd, sum(q * y) as qy, sum(d * y) as dy from within),
  fit as (select (qy * dd - dy * qd) / (qq * dd - qd * qd) as bq, (dy * qq - qy * qd) / (qq * dd - qd * qd) as bd from sums)
  select l_orderkey, l_linenumber, round(avg(l_extendedprice) over (partition by l_orderkey) + bq * q + bd * d, 4) as predicted_label
  from within, fit""")
def _(t):
    model = fit_absorbed(
        t.lineitem, label="l_extendedprice", numeric=["l_quantity", "l_discount"], categorical=["l_orderkey"])
    scored = model.transform(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_discount"))
    return scored.select("l_orderkey", "l_linenumber", F.round("predicted_label", 4).alias("predicted_label"))


@check("baseline_prediction", f"""{FIT}
  select c_custkey, cast(c_nationkey as double) as c_nationkey, c_acctbal,
    round(icpt + slope * c_nationkey, 3) as baseline from customer, fit""")
def _(t):
    scored = models.baseline_prediction(
        _customers(t), _balance_model(t), keys=["c_custkey"], share="c_nationkey",
        count="c_acctbal", output="baseline",
    )
    return scored.withColumn("baseline", F.round("baseline", 3))


@check("what_if", f"""{FIT}
  select c_custkey, cast(round(0.01 * (c_acctbal / nullif(c_nationkey, 0))) as bigint) as new_labor_force,
    round(icpt + slope * (c_nationkey - 0.01), 2) as new_income,
    cast(round((icpt + slope * (c_nationkey - 0.01) - (icpt + slope * c_nationkey))
      * (c_acctbal / nullif(c_nationkey, 0))) as bigint) as net_income_increase
  from customer, fit""")
def _(t):
    model = _balance_model(t)
    names = dict(keys=["c_custkey"], share="c_nationkey", count="c_acctbal")
    baseline = models.baseline_prediction(_customers(t), model, output="baseline", **names)
    return models.what_if(baseline, model, baseline="baseline", **names)


@check("score_scenarios", """with fit as (
    select regr_slope(p_retailprice, p_size) as slope, regr_intercept(p_retailprice, p_size) as icpt from part)
  select cast(round(p_size * pow(1.5, j)) as bigint) as p_size,
    round(icpt + slope * (p_size * pow(1.5, j)), 3) as predicted_price
  from part, fit, generate_series(0, 5) g(j)""")
def _(t):
    parts = t.part.select("p_retailprice", F.col("p_size").cast("double").alias("p_size"))
    model = models.fit_linear(parts, label="p_retailprice", numeric=["p_size"])
    scored = models.score_scenarios(
        columns.scenario_grid(parts, "p_size"), model, column="p_size", output="predicted_price"
    )
    return scored.withColumn("predicted_price", F.round("predicted_price", 3))


#: Rows that one task of a repartition takes, or so: some 50 MB.
ROWS_A_TASK = 1_000_000


@check("automl_fit", """
  select l_orderkey, l_linenumber, round(3.0 * l_quantity - 2.0 * l_discount + 100.0 * l_tax, 3) as predicted_label
  from lineitem""")
def _(t):
    # All default candidates are searched; the label is a plane, which one of them can meet.
    # The search reads its table many times: one that is not dealt evenly over the cores is stored first,
    # in as many files as there are cores, more if it is large.
    cores = t.spark.sparkContext.defaultParallelism
    held = [r["count"] for r in t.lineitem.groupBy(F.spark_partition_id()).count().collect()]
    lines = t.lineitem.select(
        *LINE, "l_returnflag", "l_quantity", "l_discount", "l_tax",
        F.expr("3.0D * l_quantity - 2.0D * l_discount + 100.0D * l_tax").alias("label"))
    if max(held, default=0) * cores > 2 * sum(held):
        lines = t.stored(lines.repartition(max(cores, -(-sum(held) // ROWS_A_TASK))))
    model = models.fit_best(
        lines, label="label", numeric=["l_quantity", "l_discount", "l_tax"], categorical=["l_returnflag"])
    return models.predict(lines, model).select(*LINE, F.round("predicted_label", 3).alias("predicted_label"))


SEARCH = ["l_quantity", "l_discount"]


@check("model_search_linear", """
  select l_orderkey, l_linenumber, round(3.0 * l_quantity - 2.0 * l_discount, 3) as predicted_label from lineitem""")
def _(t):
    label = F.lit(3.0) * F.col("l_quantity") - F.lit(2.0) * F.col("l_discount")
    lines = t.lineitem.withColumn("label", label)
    model = models.fit_best(
        lines, label="label", numeric=SEARCH, candidates=[DecisionTreeRegressor(), LinearRegression()]
    )
    scored = models.predict(lines, model)
    return scored.select(*LINE, F.round("predicted_label", 3).alias("predicted_label"))


@check("model_search_step", """
  select l_orderkey, l_linenumber, case when l_quantity > 30 then 5.0::double else 1.0::double end as predicted_label
  from lineitem""")
def _(t):
    lines = t.lineitem.withColumn("label", F.when(F.col("l_quantity") > 30, 5.0).otherwise(1.0))
    model = models.fit_best(lines, label="label", numeric=SEARCH, candidates=[
        LinearRegression(), DecisionTreeRegressor(maxDepth=3, maxBins=models.MAX_BINS)
    ])
    return models.predict(lines, model).select(*LINE, "predicted_label")


# ---- attributions --------------------------------------------------------------

def _rounded(attributions, keys, features):
    """Three decimals, and no negative zero."""
    flat = attribution.expand_struct(attributions, "feature_importance", *keys)
    return flat.select(*keys, *[
        F.expr(f"case when round({c}, 3) = 0 then 0D else round({c}, 3) end").alias(c) for c in features
    ])


def _rounded_sql(value: str) -> str:
    return f"case when round({value}, 3) = 0 then 0::double else round({value}, 3) end"


ATTRIBUTED = ["l_quantity", "l_discount"]
# Least squares on two features by their covariances.
ATTRIBUTION_SQL = f"""with sums as (
    select avg(l_quantity) as mq, avg(l_discount) as md,
      var_pop(l_quantity) as qq, var_pop(l_discount) as dd, covar_pop(l_quantity, l_discount) as qd,
      covar_pop(l_extendedprice, l_quantity) as yq, covar_pop(l_extendedprice, l_discount) as yd
    from lineitem),
  fit as (select mq, md, (yq * dd - yd * qd) / (qq * dd - qd * qd) as bq,
                 (yd * qq - yq * qd) / (qq * dd - qd * qd) as bd from sums)
  select l_orderkey, l_linenumber, {_rounded_sql('bq * (l_quantity - mq)')} as l_quantity,
    {_rounded_sql('bd * (l_discount - md)')} as l_discount from lineitem, fit"""


def _price_model(t):
    return models.fit_linear(t.lineitem, label="l_extendedprice", numeric=ATTRIBUTED)


@check("attribution_linear", ATTRIBUTION_SQL)
def _(t):
    baseline = attribution.training_baseline(t.lineitem, ATTRIBUTED)
    return _rounded(attribution.linear_attributions(
        t.lineitem, _price_model(t), baseline=baseline, keys=LINE
    ), LINE, ATTRIBUTED)


@check("attribution_sampled", f"""with sums as (
    select avg(p_size) as ms, avg(p_partkey) as mk,
      var_pop(p_size) as ss, var_pop(p_partkey) as kk, covar_pop(p_size, p_partkey) as sk,
      covar_pop(p_retailprice, p_size) as ys, covar_pop(p_retailprice, p_partkey) as yk
    from part),
  fit as (select ms, mk, (ys * kk - yk * sk) / (ss * kk - sk * sk) as bs,
                 (yk * ss - ys * sk) / (ss * kk - sk * sk) as bk from sums)
  select p_partkey as part, {_rounded_sql('bs * (p_size - ms)')} as p_size,
    {_rounded_sql('bk * (p_partkey - mk)')} as p_partkey from part, fit""")
def _(t):
    features = ["p_size", "p_partkey"]
    parts = t.part.select(
        F.col("p_partkey").alias("part"), "p_retailprice",
        *[F.col(c).cast("double").alias(c) for c in features],
    )
    attributed = attribution.sampled_attributions(
        parts, models.fit_linear(parts, label="p_retailprice", numeric=features),
        baseline=attribution.training_baseline(parts, features), features=features,
        keys=["part"],
    )
    return _rounded(attributed, ["part"], features)


@check("attribution_step", """
  select p_partkey as part, case when p_size > 30 then 4.0::double else 0.0::double end as p_size,
    0.0::double as p_partkey from part""")
def _(t):
    features = ["p_size", "p_partkey"]
    parts = t.part.select(
        F.col("p_partkey").alias("part"), F.when(F.col("p_size") > 30, 5.0).otherwise(1.0).alias("label"),
        *[F.col(c).cast("double").alias(c) for c in features],
    )
    model = models.fit_best(parts, label="label", numeric=features, candidates=[
        DecisionTreeRegressor(maxDepth=3, maxBins=models.MAX_BINS)
    ])
    attributed = attribution.sampled_attributions(
        parts, model, baseline=attribution.training_baseline(parts, features),
        features=features, keys=["part"],
    )
    return _rounded(attributed, ["part"], features)


@check("attribution_exact", """
  with base as (select avg(p_size) as ms, avg(p_partkey % 40) as mk from part),
  both_ways as (
    select p_partkey, case when p_size > 30 and p_partkey % 40 > 10 then 8 else 0 end as own,
      case when p_size > 30 and mk > 10 then 8 else 0 end as by_size,
      case when ms > 30 and p_partkey % 40 > 10 then 8 else 0 end as by_key,
      case when ms > 30 and mk > 10 then 8 else 0 end as none
    from part, base)
  select p_partkey as part, ((by_size - none) + (own - by_key)) / 2.0::double as size,
    ((by_key - none) + (own - by_size)) / 2.0::double as number
  from both_ways""")
def _(t):
    features = ["size", "number"]
    parts = t.part.selectExpr(
        "p_partkey as part", "cast(p_size as double) as size", "cast(p_partkey % 40 as double) as number",
        "case when p_size > 30 and p_partkey % 40 > 10 then 8D else 0D end as label")
    model = models.fit_best(parts, label="label", numeric=features, candidates=[
        DecisionTreeRegressor(maxDepth=3, maxBins=models.MAX_BINS)])
    attributed = exact_attributions(
        parts, model, baseline=attribution.training_baseline(parts, features), features=features, keys=["part"])
    return _rounded(attributed, ["part"], features)


ATTRIBUTION_TABLE = """select o_orderstatus as state_code, lpad(cast(o_orderkey as string), 9, '0') as tract,
    o_totalprice - 250000 as price, cast(o_custkey * 100 as double) as customer,
    cast(-3 * o_orderkey as double) as number from orders"""
LONG = f"""select state_code, tract, feature, importance from ({ATTRIBUTION_TABLE})
  unpivot include nulls (importance for feature in (price, customer, number))"""


def _attribution_table(t):
    predictions = t.orders.selectExpr(
        "o_orderstatus as state", "lpad(cast(o_orderkey as string), 9, '0') as geo_id",
        "named_struct('price', o_totalprice - 250000, 'customer', cast(o_custkey * 100 as double),"
        " 'number', cast(-3 * o_orderkey as double)) as feature_importance",
    )
    return attribution.attribution_table(predictions)


@check("attribution_table", ATTRIBUTION_TABLE)
def _(t):
    return _attribution_table(t)


@check("transpose", LONG)
def _(t):
    return attribution.attributions_long(_attribution_table(t))


TOP = f"""select * from ({ATTRIBUTION_TABLE})
  qualify row_number() over (partition by state_code order by price desc nulls last, tract) <= 2"""
WIDE = f"""select state_code, feature, any_value(importance) filter (slot = 1) as tract_1,
    any_value(importance) filter (slot = 2) as tract_2
  from (select *, row_number() over (partition by state_code, feature order by tract) as slot
    from (select * from ({TOP}) unpivot include nulls (importance for feature in (price, customer, number))))
  group by state_code, feature"""


def _top_attributions(t):
    return groups.top_k_rows(_attribution_table(t), "state_code", "price", 2, tie_break="tract")


@check("transpose_wide", WIDE)
def _(t):
    return attribution.transpose_attributions(_top_attributions(t))


@check("rank_attributions", f"""
  select *, abs(importance) as abs_value,
    cast(row_number() over (partition by state_code, tract order by abs(importance) desc, feature) as integer) as rank
  from ({LONG})""")
def _(t):
    return attribution.rank_attributions(_attribution_table(t))


@check("rank_attributions_wide", f"""
  select *, cast(row_number() over (partition by state_code order by abs(tract_1) desc, feature) as integer) as rank
  from ({WIDE})""")
def _(t):
    return attribution.rank_attributions_wide(
        attribution.transpose_attributions(_top_attributions(t))
    )


# ---- tables and files ----------------------------------------------------------

CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@check("csv_roundtrip", "select * from customer")
def _(t):
    path = scratch_path(t.spark, "customer_csv")
    sources.export_csv(t.customer, path)
    return sources.read_csv(t.spark, path, CUSTOMER)


@check("csv_column", "select lpad(cast(p_size as varchar), 3, '0') as code from part")
def _(t):
    path = scratch_path(t.spark, "part_csv")
    sources.export_csv(t.part.selectExpr("p_partkey", "lpad(cast(p_size as string), 3, '0') as code"), path)
    return sources.read_csv_column(t.spark, path, "code")


@check("partitioned_write", """
  select o_orderkey, o_totalprice, left(o_orderpriority, 1) || '0' as code from orders""")
def _(t):
    coded = t.orders.select(
        "o_orderkey", "o_totalprice",
        F.concat(F.left("o_orderpriority", F.lit(1)), F.lit("0")).alias("code"),
    )
    path = scratch_path(t.spark, "orders_by_code")
    sources.write_grouped(coded, path, "code")
    return sources.read_grouped(t.spark, path, coded.schema)


def _schema(t, name: str) -> str:
    sources.ensure_schema(t.spark, name, scratch_path(t.spark, name))
    return name


@check("replace_table", "select s_suppkey, s_name from supplier")
def _(t):
    name = f"{_schema(t, 'tractwise_checks')}.suppliers"
    sources.replace_table(t.supplier.select("s_suppkey", "s_acctbal"), name)
    sources.replace_table(t.supplier.select("s_suppkey", "s_name"), name)
    return sources.read_table(t.spark, name)


@check("union_append", """select c_custkey as key, c_name as name from customer
  union all select s_suppkey, s_name from supplier""")
def _(t):
    name = f"{_schema(t, 'tractwise_checks')}.names"
    sources.replace_table(t.customer.selectExpr("c_custkey as key", "c_name as name"), name)
    return sources.append_table(t.supplier.selectExpr("s_suppkey as key", "s_name as name"), name)


@check("catalog_find", "select s_suppkey, s_nationkey from supplier")
def _(t):
    for version in ("20210101", "20210202"):
        name = _schema(t, f"prediction_{version}")
        sources.replace_table(
            t.supplier.select("s_suppkey", "s_nationkey", F.lit(version).alias("version")),
            f"{name}.predictions",
        )
    found = sources.read_table(t.spark, f"{sources.latest_schema(t.spark, 'prediction_')}.predictions")
    return found.where(F.col("version") == "20210202").drop("version")


@check("row_report", "select count(*) as rows_written from lineitem")
def _(t):
    count = sources.write_counted(t.lineitem, f"{_schema(t, 'tractwise_checks')}.lines")
    return t.spark.createDataFrame([(count,)], "rows_written bigint")


@check("parameter_query", """select o_orderstatus, count(*) as n, max(o_totalprice) as top from orders
  where o_orderpriority = '2-HIGH' group by o_orderstatus""")
def _(t):
    t.orders.createOrReplaceTempView("tractwise_orders")
    return sources.query(
        t.spark,
        """select o_orderstatus, count(*) as n, max(o_totalprice) as top from identifier(:source)
           where o_orderpriority = :priority group by o_orderstatus""",
        source="tractwise_orders", priority="2-HIGH",
    )


@check("nested_cte", """
  with outer_query as (
    with inner_query as (select c_nationkey, c_acctbal - 0.01::double as shifted from customer)
    select c_nationkey, max(shifted) as top from inner_query group by c_nationkey)
  select n_name, top from outer_query join nation on c_nationkey = n_nationkey""")
def _(t):
    t.customer.createOrReplaceTempView("tractwise_customer")
    t.nation.createOrReplaceTempView("tractwise_nation")
    return t.spark.sql("""
      with outer_query as (
        with inner_query as (select c_nationkey, c_acctbal - 0.01D as shifted from tractwise_customer)
        select c_nationkey, max(shifted) as top from inner_query group by c_nationkey)
      select n_name, top from outer_query join tractwise_nation on c_nationkey = n_nationkey""")


@check("preview", """select o_orderkey, o_totalprice from orders
  order by o_totalprice desc, o_orderkey limit 5""")
def _(t):
    ordered = t.orders.select("o_orderkey", "o_totalprice").orderBy(
        F.desc("o_totalprice"), F.asc("o_orderkey")
    )
    return sources.preview(ordered)
