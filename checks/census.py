"""Census-shaped tables derived from the driver's tables, and the whole analysis on them.

A tract is a customer (its nation is the state, its orders of two years are the
income vintages), a ZIP area is a part (its line items of two years likewise).
Measures are whole numbers computed from the key, by one text both engines read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from checks.registry import Tables, check
from tractwise.columns import (
    EXPOSURES, EXPOSURE_TOTAL, FEATURES, GRADUATES, INDUSTRY_COLUMNS, LEAKS, MEASURE, MINORS,
    NUMERIC_FEATURES, SENIORS, SHARE,
)
from tractwise.functions.wkb import wkb_from_polygons
from tractwise.operators.attribution import training_baseline
from tractwise.operators.boundaries import simplify_boundaries
from tractwise.operators.models import predict
from tractwise.plans import importance, scenarios, staging

PARTS = ["unemployed_pop", "not_in_labor_force", "group_quarters", "in_school", *MINORS, *SENIORS]
TRACT_MEASURES = list(dict.fromkeys([
    *PARTS, "total_pop", *[c for c in LEAKS if c != "do_date"],
    *[c for c in NUMERIC_FEATURES if c != "median_income_diff"],
]))
ZIP_MEASURES = list(dict.fromkeys([*PARTS, "total_pop", *INDUSTRY_COLUMNS.values()]))

# Upper bounds that make the raw prime-age measure both negative and positive,
# the population sometimes zero and the enrolment sometimes NULL.
MODULUS = {"unemployed_pop": 401, "not_in_labor_force": 907, "total_pop": 53}


def measure_text(column: str, position: int, key: str) -> str:
    modulus = MODULUS.get(column, 31 + 2 * (position % 20))
    value = f"({key} * {1009 + 37 * position} + {position}) % {modulus}"
    if column == "total_pop":
        return f"cast({value} * 100 as double)"
    if column == "in_school":
        return f"cast(nullif({value}, 0) as double)"
    return f"cast({value} as double)"


def measures(columns: list[str], key: str) -> list[str]:
    return [f"{measure_text(c, i, key)} as {c}" for i, c in enumerate(columns)]


TRACT_ID = "lpad(cast(c_nationkey as string), 2, '0') || lpad(cast(c_custkey as string), 9, '0')"
TRACT = [
    f"{TRACT_ID} as geo_id", "cast('20170101' as string) as do_date",
    "30000.0 + c_acctbal as income_per_capita", *measures(TRACT_MEASURES, "c_custkey"),
]
ZIP_ID = "lpad(cast(p_partkey as string), 7, '0')"
ZIP = [f"{ZIP_ID} as geo_id", *measures(ZIP_MEASURES, "p_partkey")]
STATE = [
    "n_name as state", "'S' || cast(n_nationkey as string) as postal_code",
    "lpad(cast(n_nationkey as string), 2, '0') as fips",
]

LABELS = list(INDUSTRY_COLUMNS)
INDUSTRY_CASE = "case n_nationkey {} else n_name end".format(
    " ".join(f"when {i} then '{label}'" for i, label in enumerate(LABELS))
)
INDUSTRY = [f"{INDUSTRY_CASE} as occupation", "(n_nationkey + 1) / 32.0D as percent_jobs_vulnerable"]

LAST_VERTEX = 24
LON = ("cast(-100 + k % 40 as double) + abs(12 - i % 24) * cast(0.01 as double)"
       " + ((k * 31 + (i % 24) * 173) % 997) * cast(0.00005 as double)")
LAT = ("cast(30 + k % 17 as double) + abs(12 - (i + 6) % 24) * cast(0.01 as double)"
       " + ((k * 7 + (i % 24) * 293) % 991) * cast(0.00005 as double)")


def derived(df: DataFrame, columns: list[str]) -> DataFrame:
    """``columns`` as a generated row, so that the optimizer sees plain columns as
    in a stored table. As aliases of one key, their NULL rules multiply: with
    25 of them in one sum, planning does not end."""
    fields = ", ".join(f"'{name}', {text}" for text, name in (c.rsplit(" as ", 1) for c in columns))
    return df.selectExpr(f"inline(array(named_struct({fields})))")


def tract_2017(t: Tables) -> DataFrame:
    return derived(t.customer, TRACT)


def tract_income(t: Tables, year: int) -> DataFrame:
    ids = t.customer.selectExpr("c_custkey", f"{TRACT_ID} as geo_id")
    paid = (
        t.orders.where(
            f"o_orderdate >= timestamp '{year}-01-01' and o_orderdate < timestamp '{year + 1}-01-01'"
        )
        .groupBy("o_custkey").agg(F.max("o_totalprice").alias("median_income"))
    )
    return ids.join(paid, ids.c_custkey == paid.o_custkey).select("geo_id", "median_income")


def states(t: Tables) -> DataFrame:
    return t.nation.selectExpr(*STATE)


def zip_2017(t: Tables) -> DataFrame:
    return derived(t.part, ZIP)


def zip_income(t: Tables, year: int) -> DataFrame:
    return (
        t.lineitem.where(
            f"l_shipdate >= timestamp '{year}-01-01' and l_shipdate < timestamp '{year + 1}-01-01'"
        )
        .groupBy(F.expr("lpad(cast(l_partkey as string), 7, '0')").alias("geo_id"))
        .agg(F.max("l_extendedprice").alias("median_income"))
    )


def zip_boundaries(t: Tables) -> DataFrame:
    outline = f"transform(sequence(0, {LAST_VERTEX}), i -> named_struct('lon', {LON}, 'lat', {LAT}))"
    return (
        t.part.selectExpr("p_partkey as k", "p_brand as state_name")
        .selectExpr("lpad(cast(k as string), 7, '0') as zip_code", "state_name",
                    f"{outline} as zip_code_geom")
    )


def industries(t: Tables) -> DataFrame:
    return t.nation.selectExpr(*INDUSTRY)


def tract_change(t: Tables) -> DataFrame:
    return staging.income_change(tract_income(t, 1998), tract_income(t, 1995))


def zip_change(t: Tables) -> DataFrame:
    return staging.income_change(zip_income(t, 1998), zip_income(t, 1996))


def tracts(t: Tables) -> DataFrame:
    return staging.tract_all(tract_2017(t), tract_change(t), states(t))


def stored_tracts(t: Tables) -> DataFrame:
    return t.stored(tracts(t))


def zips(t: Tables) -> DataFrame:
    return staging.zip_exposure(zip_2017(t), zip_change(t), zip_boundaries(t))


def outline_measures(df: DataFrame, geom: str) -> DataFrame:
    """Replace an outline by whole numbers that identify its vertices."""
    def total(axis: str) -> F.Column:
        cells = F.transform(geom, lambda p: F.round(p[axis] * 20000).cast("bigint"))
        return F.aggregate(cells, F.lit(0).cast("bigint"), lambda a, b: a + b)
    return df.withColumns({
        "n_vertices": F.size(geom).cast("bigint"), "sum_lon": total("lon"), "sum_lat": total("lat"),
    }).drop(geom)


# ---- SQL for the derived inputs ------------------------------------------------

def _select(columns: list[str], table: str) -> str:
    return f"select {', '.join(columns)} from {table}".replace("32.0D", "cast(32 as double)")


def _change(source: str) -> str:
    return f"""
      select a.geo_id, a.median_income as median_income_2018, b.median_income as median_income_2015,
             a.median_income - b.median_income as median_income_diff
      from {source}_new a join {source}_old b on a.geo_id = b.geo_id
      where a.median_income - b.median_income is not null"""


def _tract_income(year: int) -> str:
    return f"""select {TRACT_ID} as geo_id, max(o_totalprice) as median_income
      from orders join customer on o_custkey = c_custkey
      where o_orderdate >= timestamp '{year}-01-01' and o_orderdate < timestamp '{year + 1}-01-01'
      group by 1"""


def _zip_income(year: int) -> str:
    return f"""select lpad(cast(l_partkey as string), 7, '0') as geo_id, max(l_extendedprice) as median_income
      from lineitem
      where l_shipdate >= timestamp '{year}-01-01' and l_shipdate < timestamp '{year + 1}-01-01'
      group by 1"""


RAW = (
    "unemployed_pop + not_in_labor_force - group_quarters - (in_school"
    + "".join(f" - {c}" for c in MINORS) + ") - (" + " + ".join(SENIORS) + ")"
)
CLAMPED = f"""case when {RAW} < 0 then 0 when {RAW} >= 0 then {RAW} end as {MEASURE},
      case when ({RAW}) / nullif(total_pop, 0) < 0 then 0
           when ({RAW}) / nullif(total_pop, 0) >= 0 then ({RAW}) / nullif(total_pop, 0) end as {SHARE}"""

TRACT_WITH = f"""
  tract_2017 as ({_select(TRACT, 'customer')}),
  states as ({_select(STATE, 'nation')}),
  tract_new as ({_tract_income(1998)}), tract_old as ({_tract_income(1995)}),
  tract_change as ({_change('tract')}),
  tract_all as (
    select s.postal_code as state, c.*, i.median_income_diff, {CLAMPED}
    from tract_2017 c join tract_change i on c.geo_id = i.geo_id
    join states s on c.geo_id like concat(s.fips, '%')),
  max_tracts as (
    select left(geo_id, 2) as fips, max({MEASURE}) as top from tract_all group by 1),
  disengaged as (
    select s.postal_code as state, t.geo_id, m.top as {MEASURE}, {SHARE}
    from tract_all t join max_tracts m on left(t.geo_id, 2) = m.fips and t.{MEASURE} = m.top
    join states s on s.fips = m.fips),
  top_tracts as (
    select {', '.join(FEATURES)} from (
      select *, row_number() over (partition by state order by {MEASURE} desc nulls last, geo_id) as pop_rank
      from tract_all)
    where pop_rank <= 2),
  scenario_tracts as (select * from top_tracts where geo_id in (select geo_id from disengaged))"""

SCENARIOS = f"""select t.* exclude ({GRADUATES}), {GRADUATES} * pow(1.5, j) as {GRADUATES}
  from scenario_tracts t, generate_series(0, 5) g(j) where state in (select postal_code from states)"""

# A NULL share counts as the training mean, in the fit and in every prediction.
INCOME_FIT = f"""
  income_fit as (
    select regr_slope(income_per_capita, coalesce({SHARE}, mean)) as slope,
           regr_intercept(income_per_capita, coalesce({SHARE}, mean)) as icpt, any_value(mean) as mean
    from tract_all, (select avg({SHARE}) as mean from tract_all)),
  predicted as (
    select *, icpt + slope * coalesce({SHARE}, mean) as now,
           icpt + slope * coalesce({SHARE} - 0.01, mean) as shifted
    from disengaged, income_fit)"""

OUTLINE_WITH = f"""
  points as (
    select k, i, {LON} as lon, {LAT} as lat
    from (select p_partkey as k from part) p, generate_series(0, {LAST_VERTEX}) g(i)),
  metres as (
    select *, radians(lon) * 6371008.8 * cos(radians(avg(lat) over (partition by k))) as x,
           radians(lat) * 6371008.8 as y from points),
  spans(k, a, b) as (
    select p_partkey, cast(0 as bigint), cast({LAST_VERTEX} as bigint) from part
    union all
    select k, unnest([a, split]), unnest([split, b]) from (
      select k, a, b, first(i order by d2 desc, i) as split, max(d2) as far from (
        select s.k, s.a, s.b, p.i,
          pow(p.x - pa.x - u * (pb.x - pa.x), 2) + pow(p.y - pa.y - u * (pb.y - pa.y), 2) as d2
        from spans s
        join metres pa on pa.k = s.k and pa.i = s.a
        join metres pb on pb.k = s.k and pb.i = s.b
        join metres p on p.k = s.k and p.i > s.a and p.i < s.b,
        lateral (select case when pow(pb.x - pa.x, 2) + pow(pb.y - pa.y, 2) > 0
          then least(1, greatest(0, ((p.x - pa.x) * (pb.x - pa.x) + (p.y - pa.y) * (pb.y - pa.y))
                 / (pow(pb.x - pa.x, 2) + pow(pb.y - pa.y, 2)))) else 0 end as u) l)
      group by k, a, b)
    where far > 2100.0 * 2100.0),
  kept as (select k, a as i from spans union select k, b from spans),
  outlines as (
    select lpad(cast(k as string), 7, '0') as zip_code, count(*) as n_vertices,
           cast(sum(round(lon * 20000)) as bigint) as sum_lon, cast(sum(round(lat * 20000)) as bigint) as sum_lat
    from kept join points using (k, i) group by k)"""

EXPOSED = ", ".join(
    f"{column} * cast({weight!r} as double) as {out}" for column, weight, out in EXPOSURES
)
ZIP_WITH = f"""
  zip_2017 as ({_select(ZIP, 'part')}),
  industries as ({_select(INDUSTRY, 'nation')}),
  zip_new as ({_zip_income(1998)}), zip_old as ({_zip_income(1996)}),
  zip_change as ({_change('zip')}),
  {OUTLINE_WITH.strip()},
  zip_base as (
    select p.p_brand as state_name, c.*, i.median_income_diff, {EXPOSED}, o.n_vertices, o.sum_lon, o.sum_lat
    from zip_2017 c join zip_change i on c.geo_id = i.geo_id
    join outlines o on c.geo_id = o.zip_code
    join part p on c.geo_id = {ZIP_ID}),
  zip_exposure as (select *, {' + '.join(EXPOSURE_TOTAL)} as total_vulnerable from zip_base)"""

WORKERS = "case occupation {} end * percent_jobs_vulnerable".format(
    " ".join(f"when '{label}' then {column}" for label, column in INDUSTRY_COLUMNS.items())
)


# ---- queries -------------------------------------------------------------------

@check("median_income_diff_by_tract", f"with {TRACT_WITH} select * from tract_change")
def _(t):
    return tract_change(t)


@check("median_income_diff_by_zipcode",
       f"with zip_new as ({_zip_income(1998)}), zip_old as ({_zip_income(1996)}) {_change('zip')}")
def _(t):
    return zip_change(t)


@check("census_tract_all", f"with {TRACT_WITH} select * from tract_all")
def _(t):
    return tracts(t)


@check("census_tract_training",
       f"with {TRACT_WITH} select * exclude ({', '.join(LEAKS)}) from tract_all")
def _(t):
    return staging.tract_training(tracts(t))


@check("max_not_in_labor_per_state", f"with {TRACT_WITH} select * from disengaged")
def _(t):
    return scenarios.most_disengaged(stored_tracts(t), states(t))


@check("ml_input_automl_baseline", f"with {TRACT_WITH} select * from top_tracts")
def _(t):
    return scenarios.top_tracts(stored_tracts(t))


def scenario_tracts(all_tracts, t):
    return scenarios.scenario_tracts(
        scenarios.top_tracts(all_tracts), scenarios.most_disengaged(all_tracts, states(t))
    )


@check("max_automl_scenario", f"with {TRACT_WITH} select * from scenario_tracts")
def _(t):
    return scenario_tracts(stored_tracts(t), t)


@check("ml_input_automl_scenarios", f"with {TRACT_WITH} {SCENARIOS}")
def _(t):
    return scenarios.graduate_scenarios(scenario_tracts(stored_tracts(t), t), states(t))


def income_inputs(t):
    all_tracts = stored_tracts(t)
    model = scenarios.income_model(staging.tract_training(all_tracts))
    disengaged = scenarios.most_disengaged(all_tracts, states(t))
    return scenarios.economic_impact_input(disengaged, model), model


@check("ml_input_econ_impact", f"""with {TRACT_WITH}, {INCOME_FIT}
  select state, geo_id, {SHARE}, {MEASURE}, round(now, 3) as baseline_avg_income from predicted""")
def _(t):
    inputs, _ = income_inputs(t)
    return inputs.withColumn("baseline_avg_income", F.round("baseline_avg_income", 3))


@check("economic_impact", f"""with {TRACT_WITH}, {INCOME_FIT}
  select state, geo_id,
    cast(round(0.01 * ({MEASURE} / nullif({SHARE}, 0))) as bigint) as new_labor_force,
    round(shifted, 2) as new_income,
    cast(round((shifted - now) * ({MEASURE} / nullif({SHARE}, 0))) as bigint) as net_income_increase
  from predicted""")
def _(t):
    return scenarios.economic_impact(*income_inputs(t))


@check("census_zip", f"with recursive {ZIP_WITH} select * from zip_exposure")
def _(t):
    return outline_measures(zips(t), "zip_geom")


@check("census_zip_xjoin_industries",
       f"with recursive {ZIP_WITH} select * from industries cross join zip_exposure")
def zips_by_industry(t):
    return staging.zip_by_industry(outline_measures(zips(t), "zip_geom"), industries(t))


@check("census_zip_vuln_workers", f"""with recursive {ZIP_WITH}
  select *, {WORKERS} as vulnerable_employees from industries cross join zip_exposure""")
def _(t):
    return staging.zip_vulnerable_workers(zips_by_industry(t)).drop("num_claims")


@check("census_zip_non_labor", f"""with recursive {ZIP_WITH}
  select *, {WORKERS} as vulnerable_employees, {CLAMPED} from industries cross join zip_exposure""")
def _(t):
    workers = staging.zip_vulnerable_workers(zips_by_industry(t))
    return staging.zip_non_labor(workers).drop("num_claims")


@check("simplify_boundaries", f"with recursive {OUTLINE_WITH} select * from outlines")
def _(t):
    shapes = zip_boundaries(t).select("zip_code", "zip_code_geom")
    return outline_measures(simplify_boundaries(shapes, "zip_code_geom"), "zip_code_geom")


@check("simplify_wkt", f"with recursive {OUTLINE_WITH} select * from outlines")
def _(t):
    point = "concat_ws(' ', cast(p.lon as string), cast(p.lat as string))"
    shapes = zip_boundaries(t).selectExpr(
        "zip_code", f"concat('POLYGON ((', array_join(transform(zip_code_geom, p -> {point}), ', '), '))') as text"
    )
    simple = simplify_boundaries(shapes, "text", output="polygons").drop("text")
    return outline_measures(
        simple.select("zip_code", F.col("polygons")[0][0].alias("outline")), "outline"
    )


@check("simplify_wkb", f"with recursive {OUTLINE_WITH} select * from outlines")
def _(t):
    one = zip_boundaries(t).select("zip_code", F.array(F.array("zip_code_geom")).alias("polygons"))
    # both byte orders in one column
    either = F.when(F.col("zip_code").endswith("1"), wkb_from_polygons("polygons", big_endian=True)).otherwise(
        wkb_from_polygons("polygons"))
    simple = simplify_boundaries(one.select("zip_code", either.alias("shape")), "shape")
    return outline_measures(simple.select("zip_code", F.col("shape")[0][0].alias("outline")), "outline")


# A share that is a known function of two features: the search over all kinds of models
# must find the linear one, and every number that follows has a plain answer.
KNOWN = f"(cast(0.2500123 as double) + {GRADUATES} * cast(0.001 as double) - poverty * cast(0.0005 as double))"


def known_model(all_tracts):
    training = staging.tract_training(all_tracts).withColumn(SHARE, F.expr(KNOWN))
    return training, scenarios.labor_model(training)


@check("automl_labor_scenarios", f"""with {TRACT_WITH}, grid as ({SCENARIOS})
  select cast(round({GRADUATES}) as bigint) as {GRADUATES}, round({KNOWN}, 4) as {SHARE} from grid""")
def _(t):
    all_tracts = stored_tracts(t)
    _, model = known_model(all_tracts)
    grid = scenarios.graduate_scenarios(scenario_tracts(all_tracts, t), states(t))
    return scenarios.scenario_report(grid, model).withColumn(SHARE, F.round(SHARE, 4))


PARTS_OF = f"""means as (select avg({GRADUATES}) as mg, avg(poverty) as mp from tract_all),
  parts as (
    select state, geo_id, {KNOWN} as now, cast(0.001 as double) * ({GRADUATES} - mg) as graduates,
      cast(-0.0005 as double) * (poverty - mp) as poor
    from top_tracts, means)"""


def known_predictions(t):
    all_tracts = t.stored(tracts(t))
    training, model = known_model(all_tracts)
    return importance.scored_predictions(scenarios.top_tracts(all_tracts), training, model)


@check("scored_predictions", f"""with {TRACT_WITH}, {PARTS_OF}
  select state, geo_id, round(now, 6) as predicted_label, round(graduates, 6) as graduates, round(poor, 6) as poor,
    round(graduates + poor, 6) as together from parts""")
def _(t):
    parts = [F.col(f"feature_importance.{c}") for c in importance.MODEL_FEATURES]
    return known_predictions(t).select(
        "state", "geo_id", F.round("predicted_label", 6).alias("predicted_label"),
        F.round(f"feature_importance.{GRADUATES}", 6).alias("graduates"),
        F.round("feature_importance.poverty", 6).alias("poor"), F.round(sum(parts), 6).alias("together"))


FEATURE_NAMES = ", ".join(f"'{c}'" for c in importance.MODEL_FEATURES)


@check("importance_report", f"""with {TRACT_WITH}, {PARTS_OF},
  numbered as (select *, row_number() over (partition by state order by geo_id) as n from parts),
  entries as (
    select state, n, feature, case feature when '{GRADUATES}' then round(graduates, 6) when 'poverty' then round(poor, 6)
      else 0.0::double end as importance
    from numbered, (select unnest([{FEATURE_NAMES}]) as feature)),
  turned as (
    select state, feature, max(importance) filter (n = 1) as tract_1, max(importance) filter (n = 2) as tract_2
    from entries group by state, feature)
  select *, cast(row_number() over (partition by state order by abs(tract_1) desc nulls last, feature) as int) as rank
  from turned""")
def _(t):
    table = importance.importance_table(known_predictions(t))
    rounded = table.select("state_code", "tract", *[
        F.expr(f"case when round(`{c}`, 6) = 0 then 0D else round(`{c}`, 6) end").alias(c)
        for c in importance.MODEL_FEATURES])
    return importance.importance_report(t.stored(rounded))


@check("feature_importance_by_state", f"""with {TRACT_WITH}
  select state, geo_id as tract, {len(importance.MODEL_FEATURES)}::bigint as features,
    {sum(range(len(importance.MODEL_FEATURES) + 1))}::bigint as ranks, true as adds_up, true as in_order
  from top_tracts""")
def _(t):
    """The real share: what the searched model's importances must fulfil, whichever model it is."""
    all_tracts = stored_tracts(t)
    training = staging.tract_training(all_tracts)
    model = scenarios.labor_model(training)
    scored = t.stored(importance.scored_predictions(scenarios.top_tracts(all_tracts), training, model))
    baseline = training_baseline(training, NUMERIC_FEATURES, ["state"], label=SHARE)
    types = {f.name: f.dataType for f in training.schema}
    base = predict(t.spark.range(1).select(*[
        F.lit(baseline[c]).cast(types[c]).alias(c) for c in importance.MODEL_FEATURES]), model).first().predicted_label
    ranked = importance.ranked_importance(importance.importance_table(scored))
    sizes = F.transform(F.sort_array(F.collect_list(F.struct("rank", "abs_value"))), lambda x: x["abs_value"])
    found = ranked.groupBy("state", "tract").agg(
        F.count(F.lit(1)).alias("features"), F.sum("rank").alias("ranks"), F.sum("importance").alias("total"),
        (sizes == F.reverse(F.sort_array(F.collect_list("abs_value")))).alias("in_order"))
    predicted = scored.select(F.col("geo_id").alias("tract"), "predicted_label")
    return found.join(predicted, "tract").select(
        "state", "tract", "features", "ranks",
        (F.abs(F.col("predicted_label") - F.col("total") - F.lit(base)) < 1e-9).alias("adds_up"), "in_order")
