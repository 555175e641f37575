"""The library's input tables, derived from the given tables by Spark and by SQL alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom.functions.columns import drop_check_digit
from terraloom.operators.joins import derive_parent_edges
from terraloom.operators.spatial import spatial_neighbors
from terraloom.plans.annual import annual_data
from terraloom.plans.graph import build_graph
from terraloom.registry.base import round6
from terraloom.session import cut_lineage, materialise
from terraloom.sources.polygons import parse_polygons

# Event type -> indicator name; rules for three of the types.
EVENT_NAMES = {
    "click": "population", "view": "surfaceKM2", "error": "unemploymentTotal",
    "purchase": "totalFamilyDwellings", "signup": "birthsTotal",
}
EVENT_COLUMNS = {
    "click": "population", "view": "surface_km2", "error": "unemployment_total_avg",
    "purchase": "total_family_dwellings", "signup": "births_total",
}
EVENT_RANGES = {"click": (0.0, 10.0), "view": (0.0, 20.0), "error": (0.0, 5.0)}
ORDER = ("reference_year", "event_id")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def keyed(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table whose rows grow with the data, to be joined by a shuffle: files of 10 MB hold rows of 100 MB and more."""
    return table(spark, sf, name).hint("merge")


def code5(c: str):
    return F.lpad(F.col(c).cast("string"), 5, "0")


def rent_long(spark: SparkSession, sf: str) -> DataFrame:
    brackets = ["<= 350 euros/mes", "> 350 i <= 450 euros/mes", "> 350 i <= 500 euros/mes",
                "> 450 i <= 600 euros/mes", "> 500 i <= 650 euros/mes", "> 600 euros/mes", "> 650 euros/mes"]
    step = F.round(F.col("l_tax") * 100).cast("int")
    label = F.coalesce(F.get(F.array(*[F.lit(b) for b in brackets]), step), F.lit("unknown"))
    joined = (table(spark, sf, "lineitem")
              .join(keyed(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
              .join(keyed(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")))
    return joined.select(
        F.when(F.col("l_linenumber") <= 6, "Municipi").otherwise("Comarca").alias("ambit_territorial"),
        code5("o_custkey").alias("codi_territorial"), F.col("c_name").alias("nom_territori"),
        F.year("o_orderdate").alias("any"),
        F.concat(F.lit("T"), F.quarter("o_orderdate").cast("string")).alias("periode"),
        F.col("l_quantity").cast("int").alias("habitatges"),
        F.when(F.col("l_discount") < 0.08, F.col("l_extendedprice") / F.col("l_quantity")).alias("renda"),
        label.alias("tram_preus"))


def indicator_long(spark: SparkSession, sf: str) -> DataFrame:
    nation = table(spark, sf, "nation")
    events = table(spark, sf, "events")
    return events.join(nation, (F.col("user_id") % 25) == F.col("n_nationkey")).select(
        "event_id", code5("user_id").alias("municipality_id"),
        F.concat(F.lit("M"), F.col("user_id").cast("string")).alias("municipality_name"),
        F.col("n_name").alias("comarca_name"), F.col("event_type").alias("indicator_id"),
        (F.lit(1998) + F.day("ts")).cast("int").alias("reference_year"), F.col("value").alias("municipality_value"))


def income_long(spark: SparkSession, sf: str) -> DataFrame:
    """Income with six-character ids, as formatted."""
    status = F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        F.concat(code5("o_custkey"), (F.col("o_custkey") % 10).cast("string")).alias("municipality_id"),
        F.concat(F.lit("I"), F.col("o_custkey").cast("string")).alias("municipality_name"),
        F.year("o_orderdate").cast("string").alias("year_label"),
        F.when(status == "F", "PER_CAPITA_EUR").when(status == "O", "PER_CAPITA_INDEX")
        .otherwise("VALUE_EK").alias("indicator_code"),
        F.col("o_totalprice").alias("value"))


def income(spark: SparkSession, sf: str) -> DataFrame:
    """Income with five-character ids, as cleaned."""
    return income_long(spark, sf).withColumn("municipality_id", drop_check_digit("municipality_id")) \
        .withColumnRenamed("year_label", "year")


def places(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as municipalities of their nation."""
    return table(spark, sf, "customer").join(
        F.broadcast(table(spark, sf, "nation")), F.col("c_nationkey") == F.col("n_nationkey")).select(
        code5("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("n_name").alias("parent"))


def provinces(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").join(
        table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("comarca_name"), F.col("r_name").alias("province_name"))


def polygons_text(spark: SparkSession, sf: str) -> DataFrame:
    """One 100 m square per customer on a grid 40 wide, as well-known text."""
    x, y = F.col("c_custkey") % 40 * 100, F.floor(F.col("c_custkey") / 40) * 100
    return table(spark, sf, "customer").select(
        code5("c_custkey").alias("id"),
        F.format_string("POLYGON ((%d %d, %d %d, %d %d, %d %d, %d %d))",
                        x, y, x + 100, y, x + 100, y + 100, x, y + 100, x, y).alias("wkt"))


def polygons(spark: SparkSession, sf: str) -> DataFrame:
    return parse_polygons(polygons_text(spark, sf))


def grid_edges(spark: SparkSession, sf: str) -> DataFrame:
    return spatial_neighbors(polygons(spark, sf), "id")


def graph(spark: SparkSession, sf: str) -> DataFrame:
    """The knowledge graph of the given tables, not materialised."""
    edges = cut_lineage(grid_edges(spark, sf))  # used twice
    return build_graph(
        indicator_long(spark, sf), annual_data(rent_long(spark, sf), income(spark, sf)),
        provinces(spark, sf), edges, derive_parent_edges(edges, places(spark, sf).select("id", "parent")),
        EVENT_NAMES, ORDER, all_concepts=False)


_written: dict[tuple[str, str], DataFrame] = {}


def graph_table(spark: SparkSession, sf: str) -> DataFrame:
    """The graph as a written table partitioned by predicate, made once per session and folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _written:
        _written[key] = materialise(graph(spark, sf), "graph", ["p"])
    return _written[key]


# --- the same tables in SQL -------------------------------------------------------------------

NS = "http://example.com/catalonia-ontology/"
TYPE = "http://www.w3.org/1999/02/22-rdf-syntax-ns#type"
LABEL = "http://www.w3.org/2000/01/rdf-schema#label"
XSD = "http://www.w3.org/2001/XMLSchema#"

_NAME = "case {c} " + " ".join(f"when '{k}' then '{v}'" for k, v in EVENT_NAMES.items()) + " end"


def name_case(c: str) -> str:
    return _NAME.format(c=c)


def _st(s: str, p: str, o: str, kind: str = "uri", lang: str = "", dtype: str = "", num: str = "null") -> str:
    text = "null" if dtype == "double" else o
    return (f"{s} as s, '{p}' as p, cast({text} as varchar) as o, '{kind}' as o_kind, "
            f"{repr(lang) if lang else 'cast(null as varchar)'} as o_lang, "
            f"{repr(XSD + dtype) if dtype else 'cast(null as varchar)'} as o_type, cast({num} as double) as o_num")


def _uri(kind: str, c: str) -> str:
    return f"'{NS}{kind}/' || {c}"


def _named(kind: str, c: str) -> str:
    return f"'{NS}{kind}/' || replace({c}, ' ', '_')"


def _lit(s, p, c, dtype):
    return _st(s, NS + p, c, "literal", dtype=dtype, num=f"round({c}, 6)" if dtype == "double" else c)


CTES = {
    "rent_long": """select case when l_linenumber<=6 then 'Municipi' else 'Comarca' end ambit_territorial,
  lpad(cast(o_custkey as varchar),5,'0') codi_territorial, c_name nom_territori,
  cast(year(o_orderdate) as int) as "any", 'T'||quarter(o_orderdate) periode,
  cast(l_quantity as int) habitatges,
  case when l_discount>=0.08 then null else l_extendedprice/l_quantity end renda,
  case cast(round(l_tax*100) as int)
    when 0 then '<= 350 euros/mes' when 1 then '> 350 i <= 450 euros/mes'
    when 2 then '> 350 i <= 500 euros/mes' when 3 then '> 450 i <= 600 euros/mes'
    when 4 then '> 500 i <= 650 euros/mes' when 5 then '> 600 euros/mes'
    when 6 then '> 650 euros/mes' else 'unknown' end tram_preus
from lineitem join orders on l_orderkey=o_orderkey join customer on o_custkey=c_custkey""",
    "rent_imputed": """select *, coalesce(renda, case tram_preus when '<= 350 euros/mes' then 325.0
    when '> 350 i <= 450 euros/mes' then 400.0 when '> 350 i <= 500 euros/mes' then 425.0
    when '> 450 i <= 600 euros/mes' then 525.0 when '> 500 i <= 650 euros/mes' then 575.0
    when '> 600 euros/mes' then 800.0 when '> 650 euros/mes' then 900.0 end) renda_imputed
from rent_long where ambit_territorial = 'Municipi'""",
    "rent_annual": """select codi_territorial municipality_id, "any", min(nom_territori) municipality_name,
  cast(sum(habitatges) as bigint) total_contracts,
  sum(renda_imputed*habitatges)/nullif(sum(habitatges),0) avg_monthly_rent
from rent_imputed group by 1, 2""",
    "indicator_long": """select event_id, lpad(cast(user_id as varchar),5,'0') municipality_id,
  'M'||user_id municipality_name, n_name comarca_name, event_type indicator_id,
  cast(1998+day(ts) as int) reference_year, value municipality_value
from events join nation on user_id%25=n_nationkey""",
    "indicator_latest": """select * exclude rn from (select *, row_number() over (
    partition by municipality_id, indicator_id order by reference_year desc, event_id desc) rn
  from indicator_long) where rn = 1""",
    "indicator_wide": "select municipality_id, min(comarca_name) comarca_name, " + ", ".join(
        f"max(case when indicator_id='{k}' then municipality_value end) \"{v}\"" for k, v in EVENT_NAMES.items())
    + " from indicator_latest group by 1",
    "income_long": """select lpad(cast(o_custkey as varchar),5,'0')||(o_custkey%10) municipality_id,
  'I'||o_custkey municipality_name, cast(year(o_orderdate) as varchar) year_label,
  case o_orderstatus when 'F' then 'PER_CAPITA_EUR' when 'O' then 'PER_CAPITA_INDEX'
    else 'VALUE_EK' end indicator_code, o_totalprice as value from orders""",
    "income": """select left(municipality_id, length(municipality_id)-1) municipality_id, municipality_name,
  year_label as "year", indicator_code, value from income_long""",
    "income_capita": """select municipality_id, municipality_name, cast("year" as int) as "any",
  value income_per_capita from income where indicator_code='PER_CAPITA_EUR'""",
    "income_wide": """select municipality_id, cast("year" as int) as "any",
  max(case when indicator_code='PER_CAPITA_EUR' then value end) income_per_capita,
  max(case when indicator_code='PER_CAPITA_INDEX' then value end) income_index_cat_100,
  max(case when indicator_code='VALUE_EK' then value end) income_total_thousands_eur
from income group by 1, 2""",
    "annual": """select municipality_id, "any", total_contracts, avg_monthly_rent, income_per_capita,
  income_index_cat_100, income_total_thousands_eur
from rent_annual full outer join income_wide using (municipality_id, "any")""",
    "municipal": """select m.municipality_id, m."any", r.municipality_name, r.total_contracts, r.avg_monthly_rent,
  m.income_per_capita, w.* exclude (municipality_id)
from (select coalesce(r.municipality_id, i.municipality_id) municipality_id, coalesce(r."any", i."any") as "any",
        i.income_per_capita, r.municipality_id rid, r."any" rany
      from rent_annual r full outer join income_capita i
        on r.municipality_id=i.municipality_id and r."any"=i."any") m
left join rent_annual r on r.municipality_id=m.rid and r."any"=m.rany
left join indicator_wide w on w.municipality_id=m.municipality_id""",
    "squares": """select lpad(cast(c_custkey as varchar),5,'0') id, c_custkey%40 x, c_custkey//40 y,
  c_name as name, n_name parent from customer join nation on c_nationkey=n_nationkey""",
    "grid_edges": """select a.id, b.id neighbor_id from squares a cross join (select unnest(range(9)) k)
  join squares b on b.x=a.x+k%3-1 and b.y=a.y+k//3-1 where a.id<>b.id""",
    "parent_edges": """select distinct a.parent, b.parent as neighbor from grid_edges e
  join squares a on a.id=e.id join squares b on b.id=e.neighbor_id where a.parent<>b.parent""",
    "geo_triples": " union ".join(
        f"select {x}" for x in [
            _st(_uri("municipality", "municipality_id"), TYPE, f"'{NS}Municipality'") + " from indicator_long",
            _st(_uri("municipality", "municipality_id"), LABEL, "min(municipality_name)", "literal", "ca")
            + " from indicator_long group by municipality_id",
            _st(_uri("municipality", "municipality_id"), NS + "isInComarca",
                _named("comarca", "min(comarca_name)")) + " from indicator_long group by municipality_id",
            _st(_named("comarca", "comarca_name"), TYPE, f"'{NS}Comarca'") + " from indicator_long",
            _st(_named("comarca", "comarca_name"), LABEL, "comarca_name", "literal", "ca") + " from indicator_long",
            _st(_named("comarca", "comarca_name"), NS + "isInProvince", _named("province", "r_name"))
            + " from indicator_long join nation on n_name=comarca_name join region on n_regionkey=r_regionkey",
            _st(_named("province", "r_name"), TYPE, f"'{NS}Province'")
            + " from indicator_long join nation on n_name=comarca_name join region on n_regionkey=r_regionkey",
            _st(_named("province", "r_name"), LABEL, "r_name", "literal", "ca")
            + " from indicator_long join nation on n_name=comarca_name join region on n_regionkey=r_regionkey",
        ]),
    "edge_triples": " union ".join([
        "select " + _st(_uri("municipality", "id"), NS + "isNeighborOf", _uri("municipality", "neighbor_id"))
        + " from grid_edges",
        "select " + _st(_named("comarca", "parent"), NS + "isAdjacentTo", _named("comarca", "neighbor"))
        + " from parent_edges"]),
    "concept_triples": " union ".join([
        "select " + _st(_uri("indicator", name_case("event_type")), TYPE, f"'{NS}IdescatIndicator'") + " from events",
        "select " + _st(_uri("indicator", name_case("event_type")), LABEL, name_case("event_type"), "literal")
        + " from events"]),
    "observations": f"""select '{NS}observation/' || municipality_id || '_' || {name_case('indicator_id')} obs,
  '{NS}municipality/' || municipality_id m, {name_case('indicator_id')} as name, municipality_id,
  municipality_value v, reference_year y from indicator_latest where municipality_value is not null""",
    "observation_triples": " union all ".join(f"select {x} from observations" for x in [
        _st("obs", TYPE, f"'{NS}IndicatorObservation'"),
        _st("obs", LABEL, "municipality_id || '_' || name", "literal"),
        _lit("obs", "value", "v", "double"), _lit("obs", "referenceYear", "y", "gYear"),
        _st("m", NS + "hasObservation", "obs"), _st("obs", NS + "field", _uri("indicator", "name"))]),
    "points": f"""select *, '{NS}datapoint/' || municipality_id || '_' || "any" d,
  '{NS}municipality/' || municipality_id m from annual""",
    "datapoint_triples": " union all ".join(f"select {x}" for x in [
        _st("d", TYPE, f"'{NS}AnnualDataPoint'") + " from points",
        _st("m", NS + "hasAnnualData", "d") + " from points",
        _lit("d", "referenceYear", '"any"', "gYear") + " from points",
        _lit("d", "avgMonthlyRent", "avg_monthly_rent", "double") + " from points where avg_monthly_rent is not null",
        _lit("d", "totalContracts", "total_contracts", "integer") + " from points where total_contracts is not null",
        _lit("d", "incomePerCapita", "income_per_capita", "double") + " from points where income_per_capita is not null",
        _lit("d", "incomeIndex", "income_index_cat_100", "double") + " from points where income_index_cat_100 is not null",
        _lit("d", "incomeTotal", "income_total_thousands_eur", "double")
        + " from points where income_total_thousands_eur is not null"]),
    "graph": """select * from geo_triples union all select * from edge_triples union all
  select * from concept_triples union all select * from observation_triples union all select * from datapoint_triples""",
}

_NEEDS = {
    "rent_imputed": ["rent_long"], "rent_annual": ["rent_imputed"], "indicator_latest": ["indicator_long"],
    "indicator_wide": ["indicator_latest"], "income": ["income_long"], "income_capita": ["income"],
    "income_wide": ["income"], "annual": ["rent_annual", "income_wide"],
    "municipal": ["rent_annual", "income_capita", "indicator_wide"], "grid_edges": ["squares"],
    "parent_edges": ["grid_edges"], "geo_triples": ["indicator_long"], "edge_triples": ["parent_edges"],
    "observations": ["indicator_latest"], "observation_triples": ["observations"], "points": ["annual"],
    "datapoint_triples": ["points"],
    "graph": ["geo_triples", "edge_triples", "concept_triples", "observation_triples", "datapoint_triples"],
}


def sql(body: str, *views: str, **extra: str) -> str:
    """A statement over the named views, with the views they need; ``extra`` adds own ones."""
    order: list[str] = []

    def need(v: str) -> None:
        for n in _NEEDS.get(v, []):
            need(n)
        if v not in order:
            order.append(v)

    for v in views:
        need(v)
    parts = [f"{v} as materialized ({CTES[v]})" for v in order] + [f"{k} as ({v})" for k, v in extra.items()]
    return ("with " + ",\n".join(parts) + "\n" if parts else "") + body


def comparable(triples: DataFrame) -> DataFrame:
    """Triples for comparison: the text of doubles differs between engines, their value does not."""
    double = F.col("o_type") == XSD + "double"
    return triples.select("s", "p", F.when(double, F.lit(None)).otherwise(F.col("o")).alias("o"), "o_kind",
                          "o_lang", "o_type", F.when(double, round6("o_num")).otherwise(F.col("o_num")).alias("o_num"))
