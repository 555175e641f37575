"""Knowledge-graph triples from tables: structure, adjacency, observations, annual data."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terraloom import schemas, vocab
from terraloom.functions.columns import lit_lang, lit_plain, lit_typed, lookup, term_uri, uri
from terraloom.operators.ordering import latest_per_key

COLUMNS = schemas.TRIPLES.fieldNames()


def _statement(s: Column | str, p: str, o: Column) -> Column:
    return F.struct(
        (F.col(s) if isinstance(s, str) else s).alias("s"), F.lit(p).alias("p"),
        *[o[c].alias(c) for c in COLUMNS[2:]])


def _emit(df: DataFrame, *statements: Column) -> DataFrame:
    """Rows of each input row's statements, without those lacking a subject or an object."""
    return df.select(F.inline(F.array(*statements))).filter("s is not null and o is not null")


def _filled(c: str) -> Column:
    return F.col(c).isNotNull() & (F.col(c) != "")


def geo_triples(places: DataFrame, provinces: DataFrame) -> DataFrame:
    """Municipalities, comarques and provinces with labels and parents.

    ``places``: ``municipality_id, municipality_name, comarca_name``; ``provinces``:
    ``comarca_name, province_name``. A municipality seen under several names or comarques keeps
    the smallest pair; a comarca without a province gets no province statements.
    """
    known = places.filter(_filled("municipality_id") & _filled("comarca_name"))
    municipal = known.groupBy("municipality_id").agg(
        F.min(F.struct("comarca_name", "municipality_name")).alias("place")).select(
        uri("municipality", "municipality_id").alias("m"),
        F.col("place.municipality_name").alias("label"),
        uri("comarca", "place.comarca_name").alias("c"))
    of = provinces.groupBy("comarca_name").agg(F.min("province_name").alias("province_name"))
    comarques = (known.select("comarca_name").distinct().join(of, "comarca_name", "left")
                 .groupBy(uri("comarca", "comarca_name").alias("c"))
                 .agg(F.min("comarca_name").alias("label"), F.min("province_name").alias("province_name"))
                 .withColumn("v", F.when(_filled("province_name"), uri("province", "province_name"))))
    named_provinces = comarques.filter("v is not null").groupBy("v").agg(F.min("province_name").alias("label"))

    def typed(c: str, kind: str) -> tuple[Column, Column]:
        return (_statement(c, vocab.RDF_TYPE, term_uri(F.lit(vocab.NS + kind))),
                _statement(c, vocab.RDFS_LABEL, lit_lang("label")))

    return (
        _emit(municipal, *typed("m", "Municipality"), _statement("m", vocab.NS + "isInComarca", term_uri("c")))
        .unionByName(_emit(comarques, *typed("c", "Comarca"),
                           _statement("c", vocab.NS + "isInProvince", term_uri("v"))))
        .unionByName(_emit(named_provinces, *typed("v", "Province"))))


def edge_triples(edges: DataFrame, a: str, b: str, kind: str, predicate: str) -> DataFrame:
    """One statement per distinct edge between two entities of a kind."""
    pairs = edges.select(uri(kind, a).alias("a"), uri(kind, b).alias("b")).distinct()
    return _emit(pairs, _statement("a", vocab.NS + predicate, term_uri("b")))


def concept_triples(codes: DataFrame, code: str, names: Mapping[str, str]) -> DataFrame:
    """Type and plain label of each indicator concept named by the codes."""
    concepts = codes.select(lookup(code, names).alias("name")).distinct()
    return _emit(
        concepts.select("name", uri("indicator", "name").alias("i")),
        _statement("i", vocab.RDF_TYPE, term_uri(F.lit(vocab.NS + "IdescatIndicator"))),
        _statement("i", vocab.RDFS_LABEL, lit_plain("name")))


def observation_triples(indicators: DataFrame, names: Mapping[str, str],
                        order: tuple[str, ...] = ("reference_year",)) -> DataFrame:
    """The latest observation per municipality and indicator, six statements each.

    The latest row is chosen first; it is then left out if it lacks an id, code, value or year
    or if its indicator has no name.
    """
    cols = ["municipality_id", "indicator_id", "municipality_value", *order]
    latest = latest_per_key(indicators.select(*cols), ["municipality_id", "indicator_id"], order)
    named = latest.withColumn("name", lookup("indicator_id", names)).dropna(
        subset=["municipality_id", "indicator_id", "municipality_value", "reference_year", "name"])
    terms = named.select(
        uri("observation", "municipality_id", "name").alias("obs"),
        uri("municipality", "municipality_id").alias("m"), uri("indicator", "name").alias("i"),
        F.concat_ws("_", "municipality_id", "name").alias("label"),
        F.col("municipality_value").alias("value"), F.col("reference_year").alias("year"))
    return _emit(
        terms,
        _statement("obs", vocab.RDF_TYPE, term_uri(F.lit(vocab.NS + "IndicatorObservation"))),
        _statement("obs", vocab.RDFS_LABEL, lit_plain("label")),
        _statement("obs", vocab.NS + "value", lit_typed("value", vocab.XSD_DOUBLE)),
        _statement("obs", vocab.NS + "referenceYear", lit_typed("year", vocab.XSD_GYEAR)),
        _statement("m", vocab.NS + "hasObservation", term_uri("obs")),
        _statement("obs", vocab.NS + "field", term_uri("i")))


# Column of the annual data -> predicate and literal type.
_MEASURES = {
    "avg_monthly_rent": ("avgMonthlyRent", vocab.XSD_DOUBLE),
    "total_contracts": ("totalContracts", vocab.XSD_INTEGER),
    "income_per_capita": ("incomePerCapita", vocab.XSD_DOUBLE),
    "income_index_cat_100": ("incomeIndex", vocab.XSD_DOUBLE),
    "income_total_thousands_eur": ("incomeTotal", vocab.XSD_DOUBLE),
}


def datapoint_triples(annual: DataFrame) -> DataFrame:
    """One data point per municipality and year, with a statement per measure that is present."""
    keyed = annual.filter(_filled("municipality_id") & F.col("any").isNotNull())
    nan_free = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c)) for c in _MEASURES if c in annual.columns}
    terms = keyed.select(
        uri("datapoint", "municipality_id", "any").alias("d"),
        uri("municipality", "municipality_id").alias("m"), F.col("any").alias("year"),
        *[c.alias(n) for n, c in nan_free.items()])
    return _emit(
        terms,
        _statement("d", vocab.RDF_TYPE, term_uri(F.lit(vocab.NS + "AnnualDataPoint"))),
        _statement("m", vocab.NS + "hasAnnualData", term_uri("d")),
        _statement("d", vocab.NS + "referenceYear", lit_typed("year", vocab.XSD_GYEAR)),
        *[_statement("d", vocab.NS + p, lit_typed(c, t)) for c, (p, t) in _MEASURES.items() if c in nan_free])


def union_triples(*frames: DataFrame) -> DataFrame:
    """Set union: a statement made several times counts once."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.distinct()
