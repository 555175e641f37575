import json

import pytest
from pyspark.sql import functions as F

from terraloom import schemas, vocab
from terraloom.operators import inference as I
from terraloom.operators import patterns as P
from terraloom.operators import retrieval as R
from terraloom.operators import triples as G
from terraloom.operators.aggregate import graph_counts
from terraloom.plans.annual import annual_data, municipal_annual, municipal_annual_v1
from terraloom.plans.graph import build_graph
from terraloom.session import materialise

NS = vocab.NS


@pytest.fixture(scope="module")
def inputs(spark):
    indicators = spark.createDataFrame([
        ("08019", "Zeta", "Alt Camp", "f171", 2020, 10.0), ("08019", "Alpha", "Alt Camp", "f171", 2021, 30000.0),
        ("08019", "Alpha", "Alt Camp", "f999", 2021, 1.0), ("08101", "Beta", "Osona", "f171", 2022, None), ("08101", "Beta", "Osona", "f171", 2021, 7.0),
        ("17079", "Girona", "Unknown", "f36", 2021, 5.0), ("", "Empty", "Osona", "f171", 2021, 1.0), (None, "Null", "Lost", "f171", 2021, 1.0), ("25001", "NoCom", None, "f171", 2021, 3.0)],
        "municipality_id string, municipality_name string, comarca_name string, indicator_id string, reference_year int, municipality_value double")
    rent = spark.createDataFrame([
        ("Municipi", "08019", "Alpha", 2021, 2, 500.0, "x"), ("Municipi", "08019", "Alpha", 2021, 2, None, "> 650 euros/mes"), ("Municipi", "08101", "Beta", 2021, 3, None, "unknown"),
        ("Comarca", "08019", "Alpha", 2021, 9, 1.0, "x"), ("Municipi", None, "Nobody", 2021, 1, 5.0, "x")],
        "ambit_territorial string, codi_territorial string, nom_territori string, any int, habitatges int, renda double, tram_preus string")
    income = spark.createDataFrame([
        ("08019", "Ai", "2021", "PER_CAPITA_EUR", 20000.0), ("08019", "Ai", "2021", "VALUE_EK", 7.0), ("08019", "Ai", "2020", "PER_CAPITA_INDEX", 99.0),
        ("17079", "Gi", "2021", "PER_CAPITA_EUR", 15000.0), ("17079", "Gi", "x", "PER_CAPITA_EUR", 1.0), ("17079", "Gi", "2021", "OTHER", 3.0)],
        "municipality_id string, municipality_name string, year string, indicator_code string, value double")
    return indicators, rent, income


@pytest.fixture(scope="module")
def graph(spark, inputs):
    indicators, rent, income = inputs
    provinces = spark.createDataFrame([("Alt Camp", "Tarragona"), ("Osona", "Barcelona"), ("Unknown", None)], "comarca_name string, province_name string")
    near = spark.createDataFrame([("08019", "08101"), ("08101", "08019"), ("08019", "99999"), ("08019", "08101")], "id string, neighbor_id string")
    adjacent = spark.createDataFrame([("Alt Camp", "Osona"), ("Osona", "Alt Camp")], "parent string, neighbor string")
    return materialise(build_graph(indicators, annual_data(rent, income), provinces, near, adjacent), "graph", ["p"])


def statements(graph, p):
    return {(r.s.replace(NS, ""), r.o.replace(NS, "")) for r in graph.filter(F.col("p") == p).collect()}


def test_annual_tables(inputs, rows):
    indicators, rent, income = inputs
    annual = municipal_annual(rent, income, indicators)
    got = rows(annual, "municipality_id", "any", "municipality_name", "total_contracts", "avg_monthly_rent", "income_per_capita", "comarca_name", "population")
    assert got == [(None, 2021, "Nobody", 1, 5.0, None, None, None), ("08019", 2021, "Alpha", 4, 700.0, 20000.0, "Alt Camp", 30000.0),
                   ("08101", 2021, "Beta", 3, None, None, "Osona", None), ("17079", None, None, None, None, 1.0, "Unknown", None),
                   ("17079", 2021, None, None, None, 15000.0, "Unknown", None)]
    assert annual.columns[:7] == ["municipality_id", "any", "municipality_name", "total_contracts", "avg_monthly_rent", "income_per_capita", "comarca_name"]
    older = municipal_annual_v1(rent, income, indicators)
    assert older.columns == vocab.ANNUAL_V1_COLUMNS
    assert rows(older.filter("municipality_id in ('08101','17079') and any = 2021"), "municipality_id", "municipality_name", "avg_monthly_rent_eur") == [
        ("08101", "Beta", 0.0), ("17079", "Gi", None)]
    alone = municipal_annual_v1(rent, income, None)
    assert alone.columns == vocab.ANNUAL_V1_COLUMNS and alone.count() == older.count()
    with pytest.raises(ValueError, match="comarca_name"):
        municipal_annual_v1(rent, income, indicators.drop("comarca_name"))
    wide = annual_data(rent, income, discover=True)
    assert "OTHER" in wide.columns and wide.filter("any is null or municipality_id is null").count() == 0


def test_structure(graph):
    assert statements(graph, vocab.RDFS_LABEL) >= {("municipality/08019", "Alpha"), ("comarca/Alt_Camp", "Alt Camp"), ("province/Tarragona", "Tarragona")}
    assert ("municipality/08019", "Zeta") not in statements(graph, vocab.RDFS_LABEL)
    assert statements(graph, NS + "isInComarca") == {("municipality/08019", "comarca/Alt_Camp"), ("municipality/08101", "comarca/Osona"), ("municipality/17079", "comarca/Unknown")}
    assert statements(graph, NS + "isInProvince") == {("comarca/Alt_Camp", "province/Tarragona"), ("comarca/Osona", "province/Barcelona")}
    assert statements(graph, NS + "isNeighborOf") == {("municipality/08019", "municipality/08101"), ("municipality/08101", "municipality/08019"), ("municipality/08019", "municipality/99999")}
    assert statements(graph, NS + "isAdjacentTo") == {("comarca/Alt_Camp", "comarca/Osona"), ("comarca/Osona", "comarca/Alt_Camp")}
    assert graph.filter(F.col("o").endswith("IdescatIndicator")).count() == 15


def test_observations_and_points(graph):
    # The latest Beta observation lacks a value, so there is none; an unmapped indicator neither.
    assert ("observation/08019_population", "30000.0") in statements(graph, NS + "value")
    assert not [s for s, _ in statements(graph, NS + "value") if s.startswith("observation/08101")]
    assert statements(graph, NS + "totalContracts") == {("datapoint/08019_2021", "4"), ("datapoint/08101_2021", "3")}
    assert statements(graph, NS + "avgMonthlyRent") == {("datapoint/08019_2021", "700.0")}
    assert statements(graph, NS + "incomeIndex") == {("datapoint/08019_2020", "99.0")}
    assert statements(graph, NS + "referenceYear") >= {("datapoint/17079_2021", "2021")}


def test_the_graph_is_a_set(graph):
    assert graph.count() == graph.distinct().count()
    assert G.union_triples(graph, graph).count() == graph.count()
    assert graph_counts(graph).filter("kind = 'graph'").first().triples == graph.count()


def test_catalogue_queries(graph, rows):
    assert rows(P.entity_indicator(graph, "Alpha")) == [(30000.0,)]
    assert rows(P.entity_year(graph, "Alpha", 2021)) == [(4.0, 20000.0)]
    assert rows(P.entity_neighbors(graph, "Beta")) == [("Alpha",)]
    assert rows(P.province_neighbors(graph, "Barcelona", 2021, 20000, 700)) == []
    assert rows(P.province_neighbors(graph, "Tarragona", 2021, 0, 701)) == []
    assert rows(P.comarca_top(graph, "Alt Camp", 2021)) == [("Alpha", 30000.0, 20000.0)]
    result = P.run_catalog(graph, {"a": lambda t: P.entity_neighbors(t, "Beta"), "none": lambda t: P.entity_neighbors(t, "?")})
    assert rows(result) == [("a", '{"neighbor_label":"Alpha"}'), ("none", None)]
    assert P.run_catalog(graph).select("query").distinct().count() == 5


def test_pattern_semantics(spark, rows):
    t = spark.createDataFrame([
        ("a", "p", "b", "uri", None, None, None), ("b", "p", "a", "uri", None, None, None), ("c", "p", "c", "uri", None, None, None),
        ("a", "name", "x", "literal", "ca", None, None), ("b", "name", "x", "literal", "en", None, None), ("c", "name", "x", "literal", "ca", None, None),
        ("d", "q", "b", "literal", None, None, None), ("a", "n", "5", "literal", None, vocab.XSD_INTEGER, 5.0), ("b", "n", "text", "literal", None, None, None)], schemas.TRIPLES)
    assert rows(P.match(t, [("?x", "p", "?x")])) == [("c",)]
    assert rows(P.match(t, [("?x", "name", P.Literal("x", "ca"))])) == [("a",), ("c",)]
    # A literal is no resource, even if it reads like one.
    assert rows(P.match(t, [("?x", "q", "?y"), ("?y", "p", "?z")])) == []
    # Equal text in different languages is not the same term.
    assert rows(P.match(t, [("?x", "name", "?l"), ("?y", "name", "?l")], select=["?x", "?y"])) == [("a", "a"), ("a", "c"), ("b", "b"), ("c", "a"), ("c", "c")]
    assert rows(P.match(t, [("?x", "n", "?v")], filters=[("?v", ">", 1)], numbers=["?v"])) == [(5.0, "a")]
    # Bag unless distinct.
    assert P.match(t, [("?x", "name", "?l")], select=["?l"]).count() == 3
    assert P.match(t, [("?x", "name", "?l")], select=["?l"], distinct=True).count() == 1
    assert [r.x for r in P.match(t, [("?x", "name", "?l")], select=["?x"], order=["-?x"], limit=2).collect()] == ["c", "b"]
    assert rows(P.match(t, [("a", "?p", "b")])) == [("p",)]
    with pytest.raises(ValueError):
        P.match(t, [("?x", "p", "?y"), ("?z", "name", "?w")])


EX = "http://example.org/"


def triples(spark, *facts):
    lit = lambda o: ("literal" if not o.startswith(("http", "x:")) else "uri")
    return spark.createDataFrame([(s, p, o, lit(o), None, None, None) for s, p, o in facts], schemas.TRIPLES)


def test_domain_demo(spark, rows):
    facts = triples(
        spark, (EX + "Person", vocab.RDF_TYPE, vocab.RDFS + "Class"), (EX + "has_name", vocab.RDF_TYPE, vocab.RDF + "Property"),
        (EX + "has_name", I.DOMAIN, EX + "Person"), (EX + "has_name", I.RANGE, vocab.RDFS + "Literal"),
        (EX + "person1", vocab.RDF_TYPE, EX + "Person"), (EX + "person1", EX + "has_name", "Alice"), (EX + "person2", EX + "has_name", "Bob"))
    closed = I.closure(facts)
    assert rows(I.instances_of(closed, EX + "Person")) == [(EX + "person1",), (EX + "person2",)]
    assert closed.count() == facts.count() + 1  # a literal is given no type


def test_closure_rules(spark, rows):
    x = "x:"
    facts = triples(
        spark, (x + "part", vocab.RDF_TYPE, I.TRANSITIVE), *[(x + str(i), x + "part", x + str(i + 1)) for i in range(8)],
        (x + "near", vocab.RDF_TYPE, I.SYMMETRIC), (x + "1", x + "near", x + "2"), (x + "has", I.INVERSE, x + "of"), (x + "1", x + "has", x + "9"), (x + "7", x + "of", x + "8"),
        (x + "A", I.SUBCLASS, x + "B"), (x + "B", I.SUBCLASS, x + "C"), (x + "i", vocab.RDF_TYPE, x + "A"),
        (x + "sub", I.SUBPROPERTY, x + "mid"), (x + "mid", I.SUBPROPERTY, x + "top"), (x + "i", x + "sub", x + "j"), (x + "top", I.RANGE, x + "A"))
    closed = I.closure(facts)
    got = {(r.s[2:], r.p[2:], r.o[2:]) for r in closed.collect() if r.p.startswith("x:")}
    assert {(str(i), "part", str(j)) for i in range(8) for j in range(i + 1, 9)} <= got
    assert {("2", "near", "1"), ("9", "of", "1"), ("8", "has", "7"), ("i", "mid", "j"), ("i", "top", "j")} <= got
    assert {r.subject for r in I.instances_of(closed, x + "C").collect()} == {x + "i", x + "j"}
    assert closed.filter((F.col("s") == x + "A") & (F.col("p") == I.SUBCLASS)).count() == 2
    assert rows(I.closure(closed)) == rows(closed)
    assert closed.count() == closed.distinct().count()
    with pytest.raises(RuntimeError):
        I.closure(facts, max_iter=1)


def test_derived_rules_apply_to_old_facts(spark):
    x = "x:"
    facts = triples(spark, (x + "a", x + "p", x + "b"), (x + "p", x + "sub", x + "q"), (x + "sub", I.SUBPROPERTY, I.SUBPROPERTY))
    assert I.closure(facts).filter((F.col("p") == x + "q")).count() == 1


def test_retrieval_and_prompts(spark, graph):
    questions = spark.createDataFrame([
        ("1", "Alpha", NS + "hasObservation", NS + "field", NS + "indicator/population", NS + "value"), ("2", "Alpha", None, None, None, NS + "isNeighborOf"),
        ("3", "Nowhere", None, None, None, NS + "isNeighborOf"), ("4", "Alpha", NS + "hasAnnualData", NS + "referenceYear", "2021", NS + "totalContracts"),
        ("4", "Alpha", NS + "hasAnnualData", NS + "referenceYear", "2021", NS + "incomePerCapita")],
        "question_id string, label string, via string, where_p string, where_o string, predicate string")
    got = {r.question_id: r.context for r in R.retrieve_context(questions, graph).collect()}
    assert json.loads(got["1"]) == [{"property": "value", "value": "30000.0"}]
    assert [f["value"] for f in json.loads(got["2"])] == ["Beta", NS + "municipality/99999"]
    assert got["3"] == R.INSUFFICIENT
    assert {f["property"]: f["value"] for f in json.loads(got["4"])} == {"totalContracts": "4", "incomePerCapita": "20000.0"}
    df = spark.createDataFrame([("Who?", "facts")], "question string, context string")
    asked = R.render_prompts(df).first().prompt
    assert asked.endswith("Question: Who?\nQuery:\n") and "proj:hasObservation" in asked and NS in asked
    answered = R.render_prompts(df, context="context").first().prompt
    assert "Facts: facts" in answered and answered.endswith("Question: Who?\nAnswer:")
