"""Queries over adjacency, the knowledge graph, embeddings and models."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from terraloom import vocab
from terraloom.operators import aggregate as A
from terraloom.operators import embeddings as E
from terraloom.operators import features as X
from terraloom.operators import inference, patterns, retrieval
from terraloom.operators import joins as J
from terraloom.operators import ordering as O
from terraloom.operators import quality as Q
from terraloom.operators import regression as R
from terraloom.operators import triples as G
from terraloom.plans.annual import annual_data
from terraloom.registry import bindings as B
from terraloom.registry.base import query, round6
from terraloom.registry.bindings import LABEL, NS, TYPE, comparable, sql, table
from terraloom.registry.tables import municipal, rounded
from terraloom.session import materialise, shared_path
from terraloom.sources import graphs

# --- adjacency --------------------------------------------------------------------------------------


@query("spatial_neighbors", sql("select id, neighbor_id from grid_edges", "grid_edges"))
def _(spark, sf):
    return B.grid_edges(spark, sf)


@query("parent_adjacency", sql("select parent, neighbor from parent_edges", "parent_edges"))
def _(spark, sf):
    return J.derive_parent_edges(B.grid_edges(spark, sf), B.places(spark, sf).select("id", "parent"))


@query("neighbor_lists", sql("select id, 0 part, string_agg(neighbor_id, ',' order by neighbor_id) neighbors from grid_edges group by 1", "grid_edges"))
def _(spark, sf):
    lists = A.neighbor_lists(B.grid_edges(spark, sf), ["id"], ["neighbor_id"])
    return lists.withColumn("neighbors", F.concat_ws(",", F.transform("neighbors", lambda n: n["neighbor_id"])))


# --- triples ----------------------------------------------------------------------------------------

@query("structure_triples", sql("select * from geo_triples", "geo_triples"))
def _(spark, sf):
    return comparable(G.geo_triples(B.indicator_long(spark, sf), B.provinces(spark, sf)))


@query("adjacency_triples", sql("select * from edge_triples", "edge_triples"))
def _(spark, sf):
    edges = B.grid_edges(spark, sf)
    adjacent = J.derive_parent_edges(edges, B.places(spark, sf).select("id", "parent"))
    return comparable(G.edge_triples(edges, "id", "neighbor_id", "municipality", "isNeighborOf").unionByName(
        G.edge_triples(adjacent, "parent", "neighbor", "comarca", "isAdjacentTo")))


@query("concept_triples", sql("select * from concept_triples", "concept_triples"))
def _(spark, sf):
    return comparable(G.concept_triples(table(spark, sf, "events"), "event_type", B.EVENT_NAMES))


@query("observation_triples", sql("select * from observation_triples", "observation_triples"))
def _(spark, sf):
    return comparable(G.observation_triples(B.indicator_long(spark, sf), B.EVENT_NAMES, B.ORDER))


@query("datapoint_triples", sql("select * from datapoint_triples", "datapoint_triples"))
def _(spark, sf):
    return comparable(G.datapoint_triples(annual_data(B.rent_long(spark, sf), B.income(spark, sf))))


@query("knowledge_graph", sql("select * from graph", "graph"))
def _(spark, sf):
    return comparable(B.graph(spark, sf))


@query("triple_union", sql("select * from geo_triples union select * from concept_triples", "geo_triples", "concept_triples"))
def _(spark, sf):
    geo = G.geo_triples(B.indicator_long(spark, sf), B.provinces(spark, sf))
    return comparable(G.union_triples(geo, geo, G.concept_triples(table(spark, sf, "events"), "event_type", B.EVENT_NAMES)))


@query("entity_triples", sql("select s, p, o from graph where o_kind='uri'", "graph"))
def _(spark, sf):
    return Q.entity_triples(B.graph_table(spark, sf))


@query("graph_counts", sql(f"""select 'graph' as kind, '' as name, count(*) triples from graph
  union all select 'predicate', p, count(*) from graph group by p
  union all select 'class', o, count(*) from graph where p='{TYPE}' group by o""", "graph"))
def _(spark, sf):
    return A.graph_counts(B.graph_table(spark, sf))


@query("ntriples_round_trip", sql("select * from graph", "graph"))
def _(spark, sf):
    path = shared_path(spark, "ntriples")
    graphs.write_ntriples(B.graph_table(spark, sf), path)
    return comparable(graphs.read_ntriples(spark, path))


@query("tsv_round_trip", sql("select s, p, o from graph where o_kind='uri'", "graph"))
def _(spark, sf):
    path = shared_path(spark, "training")
    graphs.write_tsv_triples(B.graph_table(spark, sf), path)
    return graphs.read_tsv_triples(spark, path)


@query("triples_round_trip", sql("select * from graph", "graph"))
def _(spark, sf):
    path = shared_path(spark, "triples")
    graphs.write_triples(B.graph_table(spark, sf), path)
    return comparable(graphs.read_triples(spark, path))


# --- graph queries ------------------------------------------------------------------------------------

def _g(alias, p, o=None):
    return f"(select s, o, round(o_num,6) as num from graph where p='{p}'" + (f" and o='{o}'" if o else "") + f") {alias}"


_POP = f"{NS}indicator/population"
_INDICATOR_SQL = (f"select v.num population from (select s from graph where p='{LABEL}' and o='M7' and o_lang='ca') m "
                  f"join {_g('h', NS + 'hasObservation')} on h.s=m.s join {_g('f', NS + 'field', _POP)} on f.s=h.o join {_g('v', NS + 'value')} on v.s=h.o")


@query("query_entity_indicator", sql(_INDICATOR_SQL, "graph"))
def _(spark, sf):
    return rounded(patterns.entity_indicator(B.graph_table(spark, sf), "M7"), "population")


_YEAR_SQL = (f"select t.num total_contracts, i.num income_per_capita from (select s from graph where p='{LABEL}' and o='M7' and o_lang='ca') m "
             f"join {_g('h', NS + 'hasAnnualData')} on h.s=m.s join {_g('y', NS + 'referenceYear', '1997')} on y.s=h.o "
             f"join {_g('t', NS + 'totalContracts')} on t.s=h.o join {_g('i', NS + 'incomePerCapita')} on i.s=h.o")


@query("query_entity_year", sql(_YEAR_SQL, "graph"))
def _(spark, sf):
    return rounded(patterns.entity_year(B.graph_table(spark, sf), "M7", 1997), "income_per_capita")


_NEAR_SQL = (f"select l.o neighbor_label from (select s from graph where p='{LABEL}' and o='M7' and o_lang='ca') m "
             f"join {_g('n', NS + 'isNeighborOf')} on n.s=m.s join {_g('l', LABEL)} on l.s=n.o")


@query("query_neighbors", sql(_NEAR_SQL, "graph"))
def _(spark, sf):
    return patterns.entity_neighbors(B.graph_table(spark, sf), "M7")


_PROVINCE_SQL = f"""select distinct ml.o municipality_name, r.num avg_rent, nl.o neighbor_name, v.num neighbor_population
  from (select s from graph where p='{LABEL}' and o='ASIA' and o_lang='ca') pr
  join {_g('ip', NS + 'isInProvince')} on ip.o=pr.s join {_g('ic', NS + 'isInComarca')} on ic.o=ip.s join {_g('ml', LABEL)} on ml.s=ic.s
  join {_g('nb', NS + 'isNeighborOf')} on nb.s=ic.s join {_g('nl', LABEL)} on nl.s=nb.o
  join {_g('h', NS + 'hasObservation')} on h.s=nb.o join {_g('f', NS + 'field', _POP)} on f.s=h.o join {_g('v', NS + 'value')} on v.s=h.o and v.num > 10
  join {_g('d', NS + 'hasAnnualData')} on d.s=ic.s join {_g('y', NS + 'referenceYear', '1998')} on y.s=d.o
  join {_g('r', NS + 'avgMonthlyRent')} on r.s=d.o and r.num < 3000"""


@query("query_province_neighbors", sql(_PROVINCE_SQL, "graph"))
def _(spark, sf):
    return rounded(patterns.province_neighbors(B.graph_table(spark, sf), "ASIA", 1998, 10, 3000), "avg_rent", "neighbor_population")


_TOP_SQL = f"""select ml.o municipality_name, v.num population, i.num income from (select s from graph where p='{LABEL}' and o='NATION_3' and o_lang='ca') c
  join {_g('ic', NS + 'isInComarca')} on ic.o=c.s join {_g('ml', LABEL)} on ml.s=ic.s
  join {_g('h', NS + 'hasObservation')} on h.s=ic.s join {_g('f', NS + 'field', _POP)} on f.s=h.o join {_g('v', NS + 'value')} on v.s=h.o
  join {_g('d', NS + 'hasAnnualData')} on d.s=ic.s join {_g('y', NS + 'referenceYear', '1998')} on y.s=d.o join {_g('i', NS + 'incomePerCapita')} on i.s=d.o
  order by population desc, municipality_name, income limit 5"""


@query("query_top_of_comarca", sql(_TOP_SQL, "graph"))
def _(spark, sf):
    return rounded(patterns.comarca_top(B.graph_table(spark, sf), "NATION_3", 1998), "population", "income")


@query("pattern_match", sql(f"""select a.s as a, b.s as b, l.o label from {_g('n', NS + 'isNeighborOf')} join {_g('a', NS + 'isInComarca')} on n.s=a.s
  join {_g('b', NS + 'isInComarca')} on n.o=b.s join {_g('x', NS + 'isAdjacentTo')} on x.s=a.o and x.o=b.o join {_g('l', LABEL)} on l.s=b.o""", "graph"))
def _(spark, sf):
    return patterns.match(B.graph_table(spark, sf), [
        ("?a", NS + "isNeighborOf", "?b"), ("?a", NS + "isInComarca", "?c"), ("?b", NS + "isInComarca", "?d"),
        ("?c", NS + "isAdjacentTo", "?d"), ("?d", vocab.RDFS_LABEL, "?label")], select=["?a", "?b", "?label"])


_CATALOG_SQL = {"population": _INDICATOR_SQL, "annual data": _YEAR_SQL, "neighbors": _NEAR_SQL, "cheap next to populous": _PROVINCE_SQL, "top population": _TOP_SQL}


_SOLUTION = {"population": "double", "total_contracts": "double", "income_per_capita": "double", "neighbor_label": "string", "municipality_name": "string",
             "avg_rent": "double", "neighbor_name": "string", "neighbor_population": "double", "income": "double"}


@query("query_catalog", sql("select query, " + ", ".join(f"cast({c} as {'double' if k == 'double' else 'varchar'}) {c}" for c, k in _SOLUTION.items()) + " from ("
                            + " union all by name ".join(f"select '{n}' as query, * from ({q})" for n, q in _CATALOG_SQL.items())
                            + " union all by name select 'nobody' as query)", "graph"))
def _(spark, sf):
    """All solutions of the five queries of the catalogue, and of one that has none."""
    found = patterns.run_catalog(B.graph_table(spark, sf), {
        "population": lambda t: patterns.entity_indicator(t, "M7"), "annual data": lambda t: patterns.entity_year(t, "M7", 1997),
        "neighbors": lambda t: patterns.entity_neighbors(t, "M7"),
        "cheap next to populous": lambda t: patterns.province_neighbors(t, "ASIA", 1998, 10, 3000),
        "top population": lambda t: patterns.comarca_top(t, "NATION_3", 1998),
        "nobody": lambda t: patterns.entity_neighbors(t, "no such place")})
    parsed = found.select("query", F.from_json("solution", ", ".join(f"{c} {k}" for c, k in _SOLUTION.items())).alias("of"))
    return rounded(parsed.select("query", *[F.col(f"of.{c}").alias(c) for c in _SOLUTION]), *[c for c, k in _SOLUTION.items() if k == "double"])


def _schema_rows(spark):
    """Schema of the graph: domains and ranges of places, symmetry, and a transitive hierarchy."""
    p = lambda n: vocab.NS + n
    rows = [(p("isInComarca"), inference.DOMAIN, p("Place")), (p("isInComarca"), inference.SUBPROPERTY, p("within")),
            (p("isInProvince"), inference.SUBPROPERTY, p("within")), (p("within"), vocab.RDF_TYPE, inference.TRANSITIVE),
            (p("isAdjacentTo"), vocab.RDF_TYPE, inference.SYMMETRIC), (p("hasObservation"), inference.INVERSE, p("observedAt")),
            (p("Municipality"), inference.SUBCLASS, p("Place")), (p("Comarca"), inference.SUBCLASS, p("Place")),
            (p("Place"), inference.SUBCLASS, p("Thing")), (p("isInProvince"), inference.RANGE, p("Province"))]
    return spark.createDataFrame(
        [(s, q, o, "uri", None, None, None) for s, q, o in rows],
        "s string, p string, o string, o_kind string, o_lang string, o_type string, o_num double")


_IN = f"select s, o from graph where p='{NS}isInComarca'"
_OF = f"select s, o from graph where p='{NS}isInProvince'"


@query("closure", sql(f"""select distinct s, p, o from (
  select s, '{TYPE}' as p, o from graph where p='{TYPE}' and o in ('{NS}Municipality','{NS}Comarca','{NS}Province')
  union all select s, '{TYPE}', '{NS}' || t from graph cross join (select unnest(['Place','Thing']) t) where p='{TYPE}' and o in ('{NS}Municipality','{NS}Comarca')
  union all select s, '{TYPE}', '{NS}' || t from ({_IN}) cross join (select unnest(['Place','Thing']) t)
  union all select s, '{NS}within', o from ({_IN}) union all select s, '{NS}within', o from ({_OF})
  union all select a.s, '{NS}within', b.o from ({_IN}) a join ({_OF}) b on a.o=b.s
  union all select o, '{NS}observedAt', s from graph where p='{NS}hasObservation')""", "graph"))
def _(spark, sf):
    """Inferred places, hierarchy and inverse links of the whole graph."""
    base = B.graph_table(spark, sf)
    closed = inference.closure(base.unionByName(_schema_rows(spark)))
    kinds = [vocab.NS + n for n in ("Municipality", "Comarca", "Province", "Place", "Thing")]
    wanted = (((F.col("p") == vocab.RDF_TYPE) & F.col("o").isin(kinds))
              | F.col("p").isin(vocab.NS + "within", vocab.NS + "observedAt"))
    return closed.filter(wanted).select("s", "p", "o")


@query("retrieval_context", sql(f"""select 'n' || o question_id, 0 part, '[' || string_agg(fact, ',' order by fact) || ']' as context from (
    select distinct m.o, '{{"property":"isNeighborOf","value":"' || coalesce(l.o, n.o) || '"}}' fact from graph m join graph n on n.s=m.s and n.p='{NS}isNeighborOf'
    left join graph l on l.s=n.o and l.p='{LABEL}' where m.p='{LABEL}' and m.s like '%/municipality/%' and m.o in (select o from asked)) group by o
  union all select 'c' || o, 0, '[{{"property":"totalContracts","value":"' || v || '"}}]' from (
    select m.o, t.o v from graph m join graph d on d.s=m.s and d.p='{NS}hasAnnualData' join graph y on y.s=d.o and y.p='{NS}referenceYear' and y.o='1998'
    join graph t on t.s=d.o and t.p='{NS}totalContracts' where m.p='{LABEL}' and m.o in (select o from asked))
  union all select 'x' || c_name, 0, '{retrieval.INSUFFICIENT}' from customer""".replace("{{", "{").replace("}}", "}"),
    "graph", asked=f"select distinct o from graph where p='{LABEL}' and s like '%/municipality/%'"))
def _(spark, sf):
    """Neighbours and contracts of every labelled municipality, and one question per unknown name."""
    graph = B.graph_table(spark, sf)
    names = graph.filter((F.col("p") == vocab.RDFS_LABEL) & F.col("s").contains("/municipality/")).select(F.col("o").alias("label")).distinct()
    null = F.lit(None).cast("string")
    near = names.select(F.concat(F.lit("n"), "label").alias("question_id"), "label", null.alias("via"), null.alias("where_p"), null.alias("where_o"),
                        F.lit(vocab.NS + "isNeighborOf").alias("predicate"))
    count = names.select(F.concat(F.lit("c"), "label").alias("question_id"), "label", F.lit(vocab.NS + "hasAnnualData").alias("via"),
                         F.lit(vocab.NS + "referenceYear").alias("where_p"), F.lit("1998").alias("where_o"),
                         F.lit(vocab.NS + "totalContracts").alias("predicate"))
    unknown = table(spark, sf, "customer").select(
        F.concat(F.lit("x"), "c_name").alias("question_id"), F.col("c_name").alias("label"), null.alias("via"), null.alias("where_p"),
        null.alias("where_o"), F.lit(vocab.NS + "isNeighborOf").alias("predicate"))
    found = retrieval.retrieve_context(near.unionByName(count).unionByName(unknown), graph)
    of = lambda asked: found.join(asked.select("question_id").hint("merge"), "question_id", "left_semi")  # noqa: E731  (as many as customers)
    return of(near.unionByName(count)).filter(F.col("context") != retrieval.INSUFFICIENT).unionByName(of(unknown))


@query("query_prompts", f"""select c_custkey, 'Question: Who is ' || c_name || '?' || chr(10) || 'Query:' || chr(10) as tail, true as guided, {len(retrieval.GRAPH_GUIDE)} as guide_lines from customer""")
def _(spark, sf):
    """Requests for a graph query, seen by their end and by the vocabulary they spell out."""
    rows = table(spark, sf, "customer").select("c_custkey", F.concat(F.lit("Who is "), "c_name", F.lit("?")).alias("question"))
    prompt = F.col("prompt")
    told = retrieval.render_prompts(rows, "question")
    at = F.instr(prompt, F.lit("Question: "))
    return told.select("c_custkey", F.substr(prompt, at).alias("tail"), F.contains(prompt, F.lit(f"proj <{NS}>")).alias("guided"),
                       F.size(F.filter(F.split(prompt, "\n"), lambda line: F.startswith(line, F.lit("- ")))).alias("guide_lines"))


@query("prompts", f"""select c_custkey, 'Answer from these facts only, briefly. If they are empty or say so, reply that the information does not suffice.

Facts: ' || c_mktsegment || '

Question: Who is ' || c_name || '?
Answer:' prompt from customer""")
def _(spark, sf):
    rows = table(spark, sf, "customer").select(
        "c_custkey", F.concat(F.lit("Who is "), "c_name", F.lit("?")).alias("question"), F.col("c_mktsegment").alias("context"))
    return retrieval.render_prompts(rows, "question", "context").select("c_custkey", "prompt")


@query("fenced_blocks", r"""select conv_id, turn, trim(text, chr(10) || chr(13) || chr(9) || chr(11) || chr(12) || ' ') as query from conversations""")
def _(spark, sf):
    """Replies wrapped in a fence, in a labelled fence or bare give the same text back."""
    rows = table(spark, sf, "conversations")
    wrapped = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("Here:\n```sparql\n"), "text", F.lit("\n```\nDone."))) \
        .when(F.col("turn") % 3 == 1, F.concat(F.lit("```"), F.lit("\n"), "text", F.lit("```"))).otherwise(F.col("text"))
    return retrieval.extract_fenced(rows.withColumn("reply", wrapped)).select("conv_id", "turn", "query")


# --- embeddings ---------------------------------------------------------------------------------------

def _links(spark, sf):
    """Distinct customer-to-supplier links by return flag."""
    rows = (table(spark, sf, "lineitem").join(B.keyed(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.col("o_custkey").alias("h"), F.col("l_returnflag").alias("p"), F.col("l_suppkey").alias("t")).distinct())
    return rows.select(F.col("h").cast("string").alias("s"), "p", F.col("t").cast("string").alias("o"))


def _vector_keys(spark, sf):
    """Links ``h, p, t`` by number whose head has a given vector: orders of other customers go before they meet the line items."""
    have = B.keyed(spark, sf, "embeddings").select(F.col("vec_id").alias("o_custkey"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey").join(have, "o_custkey", "left_semi")
    return (table(spark, sf, "lineitem").join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
            .select(F.col("o_custkey").alias("h"), F.col("l_returnflag").alias("p"), F.col("l_suppkey").alias("t")).distinct())


def _vector_links(spark, sf):
    """The links whose two ends have a given vector.

    Tails are matched by an inner join: a semi join would be pushed down to the line items and deal all of them once more.
    """
    have = B.keyed(spark, sf, "embeddings").select(F.col("vec_id").alias("t")).distinct()
    return _vector_keys(spark, sf).join(have.hint("merge"), "t").select(F.col("h").cast("string").alias("s"), "p", F.col("t").cast("string").alias("o"))


_ALL_LINKS = "select distinct o_custkey h, l_returnflag p, l_suppkey t from lineitem join orders on l_orderkey=o_orderkey"
_LINKS = _ALL_LINKS + """
  where o_custkey in (select vec_id from embeddings) and l_suppkey in (select vec_id from embeddings)"""
_RELS = """select p, list(m order by i) vec from (select case when label < 3 then 'A' when label < 6 then 'N' else 'R' end p, i, avg(embedding[i]::double) m
  from embeddings cross join (select unnest(range(1, 65)) i) group by 1, 2) group by p"""


def _params(spark, sf):
    """Given vectors as parameters: entities as they are, relations as means over ranges of labels."""
    vectors = table(spark, sf, "embeddings")
    double = F.transform("embedding", lambda e: e.cast("double"))
    ent = vectors.select(F.lit("e").alias("kind"), F.col("vec_id").alias("id"), F.col("vec_id").cast("string").alias("label"), double.alias("vec"))
    name = F.when(F.col("label") < 3, "A").when(F.col("label") < 6, "N").otherwise("R")
    means = vectors.select(name.alias("label"), double.alias("v")).groupBy("label").agg(
        F.array(*[F.avg(F.get("v", F.lit(i))) for i in range(64)]).alias("vec"))
    return ent.unionByName(means.select(F.lit("r").alias("kind"), F.xxhash64("label").alias("id"), "label", "vec"))


@query("index_triples", sql("""select h.i h, r.i r, t.i t from links l join ent h on h.x=l.h join rel r on r.x=l.p join ent t on t.x=l.t""",
    links=_ALL_LINKS.replace("o_custkey h", "cast(o_custkey as varchar) h").replace("l_suppkey t", "cast(l_suppkey as varchar) t"),
    ent="select x, row_number() over (order by x)-1 i from (select h x from links union select t from links)",
    rel="select x, row_number() over (order by x)-1 i from (select distinct p x from links)"))
def _(spark, sf):
    return E.index_triples(_links(spark, sf))[0]


@query("inverse_triples", sql("select cast(h as varchar) s, p, cast(t as varchar) o from links union all select cast(t as varchar), p || '_inverse', cast(h as varchar) from links", links=_ALL_LINKS))
def _(spark, sf):
    return E.add_inverses(_links(spark, sf))


def _split_ctes(links: str) -> dict[str, str]:
    """The split in SQL: one least triple of every entity and relation is training, the rest goes by the digest."""
    return {
        "links": f"select cast(h as varchar) s, p, cast(t as varchar) o from ({links})",
        "member": "select 'e' kind, s as name, row(s, p, o) t from links union all select 'e', o, row(s, p, o) from links union all select 'r', p, row(s, p, o) from links",
        "cover": "select distinct t from (select min(t) t from member group by kind, name)",
        "drawn": "select *, cast('0x' || left(md5(concat_ws(chr(9), s, p, o, '42')), 8) as bigint) % 10 b, row(s, p, o) in (select t from cover) c from links",
        "split": "select s, p, o, case when c or b < 8 then 'train' when b < 9 then 'validation' else 'test' end as split from drawn"}


@query("split_triples", sql("select * from split", **_split_ctes(_ALL_LINKS)))
def _(spark, sf):
    return E.split_triples(_links(spark, sf))


@query("grid_split", sql("select * from split union all select o, p || '_inverse', s, split from split where split = 'train'", **_split_ctes(_ALL_LINKS)))
def _(spark, sf):
    """What experiments train, validate and test on: inverses in the training part only."""
    return E.grid_split(_links(spark, sf))


_SUM = lambda f: f"list_sum([{f} for i in range(1, 65)])"


@query("score_transe", sql(f"""select h, l.p, t, round(-sqrt({_SUM('(a.embedding[i]::double+r.vec[i]-b.embedding[i]::double)**2')}),6) score
  from links l join embeddings a on a.vec_id=l.h join embeddings b on b.vec_id=l.t join rels r on r.p=l.p""", links=_LINKS, rels=_RELS))
def _(spark, sf):
    return _scored(spark, sf, lambda df: df.withColumn("score", E.score_column("TransE", "hv", "rv", "tv")))


@query("score_distmult", sql(f"""select h, l.p, t, round({_SUM('a.embedding[i]::double*r.vec[i]*b.embedding[i]::double')},6) score
  from links l join embeddings a on a.vec_id=l.h join embeddings b on b.vec_id=l.t join rels r on r.p=l.p""", links=_LINKS, rels=_RELS))
def _(spark, sf):
    return _scored(spark, sf, lambda df: E.score_triples(df, "DistMult"))


def _scored(spark, sf, score):
    """Scores of the links: entity vectors travel as the floats they are given in, the three relations' as a small table."""
    given = lambda key, out: B.keyed(spark, sf, "embeddings").select(F.col("vec_id").alias(key), F.col("embedding").alias(out))
    relations = _params(spark, sf).filter("kind = 'r'").select(F.col("label").alias("p"), F.col("vec").alias("rv"))
    links = _vector_keys(spark, sf).select(F.col("h").alias("s"), "p", F.col("t").alias("o"))
    rows = links.join(given("o", "tv"), "o").join(given("s", "hv"), "s").join(F.broadcast(relations), "p")
    return score(rows.withColumns({c: F.transform(c, lambda e: e.cast("double")) for c in ("hv", "tv")})).select(F.col("s").cast("long").alias("h"), "p", F.col("o").cast("long").alias("t"), round6("score").alias("score"))


def _ranked_part(spark, sf):
    """All links with vectors, and the tenth of them that a training run holds back for testing."""
    links = materialise(_vector_links(spark, sf), "links")  # read by the split, the known answers and the ranking
    return links, E.split_triples(links).filter("split = 'test'").select("s", "p", "o")


def _rank_ctes(tail: str, head: str, score: str) -> dict[str, str]:
    """Filtered realistic ranks in SQL: every test link against every vector, on both sides."""
    return _split_ctes(_LINKS) | {
        "rels": _RELS, "ent": "select cast(vec_id as varchar) e, [x::double for x in embedding] v from embeddings",
        "asked": f"""select t.s, t.p, t.o, 'tail' side, t.o answer, {tail} q from split t join ent a on a.e=t.s join rels r using (p) where split='test'
  union all select t.s, t.p, t.o, 'head', t.s, {head} from split t join ent a on a.e=t.o join rels r using (p) where split='test'""",
        "scored": f"select a.*, e.e, {score} score from asked a cross join ent e",
        "own": "select s, p, o, side, score mine from scored where e=answer",
        "ranks": """select c.s, c.p, c.o, c.side, 1 + sum((c.score > own.mine and k.s is null)::int) + sum((c.score = own.mine and k.s is null)::int) / 2 as rank
  from scored c join own using (s, p, o, side) left join links k on k.p=c.p and k.s=case c.side when 'tail' then c.s else c.e end
    and k.o=case c.side when 'tail' then c.e else c.o end group by 1, 2, 3, 4"""}


_DOT = "[x[1]*x[2] for x in list_zip(a.v, r.vec)]"


@query("rank_triples", sql("select s, p, o, side, cast(rank as double) as rank from ranks", **_rank_ctes(_DOT, _DOT, "list_dot_product(a.q, e.v)")))
def _(spark, sf):
    links, test = _ranked_part(spark, sf)
    return E.rank_triples(_params(spark, sf), test, links, "DistMult")


@query("rank_metrics", sql("""select side, metric, round(v, 6) as value from (
  select side, avg(1 / rank) inverse_harmonic_mean_rank, avg((rank <= 1)::int) hits_at_1, avg((rank <= 3)::int) hits_at_3, avg((rank <= 5)::int) hits_at_5, avg((rank <= 10)::int) hits_at_10
  from (select side, rank from ranks union all select 'both', rank from ranks) group by 1) unpivot (v for metric in (inverse_harmonic_mean_rank, hits_at_1, hits_at_3, hits_at_5, hits_at_10))""",
    **_rank_ctes("[x[1]+x[2] for x in list_zip(a.v, r.vec)]", "[x[1]-x[2] for x in list_zip(a.v, r.vec)]", "-list_distance(a.q, e.v)")))
def _(spark, sf):
    links, test = _ranked_part(spark, sf)
    return rounded(E.evaluate_kge(_params(spark, sf), test, links, "TransE"), "value")


@query("exclude_known", sql("""select distinct cast(o_custkey as varchar) s, o_orderstatus p, cast(o_orderkey % 97 as varchar) o from orders where not exists (
  from links where links.h=o_custkey and links.t=o_orderkey % 97)""", links="select distinct o_custkey h, l_suppkey t from lineitem join orders on l_orderkey=o_orderkey"))
def _(spark, sf):
    orders = table(spark, sf, "orders")
    wanted = orders.select(F.col("o_custkey").cast("string").alias("s"), F.col("o_orderstatus").alias("p"), (F.col("o_orderkey") % 97).cast("string").alias("o")).distinct()
    known = table(spark, sf, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").cast("string").alias("s"), F.col("l_suppkey").cast("string").alias("o")).distinct()
    return J.exclude_known(wanted, known, ["s", "o"]).select("s", "p", "o")


@query("message_pass", sql("""select cast(t as varchar) as label, i - 1 j, round(sum(m),6) as value from (
    select l.t, l.p, i, avg(e.embedding[i]::double) m from links l join embeddings e on e.vec_id=l.h cross join (select unnest(range(1,65)) i) group by 1, 2, 3) group by 1, 2""", links=_LINKS))
def _(spark, sf):
    out = E.message_pass(_params(spark, sf).filter("kind = 'e'"), _vector_links(spark, sf))
    return out.select("label", F.posexplode("vec").alias("j", "value")).select("label", F.col("j").cast("long").alias("j"), round6("value").alias("value"))


@query("message_pass_weighted", sql("""select cast(t as varchar) as label, i - 1 j, round(sum(m),6) as value from (
    select l.t, l.p, i, avg(case when l.p='N' then e.embedding[65-i]::double when l.p='A' then 2*e.embedding[i]::double else e.embedding[i]::double end) m
    from links l join embeddings e on e.vec_id=l.h cross join (select unnest(range(1,65)) i) group by 1, 2, 3) group by 1, 2""", links=_LINKS))
def _(spark, sf):
    """One relation doubles what it passes on, one reverses it, the third leaves it as it is."""
    weights = {"A": 2 * np.eye(64), "N": np.eye(64)[::-1].copy()}
    out = E.message_pass(_params(spark, sf).filter("kind = 'e'"), _vector_links(spark, sf), weights)
    return out.select("label", F.posexplode("vec").alias("j", "value")).select("label", F.col("j").cast("long").alias("j"), round6("value").alias("value"))


_FLAT = ", ".join(f"embedding[{j + 1}]::double emb_dim_{j}" for j in range(64))


@query("embedding_features", f"select cast(vec_id as varchar) municipality_id, {_FLAT} from embeddings where label < 5")
def _(spark, sf):
    kind = F.when(F.col("label") < 5, "municipality").otherwise("comarca")
    named = table(spark, sf, "embeddings").select(
        F.concat(F.lit(vocab.NS), kind, F.lit("/"), F.col("vec_id").cast("string")).alias("label"),
        F.transform("embedding", lambda e: e.cast("double")).alias("vec"))
    return E.embedding_features(named, 64)


@query("join_embeddings", sql(f"""select m.municipality_id, m."any", m.total_contracts, v.* exclude (k) from municipal m
  join (select lpad(cast(vec_id as varchar),5,'0') k, {", ".join(f"embedding[{j + 1}]::double emb_dim_{j}" for j in range(64))} from embeddings) v on v.k=m.municipality_id""", "municipal"))
def _(spark, sf):
    vectors = table(spark, sf, "embeddings").select(
        F.concat(F.lit(vocab.NS + "municipality/"), B.code5("vec_id")).alias("label"), F.transform("embedding", lambda e: e.cast("double")).alias("vec"))
    return J.join_embeddings(municipal(spark, sf).select("municipality_id", "any", "total_contracts"), E.embedding_features(vectors, 64))


def _event_metrics(spark, sf):
    """Events as metric rows of experiments, one value per experiment and metric."""
    names = F.array(*[F.lit(n) for n in vocab.METRIC_NAMES])
    model = F.get(F.array(F.lit("TransE"), F.lit("RotatE"), F.lit("ComplEx")), (F.col("user_id") % 3).cast("int"))
    return table(spark, sf, "events").select(
        F.concat(model, F.lit("_dim_"), (64 + F.col("user_id") % 4 * 64).cast("string")).alias("experiment"),
        F.when(F.col("event_id") % 2 == 0, "both").otherwise("head").alias("side"),
        F.when(F.col("event_id") % 3 == 0, "realistic").otherwise("optimistic").alias("rank_type"), F.lit("testing").alias("dataset"),
        F.get(names, (F.col("event_id") % 5).cast("int")).alias("metric"), "value").groupBy(
        "experiment", "side", "rank_type", "dataset", "metric").agg(F.max("value").alias("value"))


_METRICS = """select case user_id%3 when 0 then 'TransE' when 1 then 'RotatE' else 'ComplEx' end model, 64+user_id%4*64 dim,
  event_id%5 m, max(value) v from events where event_id%2=0 and event_id%3=0 group by 1, 2, 3"""


@query("compare_experiments", sql("select model || ' (d=' || dim || ')' experiment, " + ", ".join(
    f'max(v) filter (m={i}) "{n}"' for i, n in enumerate(vocab.METRIC_NAMES.values())) + " from metrics group by 1 order by 2 desc", metrics=_METRICS))
def _(spark, sf):
    return E.compare_experiments(_event_metrics(spark, sf))


@query("metrics_wide", """select event_type experiment, max(value) filter (user_id%2=0) IHMR, max(value) filter (user_id%2=1) "Hits@1" from events group by 1 order by 2 desc""")
def _(spark, sf):
    rows = table(spark, sf, "events").select(
        F.col("event_type").alias("experiment"), "value",
        F.when(F.col("user_id") % 2 == 0, "inverse_harmonic_mean_rank").otherwise("hits_at_1").alias("metric"))
    return A.metrics_wide(rows, ["inverse_harmonic_mean_rank", "hits_at_1"])


@query("experiment_long", sql("select model, cast(dim as int) dimension, case m when 0 then 'IHMR' when 1 then 'Hits@1' when 2 then 'Hits@3' when 3 then 'Hits@5' else 'Hits@10' end metric, v as value from metrics", metrics=_METRICS))
def _(spark, sf):
    return E.experiment_long(_event_metrics(spark, sf))


@query("train_embeddings")
def _(spark, sf):
    """Entity vectors of the link graph after five epochs of steps of 64."""
    params, _ = E.train_kge(_links(spark, sf), None, "TransE", 64, epochs=5)
    return params.filter("kind = 'e'").select("label", F.explode(F.transform("vec", lambda v: F.round(v, 4))).alias("value"))


# --- prediction -----------------------------------------------------------------------------------------

def _model_rows(spark, sf):
    timed = X.time_features(municipal(spark, sf).drop("municipality_name")).dropna(subset=["avg_monthly_rent", "avg_monthly_rent_lag1"])
    return O.time_split(materialise(timed, "timed"), "any")  # read by every statistic of a fit


@query("boosted_trees")
def _(spark, sf):
    """Test-year predictions of rent with residuals."""
    split = _model_rows(spark, sf)
    features = [c for c in X.feature_columns(split) if c != "municipality_id"]
    model = R.train_gbt(split, features, rounds=100, rate=0.1, patience=20)
    scored, _ = R.evaluate(model, split)
    return scored.select("municipality_id", "any", "avg_monthly_rent", "prediction", "residual")


@query("top_importances")
def _(spark, sf):
    split = _model_rows(spark, sf)
    model = R.train_gbt(split, [c for c in X.feature_columns(split)], rounds=30, rate=0.1, patience=10)
    return R.top_importances(spark, model, 5)
