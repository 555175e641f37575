import json
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from terraloom import schemas
from terraloom.operators import cube as K
from terraloom.plans import cleaning
from terraloom.sources import documents, graphs, polygons, relations, tables

CUBE = {"id": ["YEAR", "MUN"],
        "dimension": {"YEAR": {"category": {"index": ["2020", "2021"], "label": {"2020": "y20"}}}, "MUN": {"category": {"index": ["080193", "170792", "x"]}}},
        "value": [1.5, None, "text", 4, 5, 6]}


def cubes(spark, *docs):
    return documents.parse_cubes(spark.createDataFrame([(i, d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)], "n int, value string"))


def test_cube_flatten(spark):
    out = K.flatten_cube(cubes(spark, CUBE), ("YEAR", "MUN", "CONCEPT")).collect()
    assert [(r.YEAR_CODE, r.YEAR_LABEL, r.MUN_CODE, r.MUN_LABEL, r.CONCEPT_CODE, r.VALUE) for r in out] == [
        ("2020", "y20", "080193", "080193", None, 1.5), ("2020", "y20", "170792", "170792", None, None), ("2020", "y20", "x", "x", None, None),
        ("2021", "2021", "080193", "080193", None, 4.0), ("2021", "2021", "170792", "170792", None, 5.0), ("2021", "2021", "x", "x", None, 6.0)]


@pytest.mark.parametrize("values,found,flattened,complete", [([1, 2], 2, 2, False), (list(range(9)), 9, 6, False), (list(range(6)), 6, 6, True)])
def test_cube_sizes(spark, values, found, flattened, complete):
    cube = cubes(spark, {**CUBE, "value": values})
    assert tuple(K.validate_cube(cube).first()) == (0, 6, found, flattened, complete)
    assert K.flatten_cube(cube, ("YEAR", "MUN")).count() == flattened


def _files(tmp_path, *docs):
    for i, d in enumerate(docs):
        (tmp_path / f"{i}.json").write_text(d if isinstance(d, str) else json.dumps(d))
    return str(tmp_path)


def test_cubes_by_byte_ranges_equal_whole_documents(spark, tmp_path):
    awkward = {**CUBE, "label": 'a, "value":[9], ]', "dimension": {**CUBE["dimension"], "YEAR": {"category": {"index": ["2020", "2021"], "label": {"2020": "y, 20 ]"}}}}}
    first = {"value": CUBE["value"], **CUBE}
    docs = [CUBE, json.dumps(CUBE, indent=2), json.dumps(CUBE, separators=(",", ":")), awkward, first, {**CUBE, "value": []}, {**CUBE, "value": [7]},
            {**CUBE, "value": list(range(9))}, {**CUBE, "status": ["a", "b"]}, {**CUBE, "id": ["YEAR", "NO"]}, {"id": ["YEAR"]}, "not json",
            {**CUBE, "value": {"0": 1, "3": 2}}, {**CUBE, "value": ['say \\ "x"', -1e-3, True, None]}, json.dumps({**CUBE, "value": []}).replace("[]", "[ \n]")]
    found, values = documents.scan_cube_values(spark, _files(tmp_path, *docs))
    number = F.regexp_extract("path", r"(\d+)\.json", 1).cast("int").alias("n")
    want, sizes, whole = {}, {}, cubes(spark, *docs)
    for r in whole.select("n", F.posexplode("raw")).collect():
        want[r.n, r.pos] = r.col
    assert {(r.n, r.pos): r.text for r in values.select(number, "pos", "text").collect()} == want
    key = lambda r: tuple("" if v is None else str(v) for v in r)
    dims = ("YEAR", "MUN", "OTHER")
    got = K.flatten_cube_values(found, values, dims).select(number, "*").drop("path")
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, K.flatten_cube(whole, dims).collect()), key=key)
    well = whole.filter(F.size("dims") > 0)
    sizes = {tuple(r) for r in K.validate_cube_values(found.filter(F.size("dims") > 0)).select(number, "*").drop("path").collect()}
    assert sizes == {tuple(r) for r in K.validate_cube(well).collect()} and len(sizes) == 11


def test_one_cube_is_read_by_many_tasks(spark, tmp_path):
    """Values keep their places across more than eight byte ranges; every range numbers its own."""
    n = 400_000
    cube = {"id": ["A", "B"], "dimension": {"A": {"category": {"index": [str(i) for i in range(400)]}}, "B": {"category": {"index": [str(i) for i in range(1000)]}}},
            "value": [None if i % 7 == 0 else i for i in range(n)]}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(256 * 1024))
    try:
        found, values = documents.scan_cube_values(spark, _files(tmp_path, cube))
        assert spark.read.option("lineSep", ",").text(str(tmp_path)).rdd.getNumPartitions() >= 8
        cells = K.flatten_cube_values(found, values, ("A", "B"))
        at = F.col("A_CODE").cast("int") * 1000 + F.col("B_CODE").cast("int")
        right = F.when(at % 7 == 0, F.col("VALUE").isNull()).otherwise(F.col("VALUE") == at)
        assert tuple(cells.agg(F.count(F.lit(1)), F.count_distinct(at), F.count_if(right)).first()) == (n, n, n)
        assert tuple(K.validate_cube_values(found).drop("path").first()) == (n, n, n, True)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_cubes_that_cannot_be_cut_at_commas_raise(spark, tmp_path):
    (tmp_path / "a").mkdir(), (tmp_path / "b").mkdir()
    with pytest.raises(Exception, match="several lists of values"):
        documents.scan_cube_values(spark, _files(tmp_path / "a", {**CUBE, "extra": {"value": [1]}}))
    with pytest.raises(Exception, match="a text value with a comma"):
        documents.scan_cube_values(spark, _files(tmp_path / "b", {**CUBE, "value": ["1,5", 2]}))[1].collect()


def test_malformed_cubes_give_nothing(spark):
    broken = [{**CUBE, "id": ["YEAR", "NO"]}, {"id": ["YEAR"]}, "not json", {**CUBE, "dimension": {"YEAR": {}, "MUN": {}}}]
    assert K.flatten_cube(cubes(spark, *broken), ("YEAR", "MUN")).count() == 0


def test_income_from_cube_file(spark, tmp_path):
    full = {"id": ["YEAR", "MUN", "CONCEPT", "INDICATOR"],
            "dimension": {d: {"category": {"index": c}} for d, c in (("YEAR", ["2020"]), ("MUN", ["080193"]), ("CONCEPT", ["c"]), ("INDICATOR", ["PER_CAPITA_EUR", "VALUE_EK"]))},
            "value": [10, 20]}
    (tmp_path / "cube.json").write_text(json.dumps(full, indent=2))
    out = cleaning.format_income(documents.scan_cube(spark, str(tmp_path / "cube.json")))
    assert out.schema.fieldNames() == schemas.INCOME.fieldNames()
    assert [(r.municipality_id, r.indicator_code, r.value) for r in out.collect()] == [("080193", "PER_CAPITA_EUR", 10.0), ("080193", "VALUE_EK", 20.0)]


@pytest.mark.parametrize("pages,wanted", [([2, 2, 1, 2], 5), ([2, 2, 0, 2], 4), ([2, 2], 4), ([1, 2], 1)])
def test_pages_end_at_the_first_short_one(spark, tmp_path, pages, wanted):
    for i, n in enumerate(pages):
        body = json.dumps([{"codi_territorial": f"{i}-{j}", "renda": "5"} for j in range(n)]) if n else ""
        (tmp_path / f"page_{i * 2}.json").write_text(body)
    out = documents.read_pages(spark, str(tmp_path), limit=2).collect()
    assert len(out) == wanted
    assert [r.codi_territorial for r in sorted(out, key=lambda r: (r.page, r.position))] == [f"{i}-{j}" for i, n in enumerate(pages) for j in range(n)][:wanted]


@pytest.mark.parametrize("files", [
    {"page_0.json": "", "page_2.json": "[{}]"}, {"page_2.json": "[{}]"}, {"page_0.json": "[{}, {}]", "page_2.json": "<html>busy</html>"},
    {"page_0.json": "[{}][{}]"}, {"page_0.json": '{"error": 1}'}, {"page_0.json": "[{}", "page_2.json": "[{}]"},
    {"a/page_0.json": "[{}]", "b/page_0.json": "[{}]"}, {"page.json": "[{}]"}])
def test_damaged_pages_raise(spark, tmp_path, files):
    for name, body in files.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(body)
    with pytest.raises(ValueError):
        documents.read_pages(spark, str(tmp_path / "*") if any("/" in n for n in files) else str(tmp_path), limit=2)


def test_tree(spark):
    tree = {"fitxes": {"v": {"scheme": "cat", "id": "00", "v": [
        {"scheme": "com", "id": "01", "v": {"scheme": "mun", "id": "080193"}},
        {"scheme": "com", "id": "02", "v": [{"scheme": "mun", "id": "170792"}, {"scheme": "mun", "id": "080193", "v": []}]}]}}}
    df = spark.createDataFrame([(json.dumps(tree),), ("broken",), (json.dumps({"fitxes": {"v": [{"scheme": "mun", "id": "1"}]}}),)], "doc string")
    assert [r.id for r in documents.flatten_tree(df, "doc", "mun").collect()] == ["080193", "1", "170792"]


def test_indicator_documents(spark):
    doc = lambda col, entries: json.dumps({"fitxes": {"cols": {"col": col}, "indicadors": {"i": entries}}})
    both = [{"scheme": "mun", "content": "A"}, {"@scheme": "com", "#content": "B"}]
    good = {"id": "f171", "c": "Population", "v": "10,_,30", "r": "2023", "updated": "2024-01-05T00:00:00"}
    df = spark.createDataFrame([
        ("080193", doc(both, [good, {"id": "f36", "error": "x", "v": "1"}, {"id": "f42"}, {"v": "3"}, {"id": "f1", "v": "bad", "r": "x"}])),
        ("170792", doc({"scheme": "mun", "c": "C"}, [good])), ("2", doc(both, {"id": "f171", "v": "1"})), ("3", "no json")], "municipality_id string, value string")
    got = {(r.municipality_id, r.indicator_id): r for r in documents.flatten_indicators(df).collect()}
    assert set(got) == {("080193", "f171"), ("080193", "f1"), ("170792", "f171")}
    first = got["080193", "f171"]
    assert (first.municipality_name, first.comarca_name, first.indicator_name, first.reference_year) == ("A", "B", "Population", 2023)
    assert (first.municipality_value, first.comarca_value, first.catalunya_value) == (10.0, None, 30.0)
    assert (got["080193", "f1"].municipality_value, got["080193", "f1"].reference_year) == (None, None)
    assert (got["170792", "f171"].municipality_name, got["170792", "f171"].comarca_name) == ("C", None)


def test_nanosecond_parquet_needs_the_physical_schema(spark, tmp_path):
    stamp = pa.array([1_700_000_000_123_456_789, None], pa.timestamp("ns", tz="UTC"))
    pq.write_table(pa.table({"municipality_id": ["80193", "250019"], "reference_year": [2020, 2021], "source_update_timestamp": stamp}), tmp_path / "t.parquet")
    landed = tables.scan_parquet(spark, str(tmp_path / "t.parquet"), schemas.INDICATORS_LANDED)
    out = cleaning.format_indicators(landed)
    assert out.schema == schemas.INDICATORS
    assert [(r[0], r[1]) for r in out.orderBy("reference_year").select("municipality_id", F.unix_micros("source_update_timestamp")).collect()] == [
        ("08019", 1_700_000_000_123_456), ("25001", None)]


def test_table_sink_replaces_rows_and_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_table(spark.range(5), path)
    tables.write_table(spark.createDataFrame([("x", 1)], "a string, b int"), path, columns=["b", "zz", "a"])
    back = tables.read_table(spark, path)
    assert back.columns == ["b", "a"] and back.count() == 1
    profile = {r["column"]: (r["type"], r["rows"], r["present"], r["least"]) for r in tables.profile_table(back).collect()}
    assert profile == {"a": ("string", 1, 1, "x"), "b": ("int", 1, 1, "1")}
    assert tables.sample_rows(back, 1).count() == 1


def test_ntriples_round_trip(spark, tmp_path, rows):
    data = [("u:a", "u:p", 'quo"te \\n real\nnew\ttab \\\\', "literal", "ca", None, None), ("u:a", "u:p", "u:b", "uri", None, None, None),
            ("u:a", "u:q", "2021", "literal", None, "http://www.w3.org/2001/XMLSchema#gYear", 2021.0), ("u:a", "u:q", "", "literal", None, None, None)]
    triples = spark.createDataFrame(data, schemas.TRIPLES)
    graphs.write_ntriples(triples, str(tmp_path / "nt"))
    assert rows(graphs.read_ntriples(spark, str(tmp_path / "nt"))) == rows(triples)
    graphs.write_triples(triples, str(tmp_path / "pq"))
    back = graphs.read_triples(spark, str(tmp_path / "pq"))
    assert rows(back) == rows(triples)
    assert "PartitionFilters: [isnotnull(p" in back.filter("p = 'u:p'")._jdf.queryExecution().toString()
    graphs.write_tsv_triples(triples, str(tmp_path / "tsv"))
    assert rows(graphs.read_tsv_triples(spark, str(tmp_path / "tsv"))) == [("u:a", "u:p", "u:b")]


def test_ntriples_of_all_forms(spark, rows):
    lines = ["", "# comment", '_:a <u:p> _:b . # blank nodes', r'<u:a> <u:p> "\u00e9 \U0001F600 \b\f\'\\u0041 \\n"@ca .', '<u:\\u00e9><u:p><u:o>.',
             '<u:a> <u:q> "1.50"^^<http://www.w3.org/2001/XMLSchema#double> .', '<u:a> <u:q> "\ue000 private" .']
    got = graphs.parse_ntriples(spark.createDataFrame([(x,) for x in lines], "value string"))
    assert rows(got, "s", "p", "o", "o_kind") == sorted([
        ("_:a", "u:p", "_:b", "uri"), ("u:a", "u:p", "\u00e9 \U0001f600 \b\f'\\u0041 \\n", "literal"), ("u:\u00e9", "u:p", "u:o", "uri"),
        ("u:a", "u:q", "1.50", "literal"), ("u:a", "u:q", "\ue000 private", "literal")])
    assert [r.o_num for r in got.collect() if r.o_num] == [1.5]
    again = graphs.parse_ntriples(graphs.ntriples_lines(got))
    assert rows(again) == rows(got)
    for wrong in ("<u:a> <u:b> .", "nonsense", '<u:a> <u:b> "open .'):
        with pytest.raises(Exception, match="no N-Triples statement"):
            graphs.parse_ntriples(spark.createDataFrame([(wrong,)], "value string")).collect()


def test_relations(spark, tmp_path, rows):
    whole = {"08019": {"name": "A", "neighbors": [{"id": "08101", "name": "B"}]}, "08101": {"name": "B", "neighbors": []}}
    (tmp_path / "n.json").write_text(json.dumps(whole, indent=4))
    edges = relations.parse_neighbors(relations.read_relations(spark, str(tmp_path / "n.json"), whole=True))
    assert rows(edges) == [("08019", "A", "08101", "B")]
    lonely = edges.unionByName(spark.createDataFrame([("08101", "B", None, None)], edges.schema))
    lines = [json.loads(r.value) for r in relations.relation_lines(lonely).collect()]
    assert {k: v for line in lines for k, v in line.items()} == whole
    plain = spark.createDataFrame([('{"X": {"neighbors": ["Y", "Z"]}}',)], "value string")
    assert rows(relations.parse_parent_neighbors(plain)) == [("X", "Y"), ("X", "Z")]
    parents = spark.createDataFrame([("X", "P"), ("Y", None)], "c string, p string")
    relations.write_relations(relations.parent_lines(parents, "c", "p"), str(tmp_path / "p"))
    assert rows(relations.parse_parents(relations.read_relations(spark, str(tmp_path / "p")))) == [("X", "P"), ("Y", None)]


def test_polygon_text(spark):
    df = spark.createDataFrame([("a", "POLYGON ((0 0, 4 0, 4 4, 0 0), (1 1, 2 1, 1 1))"), ("b", "MULTIPOLYGON (((0 0,1 0,1 1,0 0)),((5 5,6 5,6 6,5 5)))"),
                                ("c", "POINT (1 1)"), ("d", None)], "id string, wkt string")
    got = {r.id: [[(p.x, p.y) for p in ring] for ring in r.rings] for r in polygons.parse_polygons(df).collect()}
    assert set(got) == {"a", "b"}
    assert got["a"][1] == [(1.0, 1.0), (2.0, 1.0), (1.0, 1.0)] and len(got["b"]) == 2


def test_streams_end_each_by_itself(spark, tmp_path):
    """Short, empty and missing pages of one stream do not end another."""
    import json
    page = lambda n: json.dumps([{"periode": f"{n}.{i}"} for i in range(n)])
    files = {"a/page_1": 2, "a/page_2": 1, "a/page_3": 2, "b/page_1": 2, "b/page_2": 2, "b/page_4": 2, "c/page_0": 0, "c/page_1": 2}
    for name, n in files.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / f"{name}.json").write_text(page(n))
    out = documents.read_page_streams(spark, str(tmp_path / "*"), r"/(\w)/page", limit=2)
    got = {(r.stream, r.page): r.n for r in out.groupBy("stream", "page").agg(F.count("*").alias("n")).collect()}
    assert got == {("a", 1): 2, ("a", 2): 1, ("b", 1): 2, ("b", 2): 2}
    (tmp_path / "c" / "page_0.json").write_text("no list")
    with pytest.raises(ValueError, match="stream c"):
        documents.read_page_streams(spark, str(tmp_path / "*"), r"/(\w)/page", limit=2)


def test_deep_trees_end_where_their_nodes_do(spark):
    import json
    node = {"scheme": "mun", "id": "deepest"}
    for level in range(12):
        node = {"scheme": "mun", "id": f"m{level}", "v": node if level % 2 else [node, {"scheme": "com", "id": f"c{level}"}]}
    docs = spark.createDataFrame([(json.dumps({"fitxes": {"v": node}}),), (None,), ("{}",), ("broken",)], "doc string")
    assert [r.id for r in documents.flatten_tree(docs, "doc", "mun").collect()] == sorted(["deepest", *[f"m{n}" for n in range(12)]])


def test_pages_as_rows_follow_the_rules_of_files(spark):
    body = lambda *names: json.dumps([{"codi_territorial": n} for n in names])
    rows = [("s=a/p=0", body("a0", "a1")), ("s=a/p=1", body("a2")), ("s=a/p=2", body("stale")), ("s=b/p=0", body("b0", "b1")), ("s=b/p=1", "[]"), ("s=b/p=2", body("stale"))]
    got = documents.page_streams(spark.createDataFrame(rows, "path string, value string"), r"s=(\w+)", limit=2, number=r"p=(\d+)")
    assert sorted((r.stream, r.page, r.position, r.codi_territorial) for r in got.collect()) == [
        ("a", 0, 0, "a0"), ("a", 0, 1, "a1"), ("a", 1, 0, "a2"), ("b", 0, 0, "b0"), ("b", 0, 1, "b1")]
    with pytest.raises(ValueError):
        documents.page_streams(spark.createDataFrame([*rows, ("s=a/p=1", body())], "path string, value string"), r"s=(\w+)", limit=2, number=r"p=(\d+)")


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="needs the given tables")
@pytest.mark.parametrize("name", ["landed_pages", "landed_streams"])
def test_landed_pages_take_no_file_each(spark, monkeypatch, name):
    import __spark_entry__ as entry
    held = []
    monkeypatch.setattr(documents, "page_streams", lambda landed, *args, _of=documents.page_streams, **more: held.append(landed) or _of(landed, *args, **more))
    assert entry.queries()[name](spark, "/root/testdata/sf0.001").count()
    assert len(held[0].inputFiles()) <= 8


def test_relation_files_are_compressed(spark, tmp_path):
    edges = spark.range(20_000).selectExpr("cast(id % 50 as string) id", "concat('Customer ', id % 50) name", "cast(id as string) neighbor_id", "concat('Customer ', id) neighbor_name")
    relations.write_relations(relations.relation_lines(edges, part_size=100), str(tmp_path / "r"))
    files = [f for f in (tmp_path / "r").iterdir() if f.name.startswith("part-")]
    assert files and sum(f.stat().st_size for f in files) < 300_000  # a million bytes of text
    assert sorted(map(tuple, relations.parse_neighbors(relations.read_relations(spark, str(tmp_path / "r"))).collect())) == sorted(map(tuple, edges.collect()))
