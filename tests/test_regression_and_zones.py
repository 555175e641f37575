import json
import random

import pytest
from pyspark.sql import functions as F

from terraloom import vocab
from terraloom.operators import regression as R
from terraloom.operators.ordering import time_split
from terraloom.plans import zones
from terraloom.session import read_options
from terraloom.sources.graphs import read_triples


def test_best_round():
    assert R.best_round([5, 4, 3, 3.5, 3.6, 1], 2) == 3
    assert R.best_round([5, 4, 3, 3.5, 1], 5) == 5
    assert R.best_round([2], 3) == 1


def test_boosted_trees_beat_the_last_value(spark, tmp_path):
    rng = random.Random(4)
    data = []
    for i in range(60):
        level = rng.uniform(300, 900)
        for y in range(2015, 2022):
            data.append((f"m{i}", y, level + 0.4 * (y - 2015) * (level - 500) / 10 + rng.gauss(0, 40), level + rng.gauss(0, 5) if rng.random() > 0.1 else None,
                         f"c{i % 5}" if y < 2021 or i else "unseen"))
    df = spark.createDataFrame(data, "municipality_id string, any int, avg_monthly_rent double, signal double, comarca_name string")
    split = time_split(df, "any").withColumn("lag", F.col("avg_monthly_rent") * 0 + 600)
    model = R.train_gbt(split, ["any", "signal", "comarca_name"], rounds=15, rate=0.3, patience=5, depth=3)
    assert 1 <= model.best_rounds <= 15 and model.flags == ["signal"]
    scored, metrics = R.evaluate(model, split)
    assert scored.count() == 60 and scored.filter("prediction is null").count() == 0
    spread = split.filter("split = 'test'").agg(F.avg(F.abs(F.col("avg_monthly_rent") - 600))).first()[0]
    assert metrics.first().mae < 0.6 * spread
    top = R.top_importances(spark, model, 2).collect()
    assert top[0].feature == "signal" and top[0].importance >= top[1].importance
    R.save_model(model, str(tmp_path / "m"))
    R.write_metrics(metrics, str(tmp_path / "metrics"))
    assert spark.read.json(str(tmp_path / "metrics")).first().r2 == pytest.approx(metrics.first().r2)


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    """Raw files of four municipalities in two comarques."""
    root = tmp_path_factory.mktemp("platform")
    towns = [("080193", "Alpha", "Alt Camp"), ("081015", "Beta", "Alt Camp"), ("170792", "Girona", "Osona"), ("250019", "Delta", "Osona")]
    for name in ("indicators", "rent", "income", "polygons"):
        (root / "raw" / name).mkdir(parents=True)
    for i, (code, name, comarca) in enumerate(towns):
        entry = [{"id": c, "c": c, "v": f"{1 + i}.5,_,3", "r": "2021", "updated": "2024-01-05T00:00:00"} for c in ("f171", "f329")]
        entry[1]["v"] = "41.5"
        (root / "raw/indicators" / f"{code}.json").write_text(json.dumps({"fitxes": {"cols": {"col": [
            {"scheme": "mun", "content": name}, {"scheme": "com", "content": comarca}]}, "indicadors": {"i": entry}}}))
    rows = [{"ambit_territorial": "Municipi", "codi_territorial": code[:5], "nom_territori": name, "any": str(y), "periode": "T1",
             "habitatges": str(3 + i), "renda": str(400 + 50 * i + 10 * (y - 2014)), "tram_preus": "> 600 euros/mes"} for i, (code, name, _) in enumerate(towns) for y in range(2014, 2022)]
    for page in range(0, len(rows) + 1, 10):
        (root / "raw/rent" / f"page_{page // 10}.json").write_text(json.dumps(rows[page:page + 10]))
    dims = {"YEAR": [str(y) for y in range(2014, 2022)], "MUN": [c for c, _, _ in towns], "CONCEPT": ["c"], "INDICATOR": ["PER_CAPITA_EUR", "VALUE_EK"]}
    size = 8 * 4 * 2
    (root / "raw/income/cube.json").write_text(json.dumps({"id": list(dims), "dimension": {d: {"category": {"index": v}} for d, v in dims.items()}, "value": [15000 + i for i in range(size)]}, indent=1))
    return root, towns


def test_stages_end_to_end(spark, landed, monkeypatch):
    root, towns = landed
    squares = [(code, f"POLYGON (({i * 10} 0, {i * 10 + 10} 0, {i * 10 + 10} 10, {i * 10} 10, {i * 10} 0))") for i, (code, _, _) in enumerate(towns)]
    spark.createDataFrame(squares, "id string, wkt string").write.mode("overwrite").parquet(str(root / "raw/polygons"))
    from terraloom.sources import documents
    monkeypatch.setattr(zones, "read_pages", lambda s, p: documents.read_pages(s, p, limit=10))
    questions = spark.createDataFrame([("1", "Who borders on Alpha?", "Alpha", None, None, None, vocab.NS + "isNeighborOf")],
                                      "question_id string, question string, label string, via string, where_p string, where_o string, predicate string")
    zones.run_pipeline(spark, str(root), 1, 5, ["prediction", "query", "rag_query", "embeddings"], model="TransE", dim=4, questions=questions,
                       training={"epochs": 1}, boosting={"rounds": 2, "rate": 0.3, "depth": 2})
    at = zones.layout(str(root))
    assert spark.read.parquet(f"{at['trusted']}/rent").count() == 32
    assert spark.read.parquet(f"{at['trusted']}/income").count() == 64
    assert spark.read.parquet(f"{at['trusted']}/reports/indicators").count() == 3
    annual = spark.read.parquet(f"{at['exploitation']}/municipal_annual")
    assert annual.count() == 32 and annual.filter("population is null or income_per_capita is null or avg_monthly_rent is null").count() == 0
    graph = read_triples(spark, f"{at['exploitation']}/knowledge_graph")
    assert graph.filter(F.col("p") == vocab.NS + "isNeighborOf").count() == 6
    assert graph.filter(F.col("p") == vocab.NS + "isAdjacentTo").count() == 2
    assert graph.filter(F.col("p") == vocab.NS + "isInProvince").count() == 2
    assert "Beta" in spark.read.parquet(f"{at['analysis']}/prompts").first().prompt
    assert spark.read.parquet(f"{at['analysis']}/query").count() == 5
    assert spark.read.json(f"{at['analysis']}/prediction").columns == ["mae", "mape", "mse", "r2", "rmse"]


def test_stage_choice(spark, tmp_path):
    with pytest.raises(ValueError, match="nonsense"):
        zones.run_pipeline(spark, str(tmp_path), parts=["nonsense"])
    with pytest.raises(ValueError):
        zones.run_zone(spark, str(tmp_path), "nowhere")
    zones.run_pipeline(spark, str(tmp_path), 5, 4)  # an empty range does nothing
    assert zones.layout("s3://b/x/")["trusted"] == "s3://b/x/trusted"
    assert set(read_options().values()) == {"CORRECTED"}


def test_a_missing_source_stops_the_run(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        zones.run_zone(spark, str(tmp_path), "formatted")
