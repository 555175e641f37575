"""Stages over a folder: landed files, formatted, trusted and exploitation tables, analysis."""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terraloom import schemas, vocab
from terraloom.functions.columns import normalize_id
from terraloom.operators.aggregate import collect_in_parts
from terraloom.operators.embeddings import compare_experiments, embedding_features, grid_split, run_grid, train_experiment
from terraloom.operators.features import feature_columns, time_features
from terraloom.operators.joins import derive_parent_edges, join_embeddings, mapping_frame, with_geometry
from terraloom.operators.ordering import dedupe_keys, time_split
from terraloom.operators.patterns import CATALOG, run_catalog
from terraloom.operators.quality import entity_triples
from terraloom.operators.regression import evaluate, save_model, top_importances, train_gbt, write_metrics
from terraloom.operators.retrieval import render_prompts, retrieve_context
from terraloom.operators.schema import map_column
from terraloom.operators.spatial import spatial_neighbors
from terraloom.plans import cleaning
from terraloom.plans.annual import annual_data, municipal_annual
from terraloom.plans.graph import build_graph
from terraloom.sources.documents import flatten_indicators, parse_cubes, read_pages
from terraloom.sources.graphs import read_triples, write_triples
from terraloom.sources.polygons import read_polygons
from terraloom.sources.relations import parent_lines, parse_neighbors, parse_parent_neighbors, relation_lines
from terraloom.sources.tables import read_table, scan_parquet, write_table

SOURCES = ("indicators", "rent", "income")
PARTS = ("query", "rag_query", "embeddings", "prediction")
ZONES = ("landing", "formatted", "trusted", "exploitation", "analysis")


def layout(root: str) -> dict[str, str]:
    """Folders of a deployment; sinks create them."""
    names = ("raw", *ZONES, "relations", "models")
    return {n: str(PurePosixPath(root) / n) if "://" not in root else f"{root.rstrip('/')}/{n}" for n in names}


def _land(spark: SparkSession, at: dict[str, str], source: str) -> None:
    """Landed tables from files as fetched: indicator documents, rent pages, the income cube."""
    if source == "indicators":
        docs = spark.read.text(f"{at['raw']}/indicators", wholetext=True).select(
            F.regexp_extract(F.col("_metadata.file_path"), r"([^/.]+)\.[^/]*$", 1).alias("municipality_id"), "value")
        rows = flatten_indicators(docs)
        # Landed times are epoch nanoseconds, like those of the fetching tool.
        rows = rows.withColumn("source_update_timestamp", F.unix_micros("source_update_timestamp") * 1000)
        write_table(rows, f"{at['landing']}/indicators", columns=schemas.INDICATORS_LANDED.fieldNames())
    elif source == "rent":
        write_table(read_pages(spark, f"{at['raw']}/rent"), f"{at['landing']}/rent", columns=schemas.RENT.fieldNames())
    else:
        write_table(spark.read.text(f"{at['raw']}/income", wholetext=True), f"{at['landing']}/income")


def _format(spark: SparkSession, at: dict[str, str], source: str, fmt: str) -> None:
    path = f"{at['landing']}/{source}"
    if source == "indicators":
        table = cleaning.format_indicators(scan_parquet(spark, path, schemas.INDICATORS_LANDED))
    elif source == "rent":
        table = cleaning.format_rent(scan_parquet(spark, path))
    else:
        table = cleaning.format_income(parse_cubes(scan_parquet(spark, path)))
    write_table(table, f"{at['formatted']}/{source}", fmt)


def _trust(spark: SparkSession, at: dict[str, str], source: str, fmt: str) -> None:
    table = read_table(spark, f"{at['formatted']}/{source}", fmt)
    clean, report = getattr(cleaning, f"clean_{source}")(table)
    write_table(clean, f"{at['trusted']}/{source}", fmt)
    write_table(report, f"{at['trusted']}/reports/{source}", fmt)


def run_zone(spark: SparkSession, root: str, zone: str, fmt: str = "parquet") -> None:
    """One of the first three zones for all sources, in order; a failure stops the run."""
    at = layout(root)
    for source in SOURCES:
        if zone == "landing":
            _land(spark, at, source)
        elif zone == "formatted":
            _format(spark, at, source, fmt)
        elif zone == "trusted":
            _trust(spark, at, source, fmt)
        else:
            raise ValueError(f"unknown zone {zone}")


def relations(spark: SparkSession, root: str) -> None:
    """Neighbour and parent relations from landed indicators and polygons, as keyed JSON."""
    at = layout(root)
    landed = scan_parquet(spark, f"{at['landing']}/indicators", schemas.INDICATORS_LANDED)
    places = dedupe_keys(
        landed.select(normalize_id("municipality_id").alias("municipality_id"), "comarca_name", "municipality_name"),
        ["municipality_id"])
    polys = read_polygons(spark, f"{at['raw']}/polygons").select(
        normalize_id("id").alias("municipality_id"), "rings")
    shaped = with_geometry(places, dedupe_keys(polys, ["municipality_id"]))
    names = shaped.select("municipality_id", "municipality_name")
    edges = spatial_neighbors(shaped, "municipality_id")
    named = (names.select(F.col("municipality_id").alias("id"), F.col("municipality_name").alias("name"))
             .join(edges, "id", "left")
             .join(names.select(F.col("municipality_id").alias("neighbor_id"),
                                F.col("municipality_name").alias("neighbor_name")), "neighbor_id", "left"))
    relation_lines(named).write.mode("overwrite").text(f"{at['relations']}/neighbors")
    parents = shaped.select(F.col("municipality_id").alias("id"), F.col("comarca_name").alias("parent")).dropna()
    derived = derive_parent_edges(edges, parents)
    collect_in_parts(derived, ["parent"], F.col("neighbor"), "neighbors").select(
        F.to_json(F.create_map("parent", F.struct("neighbors"))).alias("value")
    ).write.mode("overwrite").text(f"{at['relations']}/adjacent")
    provinces = map_column(shaped.select("comarca_name").dropna().distinct(), "comarca_name",
                           vocab.COMARCA_PROVINCE, out="province_name")
    parent_lines(provinces, "comarca_name", "province_name").write.mode("overwrite").text(f"{at['relations']}/provinces")


def exploit(spark: SparkSession, root: str, fmt: str = "parquet") -> None:
    """Relations, the consolidated annual table and the knowledge graph."""
    at = layout(root)
    relations(spark, root)
    indicators, rent, income = (read_table(spark, f"{at['trusted']}/{s}", fmt) for s in SOURCES)
    write_table(municipal_annual(rent, income, indicators), f"{at['exploitation']}/municipal_annual", fmt)
    lines = lambda name: spark.read.text(f"{at['relations']}/{name}")
    provinces = mapping_frame(spark, vocab.COMARCA_PROVINCE, "comarca_name", "province_name")
    graph = build_graph(indicators, annual_data(rent, income), provinces, parse_neighbors(lines("neighbors")),
                        parse_parent_neighbors(lines("adjacent")))
    write_triples(graph, f"{at['exploitation']}/knowledge_graph", fmt)


def _predict(spark: SparkSession, at: dict[str, str], annual: DataFrame, vectors: DataFrame, dim: int, options: dict) -> None:
    joined = join_embeddings(annual, embedding_features(vectors, dim))
    timed = time_features(joined).dropna(subset=["avg_monthly_rent", "avg_monthly_rent_lag1"])
    split = time_split(timed, "any")
    model = train_gbt(split, feature_columns(timed), **options)
    scored, metrics = evaluate(model, split)
    save_model(model, f"{at['models']}/rent")
    write_metrics(metrics, f"{at['analysis']}/prediction")
    scored.write.mode("overwrite").parquet(f"{at['analysis']}/predictions")
    top_importances(spark, model).write.mode("overwrite").parquet(f"{at['analysis']}/importances")


def analyse(spark: SparkSession, root: str, parts: Sequence[str], fmt: str = "parquet", model: str = "TransH",
            dim: int = 128, questions: DataFrame | None = None, training: dict | None = None,
            boosting: dict | None = None, grid: Sequence[tuple[str, int]] = ()) -> None:
    """Chosen analysis parts in fixed order: catalogue queries, retrieval, embeddings, prediction.

    Embeddings are split, trained with early stopping, tested and compared for ``grid`` or else for
    ``(model, dim)`` alone; the prediction joins the vectors of the experiment of ``model`` and ``dim``,
    trained by the same rule whichever part asks for them first.
    """
    at = layout(root)
    graph = read_triples(spark, f"{at['exploitation']}/knowledge_graph", fmt)
    stored_at = f"{at['analysis']}/embeddings"
    vectors = lambda: train_experiment(spark, grid_split(entity_triples(graph)), model, dim, stored_at, **(training or {}))
    for part in PARTS:
        if part not in parts:
            continue
        if part == "query":
            write_table(run_catalog(graph, CATALOG), f"{at['analysis']}/query", fmt)
        elif part == "rag_query" and questions is not None:
            found = retrieve_context(questions, graph).join(
                questions.select("question_id", "question").distinct(), "question_id")
            write_table(render_prompts(found, "question", "context"), f"{at['analysis']}/prompts", fmt)
        elif part == "embeddings":
            metrics, failed = run_grid(spark, entity_triples(graph), [*grid] or [(model, dim)], stored_at, **(training or {}))
            if metrics is None:
                raise RuntimeError(f"no experiment succeeded: {failed}")
            write_table(compare_experiments(metrics), f"{at['analysis']}/comparison", fmt)
        elif part == "prediction":
            annual = read_table(spark, f"{at['exploitation']}/municipal_annual", fmt)
            _predict(spark, at, annual, vectors().filter("kind = 'e'"), dim, boosting or {})


def run_pipeline(spark: SparkSession, root: str, start: int = 1, stop: int = 5, parts: Sequence[str] = (),
                 fmt: str = "parquet", **analysis) -> None:
    """Stages ``start`` to ``stop``: landing, formatted, trusted, exploitation, analysis."""
    unknown = [p for p in parts if p not in PARTS]
    if unknown:
        raise ValueError(f"unknown analysis parts {unknown}; choose from {PARTS}")
    for number, zone in enumerate(ZONES, 1):
        if not start <= number <= stop:
            continue
        if zone == "exploitation":
            exploit(spark, root, fmt)
        elif zone == "analysis":
            analyse(spark, root, parts, fmt, **analysis)
        else:
            run_zone(spark, root, zone, fmt)
