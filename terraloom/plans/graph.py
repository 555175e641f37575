"""Assembly of the knowledge graph from cleaned tables and relations."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from terraloom import vocab
from terraloom.operators.triples import (
    concept_triples, datapoint_triples, edge_triples, geo_triples, observation_triples,
)


def build_graph(indicators: DataFrame, annual: DataFrame, provinces: DataFrame, neighbors: DataFrame,
                adjacent: DataFrame, names: Mapping[str, str] = vocab.INDICATOR_NAMES,
                order: tuple[str, ...] = ("reference_year",), all_concepts: bool = True) -> DataFrame:
    """All statements, each once.

    ``provinces``: ``comarca_name, province_name``; ``neighbors``: ``id, neighbor_id``;
    ``adjacent``: ``parent, neighbor`` of comarques. The families make statements about
    different kinds of subjects or predicates and each makes its own distinct, so no shuffle of
    the whole graph is needed for the set. ``all_concepts`` names every indicator of the fixed
    list, else those that occur.
    """
    codes = (indicators.sparkSession.createDataFrame([(c,) for c in names], "indicator_id string")
             if all_concepts else indicators.select("indicator_id"))
    parts = [
        geo_triples(indicators.select("municipality_id", "municipality_name", "comarca_name"), provinces),
        edge_triples(neighbors, "id", "neighbor_id", "municipality", "isNeighborOf"),
        edge_triples(adjacent, "parent", "neighbor", "comarca", "isAdjacentTo"),
        concept_triples(codes, "indicator_id", names),
        observation_triples(indicators, names, order),
        datapoint_triples(annual),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
