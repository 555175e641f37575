"""Codes, brackets, ranges, names and identifiers that results depend on."""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------------

# Indicator code -> property name (current annual table and graph).
INDICATOR_NAMES = {
    "f171": "population",
    "f36": "populationMen",
    "f42": "populationWomen",
    "f187": "birthsTotal",
    "f183": "populationSpanishNat",
    "f261": "surfaceKM2",
    "f262": "densityPopKM2",
    "f328": "longitude",
    "f329": "latitude",
    "f308": "unemploymentTotal",
    "f191": "totalFamilyDwellings",
    "f270": "publicLibrariesCount",
    "f293": "sportsPavilionsCount",
    "f294": "multiSportsCourtsCount",
    "f301": "indoorPoolsCount",
}

# Indicator code -> column name (older annual table).
INDICATOR_COLUMNS = {
    "f171": "population",
    "f36": "population_men",
    "f42": "population_women",
    "f187": "births_total",
    "f183": "population_spanish_nat",
    "f261": "surface_km2",
    "f262": "density_pop_km2",
    "f328": "longitude",
    "f329": "latitude",
    "f308": "unemployment_total_avg",
    "f191": "total_family_dwellings",
    "f270": "public_libraries_count",
    "f293": "sports_pavilions_count",
    "f294": "multi_sports_courts_count",
    "f301": "indoor_pools_count",
}

# Indicator code -> plausible inclusive range of the municipal value.
INDICATOR_RANGES = {
    "f171": (0.0, 2_000_000.0),
    "f36": (0.0, 1_000_000.0),
    "f42": (0.0, 1_000_000.0),
    "f187": (0.0, 50_000.0),
    "f183": (0.0, 2_000_000.0),
    "f261": (0.0, 500.0),
    "f262": (0.0, 50_000.0),
    "f328": (0.0, 3.5),
    "f329": (40.5, 43.0),
    "f308": (0.0, 500_000.0),
    "f191": (0.0, 1_000_000.0),
    "f270": (0.0, 1_000.0),
    "f293": (0.0, 1_000.0),
    "f294": (0.0, 1_000.0),
    "f301": (0.0, 1_000.0),
}

# Older ranges: non-negative counts and areas, plus coordinates.
INDICATOR_RANGES_V1 = {
    code: ((0.0, float("inf")) if code not in ("f328", "f329") else INDICATOR_RANGES[code])
    for code in INDICATOR_RANGES
}

# Rent bracket label -> rent assumed when the rent itself is missing.
RENT_BRACKETS = {
    "<= 350 euros/mes": 325.0,
    "> 350 i <= 450 euros/mes": 400.0,
    "> 350 i <= 500 euros/mes": 425.0,
    "> 450 i <= 600 euros/mes": 525.0,
    "> 500 i <= 650 euros/mes": 575.0,
    "> 600 euros/mes": 800.0,
    "> 650 euros/mes": 900.0,
}

# Income indicator code -> column of the graph's annual data.
INCOME_COLUMNS = {
    "PER_CAPITA_EUR": "income_per_capita",
    "PER_CAPITA_INDEX": "income_index_cat_100",
    "VALUE_EK": "income_total_thousands_eur",
}

# Comarca -> province.
COMARCA_PROVINCE = {
    "Alt Camp": "Tarragona",
    "Alt Empordà": "Girona",
    "Alt Penedès": "Barcelona",
    "Alt Urgell": "Lleida",
    "Alta Ribagorça": "Lleida",
    "Anoia": "Barcelona",
    "Aran": "Lleida",
    "Bages": "Barcelona",
    "Baix Camp": "Tarragona",
    "Baix Ebre": "Tarragona",
    "Baix Empordà": "Girona",
    "Baix Llobregat": "Barcelona",
    "Baix Penedès": "Tarragona",
    "Barcelonès": "Barcelona",
    "Berguedà": "Barcelona",
    "Cerdanya": "Girona",
    "Conca de Barberà": "Tarragona",
    "Garraf": "Barcelona",
    "Garrigues": "Lleida",
    "Garrotxa": "Girona",
    "Gironès": "Girona",
    "Lluçanès": "Barcelona",
    "Maresme": "Barcelona",
    "Moianès": "Barcelona",
    "Montsià": "Tarragona",
    "Noguera": "Lleida",
    "Osona": "Barcelona",
    "Pallars Jussà": "Lleida",
    "Pallars Sobirà": "Lleida",
    "Pla d'Urgell": "Lleida",
    "Pla de l'Estany": "Girona",
    "Priorat": "Tarragona",
    "Ribera d'Ebre": "Tarragona",
    "Ripollès": "Girona",
    "Segarra": "Lleida",
    "Segrià": "Lleida",
    "Selva": "Girona",
    "Solsonès": "Lleida",
    "Tarragonès": "Tarragona",
    "Terra Alta": "Tarragona",
    "Urgell": "Lleida",
    "Vallès Occidental": "Barcelona",
    "Vallès Oriental": "Barcelona",
}

# Cube column -> income table column, in output order.
INCOME_RENAMES = {
    "YEAR_CODE": "year_code",
    "YEAR_LABEL": "year_label",
    "MUN_CODE": "municipality_id",
    "MUN_LABEL": "municipality_name",
    "CONCEPT_CODE": "concept_code",
    "CONCEPT_LABEL": "concept_label",
    "INDICATOR_CODE": "indicator_code",
    "INDICATOR_LABEL": "indicator_label",
    "VALUE": "value",
}

# Ranking metric -> display name.
METRIC_NAMES = {
    "inverse_harmonic_mean_rank": "IHMR",
    "hits_at_1": "Hits@1",
    "hits_at_3": "Hits@3",
    "hits_at_5": "Hits@5",
    "hits_at_10": "Hits@10",
}

# Graph identifiers.
NS = "http://example.com/catalonia-ontology/"
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
OWL = "http://www.w3.org/2002/07/owl#"
XSD = "http://www.w3.org/2001/XMLSchema#"

# Columns of the older annual table, in order.
ANNUAL_V1_COLUMNS = [
    "municipality_id", "municipality_name", "comarca_name", "any",
    "avg_monthly_rent_eur", "total_annual_contracts", "salary_per_capita_eur",
    *INDICATOR_COLUMNS.values(),
]

# --- end of fixed values ------------------------------------------------------------

RDF_TYPE = RDF + "type"
RDFS_LABEL = RDFS + "label"
XSD_DOUBLE = XSD + "double"
XSD_INTEGER = XSD + "integer"
XSD_GYEAR = XSD + "gYear"
NUMERIC_TYPES = (XSD_DOUBLE, XSD_INTEGER, XSD_GYEAR)
