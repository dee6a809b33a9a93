"""Get-or-create of dimension rows and coverage of the city dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ecostar.sources.warehouse import number_rows, stage


def new_rows(
    dim: DataFrame, incoming: DataFrame, keys: list[str], id_col: str, order: str = "id"
) -> DataFrame:
    """One row per natural key that the dimension lacks.

    The attributes come from the entry with the lowest lake id, and the ids follow
    the order of first appearance. The new keys are written out before they are
    numbered, so the entries behind them are read once.
    """
    attributes = [c for c in dim.columns if c not in (*keys, id_col)]
    known = incoming.dropna(subset=keys).join(dim.select(*keys), keys, "left_anti")
    first = known.groupBy(*keys).agg(
        F.min(order).alias("_first"),
        *(F.min_by(c, order).alias(c) for c in attributes if c in incoming.columns),
    )
    numbered = number_rows(stage(first, "new-keys"), "_first", id_col, dim.agg(F.max(id_col)).scalar())
    typed = numbered.withColumn(id_col, F.col(id_col).cast(dim.schema[id_col].dataType))
    return typed.select(*(c for c in dim.columns if c in typed.columns))


def get_or_create(
    dim: DataFrame, incoming: DataFrame, keys: list[str], id_col: str, order: str = "id"
) -> DataFrame:
    """The dimension, its rows unchanged, plus the rows of new natural keys."""
    return dim.unionByName(new_rows(dim, incoming, keys, id_col, order), allowMissingColumns=True)


TRAFFIC_POINT = (
    "traffic_point_id INT, city_id INT, code_point STRING, libelle_point STRING, "
    "latitude DOUBLE, longitude DOUBLE, actif BOOLEAN"
)
INCIDENT_CATEGORY = "incident_category_id INT, icon_category INT, libelle_category STRING"
COMMUNE = "commune_id INT, code_commune STRING, nom_commune STRING"
STATION = (
    "station_id INT, code_station STRING, libelle_station STRING, latitude DOUBLE, longitude DOUBLE, "
    "code_commune STRING, libelle_commune STRING"
)
GROUNDWATER_STATION = "groundwater_station_id INT, code_bss STRING, bss_id STRING"

# Labels of incident categories given by the data contract.
INCIDENT_LABELS = {8: "RoadClosed", 1: "Accident", 6: "Jam"}


def traffic_points(dim: DataFrame, flows: DataFrame) -> DataFrame:
    incoming = flows.withColumns(
        {"libelle_point": F.concat(F.lit("Point "), "code_point"), "actif": F.lit(True)}
    )
    return get_or_create(dim, incoming, ["city_id", "code_point"], "traffic_point_id")


def incident_categories(dim: DataFrame, incidents: DataFrame, use_labels: bool = False) -> DataFrame:
    label = F.col("libelle_categorie")
    if use_labels:
        for code, name in INCIDENT_LABELS.items():
            label = F.when(F.col("categorie_incident") == code, F.lit(name)).otherwise(label)
    incoming = incidents.withColumns(
        {"icon_category": F.col("categorie_incident"), "libelle_category": label}
    )
    return get_or_create(dim, incoming, ["icon_category"], "incident_category_id")


def communes(dim: DataFrame, water: DataFrame) -> DataFrame:
    return get_or_create(dim, water.filter(F.length("code_commune") > 0), ["code_commune"], "commune_id")


def stations(dim: DataFrame, station_rows: DataFrame, observations: DataFrame) -> DataFrame:
    """Stations announce themselves or appear first, bare, in an observation."""
    described = station_rows.select(
        "id", "code_station", "libelle_station", "latitude", "longitude", "code_commune", "libelle_commune"
    )
    bare = observations.select("id", "code_station")
    return get_or_create(
        dim, described.unionByName(bare, allowMissingColumns=True), ["code_station"], "station_id"
    )


def groundwater_stations(dim: DataFrame, readings: DataFrame) -> DataFrame:
    return get_or_create(dim, readings, ["code_bss"], "groundwater_station_id")


def missing_cities(df: DataFrame, cities: DataFrame) -> DataFrame:
    """Expected cities without a row."""
    seen = df.filter(F.col("city_id").isNotNull()).select("city_id").distinct()
    return cities.select("city_id", "city_name").join(seen, "city_id", "left_anti")
