"""Traffic flow and incident facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ecostar.functions import expr
from ecostar.operators.loading import keep_first

FLOW_KEY = ["date_value", "hour_of_day", "city_id", "traffic_point_id"]
FLOW_FACT = (
    "date_value DATE, hour_of_day INT, city_id INT, traffic_point_id INT, traffic_model_id STRING, "
    "vitesse_actuelle_kmph DOUBLE, vitesse_fluide_kmph DOUBLE, temps_trajet_actuel_s DOUBLE, "
    "temps_trajet_fluide_s DOUBLE, congestion_ratio DOUBLE, speed_ratio DOUBLE, route_fermee BOOLEAN, "
    "indice_confiance DOUBLE"
)
INCIDENT_KEY = ["date_value", "hour_of_day", "city_id", "incident_category_id"]
INCIDENT_FACT = (
    "date_value DATE, hour_of_day INT, city_id INT, incident_category_id INT, traffic_model_id STRING, "
    "nombre_incidents BIGINT, retard_total_s DOUBLE, retard_moyen_s DOUBLE, longueur_moyenne_m DOUBLE, "
    "incident_severity_score DOUBLE"
)


def _model_id(chars: int | None = None):
    text = F.substring("traffic_model_id", 1, chars) if chars else F.col("traffic_model_id")
    return F.when(F.length(text) > 0, text)


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"date_value": F.to_date("collected_at"), "hour_of_day": F.hour("collected_at")}
    )


def flow_rows(flows: DataFrame, dim_points: DataFrame, model_chars: int | None = None) -> DataFrame:
    """Flow records as fact rows; ``model_chars`` cuts the model id, by default it stays whole."""
    points = dim_points.select("city_id", "code_point", "traffic_point_id")
    return _dated(flows.join(points, ["city_id", "code_point"])).select(
        "id",
        *FLOW_KEY,
        _model_id(model_chars).alias("traffic_model_id"),
        "vitesse_actuelle_kmph",
        "vitesse_fluide_kmph",
        "temps_trajet_actuel_s",
        "temps_trajet_fluide_s",
        "congestion_ratio",
        "speed_ratio",
        F.coalesce("route_fermee", F.lit(False)).alias("route_fermee"),
        "indice_confiance",
    )


def load_flow(
    old: DataFrame, flows: DataFrame, dim_points: DataFrame, within: str | None = None
) -> DataFrame:
    """Rows to add: the first per point and hour, unless the table has one."""
    return keep_first(old, flow_rows(flows, dim_points), FLOW_KEY, within=within)


def scored_incidents(incidents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(incidents with their severity, those whose delay has no logarithm)."""
    score = expr.incident_severity(
        F.col("gravite_retard"), F.col("retard_s"), F.col("categorie_incident")
    )
    scored = incidents.withColumn("incident_severity_score", score)
    bad = F.coalesce("retard_s", F.lit(0.0)) <= -1
    return scored.filter(~bad), scored.filter(bad).withColumn("reason", F.lit("negative_delay"))


def load_incidents(
    incidents: DataFrame, dim_categories: DataFrame, model_chars: int | None = None
) -> DataFrame:
    """One row per hour, city and category; whole hours are recomputed, so reruns agree.

    Model id and length come from the first incident of the group; ``model_chars`` cuts the id.
    """
    scored, _ = scored_incidents(incidents)
    cats = dim_categories.select(
        F.col("icon_category").alias("categorie_incident"), "incident_category_id"
    )
    delay = F.coalesce("retard_s", F.lit(0.0))
    return (
        _dated(scored.join(cats, "categorie_incident"))
        .withColumn("traffic_model_id", _model_id(model_chars))
        .groupBy(*INCIDENT_KEY)
        .agg(
            F.min_by("traffic_model_id", "id").alias("traffic_model_id"),
            F.count("*").alias("nombre_incidents"),
            F.sum(delay).alias("retard_total_s"),
            (F.sum(delay) / F.count("*")).alias("retard_moyen_s"),
            F.min_by("longueur_m", "id").alias("longueur_moyenne_m"),
            F.max("incident_severity_score").alias("incident_severity_score"),
        )
    )
