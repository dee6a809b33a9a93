"""Schemas of the lake, of the payloads and of the warehouse tables."""

LAKE = (
    "id BIGINT, city_id INT, city_name STRING, source STRING, raw_data STRING, "
    "collected_at TIMESTAMP, processed BOOLEAN, processed_at TIMESTAMP"
)

WEATHER = "openweather"
AIR = "aqicn"
FLOW = "tomtom_flow"
INCIDENTS = "tomtom_incidents"
DRINKING_WATER = "hubeau_eau_potable"
RIVER_STATIONS = "hubeau_cd_stations"
RIVER_OBSERVATIONS = "hubeau_cd_observations"
GROUNDWATER = ("hubeau_chroniques", "hubeau_chroniques_tr")

FAMILIES = {
    "weather_air": (WEATHER, AIR),
    "traffic": (FLOW, INCIDENTS),
    "water": (DRINKING_WATER, RIVER_STATIONS, RIVER_OBSERVATIONS),
}

WEATHER_PAYLOAD = (
    "main STRUCT<temp: DOUBLE, feels_like: DOUBLE, pressure: DOUBLE, humidity: DOUBLE>, "
    "wind STRUCT<speed: DOUBLE, deg: DOUBLE, gust: DOUBLE>, clouds STRUCT<all: DOUBLE>, "
    "rain STRUCT<`1h`: DOUBLE>, snow STRUCT<`1h`: DOUBLE>, visibility DOUBLE, "
    "weather ARRAY<STRUCT<id: INT, main: STRING, description: STRING>>"
)

POLLUTANTS = ("pm25", "pm10", "no2", "o3", "so2", "co")

AIR_PAYLOAD = (
    "data STRUCT<aqi: DOUBLE, iaqi: STRUCT<"
    + ", ".join(f"{p}: STRUCT<v: DOUBLE>" for p in POLLUTANTS)
    + ">>"
)

# The same node with bare numbers in place of {"v": number}.
AIR_PAYLOAD_BARE = (
    "data STRUCT<iaqi: STRUCT<" + ", ".join(f"{p}: DOUBLE" for p in POLLUTANTS) + ">>"
)

FLOW_API = (
    "flowSegmentData STRUCT<currentSpeed: DOUBLE, freeFlowSpeed: DOUBLE, currentTravelTime: DOUBLE, "
    "freeFlowTravelTime: DOUBLE, confidence: DOUBLE, roadClosure: BOOLEAN, frc: STRING>"
)

FLOW_RECORD = (
    "code_point STRING, latitude DOUBLE, longitude DOUBLE, traffic_model_id STRING, "
    "vitesse_actuelle_kmph DOUBLE, vitesse_fluide_kmph DOUBLE, temps_trajet_actuel_s DOUBLE, "
    "temps_trajet_fluide_s DOUBLE, indice_confiance DOUBLE, route_fermee BOOLEAN, "
    "congestion_ratio DOUBLE, speed_ratio DOUBLE"
)

INCIDENTS_API = (
    "incidents ARRAY<STRUCT<geometry: STRUCT<type: STRING>, properties: STRUCT<"
    "id: STRING, iconCategory: INT, magnitudeOfDelay: DOUBLE, delay: DOUBLE, length: DOUBLE, "
    "startTime: STRING, endTime: STRING, numberOfReports: INT>>>"
)

INCIDENT_RECORD = (
    "incident_id STRING, categorie_incident INT, libelle_categorie STRING, gravite_retard DOUBLE, "
    "retard_s DOUBLE, longueur_m DOUBLE, traffic_model_id STRING"
)

DRINKING_WATER_FIELDS = (
    "nom_commune STRING, code_commune STRING, date_prelevement STRING, libelle_parametre STRING, "
    "resultat_numerique DOUBLE, libelle_unite STRING, conclusion_conformite_prelevement STRING"
)

RIVER_STATION_FIELDS = (
    "code_station STRING, libelle_station STRING, latitude DOUBLE, longitude DOUBLE, "
    "code_commune STRING, libelle_commune STRING"
)

RIVER_OBSERVATION_FIELDS = (
    "code_station STRING, date_prelevement STRING, heure_prelevement STRING, libelle_parametre STRING, "
    "resultat DOUBLE, symbole_unite STRING, code_remarque STRING"
)

RIVER_OBSERVATION_RECORD = (
    RIVER_OBSERVATION_FIELDS + ", donnees_brutes STRUCT<heure_prelevement: STRING>"
)

GROUNDWATER_FIELDS = (
    "bss_id STRING, code_bss STRING, date_mesure STRING, date_mesure_utc STRING, timestamp_mesure DOUBLE, "
    "groundwater_level_ngf_m DOUBLE, groundwater_depth_m DOUBLE"
)

# Numeric columns of fact_measures: fixed types of the warehouse.
MEASURE_TYPES = {
    "temperature": "DECIMAL(5,2)",
    "feels_like": "DECIMAL(5,2)",
    "pressure": "INT",
    "humidity": "INT",
    "wind_speed": "DECIMAL(5,2)",
    "wind_deg": "INT",
    "wind_gust": "DECIMAL(5,2)",
    "clouds": "INT",
    "visibility": "INT",
    "rain_1h": "DECIMAL(5,2)",
    "snow_1h": "DECIMAL(5,2)",
    "aqi_index": "INT",
    "pm25": "DECIMAL(7,2)",
    "pm10": "DECIMAL(7,2)",
    "no2": "DECIMAL(7,2)",
    "o3": "DECIMAL(7,2)",
    "so2": "DECIMAL(7,2)",
    "co": "DECIMAL(7,2)",
}

WEATHER_COLUMNS = (
    "temperature", "feels_like", "pressure", "humidity", "wind_speed", "wind_deg", "wind_gust",
    "clouds", "visibility", "rain_1h", "snow_1h", "weather_id",
)
AIR_COLUMNS = ("aqi_index", *POLLUTANTS)
