"""Payload JSON to columns.

Only ``from_json`` with declared types is used: a wrong-typed value becomes NULL
and its siblings survive, so a numeric string never counts as a number.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ecostar import schemas


def payload_text(raw: Column) -> Column:
    """The payload object as text, also where it arrives as a JSON string inside JSON."""
    text = F.trim(raw)
    inner = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "ARRAY<STRING>")
    return F.when(text.startswith('"'), F.try_element_at(inner, F.lit(1))).otherwise(text)


def is_object(text: Column) -> Column:
    return F.coalesce(F.trim(text).startswith("{"), F.lit(False))


def is_readable(text: Column) -> Column:
    """Whether the text is one whole JSON object."""
    return F.coalesce(is_object(text) & F.json_object_keys(text).isNotNull(), F.lit(False))


def weather_struct(raw: Column) -> Column:
    return F.from_json(payload_text(raw), schemas.WEATHER_PAYLOAD, JSON)


# The 14 weather values of a parsed weather payload ``w``.
WEATHER_FIELDS = {
    "temperature": "w.main.temp",
    "feels_like": "w.main.feels_like",
    "pressure": "w.main.pressure",
    "humidity": "w.main.humidity",
    "wind_speed": "w.wind.speed",
    "wind_deg": "w.wind.deg",
    "wind_gust": "w.wind.gust",
    "clouds": "w.clouds.all",
    "visibility": "w.visibility",
    "rain_1h": "coalesce(w.rain.`1h`, 0D)",
    "snow_1h": "coalesce(w.snow.`1h`, 0D)",
    "weather_id": "try_element_at(w.weather, 1).id",
    "weather_main": "try_element_at(w.weather, 1).main",
    "weather_description": "try_element_at(w.weather, 1).description",
}

# The values of a parsed air payload ``a``; ``bare`` is its reading with bare numbers.
AIR_FIELDS = {
    "aqi_index": "try_cast(a.data.aqi AS INT)",
    **{p: f"coalesce(a.data.iaqi.{p}.v, bare.data.iaqi.{p})" for p in schemas.POLLUTANTS},
}


def fields(sources: dict[str, str]) -> list[str]:
    return [f"{sql} AS {name}" for name, sql in sources.items()]


#: A text such as "NaN" is no number.
JSON = {"allowNonNumericNumbers": "false"}

_BARE_POLLUTANT = r'"(' + "|".join(schemas.POLLUTANTS) + r')"\s*:\s*-?[0-9]'


def air_struct(raw: Column) -> Column:
    return F.from_json(payload_text(raw), schemas.AIR_PAYLOAD, JSON)


def bare_air_struct(raw: Column) -> Column:
    """Second reading for ``"pm25": 4.5``; skipped where no such text occurs."""
    text = payload_text(raw)
    return F.when(text.rlike(_BARE_POLLUTANT), F.from_json(text, schemas.AIR_PAYLOAD_BARE, JSON))


def air_attribution(raw: Column) -> Column:
    """First attribution's name, else the city's name, else the city text."""
    text = payload_text(raw)
    first = F.get_json_object(text, "$.data.attributions[0]")
    city = F.get_json_object(text, "$.data.city")
    return (
        F.when(first.startswith("{"), F.get_json_object(text, "$.data.attributions[0].name"))
        .when(city.startswith("{"), F.get_json_object(text, "$.data.city.name"))
        .otherwise(city)
    )


# Beyond 9999-12-31 no calendar date exists.
_MAX_EPOCH = 253402300799


def _epoch(text: Column) -> Column:
    seconds = text.try_cast("double")
    return F.when(F.abs(seconds) <= _MAX_EPOCH, F.timestamp_seconds(seconds))


def iso_instant(text: Column) -> Column:
    """ISO text to an instant; text without an offset is UTC, other text is NULL."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(text))


def weather_timestamp(raw: Column) -> Column:
    return _epoch(F.get_json_object(payload_text(raw), "$.dt"))


def air_timestamp(raw: Column) -> Column:
    """``iso``, else ``s`` with ``tz``, else ``s`` as UTC, else the epoch ``v``."""
    text = payload_text(raw)

    def part(name: str) -> Column:
        return F.get_json_object(text, f"$.data.time.{name}")

    tz = part("tz")
    signed = F.when(tz.rlike(r"^[+-]"), tz).when(F.length(tz) > 0, F.concat(F.lit("+"), tz))
    return F.coalesce(
        iso_instant(part("iso")),
        iso_instant(F.concat(part("s"), signed)),
        iso_instant(part("s")),
        _epoch(part("v")),
    )


def ratio(num: Column, den: Column) -> Column:
    """NULL where either side is NULL or 0."""
    return F.nullif(num, F.lit(0.0)) / F.nullif(den, F.lit(0.0))
