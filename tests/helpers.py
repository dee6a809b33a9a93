import datetime as dt
import json

from ecostar import schemas


def utc(*parts):
    return dt.datetime(*parts, tzinfo=dt.timezone.utc)


def naive(*parts):
    return dt.datetime(*parts)


def entry(id_, source, raw, at, city_id=1, city_name="Paris"):
    raw = raw if isinstance(raw, str) or raw is None else json.dumps(raw)
    return (id_, city_id, city_name, source, raw, at, False, None)


def lake(spark, entries):
    return spark.createDataFrame(entries, schemas.LAKE)


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]
