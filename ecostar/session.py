"""Session set-up and the shared working folder."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession


#: Bytes up to which the JVM compiles a method. Longer generated code, as of wide parsing steps, would be interpreted;
#: beyond the limit the step's expressions are generated as several methods.
METHOD_LIMIT = "8000"


def build_session(app: str = "ecostar", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.codegen.hugeMethodLimit": METHOD_LIMIT,
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """All instants of the warehouse are UTC, hour keys included; generated code is compiled, however wide a step is."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", METHOD_LIMIT)
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that ``spark.checkpoint.dir`` names.

    With the setting absent, it is a folder below the warehouse, which executors see too,
    unless that lies on the driver's disk and executors run elsewhere.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base is None:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        local = warehouse.startswith(("file:", "/")) or ":" not in warehouse.split("/")[0]
        if local and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = f"{warehouse.rstrip('/')}/_working"
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def folder_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


#: Calls to the file system that wait at the same time; a table may have a folder per day of many years.
FILE_CALLS = 16


def side_by_side(call, items) -> list:
    """``call`` of every item, a few at a time."""
    with ThreadPoolExecutor(FILE_CALLS) as pool:
        return list(pool.map(call, items))


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Paths of all files below a folder, relative to it, without those of marker or hidden names."""
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        return []

    def below(folder, prefix: str) -> tuple[list[str], list[tuple]]:
        found = [(s, s.getPath()) for s in fs.listStatus(folder)]
        files = [prefix + p.getName() for s, p in found if not s.isDirectory() and not p.getName().startswith(("_", "."))]
        return files, [(p, f"{prefix}{p.getName()}/") for s, p in found if s.isDirectory()]

    out, folders = below(target, "")
    while folders:
        levels = side_by_side(lambda f: below(*f), folders)
        out, folders = out + [f for files, _ in levels for f in files], [f for _, inner in levels for f in inner]
    return sorted(out)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    fs, target = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def move_file(spark: SparkSession, source: str, target: str) -> None:
    """Gives a file its final name; nothing happens where an earlier attempt has done so."""
    fs, old = _file_system(spark, source)
    new = spark._jvm.org.apache.hadoop.fs.Path(target)
    if fs.exists(old):
        fs.mkdirs(new.getParent())
        if not fs.rename(old, new):
            raise OSError(f"cannot move {source} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all."""
    fs, target = _file_system(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), "_" + target.getName() + ".draft")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(target, False)
    if not fs.rename(draft, target):
        raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _file_system(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.java.lang.String(stream.readAllBytes(), "UTF-8")
    finally:
        stream.close()


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.delete(target, True)
