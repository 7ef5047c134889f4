"""Writers for cubes, reports and rule tables."""

from __future__ import annotations

import json
import re
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_cube(cube: DataFrame, path: str, year: str = "timePointYears", max_rows: int = 20_000_000) -> None:
    """Store a cube by year, replacing only the years that occur in it.

    Rows are rebalanced by year first: adaptive execution splits a large year over several tasks and
    merges small ones, so neither a hot year nor a file per task and year comes out.
    """
    (
        cube.hint("rebalance", year)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", max_rows)
        .partitionBy(year)
        .parquet(path)
    )


def write_report(report: DataFrame, path: str) -> None:
    """Store a report as CSV with a header, one file per task; a quote in a text is doubled."""
    report.select([F.col(f"`{c}`") for c in report.columns]).write.mode("overwrite").option("escape", '"').csv(path, header=True)


def append_rules(rows: DataFrame, path: str) -> None:
    """Insert rows into a stored rule table."""
    rows.write.mode("append").parquet(path)


PARTS = ("cube", "metadata")


def write_release(cube: DataFrame, metadata: DataFrame, path: str, year: str = "timePointYears") -> None:
    """Replace the years that occur in a cube or in its metadata, in both tables at once.

    Both are written to a folder of their own. A manifest, which says for each year where its rows are, comes last and
    under a new name; readers take the newest. So they see both tables before or after, also if the writing stops halfway.
    """
    publish_release(cube.sparkSession, path, write_version(cube, metadata, path, year), year)


def write_version(cube: DataFrame, metadata: DataFrame, path: str, year: str = "timePointYears") -> str:
    """Write both tables to a new version folder, which no reader sees yet, and name it."""
    version = uuid.uuid4().hex
    for part, df in zip(PARTS, (cube, metadata), strict=True):
        write_cube(df, f"{path}/versions/{version}/{part}", year)
    return version


def publish_release(spark: SparkSession, path: str, version: str, year: str = "timePointYears") -> None:
    """Let the manifest point to a version for all of its years. Of two writers at a time the second one fails."""
    number, manifest = _manifest(spark, path)
    years = {part: _years(spark, f"{path}/versions/{version}/{part}", year) for part in PARTS}
    told = {
        part: {y: v for y, v in manifest.get(part, {}).items() if y not in set().union(*years.values())} | dict.fromkeys(years[part], version)
        for part in PARTS
    }
    files, at = _files(spark, path)
    draft, final = at(f"{path}/{version}.draft"), at(f"{path}/manifest-{number + 1:010d}.json")
    stream = files.create(draft, False)
    stream.write(bytearray(json.dumps(told).encode()))
    stream.close()
    if files.exists(final) or not files.rename(draft, final):
        raise RuntimeError(f"another release of {path} was published meanwhile")


def read_release(spark: SparkSession, path: str, year: str = "timePointYears") -> tuple[DataFrame, DataFrame]:
    """Cube and metadata as of the newest manifest."""
    _, manifest = _manifest(spark, path)
    if not manifest:
        raise ValueError(f"no release in {path}")

    def read(part: str) -> DataFrame:
        versions: dict[str, list[str]] = {}
        for y, version in sorted(manifest[part].items()):
            versions.setdefault(f"{path}/versions/{version}/{part}", []).append(y)
        tables = [spark.read.option("basePath", base).parquet(*[f"{base}/{year}={y}" for y in years]) for base, years in versions.items()]
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
        return rows.withColumn(year, F.col(year).cast("int"))

    return read(PARTS[0]), read(PARTS[1])


def _files(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def _manifest(spark: SparkSession, path: str) -> tuple[int, dict[str, dict[str, str]]]:
    """Number and content of the newest manifest: {part: {year: version}}."""
    files, at = _files(spark, path)
    names = [f.getPath().getName() for f in files.listStatus(at(path))] if files.exists(at(path)) else []
    numbers = sorted(int(m[1]) for n in names if (m := re.fullmatch(r"manifest-(\d+)\.json", n)))
    if not numbers:
        return 0, {}
    text = spark.read.text(f"{path}/manifest-{numbers[-1]:010d}.json", wholetext=True).first()[0]
    return numbers[-1], json.loads(text)


def _years(spark: SparkSession, folder: str, year: str) -> list[str]:
    files, at = _files(spark, folder)
    names = [f.getPath().getName() for f in files.listStatus(at(folder))]
    return [n.removeprefix(f"{year}=") for n in names if n.startswith(f"{year}=")]
