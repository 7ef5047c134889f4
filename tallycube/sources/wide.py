"""Wide yearly tables: one row per area, one column per year."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallycube.schema import ELEMENT_OF_ROLE, FIRST_YEAR, POPULATION, Dims
from tallycube.sources.tables import literal_table

# Header, file and section name patterns. The order of the roles matters, since
# "female" also contains "male"; the first match wins.
ROLE_PATTERNS = {
    "total": "oth|OTH",
    "female": "emale|EMALE",
    "male": "male|MALE",
    "urban": "rban|RBAN",
    "rural": "ural|URAL",
}
SECTION_PATTERNS = {
    "estimates": "ESTIM|estim|Estimat|ata",
    "medium": "EDIUM|edium",
}
VARIANT_PATTERN = "ariant|ARIANT"
AREA_PATTERNS = ("ountr", "ode")


def read_wide(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str | None = None, start_row: int = 1
) -> DataFrame:
    """CSV table with a header, UTF-8, all text unless a schema is given.

    `start_row` is the line of the header, for published tables that begin with notes: the lines before it are left out
    of each file. The lines of such a file are put in order by one task, as a record's begin is known from the start of its
    file only; a quoted line break stays in its record.

    Nothing is inferred: inference would scan the file and turn the code 011.01 into a number. Files
    read together must have the same header; another one is an error.
    """
    if start_row > 1:
        return _below_preamble(spark, path, start_row, schema)
    reader = spark.read.option("header", True).option("encoding", "UTF-8").option("enforceSchema", False).option("escape", '"')
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def _below_preamble(spark: SparkSession, path: str | Sequence[str], start_row: int, schema: T.StructType | str | None) -> DataFrame:
    """Rows below the header in line `start_row`; all columns are text unless a schema gives their types.

    Lines are numbered within their file, and a line belongs to the record before it where an odd number of quotes stands
    between the header and its start. A file is sorted by one task, which may spill, but its records are rows of their own.
    """
    lines = spark.read.text(path)
    headers = {tuple(csv_fields(line_of(spark, f, start_row))) for f in lines.inputFiles()}
    if len(headers) != 1:
        raise ValueError(f"expected one header in line {start_row} of all files, found {sorted(headers)}")
    names = headers.pop()
    at = ("_file", "_block", "_at")
    placed = lines.select("value", *[F.col(f"_metadata.{c}").alias(n) for c, n in (("file_path", "_file"), ("file_block_start", "_block"))])
    placed = placed.withColumn("_at", F.monotonically_increasing_id())
    by = Window.partitionBy("_file").orderBy(*at[1:])
    body = placed.withColumn("_line", F.row_number().over(by)).filter(F.col("_line") > start_row)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    open_ = F.coalesce(F.sum(quotes).over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    begun = body.withColumn("_begins", (open_ == 0).cast("int")).withColumn("_record", F.sum("_begins").over(by))
    records = begun.groupBy("_file", "_record").agg(F.array_sort(F.collect_list(F.struct("_line", "value"))).alias("l"))
    text = records.select(F.array_join(F.transform("l", lambda x: x["value"]), "\n").alias("line")).filter("line <> ''")
    table = text.select(F.from_csv("line", ", ".join(f"`{n}` string" for n in names), {"multiLine": "true", "escape": '"'}).alias("r")).select("r.*")
    if schema is None:
        return table
    kinds = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    return table.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in kinds])


def line_of(spark: SparkSession, path: str, number: int = 1) -> str:
    """One of the first lines of a file, by its (encoded) address; no more of the file is read."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    file = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path))
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(file.getFileSystem(conf).open(file), "UTF-8"))
    try:
        lines = [reader.readLine() for _ in range(number)]
    finally:
        reader.close()
    return (lines[-1] or "").removeprefix("\ufeff")


def csv_fields(line: str) -> list[str]:
    return next(csv.reader([line]), [])


def read_typed(spark: SparkSession, path: str | Sequence[str], columns: dict[str, str]) -> DataFrame:
    """CSV table whose columns are matched by name and typed, e.g. `{"Year": "int"}`.

    The file stays text during the scan and each column is cast on its own, so a column order that
    differs from `columns` is harmless and a bad cell is null instead of a failed job.
    """
    raw = read_wide(spark, path)
    return raw.select([F.col(f"`{name}`").try_cast(kind).alias(name) for name, kind in columns.items()])


def role_of(name: str) -> str | None:
    """Role of one file or folder name."""
    return next((role for role, pattern in ROLE_PATTERNS.items() if re.search(pattern, name)), None)


def section_of(name: str) -> str | None:
    """Section (estimates or medium projection) a table name stands for.

    The projection is tested first: "ata" is loose enough to match many names.
    """
    if re.search(SECTION_PATTERNS["medium"], name):
        return "medium"
    return "estimates" if re.search(SECTION_PATTERNS["estimates"], name) else None


def role_from_path(path: str | Column) -> Column:
    """Same rule as `role_of`, for a column such as `_metadata.file_name`."""
    column = F.col(path) if isinstance(path, str) else path
    return reduce(
        lambda chain, role: chain.when(column.rlike(ROLE_PATTERNS[role]), F.lit(role)),
        list(ROLE_PATTERNS)[1:],
        F.when(column.rlike(ROLE_PATTERNS["total"]), F.lit("total")),
    )


def files_by_role(spark: SparkSession, folder: str) -> dict[str, dict[str, list[str]]]:
    """File paths below `folder` as `{role: {section: paths}}`; listing only, no data is read."""
    found: dict[str, dict[str, list[str]]] = {}
    paths = spark.read.option("recursiveFileLookup", True).text(folder).inputFiles()
    base = folder.rstrip("/").rsplit("/", 1)[-1]
    for path in sorted(unquote(p) for p in paths):
        name = path.rsplit(f"/{base}/", 1)[-1]
        role = role_of(name)
        if role:
            section = "medium" if section_of(name) == "medium" else "estimates"
            found.setdefault(role, {}).setdefault(section, []).append(path)
    return found


def discover_columns(columns: Sequence[str], first_year: int = FIRST_YEAR) -> tuple[str | None, str, list[str]]:
    """Variant column (if any), area column and year columns of a wide table.

    Years run from `first_year` to the last header; an absent year in between is an error.
    """
    variant = next((c for c in columns if re.search(VARIANT_PATTERN, c)), None)
    areas = [c for c in columns if all(re.search(p, c) for p in AREA_PATTERNS)]
    if len(areas) != 1:
        raise ValueError(f"expected one area code column, found {areas}")
    if not re.fullmatch(r"\d{4}", columns[-1]):
        raise ValueError(f"the last column should be a year, not {columns[-1]!r}")
    years = [str(y) for y in range(first_year, int(columns[-1]) + 1)]
    absent = [y for y in years if y not in columns]
    if absent:
        raise ValueError(f"year columns are missing: {absent}")
    return variant, areas[0], years


def read_folder(
    spark: SparkSession, folder: str, common_year: int, first_year: int = FIRST_YEAR, dims: Dims = POPULATION
) -> DataFrame:
    """All wide tables below a folder in one scan: Variant, area, year, value, element, section.

    Role and section come from the file's name, its columns from its own header, so files may differ in both. Only the
    headers are read here, one line of each file; they meet the rows of their file as a small table. Values are text.
    """
    found = spark.read.option("recursiveFileLookup", True).text(folder).inputFiles()
    base = unquote(folder.rstrip("/").rsplit("/", 1)[-1])
    files, width = [], 1
    for path in sorted(found):
        name = unquote(path).rsplit(f"/{base}/", 1)[-1]
        role = role_of(name)
        header = csv_fields(line_of(spark, path)) if role else []
        if not header:
            continue
        section = "medium" if section_of(name) == "medium" else "estimates"
        variant, area, years = discover_columns(header, first_year if section == "estimates" else common_year)
        width = max(width, len(header))
        at = [header.index(y) for y in years]
        # As `_metadata` writes it: a local address with one slash.
        files.append((re.sub("^file:/+", "file:/", path), ELEMENT_OF_ROLE[role], section, area, header.index(area), header.index(variant) if variant else None, at, list(map(int, years))))
    if not files:
        raise ValueError(f"no table of a known role below {folder}")
    known = literal_table(
        spark, files, f"_file string, {dims.element} string, section string, _name string, _area int, _variant int, _at array<int>, _year array<int>"
    )
    cells = [f"c{k}" for k in range(width)]
    scan = spark.read.schema(", ".join(f"{c} string" for c in cells)).option("encoding", "UTF-8").option("escape", '"').csv([unquote(f[0]) for f in files])
    rows = scan.select(F.col("_metadata.file_path").alias("_file"), F.array(*cells).alias("_cells")).join(known, "_file")
    area = F.regexp_replace(F.get("_cells", F.col("_area")), "^\ufeff", "")
    one = rows.withColumn("_code", area).filter(F.col("_code") != F.col("_name")).withColumn("_y", F.explode(F.arrays_zip("_at", "_year")))
    return one.select(
        F.get("_cells", F.col("_variant")).alias("Variant"),
        F.col("_code").alias(dims.area),
        F.col("_y._year").alias(dims.year),
        F.get("_cells", F.col("_y._at")).alias(dims.value),
        dims.element,
        "section",
    )
