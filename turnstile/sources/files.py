"""Scans and sinks: delimited text, the datapoint config, and format dispatch."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnstile.defaults import HR_SCHEMA
from turnstile.sources.records import read_records


# Column of the lines that hold a bad cell (``read_csv(bad_cells="report")``).
BAD_RECORD = "_bad_record"


@dataclass(frozen=True)
class Config:
    """Datapoint config: declared source format plus the column lists."""
    data_source: str
    mandatory: tuple[str, ...]
    optional: tuple[str, ...] = field(default_factory=tuple)

    @property
    def columns(self) -> list[str]:
        return [*self.mandatory, *self.optional]


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             delimiter: str = ",", header: bool = True, infer_schema: bool = False,
             columns: list[str] | None = None, bad_cells: str = "error",
             multi_line: bool | str = False) -> DataFrame:
    """Delimited scan with a header row.

    Give ``schema`` to avoid the extra inference pass over the files (the
    default at scale); its columns are found by their names in the header, in
    whatever order the file has them, and a file whose header differs raises.
    ``infer_schema=True`` reproduces the reference's typing (a literal ``null``
    in a numeric column makes the whole column text).  ``columns`` projects
    directly on the scan so the reader prunes the rest.

    ``bad_cells``, for a cell that doesn't fit its type: ``error`` raises,
    ``null`` makes it null, ``report`` also keeps the line in ``_bad_record``.
    ``multi_line`` allows line ends inside quoted cells.  With a schema a file is
    read by many tasks (``records.py``); without one, or with ``'serial'``, by one
    task.  The reader strips a UTF-8 BOM and CRLF line ends.
    """
    serial = multi_line == "serial"
    if bad_cells not in ("error", "null", "report"):
        raise ValueError("bad_cells must be 'error', 'null' or 'report'")

    def reader():
        return (spark.read.format("csv").option("delimiter", delimiter)
                .option("header", header).option("encoding", "UTF-8")
                .option("escape", '"').option("multiLine", bool(multi_line))
                .option("mode", "FAILFAST" if bad_cells == "error" else "PERMISSIVE"))

    if schema is None:
        df = (reader().option("inferSchema", True) if infer_schema else reader()).load(path)
        return df if columns is None else df.select(*columns)
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    wanted = {f.name.lower(): f for f in schema.fields}
    fields = schema.fields
    if header:
        # Reads the first line only.
        names = reader().load(path).columns
        absent = [f.name for f in schema.fields if f.name.lower() not in {n.lower() for n in names}]
        if absent:
            raise ValueError(f"no column(s) {', '.join(absent)} in the header of {path}")
        fields = [T.StructField(n, wanted[n.lower()].dataType if n.lower() in wanted else T.StringType())
                  for n in names]
    scan = reader().option("enforceSchema", not header)
    if bad_cells == "report":
        fields = [*fields, T.StructField(BAD_RECORD, T.StringType())]
        scan = scan.option("columnNameOfCorruptRecord", BAD_RECORD)
    if multi_line and not serial:
        df = _parsed_records(read_records(spark, path, delimiter), fields, header, {
            "delimiter": delimiter, "escape": '"', "multiLine": "true", "columnNameOfCorruptRecord": BAD_RECORD,
            "mode": "FAILFAST" if bad_cells == "error" else "PERMISSIVE"})
    else:
        df = scan.schema(T.StructType(fields)).load(path)
    df = df.select(*[df[f"`{f.name}`"].alias(f.name) for f in schema.fields],
                   *([BAD_RECORD] if bad_cells == "report" else []))
    return df if columns is None else df.select(*columns)


def _parsed_records(records: DataFrame, fields: list[T.StructField], header: bool,
                    options: dict[str, str]) -> DataFrame:
    """The cells of records; the first of every file must be the header."""
    if header:
        names = [f.name for f in fields if f.name != BAD_RECORD]
        cells = F.from_csv("record", ", ".join(f"c{k} string" for k in range(len(names))), options)
        found = F.array(*[cells[f"c{k}"] for k in range(len(names))])
        same = F.transform(found, F.lower) == F.array(*[F.lit(n.lower()) for n in names])
        wrong = F.raise_error(F.concat(F.lit("another header in a file: "), "record")).cast("boolean")
        records = records.where(F.when(~F.col("_first"), True).when(same, False).otherwise(wrong))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return records.select(F.from_csv("record", schema, options).alias("_row")).select("_row.*")


def read_table(spark: SparkSession, path: str, fmt: str = "csv",
               schema: T.StructType | str | None = None, **options) -> DataFrame:
    """Source-format dispatch: csv / parquet / json / orc / anything Spark reads."""
    if fmt == "csv":
        return read_csv(spark, path, schema=schema,
                        infer_schema=options.pop("infer_schema", schema is None),
                        **options)
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_config(spark: SparkSession, path: str) -> Config:
    """Read the JSON datapoint config (one small document, metadata only).

    Keys ``config.list_of_datapoint.mandatory`` / ``.optional`` are required;
    a missing key raises.
    """
    row = (spark.read.option("multiLine", True).json(path)
           .select("config.*").first())
    if row is None:
        raise ValueError(f"empty config at {path}")
    cfg = row.asDict(recursive=True)
    lists = cfg["list_of_datapoint"]
    return Config(data_source=cfg.get("data_source") or "csv",
                  mandatory=tuple(lists["mandatory"]),
                  optional=tuple(lists["optional"]))


def read_configured(spark: SparkSession, path: str, config: Config,
                    schema: T.StructType | str | None = HR_SCHEMA) -> DataFrame:
    """Scan with the config's format and project its columns on the scan.

    The HR schema is the default, so a CSV source is read without an
    inference pass; pass ``schema=None`` to infer instead.
    """
    df = read_table(spark, path, fmt=config.data_source, schema=schema)
    return df.select(*config.columns)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Export with a header and no index (a folder of part files).  White
    space and quotes come back as they were; an empty text comes back as null.

    Returns its input, as the reference's export did.
    """
    (df.write.mode(mode).option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return df
