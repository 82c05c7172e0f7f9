"""Dated input batches as lazy DataFrames: SQL over the catalog, JDBC, and files.

Every reader is ``(spark, spec, run_date) -> DataFrame``. Filters and column
choices made on the result reach the scan.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType

from batchgauge.config import SourceSpec
from batchgauge.functions.columns import col

Reader = Callable[[SparkSession, SourceSpec, str], DataFrame]

# The file suffixes read, with their separator.
SEPARATORS = {".csv": ",", ".tsv": "\t"}
_QUOTED_OR_DATE = re.compile(r"""'(?:[^'\\]|\\.|'')*'|"(?:[^"\\]|\\.|"")*"|`[^`]*`|\{run_date\}""")


def iso_date(run_date: str | date) -> str:
    """The date as YYYY-MM-DD; anything else raises, so it is safe inside a path or query."""
    return run_date.isoformat() if isinstance(run_date, date) else date.fromisoformat(run_date).isoformat()


def fill_run_date(template: str, run_date: str | date) -> str:
    """Put the date into ``{run_date}``; other braces stay as they are."""
    return template.replace("{run_date}", iso_date(run_date))


def read_sql(spark: SparkSession, spec: SourceSpec, run_date: str) -> DataFrame:
    """Run the query over the session's tables and views, with the date as a parameter."""
    if not spec.query.strip():
        raise ValueError("a sql source without a query reads nothing")
    day = iso_date(run_date)

    def put(m: re.Match) -> str:
        # alone it is a parameter; inside a longer literal or name it is the date's text, which iso_date has checked
        return ":run_date" if m[0] in ("{run_date}", "'{run_date}'") else fill_run_date(m[0], day)

    text = _QUOTED_OR_DATE.sub(put, spec.query)
    return spark.sql(text, args={"run_date": date.fromisoformat(day)} if ":run_date" in text else None)


def jdbc_options(spec: SourceSpec, run_date: str) -> dict[str, str]:
    """Reader options for an external database; the query runs there.

    With ``partitionColumn``, ``lowerBound``, ``upperBound`` and ``numPartitions`` in the
    connection the read is split over executors by these; with the column alone ``read_jdbc`` asks for the bounds first.
    """
    if not spec.query.strip():
        raise ValueError("a jdbc source without a query reads nothing")
    text = fill_run_date(spec.query, run_date).strip().rstrip(";")
    given = dict(spec.connection)
    if "url" not in given:
        host, port = given.pop("host", "localhost"), given.pop("port", 3306)
        given["url"] = f"jdbc:mysql://{host}:{port}/{given.pop('database', '')}"
    options = {k: str(v) for k, v in given.items()}
    if "partitionColumn" in options:
        return {**options, "dbtable": f"({text}) batch"}
    return {**options, "query": text}


#: Rows that one task reads from a database, unless ``numPartitions`` says otherwise.
JDBC_ROWS = 1_000_000


def bounds_options(options: dict[str, str]) -> dict[str, str]:
    """Options of a query that asks the database for the least and greatest value of the split column, and the rows."""
    column = options["partitionColumn"]
    kept = {k: v for k, v in options.items() if k not in ("partitionColumn", "numPartitions", "dbtable")}
    return {**kept, "query": f"SELECT MIN({column}) AS low, MAX({column}) AS high, COUNT(*) AS n FROM {options['dbtable']}"}


def range_predicates(column: str, low, high, n: int, parts: int | None = None) -> list[str]:
    """Conditions that cut a batch by a column into about even ranges: each row meets exactly one.

    Numbers, dates and timestamps are cut evenly between their ends; NULLs are in the first range. A column without values, or
    with one, is one range, as is one of a type that cannot be cut (text).
    """
    parts = parts or max(1, -(-n // JDBC_ROWS))
    if low is None or high is None or low == high or parts == 1 or isinstance(low, (str, bytes)):
        return ["1 = 1"]
    whole = isinstance(low, int) or type(low) is date
    parts = min(parts, int((high - low).days if type(low) is date else high - low) + 1) if whole else parts
    cuts = []
    for i in range(1, parts):
        if type(low) is date:
            cut = low + timedelta(days=(high - low).days * i // parts)
        elif isinstance(low, int):
            cut = low + (high - low) * i // parts
        else:
            cut = low + (high - low) * i / parts
        if cut > low and (not cuts or cut > cuts[-1]):
            cuts.append(cut)
    shown = [f"'{c}'" if isinstance(c, (date, datetime)) else str(c) for c in cuts]
    if not shown:
        return ["1 = 1"]
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(shown, shown[1:])]
    return [f"{column} < {shown[0]} OR {column} IS NULL", *middle, f"{column} >= {shown[-1]}"]


def read_jdbc(spark: SparkSession, spec: SourceSpec, run_date: str) -> DataFrame:
    """The batch of a database. A ``partitionColumn`` without bounds is asked for them, and the ranges are planned from the answer."""
    options = jdbc_options(spec, run_date)
    if "partitionColumn" not in options or "lowerBound" in options:
        return spark.read.format("jdbc").options(**options).load()
    low, high, n = spark.read.format("jdbc").options(**bounds_options(options)).load().first()
    parts = int(options["numPartitions"]) if "numPartitions" in options else None
    rest = {k: v for k, v in options.items() if k not in ("partitionColumn", "numPartitions", "dbtable", "url")}
    where = range_predicates(options["partitionColumn"], low, high, int(n), parts)
    return spark.read.jdbc(options["url"], options["dbtable"], predicates=where, properties=rest)


def read_separated(spark: SparkSession, paths: Sequence[str], separator: str = ",", schema: str | None = None) -> DataFrame:
    """CSV or TSV files with a header: cells may be quoted and hold separators, doubled quotes and line breaks.

    An empty cell is NULL, quoted or not. Files are split between tasks unless a cell goes on over a line break: a line
    with an odd number of quotes shows that, and is looked for first.
    """
    quotes = F.length("value") - F.length(F.translate("value", '"', ""))
    over_lines = not spark.read.text(list(paths)).filter(quotes % 2 == 1).isEmpty()
    reader = spark.read if schema is None else spark.read.schema(schema)
    rows = reader.csv(
        list(paths), sep=separator, header=True, inferSchema=schema is None, quote='"', escape='"', multiLine=over_lines,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
    text = [f.name for f in rows.schema if isinstance(f.dataType, StringType)]
    return rows.withColumns({n: F.nullif(col(n), F.lit("")) for n in text}) if text else rows


def read_paths(spark: SparkSession, paths: Iterable[str], schema: str | None = None) -> DataFrame:
    """Parquet, CSV or TSV files, by the suffix that all the paths share."""
    paths = list(paths)
    suffixes = {"." + p.rstrip("/").rsplit(".", 1)[-1] if "." in p.rsplit("/", 1)[-1] else "" for p in paths}
    suffix = suffixes.pop() if len(suffixes) == 1 else str(sorted(suffixes))
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        if suffix == ".parquet":
            return reader.parquet(*paths)
        if suffix in SEPARATORS:
            return read_separated(spark, paths, SEPARATORS[suffix], schema)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no such path: {', '.join(paths)}") from e
        raise
    raise ValueError(f"files end in .csv, .tsv or .parquet here, not in '{suffix}'")


def _path_template(spec: SourceSpec) -> str:
    template = spec.connection.get("path") or spec.query
    if not template:
        raise ValueError("name the file in connection.path or in the query")
    return template


def read_file(spark: SparkSession, spec: SourceSpec, run_date: str) -> DataFrame:
    path = fill_run_date(_path_template(spec), run_date)
    return read_paths(spark, [path], spec.connection.get("schema"))


def read_object(spark: SparkSession, spec: SourceSpec, run_date: str) -> DataFrame:
    """Files in an object store: the bucket and key template make an s3a path."""
    if not (spec.bucket and spec.key_template):
        raise ValueError("an object is named by bucket and key_template together")
    path = f"s3a://{spec.bucket}/{fill_run_date(spec.key_template, run_date).lstrip('/')}"
    return read_paths(spark, [path], spec.connection.get("schema"))


READERS: dict[str, Reader] = {
    "sql": read_sql,
    "mysql": read_jdbc,
    "jdbc": read_jdbc,
    "file": read_file,
    "s3": read_object,
}


def is_templated(spec: SourceSpec) -> bool:
    """True when another date means other files or another query."""
    return any("{run_date}" in t for t in (spec.query, spec.key_template, str(spec.connection.get("path", ""))))


def fetch(spark: SparkSession, spec: SourceSpec, run_date: str | date) -> DataFrame:
    """The batch of one date, by the reader registered for ``spec.source``."""
    reader = READERS.get(spec.source.lower())
    if reader is None:
        raise ValueError(f"no reader for '{spec.source.lower()}', only for {sorted(READERS)}")
    return reader(spark, spec, iso_date(run_date))
