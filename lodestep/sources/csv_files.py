"""CSV readers: folders of postings with differing headers, and dictionary files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestep.functions import fixed_values as fixed
from lodestep.functions.text import text_or_blank, to_number

_SURPLUS = "_surplus"
_ROW_BITS = 33


def csv_names(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the CSV files of a folder in name order; no content is read."""
    paths = (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
             .select("path").orderBy("path").collect())
    if not paths:
        raise FileNotFoundError(f"no CSV files in {folder}")
    return [row["path"] for row in paths]


def file_name() -> Column:
    """The name of a row's file as the folder shows it; Spark gives it escaped, and leaves ``+`` as it is."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def read_csv(spark: SparkSession, paths: list[str], header: list[str]) -> DataFrame:
    """Text columns of files that share a header, with ``source``, the file name, and ``row_no``.

    ``row_no`` rises inside a file: multi-line files are never split, so the low bits of the running id
    count on from row to row. Rows with more cells than the header are dropped, shorter ones padded with nulls. Cells that
    stand for a missing value become null.
    """
    schema = ", ".join(f"`{name}` string" for name in [*header, _SURPLUS])
    rows = (
        spark.read.schema(schema)
        .option("header", True).option("multiLine", True).option("escape", '"').option("encoding", "UTF-8")
        .option("mode", "PERMISSIVE").option("enforceSchema", True)
        .csv(paths)
    )
    cells = [F.when(~F.col(f"`{name}`").isin(fixed.MISSING_CELLS), F.col(f"`{name}`")).alias(name) for name in header]
    row_no = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return rows.select(*cells, _SURPLUS, file_name().alias("source"), row_no.alias("row_no")).filter(
        F.col(_SURPLUS).isNull()).drop(_SURPLUS)


def header_of(spark: SparkSession, path: str) -> list[str]:
    return spark.read.option("header", True).option("escape", '"').csv(path).columns


def harmonised(raw: DataFrame, candidates: dict[str, list[str]], keep: tuple[str, ...] = ()) -> DataFrame:
    """Each canonical column from the first of its candidates that ``raw`` has, else null."""
    def pick(name: str, sources: list[str]) -> Column:
        found = next((source for source in sources if source in raw.columns), None)
        return (F.col(f"`{found}`") if found else F.lit(None)).cast("string").alias(name)

    return raw.select(*[pick(name, sources) for name, sources in candidates.items()], *keep)


def blank_texts(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.withColumns({name: text_or_blank(F.col(name)) for name in columns})


def harmonised_files(spark: SparkSession, folder: str, candidates: dict[str, list[str]]) -> DataFrame:
    """All CSV files of a folder under one schema plus ``source`` and ``row_no``.

    Files are grouped by header, so the plan grows with the number of layouts, not of files.
    """
    layouts: dict[tuple[str, ...], list[str]] = {}
    for path in csv_names(spark, folder):
        layouts.setdefault(tuple(header_of(spark, path)), []).append(path)
    parts = [harmonised(read_csv(spark, paths, list(header)), candidates, ("source", "row_no"))
             for header, paths in layouts.items()]
    return reduce(DataFrame.unionByName, parts)


def read_postings(spark: SparkSession, folder: str,
                  candidates: dict[str, list[str]] = fixed.POSTING_COLUMNS) -> DataFrame:
    """Raw postings: text columns never null, ``exp_min`` a number or null, and ``posting``.

    ``posting`` is unique and rises with file name and row, the order that decides which of several
    copies is the first.
    """
    rows = harmonised_files(spark, folder, candidates)
    texts = [name for name in candidates if name != "exp_min"]
    files = [(path.rsplit("/", 1)[-1], place) for place, path in enumerate(csv_names(spark, folder))]
    places = spark.createDataFrame(files, "source string, _place long")
    unknown = F.raise_error(F.concat(F.lit("a file that was not listed: "), F.col("source"))).cast("long")
    posting = F.shiftleft(F.coalesce("_place", unknown), _ROW_BITS) + F.col("row_no")
    typed = rows.join(places, "source", "left").withColumns({"exp_min": to_number(F.col("exp_min")), "posting": posting})
    return blank_texts(typed.drop("_place", "row_no"), texts)


def read_survey(spark: SparkSession, folder: str, candidates: dict[str, list[str]],
                year_pattern: str = r"(\d{4})") -> DataFrame:
    """Yearly survey files under one schema plus ``year``, taken from the file name.

    ``candidates`` lists the names a column had over the years, e.g. for ``country`` and ``technologies``.
    """
    year = F.regexp_extract("source", year_pattern, 1).cast("int")
    return harmonised_files(spark, folder, candidates).withColumn("year", year).drop("row_no", "source")


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """``skill_idx, uri, label, alt_labels`` of a dictionary file, rows without label dropped.

    ``skill_idx`` rises with the row; without a uri column the label stands in.
    """
    raw = read_csv(spark, [path], header_of(spark, path))
    names = set(raw.columns)
    label = F.col("preferredLabel")
    uri = F.col("conceptUri") if "conceptUri" in names else label
    alternatives = F.col("altLabels") if "altLabels" in names else F.lit(None).cast("string")
    return raw.filter(label.isNotNull()).select(
        F.col("row_no").alias("skill_idx"), uri.alias("uri"), label.alias("label"), alternatives.alias("alt_labels"))


def read_subset(spark: SparkSession, path: str) -> DataFrame:
    """``uri`` of a subset list."""
    return read_csv(spark, [path], header_of(spark, path)).select(F.col("conceptUri").alias("uri")).distinct()
