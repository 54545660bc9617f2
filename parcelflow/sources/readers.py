"""Scans. Every scan has a declared schema and yields plain columns."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from parcelflow.functions.logs import parse_log_line
from parcelflow.functions.text import as_col, strip
from parcelflow.schemas import POSTAL, PROVIDER_RAW, WORK_LIST

URL_EXPORT = "Total_URLs.csv"


def scan_csv_dir(spark: SparkSession, path: str, schema: T.StructType, exclude: str = URL_EXPORT) -> DataFrame:
    """All CSV files under a folder except those named ``exclude``, be it a file or a folder of parts."""
    named = r"(^|/)" + exclude.replace(".", r"\.") + "(/|$)"
    return (
        spark.read.schema(schema)
        .options(header=True, recursiveFileLookup=True, pathGlobFilter="*.csv", escape='"')
        .csv(path)
        .filter(~F.col("_metadata.file_path").rlike(named))
    )


def scan_work_list(spark: SparkSession, path: str) -> DataFrame:
    """Location, array of ZIPs, done flag and line number of a work list."""
    raw = spark.read.schema(WORK_LIST).options(header=True, escape='"').csv(path)
    return raw.select(
        F.monotonically_increasing_id().alias("line_no"),
        F.col("Location").alias("location"),
        split_list("ZipCodes").alias("zip_codes"),
        (F.lower(strip(F.coalesce("Completed", F.lit("")))) == "yes").alias("completed"),
    )


def split_list(c: Column | str) -> Column:
    """A comma list as an array of trimmed, non-empty parts."""
    return F.filter(F.transform(F.split(as_col(c), ","), strip), lambda x: x != "")


def scan_comma_list(spark: SparkSession, path: str, out: str = "zip_code") -> DataFrame:
    return spark.read.text(path).select(F.explode(split_list("value")).alias(out))


def kv_entries(record: Column | str) -> Column:
    """The 'key: value' lines of a record as an array of (key, value), in line order.

    A line is cut at its first ': '; lines without one are left out (see ``kv_bad_lines``).
    """
    good = F.filter(_kv_lines(record), lambda line: line.contains(": "))
    return F.transform(
        good,
        lambda line: F.struct(
            F.substring_index(line, ": ", 1).alias("key"),
            F.substring(line, F.locate(": ", line) + 2, F.length(line)).alias("value"),
        ),
    )


def kv_bad_lines(record: Column | str) -> Column:
    return F.size(F.filter(_kv_lines(record), lambda line: ~line.contains(": "))).cast("bigint")


def _kv_lines(record: Column | str) -> Column:
    lines = F.transform(F.split(as_col(record), "\r?\n"), strip)
    return F.filter(lines, lambda line: line != "")


def kv_value(entries: Column | str, key: str) -> Column:
    """The last value given for ``key``; null when the record lacks it."""
    found = F.filter(as_col(entries), lambda e: e["key"] == key)
    return F.try_element_at(found, F.lit(-1))["value"]


def scan_kv_records(spark: SparkSession, path: str, fields: list[str], separator: str | None = None) -> DataFrame:
    """One row per record, with its fields and the number of malformed lines.

    Without ``separator`` a record is a file of its own; with it, large files hold many records.
    """
    records = spark.read.text(path, wholetext=separator is None, lineSep=separator)
    kept = records.filter(strip("value") != "").select(
        kv_entries("value").alias("_e"), kv_bad_lines("value").alias("bad_lines")
    )
    return kept.select(*[kv_value("_e", f).alias(f) for f in fields], "bad_lines")


def scan_documents_json(
    spark: SparkSession, path: str, record: T.StructType, whole_file: bool = False, bad: str | None = None
) -> DataFrame:
    """Nested agent documents as flat rows (agent, label, record fields).

    Each line is an object {agent: {label: record}} of one or more agents; ``whole_file``
    reads a pretty-printed document. A missing path gives no rows. With ``bad`` each broken line is a row of
    nulls that holds its text in the column of that name; else broken lines are left out.
    """
    flat = T.StructType([T.StructField("agent", T.StringType()), T.StructField("label", T.StringType()), *record.fields])
    try:
        text = spark.read.text(path, wholetext=whole_file)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], flat if bad is None else flat.add(bad, T.StringType()))
    kind = T.MapType(T.StringType(), T.MapType(T.StringType(), record))
    parsed = text.select("value", F.from_json("value", kind).alias("_d"))
    rows = (
        parsed.select(F.explode("_d").alias("agent", "_m"))
        .select("agent", F.explode("_m").alias("label", "_r"))
        .select("agent", "label", "_r.*")
    )
    if bad is None:
        return rows
    broken = parsed.filter(F.col("_d").isNull() & (strip("value") != "")).select(F.col("value").alias(bad))
    return rows.unionByName(broken, allowMissingColumns=True)


def scan_provider_csv(spark: SparkSession, path: str, schema: T.StructType = PROVIDER_RAW, bad: str | None = None, header: bool = True) -> DataFrame:
    """Provider files with a trimmed county per row.

    With ``bad`` malformed lines stay as rows that hold their text in the column of that name; else they are left out.
    ``load_seq`` orders rows by file time, file name and position for the last-wins rule.
    """
    broken = bad or "_corrupt_record"
    with_bad = T.StructType([*schema.fields, T.StructField(broken, T.StringType())])
    raw = (
        spark.read.schema(with_bad)
        .options(header=header, columnPruning=False, mode="PERMISSIVE", columnNameOfCorruptRecord=broken, escape='"', pathGlobFilter="*.csv")
        .csv(path)
    )
    kept = raw.filter(F.col(broken).isNull()) if bad is None else raw
    return kept.select(
        *[(strip("County") if f.name == "County" else F.col(f"`{f.name}`")).alias(f.name) for f in schema.fields],
        F.struct(
            F.col("_metadata.file_modification_time").alias("at"),
            F.col("_metadata.file_path").alias("file"),
            F.monotonically_increasing_id().alias("pos"),
        ).alias("load_seq"),
        *([] if bad is None else [bad]),
    )


def scan_postal_reference(spark: SparkSession, path: str) -> DataFrame:
    """The postal table; ZIPs are text and keep leading zeros."""
    return spark.read.schema(POSTAL).parquet(path)


def scan_lexicon(spark: SparkSession, path: str, section: str = "keywords") -> DataFrame:
    """(priority, keyword, synonym_pos, synonym) of a JSON configuration, positions from 0."""
    kind = T.StructType([T.StructField(section, T.MapType(T.StringType(), T.ArrayType(T.StringType())))])
    return (
        spark.read.text(path, wholetext=True)
        .select(F.posexplode(F.from_json("value", kind)[section]).alias("priority", "keyword", "_s"))
        .select("priority", "keyword", F.posexplode("_s").alias("synonym_pos", "synonym"))
    )


def scan_variants(lines: DataFrame, known: dict[str, str], line: str = "value", bad: str | None = None) -> DataFrame:
    """JSON objects of any shape: typed columns for the ``known`` fields, and all others as they are in a VARIANT column ``rest``.

    ``known`` maps a field to its type. A field of another type than stated is null in its column and stays in ``rest``, so none is lost; with
    ``rest_joined`` the object comes back. A line that is no object is left out, or with ``bad`` told in the column of that name.
    """
    parsed = lines.select(F.col(line).alias("_line"), F.try_parse_json(F.col(line)).alias("_v"))
    whole = F.when(F.schema_of_variant("_v").startswith("OBJECT"), F.col("_v"))
    fields = F.from_json(F.to_json(whole), "map<string, variant>")
    typed = {name: F.try_variant_get(whole, f"$['{name}']", kind) for name, kind in known.items()}
    lost = F.map_filter(fields, lambda k, _: ~F.coalesce(F.element_at(F.create_map(*[x for n, v in typed.items() for x in (F.lit(n), v.isNotNull())]), k), F.lit(False)))
    out = parsed.select(*[v.alias(n) for n, v in typed.items()], F.parse_json(F.to_json(lost)).alias("rest"), F.when(whole.isNull(), F.col("_line")).alias("_bad"))
    return out.filter("_bad IS NULL").drop("_bad") if bad is None else out.withColumnRenamed("_bad", bad)


def rest_joined(known: list[str], rest: str = "rest") -> Column:
    """The JSON object of a row of ``scan_variants`` again: known fields that are not null, then the rest."""
    own, others = F.to_json(F.struct(*known)), F.to_json(rest)
    both = F.concat(F.substring(own, F.lit(1), F.length(own) - 1), F.lit(","), F.substring(others, F.lit(2), F.length(others)))
    return F.when(own == "{}", others).when(others == "{}", own).otherwise(both)


def scan_url_state(spark: SparkSession, path: str, location: str | None = None, state: str | None = None) -> DataFrame:
    """The URL state table; both filters reach the Parquet scan."""
    df = spark.read.parquet(path)
    if location is not None:
        df = df.filter(F.col("location") == location)
    if state is not None:
        df = df.filter(F.col("state") == state)
    return df


def scan_log_lines(spark: SparkSession, path: str, bad: str | None = None) -> DataFrame:
    """(ts, level, message) of log files.

    With ``bad`` lines of another form are rows that hold their text in the column of that name; else they are left out.
    """
    lines = spark.read.text(path).select(parse_log_line("value").alias("_l"), "value")
    if bad is None:
        return lines.filter("_l IS NOT NULL").select("_l.*")
    return lines.select("_l.*", F.when(F.col("_l").isNull(), F.col("value")).alias(bad))
