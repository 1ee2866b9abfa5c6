"""Data quality: rules on records, checks of stored tables, reports."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import fixed, text
from ..functions.numbers import to_number

ISSUES = "_issues"
SHOWN_DETAILS = 50


def _filled(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit("")) != ""


# Lowest and highest value allowed; None is no bound.
RANGES = {"size_cm": (0, 200), "weight_kg": (0, 100), "count": (1, None),
          "spot_lat": (-90, 90), "spot_lng": (-180, 180), "water_temp": (0, 40)}


def with_issues(records: DataFrame, as_of: Column,
                required: Sequence[str] = tuple(fixed.REQUIRED_COLUMNS)) -> DataFrame:
    """Records of texts with their issues joined by a bar; empty for good records.

    ``as_of`` is the last allowed day. Numbers that cannot be read pass.
    """
    missing = F.array_join(F.array_compact(F.array(
        *[F.when(~_filled(name), name) for name in required])), ",")
    # Months, days, hours and minutes may have one digit.
    day = F.when(F.col("date").rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.col("date").try_cast("date"))
    facts = {"_missing": missing, "_day": day,
             **{f"_n_{name}": to_number(F.col(name)) for name in RANGES}}

    def said(problem: str, column: str) -> Column:
        return F.concat(F.lit(f"{problem}:"), F.col(column))

    def outside(column: str, low: float, high: float | None) -> Column:
        number = F.col(f"_n_{column}")
        bad = number < low
        if high is not None:
            # NaN compares as larger than anything here, but is no violation.
            bad = bad | ((number > high) & ~F.isnan(number))
        return F.when(bad, said(f"{column}_range", column))

    clock = F.col("time").rlike(r"^(2[0-3]|[01]?\d):[0-5]?\d$")
    found = F.array(
        F.when(F.col("_missing") != "", F.concat(F.lit("required_missing:"), "_missing")),
        F.when(_filled("date") & F.col("_day").isNull(), said("date_format", "date")).when(
            ~F.col("_day").between(F.lit("1900-01-01").cast("date"), as_of),
            said("date_out_of_range", "date")),
        F.when(_filled("time") & ~clock, said("time_format", "time")),
        *[outside(name, *bounds) for name, bounds in RANGES.items()],
        F.when(_filled("tide") & ~F.col("tide").isin(*fixed.TIDES), said("tide_out_of_set", "tide")),
        F.when(_filled("weather") & ~F.col("weather").isin(*fixed.WEATHERS),
               said("weather_out_of_set", "weather")),
        F.when(_filled("source") & ~text.known_source(F.col("source")),
               said("source_unknown", "source")))
    return records.withColumns(facts).withColumn(ISSUES, F.concat_ws("|", found)).drop(*facts)


def split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good records, bad records with their issues)."""
    return checked.where(F.col(ISSUES) == "").drop(ISSUES), checked.where(F.col(ISSUES) != "")


# ---- checks of stored tables --------------------------------------------------
# A finding has four columns: check, kind, detail, and times, how often it was made.


def _finding(rows: DataFrame, check: str, kind: str, detail: Column,
             times: Column | None = None) -> DataFrame:
    times = F.lit(1) if times is None else times
    return rows.select(F.lit(check).alias("check"), F.lit(kind).alias("kind"),
                       detail.cast("string").alias("detail"), times.cast("long").alias("times"))


def bad_days(table: DataFrame, check: str, day: str) -> DataFrame:
    """Day texts that are not YYYY-MM-DD."""
    day_text = F.coalesce(F.col(day).cast("string"), F.lit(""))
    return _finding(table.where(~day_text.rlike(r"^\d{4}-\d{2}-\d{2}$")), check, "bad_date", day_text)


def repeated_keys(table: DataFrame, check: str, keys: Sequence[str]) -> DataFrame:
    """A finding per key, made as often as there are rows beyond its first."""
    found = table.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return _finding(found, check, "duplicate_key", F.concat_ws("|", *keys), F.col("_n") - 1)


def wrong_width(table: DataFrame, check: str, corrupt: str) -> DataFrame:
    """Lines whose number of columns differs from the header."""
    return _finding(table.where(F.col(corrupt).isNotNull()), check, "wrong_width", F.col(corrupt))


def outside_domain(table: DataFrame, check: str, column: str, allowed: Sequence[str]) -> DataFrame:
    """Distinct values that are not among the allowed ones."""
    return _finding(table.where(~F.col(column).isin(*allowed)).select(column).distinct(),
                    check, f"unknown_{column}", F.col(column))


def header_findings(table: DataFrame, check: str, expected: Sequence[str]) -> DataFrame:
    """Missing and extra columns; the schema alone tells."""
    names = table.columns
    found = ([(check, "missing_column", c) for c in expected if c not in names]
             + [(check, "extra_column", c) for c in names if c not in expected])
    rows = table.sparkSession.createDataFrame(found, "check string, kind string, detail string")
    return rows.withColumn("times", F.lit(1).cast("long"))


def bad_json(lines: DataFrame, check: str, body: str, schema: str, keys: Sequence[str]
             ) -> DataFrame:
    """Documents that cannot be parsed with a schema, named by their key columns."""
    mode = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    parsed = F.from_json(F.col(body), f"{schema}, _bad string", mode)
    return _finding(lines.where(parsed["_bad"].isNotNull() | parsed.isNull()),
                    check, "unreadable_json", F.concat_ws("|", *keys))


def missing_json_keys(lines: DataFrame, check: str, body: str, keys: Sequence[str],
                      inside: str | None = None) -> DataFrame:
    """Keys that a document, or the object at a path inside it, lacks.

    A document without anything at the path has no keys to miss.
    """
    document = F.col(body) if inside is None else F.get_json_object(body, inside)
    absent = F.array_except(F.array(*[F.lit(k) for k in keys]), F.json_object_keys(document))
    return _finding(lines.select(F.explode(absent).alias("_key")), check, "missing_key", F.col("_key"))


def not_a_list(lines: DataFrame, check: str, body: str, keys: Sequence[str], path: str = "$"
               ) -> DataFrame:
    """Documents whose value at a path is not an array, named by their key columns."""
    value = F.get_json_object(body, path)
    return _finding(lines.where(~F.coalesce(value.startswith("["), F.lit(False))),
                    check, "not_an_array", F.concat_ws("|", *keys))


def forecast_findings(lines: DataFrame, check: str, body: str, keys: Sequence[str]) -> DataFrame:
    """Findings of stored forecast documents; one that cannot be parsed is only that."""
    readable = F.json_object_keys(body).isNotNull()
    parsed = lines.where(readable)
    return (_finding(lines.where(~readable), check, "unreadable_json", F.concat_ws("|", *keys))
            .unionByName(missing_json_keys(parsed, check, body, ["updated", "rows"]))
            .unionByName(not_a_list(parsed, check, body, keys, "$.rows"))
            .unionByName(missing_json_keys(parsed, check, body, ["t", "wave", "wind", "dir"],
                                           "$.rows[0]")))


def condition_findings(table: DataFrame, check: str, day: str, station: str,
                       points: Sequence[str] | None = None) -> DataFrame:
    """Day format, key and (optionally) point-domain findings of a daily table."""
    parts = [bad_days(table, check, day), repeated_keys(table, check, [day, station])]
    if points is not None:
        parts.append(outside_domain(table, check, station, points))
    return reduce(DataFrame.unionByName, parts)


def line_findings(lines: DataFrame, check: str, columns: Sequence[str], day: str, keys: Sequence[str],
                  points: Sequence[str] | None = None) -> DataFrame:
    """Findings of stored CSV files, each with its file and line.

    ``lines`` are those of ``files.read_lines``; the first of a file is its header. Kinds: ``header``
    (another first line), ``width`` (another number of values; such a line is only that), ``bad_date``,
    ``duplicate_key`` (an earlier line of the file has the key) and ``unknown_...`` (the last key column
    is not among ``points``). A value does not go over several lines.
    """
    bare = F.regexp_replace("value", '"(?:[^"]|"")*"', "")
    width = F.when(F.col("value") == "", 0).otherwise(F.size(F.split(bare, ",", -1)))
    first = F.regexp_replace("value", "^\ufeff", "")
    values = F.from_csv(F.col("value"), ", ".join(f"`{c}` string" for c in columns), {"mode": "PERMISSIVE"})
    rows = lines.select("_file", "_line", "value", width.alias("_width"))
    heads = rows.where("_line = 1")
    rows = rows.where("_line > 1")
    whole = rows.where(F.col("_width") == len(columns)).select("_file", "_line", values.alias("_v")).select(
        "_file", "_line", *[F.coalesce(F.col("_v")[c], F.lit("")).alias(c) for c in {day: 0, **dict.fromkeys(keys)}])
    key = F.concat_ws("|", *keys)
    firsts = whole.groupBy("_file", *keys).agg(F.min("_line").alias("_at"), F.count(F.lit(1)).alias("_n"))
    again = whole.join(firsts.where("_n > 1"), ["_file", *keys]).where("_line > _at")

    def found(df: DataFrame, kind: str, detail: Column) -> DataFrame:
        return df.select(F.lit(check).alias("check"), F.lit(kind).alias("kind"), F.col("_file").alias("file"),
                         F.col("_line").alias("line"), detail.alias("detail"))

    parts = [found(heads.where(first != ",".join(columns)), "header", F.col("value")),
             found(rows.where(F.col("_width") != len(columns)), "width", F.col("_width").cast("string")),
             found(whole.where(~F.col(day).rlike(r"^\d{4}-\d{2}-\d{2}$")), "bad_date", F.col(day)),
             found(again, "duplicate_key", key)]
    if points is not None:
        parts.append(found(whole.where(~F.col(keys[-1]).isin(*points)), f"unknown_{keys[-1]}",
                           F.col(keys[-1])))
    return reduce(DataFrame.unionByName, parts)


def as_findings(located: DataFrame) -> DataFrame:
    """Findings with file and line as findings of a report."""
    return located.select("check", "kind", F.concat(
        F.col("file"), F.lit(":"), F.lpad(F.col("line").cast("string"), 12, " "), F.lit(" "), F.col("detail")
    ).alias("detail"), F.lit(1).cast("long").alias("times"))


def report(findings: DataFrame, checks: Sequence[str], shown: int = SHOWN_DETAILS) -> DataFrame:
    """One row per check: ok, number of issues, the first details in order.

    The row-number limit is applied before the shuffle as well, so a check with
    very many findings sends only what is shown; a finding made very often counts
    as often and is listed ``shown`` times at most.
    """
    spark = findings.sparkSession
    names = spark.range(1).select(F.explode(F.array(*[F.lit(c) for c in checks])).alias("check"))
    totals = findings.groupBy("check").agg(F.sum("times").alias("total_issues"))
    listed = findings.withColumn("_again", F.explode(F.sequence(
        F.lit(1), F.least(F.col("times"), F.lit(shown)).cast("int"))))
    order = Window.partitionBy("check").orderBy("kind", "detail")
    details = (listed.withColumn("_rank", F.row_number().over(order))
               .where(F.col("_rank") <= shown).groupBy("check")
               .agg(F.array_sort(F.collect_list(F.struct("_rank", "kind", "detail"))).alias("_rows"))
               .select("check", F.transform(
                   "_rows", lambda r: F.concat_ws(" ", r["kind"], r["detail"])).alias("details")))
    return (names.join(totals, "check", "left").join(details, "check", "left")
            .withColumn("total_issues", F.coalesce("total_issues", F.lit(0)))
            .withColumn("ok", F.col("total_issues") == 0)
            .withColumn("details", F.coalesce("details", F.array().cast("array<string>")))
            .select("check", "ok", "total_issues", "details"))


def all_ok(reported: DataFrame) -> bool:
    """Whether every check of a report is clean."""
    return reported.where(~F.col("ok")).limit(1).isEmpty()


def require_none(df: DataFrame, column: str, value: str = fixed.UNKNOWN) -> DataFrame:
    """The table itself; raises if any row still has the unknown mark."""
    if not df.where(F.col(column) == value).limit(1).isEmpty():
        raise ValueError(f"rows with {column} = {value} need review first")
    return df
