"""Records of different origin brought to the master columns."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed, text
from ..functions.numbers import finite, null_as_blank, to_number

CLEANED = ["species", "bait", "method", "spot", "date", "time", "tide", "weather",
           "nearest_station", "memo", "source_detail"]
KEPT_NUMBERS = ["size_cm", "weight_kg", "count", "spot_lat", "spot_lng", "water_temp"]


def _first_filled(df: DataFrame, names: Sequence[str]) -> Column:
    present = [F.col(f"`{n}`").cast("string") for n in names if n in df.columns]
    return F.coalesce(*[F.when(c != "", c) for c in present], F.lit("")) if present else F.lit("")


def normalise_records(df: DataFrame, columns: Mapping[str, str | Sequence[str]], source: str,
                      entered_at: Column, record_id: Column, prompt_version: str = "",
                      confidence: str | None = None, passed: Sequence[str] = ()) -> DataFrame:
    """Raw records to master columns (first version), all texts.

    ``columns`` maps a master column to its input column, or to several of which
    the first non-empty one counts. Texts are stripped and put in compatibility
    form, dates and times brought to one format, numbers kept as they are
    written. Tide and weather words outside their lists move to the memo.
    """
    def given(name: str) -> Column:
        source_names = columns.get(name, [])
        return _first_filled(df, [source_names] if isinstance(source_names, str) else source_names)

    row = df.select(
        *passed, entered_at.alias("_entered_at"), record_id.alias("_record_id"),
        *[given(name).alias(f"_{name}") for name in [*CLEANED, *KEPT_NUMBERS]],
        (F.col(confidence).cast("string") if confidence else F.lit("")).alias("_confidence"))
    row = row.withColumns({f"_{name}": text.strip(F.col(f"_{name}"))
                           for name in [*KEPT_NUMBERS, "confidence"]})
    row = text.with_nfkc(row, {f"_{name}": text.strip(F.col(f"_{name}")) for name in CLEANED})

    def listed(name: str, words: Sequence[str]) -> tuple[Column, Column]:
        inside = F.col(f"_{name}").isin(*words)
        return (F.when(inside, F.col(f"_{name}")).otherwise(""),
                F.when(~inside & (F.col(f"_{name}") != ""), F.col(f"_{name}")))

    tide, moved_tide = listed("tide", fixed.TIDES)
    weather, moved_weather = listed("weather", fixed.WEATHERS)
    memo = F.concat_ws(" / ", F.when(F.col("_memo") != "", F.col("_memo")),
                       moved_tide, moved_weather)
    out = {name: F.lit("") for name in fixed.MASTER_V1_COLUMNS}
    out |= {name: F.col(f"_{name}") for name in [*CLEANED, *KEPT_NUMBERS]}
    out |= {"date": text.iso_date(F.col("_date")), "time": text.hour_minute(F.col("_time")),
            "tide": tide, "weather": weather, "memo": memo, "source": F.lit(source),
            "entered_at": F.col("_entered_at"), "record_id": F.col("_record_id"),
            "prompt_version": F.lit(prompt_version), "confidence": F.col("_confidence")}
    return row.select(*passed, *[column.alias(name) for name, column in out.items()])


def target_columns(mapping: Mapping[str, str]) -> dict[str, str]:
    """Input-to-master names turned round; of two inputs for one target the last wins."""
    return {target: source for source, target in mapping.items()}


def normalise_manual(df: DataFrame, entered_at: Column, record_id: Column,
                     passed: Sequence[str] = ()) -> DataFrame:
    """Hand-entered records, whose columns have the master names already."""
    return normalise_records(df, {n: n for n in [*CLEANED, *KEPT_NUMBERS]}, "manual",
                             entered_at, record_id, passed=passed)


def normalise_extracted(df: DataFrame, entered_at: Column, record_id: Column,
                        prompt_version: str = "pre-v1", passed: Sequence[str] = ()) -> DataFrame:
    """Records read from pictures: with the detail's origin, prompt and confidence."""
    columns = {n: n for n in [*CLEANED, *KEPT_NUMBERS]}
    columns["source_detail"] = ["source_detail", "post_url", "image_file"]
    return normalise_records(df, columns, "instagram", entered_at, record_id, prompt_version,
                             "confidence" if "confidence" in df.columns else None, passed)


def normalise_import(df: DataFrame, mapping: Mapping[str, str], entered_at: Column,
                     record_id: Column, source: str = "import:csv_v5.5",
                     passed: Sequence[str] = ()) -> DataFrame:
    """Rows of a foreign table, renamed by a mapping of its columns."""
    return normalise_records(df, target_columns(mapping), source, entered_at, record_id,
                             passed=passed)


def entered_at(date: Column) -> Column:
    """Fixed entry time of a record without one: midnight of its day, or empty."""
    return F.when(date != "", F.concat(date, F.lit("T00:00:00+09:00"))).otherwise("")


def to_master(drops: DataFrame, boat: Column, area: Column, normalise_dates: bool = False,
              namespace: str = fixed.RECORD_ID_NAMESPACE, passed: Sequence[str] = ()) -> DataFrame:
    """Dropped catch rows to master rows: source form, entry time, content id.

    With ``normalise_dates`` other date formats are brought to one first, so ids
    and day joins do not depend on them; rows in the usual format keep their id.
    """
    rows = drops.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in fixed.CATCH_COLUMNS],
                        boat.alias("boat_id"), area.alias("area_id"), *passed)
    rows = rows.withColumn("source", text.internal_source(F.col("source")))
    if normalise_dates:
        rows = text.once(rows, {"date": text.strip(F.col("date"))})
        rows = text.once(text.with_nfkc(rows, {"date": F.col("date")}), {"date": text.iso_date(F.col("date"))})
    rows = rows.withColumn("entered_at", entered_at(F.col("date")))
    rows = text.with_record_id(rows, "record_id", F.col("boat_id"),
                               [F.col(c) for c in fixed.RECORD_ID_COLUMNS], namespace)
    return rows.select(*[F.col(c) if c in rows.columns else F.lit("").alias(c)
                         for c in fixed.MASTER_COLUMNS], *passed)


def initial_master(catch: DataFrame, seq: str, namespace: str | None = None) -> DataFrame:
    """First master from a catch table: values untouched, ids by row number.

    ``seq`` is the zero-based row number. Without a name space ids are random.
    """
    named = {"Instagram": "instagram", "Manual": "manual", "Other": "other"}
    number = F.col(seq).cast("string")
    padded = F.when(F.length(number) < 4, F.lpad(number, 4, "0")).otherwise(number)
    seed = F.concat(F.lit("fishing_data#"), padded, F.lit(":"), F.concat_ws(
        "|", *[null_as_blank(F.col(c)) for c in ("date", "time", "species", "spot")]))
    rows = (catch.withColumn("record_id", F.expr("uuid()")) if namespace is None
            else text.with_uuid5(catch, "record_id", seed, namespace))
    rows = rows.withColumns({
        "source": F.coalesce(text.lookup(F.col("source"), named), F.col("source")),
        "entered_at": entered_at(F.col("date"))})
    return rows.select(*[null_as_blank(F.col(c)).alias(c) if c in rows.columns
                         else F.lit("").alias(c) for c in fixed.MASTER_COLUMNS])


def catch_columns(master: DataFrame, force_empty: bool = False) -> DataFrame:
    """The nineteen catch columns, source in its written form."""
    def column(name: str) -> Column:
        if force_empty and name in ("temp", "wind"):
            return F.lit("")
        value = F.coalesce(F.col(name), F.lit(""))
        return text.external_source(value) if name == "source" else value

    return master.select(*[column(c).alias(c) for c in fixed.CATCH_COLUMNS])


def design_sorted(df: DataFrame) -> DataFrame:
    """Newest day and time first, then by id; malformed days and times last.

    The sort numbers are columns of their own, as a sort would work out an
    expression at every comparison.
    """
    def number(column: str, mark: str, *weights: int) -> Column:
        part = r"\s*\+?\d+\s*"
        total = F.lit(0.0)
        for i, weight in enumerate(weights):
            text_of = F.substring_index(F.substring_index(F.col(column), mark, i + 1), mark, -1)
            total = total + F.trim(text_of).cast("double") * weight
        return F.when(F.col(column).rlike(f"^{mark.join([part] * len(weights))}$"), total
                      ).otherwise(0)

    keyed = df.withColumns({"_day_no": number("date", "-", 10000, 100, 1),
                            "_time_no": number("time", ":", 100, 1)})
    return keyed.orderBy(F.desc("_day_no"), F.desc("_time_no"), F.asc("record_id")).drop(
        "_day_no", "_time_no")


def day_sorted(df: DataFrame, day: str, seq: str) -> DataFrame:
    """By day, rows without a valid day first, else as they came."""
    return df.orderBy(F.col(day).asc_nulls_first(), F.col(seq).asc())


def recode(df: DataFrame, column: str, table: Mapping[str, str] = fixed.STATION_RECODE
           ) -> DataFrame:
    """Old key values replaced by new ones."""
    return df.withColumn(column, F.coalesce(text.lookup(F.col(column), table), F.col(column)))


def typed(master: DataFrame) -> DataFrame:
    """Texts of a master to days and numbers; unreadable and non-finite ones become null."""
    numbers = ["size_cm", "weight_kg", "count", "spot_lat", "spot_lng", "water_temp"]
    day = F.when(F.col("date").rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$"),
                 F.trim("date").try_cast("date"))
    return master.withColumn("day", day).withColumns(
        {name: finite(to_number(F.col(name))) for name in numbers if name in master.columns})
