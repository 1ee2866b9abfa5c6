"""Text expressions: normal forms, formats, names and ids."""
from __future__ import annotations

import unicodedata
import uuid
from collections.abc import Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from . import fixed

# White space as str.strip() knows it.
_SPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
          "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def strip(text: Column) -> Column:
    """Remove all white space at both ends; null becomes an empty text."""
    return F.btrim(F.coalesce(text, F.lit("")), F.lit(_SPACE))


def _normal_form_function():
    """Arrow function for the compatibility normal form of a text.

    Defined inside a function, it travels to the workers by value, so the
    package need not be installed there.
    """
    def part(texts: pa.Array) -> pa.Array:
        coded = texts.dictionary_encode()  # each distinct text once
        words = [unicodedata.normalize("NFKC", word) for word in coded.dictionary.to_pylist()]
        return pa.array(words, pa.string()).take(coded.indices)

    most = 1 << 22

    def normal(texts: pa.Array) -> pa.Array:
        size = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size, dtype=np.int64)
        if not len(ends) or ends[-1] <= most:
            return part(texts)
        # Long texts go by parts of about ``most`` bytes, so that few of them are Python's at a time.
        cuts = np.flatnonzero(np.diff(ends // most)) + 1
        return pa.concat_arrays([part(texts[a:b]) for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(texts)])])

    return F.arrow_udf(normal, T.StringType())


_nfkc = _normal_form_function()


# Characters that are their own compatibility form whatever stands beside them:
# ASCII, unified ideographs, kana, and most Latin letters with marks and punctuation of kana. One class of all
# tries range after range for every character; runs of one class at a time take a fraction of that.
_RUNS = ("\x00-\x7f", "一-\u9fff", "ぁ-ゖァ-ヺ・ー", "\u3001-\u3003\u3005-\u3011À-ÖØ-öø-ıĴ-ľŁ-ňŊ-ž")
_STABLE_RUNS = r"\A(?:" + "|".join(f"[{part}]+" for part in _RUNS) + r")*+\z"
STABLE = "".join(_RUNS)


def _stable(text: Column) -> Column:
    """The pattern only sees texts that are not ASCII, which the two lengths tell."""
    return (F.octet_length(text) == F.char_length(text)) | text.rlike(_STABLE_RUNS)


def once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Adds columns that are worked out once for each row, however often they are used above.

    The optimizer puts what a column is made of in the place of each of its uses where one goes to
    Python; it does not do so through a generator.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))).alias(*columns))


def nfkc(text: Column) -> Column:
    """Text in compatibility normal form, which Spark has no function for.

    A text of stable characters is its own normal form and goes through as null,
    so only other texts cost anything in Python.
    """
    return F.coalesce(_nfkc(F.when(~_stable(text), text)), text)


_END, _ESCAPE = "\x1f", "\x1e"  # both are their own normal form and keep what is beside them apart


def with_nfkc(df: DataFrame, texts: Mapping[str, Column]) -> DataFrame:
    """Adds several columns in compatibility normal form with one Arrow call per batch.

    The texts of a row go as one, and only where one of them is not stable: a
    column of nulls costs next to nothing there, a column of lists would.
    """
    def closed(text: Column) -> Column:
        return F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit(_ESCAPE), F.lit(_ESCAPE + "0")),
                         F.lit(_END), F.lit(_ESCAPE + "1"))

    def opened(text: Column) -> Column:
        return F.replace(F.replace(text, F.lit(_ESCAPE + "1"), F.lit(_END)), F.lit(_ESCAPE + "0"), F.lit(_ESCAPE))

    raw = {f"_raw{i}": text for i, text in enumerate(texts.values())}
    rows = once(once(df, raw), {"_all": F.concat_ws("", *raw)})
    rows = once(rows, {"_odd": F.when(~_stable(F.col("_all")), F.concat_ws(_END, *[closed(F.col(c)) for c in raw]))})
    rows = rows.withColumn("_normal", _nfkc(F.col("_odd")))
    parts = F.split("_normal", _END, -1)
    return rows.withColumns({name: F.when(F.col("_normal").isNull() | F.col(c).isNull(), F.col(c)).otherwise(
        opened(F.get(parts, i))) for i, (name, c) in enumerate(zip(texts, raw))}).drop("_normal", "_odd", "_all", *raw)


def clean(text: Column) -> Column:
    """Stripped and compatibility-normalised text; null becomes empty."""
    return nfkc(strip(text))


def iso_date(text: Column) -> Column:
    """2024-1-5, 2024/1/5 and 2024.1.5 become 2024-01-05; the rest stays."""
    parts = text.rlike(r"^\d{4}([-/.])\d{1,2}\1\d{1,2}$")
    day = F.regexp_replace(text, "[/.]", "-").try_cast("date")
    return F.coalesce(F.when(parts, F.date_format(day, "yyyy-MM-dd")), text)


def hour_minute(text: Column) -> Column:
    """6:5, 06:05:59 and 6時5分 become 06:05; the rest stays."""
    pattern = (r"^(2[0-3]|[01]?\d)(?::([0-5]?\d)(?::(?:6[01]|[0-5]?\d))?|時([0-5]?\d)分)$")
    hour = F.regexp_extract(text, pattern, 1)
    minute = F.concat(F.regexp_extract(text, pattern, 2), F.regexp_extract(text, pattern, 3))
    return F.when(text.rlike(pattern),
                  F.concat(F.lpad(hour, 2, "0"), F.lit(":"), F.lpad(minute, 2, "0"))
                  ).otherwise(text)


def lookup(key: Column, table: Mapping) -> Column:
    """Value of a small fixed table; null where the key is missing."""
    entries = [F.lit(item) for pair in table.items() for item in pair]
    return F.try_element_at(F.create_map(*entries), key)


def internal_source(source: Column) -> Column:
    return F.coalesce(lookup(source, fixed.SOURCE_TO_INTERNAL), source)


def external_source(source: Column) -> Column:
    """Back to the written form: known names and prefixes start with a capital."""
    shown = {inner: outer for outer, inner in fixed.SOURCE_TO_INTERNAL.items()}
    with_prefix = _any_prefix(source, fixed.SOURCE_PREFIXES)
    capital = F.concat(F.upper(F.substring(source, 1, 1)),
                       source.substr(F.lit(2), F.length(source)))
    return F.coalesce(lookup(source, shown), F.when(with_prefix, capital), source, F.lit(""))


def known_source(source: Column) -> Column:
    return (source.isin(*fixed.SOURCE_TO_INTERNAL.values())
            | _any_prefix(source, fixed.SOURCE_PREFIXES))


def _any_prefix(text: Column, prefixes: Sequence[str]) -> Column:
    found = F.lit(False)
    for prefix in prefixes:
        found = found | text.startswith(prefix)
    return found


def spot_core(text: Column,
              blanks: Sequence[str] = fixed.SPOT_BLANKS,
              brackets: Sequence[str] = fixed.SPOT_BRACKETS,
              prefixes: Sequence[str] = fixed.SPOT_PREFIXES) -> Column:
    """Spot name without blanks, brackets and one leading prefecture name.

    A name that is nothing but the prefecture stays as it is. Expects text in
    compatibility normal form.
    """
    bare = F.translate(text, "".join([*blanks, *brackets]), "")
    longest_first = sorted(prefixes, key=len, reverse=True)
    return F.regexp_replace(bare, "^(?:" + "|".join(longest_first) + ")(?=.)", "")


def canonical_spot(text: Column, aliases: Mapping[str, str] = fixed.SPOT_ALIASES,
                   normalise: bool = True) -> Column:
    """Raw spot name to its canonical name; null and empty become empty."""
    text = F.coalesce(text, F.lit(""))
    core = spot_core(nfkc(text) if normalise else text)
    return F.coalesce(lookup(core, aliases), core) if aliases else core


def with_uuid5(df: DataFrame, name: str, seed: Column, namespace: str) -> DataFrame:
    """Adds the version-5 UUID of a text in a name space."""
    space = F.unhex(F.lit(uuid.UUID(namespace).hex))
    digest = F.col("_digest")
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab" * 4)
    rows = df.withColumn("_digest", F.sha1(F.concat(space, F.encode(seed, "UTF-8"))))
    return rows.withColumn(name, F.concat_ws(
        "-", F.substring(digest, 1, 8), F.substring(digest, 9, 4),
        F.concat(F.lit("5"), F.substring(digest, 14, 3)),
        F.concat(variant, F.substring(digest, 18, 3)), F.substring(digest, 21, 12))
    ).drop("_digest")


def with_record_id(df: DataFrame, name: str, boat: Column, fields: Sequence[Column],
                   namespace: str = fixed.RECORD_ID_NAMESPACE) -> DataFrame:
    """Adds an id made from what a record says, so order and replays do not change it."""
    rows = once(df, {"_seed": F.concat_ws("|", boat, *[strip(field) for field in fields])})
    return with_uuid5(rows, name, nfkc(F.col("_seed")), namespace).drop("_seed")


def weather_text(code: Column) -> Column:
    named = lookup(code.cast("int"), fixed.WEATHER_TEXT)
    return F.when(code.isNull(), "").otherwise(
        F.coalesce(named, F.concat(F.lit("code"), code.cast("int").cast("string"))))
