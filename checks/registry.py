"""Where queries and their checking SQL are collected, and SQL building blocks."""
from __future__ import annotations

from collections.abc import Callable, Sequence

from . import views

QUERIES: dict[str, Callable] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under its name."""
    def add(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function
    return add


def with_views(*names: str, **parts: str) -> str:
    """WITH clause of some views and further named selects."""
    clauses = [views.view_sql(n) if n in views.TABLES else views.aggregated_sql(n) for n in names]
    clauses += [f"{name} AS ({text})" for name, text in parts.items()]
    return "WITH " + ", ".join(clauses) + " "


def rounded(value: str, digits: int) -> str:
    """Rounding to the nearest decimal, ties to even; ``value`` is a column."""
    scale = 10 ** digits
    scaled = f"({value} * {scale}::DOUBLE)"
    rest = f"(floor({scaled}) + 0.5::DOUBLE)"
    for bit in reversed(range(scale.bit_length())):
        if scale >> bit & 1:
            rest = f"({rest} - {value} * {1 << bit}::DOUBLE)"
    half = f"{scaled} - floor({scaled}) = 0.5"
    return (f"(CASE WHEN {half} AND {rest} > 0 THEN floor({scaled}) "
            f"WHEN {half} AND {rest} < 0 THEN floor({scaled}) + 1 "
            f"ELSE round_even({scaled}, 0) END / {scale}::DOUBLE)")


def tenth(value: str) -> str:
    return f"(round_even(({value}) * 10::DOUBLE, 0) / 10::DOUBLE)"


def summary_parts(source: str, keys: Sequence[str], value: str = "value", prefix: str = "s"
                  ) -> dict[str, str]:
    """Named selects that end in ``<prefix>_out``: keys and the eight numbers."""
    k = ", ".join(keys)
    join = " AND ".join(f"m.{x} = q.{x}" for x in keys)
    a, b = "((n - 1) * 25)", "((n - 1) * 75)"
    return {
        f"{prefix}_r": f"SELECT {k}, {value} AS x, count(*) OVER (PARTITION BY {k}) AS n, "
                       f"row_number() OVER (PARTITION BY {k} ORDER BY {value}) - 1 AS rk "
                       f"FROM {source} WHERE {value} IS NOT NULL",
        f"{prefix}_q": f"SELECT {k}, max(n) AS qn, "
                       f"max(CASE WHEN rk = (n - 1) // 2 THEN x END) AS m0, "
                       f"max(CASE WHEN rk = n // 2 THEN x END) AS m1, "
                       f"max(CASE WHEN rk = {a} // 100 THEN x END) AS a0, "
                       f"max(CASE WHEN rk = least({a} // 100 + 1, n - 1) THEN x END) AS a1, "
                       f"max(CASE WHEN rk = {b} // 100 THEN x END) AS b0, "
                       f"max(CASE WHEN rk = least({b} // 100 + 1, n - 1) THEN x END) AS b1 "
                       f"FROM {prefix}_r GROUP BY {k}",
        f"{prefix}_m": f"SELECT {k}, count({value}) AS n, avg({value}) AS mean, "
                       f"stddev_pop({value}) AS sd, min({value}) AS lo, max({value}) AS hi "
                       f"FROM {source} GROUP BY {k}",
        f"{prefix}_z": f"SELECT {', '.join('m.' + x for x in keys)}, n, mean, "
                       f"CASE WHEN n >= 2 THEN sd END AS sd, lo, hi, "
                       f"(m0 + m1) / 2::DOUBLE AS med, "
                       f"a0 * (({a} // 100) + 1 - {a} / 100::DOUBLE) "
                       f"+ a1 * ({a} / 100::DOUBLE - ({a} // 100)) AS p25, "
                       f"b0 * (({b} // 100) + 1 - {b} / 100::DOUBLE) "
                       f"+ b1 * ({b} / 100::DOUBLE - ({b} // 100)) AS p75 "
                       f"FROM {prefix}_m m LEFT JOIN {prefix}_q q ON {join}",
        f"{prefix}_out": f"SELECT {k}, n, {rounded('mean', 2)} AS mean, "
                         f"{rounded('med', 2)} AS median, {rounded('sd', 2)} AS std, "
                         f"{rounded('lo', 2)} AS min, {rounded('hi', 2)} AS max, "
                         f"{rounded('p25', 2)} AS p25, {rounded('p75', 2)} AS p75 "
                         f"FROM {prefix}_z",
    }


def share_select(source: str, keys: Sequence[str], value: str) -> str:
    k = ", ".join(keys)
    over = f"OVER (PARTITION BY {k})" if keys else "OVER ()"
    lead = k + ", " if keys else ""
    inner = (f"SELECT {lead}{value}, count(*) AS n FROM {source} "
             f"WHERE {value} IS NOT NULL AND {value} <> '' GROUP BY {lead}{value}")
    shares = (f"SELECT *, n / CAST(sum(n) {over} AS DOUBLE) * 100::DOUBLE AS share FROM ({inner})")
    return f"SELECT {lead}{value}, n, {rounded('share', 1)} AS pct FROM ({shares})"


def trend_parts(source: str, value: str = "v", digits: int = 2, speed: bool = False
                ) -> dict[str, str]:
    """Named selects that end in ``trend``: point, day, value, ma7, changes, label."""
    def before(days: int) -> str:
        return (f"max({value}) OVER (PARTITION BY point ORDER BY day RANGE BETWEEN "
                f"INTERVAL {days} DAY PRECEDING AND INTERVAL {days} DAY PRECEDING)")
    steps = ([("change7 >= 0.2", "流速増加"), ("change7 <= -0.2", "流速減少")] if speed else
             [("change7 >= 1.5", "急上昇"), ("change7 >= 0.5", "上昇"),
              ("change7 <= -1.5", "急下降"), ("change7 <= -0.5", "下降")])
    flat = "流速安定" if speed else "安定"
    label = ("CASE WHEN change7 IS NULL THEN '不明' "
             + " ".join(f"WHEN {c} THEN '{w}'" for c, w in steps) + f" ELSE '{flat}' END")
    return {
        "t_raw": f"SELECT point, day, {value} AS value, avg({value}) OVER (PARTITION BY point "
                 f"ORDER BY day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW) AS m, "
                 f"{value} - {before(1)} AS c1, {value} - {before(7)} AS c7 "
                 f"FROM {source} WHERE {value} IS NOT NULL",
        "t_round": f"SELECT point, day, value, {rounded('m', digits)} AS ma7, "
                   f"{rounded('c1', digits)} AS change1, {rounded('c7', digits)} AS change7 "
                   f"FROM t_raw",
        "trend": f"SELECT *, {label} AS label FROM t_round",
    }


MOON_RAW = ("((((day - DATE '1970-01-01') + 2440587.5::DOUBLE) - 2451550.1::DOUBLE) "
            "% 29.530588853::DOUBLE)")
MOON_AGE = tenth(f"CASE WHEN {MOON_RAW} < 0 THEN {MOON_RAW} + 29.530588853::DOUBLE "
                 f"ELSE {MOON_RAW} END")
TIDE = ("CASE WHEN moon <= 2 OR moon >= 28 THEN '大潮' WHEN moon <= 5 THEN '中潮' "
        "WHEN moon <= 8 THEN '小潮' WHEN moon <= 10 THEN '長潮' WHEN moon <= 12 THEN '若潮' "
        "WHEN moon <= 16 THEN '大潮' WHEN moon <= 19 THEN '中潮' WHEN moon <= 22 THEN '小潮' "
        "WHEN moon <= 24 THEN '長潮' WHEN moon <= 26 THEN '若潮' ELSE '中潮' END")
PHASE = ("CASE WHEN moon < 1.85::DOUBLE THEN '新月' WHEN moon < 5.55::DOUBLE THEN '三日月' "
         "WHEN moon < 9.25::DOUBLE THEN '上弦' WHEN moon < 12.95::DOUBLE THEN '十日夜' "
         "WHEN moon < 16.65::DOUBLE THEN '満月' WHEN moon < 20.35::DOUBLE THEN '十六夜' "
         "WHEN moon < 24.05::DOUBLE THEN '下弦' WHEN moon < 27.75::DOUBLE THEN '二十六夜' "
         "ELSE '晦日' END")


def sector_sql(names: Sequence[str], index: str) -> str:
    items = ", ".join(f"'{n}'" for n in names)
    return f"[{items}][CAST(({index}) AS INT) % {len(names)} + 1]"


def in_list(words: Sequence[str]) -> str:
    return "(" + ", ".join(f"'{w}'" for w in words) + ")"
