"""Queries: names, aliases and prefixes as tables, curvilinear grids, findings by line."""
from __future__ import annotations

from pyspark.sql import functions as F

from tidewright.functions import fixed
from tidewright.operators import merge, names, quality, spatial
from tidewright.session import fresh_path
from tidewright.sources import files

from .joins import BLOCKED
from .records import ADDED_ALIASES
from .registry import query, rounded, with_views
from .views import POINTS, table

NAMES = """SELECT p_name AS name FROM part UNION
    SELECT unnest(string_split(text, ' ')) FROM benchmark"""


@query(f"""WITH names AS (SELECT DISTINCT name FROM ({NAMES}) WHERE name <> ''),
    hits AS (SELECT doc_id, arg_min(name, row(-length(name), name)) AS name
             FROM documents JOIN names ON contains(text, name) GROUP BY doc_id)
    SELECT doc_id, CASE WHEN {" OR ".join(f"contains(text, '{w}')" for w in BLOCKED)} THEN NULL
           ELSE hits.name END AS name
    FROM documents LEFT JOIN hits USING (doc_id)""")
def names_in_documents(spark, sf):
    """All part names and all words of the benchmark looked for in all whole documents."""
    words = table(spark, sf, "benchmark").select(F.explode(F.split("text", " ", -1)).alias("name"))
    known = table(spark, sf, "part").select(F.col("p_name").alias("name")).unionByName(words)
    known = known.withColumn("order", F.col("name"))
    bad = spark.createDataFrame([(w,) for w in BLOCKED], "name string")
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return names.longest_name_in(docs, "text", known, "name", "order", "name", bad).select("doc_id", "name")


SPOTS = """SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN 'ASIA' || name WHEN 1 THEN '(' || name || ') '
    WHEN 2 THEN 'AMERICA' WHEN 3 THEN 'EUROPE　' || name WHEN 4 THEN 'ASIAAFRICA' || name END AS spot
    FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'R' || CAST(c_nationkey % 5 AS STRING) ELSE
    'NATION_' || CAST(c_nationkey + 5 * CAST(c_custkey % 3 AS INT) AS STRING) END AS name FROM customer)"""


@query(f"""WITH given AS (SELECT DISTINCT * FROM ({ADDED_ALIASES})),
    old AS (SELECT n_name AS name, 'R' || CAST(n_regionkey AS STRING) AS target FROM nation),
    many AS (SELECT name, count(*) AS n FROM given WHERE name <> target GROUP BY name),
    fine AS (SELECT g.* FROM given g JOIN many m USING (name) LEFT JOIN old o USING (name)
             WHERE g.name <> g.target AND o.target IS NULL AND m.n = 1
             UNION ALL SELECT name, target FROM old),
    bare AS (SELECT c_custkey, translate(coalesce(spot, ''), ' 　()（）', '') AS b FROM ({SPOTS})),
    cut AS (SELECT c_custkey, b, coalesce((SELECT max(length(r_name)) FROM region WHERE starts_with(b, r_name)
            AND length(r_name) < length(b)), 0) AS n FROM bare)
    SELECT c_custkey, coalesce(f.target, substr(b, n + 1)) AS canonical FROM cut
    LEFT JOIN fine f ON f.name = substr(b, n + 1)""")
def name_canonical_table(spark, sf):
    """Aliases as a merge left them and prefixes, both as tables, applied to raw names."""
    customer = table(spark, sf, "customer")
    given = spark.sql(ADDED_ALIASES.replace("FROM customer", "FROM {c}"), c=customer)
    stored = table(spark, sf, "nation").selectExpr("n_name AS name", "'R' || CAST(n_regionkey AS STRING) AS target")
    added = merge.alias_statuses(stored, given, "name", "target").where("status = 'added'")
    aliases = stored.unionByName(added.select("name", "target"))
    spots = spark.sql(SPOTS.replace("FROM customer", "FROM {c}"), c=customer)
    prefixes = table(spark, sf, "region").select(F.col("r_name").alias("prefix"))
    return names.canonical_by_table(spots, "spot", aliases, prefixes, "canonical", source="name",
                                    target="target").select("c_custkey", "canonical")


CURVED = {"day": "CAST(o_orderdate AS DATE)", "depth": "CAST(o_custkey % 3 AS DOUBLE)", "y": "o_orderkey",
          "x": "o_custkey", "lat": "32.0E0 + CAST(o_orderkey % 131 AS DOUBLE) / 57.0E0 + CAST(o_custkey % 7 AS DOUBLE) / 90.0E0",
          "lon": "133.0E0 + CAST(o_custkey % 113 AS DOUBLE) / 51.0E0 + CAST(o_orderkey % 5 AS DOUBLE) / 70.0E0",
          "u": "(o_totalprice - 250000.0E0) / 250000.0E0", "v": "(CAST(o_custkey % 101 AS DOUBLE) - 50.0E0) / 50.0E0",
          "temp": "o_totalprice / 20000.0E0", "salt": "30.0E0 + o_totalprice / 100000.0E0"}
SEARCHED = (*fixed.CURRENT_POINTS, ("far", -60.0, -170.0, ""))
_CURVED = "SELECT " + ", ".join(f"{e} AS {c}" for c, e in CURVED.items()) + " FROM orders"
_SEARCHED = " UNION ALL ".join(f"SELECT '{n}' AS point, {a}::DOUBLE AS p, {o}::DOUBLE AS q" for n, a, o, *_ in SEARCHED)


@query(with_views(g=_CURVED, pts=_SEARCHED, top="SELECT day, min(depth) AS depth FROM g GROUP BY day",
                  d="""SELECT g.*, point, p, q, (lat - p) * (lat - p) + (lon - q) * (lon - q) AS off
                       FROM g JOIN top USING (day, depth) CROSS JOIN pts""",
                  b="SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY day, point ORDER BY off, y, x) AS rn "
                    "FROM d) WHERE rn = 1",
                  c="SELECT *, sqrt(u * u + v * v) AS s, degrees(atan2(u, v)) + 360::DOUBLE AS d0, "
                    "sqrt(pow(lat - p, 2) + pow(lon - q, 2)) AS away FROM b",
                  e="SELECT *, s * 1.944::DOUBLE AS kn, CASE WHEN d0 >= 360 THEN d0 - 360 ELSE d0 END AS dir FROM c")
       + f"""SELECT CAST(day AS STRING) AS day, point, {rounded('u', 4)} AS u_ms, {rounded('v', 4)} AS v_ms,
        {rounded('s', 4)} AS speed_ms, {rounded('kn', 4)} AS speed_kn, {rounded('dir', 1)} AS direction,
        {rounded('temp', 2)} AS temp_c, {rounded('salt', 3)} AS salinity, away > 0.15 AS too_far FROM e""")
def grid_points_2d(spark, sf):
    """Positions that follow from no axes, points near and half a globe away."""
    grid = table(spark, sf, "orders").selectExpr(*[f"{e} AS `{c}`" for c, e in CURVED.items()])
    return spatial.grid_points_2d(grid, SEARCHED).drop("lat", "lon").withColumn("day", F.col("day").cast("string"))


LINE = ("CASE o_orderkey % 40 WHEN 1 THEN day || ',' || point || ',1,extra' WHEN 2 THEN '' "
        "WHEN 3 THEN replace(day, '-', '/') || ',' || point || ',2' WHEN 4 THEN day || ',\"a,b\",3' "
        "WHEN 5 THEN '1999-09-09,' || point || ',4' ELSE day || ',' || point || '-' || "
        "CAST(o_orderkey AS STRING) || ',5' END")
LINES = ("SELECT CAST(o_custkey % 4 AS STRING) AS part, o_orderkey, {line} AS value FROM (SELECT *, CAST(CAST(o_orderdate "
         "AS DATE) AS STRING) AS day, o_orderpriority AS point FROM {orders})")


@query(f"""WITH l AS (SELECT 'part=' || part AS file, row_number() OVER (PARTITION BY part ORDER BY o_orderkey) + 1 AS line,
        o_orderkey % 40 AS k, split_part(value, ',', 2) AS point, split_part(value, ',', 1) AS day
        FROM ({LINES.format(line=LINE, orders="orders")})),
    r AS (SELECT *, row_number() OVER (PARTITION BY file, day, point ORDER BY line) AS rn FROM l WHERE k IN (3, 5)),
    q AS (SELECT *, row_number() OVER (PARTITION BY file, day ORDER BY line) AS rn FROM l WHERE k = 4)
    SELECT 'width' AS kind, file, line, CASE k WHEN 1 THEN '4' ELSE '0' END AS detail FROM l WHERE k IN (1, 2)
    UNION ALL SELECT 'bad_date', file, line, day FROM l WHERE k = 3
    UNION ALL SELECT 'duplicate_key', file, line, day || '|' || point FROM r WHERE rn > 1
    UNION ALL SELECT 'duplicate_key', file, line, day || '|a,b' FROM q WHERE rn > 1""")
def findings_by_line(spark, sf):
    """Orders as four CSV files with faults, each found with its file and line."""
    path = fresh_path(spark, "stored")
    lines = spark.sql(LINES.format(line=LINE, orders="{o}"), o=table(spark, sf, "orders"))
    heads = lines.select("part", F.lit(-1).cast("long").alias("o_orderkey"), F.lit("day,point,v").alias("value")).distinct()
    lines = lines.withColumn("o_orderkey", F.col("o_orderkey").cast("long")).unionByName(heads)
    lines.repartition("part").sortWithinPartitions("part", "o_orderkey").select("part", "value").write.partitionBy(
        "part").text(path)
    found = quality.line_findings(files.read_lines(spark, f"{path}/part=*"), "stored", ["day", "point", "v"], "day",
                                  ["day", "point"])
    return found.select("kind", "file", "line", "detail")
