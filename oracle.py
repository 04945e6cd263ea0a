"""The analyses once more, as SQL for DuckDB over the same tables.

Written independently of the Spark code where a second way exists: calendars
are filled by a join, slopes come from the increases themselves, places are
matched to outlines side by side, hulls are found by testing every pair.
"""

from __future__ import annotations

from datetime import date

from tidemark.functions.dates import label_of, months_between
from tidemark.functions.regions import ELSEWHERE, UNLOCATED, rings

# Fixed value: the order range of the test tables, for wide column names.
FIRST_DAY, LAST_DAY = date(1995, 1, 1), date(2001, 8, 1)
NATIONS = 25

BOUNDS = """bounds AS (
  SELECT min(CAST(o_orderdate AS DATE)) AS start_day, max(CAST(o_orderdate AS DATE)) AS end_day FROM orders)"""
DAYS = BOUNDS + """, days AS (
  SELECT CAST(unnest(generate_series(start_day, end_day, INTERVAL 1 DAY)) AS DATE) AS day FROM bounds)"""
PLACE = "n_name AS country, CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '' ELSE c_mktsegment END AS province"
PANEL = DAYS + f""", counts AS (
  SELECT {PLACE}, CAST(o_orderdate AS DATE) AS day, count(*) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
places AS (SELECT DISTINCT country, province FROM counts),
panel AS (
  SELECT p.country, p.province, d.day,
         CAST(sum(coalesce(c.n, 0)) OVER (PARTITION BY p.country, p.province ORDER BY d.day) AS BIGINT) AS cum
  FROM places p CROSS JOIN days d
  LEFT JOIN counts c ON c.country = p.country AND c.province = p.province AND c.day = d.day)"""


def _monthly(source: str, keys: str, prefix: str = "") -> str:
    """Month-ends, increases and means of ``source`` under names starting with ``prefix``."""
    return f"""{prefix}ends AS (
  SELECT {keys}, date_trunc('month', day) AS m, day AS month_end, cum FROM {source}
  QUALIFY row_number() OVER (PARTITION BY {keys}, date_trunc('month', day) ORDER BY day DESC) = 1),
{prefix}changes AS (
  SELECT {keys}, m, month_end, strftime(m, '%Y-%m') AS month,
         row_number() OVER (PARTITION BY {keys} ORDER BY m) AS nth,
         CAST(cum - coalesce(lag(cum) OVER (PARTITION BY {keys} ORDER BY m), 0) AS BIGINT) AS increase
  FROM {prefix}ends),
{prefix}means AS (
  SELECT {keys}, m, month, CAST(increase AS DOUBLE) / CASE WHEN nth = 1 THEN 1 ELSE day(month_end) END AS mean
  FROM {prefix}changes)"""


BY_PLACE = PANEL + ", " + _monthly("panel", "country, province")
COUNTRY = """country_panel AS (
  SELECT country, day, CAST(sum(cum) AS BIGINT) AS cum FROM panel GROUP BY country, day)"""
BY_COUNTRY = PANEL + ", " + COUNTRY + ", " + _monthly("country_panel", "country", "c_")
INCREASES = PANEL + """, increases AS (
  SELECT country, province, day, lead(cum) OVER (PARTITION BY country, province ORDER BY day) - cum AS inc
  FROM panel QUALIFY lead(cum) OVER (PARTITION BY country, province ORDER BY day) IS NOT NULL)"""


# Levels of the days with orders only, each carried to every later month-end of its country.
RAGGED = f"""counts AS (
  SELECT {PLACE}, CAST(o_orderdate AS DATE) AS day, count(*) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
sparse AS (
  SELECT country, province, day, date_trunc('month', day) AS m, sum(n) OVER (PARTITION BY country, province ORDER BY day) AS cum FROM counts),
spans AS (SELECT country, unnest(generate_series(min(m), max(m), INTERVAL 1 MONTH)) AS m FROM sparse GROUP BY country),
asof_levels AS (
  SELECT s.country, s.m, p.province, (
    SELECT arg_max(cum, day) FROM sparse x WHERE x.country = s.country AND x.province = p.province AND x.m <= s.m) AS cum
  FROM spans s JOIN (SELECT DISTINCT country, province FROM counts) p ON p.country = s.country),
r_totals AS (SELECT country, m, CAST(sum(coalesce(cum, 0)) AS BIGINT) AS total FROM asof_levels GROUP BY country, m),
r_means AS (
  SELECT t.country, strftime(t.m, '%Y-%m') AS month,
         CASE WHEN lag(total) OVER w IS NULL THEN CAST(total AS DOUBLE)
              ELSE CAST(total - lag(total) OVER w AS DOUBLE) / coalesce((SELECT day(max(x.day)) FROM sparse x WHERE x.country = t.country AND x.m = t.m), 1) END AS mean
  FROM r_totals t WINDOW w AS (PARTITION BY t.country ORDER BY t.m))"""


def _slopes(source: str, order: str, value: str, k: int) -> str:
    """Slopes on positions 0..n-1, and the ``k`` steepest."""
    return f"""indexed AS (
  SELECT country, province, CAST({value} AS HUGEINT) AS y,
         CAST(row_number() OVER (PARTITION BY country, province ORDER BY {order}) - 1 AS HUGEINT) AS x
  FROM {source}),
slopes AS (
  SELECT country, province,
         CAST(count(*) * sum(x * y) - sum(x) * sum(y) AS DOUBLE)
           / CAST(count(*) * sum(x * x) - sum(x) * sum(x) AS DOUBLE) AS slope
  FROM indexed GROUP BY country, province),
steepest AS (
  SELECT country, province, CAST(slope AS FLOAT) AS slope,
         CAST(row_number() OVER (ORDER BY slope DESC, country, province) - 1 AS INTEGER) AS rank
  FROM slopes QUALIFY rank < {k})"""


DAILY_TOP = INCREASES + ", " + _slopes("increases", "day", "inc", 100)
MONTHLY_TOP = BY_PLACE + ", " + _slopes("changes", "m", "increase", 50)

LOCATED = """located AS (
  SELECT c_custkey, c_nationkey, c_mktsegment,
         CASE WHEN c_acctbal < 0 THEN NULL WHEN c_custkey % 50 = 0 THEN CAST(0 AS DOUBLE)
              ELSE CAST((c_custkey * 37) % 1700 AS DOUBLE) / CAST(10 AS DOUBLE) - 85 + CAST(0.05 AS DOUBLE) END AS lat,
         CASE WHEN c_custkey % 50 = 0 THEN CAST(0 AS DOUBLE)
              ELSE CAST((c_custkey * 73) % 3600 AS DOUBLE) / CAST(10 AS DOUBLE) - 180 + CAST(0.05 AS DOUBLE) END AS lon
  FROM customer)"""
PLACE_LOCATED = LOCATED + f""", place_located AS (
  SELECT {PLACE}, lat, lon FROM located JOIN nation ON c_nationkey = n_nationkey
  QUALIFY row_number() OVER (PARTITION BY country, province ORDER BY c_custkey) = 1)"""


def _labels(source: str, keys: str, corrected: bool = False) -> str:
    """Continent of every row of ``source`` by counting the sides beyond it.

    A point level with a corner counts that corner as beyond (>=), so that a
    point on a border that runs along a longitude belongs to one side only.
    """
    priority: dict[str, int] = {}
    rows = []
    for nr, (name, ring) in enumerate(rings(corrected)):
        rank = priority.setdefault(name, len(priority))
        for (la0, lo0), (la1, lo1) in zip(ring, ring[1:] + ring[:1]):
            ends = ", ".join(f"CAST({v} AS DOUBLE)" for v in (la0, lo0, la1, lo1))
            rows.append(f"('{name}', {rank}, {nr}, {ends})")
    sides = ",\n    ".join(rows)
    return f"""sides(name, priority, ring, la0, lo0, la1, lo1) AS (VALUES
    {sides}),
hits AS (
  SELECT {keys}, name, priority FROM {source} JOIN sides
    ON ((lo0 >= lon) <> (lo1 >= lon)) AND lat < (la1 - la0) * (lon - lo0) / (lo1 - lo0) + la0
  GROUP BY {keys}, name, priority, ring HAVING count(*) % 2 = 1),
best AS (SELECT {keys}, arg_min(name, priority) AS name FROM hits GROUP BY {keys}),
labelled AS (
  SELECT {', '.join('s.' + k.strip() for k in keys.split(','))},
         CASE WHEN lat IS NULL OR lon IS NULL OR (lat = 0 AND lon = 0) THEN '{UNLOCATED}'
              ELSE coalesce(name, '{ELSEWHERE}') END AS continent
  FROM {source} s LEFT JOIN best b ON {' AND '.join(f's.{k.strip()} = b.{k.strip()}' for k in keys.split(','))})"""


CONTINENTS = (
    DAILY_TOP
    + ", "
    + PLACE_LOCATED
    + ", "
    + _labels("place_located", "country, province")
    + """, continent_days AS (
  SELECT continent, day, CAST(sum(inc) AS BIGINT) AS inc
  FROM increases JOIN steepest USING (country, province) JOIN labelled USING (country, province)
  GROUP BY continent, day),
weeks AS (
  SELECT continent, CAST(date_diff('day', min(day) OVER (PARTITION BY continent), day) // 7 + 1 AS INTEGER) AS week,
         inc FROM continent_days)"""
)

NEAREST = """c[list_position(list_transform(c, lambda v: abs(v - y)), list_min(list_transform(c, lambda v: abs(v - y))))]"""


def _top_means(k: int) -> str:
    return BY_PLACE + ", " + _slopes("changes", "m", "increase", k) + """, top_means AS (
  SELECT rank, country, province, slope, m, month, mean FROM means JOIN steepest USING (country, province)),
scaled AS (
  SELECT *, CASE WHEN max(mean) OVER w = min(mean) OVER w THEN CAST(0 AS DOUBLE)
                 ELSE (mean - min(mean) OVER w) / (max(mean) OVER w - min(mean) OVER w) END AS scaled
  FROM top_means WINDOW w AS (PARTITION BY month))"""


def _clusters(k: int, ranks: tuple[int, ...]) -> str:
    """Clusters of the ``k`` steepest places, started by the places of these ranks."""
    return _top_means(k) + f""", points AS (
  SELECT *, CAST(floor(scaled * CAST(1e12 AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS BIGINT) AS steps FROM scaled),
grid AS (SELECT *, CAST(steps AS DOUBLE) / CAST(1e12 AS DOUBLE) AS y FROM points),
state(round, month, c, avg_c, done) AS (
  SELECT 0, month, [{', '.join(f"max(y) FILTER (rank = {r})" for r in ranks)}], CAST(NULL AS DOUBLE), false
  FROM grid GROUP BY month
  UNION ALL
  SELECT round + 1, month, moved, (moved[1] + moved[2] + moved[3] + moved[4]) / 4,
         coalesce((moved[1] + moved[2] + moved[3] + moved[4]) / 4 = avg_c, false)
  FROM (
    SELECT round, month, avg_c, [{', '.join(
        f"CAST(sum(CASE WHEN near = c[{i}] THEN steps ELSE 0 END) AS DOUBLE) / CAST(1e12 AS DOUBLE)"
        f" / (count(*) FILTER (near = c[{i}]) + 1)" for i in (1, 2, 3, 4))}] AS moved
    FROM (SELECT round, month, avg_c, c, steps, {NEAREST} AS near
          FROM state JOIN grid USING (month) WHERE NOT done)
    GROUP BY round, month, avg_c, c)),
final AS (SELECT month, c FROM state WHERE done),
near AS (SELECT *, {NEAREST} AS near FROM grid JOIN final USING (month)),
clustered AS (
  SELECT rank, country, province, slope, m, month, mean,
         CAST(dense_rank() OVER (PARTITION BY month ORDER BY near) - 1 AS INTEGER) AS cluster FROM near)"""


TOP_MEANS = _top_means(50)
# The draws of four from 50, 20 and 90 with the seed 42.
CLUSTERS = _clusters(50, (13, 39, 30, 45))
FEW_CLUSTERS = _clusters(20, (0, 17, 15, 1))
MANY_CLUSTERS = _clusters(90, (40, 22, 55, 70))

CROSS = "({1}.x - {0}.x) * ({2}.y - {0}.y) - ({1}.y - {0}.y) * ({2}.x - {0}.x)"
HULL = CLUSTERS + f""", dots AS (
  SELECT DISTINCT month, cluster, CAST(slope AS DOUBLE) AS x, mean AS y FROM clustered),
outermost AS (
  SELECT month, cluster, count(*) AS n, min({{'x': x, 'y': y}}) AS a, max({{'x': x, 'y': y}}) AS b
  FROM dots GROUP BY month, cluster),
edges AS (
  SELECT p.month, p.cluster, p.x, p.y FROM dots p
  JOIN dots q ON p.month = q.month AND p.cluster = q.cluster AND (p.x <> q.x OR p.y <> q.y)
  LEFT JOIN dots r ON r.month = p.month AND r.cluster = p.cluster
    AND (r.x <> p.x OR r.y <> p.y) AND (r.x <> q.x OR r.y <> q.y)
  GROUP BY p.month, p.cluster, p.x, p.y, q.x, q.y
  HAVING count(*) FILTER ({CROSS.format('p', 'q', 'r')} < 0 OR ({CROSS.format('p', 'q', 'r')} = 0
    AND (r.x - p.x) * (r.x - q.x) + (r.y - p.y) * (r.y - q.y) > 0)) = 0),
corners AS (
  SELECT DISTINCT month, cluster, x, y FROM edges
  UNION SELECT month, cluster, a.x, a.y FROM outermost WHERE n = 1),
sided AS (
  SELECT corners.*, (b.x - a.x) * (y - a.y) - (b.y - a.y) * (x - a.x) > 0 AS above
  FROM corners JOIN outermost USING (month, cluster)),
hull AS (
  SELECT month, cluster, x AS slope, y AS mean,
         CAST(row_number() OVER (PARTITION BY month, cluster ORDER BY above,
           CASE WHEN above THEN -x ELSE x END, CASE WHEN above THEN -y ELSE y END) - 1 AS INTEGER) AS vertex
  FROM sided)"""


SHIPMENTS = """days AS (
  SELECT CAST(unnest(generate_series(min(CAST(l_shipdate AS DATE)), max(CAST(l_shipdate AS DATE)), INTERVAL 1 DAY))
         AS DATE) AS day FROM lineitem),
counts AS (
  SELECT n_name AS country, CAST(l_shipdate AS DATE) AS day, count(*) AS n
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL),
panel AS (
  SELECT p.country, d.day,
         CAST(sum(coalesce(c.n, 0)) OVER (PARTITION BY p.country ORDER BY d.day) AS BIGINT) AS cum
  FROM (SELECT DISTINCT country FROM counts) p CROSS JOIN days d
  LEFT JOIN counts c ON c.country = p.country AND c.day = d.day), """ + _monthly("panel", "country")


def _events(keys: str) -> str:
    """Increases per day of the events: the counts of the next day."""
    same = " AND ".join(f"c.{k.strip()} = p.{k.strip()}" for k in keys.split(","))
    return f"""days AS (
  SELECT CAST(unnest(generate_series(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)), INTERVAL 1 DAY)) AS DATE) AS day
  FROM events),
counts AS (SELECT {keys}, CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY ALL),
increases AS (
  SELECT {', '.join('p.' + k.strip() for k in keys.split(','))}, d.day, coalesce(c.n, 0) AS inc
  FROM (SELECT DISTINCT {keys} FROM counts) p CROSS JOIN (SELECT day FROM days WHERE day < (SELECT max(day) FROM days)) d
  LEFT JOIN counts c ON {same} AND c.day = d.day + 1)"""


def _with(ctes: str, select: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{ctes}\n{select}"


def _pivot(label: str, labels: list[str], value: str) -> str:
    return ", ".join(f"max(CASE WHEN {label} = '{name}' THEN {value} END) AS \"{name}\"" for name in labels)


def oracle_sql() -> dict[str, str]:
    months = months_between(FIRST_DAY, LAST_DAY)
    short = [label_of(m) for m in months]
    long = [f"{m:%m/%y}" for m in months]
    nations = [f"NATION_{i}" for i in range(NATIONS)]
    day = "strftime(day, '%Y-%m-%d') AS day"
    short_label = "concat(CAST(month(m) AS VARCHAR), '/', strftime(m, '%y'))"
    header = "concat(CAST(month(day) AS VARCHAR), '/', CAST(day(day) AS VARCHAR), '/', strftime(day, '%y'))"
    last = "day = (SELECT end_day FROM bounds)"
    return {
        "panel_cumulative": _with(PANEL, f"SELECT country, province, {day}, cum FROM panel"),
        "calendar_days": _with(
            DAYS, f"SELECT CAST(row_number() OVER (ORDER BY day) - 1 AS INTEGER) AS idx, {day} FROM days ORDER BY idx"
        ),
        "header_names": _with(
            DAYS,
            f"""SELECT {header} AS header, concat({header}, '-', CAST(day(day) AS VARCHAR), '-days') AS bucket,
       CAST(day(day) AS INTEGER) AS bucket_days,
       concat(CAST(month(day) AS VARCHAR), '-', CAST(day(day) AS VARCHAR), '-', CAST(year(day) AS VARCHAR)) AS dashed,
       strftime(day, '%Y-%m-%d') AS day, strftime(day, '%Y-%m') AS month,
       concat(CAST(month(day) AS VARCHAR), '/', strftime(day, '%y')) AS label, strftime(day, '%Y-%m-%d') AS long_day FROM days""",
        ),
        "months_present": _with(
            DAYS,
            f"""SELECT strftime(m, '%Y-%m') AS month, {short_label} AS label
FROM (SELECT DISTINCT date_trunc('month', day) AS m FROM days) ORDER BY month""",
        ),
        "monthly_mean_by_country": _with(BY_COUNTRY, "SELECT country, month, mean FROM c_means"),
        "monthly_mean_ragged": _with(RAGGED, "SELECT country, month, mean FROM r_means"),
        "monthly_mean_by_place": _with(BY_PLACE, "SELECT country, province, month, mean FROM means"),
        "monthly_increase_by_place": _with(BY_PLACE, "SELECT country, province, month, increase FROM changes"),
        "monthly_level_mean": _with(
            PANEL,
            """SELECT country, province, strftime(day, '%Y-%m') AS month,
       CAST(sum(cum) AS DOUBLE) / count(*) AS level_mean FROM panel GROUP BY ALL""",
        ),
        "monthly_mean_wide": _with(
            BY_COUNTRY, f"SELECT country, {_pivot(short_label, short, 'mean')} FROM c_means GROUP BY country"
        ),
        "monthly_mean_transposed": _with(
            BY_COUNTRY,
            f"SELECT {short_label} AS label, {_pivot('country', nations, 'mean')} FROM c_means GROUP BY label",
        ),
        "most_least_affected": _with(
            BY_COUNTRY
            + f""", totals AS (SELECT country, cum AS total FROM country_panel WHERE {last}),
report AS (
  SELECT 'most' AS side, CAST(row_number() OVER (ORDER BY total DESC, country) - 1 AS INTEGER) AS rank, * FROM totals
  UNION ALL
  SELECT 'least', CAST(row_number() OVER (ORDER BY total, country) - 1 AS INTEGER), * FROM totals)""",
            "SELECT side, rank, country, total, month, mean FROM report JOIN c_means USING (country) WHERE rank < 10",
        ),
        "most_least_transposed": _with(
            BY_COUNTRY
            + f""", totals AS (SELECT country, cum AS total FROM country_panel WHERE {last}),
report AS (
  SELECT 'most_' || (row_number() OVER (ORDER BY total DESC, country) - 1) AS place, country FROM totals
  UNION ALL
  SELECT 'least_' || (row_number() OVER (ORDER BY total, country) - 1), country FROM totals)""",
            f"""SELECT {short_label} AS label,
       {_pivot('place', [f'{side}_{i}' for side in ('most', 'least') for i in range(10)], 'mean')}
FROM report JOIN c_means USING (country) GROUP BY label""",
        ),
        "kept_entities": _with(
            BY_COUNTRY, "SELECT country, month, mean FROM c_means WHERE country IN ('NATION_3', 'NATION_11', 'NATION_19')"
        ),
        "total_by_country": _with(
            PANEL + ", " + COUNTRY, f"SELECT country, cum AS total FROM country_panel WHERE {last}"
        ),
        "written_totals": _with(
            PANEL + ", " + COUNTRY, f"SELECT country, cum AS total FROM country_panel WHERE {last}"
        ),
        "snapshot_panel": _with(
            PANEL + """, cut AS (
  SELECT start_day, CAST(date_diff('day', start_day, end_day) AS DOUBLE) / 3 AS third FROM bounds)""",
            f"""SELECT country, province, {day}, CAST(cum + CASE
       WHEN date_diff('day', start_day, day) >= floor(1.5 * third) THEN 0
       WHEN date_diff('day', start_day, day) >= floor(third / 2) THEN 1 ELSE 2 END AS BIGINT) AS cum FROM panel CROSS JOIN cut""",
        ),
        "total_by_province": _with(
            PANEL, f"SELECT province, {day}, CAST(sum(cum) AS BIGINT) AS total FROM panel GROUP BY province, panel.day"
        ),
        "relabel_entities": _with(
            PANEL
            + """, renamed AS (
  SELECT CASE WHEN country = 'NATION_7' THEN 'NATION_8' ELSE country END AS name, day, cum FROM panel)""",
            f"""SELECT name AS country, {day}, CAST(sum(cum) AS BIGINT) AS total
FROM renamed GROUP BY name, renamed.day""",
        ),
        "wide_roundtrip": _with(PANEL, f"SELECT country, province, {day}, cum FROM panel"),
        "wide_level_mean": _with(
            PANEL,
            """SELECT country, province, strftime(day, '%Y-%m') AS month,
       CAST(sum(cum) AS DOUBLE) / count(*) AS level_mean FROM panel GROUP BY ALL""",
        ),
        "wide_slopes": _with(DAILY_TOP, "SELECT country, province, CAST(slope AS FLOAT) AS slope FROM slopes"),
        "wide_csv_monthly_mean": _with(
            BY_COUNTRY,
            """SELECT country, mean, concat(CAST(month(month_end) AS VARCHAR), '/', CAST(day(month_end) AS VARCHAR), '/',
       strftime(month_end, '%y'), '-', CAST(day(month_end) AS VARCHAR), '-days') AS bucket
FROM c_means JOIN c_ends USING (country, m)""",
        ),
        "daily_increase": _with(INCREASES, f"SELECT country, province, {day}, CAST(inc AS BIGINT) AS inc FROM increases"),
        "trend_slope_top100": _with(DAILY_TOP, "SELECT rank, country, province, slope FROM steepest ORDER BY rank"),
        "appended_daily_increase": _with(INCREASES, f"SELECT country, province, {day}, CAST(inc AS BIGINT) AS inc FROM increases"),
        "appended_slope_top100": _with(DAILY_TOP, "SELECT rank, country, province, slope FROM steepest ORDER BY rank"),
        "continent_label": _with(
            LOCATED + ", " + _labels("located", "c_custkey"), "SELECT c_custkey, continent FROM labelled"
        ),
        "continent_label_corrected": _with(
            LOCATED + ", " + _labels("located", "c_custkey", corrected=True),
            "SELECT c_custkey, continent FROM labelled",
        ),
        "continent_label_sql": _with(
            LOCATED + ", " + _labels("located", "c_custkey"), "SELECT c_custkey, continent FROM labelled"
        ),
        "continent_label_table": _with(
            LOCATED + ", " + _labels("located", "c_custkey"), "SELECT c_custkey, continent FROM labelled"
        ),
        "continent_daily_total": _with(CONTINENTS, f"SELECT continent, {day}, inc FROM continent_days"),
        "continent_weekly_stats": _with(
            CONTINENTS,
            """SELECT continent, week, CAST(sum(inc) AS DOUBLE) / count(*) AS mean,
       sqrt(CAST(count(*) * sum(inc * inc) - sum(inc) * sum(inc) AS DOUBLE)) / count(*) AS std,
       max(inc) AS max, min(inc) AS min FROM weeks GROUP BY continent, week""",
        ),
        "continent_weekly_min_size": _with(
            CONTINENTS, "SELECT continent, week, abs(min(inc)) AS min_size FROM weeks GROUP BY continent, week"
        ),
        "top50_monthly_mean": _with(TOP_MEANS, "SELECT rank, country, province, slope, month, mean FROM top_means"),
        "top50_monthly_increase": _with(
            MONTHLY_TOP,
            "SELECT rank, country, province, slope, month, increase FROM changes JOIN steepest USING (country, province)",
        ),
        "minmax_scaled": _with(TOP_MEANS, "SELECT country, province, month, scaled FROM scaled"),
        "kmeans_by_month": _with(CLUSTERS, "SELECT rank, country, province, month, cluster FROM clustered", True),
        "kmeans_few_places": _with(FEW_CLUSTERS, "SELECT rank, country, province, month, cluster FROM clustered", True),
        "kmeans_many_places": _with(MANY_CLUSTERS, "SELECT rank, country, province, month, cluster FROM clustered", True),
        "cluster_matrix": _with(
            CLUSTERS,
            f"""SELECT rank, country, province, slope, {_pivot("strftime(m, '%m/%y')", long, 'cluster')}
FROM clustered GROUP BY rank, country, province, slope""",
            True,
        ),
        "cluster_text": _with(
            CLUSTERS
            + """, texts AS (
  SELECT month, '[' || string_agg(CAST(cluster AS VARCHAR), ', ' ORDER BY rank) || ']' AS cluster_id
  FROM clustered GROUP BY month)""",
            "SELECT month, cluster_id, rank, cluster FROM clustered JOIN texts USING (month)",
            True,
        ),
        "cluster_hull": _with(
            HULL,
            "SELECT cluster, vertex, slope, mean FROM hull WHERE month = (SELECT max(month) FROM clustered)",
            True,
        ),
        "cluster_hull_by_month": _with(HULL, "SELECT month, cluster, vertex, slope, mean FROM hull", True),
        "outer_join_headers": _with(
            PANEL + ", " + PLACE_LOCATED,
            f"""SELECT coalesce(h.country, v.country) AS country, coalesce(h.province, v.province) AS province,
       h.lat, h.lon, v.cum AS total
FROM place_located h FULL JOIN (SELECT * FROM panel WHERE {last}) v
  ON h.country = v.country AND h.province = v.province""",
        ),
        "outer_join_users": """SELECT coalesce(e.user_id, c.c_custkey) AS party, e.event_id, e.event_type, c.c_mktsegment AS segment
FROM events e FULL JOIN customer c ON e.user_id = c.c_custkey""",
        "shipment_monthly_mean": _with(SHIPMENTS, "SELECT country, month, mean FROM means"),
        "event_trend_top100": _with(
            _events("event_type, user_id")
            + """, indexed AS (
  SELECT event_type, user_id, CAST(inc AS HUGEINT) AS y,
         CAST(row_number() OVER (PARTITION BY event_type, user_id ORDER BY day) - 1 AS HUGEINT) AS x FROM increases),
slopes AS (
  SELECT event_type, user_id,
         CAST(count(*) * sum(x * y) - sum(x) * sum(y) AS DOUBLE)
           / CAST(count(*) * sum(x * x) - sum(x) * sum(x) AS DOUBLE) AS slope
  FROM indexed GROUP BY event_type, user_id)""",
            """SELECT CAST(row_number() OVER (ORDER BY slope DESC, event_type, user_id) - 1 AS INTEGER) AS rank,
       event_type, user_id, CAST(slope AS FLOAT) AS slope FROM slopes QUALIFY rank < 100""",
        ),
        "event_weekly_stats": _with(
            _events("event_type"),
            """SELECT event_type, week, CAST(sum(inc) AS DOUBLE) / count(*) AS mean,
       sqrt(CAST(count(*) * sum(inc * inc) - sum(inc) * sum(inc) AS DOUBLE)) / count(*) AS std,
       max(inc) AS max, min(inc) AS min
FROM (SELECT event_type, inc,
             CAST(date_diff('day', (SELECT min(day) FROM days), day) // 7 + 1 AS INTEGER) AS week FROM increases)
GROUP BY event_type, week""",
        ),
        "event_weekly_stream": _with(
            _events("event_type"),
            """SELECT event_type, week, CAST(sum(inc) AS DOUBLE) / count(*) AS mean,
       sqrt(CAST(count(*) * sum(inc * inc) - sum(inc) * sum(inc) AS DOUBLE)) / count(*) AS std,
       max(inc) AS max, min(inc) AS min
FROM (SELECT event_type, inc,
             CAST(date_diff('day', (SELECT min(day) FROM days), day) // 7 + 1 AS INTEGER) AS week FROM increases)
GROUP BY event_type, week""",
        ),
    }
