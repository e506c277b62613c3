"""DuckDB text of the fixture views, for the independent SQL oracle.

``with_views(sql, "census", ...)`` prefixes an oracle query with the CTEs it
needs; definitions mirror ``fieldkit.sources.fixtures`` expression for
expression (same IEEE operations in the same order).
"""

from __future__ import annotations

from fieldkit.sources.fixtures import ADMIN_NAMES, ADMIN_X_EDGES, ADMIN_Y_EDGES, RETURNFLAG_LABELS


def _polygons_values() -> str:
    rows = []
    for r in range(3):
        for c in range(3):
            rows.append(f"('A{r}{c}', '{ADMIN_NAMES[(r, c)]}', {ADMIN_X_EDGES[c]!r}::DOUBLE, "
                        f"{ADMIN_X_EDGES[c + 1]!r}::DOUBLE, {ADMIN_Y_EDGES[r]!r}::DOUBLE, "
                        f"{ADMIN_Y_EDGES[r + 1]!r}::DOUBLE)")
    return ("SELECT * FROM (VALUES " + ", ".join(rows)
            + ") AS t(admin_id, admin_name, xmin, xmax, ymin, ymax)")


VIEWS: dict[str, str] = {
    "census": """
        SELECT CAST(l_orderkey AS VARCHAR) AS hh_id, l_linenumber AS person, l_quantity AS age,
               l_returnflag AS sex, l_linestatus AS urban_rural, CAST(year(l_shipdate) AS INTEGER) AS dob_yr,
               substring(CAST(l_orderkey AS VARCHAR), 1, 1) AS prov_id,
               substring(CAST(l_orderkey AS VARCHAR), 1, 2) AS dist_id
        FROM lineitem""",
    "census_dirty": """
        SELECT CAST(l_orderkey AS VARCHAR) AS hh_id, l_linenumber AS person,
               CASE WHEN l_linenumber = 7 THEN 'NaN?' WHEN l_linenumber = 6 THEN NULL
                    ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS P08,
               substring(CAST(l_orderkey AS VARCHAR), 1, 1) AS prov_id
        FROM lineitem""",
    "activity": """
        SELECT user_id AS SID, event_id AS ACTIVITY_ID, event_type AS "Last",
               strftime(ts, '%d-%b-%y %H.%M.%S') || '.000000000 XX' AS ACTIVITY_TIME,
               upper(left(event_type, 1)) AS STATUS
        FROM events""",
    "pings": """
        SELECT event_id, user_id, ts, event_type, site_id,
               CAST(33.7 AS DOUBLE) + CAST(site_id % 10 AS DOUBLE) * CAST(0.004 AS DOUBLE) AS x,
               CAST(-14.0 AS DOUBLE) + CAST(site_id // 10 AS DOUBLE) * CAST(0.004 AS DOUBLE) AS y
        FROM (SELECT event_id, user_id, ts, event_type, (event_id * 37 + user_id) % 100 AS site_id FROM events)""",
    "sites_2g": """
        SELECT CAST(site_id AS VARCHAR) AS "Cell ID", x AS Longitude, y AS Latitude
        FROM (SELECT DISTINCT site_id, x, y FROM pings) WHERE site_id % 2 = 0""",
    "sites_3g": """
        SELECT CAST(site_id AS VARCHAR) AS "Cell ID", y AS Latitude, x AS Longitude,
               'S' || CAST(site_id AS VARCHAR) AS "Site Name"
        FROM (SELECT DISTINCT site_id, x, y FROM pings) WHERE site_id % 2 = 1""",
    "admin_polygons": _polygons_values(),
    "codebook": "SELECT * FROM (VALUES " + ", ".join(f"('{c}', '{l}')" for c, l in RETURNFLAG_LABELS)
                + ") AS t(code, label)",
    "weather": """
        SELECT event_id,
          '{"city":{"id":' || CAST(user_id AS VARCHAR) || '},"list":[{"dt":' || CAST(event_id AS VARCHAR)
          || ',"main":{"temp_min":' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) AS VARCHAR)
          || ',"humidity":' || CAST(user_id % 100 AS VARCHAR) || '}},{"dt":' || CAST(event_id + 1 AS VARCHAR)
          || ',"main":{"temp_min":' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) + 1 AS VARCHAR)
          || ',"humidity":' || CAST(user_id % 100 AS VARCHAR) || '}'
          || CASE WHEN event_type = 'error'
                  THEN ',"rain":{"3h":' || CAST(CAST(json_extract_string(props, '$.k') AS BIGINT) AS VARCHAR) || '}'
                  ELSE '' END || '}]}' AS json
        FROM events""",
    "scores": """
        SELECT vec_id, CAST(g.i - 1 AS INTEGER) AS cls, CAST(g.embedding[g.i] AS DOUBLE) AS score, label
        FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings) g""",
    "corpus": "SELECT doc_id, text FROM documents",
}

# views that read other views
_DEPS = {"sites_2g": ["pings"], "sites_3g": ["pings"]}


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with CTEs for the named fixture views (dependencies first)."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in _DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    if not order:
        return sql
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in order)
    body = sql.strip()
    if body.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {ctes},\n{body[15:]}"
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def hav_sql(lat1: str, lon1: str, lat2: str, lon2: str, radius: float = 6371.0) -> str:
    """Great-circle km as DuckDB text: the haversine of the central angle, held at 1."""
    half = lambda a, b: f"pow(sin(radians(({b}) - ({a})) / 2), 2)"
    h = f"{half(lat1, lat2)} + cos(radians({lat1})) * cos(radians({lat2})) * {half(lon1, lon2)}"
    return f"(CAST({2 * radius!r} AS DOUBLE) * asin(sqrt(least(1.0, {h}))))"


def r6(expr: str) -> str:
    """Round half up to 6 decimals with IEEE arithmetic (twin of ``round6``)."""
    return f"(floor(({expr}) * 1e6 + 0.5) / 1e6)"
