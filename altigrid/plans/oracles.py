"""The registered queries as SQL over the same tables (DuckDB dialect).

Written from the definitions, not from the Spark plans: per-zoom formulas on
the coordinates, window ranks for ties, and explicit joins to the palette.
"""

from __future__ import annotations

from altigrid.functions.palette import PALETTES
from altigrid.plans.catalog import (
    HGT_SIDE, MAX_ZOOM, MEAN_ZOOM, PIXEL_ZOOM, SAMPLE, STORE_ZOOM, TILE_ZOOM)

# Fixed value: the public base-32 alphabet of geohash.
ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"

VIEW_SQL = {
    "v_dem": """
SELECT l_orderkey * 8 + l_linenumber AS point_id,
       CAST((l_orderkey * 7919 + l_linenumber * 104729) % 180000 - 90000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS lat,
       CAST((l_partkey * 104729 + l_suppkey * 7919 + l_orderkey * 31) % 360000 - 180000 AS DOUBLE)
           / CAST(1000 AS DOUBLE) AS lon,
       CAST((l_orderkey * 31 + l_partkey * 17 + l_linenumber * 101) % 9500 - 200 AS INTEGER) AS height
FROM lineitem""",
    "dem": "SELECT * FROM v_dem WHERE lat >= -90 AND lat < 90 AND lon >= -180 AND lon < 180"
           " AND height >= 0 AND height <= 9000",
    "dense": """
SELECT l_orderkey * 8 + l_linenumber AS point_id,
       CAST(450000 + (l_orderkey * 7919 + l_linenumber * 104729) % 10000 AS DOUBLE) / CAST(10000 AS DOUBLE) AS lat,
       CAST(50000 + (l_partkey * 104729 + l_suppkey * 7919 + l_orderkey * 31) % 20000 AS DOUBLE)
           / CAST(10000 AS DOUBLE) AS lon,
       CAST((l_orderkey * 31 + l_partkey * 17 + l_linenumber * 101) % 9001 AS INTEGER) AS height
FROM lineitem""",
    "v_gps": """
SELECT event_id AS point_id,
       CAST((user_id * 7919 + (event_id % 5) * 13) % 180000 - 90000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS lat,
       CAST((user_id * 104729 + (event_id % 5) * 29) % 360000 - 180000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS lon
FROM events""",
    "dense_gps": """
SELECT point_id, 45 + CAST(CAST(FLOOR(ABS(lat) * 1000) AS BIGINT) % 10000 AS DOUBLE) / CAST(10000 AS DOUBLE) AS lat,
       5 + CAST(CAST(FLOOR(ABS(lon) * 1000) AS BIGINT) % 20000 AS DOUBLE) / CAST(10000 AS DOUBLE) AS lon
FROM v_gps""",
    "v_near": f"""
SELECT o_orderkey AS request_id, CAST(o_custkey % {MAX_ZOOM + 1} AS INTEGER) AS zoom, lat_min, lon_min, lat_min + span AS lat_max, lon_min + span AS lon_max
FROM (SELECT *, 45 + CAST(o_orderkey * 7919 % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS lat_min,
             5 + CAST(o_orderkey * 104729 % 2000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS lon_min,
             CAST(1 + o_custkey % 8 AS DOUBLE) / CAST(8 AS DOUBLE) AS span FROM orders)""",
    "v_gps_text": """
SELECT point_id, CAST(CAST(lat AS DECIMAL(9,3)) AS VARCHAR) AS lat_text,
       CASE WHEN point_id % 41 = 0 THEN 'east' ELSE CAST(CAST(lon AS DECIMAL(9,3)) AS VARCHAR) END AS lon_text
FROM v_gps""",
    "v_cities": """
SELECT 'n' || c_nationkey AS country, LOWER(c_name) AS city, c_name AS accent_city,
       (CASE WHEN c_nationkey % 2 = 0 THEN '0' ELSE 'A' END) || (c_custkey % 3) AS region,
       CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE (c_custkey * 37) % 100003 END AS population,
       CAST(((c_custkey % 400) * 7919) % 180000 - 90000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS lat,
       CAST(((c_custkey % 400) * 104729) % 360000 - 180000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS lon
FROM customer""",
    "v_regions": """
SELECT 'N' || n_nationkey AS country,
       (CASE WHEN n_nationkey % 2 = 0 THEN '0' ELSE 'A' END) || r AS region, n_name || ' R' || r AS name
FROM nation, (VALUES (0), (1)) AS t(r)""",
    "cities": """
SELECT UPPER(country) AS country, region, accent_city AS city, population, lat, lon
FROM v_cities WHERE population IS NOT NULL""",
    "joined": "SELECT c.*, r.name FROM cities c JOIN v_regions r USING (country, region)",
    "v_views": """
SELECT request_id, lat_min, lat_min + span AS lat_max, width_px, span,
       CASE WHEN request_id % 50 = 0 THEN CAST(180 AS DOUBLE) - span / CAST(2 AS DOUBLE) ELSE lon_min END AS lon_min,
       CASE WHEN request_id % 50 = 0 THEN CAST(-180 AS DOUBLE) + span / CAST(2 AS DOUBLE) ELSE lon_min + span END AS lon_max
FROM (SELECT o_orderkey AS request_id,
             CAST((o_orderkey * 7919) % 150000 - 90000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS lat_min,
             CAST((o_orderkey * 104729) % 300000 - 180000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS lon_min,
             CAST(1 + o_custkey % 30 AS DOUBLE) AS span, CAST(256 + (o_custkey % 4) * 256 AS INTEGER) AS width_px
      FROM orders)""",
    "view_zoom": """
SELECT *, list_filter(range(0, 21), lambda z:
              CAST(180 AS DOUBLE) / (256 * CAST(POW(2, z) AS DOUBLE)) <= GREATEST(CASE WHEN lon_max < lon_min THEN lon_max - lon_min + 360 ELSE lon_max - lon_min END, lat_max - lat_min) / width_px)[1] AS best
FROM v_views""",
    "v_requests": f"""
SELECT o_orderkey AS request_id,
       CAST((o_orderkey * 7919) % 180000 - 90000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS lat,
       CAST((o_orderkey * 104729) % 360000 - 180000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS lon,
       CAST(o_custkey % {TILE_ZOOM + 2} AS INTEGER) AS zoom
FROM orders""",
}

# View name -> views it reads.
_NEEDS = {
    "dem": ["v_dem"], "v_gps_text": ["v_gps"], "dense_gps": ["v_gps"], "cities": ["v_cities"],
    "joined": ["cities", "v_regions"], "view_zoom": ["v_views"],
}


def _with(names: list[str], body: str, **extra: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    parts = [(n, VIEW_SQL[n]) for n in ordered] + list(extra.items())
    return "WITH " + ",\n".join(f"{n} AS ({sql})" for n, sql in parts) + "\n" + body


# --- pieces -----------------------------------------------------------------

def _axis(deg: str, origin: int, cells: str, last: str) -> str:
    return (f"CAST(LEAST(FLOOR(({deg} + CAST({origin} AS DOUBLE)) * CAST({cells} AS DOUBLE)"
            f" / CAST(180 AS DOUBLE)), {last}) AS INTEGER)")


def _pixel(zoom: int | str, side: int = 256) -> tuple[str, str]:
    """gx and gy of a point; zoom a number or a column."""
    cells = f"({side} * POW(2, {zoom}))"
    return _axis("lon", 180, cells, f"2 * {cells} - 1"), _axis("lat", 90, cells, f"{cells} - 1")


def _points_at(zoom: int, source: str = "dem", side: int = 256) -> str:
    gx, gy = _pixel(zoom, side)
    return f"SELECT *, CAST({zoom} AS INTEGER) AS zoom, {gx} AS gx, {gy} AS gy FROM {source}"


def _points_all(max_zoom: int, side: int = 256, source: str = "dem") -> str:
    gx, gy = _pixel("zoom", side)
    return (f"SELECT *, {gx} AS gx, {gy} AS gy FROM {source},"
            f" (SELECT CAST(UNNEST(range(0, {max_zoom + 1})) AS INTEGER) AS zoom)")


_TILE = "gx >> 8 AS tile_x, gy >> 8 AS tile_y, gx & 255 AS x, gy & 255 AS y"
_MAX = "SELECT zoom, gx, gy, MAX(height) AS alt FROM located GROUP BY ALL"


def _corner(tile: str, zoom: str, origin: int) -> str:
    return f"CAST({tile} AS DOUBLE) * (CAST(180 AS DOUBLE) / POW(2, {zoom})) - {origin}"


def _bits(lat: str, lon: str, n: int) -> tuple[int, str, str]:
    bits = 5 * n
    nlat = bits // 2
    nlon = bits - nlat
    io = f"CAST(FLOOR(({lon} + CAST(180 AS DOUBLE)) * POW(2, {nlon}) / CAST(360 AS DOUBLE)) AS BIGINT)"
    il = f"CAST(FLOOR(({lat} + CAST(90 AS DOUBLE)) * POW(2, {nlat}) / CAST(180 AS DOUBLE)) AS BIGINT)"
    return bits, io, il


def _geohash(lat: str, lon: str, n: int) -> str:
    """Interleave bit by bit, first bit longitude, and cut in fives."""
    bits, io, il = _bits(lat, lon, n)
    nlat = bits // 2
    nlon = bits - nlat
    chars = []
    for c in range(n):
        terms = []
        for k in range(5):
            at = 5 * c + k
            axis, left = (io, nlon - 1 - at // 2) if at % 2 == 0 else (il, nlat - 1 - at // 2)
            terms.append(f"(({axis} >> {left}) & 1) * {16 >> k}")
        chars.append(f"SUBSTR('{ALPHABET}', CAST({' + '.join(terms)} AS INTEGER) + 1, 1)")
    return " || ".join(chars)


_TILE_HASH = _geohash(_corner("tile_y", "zoom", 90), _corner("tile_x", "zoom", 180), 8)


def _round(cols: str, digits: int) -> str:
    return ", ".join(f"ROUND({c}, {digits}) AS {c}" for c in cols.split())


_GEO_KEYED = "SELECT *, " + _TILE_HASH + " AS geohash FROM {source}"

# Tiles of the pyramid 0..TILE_ZOOM, packed: sorted pixels with the gaps filled.
_PACKED = dict(
    located=_points_all(TILE_ZOOM),
    px=f"SELECT zoom, {_TILE}, alt FROM ({_MAX})",
    cells="""SELECT zoom, tile_x, tile_y, x * 256 + y AS pos,
       printf('%02X%02X', (alt + 32769) % 65536 % 256, ((alt + 32769) % 65536) >> 8) AS word FROM px""",
    gaps="""SELECT *, pos - COALESCE(LAG(pos) OVER (PARTITION BY zoom, tile_x, tile_y ORDER BY pos), -1) - 1 AS gap
       FROM cells""",
    packed="""SELECT zoom, tile_x, tile_y, unhex(STRING_AGG(REPEAT('0000', gap) || word, '' ORDER BY pos)
       || REPEAT('0000', 65535 - MAX(pos))) AS tile FROM gaps GROUP BY ALL""",
    tiles=_GEO_KEYED.format(source="packed"),
)


# The same of the dense readings, zooms 0..MAX_ZOOM.
_DENSE = _PACKED | {"located": _points_all(MAX_ZOOM, source="dense")}
_RAMPS = PALETTES | {"own": [(0.25, 0, 0.25, 1), (0.5, 0.5, 1, 0.5), (0.75, 1, 0.5, 0.25)]}


def _coloured(palette: str, source: str) -> dict[str, str]:
    """CTEs that colour the distinct altitudes of a pixel set."""
    rows = ", ".join(
        f"({k}, CAST({v!r} AS DOUBLE), CAST({r!r} AS DOUBLE), CAST({g!r} AS DOUBLE), CAST({b!r} AS DOUBLE))"
        for k, (v, r, g, b) in enumerate([tuple(float(c) for c in s) for s in _RAMPS[palette]]))
    blend = ", ".join(
        f"CAST(round_even(COALESCE((p.{c} - n.{c}) * ((v - n.val) / NULLIF(p.val - n.val, 0)) + n.{c},"
        f" n.{c}, l.{c}) * 255, 0) AS INTEGER) AS {name}"
        for c, name in (("r", "red"), ("g", "green"), ("b", "blue")))
    return dict(
        stops=f"SELECT * FROM (VALUES {rows}) AS t(k, val, r, g, b)",
        alts=f"SELECT DISTINCT alt, CAST(alt + 8000 AS DOUBLE) / CAST(16000 AS DOUBLE) AS v FROM {source}",
        following="SELECT alt, v, (SELECT MIN(k) FROM stops WHERE v < val) AS k FROM alts",
        colours=f"""SELECT alt, {blend}, 255 AS alpha FROM following f
            LEFT JOIN stops n ON n.k = f.k LEFT JOIN stops p ON p.k = GREATEST(f.k - 1, 0),
            (SELECT * FROM stops ORDER BY k DESC LIMIT 1) l""",
    )


def _pixel_colour(palette: str) -> str:
    return _with(["dem"], "SELECT px.*, red, green, blue, alpha FROM px JOIN colours USING (alt)",
                 located=_points_at(PIXEL_ZOOM), px=_MAX, **_coloured(palette, "px"))


def _histogram(source: str, view: str, col: str) -> str:
    return _with([view], f"""
SELECT CAST(k AS INTEGER) AS bucket, CAST(k * 80 AS DOUBLE) AS low, CAST(k * 80 + 80 AS DOUBLE) AS high,
       (SELECT COUNT(*) FROM {source} WHERE {col} >= k * 80
            AND ({col} < k * 80 + 80 OR (k = 98 AND {col} = 7920))) AS n
FROM (SELECT UNNEST(range(0, 99)) AS k)""")


def _histogram_auto(view: str, col: str) -> str:
    return _with([view], f"""
SELECT CAST(k AS INTEGER) AS bucket,
       ROUND(lo + CAST(k AS DOUBLE) * (hi - lo) / CAST(100 AS DOUBLE), 6) AS low,
       ROUND(lo + CAST(k + 1 AS DOUBLE) * (hi - lo) / CAST(100 AS DOUBLE), 6) AS high,
       COALESCE(n, 0) AS n
FROM (SELECT UNNEST(range(0, 100)) AS k) LEFT JOIN counts ON k = b, span""",
        span=f"SELECT MIN({col})::DOUBLE AS lo, MAX({col})::DOUBLE AS hi FROM {view}",
        counts=f"""SELECT CAST(LEAST(99, FLOOR((CAST({col} AS DOUBLE) - lo) * CAST(100 AS DOUBLE) / (hi - lo)))
            AS BIGINT) AS b, COUNT(*) AS n FROM {view}, span GROUP BY 1""")


def _summary(col: str, source: str) -> str:
    return (f"SELECT COUNT({col}) AS n, ROUND(AVG({col}), 6) AS mean, ROUND(STDDEV_POP({col}), 6) AS stdev,"
            f" MAX({col}) AS max, MIN({col}) AS min FROM {source}")


_SAMPLED = (f"((point_id % 2147483647) * 2654435761) % 4294967296 < {int(SAMPLE * 2**32)}")

_STORE = dict(
    located=_points_all(STORE_ZOOM),
    px=f"SELECT zoom, {_TILE}, alt FROM ({_MAX})",
    summary="""SELECT zoom, tile_x, tile_y, COUNT(*) AS n_pixels, MIN(alt) AS min_alt, MAX(alt) AS max_alt
       FROM px GROUP BY ALL""",
    tiles=_GEO_KEYED.format(source="summary"),
)


def _cover(zoom: str, source: str) -> dict[str, str]:
    def edge(fn: str, deg: str, origin: int) -> str:
        return (f"CAST({fn}(({deg} + CAST({origin} AS DOUBLE)) * POW(2, {zoom}) / CAST(180 AS DOUBLE)) AS INTEGER)")

    sides = f"""SELECT * FROM {source} WHERE lon_min <= lon_max UNION ALL
            SELECT * REPLACE (CAST(180 AS DOUBLE) AS lon_max) FROM {source} WHERE lon_min > lon_max UNION ALL
            SELECT * REPLACE (CAST(-180 AS DOUBLE) AS lon_min) FROM {source} WHERE lon_min > lon_max"""
    return dict(
        sides=sides,
        edges=f"""SELECT request_id, CAST({zoom} AS INTEGER) AS zoom,
            GREATEST({edge('FLOOR', 'lon_min', 180)}, 0) AS x0,
            LEAST({edge('CEIL', 'lon_max', 180)}, CAST(POW(2, {zoom} + 1) AS INTEGER)) AS x1,
            GREATEST({edge('FLOOR', 'lat_min', 90)}, 0) AS y0,
            LEAST({edge('CEIL', 'lat_max', 90)}, CAST(POW(2, {zoom}) AS INTEGER)) AS y1 FROM sides""",
        columns_="SELECT *, UNNEST(range(x0, x1)) AS tile_x FROM edges",
        cover="""SELECT request_id, zoom, CAST(tile_x AS INTEGER) AS tile_x,
            CAST(UNNEST(range(y0, y1)) AS INTEGER) AS tile_y FROM columns_""",
    )


def _hgt_points(n: int = HGT_SIDE, source: str = "v_dem") -> dict[str, str]:
    cell = lambda deg: f"CAST(FLOOR(({deg} - FLOOR({deg})) * {n - 1}) AS INTEGER)"
    at = lambda deg, c: f"CAST(FLOOR({deg}) AS DOUBLE) + CAST({c} AS DOUBLE) * CAST({1 / (n - 1)!r} AS DOUBLE)"
    return dict(
        placed=f"SELECT height, {at('lat', cell('lat'))} AS lat, {at('lon', cell('lon'))} AS lon FROM {source}",
        tops="SELECT lat, lon, MAX(height) AS height FROM placed GROUP BY ALL HAVING MAX(height) > 0",
    )


# Rasters of four bytes a pixel, in rows from the north-west.
_RGBA = dict(
    px=_PACKED["px"], **_coloured("gps", "px"),
    cells="""SELECT zoom, tile_x, tile_y, (255 - y) * 256 + x AS pos,
        printf('%02X%02X%02X%02X', red, green, blue, alpha) AS word FROM px JOIN colours USING (alt)""",
    gaps=_PACKED["gaps"],
    packed=_PACKED["packed"].replace("'0000'", "'00000000'").replace("AS tile", "AS raster"),
    rasters=_GEO_KEYED.format(source="packed"),
)

_CITY_BEST = """SELECT geohash, city, population, country FROM (
    SELECT geohash, city, population, name AS country,
           ROW_NUMBER() OVER (PARTITION BY geohash ORDER BY population DESC, city DESC, name DESC) AS rank
    FROM keyed) WHERE rank = 1"""
_CITY_KEYED = f"SELECT *, {_geohash('lat', 'lon', 10)} AS geohash FROM joined"


def all_oracles() -> dict[str, str]:
    out = {
        "parse_dem": _with(["v_dem"], "SELECT lat, lon, height FROM v_dem WHERE point_id % 53 <> 0"),
        "parse_dem_compat": _with(["v_dem"], """SELECT lat, lon,
            CASE WHEN point_id % 53 = 0 THEN 0 ELSE height END AS height FROM v_dem"""),
        "parse_gps": _with(["v_gps"], "SELECT lat, lon FROM v_gps WHERE point_id % 41 <> 0"),
        "parse_gps_compat": _with(["v_gps"], """SELECT lat,
            CASE WHEN point_id % 41 = 0 THEN CAST(0 AS DOUBLE) ELSE lon END AS lon FROM v_gps"""),
        "parse_points_rowfail": _with(["v_gps"], """SELECT
            CASE WHEN point_id % 41 = 0 THEN CAST(0 AS DOUBLE) ELSE lat END AS lat,
            CASE WHEN point_id % 41 = 0 THEN CAST(0 AS DOUBLE) ELSE lon END AS lon,
            point_id % 41 <> 0 AS ok FROM v_gps"""),
        "points_failed_lines": _with(["v_gps_text"], """SELECT lat_text || ',' || lon_text AS line
            FROM v_gps_text WHERE point_id % 41 = 0"""),
        "dem_bounds": _with(["dem"], "SELECT * FROM dem"),
        "gps_bounds": _with(["v_gps"], """SELECT * FROM v_gps
            WHERE lat >= -90 AND lat < 90 AND lon >= -180 AND lon < 180"""),
        "dem_positive": _with(["v_dem"], "SELECT * FROM v_dem WHERE height > 0"),
        "dem_extent": _with(["v_dem"], """SELECT MIN(lat) AS lat_min, MAX(lat) AS lat_max, MIN(lon) AS lon_min,
            MAX(lon) AS lon_max, COUNT(*) AS n_points, ROUND(MAX(lon) - MIN(lon), 9) AS width_deg,
            ROUND(MAX(lat) - MIN(lat), 9) AS height_deg FROM v_dem"""),
        "scan_not_missing": _with(["v_dem"], "SELECT lat, lon, height FROM v_dem WHERE point_id % 53 <> 0"),
        "sample_hash": _with(["v_dem"], f"SELECT * FROM v_dem WHERE {_SAMPLED}"),
        "zoom_grid": _with(["dem"], """SELECT zoom, CAST(POW(2, zoom) AS INTEGER) AS n_rows,
            CAST(POW(2, zoom + 1) AS INTEGER) AS n_cols, CAST(180 AS DOUBLE) / POW(2, zoom) AS step,
            COUNT(*) AS n_pixels FROM (SELECT DISTINCT zoom, gx, gy FROM located) GROUP BY zoom""",
            located=_points_all(MAX_ZOOM)),
        "pixel_assign": _with(["dem"], f"""SELECT point_id, zoom, {_TILE},
            {_corner('(gy >> 8)', 'zoom', 90)} AS tile_lat, {_corner('(gx >> 8)', 'zoom', 180)} AS tile_lon
            FROM located""", located=_points_at(MAX_ZOOM)),
        "snap_to_step": _with(["dem"], f"""SELECT point_id, {_corner('gy', str(MEAN_ZOOM), 90)} AS cell_lat,
            {_corner('gx', str(MEAN_ZOOM), 180)} AS cell_lon FROM located""", located=_points_at(MEAN_ZOOM, side=1)),
        "tile_key_text": _with(["dem"], f"""SELECT tile_lat || '#' || tile_lon || '#' || zoom || '#' || x || '#' || y
            AS key, tile_lat, tile_lon, zoom AS key_zoom, x AS key_x, y AS key_y
            FROM (SELECT DISTINCT zoom, {_TILE}, {_corner('(gy >> 8)', 'zoom', 90)} AS tile_lat,
                  {_corner('(gx >> 8)', 'zoom', 180)} AS tile_lon FROM located)""", located=_points_at(MAX_ZOOM)),
        "geohash_points": _with(["dem"], "SELECT point_id, " + ", ".join(
            f"{_geohash('lat', 'lon', n)} AS geohash{n}" for n in (6, 8, 10)) + " FROM dem"),
        "geohash_decode": _with(["dem"], f"""SELECT point_id, {_geohash('lat', 'lon', 8)} AS geohash,
            ROUND((CAST({_bits('lat', 'lon', 8)[2]} AS DOUBLE) + 0.5) * CAST({180 / 2**20!r} AS DOUBLE) - 90, 9) AS lat,
            ROUND((CAST({_bits('lat', 'lon', 8)[1]} AS DOUBLE) + 0.5) * CAST({360 / 2**20!r} AS DOUBLE) - 180, 9) AS lon
            FROM dem"""),
        "geohash_groups": _with(["dem"], f"""SELECT {_geohash('lat', 'lon', 8)} AS geohash, COUNT(*) AS n,
            MIN(height) AS min_height, MAX(height) AS max_height, ROUND(AVG(height), 6) AS mean_height
            FROM dem GROUP BY 1"""),
        "pixel_max": _with(["dem"], f"SELECT zoom, {_TILE}, alt FROM ({_MAX})", located=_points_at(PIXEL_ZOOM)),
        "tile_pixels": _with(["dem"], f"SELECT zoom, {_TILE}, alt FROM ({_MAX})", located=_points_at(MAX_ZOOM)),
        "pixel_argmax": _with(["dem"], f"""SELECT zoom, {_TILE}, lat, lon, height FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY gx, gy ORDER BY height DESC, lat, lon) AS rank FROM located)
            WHERE rank = 1""", located=_points_at(PIXEL_ZOOM)),
        "pixel_mean": _with(["dem"], f"""SELECT zoom, {_TILE}, CAST(SUM(height) AS BIGINT) AS total, COUNT(*) AS n,
            CAST(TRUNC(SUM(height) / COUNT(*)) AS INTEGER) AS alt FROM located GROUP BY zoom, gx, gy""",
            located=_points_at(PIXEL_ZOOM)),
        "cell_mean": _with(["dem"], """SELECT zoom, gx, gy, CAST(SUM(height) AS BIGINT) AS total, COUNT(*) AS n,
            CAST(TRUNC(SUM(height) / COUNT(*)) AS INTEGER) AS alt FROM located GROUP BY zoom, gx, gy""",
            located=_points_at(MEAN_ZOOM, side=1)),
        "pyramid_mean": _with(["dem"], """SELECT zoom, gx, gy, CAST(SUM(height) AS BIGINT) AS total, COUNT(*) AS n,
            CAST(TRUNC(SUM(height) / COUNT(*)) AS INTEGER) AS alt FROM located GROUP BY zoom, gx, gy""",
            located=_points_all(MEAN_ZOOM, side=1)),
        "tile_blob": _with(["dem"], """SELECT zoom, geohash, tile_x, tile_y,
            CAST(octet_length(tile) AS INTEGER) AS n_bytes, md5(tile) AS digest FROM tiles""", **_PACKED),
        "tile_blob_dense": _with(["dense"], """SELECT zoom, geohash, tile_x, tile_y,
            CAST(octet_length(tile) AS INTEGER) AS n_bytes, md5(tile) AS digest FROM tiles""", **_DENSE),
        "stored_tile_lookup": _with(["dense"], """SELECT request_id, a.zoom, tile_x, tile_y, geohash, md5(tile) AS digest
            FROM asked a JOIN tiles t USING (zoom, tile_x, tile_y)""", **_DENSE, asked="""
            SELECT point_id AS request_id, zoom, {} AS tile_x, {} AS tile_y
            FROM (SELECT *, CAST(point_id % 11 AS INTEGER) AS zoom FROM dense)""".format(*_pixel("zoom", 1))),
        "tile_rgba_stored": _with(["dense"], """SELECT zoom, geohash, tile_x, tile_y,
            CAST(octet_length(raster) AS INTEGER) AS n_bytes, md5(raster) AS digest FROM rasters""",
            located=_DENSE["located"], **_RGBA),
        "stored_key_lookup": _with(["dense"], """SELECT request_id, a.zoom, a.tile_x, a.tile_y, geohash, md5(tile) AS digest
            FROM asked a LEFT JOIN tiles t USING (zoom, tile_x, tile_y)""", **_DENSE, asked="""
            SELECT point_id AS request_id, zoom, {} AS tile_x, CAST({} + zoom % 2 AS INTEGER) AS tile_y
            FROM (SELECT *, CAST(point_id % 11 AS INTEGER) AS zoom FROM dense)""".format(*_pixel("zoom", 1))),
        "stored_tiles_in_boxes": _with(["dense", "v_near"], """SELECT request_id, zoom, geohash, md5(tile) AS digest
            FROM cover JOIN tiles USING (zoom, tile_x, tile_y)""", **_DENSE, **_cover("zoom", "v_near")),
        "visit_tiles_merged": _with(["dense_gps"], "SELECT zoom, gx, gy, COUNT(*) AS n FROM located GROUP BY ALL",
                                    located=_points_all(MAX_ZOOM, source="dense_gps")),
        "visit_tile_peaks": _with(["dense_gps"], """SELECT zoom, MAX(n) AS peak
            FROM (SELECT zoom, gx, gy, COUNT(*) AS n FROM located GROUP BY ALL) GROUP BY zoom""",
            located=_points_all(MAX_ZOOM, source="dense_gps")),
        "tile_unpack_dense": _with(["dense"], f"SELECT zoom, {_TILE}, alt FROM ({_MAX})", located=_DENSE["located"]),
        "pyramid_size_dense": _with(["dense"], """SELECT zoom, COUNT(*) AS n_tiles,
            CAST(SUM(octet_length(tile)) AS BIGINT) AS n_bytes, CAST(2 * POW(4, zoom) AS BIGINT) AS full_tiles,
            CAST(2 * 2 * 256 * 256 * POW(4, zoom) AS BIGINT) AS full_bytes FROM tiles GROUP BY zoom""", **_DENSE),
        "tiles_roundtrip": _with(["dem"], """SELECT zoom, geohash, tile_x, tile_y, md5(tile) AS digest
            FROM tiles""", **_PACKED),
        "tile_unpack": _with(["dem"], f"SELECT zoom, {_TILE}, alt FROM ({_MAX})", located=_points_all(TILE_ZOOM)),
        "pyramid_size": _with(["dem"], """SELECT zoom, COUNT(*) AS n_tiles,
            CAST(SUM(octet_length(tile)) AS BIGINT) AS n_bytes, CAST(2 * POW(4, zoom) AS BIGINT) AS full_tiles,
            CAST(2 * 2 * 256 * 256 * POW(4, zoom) AS BIGINT) AS full_bytes FROM tiles GROUP BY zoom""", **_PACKED),
        "tile_rgba": _with(["dem"], """SELECT zoom, geohash, tile_x, tile_y,
            CAST(octet_length(raster) AS INTEGER) AS n_bytes, md5(raster) AS digest FROM rasters""",
            located=_PACKED["located"], **_RGBA),
        "tiles_sorted": _with(["dem"], """SELECT zoom, geohash, tile_x, tile_y, n_pixels, min_alt, max_alt
            FROM tiles ORDER BY zoom, geohash""", **_STORE),
        "decode_hgt": _with(["v_dem"], "SELECT ROUND(lat, 9) AS lat, ROUND(lon, 9) AS lon, height FROM tops",
                            **_hgt_points()),
        "hgt_files_roundtrip": _with(["dense"], "SELECT ROUND(lat, 9) AS lat, ROUND(lon, 9) AS lon, height FROM tops",
                                     **_hgt_points(1201, "dense")),
        "hgt_to_text": _with(["v_dem"], "SELECT printf('%.10g,%.10g,%d', lat, lon, height) AS line FROM tops",
                             **_hgt_points()),
        "dem_text_roundtrip": _with(["v_dem"], "SELECT lat, lon, height FROM v_dem"),
        "gps_pixel_centroid": _with(["v_gps"], f"""SELECT zoom, {_TILE}, COUNT(*) AS n,
            ROUND(AVG(lat), 9) AS lat, ROUND(AVG(lon), 9) AS lon FROM located GROUP BY zoom, gx, gy""",
            located=_points_at(PIXEL_ZOOM, "v_gps")),
        "gps_dedupe": _with(["v_gps"], "SELECT lat, lon, COUNT(*) AS n FROM v_gps GROUP BY lat, lon"),
        "gps_heat": _with(["v_gps"], f"""SELECT zoom, {_TILE}, n,
            CAST(n AS DOUBLE) / CAST(MAX(n) OVER (PARTITION BY zoom) AS DOUBLE) AS heat
            FROM (SELECT zoom, gx, gy, COUNT(*) AS n FROM located GROUP BY ALL)""", located=_points_at(PIXEL_ZOOM, "v_gps")),
        "points_upsert": _with(["v_gps"], f"""SELECT geohash, value FROM (
            SELECT {_geohash('lat', 'lon', 6)} AS geohash, CAST(TRUNC(lat + lon) AS INTEGER) AS value,
                   ROW_NUMBER() OVER (PARTITION BY {_geohash('lat', 'lon', 6)} ORDER BY point_id DESC) AS rank
            FROM v_gps) WHERE rank = 1"""),
        "gps_text_export": _with(["v_gps"], f"""SELECT zoom || ',' || tile_x || ',' || tile_y || ',' || x || ',' || y
            || ',' || n AS line FROM (SELECT zoom, {_TILE}, COUNT(*) AS n FROM located GROUP BY zoom, gx, gy)""",
            located=_points_at(PIXEL_ZOOM, "v_gps")),
        "cities_clean": _with(["cities"], "SELECT * FROM cities"),
        "cities_keep_missing": _with(["v_cities"], """SELECT UPPER(country) AS country, region, accent_city AS city,
            population, lat, lon FROM v_cities"""),
        "cities_wide": _with(["v_cities"], """SELECT country, city, accent_city, region,
            CAST(COALESCE(population, 0) AS INTEGER) AS population, lat, lon FROM v_cities"""),
        "regions_clean": _with(["v_regions"], "SELECT * FROM v_regions"),
        "region_hex_code": _with(["v_regions"], """SELECT *,
            (CASE WHEN region LIKE 'A%' THEN 160 ELSE 0 END) + CAST(SUBSTR(region, 2) AS INTEGER) AS code
            FROM v_regions"""),
        "city_region_join": _with(["joined"], "SELECT * FROM joined"),
        "city_by_geohash": _with(["joined"], _CITY_BEST, keyed=_CITY_KEYED),
        "city_cells_wide": _with(["joined"], _CITY_BEST, keyed=_CITY_KEYED),
        "city_cells": _with(["joined"], """SELECT geohash, 'C' AS qualifier, country AS value FROM best UNION ALL
            SELECT geohash, 'c', city FROM best UNION ALL
            SELECT geohash, 'p', CAST(population AS VARCHAR) FROM best""", keyed=_CITY_KEYED, best=_CITY_BEST),
        "height_stats": _with(["v_dem"], _summary("height", "v_dem")),
        "gps_lon_stats": _with(["v_gps"], _summary("lon", "v_gps")),
        "height_stats_sample": _with(["v_dem"], _summary("height", f"v_dem WHERE {_SAMPLED}")),
        "gps_lon_stats_sample": _with(["v_gps"], _summary("lon", f"v_gps WHERE {_SAMPLED}")),
        "height_histogram_edges": _histogram("v_dem", "v_dem", "height"),
        "gps_lon_histogram_edges": _histogram("v_gps", "v_gps", "lon"),
        "height_histogram_auto": _histogram_auto("v_dem", "height"),
        "gps_lon_histogram_auto": _histogram_auto("v_gps", "lon"),
        "viewport_cover": _with(["view_zoom"], "SELECT * FROM cover", **_cover("best", "view_zoom")),
        "tiles_in_bbox": _with(["dem", "view_zoom"], """SELECT request_id, zoom, geohash, n_pixels, max_alt
            FROM cover JOIN tiles USING (zoom, tile_x, tile_y)""",
            **_STORE, **_cover(f"LEAST(best, {STORE_ZOOM})", "view_zoom")),
        "tile_lookup": _with(["dem", "v_requests"], """SELECT request_id, r.zoom, r.tile_x, r.tile_y, geohash,
            md5(tile) AS digest FROM wanted r LEFT JOIN tiles USING (zoom, tile_x, tile_y)""",
            wanted=f"SELECT *, {_pixel('zoom', 1)[0]} AS tile_x, {_pixel('zoom', 1)[1]} AS tile_y FROM v_requests",
            **_PACKED),
        "viewport_missing": _with(["dem", "view_zoom"], """SELECT * FROM cover c WHERE NOT EXISTS (
            SELECT 1 FROM tiles t WHERE t.zoom = c.zoom AND t.tile_x = c.tile_x AND t.tile_y = c.tile_y)""",
            **_STORE, **_cover("best", "view_zoom")),
        "tiles_visible": _with(["dem"], f"""SELECT zoom, geohash, tile_x, tile_y, n_pixels, min_alt, max_alt
            FROM (SELECT *, {_corner('tile_y', 'zoom', 90)} AS s, {_corner('tile_x', 'zoom', 180)} AS w,
                  CAST(180 AS DOUBLE) / POW(2, zoom) AS step FROM tiles)
            WHERE zoom >= 2 AND w <= 60 AND w + step >= -20 AND s <= 45 AND s + step >= -10
            ORDER BY zoom, geohash""", **_STORE),
        "key_search": _with(["dem"], """SELECT geohash, zoom, COUNT(*) OVER () AS n_hits FROM tiles
            WHERE regexp_matches(geohash, 's[0-9].*0') ORDER BY geohash, zoom LIMIT 1000""", **_STORE),
        "hot_tiles": _with(["view_zoom"], """SELECT zoom, tile_x, tile_y, COUNT(*) AS n_requests FROM cover
            GROUP BY ALL ORDER BY n_requests DESC, zoom, tile_x, tile_y LIMIT 200""",
            **_cover("best", "view_zoom")),
        "pixel_colour_custom": _pixel_colour("own"),
        "sample_bernoulli_summary": """SELECT COUNT(*) > 0 AS share_ok, CAST(0 AS BIGINT) AS n_repeats,
            CAST(0 AS BIGINT) AS n_strangers FROM lineitem""",
        "odd_lines_bounded": _with(["dem"], "SELECT lat, lon, height FROM dem WHERE point_id % 11 > 6"),
        "odd_gps_bounded": _with(["v_gps", "v_dem"], "SELECT lat, lon FROM v_dem WHERE point_id % 11 IN (4, 6, 7, 8, 9, 10)"),
        "points_merge": _with(["v_gps"], f"""SELECT geohash, value FROM (
            SELECT {_geohash('lat', 'lon', 6)} AS geohash, CAST(TRUNC(lat + lon) AS INTEGER) AS value,
                   ROW_NUMBER() OVER (PARTITION BY {_geohash('lat', 'lon', 6)} ORDER BY point_id % 2 DESC, point_id DESC) AS rank
            FROM v_gps) WHERE rank = 1"""),
        "visit_pyramid": _with(["v_gps"], "SELECT zoom, gx, gy, COUNT(*) AS n FROM located GROUP BY ALL",
                               located=_points_all(MAX_ZOOM, source="v_gps")),
        "pixel_colour_gps": _pixel_colour("gps"),
        "pixel_colour_rainbow": _pixel_colour("rainbow"),
        "pixel_colour_hotmap": _pixel_colour("hotmap"),
        "pyramid_mean_of_means": _mean_of_means(),
    }
    # The same results by other ways.
    out["tiles_rollup"] = out["tiles_incremental"] = out["tile_blob_dense"]
    out["stored_points_upsert"] = out["points_merge"]
    every_zoom = _with(["dem"], _MAX, located=_points_all(MAX_ZOOM))
    for name in ("pyramid_max", "pyramid_by_level", "pyramid_fanout", "pixels_all_zooms"):
        out[name] = every_zoom
    return out


def _mean_of_means() -> str:
    top = MEAN_ZOOM
    levels = {f"level{top}": f"""SELECT zoom, gx, gy, CAST(TRUNC(SUM(height) / COUNT(*)) AS INTEGER) AS alt
        FROM located GROUP BY zoom, gx, gy"""}
    for z in range(top - 1, -1, -1):
        levels[f"level{z}"] = f"""SELECT CAST({z} AS INTEGER) AS zoom, gx >> 1 AS gx, gy >> 1 AS gy,
            CAST(TRUNC(SUM(alt) / COUNT(*)) AS INTEGER) AS alt FROM level{z + 1} GROUP BY 1, 2, 3"""
    union = " UNION ALL ".join(f"SELECT * FROM level{z}" for z in range(top + 1))
    return _with(["dem"], union, located=_points_at(top, side=1), **levels)
