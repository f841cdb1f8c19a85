"""DuckDB SQL for the registered queries, written apart from the library's plans."""

from __future__ import annotations

DET = """det AS (
  SELECT o_orderkey AS id, (o_custkey * 7919) % 36000 - 18000 + (o_orderkey * 17) % 7 AS lon_c,
    (o_custkey * 104729) % 18000 - 9000 + (o_orderkey * 31) % 7 AS lat_c, (o_orderkey * 31337) % 1000 AS score_m,
    (o_orderkey * 613) % 500 AS area_c, 1 + (o_orderkey * 17) % 50 AS half_c, o_orderstatus AS model_version,
    ((o_orderkey * 31337) % 1000) / 1000.0::DOUBLE AS score FROM orders)"""
SITES = """sites AS (
  SELECT s_suppkey AS site_id, (s_suppkey * 7919) % 36000 - 18000 AS lon_c, (s_suppkey * 104729) % 18000 - 9000 AS lat_c,
    1 + s_suppkey % 5 AS buffer_km FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""
SCENES = """scenes AS (
  SELECT event_id AS scene_id, CASE WHEN event_id % 5 = 0 THEN 'sentinel-1' ELSE 'sentinel-2' END AS sensor, ts,
    CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_id * 37 % 100 END AS cloud_cover,
    (user_id * 7919) % 340 - 170 AS x0, (user_id * 104729) % 160 - 80 AS y0 FROM events)"""
OBS = """obs AS (
  SELECT CAST(0 AS BIGINT) AS raster_id, CAST(l_partkey % 64 AS INT) AS "row", CAST(l_suppkey % 64 AS INT) AS col, l_linenumber AS t,
    CAST(l_orderkey % 97 AS DOUBLE) AS blue, CAST((l_orderkey * 31) % 10000 AS DOUBLE) AS green,
    CAST((l_orderkey * 17 + l_linenumber) % 10000 AS DOUBLE) AS red, CAST((l_partkey * 13 + l_linenumber * 7) % 10000 AS DOUBLE) AS nir,
    CAST((l_suppkey * 29 + l_orderkey) % 10000 AS DOUBLE) AS swir16, CAST((l_orderkey * 7) % 10000 AS DOUBLE) AS swir22,
    CAST((l_orderkey + l_linenumber) % 12 AS INT) AS scl FROM lineitem)"""
BANDS = ("blue", "green", "red", "nir", "swir16", "swir22")
MED = OBS + ",\nmed AS (SELECT raster_id, \"row\", col, " + ", ".join(f"median({b}) AS {b}" for b in BANDS) + ' FROM obs GROUP BY raster_id, "row", col)'
CHIPS = """chips AS (
  SELECT vec_id AS raster_id, CAST((pos - 1) // 8 AS INT) AS "row", CAST((pos - 1) % 8 AS INT) AS col, CAST(embedding[pos] AS DOUBLE) AS value
  FROM embeddings, (SELECT unnest(generate_series(1, 64)) AS pos)),
on_px AS (SELECT *, raster_id * 64 + "row" * 8 + col AS n FROM chips WHERE value >= 0.1)"""
LABELS = CHIPS + """,
reach(n, m) AS (
  SELECT n, n FROM on_px
  UNION
  SELECT r.n, b.n FROM reach r JOIN on_px a ON a.n = r.m JOIN on_px b ON b.raster_id = a.raster_id AND abs(a."row" - b."row") + abs(a.col - b.col) = 1),
label AS (SELECT n, min(m) AS component FROM reach GROUP BY n)"""
#: The parcels' edges: stars of eight corners, and the holes of every second one.
PARCELS = """hub AS (SELECT s_suppkey AS id, 6 + s_suppkey * 29 % 52 AS cx, 6 + s_suppkey * 47 % 52 AS cy FROM supplier),
corner AS (SELECT id, 0 AS ring, k, cx + dx * (2 + (id * (k + 3) * 7) % 4) AS x, cy + dy * (2 + (id * (k + 3) * 7) % 4) AS y
    FROM hub, (VALUES (0, 1, 0), (1, 1, 1), (2, 0, 1), (3, -1, 1), (4, -1, 0), (5, -1, -1), (6, 0, -1), (7, 1, -1)) AS t(k, dx, dy)
  UNION ALL SELECT id, 1, k, cx + dx, cy + dy FROM hub, (VALUES (0, 0, 1), (1, 1, 0), (2, 0, -1), (3, -1, 0)) AS t(k, dx, dy) WHERE id % 2 = 0),
edge AS (SELECT p.id, p.x::DOUBLE AS x0, p.y::DOUBLE AS y0, q.x::DOUBLE AS x1, q.y::DOUBLE AS y1 FROM corner p
  JOIN corner q ON q.id = p.id AND q.ring = p.ring AND q.k = (p.k + 1) % CASE p.ring WHEN 0 THEN 8 ELSE 4 END)"""
#: Greedy choice in each heap, in the order of ``o`` (id, heap, place k, ids of its neighbours).
GREEDY = """turn(heap, k, kept) AS (
  SELECT DISTINCT heap, 0::BIGINT, []::BIGINT[] FROM o
  UNION ALL
  SELECT t.heap, o.k, CASE WHEN list_has_any(t.kept, o.ids) THEN t.kept ELSE list_append(t.kept, o.id) END FROM turn t JOIN o ON o.heap = t.heap AND o.k = t.k + 1),
stays AS (SELECT unnest(arg_max(kept, k)) AS id FROM turn GROUP BY heap)"""
LOGITS = """x AS (SELECT event_id, event_type, (event_id * 37 % 2000 - 1000) / 250.0::DOUBLE AS logit,
  CASE WHEN event_id * 13 % 7 < 3 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS target FROM events)"""


def _far(x: str, y: str, e: str) -> str:
    """Square of the distance from a point to an edge."""
    dx, dy = f"({e}x1 - {e}x0)", f"({e}y1 - {e}y0)"
    t = f"greatest(0, least(1, (({x} - {e}x0) * {dx} + ({y} - {e}y0) * {dy}) / ({dx} * {dx} + {dy} * {dy})))"
    return f"(pow({x} - {e}x0 - {t} * {dx}, 2) + pow({y} - {e}y0 - {t} * {dy}, 2))"


def _stretch(b: str, lo: str, hi: str) -> str:
    return f"CASE WHEN {hi} - {lo} < 1e-8 THEN 0.0::DOUBLE ELSE greatest(0.0, least(1.0, ({b} - {lo}) / ({hi} - {lo}))) END"


def _tiles(edge: int = 64, tile: int = 16, step: int = 12) -> str:
    return f"""offs AS (SELECT CAST(k * {step} AS INT) AS o FROM (SELECT unnest(generate_series(0, {(edge - tile) // step})) AS k)),
tiled AS (SELECT m.*, a.o AS row_off, b.o AS col_off FROM med m
  JOIN offs a ON m."row" >= a.o AND m."row" < a.o + {tile} JOIN offs b ON m.col >= b.o AND m.col < b.o + {tile})"""


_nd = lambda a, b: f"(({a}) - ({b})) / (({a}) + ({b}) + 1e-8)"
INDEX = {
    "ndvi": _nd("nir", "red"),
    "ndwi": _nd("green", "nir"),
    "ndbi": _nd("swir16", "nir"),
    "bsi": _nd("swir16 + red", "nir + blue"),
}
INFER = (
    MED + ",\n" + _tiles() + ",\nlim AS (SELECT row_off, col_off, "
    + ", ".join(f"quantile_cont({b}, 0.02) AS {b}_lo, quantile_cont({b}, 0.98) AS {b}_hi" for b in BANDS)
    + ' FROM tiled GROUP BY row_off, col_off),\nst AS (SELECT t.raster_id, t."row", t.col, '
    + ", ".join(f"{_stretch('t.' + b, 'l.' + b + '_lo', 'l.' + b + '_hi')} AS {b}" for b in BANDS)
    + " FROM tiled t JOIN lim l USING (row_off, col_off)),\nlg AS (SELECT raster_id, \"row\", col, "
    + f"-0.5 + 2.0 * {INDEX['ndbi']} + 1.5 * {INDEX['bsi']} - 1.0 * {INDEX['ndvi']} + swir22 AS z FROM st),\n"
    + 'av AS (SELECT raster_id, "row", col, avg(1.0 / (1.0 + exp(-z))) AS prob FROM lg GROUP BY raster_id, "row", col),\n'
    + 'prob AS (SELECT m.raster_id, m."row", m.col, coalesce(a.prob, 0.0) AS prob FROM med m LEFT JOIN av a USING (raster_id, "row", col))'
)


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["spectral_indices"] = f'WITH {OBS} SELECT "row", col, ' + ", ".join(f"round(sum({e}), 6) AS {n}" for n, e in INDEX.items()) + ' FROM obs GROUP BY "row", col'
    clear = "scl IN (4, 5, 6, 7)"
    q["cloud_mask"] = f"WITH {OBS} SELECT scl, count(*) AS n, sum(CASE WHEN {clear} THEN blue ELSE 0 END) AS blue, sum(CASE WHEN {clear} THEN nir ELSE 0 END) AS nir FROM obs GROUP BY scl"
    q["temporal_median"] = f"WITH {MED} SELECT * FROM med"
    q["temporal_mean"] = f'WITH {OBS} SELECT raster_id, "row", col, ' + ", ".join(f"round(avg({b}), 6) AS {b}" for b in BANDS) + ' FROM obs GROUP BY raster_id, "row", col'
    q["masked_median"] = f'WITH {OBS} SELECT "row", col, median(red) FILTER (WHERE {clear}) AS red, median(nir) FILTER (WHERE {clear}) AS nir FROM obs GROUP BY "row", col'
    lim = ", ".join(f"quantile_cont({b}, 0.02) AS {b}_lo, quantile_cont({b}, 0.98) AS {b}_hi" for b in BANDS)
    q["percentile_stretch"] = f'WITH {MED}, lim AS (SELECT {lim} FROM med) SELECT raster_id, "row", col, ' + ", ".join(f"round({_stretch(b, b + '_lo', b + '_hi')}, 6) AS {b}" for b in BANDS) + " FROM med, lim"
    rasters = "r AS (SELECT s_suppkey AS raster_id, 200 + s_suppkey * 37 % 900 AS h, 200 + s_suppkey * 53 % 900 AS w FROM supplier), k AS (SELECT unnest(generate_series(0, 10)) * 192 AS o), win AS (SELECT raster_id, a.o AS row_off, b.o AS col_off FROM r JOIN k a ON a.o + 256 <= h JOIN k b ON b.o + 256 <= w)"
    q["tile_grid"] = f"""WITH {rasters} SELECT r.raster_id, count(row_off) AS tiles,
      CASE WHEN min(h) < 256 OR min(w) < 256 THEN 0 ELSE ((min(h) - 256) // 192 + 1) * ((min(w) - 256) // 192 + 1) END AS formula,
      CAST(max(row_off) AS INT) AS last_row, CAST(max(col_off) AS INT) AS last_col FROM r LEFT JOIN win USING (raster_id) GROUP BY r.raster_id"""
    q["tile_batches"] = f"WITH {rasters}, nth AS (SELECT raster_id, row_number() OVER (PARTITION BY raster_id ORDER BY row_off, col_off) - 1 AS n FROM win) SELECT raster_id, n // 8 AS batch, count(*) AS tiles FROM nth GROUP BY raster_id, n // 8"
    q["chip_valid"] = f"""WITH {MED}, {_tiles()}, v AS (SELECT row_off, col_off,
        count(*) FILTER (WHERE NOT (("row" * 7 + col * 11) % 3 = 0 OR "row" > 40) AND blue <> 0) / 256.0::DOUBLE AS valid FROM tiled GROUP BY row_off, col_off)
      SELECT CAST(0 AS BIGINT) AS raster_id, 'tile_' || col_off || '_' || row_off AS tile_id, row_off, col_off, valid, 500.0::DOUBLE + 10 * col_off AS xmin,
        9000.0::DOUBLE - 10 * row_off - 160 AS ymin, 660.0::DOUBLE + 10 * col_off AS xmax, 9000.0::DOUBLE - 10 * row_off AS ymax FROM v WHERE valid >= 0.5"""
    q["overlap_average"] = f"""WITH {MED}, {_tiles()}, a AS (SELECT "row", col, avg(nir * (1 + row_off + 2 * col_off) / 1000.0::DOUBLE) AS p FROM tiled GROUP BY "row", col)
      SELECT m.raster_id, m."row", m.col, round(coalesce(a.p, 0.0), 6) AS prob FROM med m LEFT JOIN a USING ("row", col)"""
    q["sigmoid_threshold"] = f"WITH {LOGITS} SELECT event_id, round(1.0 / (1.0 + exp(-logit)), 6) AS prob FROM x WHERE 1.0 / (1.0 + exp(-logit)) >= 0.7"
    q["site_buffer_semi"] = f"""WITH {DET}, {SITES} SELECT id, EXISTS (SELECT 1 FROM sites s WHERE
        pow(greatest(d.lon_c - d.half_c - s.lon_c, 0, s.lon_c - d.lon_c - d.half_c), 2) + pow(greatest(d.lat_c - d.half_c - s.lat_c, 0, s.lat_c - d.lat_c - d.half_c), 2)
          <= pow(s.buffer_km * 20, 2)) AS is_positive FROM det d"""
    q["rasterize_labels"] = f"""WITH {OBS}, {SITES}, px AS (SELECT DISTINCT "row", col FROM obs) SELECT "row", col, CASE WHEN EXISTS (SELECT 1 FROM sites
        WHERE pow(col * 2 + 1 - site_id * 37 % 128, 2) + pow("row" * 2 + 1 - site_id * 53 % 128, 2) <= pow(buffer_km, 2)) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label FROM px"""
    near = "pow(d.lon_c - s.lon_c, 2) + pow(d.lat_c - s.lat_c, 2)"
    q["recall_at_k"] = f"""WITH {DET}, {SITES}, top AS (SELECT * FROM det ORDER BY score DESC, id LIMIT 2000),
      m AS (SELECT count(*) AS matched FROM sites s WHERE EXISTS (SELECT 1 FROM top d WHERE {near} < pow(200, 2)))
      SELECT (SELECT count(*) FROM sites) AS sites, matched, round(matched / (SELECT count(*) FROM sites)::DOUBLE, 6) AS recall FROM m"""
    q["fp_rate"] = f"""WITH {DET}, {SITES}, f AS (SELECT count(*) AS n FROM det d WHERE NOT EXISTS (SELECT 1 FROM sites s WHERE {near} < 250000))
      SELECT n AS false_positives, round(n / 1234.0::DOUBLE, 6) AS per_1000_km2 FROM f"""
    q["calibration"] = f"""WITH {DET}, {SITES}, bins AS (SELECT CAST(i AS INT) AS bin, i * 0.1::DOUBLE AS lo, (i + 1) * 0.1::DOUBLE AS hi FROM (SELECT unnest(generate_series(0, 9)) AS i)),
      f AS (SELECT d.score, EXISTS (SELECT 1 FROM sites s WHERE {near} < 250000) AS tp FROM det d)
      SELECT bin, round(lo, 6) AS lo, round(hi, 6) AS hi, count(score) AS count, round(coalesce(avg(tp::INT), 0.0), 6) AS accuracy,
        round(coalesce(avg(score), (bin + 0.5) * 0.1), 6) AS confidence FROM bins LEFT JOIN f ON score >= lo AND score < hi GROUP BY bin, lo, hi"""
    q["segmentation_loss"] = f"""WITH {LOGITS}, y AS (SELECT *, 1 / (1 + exp(-logit)) AS p, target * 0.95 + 0.025 AS t FROM x),
      z AS (SELECT *, greatest(logit, 0) - logit * t + ln(1 + exp(-abs(logit))) AS bce, p * t + (1 - p) * (1 - t) AS pt FROM y),
      a AS (SELECT event_type, avg((0.25 * t + 0.75 * (1 - t)) * pow(1 - pt, 2) * bce) AS focal, 1 - (2 * sum(p * target) + 1e-6) / (sum(p) + sum(target) + 1e-6) AS dice FROM z GROUP BY event_type)
      SELECT event_type, round(focal, 6) AS focal, round(dice, 6) AS dice, round(focal + 0.5 * dice, 6) AS combined FROM a"""
    q["prf1"] = f"""WITH {LOGITS}, c AS (SELECT event_type, count(*) FILTER (WHERE logit > 0 AND target = 1) AS tp, count(*) FILTER (WHERE logit > 0 AND target = 0) AS fp,
        count(*) FILTER (WHERE logit <= 0 AND target = 1) AS fn FROM x GROUP BY event_type)
      SELECT *, round(tp / (tp + fp)::DOUBLE, 6) AS "precision", round(tp / (tp + fn)::DOUBLE, 6) AS recall, round(2 * tp / (2 * tp + fp + fn)::DOUBLE, 6) AS f1 FROM c"""
    q["auroc"] = f"""WITH {LOGITS}, g AS (SELECT logit, count(*) FILTER (WHERE target = 1) AS pos, count(*) FILTER (WHERE target = 0) AS neg FROM x GROUP BY logit),
      w AS (SELECT pos, neg, sum(neg) OVER (ORDER BY logit) - neg AS below FROM g)
      SELECT round(sum(pos * (below + neg / 2.0::DOUBLE)) / (sum(pos) * sum(neg))::DOUBLE, 6) AS auroc FROM w"""
    q["latency_percentiles"] = "SELECT event_type, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99 FROM events GROUP BY event_type"
    q["composite_score"] = f"""WITH {DET}, g AS (SELECT id, score, area_c / 100.0::DOUBLE AS area, 2 * half_c / 10.0::DOUBLE AS w, (half_c + 3) / 10.0::DOUBLE AS h FROM det),
      c AS (SELECT id, score, 4 * pi() * w * h / pow(2 * (w + h), 2) AS c, 1 - least(abs(area - 2.0) / 2.0, 1.0) AS a FROM g)
      SELECT id, round(c, 6) AS compactness, round(a, 6) AS area_score, round(0.6 * score + 0.2 * c + 0.2 * a, 6) AS final FROM c"""
    q["components_8x8"] = f"WITH RECURSIVE {LABELS} SELECT raster_id, component, count(*) AS area_px, round(avg(value), 6) AS mean_value FROM on_px JOIN label USING (n) GROUP BY raster_id, component"
    q["region_features"] = f"""WITH RECURSIVE {LABELS}, s AS (SELECT a.*, l.component,
        2 - (SELECT count(*) FROM on_px b WHERE b.raster_id = a.raster_id AND b.col = a.col AND abs(b."row" - a."row") = 1) AS lev,
        2 - (SELECT count(*) FROM on_px b WHERE b.raster_id = a.raster_id AND b."row" = a."row" AND abs(b.col - a.col) = 1) AS upr FROM on_px a JOIN label l USING (n)),
      g AS (SELECT raster_id, component, count(*) AS area_px, avg(value) AS mean_value, sum(lev) * 10.0::DOUBLE + sum(upr) * 20.0::DOUBLE AS perimeter,
        100 + 10 * (avg(col) + 0.5) AS cx, 900 - 20 * (avg("row") + 0.5) AS cy, 100.0::DOUBLE + 10 * min(col) AS xmin, 900.0::DOUBLE - 20 * (max("row") + 1) AS ymin,
        110.0::DOUBLE + 10 * max(col) AS xmax, 900.0::DOUBLE - 20 * min("row") AS ymax FROM s GROUP BY raster_id, component HAVING count(*) >= 3)
      SELECT raster_id, component, area_px, round(mean_value, 6) AS mean_value, perimeter, round(cx, 6) AS centroid_x, round(cy, 6) AS centroid_y, xmin, ymin, xmax, ymax,
        area_px * 200.0::DOUBLE AS area, round(4 * pi() * area_px * 200 / (perimeter * perimeter), 6) AS compactness FROM g"""
    q["rasterize_outlines"] = f'WITH RECURSIVE {LABELS} SELECT raster_id, component, "row", col FROM on_px JOIN label USING (n)'
    # even-odd rule: crossings to the right of a point
    cross = lambda x, y: f"(least(y0, y1) <= {y} AND {y} < greatest(y0, y1) AND x0 + ({y} - y0) * (x1 - x0) / (y1 - y0) > {x})"
    q["rasterize_parcels"] = f"""WITH {OBS}, {PARCELS}, px AS (SELECT DISTINCT "row", col FROM obs),
      hit AS (SELECT "row", col FROM px, edge WHERE {cross("col + 0.5::DOUBLE", '63.5::DOUBLE - "row"')} GROUP BY "row", col, id HAVING count(*) % 2 = 1)
      SELECT "row", col, CASE WHEN ("row", col) IN (SELECT ("row", col) FROM hit) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label FROM px"""
    q["parcels_of_points"] = f"""WITH {PARCELS}, p AS (SELECT o_orderkey AS point_id, (o_orderkey * 37 % 6400) / 100.0::DOUBLE + 0.005::DOUBLE AS x, (o_custkey * 53 % 6400) / 100.0::DOUBLE + 0.005::DOUBLE AS y FROM orders)
      SELECT point_id, id FROM p, edge WHERE {cross("x", "y")} GROUP BY point_id, id HAVING count(*) % 2 = 1"""
    both = "greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0))"
    q["box_overlay"] = f"""WITH {DET}, bx AS (SELECT id, lon_c - half_c AS x0, lat_c - half_c AS y0, lon_c + half_c AS x1, lat_c + half_c AS y1 FROM det),
      m AS (SELECT a.id AS a, b.id AS b, ({both})::DOUBLE AS common, ((a.x1 - a.x0) * (a.y1 - a.y0))::DOUBLE AS area_a, ((b.x1 - b.x0) * (b.y1 - b.y0))::DOUBLE AS area_b
        FROM bx a JOIN bx b ON b.x0 BETWEEN a.x0 - 102 AND a.x0 + 102 AND a.id < b.id)
      SELECT a, b, common, area_a, area_b, round(common / (area_a + area_b - common), 6) AS iou FROM m WHERE common > 0"""
    q["parcel_distances"] = f"""WITH {PARCELS},
      n AS (SELECT a.id AS a, b.id AS b, a.x0 AS ax0, a.y0 AS ay0, a.x1 AS ax1, a.y1 AS ay1, b.x0 AS bx0, b.y0 AS by0, b.x1 AS bx1, b.y1 AS by1 FROM edge a JOIN edge b ON a.id < b.id),
      s AS (SELECT a, b, CASE WHEN sign((ax1 - ax0) * (by0 - ay0) - (ay1 - ay0) * (bx0 - ax0)) * sign((ax1 - ax0) * (by1 - ay0) - (ay1 - ay0) * (bx1 - ax0)) < 0
          AND sign((bx1 - bx0) * (ay0 - by0) - (by1 - by0) * (ax0 - bx0)) * sign((bx1 - bx0) * (ay1 - by0) - (by1 - by0) * (ax1 - bx0)) < 0 THEN 0.0::DOUBLE
          ELSE least({_far("ax0", "ay0", "b")}, {_far("ax1", "ay1", "b")}, {_far("bx0", "by0", "a")}, {_far("bx1", "by1", "a")}) END AS d2 FROM n),
      c AS (SELECT id, any_value(x) AS x, any_value(y) AS y FROM (SELECT id, x, y, row_number() OVER (PARTITION BY id ORDER BY x, y) AS nth FROM corner) WHERE nth = 1 GROUP BY id),
      h AS (SELECT least(c.id, e.id) AS a, greatest(c.id, e.id) AS b, 0.0::DOUBLE AS d2 FROM c JOIN edge e ON e.id <> c.id WHERE {cross("c.x", "c.y").replace("x0", "e.x0").replace("y0", "e.y0").replace("x1", "e.x1").replace("y1", "e.y1")}
        GROUP BY c.id, e.id HAVING count(*) % 2 = 1)
      SELECT a, b, round(sqrt(min(d2)), 6) AS distance FROM (SELECT * FROM s UNION ALL SELECT * FROM h) GROUP BY a, b HAVING min(d2) <= 9"""
    q["dedupe_dbscan"] = f"""WITH RECURSIVE {DET}, e AS (SELECT a.id AS a, b.id AS b FROM det a JOIN det b ON b.lon_c BETWEEN a.lon_c - 2 AND a.lon_c + 2 AND b.lat_c BETWEEN a.lat_c - 2 AND a.lat_c + 2
          AND pow(a.lon_c - b.lon_c, 2) + pow(a.lat_c - b.lat_c, 2) <= 4),
      r(a, b) AS (SELECT id, id FROM det UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
      c AS (SELECT a AS id, min(b) AS cluster FROM r GROUP BY a)
      SELECT id, score, cluster FROM (SELECT d.id, d.score, c.cluster, row_number() OVER (PARTITION BY cluster ORDER BY score DESC, d.id) AS k FROM det d JOIN c USING (id)) WHERE k = 1"""
    inter = "greatest(0, least(a.x1, b.x1) - greatest(a.x0, b.x0)) * greatest(0, least(a.y1, b.y1) - greatest(a.y0, b.y0))"
    q["dedupe_nms"] = f"""WITH RECURSIVE {DET},
      bx AS (SELECT id, score, lon_c - half_c AS x0, lat_c - half_c AS y0, lon_c + half_c AS x1, lat_c + half_c AS y1 FROM det),
      e AS (SELECT a.id AS a, b.id AS b FROM bx a JOIN bx b ON b.x0 BETWEEN a.x0 - 102 AND a.x0 + 102 AND a.x0 <= b.x1 AND b.x0 <= a.x1 AND a.y0 <= b.y1 AND b.y0 <= a.y1
          AND {inter} >= 0.3 * ((a.x1 - a.x0) * (a.y1 - a.y0) + (b.x1 - b.x0) * (b.y1 - b.y0) - {inter}) AND a.id <> b.id),
      reach(a, b) AS (SELECT id, id FROM bx UNION SELECT r.a, e.b FROM reach r JOIN e ON e.a = r.b),
      o AS (SELECT bx.id, c.heap, row_number() OVER (PARTITION BY c.heap ORDER BY score DESC, bx.id) AS k, coalesce(nb.ids, []) AS ids
        FROM bx JOIN (SELECT a, min(b) AS heap FROM reach GROUP BY a) c ON c.a = bx.id LEFT JOIN (SELECT a, list(b) AS ids FROM e GROUP BY a) nb ON nb.a = bx.id),
      {GREEDY}
      SELECT id, score, x0 AS xmin, y0 AS ymin, x1 AS xmax, y1 AS ymax FROM bx JOIN stays USING (id)"""
    two = CHIPS.replace("value >= 0.1", "value >= 0.05").replace("on_px", "low_px")
    q["dedupe_regions"] = f"""WITH RECURSIVE {two}, on_px AS (SELECT *, 1 AS run FROM low_px WHERE value >= 0.1 UNION ALL SELECT *, 0 FROM low_px),
      walk(run, n, m) AS (SELECT run, n, n FROM on_px UNION SELECT r.run, r.n, b.n FROM walk r JOIN on_px a ON a.run = r.run AND a.n = r.m
        JOIN on_px b ON b.run = a.run AND b.raster_id = a.raster_id AND abs(a."row" - b."row") + abs(a.col - b.col) = 1),
      cells AS (SELECT 2 * w.component + w.run AS id, o.raster_id, o.n, o.value FROM (SELECT run, n, min(m) AS component FROM walk GROUP BY run, n) w JOIN on_px o USING (run, n)),
      rated AS (SELECT id, min(raster_id) AS heap, count(*) AS area_px, round(avg(value), 6) AS score FROM cells GROUP BY id),
      shared AS (SELECT a.id AS a, b.id AS b, count(*) AS common FROM cells a JOIN cells b ON a.n = b.n AND a.id <> b.id GROUP BY a.id, b.id),
      e AS (SELECT s.a, s.b FROM shared s JOIN rated x ON x.id = s.a JOIN rated y ON y.id = s.b WHERE common / (x.area_px + y.area_px - common)::DOUBLE >= 0.5),
      o AS (SELECT r.id, heap, row_number() OVER (PARTITION BY heap ORDER BY score DESC, r.id) AS k, coalesce(nb.ids, []) AS ids FROM rated r LEFT JOIN (SELECT a, list(b) AS ids FROM e GROUP BY a) nb ON nb.a = r.id),
      {GREEDY}
      SELECT id, area_px, score FROM rated JOIN stays USING (id)"""
    q["dedupe_polygons"] = q["dedupe_regions"]
    q["outline_overlay"] = q["dedupe_regions"].partition("      e AS (")[0].rstrip().removesuffix(",") + """
      SELECT a, b, common::DOUBLE AS common, x.area_px::DOUBLE AS area_a, y.area_px::DOUBLE AS area_b, round(common / (x.area_px + y.area_px - common)::DOUBLE, 6) AS iou
      FROM shared JOIN rated x ON x.id = a JOIN rated y ON y.id = b WHERE a % 2 = 0 AND b % 2 = 1"""
    # corners and holes of a region follow from the 2 x 2 blocks of pixels around each lattice point
    q["outline_measures"] = f"""WITH RECURSIVE {LABELS}, px AS (SELECT raster_id, component, "row" AS r, col AS c FROM on_px JOIN label USING (n)),
      quad AS (SELECT raster_id, component, r + dr AS y, c + dc AS x, count(*) AS n, min(dr * 2 + dc) AS u, max(dr * 2 + dc) AS v FROM px, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS t(dr, dc) GROUP BY ALL),
      c AS (SELECT raster_id, component, count(*) FILTER (WHERE n IN (1, 3)) + 2 * count(*) FILTER (WHERE n = 2 AND u + v = 3) AS corners,
          (count(*) FILTER (WHERE n = 1) - count(*) FILTER (WHERE n = 3) + 2 * count(*) FILTER (WHERE n = 2 AND u + v = 3)) // 4 AS euler FROM quad GROUP BY raster_id, component),
      m AS (SELECT raster_id, component, count(*) AS n FROM px GROUP BY raster_id, component),
      j AS (SELECT a.raster_id, a.component, count(*) AS touching FROM px a JOIN px b ON a.raster_id = b.raster_id AND abs(a.r - b.r) + abs(a.c - b.c) = 1 GROUP BY a.raster_id, a.component)
      SELECT raster_id, component, CAST(2 - euler AS INT) AS rings, CAST(corners AS INT) AS corners, n::DOUBLE AS area, (4 * n - coalesce(touching, 0))::DOUBLE AS length
      FROM c JOIN m USING (raster_id, component) LEFT JOIN j USING (raster_id, component)"""
    # from side to side: each outline is walked from every side, and the walk from its smallest one counts
    q["region_outlines"] = f"""WITH RECURSIVE {LABELS}, px AS (SELECT raster_id, component, "row" AS r, col AS c FROM on_px JOIN label USING (n)),
      side AS (SELECT p.raster_id, p.component, p.r + sr AS r, p.c + sc AS c, d FROM px p, (VALUES (0, 0, 0, -1, 0), (1, 0, 1, 0, 1), (2, 1, 1, 1, 0), (3, 1, 0, 0, -1)) AS t(d, sr, sc, nr, nc)
        WHERE NOT EXISTS (SELECT 1 FROM px q WHERE q.raster_id = p.raster_id AND q.r = p.r + nr AND q.c = p.c + nc)),
      link AS (SELECT *, row_number() OVER (PARTITION BY raster_id, id ORDER BY choice) AS nth FROM (
        SELECT a.raster_id, a.component, a.r * 10000 + a.c * 4 + a.d AS id, b.r * 10000 + b.c * 4 + b.d AS next, a.d <> b.d AS turned, CASE (b.d - a.d + 4) % 4 WHEN 1 THEN 0 WHEN 0 THEN 1 ELSE 2 END AS choice
        FROM side a JOIN side b ON b.raster_id = a.raster_id AND b.r = a.r + CASE a.d WHEN 1 THEN 1 WHEN 3 THEN -1 ELSE 0 END AND b.c = a.c + CASE a.d WHEN 0 THEN 1 WHEN 2 THEN -1 ELSE 0 END)),
      way AS (SELECT raster_id, component, id, next, turned FROM link WHERE nth = 1),
      walk(raster_id, component, ring, id, k, corner) AS (
        SELECT raster_id, component, id, id, 0, true FROM way
        UNION ALL SELECT w.raster_id, w.component, w.ring, v.next, w.k + 1, v.turned FROM walk w JOIN way v ON v.raster_id = w.raster_id AND v.id = w.id WHERE v.next <> w.ring),
      spot AS (SELECT *, '[' || CAST((id % 10000) // 4 AS DOUBLE) || ',' || CAST(0 - id // 10000 AS DOUBLE) || ']' AS p FROM walk WHERE ring = (SELECT min(id) FROM walk u WHERE u.raster_id = walk.raster_id AND u.ring = walk.ring)),
      ring AS (SELECT raster_id, component, ring, '[' || string_agg(p, ',' ORDER BY k) FILTER (corner) || ',' || min_by(p, k) || ']' AS ps FROM spot GROUP BY ALL)
      SELECT raster_id, component, '{{"type":"Feature","geometry":{{"type":"Polygon","coordinates":[' || string_agg(ps, ',' ORDER BY ring) || ']}},"properties":{{"component":' || component || '}}}}' AS feature FROM ring GROUP BY raster_id, component"""
    q["scan_and_detect"] = f"""WITH RECURSIVE {INFER}, on_px AS (SELECT "row" AS r, col AS c, prob AS value, "row" * 64 + col AS n FROM prob WHERE prob >= 0.62),
      walk(n, m) AS (SELECT n, n FROM on_px UNION SELECT w.n, b.n FROM walk w JOIN on_px a ON a.n = w.m JOIN on_px b ON abs(a.r - b.r) + abs(a.c - b.c) = 1),
      px AS (SELECT o.*, l.component FROM on_px o JOIN (SELECT n, min(m) AS component FROM walk GROUP BY n) l USING (n)),
      j AS (SELECT a.component, count(*) AS touching FROM px a JOIN px b ON abs(a.r - b.r) + abs(a.c - b.c) = 1 GROUP BY a.component),
      g AS (SELECT component, count(*) AS area_px, avg(value) AS p, 500 * (avg(c) + 0.5) AS x, -500 * (avg(r) + 0.5) AS y FROM px GROUP BY component HAVING count(*) >= 3),
      h AS (SELECT g.*, 4 * pi() * area_px / pow(4 * area_px - touching, 2) AS compactness FROM g JOIN j USING (component)),
      s AS (SELECT *, 0.6 * p + 0.2 * compactness + 0.2 * (1 - least(abs(area_px * 0.25 - 2) / 2, 1)) AS score FROM h),
      e AS (SELECT a.component AS a, b.component AS b FROM s a JOIN s b ON pow(a.x - b.x, 2) + pow(a.y - b.y, 2) <= 2250000),
      heap(a, b) AS (SELECT component, component FROM s UNION SELECT k.a, e.b FROM heap k JOIN e ON e.a = k.b),
      best AS (SELECT s.*, row_number() OVER (PARTITION BY (SELECT min(b) FROM heap WHERE a = s.component) ORDER BY score DESC, component) AS nth FROM s)
      SELECT component, area_px, round(score, 6) AS score, round(compactness, 6) AS compactness, round(x, 6) AS centroid_x, round(y, 6) AS centroid_y FROM best WHERE nth = 1"""
    # the outlines of region_outlines, of the regions that scan_and_detect keeps and in its units
    walked = q["region_outlines"].partition("      side AS (")
    traced = (walked[1] + walked[2].rpartition("      SELECT raster_id, component,")[0]).replace("CAST((id % 10000) // 4 AS DOUBLE)", "CAST(500 * ((id % 10000) // 4) AS DOUBLE)").replace("CAST(0 - id // 10000 AS DOUBLE)", "CAST(-500 * (id // 10000) AS DOUBLE)")
    traced = traced.replace("FROM px", "FROM own").replace("walk", "pace").rstrip()
    q["detected_outlines"] = q["scan_and_detect"].partition("      SELECT component, area_px, round(score")[0].rstrip() + f""",
      own AS (SELECT 0 AS raster_id, px.component, r, c FROM px JOIN best USING (component) WHERE nth = 1),
{traced}
      SELECT component, '{{"type":"Feature","geometry":{{"type":"Polygon","coordinates":[' || string_agg(ps, ',' ORDER BY ring) || ']}},"properties":{{"component":' || component || ',"area_px":' || any_value(area_px) || '}}}}' AS feature
      FROM ring JOIN best USING (component) WHERE nth = 1 GROUP BY component"""
    split = f"""{DET}, r AS (SELECT id, id % 11 = 0 AS is_positive, row_number() OVER (PARTITION BY id % 11 = 0 ORDER BY id * 7919 % 1048573, id) - 1 AS k,
        count(*) OVER (PARTITION BY id % 11 = 0) AS n FROM det),
      sp AS (SELECT id, is_positive, CASE WHEN k < floor(n * 0.7::DOUBLE) THEN 'train' WHEN k < floor(n * 0.7::DOUBLE) + floor(n * 0.15::DOUBLE) THEN 'val' ELSE 'test' END AS split FROM r)"""
    q["stratified_split"] = f"WITH {split} SELECT * FROM sp"
    q["split_sizes"] = f"WITH {split} SELECT split, is_positive, count(*) AS n FROM sp GROUP BY split, is_positive"
    meets = "x0 <= 60 AND x0 + 2 >= -60 AND y0 <= 40 AND y0 + 2 >= -40 AND ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25'"
    q["scene_search"] = f"""WITH {SCENES} SELECT scene_id, sensor, cloud_cover FROM (SELECT * FROM scenes WHERE sensor = 'sentinel-2' AND {meets} AND cloud_cover < 20 ORDER BY ts DESC, scene_id LIMIT 50)
      UNION ALL SELECT scene_id, sensor, NULL FROM (SELECT * FROM scenes WHERE sensor = 'sentinel-1' AND {meets} ORDER BY ts DESC, scene_id LIMIT 50)"""
    q["aoi_scene_join"] = f"""WITH {SCENES}, p AS (SELECT n_name AS name, scene_id, row_number() OVER (PARTITION BY n_name ORDER BY ts DESC, scene_id) AS nth FROM nation, scenes
        WHERE x0 <= (n_nationkey * 53) % 320 - 140 AND x0 + 2 >= (n_nationkey * 53) % 320 - 160 AND y0 <= (n_nationkey * 31) % 140 - 50 AND y0 + 2 >= (n_nationkey * 31) % 140 - 70
          AND ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25' AND cloud_cover < 60) SELECT name, scene_id, nth FROM p WHERE nth <= 5"""
    page = "lon_c - half_c <= 3000 AND lon_c + half_c >= -2000 AND lat_c - half_c <= 4000 AND lat_c + half_c >= 0 AND score >= 0.5"
    q["radar_scene_join"] = f"""WITH {SCENES}, p AS (SELECT n_name AS name, sensor, scene_id, row_number() OVER (PARTITION BY n_name, sensor ORDER BY ts DESC, scene_id) AS nth FROM nation, scenes
        WHERE x0 <= (n_nationkey * 53) % 320 - 140 AND x0 + 2 >= (n_nationkey * 53) % 320 - 160 AND y0 <= (n_nationkey * 31) % 140 - 50 AND y0 + 2 >= (n_nationkey * 31) % 140 - 70
          AND ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25' AND (cloud_cover < 60 OR sensor = 'sentinel-1')) SELECT name, sensor, scene_id, nth FROM p WHERE nth <= 5"""
    q["detections_page"] = f"WITH {DET} SELECT id, score, area_c, model_version FROM det WHERE {page} ORDER BY score DESC, id LIMIT 25 OFFSET 3"
    q["detections_count"] = f"WITH {DET} SELECT count(*) AS total FROM det WHERE {page}"
    q["detection_by_id"] = f"""WITH {DET} SELECT id, score, model_version, lon_c::DOUBLE AS centroid_lon, lat_c::DOUBLE AS centroid_lat, lon_c - half_c AS x0, lat_c - half_c AS y0,
      lon_c + half_c AS x1, lat_c + half_c AS y1 FROM det WHERE id = 97"""
    q["tile_features"] = f"""WITH {DET}, p AS (SELECT id, score, lon_c / 100.0::DOUBLE AS lon, lat_c / 100.0::DOUBLE AS lat FROM det),
      w AS (SELECT *, (lon + 180) / 360 * 8 - 4 AS fx, (1 - ln(tan((lat + 90) * (pi() / 360))) / pi()) / 2 * 8 - 3 AS fy FROM p WHERE abs(lat) < 89)
      SELECT id, score, CAST(floor(fx * 4096) AS INT) AS px, CAST(floor(fy * 4096) AS INT) AS py FROM w WHERE fx BETWEEN 0 AND 1 AND fy BETWEEN 0 AND 1 AND score >= 0.1"""
    q["warped_raster"] = f"""WITH {MED}, g AS (SELECT CAST(r AS INT) AS r, CAST(c AS INT) AS c, (c + 0.5) * 1.5 - 2.25 - 0.5 AS sx, (r + 0.5) * 1.5 + 1.25 - 0.5 AS sy
        FROM (SELECT unnest(generate_series(0, 45)) AS r), (SELECT unnest(generate_series(0, 45)) AS c)),
      k AS (SELECT r, c, floor(sy) + dy AS y, floor(sx) + dx AS x, CAST((1 - abs(sy - floor(sy) - dy)) * (1 - abs(sx - floor(sx) - dx)) AS DOUBLE) AS w FROM g, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS t(dy, dx))
      SELECT r AS "row", c AS col, round(sum(w * red) / sum(w) FILTER (red IS NOT NULL), 6) AS red, round(sum(w * nir) / sum(w) FILTER (nir IS NOT NULL), 6) AS nir
      FROM k LEFT JOIN med m ON m."row" = y AND m.col = x AND w > 0 WHERE true GROUP BY 1, 2"""
    q["tile_pyramid"] = f"""WITH {DET}, w AS (SELECT id, score, (lon_c / 100.0::DOUBLE + 180) / 360 * 32 AS fx, (1 - ln(tan((lat_c / 100.0::DOUBLE + 90) * (pi() / 360))) / pi()) / 2 * 32 AS fy
        FROM det WHERE abs(lat_c) < 8900 AND score >= 0.1),
      v AS (SELECT z, id, score, fx / 2 ** (5 - z) AS fx, fy / 2 ** (5 - z) AS fy FROM w, (SELECT unnest(generate_series(0, 5)) AS z) WHERE fx >= 0 AND fx < 32 AND fy >= 0 AND fy < 32),
      c AS (SELECT *, count(*) OVER own AS n, row_number() OVER (own ORDER BY score DESC, id) AS nth FROM v WINDOW own AS (PARTITION BY z, floor(fx * 64), floor(fy * 64)))
      SELECT CAST(z AS INT) AS z, CAST(floor(fx) AS BIGINT) AS x, CAST(floor(fy) AS BIGINT) AS y, count(*) AS features, CAST(sum(n) AS BIGINT) AS detections,
        CAST(sum(floor((fx - floor(fx)) * 4096)) AS BIGINT) AS px, CAST(sum(floor((fy - floor(fy)) * 4096)) AS BIGINT) AS py, CAST(sum(id) AS BIGINT) AS ids, max(score) AS best
      FROM c WHERE nth = 1 GROUP BY 1, 2, 3"""
    q["detections_layout"] = f"WITH {DET} SELECT id, score, area_c, model_version FROM det WHERE {page}"
    q["marker_style"] = f"""WITH {DET} SELECT id, round(CASE WHEN score <= 0.5 THEN 4 + score * 6 ELSE 7 + (score - 0.5) * 10 END, 6) AS radius,
      (score >= 0.3)::INT + (score >= 0.6)::INT + (score >= 0.9)::INT AS colour FROM det"""
    stops = [(0.0, (55, 65, 81)), (0.3, (245, 158, 11)), (0.6, (239, 68, 68)), (0.9, (220, 38, 38))]
    part = lambda i: "CASE " + " ".join(f"WHEN score <= {b[0]} THEN {a[1][i]} + (score - {a[0]}) * ({b[1][i] - a[1][i]} / {b[0] - a[0]})" for a, b in zip(stops, stops[1:], strict=False)) + f" ELSE {stops[-1][1][i]} END"
    q["marker_colour"] = f"WITH {DET} SELECT id, printf('#%02x%02x%02x', " + ", ".join(f"CAST(floor({part(i)} + 0.5) AS INT)" for i in range(3)) + ") AS colour FROM det"
    burnt = q["rasterize_labels"].removeprefix("WITH ")
    q["label_arrays"] = f"""WITH med AS (WITH {burnt}), {_tiles()} SELECT 'tile_' || col_off || '_' || row_off AS tile_id, string_agg(CAST(CAST(label AS INT) AS VARCHAR), '' ORDER BY "row", col) AS labels FROM tiled GROUP BY row_off, col_off"""
    # the box in pixels of 10: columns 0 to 22 and rows 8 to 39
    q["scene_crop"] = f"""WITH {MED}, g AS (SELECT CAST(r AS INT) AS r, CAST(c AS INT) AS c FROM (SELECT unnest(generate_series(8, 39)) AS r), (SELECT unnest(generate_series(0, 22)) AS c))
      SELECT CAST(r - 8 AS INT) AS "row", c AS col, m.blue, CAST(NULL AS DOUBLE) AS green, k.red FROM g LEFT JOIN med m ON m."row" = r AND m.col = c LEFT JOIN med k ON k."row" = r // 2 * 2 AND k.col = c // 2 * 2"""
    bands = ("red", "green", "blue")
    lim3 = ", ".join(f"quantile_cont({b}, 0.02) AS {b}_lo, quantile_cont({b}, 0.98) AS {b}_hi" for b in bands)
    rgb = ", ".join(
        f"CAST(trunc(CASE WHEN {b}_hi - {b}_lo <= 0 THEN {b} ELSE greatest(0.0, least(1.0, ({b} - {b}_lo) / ({b}_hi - {b}_lo))) * 255.0 END) AS INT) AS {n}" for b, n in zip(bands, "rgb", strict=True)
    )
    q["evidence_rgb"] = f"""WITH {MED}, o AS (SELECT CAST(i AS INT) AS i, CAST(floor((i + 0.5) * 64 / 20) AS INT) AS src FROM (SELECT unnest(generate_series(0, 19)) AS i)),
      s AS (SELECT a.i AS "row", b.i AS col, red, green, blue FROM med m JOIN o a ON a.src = m."row" JOIN o b ON b.src = m.col), lim AS (SELECT {lim3} FROM s)
      SELECT "row", col, {rgb} FROM s, lim"""
    q["geojson_features"] = f"""WITH {DET} SELECT id, '{{"type":"Feature","geometry":{{"type":"Point","coordinates":[' || lon_c || ',' || lat_c || ']}},"properties":{{"id":' || id
      || ',"score_m":' || score_m || ',"model_version":"' || model_version || '"}}}}' AS feature FROM det WHERE {page}"""
    q["health"] = "SELECT 'ok' AS status, CAST(NULL AS BOOLEAN) AS model_ready, count(*) AS detections FROM orders"
    q["aoi_union"] = """WITH r AS (SELECT s_suppkey AS raster_id, CASE s_nationkey % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' ELSE 'c' END AS aoi, 200 + s_suppkey * 37 % 900 AS h, 200 + s_suppkey * 53 % 900 AS w FROM supplier),
      k AS (SELECT CAST(unnest(generate_series(0, 10)) * 224 AS INT) AS o)
      SELECT aoi, raster_id, 'tile_' || b.o || '_' || a.o AS tile_id, a.o AS row_off, b.o AS col_off FROM r JOIN k a ON a.o + 256 <= h JOIN k b ON b.o + 256 <= w"""
    q["warped_blocks"] = q["warped_raster"]
    q["raster_files"] = f"""WITH {MED} SELECT raster_id, "row", col, {", ".join(f"CAST(CAST({b} AS FLOAT) AS DOUBLE) AS {b}" for b in BANDS)} FROM med WHERE "row" BETWEEN 10 AND 39 AND col BETWEEN 21 AND 37"""
    q["chip_files"] = f"""WITH {MED}, {_tiles()} SELECT 'tile_' || col_off || '_' || row_off AS tile_id, 500.0::DOUBLE + 10 * col_off AS "left", 9000.0::DOUBLE - 10 * row_off AS top,
      sum(CAST(red AS FLOAT)::DOUBLE) AS red, sum(CAST(nir AS FLOAT)::DOUBLE) AS nir FROM tiled GROUP BY row_off, col_off HAVING count(*) FILTER (WHERE blue <> 0) / 256.0::DOUBLE >= 0.5"""
    q["early_stopping"] = """WITH e AS (SELECT CAST(day(ts) AS INT) AS epoch, round(avg(value), 6) AS loss FROM events GROUP BY day(ts)),
      b AS (SELECT *, min(loss) OVER (ORDER BY epoch) AS best, min(loss) OVER (ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM e),
      s AS (SELECT *, epoch - max(CASE WHEN prev IS NULL OR loss < prev THEN epoch END) OVER (ORDER BY epoch) AS stale FROM b)
      SELECT epoch, loss, best, stale, stale >= 4 AS stop, pow(0.5, count(*) FILTER (WHERE stale > 0 AND stale % 3 = 0) OVER (ORDER BY epoch)) AS lr_scale,
        row_number() OVER (ORDER BY loss, epoch) <= 3 AS kept FROM s"""
    room = 512 * 1024 * 1024 - 16 * 10 * 256 * 256 * 4
    q["strip_height"] = f"SELECT s_suppkey AS id, greatest(256, CAST(floor(floor({room} / ((1000 + s_suppkey * 997) * 8.0::DOUBLE)) / 192) AS BIGINT) * 192 + 64) AS height FROM supplier"
    q["augment"] = f"""WITH {CHIPS}, a AS (SELECT raster_id, value,
        CASE raster_id % 4 WHEN 0 THEN "row" WHEN 1 THEN 7 - col WHEN 2 THEN 7 - "row" ELSE col END AS r,
        CASE raster_id % 4 WHEN 0 THEN col WHEN 1 THEN "row" WHEN 2 THEN 7 - col ELSE 7 - "row" END AS c FROM chips)
      SELECT raster_id, CASE WHEN raster_id % 5 = 0 THEN 7 - r ELSE r END AS "row", CASE WHEN raster_id % 3 = 0 THEN 7 - c ELSE c END AS col, round(value, 6) AS value FROM a"""
    q["sliding_window_inference"] = f'WITH {INFER} SELECT raster_id, "row", col, round(prob, 6) AS prob FROM prob'
    return q
