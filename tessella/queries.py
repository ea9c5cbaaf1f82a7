"""One query per operator over the derived tables, with the DuckDB SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import fixtures as fx
from .functions import boxes as bx
from .functions import georef, naming
from .operators import evaluate as ev
from .operators import labels, profile, score, split, stretch, suppress, tiling
from .plans import pipelines

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}
TILE, STRIDE, RATIOS = 256, 64, {"train": 0.7, "val": 0.3, "test": 0.0}


def query(name: str, sql: str | None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return add


# --- boxes -----------------------------------------------------------------------------------------

_AREA = "greatest(x2-x1,0)*greatest(y2-y1,0)"


@query("box_area", f"WITH {fx.DETECTIONS} SELECT det_id, {_AREA} AS area, {_AREA}+1e-9::double AS area_eps, greatest((x2-x1)*(y2-y1),1e-9::double) AS area_floored FROM detections")
def box_area(spark, sf_dir):
    b = bx.Box.of()
    return fx.detections(spark, sf_dir).select("det_id", bx.area(b).alias("area"), bx.area_eps(b).alias("area_eps"), bx.area_floored(b).alias("area_floored"))


def _pairs(spark, sf_dir):
    d = fx.detections(spark, sf_dir)
    a, b = (d.select((F.col("det_id").alias(f"det_{p}")), F.floor(F.col("det_id") / 3).alias(f"{p}_event"), *bx.Box.of().columns(tuple(f"{p}_{n}" for n in ("x1", "y1", "x2", "y2")))) for p in "ab")
    return a.join(b, (F.col("a_event") == F.col("b_event")) & (F.col("det_a") < F.col("det_b")))


_PAIRS = fx.DETECTIONS + """, boxes AS (SELECT *, (x2-x1)*(y2-y1) AS own FROM detections),
pairs AS (SELECT a.det_id det_a, b.det_id det_b, a.x1 ax1, a.y1 ay1, a.x2 ax2, a.y2 ay2, b.x1 bx1, b.y1 by1, b.x2 bx2, b.y2 by2, a.own aa, b.own ba,
    greatest(least(a.x2,b.x2)-greatest(a.x1,b.x1),0)*greatest(least(a.y2,b.y2)-greatest(a.y1,b.y1),0) AS inter
  FROM boxes a JOIN boxes b ON a.det_id//3=b.det_id//3 AND a.det_id<b.det_id)"""
_EPS = "cast(1e-9 AS double)"


@query("box_iou", f"WITH {_PAIRS} SELECT det_a, det_b, inter/(aa+ba-inter+{_EPS}) AS iou_merge, inter/greatest(aa+ba-inter,{_EPS}) AS iou_export, "
       "CASE WHEN least(ax2,bx2)<greatest(ax1,bx1) OR least(ay2,by2)<greatest(ay1,by1) THEN 0 ELSE inter/(aa+ba-inter+cast(1e-6 AS double)) END AS iou_eval FROM pairs")  # fmt: skip
def box_iou(spark, sf_dir):
    a, b = bx.Box.of("a_"), bx.Box.of("b_")
    return _pairs(spark, sf_dir).select("det_a", "det_b", bx.iou_merge(a, b).alias("iou_merge"), bx.iou_export(a, b).alias("iou_export"), bx.iou_eval(a, b).alias("iou_eval"))


@query("box_coverage", f"WITH {_PAIRS} SELECT det_a, det_b, inter/(ba+{_EPS}) AS coverage_merge, inter/greatest(ba,{_EPS}) AS coverage_export, "
       "bx1>=ax1-3 AND by1>=ay1-3 AND bx2<=ax2+3 AND by2<=ay2+3 AS near FROM pairs")  # fmt: skip
def box_coverage(spark, sf_dir):
    a, b = bx.Box.of("a_"), bx.Box.of("b_")
    return _pairs(spark, sf_dir).select("det_a", "det_b", bx.coverage_merge(b, a).alias("coverage_merge"), bx.coverage_export(b, a).alias("coverage_export"), bx.nearly_inside(b, a, 3).alias("near"))


@query("box_normalise", f"WITH {fx.DETECTIONS} SELECT det_id, least(x1,x2) x1, least(y1,y2) y1, greatest(x1,x2) x2, greatest(y1,y2) y2 FROM "
       "(SELECT det_id, CASE WHEN det_id%2=0 THEN x1 ELSE x2 END x1, y1, CASE WHEN det_id%2=0 THEN x2 ELSE x1 END x2, y2 FROM detections)")  # fmt: skip
def box_normalise(spark, sf_dir):
    even = F.col("det_id") % 2 == 0
    d = fx.detections(spark, sf_dir).select("det_id", F.when(even, F.col("x1")).otherwise(F.col("x2")).alias("x1"), "y1", F.when(even, F.col("x2")).otherwise(F.col("x1")).alias("x2"), "y2")
    return d.select("det_id", *bx.ordered(bx.Box.of()).columns())


@query("global_to_tile", f"WITH {fx.TILED} SELECT det_id, tile, x1-tile_c*64 x1, y1-tile_r*64 y1, x2-tile_c*64 x2, y2-tile_r*64 y2 FROM tiled")
def global_to_tile(spark, sf_dir):
    return fx.tiled_detections(spark, sf_dir).select("det_id", "tile", *bx.to_tile(bx.Box.of(), F.col("tile_r"), F.col("tile_c"), STRIDE).columns())


@query("tile_to_global", f"WITH {fx.TILED} SELECT det_id, x1+tile_c*64 x1, y1+tile_r*64 y1, x2+tile_c*64 x2, y2+tile_r*64 y2 FROM tiled")
def tile_to_global(spark, sf_dir):
    return fx.tiled_detections(spark, sf_dir).select("det_id", *bx.to_image(bx.Box.of(), F.col("tile_r"), F.col("tile_c"), STRIDE).columns())


_FIT = "greatest(0,least(cast(round_even({c}/8,0) AS int),511))"


@query("clamp_box", f"WITH {fx.DETECTIONS} SELECT det_id, " + ", ".join(f"{f}({_FIT.format(c=a)},{_FIT.format(c=b)}) {o}" for f, a, b, o in (("least", "x1", "x2", "x1"), ("least", "y1", "y2", "y1"), ("greatest", "x1", "x2", "x2"), ("greatest", "y1", "y2", "y2"))) + " FROM detections")
def clamp_box(spark, sf_dir):
    b = bx.Box(*(c / 8 for c in bx.Box.of()))
    return fx.detections(spark, sf_dir).select("det_id", *bx.clamped(b, 512, 512).columns())


# --- georeferencing ----------------------------------------------------------------------------------


@query("pixel_to_map", f"WITH {fx.DETECTIONS}, {fx.RASTERS} SELECT det_id, least(a*x1+c,a*(x2+1)+c) minx, least(e*y1+f,e*(y2+1)+f) miny, greatest(a*x1+c,a*(x2+1)+c) maxx, greatest(e*y1+f,e*(y2+1)+f) maxy FROM detections JOIN rasters USING (image_id)")
def pixel_to_map(spark, sf_dir):
    return pipelines.georeference(fx.detections(spark, sf_dir), fx.rasters(spark, sf_dir)).select("det_id", "minx", "miny", "maxx", "maxy")


@query("map_to_pixel", f"WITH {fx.FEATURES}, {fx.RASTERS} SELECT feature_id, cast(floor((e*(a*(x1+0.25::double)+c-c))/(a*e)) AS bigint) col, cast(floor((a*(e*(y1+0.25::double)+f-f))/(a*e)) AS bigint) AS row FROM features JOIN rasters USING (image_id)")
def map_to_pixel(spark, sf_dir):
    j = fx.features(spark, sf_dir).join(fx.rasters(spark, sf_dir), "image_id")
    t = georef.Affine.of()
    x, y = georef.to_map(t, F.col("x1") + 0.25, F.col("y1") + 0.25)
    col, row = georef.to_pixel(t, x, y)
    return j.select("feature_id", col.alias("col"), row.alias("row"))


@query("pixel_size", f"WITH {fx.RASTERS} SELECT image_id, (abs(a)+abs(e))/2 AS pixel_size FROM rasters")
def pixel_size(spark, sf_dir):
    return fx.rasters(spark, sf_dir).select("image_id", georef.pixel_size(georef.Affine.of()).alias("pixel_size"))


@query("window_bounds", f"WITH {fx.TILES.format(way='floor')} SELECT tile_id, a*x0+c minx, e*(y0+256)+f miny, a*(x0+256)+c maxx, e*y0+f maxy FROM tiles JOIN rasters USING (image_id)")
def window_bounds(spark, sf_dir):
    r = fx.rasters(spark, sf_dir)
    j = tiling.tile_grid(r, TILE, STRIDE, False, carry=tuple("abcdef"))
    b = georef.window_bounds(georef.Affine.of(), F.col("x0"), F.col("y0"), F.lit(TILE))
    return j.select("tile_id", *b.columns(("minx", "miny", "maxx", "maxy")))


# --- tiling ------------------------------------------------------------------------------------------


@query("tile_size_resolve", f"WITH {fx.RASTERS} SELECT image_id, greatest(32, cast(round_even(round_even(2560/((abs(a)+abs(e))/2+h%7),0)/32,0)*32 AS int)) AS tile_size FROM rasters")
def tile_size_resolve(spark, sf_dir):
    size = georef.pixel_size(georef.Affine.of()) + F.col("h") % 7
    return fx.rasters(spark, sf_dir).select("image_id", tiling.tile_size_from_ground(2560, size).alias("tile_size"))


@query("stride_resolve", f"WITH {fx.RASTERS} SELECT image_id, cast(round_even((32*(1+h%20))*cast(0.35 AS double),0) AS int) AS stride FROM rasters")
def stride_resolve(spark, sf_dir):
    return fx.rasters(spark, sf_dir).select("image_id", tiling.stride_of(F.lit(32) * (F.lit(1) + F.col("h") % 20), 0.35).alias("stride"))


def _grid(cover: bool) -> Query:
    return lambda spark, sf_dir: tiling.tile_grid(fx.rasters(spark, sf_dir), TILE, STRIDE, cover)


for _name, _way, _cover in (("tile_grid_train", "floor", False), ("tile_grid_infer", "ceil", True)):
    query(_name, f"WITH {fx.TILES.format(way=_way)} SELECT image_id, tile_r, tile_c, x0, y0, tile_id FROM tiles")(_grid(_cover))

_NAMES = fx.TILED + """, names AS (SELECT det_id, CASE det_id%5 WHEN 0 THEN tile WHEN 1 THEN replace(tile,'image','a_b') WHEN 2 THEN replace(tile,concat(image_id,'_'),'')
  WHEN 3 THEN replace(upper(tile),'TIF','PNG') ELSE replace(tile,'tif','txt') END AS name FROM tiled)"""


def _named(spark, sf_dir):
    k = F.col("det_id") % 5
    t, r = F.col("tile"), lambda a, b: F.replace(F.col("tile"), a, b)
    name = F.when(k == 0, t).when(k == 1, r(F.lit("image"), F.lit("a_b"))).when(k == 2, r(F.concat("image_id", F.lit("_")), F.lit(""))).when(k == 3, F.replace(F.upper(t), F.lit("TIF"), F.lit("PNG"))).otherwise(r(F.lit("tif"), F.lit("txt")))
    return fx.tiled_detections(spark, sf_dir).select("det_id", name.alias("name"))


_RE = r"(?i)tile_(?:([^_]+)_)?r(\d+)_c(\d+)\.(?:tif|tiff|png|jpg|jpeg)$"


@query("tile_name_parse", f"WITH {_NAMES} SELECT det_id, name, regexp_extract(name,'{_RE}',1) AS image_id, coalesce(try_cast(regexp_extract(name,'{_RE}',2) AS int),-1) AS tile_r, coalesce(try_cast(regexp_extract(name,'{_RE}',3) AS int),-1) AS tile_c FROM names")
def tile_name_parse(spark, sf_dir):
    parts = naming.parse_tile(F.col("name"))
    return _named(spark, sf_dir).select("det_id", "name", F.coalesce(parts["image_id"], F.lit("")).alias("image_id"), *(F.coalesce(parts[n], F.lit(-1)).alias(n) for n in ("tile_r", "tile_c")))


@query("image_prefix", f"WITH {_NAMES} SELECT det_id, CASE WHEN starts_with(name,'tile_') AND contains(name,'_r') THEN replace(split_part(name,'_r',1),'tile_','') END AS prefix FROM names")
def image_prefix(spark, sf_dir):
    return _named(spark, sf_dir).select("det_id", naming.image_prefix(F.col("name")).alias("prefix"))


@query("tile_name_format", f"WITH {fx.TILED} SELECT DISTINCT image_id, tile_r, tile_c, replace(tile,'.tif','.png') AS file FROM tiled")
def tile_name_format(spark, sf_dir):
    d = fx.tiled_detections(spark, sf_dir).select("image_id", "tile_r", "tile_c").distinct()
    return d.withColumn("file", naming.tile_file(F.col("image_id"), F.col("tile_r"), F.col("tile_c"), "png"))


# --- filters -----------------------------------------------------------------------------------------


@query("conf_filter", f"WITH {fx.DETECTIONS} SELECT det_id, conf FROM detections WHERE conf>=0.25")
def conf_filter(spark, sf_dir):
    return fx.detections(spark, sf_dir).filter(bx.confident(F.col("conf"), 0.25)).select("det_id", "conf")


@query("input_filter", f"WITH {fx.TILED} SELECT det_id, tile FROM tiled WHERE starts_with(tile,'tile_image1_')")
def input_filter(spark, sf_dir):
    return fx.tiled_detections(spark, sf_dir).filter(naming.has_prefix(F.col("tile"), "image1")).select("det_id", "tile")


@query("distinct_tiles", f"WITH {fx.TILED} SELECT DISTINCT tile FROM tiled")
def distinct_tiles(spark, sf_dir):
    return profile.distinct_tiles(fx.tiled_detections(spark, sf_dir))


@query("topk_per_tile", f"WITH {fx.TILED} SELECT det_id, tile, conf FROM tiled QUALIFY row_number() OVER (PARTITION BY tile ORDER BY conf DESC, det_id)<=2")
def topk_per_tile(spark, sf_dir):
    return suppress.top_k(fx.tiled_detections(spark, sf_dir), 2).select("det_id", "tile", "conf")


# --- labels ------------------------------------------------------------------------------------------


def _hits(spark, sf_dir):
    return labels.join_raster_tiles(fx.features(spark, sf_dir), fx.rasters(spark, sf_dir), TILE, STRIDE)


_HITS = fx.TILES.format(way="floor") + f", {fx.FEATURES}" + """, hits AS (
  SELECT f.feature_id, t.*, greatest(x1,x0)-x0 cx1, greatest(y1,y0)-y0 cy1, least(x2,x0+256)-x0 cx2, least(y2,y0+256)-y0 cy2, (x2-x1)*(y2-y1) own
  FROM features f JOIN tiles t ON f.image_id=t.image_id AND x1<x0+256 AND x2>x0 AND y1<y0+256 AND y2>y0),
clipped AS (SELECT *, (cx2-cx1)*(cy2-cy1)/own AS area_fraction FROM hits)"""
_LABELS = _HITS + """, boxed AS (SELECT *, cast(greatest(0,least(floor(cx1),255)) AS int) px1, cast(greatest(0,least(floor(cy1),255)) AS int) py1,
    cast(greatest(0,least(floor(cx2),255)) AS int) px2, cast(greatest(0,least(floor(cy2),255)) AS int) py2 FROM clipped WHERE area_fraction>=0.25),
labels AS (SELECT * FROM boxed WHERE px2-px1>=4 AND py2-py1>=4)"""


@query("spatial_join_tiles", f"WITH {_HITS} SELECT feature_id, tile_id, area_fraction FROM clipped")
def spatial_join_tiles(spark, sf_dir):
    return labels.clip_boxes(_hits(spark, sf_dir), TILE).select("feature_id", "tile_id", "area_fraction")


@query("label_boxes", f"WITH {_LABELS} SELECT feature_id, tile_id, px1, py1, px2, py2, (px1+px2)/2/256 AS cx, (py1+py2)/2/256 AS cy, (px2-px1)/256 AS bw, (py2-py1)/256 AS bh FROM labels")
def label_boxes(spark, sf_dir):
    made = labels.pixel_labels(labels.clip_boxes(_hits(spark, sf_dir), TILE), TILE)
    return made.select("feature_id", "tile_id", "px1", "py1", "px2", "py2", "cx", "cy", "bw", "bh")


@query("label_filters", f"WITH {_LABELS} SELECT (SELECT count(*) FROM hits) AS hits, (SELECT count(*) FROM boxed) AS large_enough, (SELECT count(*) FROM labels) AS labels")
def label_filters(spark, sf_dir):
    clipped = labels.clip_boxes(_hits(spark, sf_dir), TILE)
    large = F.col("area_fraction") >= 0.25
    some = labels.pixel_labels(clipped, TILE).select("feature_id", "tile_id", F.lit(True).alias("kept"))
    return clipped.join(some, ["feature_id", "tile_id"], "left").agg(F.count("*").alias("hits"), F.count_if(large).alias("large_enough"), F.count("kept").alias("labels"))


def _draw_rows(rows: int, cols: int, block: int) -> str:
    """Keys and splits of the blocks of a grid, by Python's generator; the operator's own code has no part in it."""
    import random

    keys = sorted({(r * 1000003) ^ c for r in range(-(-rows // block)) for c in range(-(-cols // block))})
    return ", ".join(f"({k}, '{'train' if random.Random(k + 42).random() < 0.7 else 'val'}')" for k in keys)


_SPLIT = "draws(key, split) AS (VALUES " + _draw_rows(60, 60, 6) + ")"


@query("block_split", f"WITH {fx.TILES.format(way='ceil')}, {_SPLIT} SELECT tile_id, split FROM tiles JOIN draws ON key=xor(cast(tile_r//6 AS bigint)*1000003, cast(tile_c//6 AS bigint))")
def block_split(spark, sf_dir):
    places = tiling.grid_places(fx.rasters(spark, sf_dir), TILE, STRIDE, True)
    return split.with_split(_grid(True)(spark, sf_dir), RATIOS, 42, 6, places=places).select("tile_id", "split")


@query("split_counts", f"WITH {_LABELS}, {_SPLIT} SELECT split, count(DISTINCT tile_id) AS tiles_written, count(*) AS labels_written FROM labels JOIN draws ON key=xor(cast(tile_r//6 AS bigint)*1000003, cast(tile_c//6 AS bigint)) GROUP BY split")
def split_counts(spark, sf_dir):
    made = pipelines.build_labels(fx.features(spark, sf_dir), fx.rasters(spark, sf_dir), TILE, STRIDE, RATIOS, 42, 6)
    return labels.split_counts(made)


# --- pixels ------------------------------------------------------------------------------------------

_FINITE = "list_filter(pixels, lambda x: isfinite(x))"
_STRETCH = """bounds AS (SELECT *, quantile_cont(p, 0.02) OVER (PARTITION BY vec_id) lo, quantile_cont(p, 0.98) OVER (PARTITION BY vec_id) hi, count(p) OVER (PARTITION BY vec_id) n FROM valid),
pixel AS (SELECT vec_id, i, CASE WHEN p IS NULL OR n<50 OR hi-lo<1e-6 THEN 0 ELSE cast(floor(greatest(0,least(1,(p-lo)/(hi-lo)))*255) AS int) END AS v FROM bounds)
SELECT vec_id, string_agg(cast(v AS varchar), ',' ORDER BY i) AS bytes FROM pixel GROUP BY vec_id"""


def _valid(masked: str) -> str:
    return fx.PIXELS + f", valid AS (SELECT vec_id, i, CASE WHEN {masked} THEN NULL ELSE cast(pixels[i+1] AS double) END AS p FROM (SELECT vec_id, pixels, unnest(range(64)) AS i FROM pixels)),\n"


@query("stretch_uint8", f"WITH {_valid('false')}{_STRETCH}")
def stretch_uint8(spark, sf_dir):
    return stretch.stretch_bands(fx.pixels(spark, sf_dir)).select("vec_id", F.array_join(F.col("bytes").cast("array<string>"), ",").alias("bytes"))


@query("stretch_masked", f"WITH {_valid('i % 7 = vec_id % 7 OR (vec_id % 10 = 3 AND i % 3 = 0)')}{_STRETCH}")
def stretch_masked(spark, sf_dir):
    hidden = F.transform("pixels", lambda x, i: (i % 7 == F.col("vec_id") % 7) | ((F.col("vec_id") % 10 == 3) & (i % 3 == 0)))
    return stretch.stretch_bands(fx.pixels(spark, sf_dir).withColumn("mask", hidden), mask="mask").select("vec_id", F.array_join(F.col("bytes").cast("array<string>"), ",").alias("bytes"))


def _stacked(spark, sf_dir):
    hidden = F.transform("pixels", lambda x, i: F.when((F.col("tile_id") % 5 == 0) | (i % 7 == F.col("vec_id") % 7), F.lit(-9.0)).otherwise(x.cast("double")))
    p = fx.pixels(spark, sf_dir).withColumn("pixels", hidden)
    return p.groupBy("tile_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("band", "pixels"))), lambda s: s["pixels"]).alias("bands"))


_MASK = fx.PIXELS + """, mask AS (SELECT tile_id, i, bool_or(tile_id%5=0 OR i%7=vec_id%7) AS m FROM (SELECT tile_id, vec_id, unnest(range(64)) AS i FROM pixels) GROUP BY ALL)"""


@query("nodata_mask", f"WITH {_MASK} SELECT tile_id, string_agg(cast(cast(m AS int) AS varchar), '' ORDER BY i) AS mask FROM mask GROUP BY tile_id")
def nodata_mask(spark, sf_dir):
    mask = F.transform(stretch.pixel_mask(F.col("bands"), -9.0), lambda m: m.cast("int").cast("string"))
    return _stacked(spark, sf_dir).select("tile_id", F.array_join(mask, "").alias("mask"))


@query("skip_empty_tiles", f"WITH {_MASK} SELECT tile_id FROM mask GROUP BY tile_id HAVING NOT bool_and(m)")
def skip_empty_tiles(spark, sf_dir):
    return _stacked(spark, sf_dir).filter(~stretch.all_masked(stretch.pixel_mask(F.col("bands"), -9.0))).select("tile_id")


@query("padded_read", f"WITH {fx.PIXELS} SELECT vec_id, k::int AS k, (CASE WHEN k%10<8 AND k//10<8 THEN cast(pixels[(k//10)*8+k%10+1] AS double) ELSE CASE WHEN band=0 THEN 0 ELSE band END END)::double AS pixel FROM (SELECT *, unnest(range(100)) AS k FROM pixels)")
def padded_read(spark, sf_dir):
    fill = F.when(F.col("band") > 0, F.col("band").cast("double"))
    return fx.pixels(spark, sf_dir).select("vec_id", stretch.padded(F.col("pixels"), F.lit(8), F.lit(8), 10, fill).alias("pixels")).select("vec_id", F.posexplode("pixels").alias("k", "pixel"))


# --- suppression ---------------------------------------------------------------------------------------

_RULES = {
    "nms": ("conf DESC, det_id DESC", "inter/(ka+ca-inter+cast(1e-9 AS double))>0.30"),
    "nested": ("area+cast(1e-9 AS double) DESC, conf DESC, det_id", "cconf<=kconf AND ((cx1>=kx1-3 AND cy1>=ky1-3 AND cx2<=kx2+3 AND cy2<=ky2+3) OR inter/(ca+cast(1e-9 AS double))>=0.85)"),
    "cut": ("greatest(area,cast(1e-9 AS double)) DESC, conf DESC, det_id", "(cx1>=kx1-3 AND cy1>=ky1-3 AND cx2<=kx2+3 AND cy2<=ky2+3) OR inter/greatest(ca,cast(1e-9 AS double))>=0.90"),
    "dup": ("conf DESC, det_id DESC", "inter/greatest(ka+ca-inter,cast(1e-9 AS double))>=0.90"),
}


def _suppress_sql(n: str, source: str, rule: str, keys: str = "image_id, class_id") -> str:
    """Walk each group in order, carrying the ids kept; a row stays unless a kept id is among its rivals."""
    order, test = _RULES[rule]
    same = " AND ".join(f"k.{c.strip()}=c.{c.strip()}" for c in keys.split(","))
    return f"""{n}_o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM (SELECT *, (x2-x1)*(y2-y1) AS area FROM {source})),
{n}_e AS MATERIALIZED (SELECT cid, list(kid) AS his FROM (
    SELECT c.det_id cid, k.det_id kid, k.area ka, c.area ca, c.conf cconf, k.conf kconf, c.x1 cx1, c.y1 cy1, c.x2 cx2, c.y2 cy2, k.x1 kx1, k.y1 ky1, k.x2 kx2, k.y2 ky2,
      greatest(least(k.x2,c.x2)-greatest(k.x1,c.x1),0)*greatest(least(k.y2,c.y2)-greatest(k.y1,c.y1),0) AS inter
    FROM {n}_o k JOIN {n}_o c ON {same} AND k.rn<c.rn AND c.x1<=k.x2+3 AND c.x2>=k.x1-3 AND c.y1<=k.y2+3 AND c.y2>=k.y1-3) WHERE {test} GROUP BY cid),
{n}_r AS MATERIALIZED (SELECT {keys}, rn, det_id, coalesce(his, []) AS his FROM {n}_o LEFT JOIN {n}_e ON det_id=cid),
{n}_w AS (SELECT {keys}, rn, CASE WHEN true THEN [det_id] END AS kept FROM {n}_r WHERE rn=1
  UNION ALL SELECT {", ".join("r." + c.strip() for c in keys.split(","))}, r.rn, CASE WHEN list_has_any(w.kept, r.his) THEN w.kept ELSE list_append(w.kept, r.det_id) END
  FROM {n}_w w JOIN {n}_r r ON {" AND ".join(f"w.{c.strip()}=r.{c.strip()}" for c in keys.split(","))} AND r.rn=w.rn+1),
{n} AS MATERIALIZED (SELECT s.* FROM {source} s JOIN (SELECT unnest(arg_max(kept, rn)) AS det_id FROM {n}_w GROUP BY {keys}) USING (det_id))"""


_OUT = "det_id, image_id, class_id, conf"


def _kept(rule: suppress.Rule, strategy: str = "auto") -> Query:
    return lambda spark, sf_dir: suppress.suppress(fx.detections(spark, sf_dir), rule, strategy=strategy).select("det_id", "image_id", "class_id", "conf")


for _name, _key, _rule, _how in (
    ("nms_per_class", "nms", suppress.nms(0.30), "auto"), ("nms_conflict_graph", "nms", suppress.nms(0.30), "graph"), ("nested_suppression", "nested", suppress.nested(0.85, 3, 0), "auto"),
    ("nested_conflict_graph", "nested", suppress.nested(0.85, 3, 0), "graph"), ("cut_box_dedup", "cut", suppress.cut_boxes(0.90, 3), "auto"), ("duplicate_nms", "dup", suppress.duplicates(0.90), "auto"),
):
    query(_name, f"WITH RECURSIVE {fx.DETECTIONS}, {_suppress_sql('k1', 'detections', _key)} SELECT {_OUT} FROM k1")(_kept(_rule, _how))

_MERGED = f"WITH RECURSIVE {fx.DETECTIONS}, chosen AS (SELECT * FROM detections WHERE conf>=0.25), {_suppress_sql('k1', 'chosen', 'nms')}, {_suppress_sql('k2', 'k1', 'nested')}"


@query("merge_pipeline", f"{_MERGED}, {fx.RASTERS} SELECT k2.det_id, image_id, class_id, conf, a*x1+c AS minx, e*(y2+1)+f AS miny, a*(x2+1)+c AS maxx, e*y1+f AS maxy FROM k2 JOIN rasters USING (image_id)")
def merge_pipeline(spark, sf_dir):
    merged = pipelines.merge_detections(fx.detections(spark, sf_dir), min_conf=0.25)
    out = pipelines.georeference(merged, fx.rasters(spark, sf_dir)).orderBy(F.desc("conf"), "det_id")
    return out.select("det_id", "image_id", "class_id", "conf", "minx", "miny", "maxx", "maxy")


@query("merge_reduction", f"{_MERGED} SELECT n AS before, m AS after, 100*(1-m/n) AS reduction FROM (SELECT (SELECT count(*) FROM detections) AS n, (SELECT count(*) FROM k2) AS m)")
def merge_reduction(spark, sf_dir):
    d = fx.detections(spark, sf_dir)
    kept = pipelines.merge_detections(d, min_conf=0.25).agg(F.count("*").alias("after"))
    both = d.agg(F.count("*").alias("before")).join(kept)
    return both.select("before", "after", profile.reduction_percent(F.col("before"), F.col("after")).alias("reduction"))


def _export_sql(keys: str) -> str:
    return f"WITH RECURSIVE {fx.DETECTIONS}, chosen AS (SELECT * FROM detections WHERE conf>=0.25), {_suppress_sql('k1', 'chosen', 'cut', keys)}, {_suppress_sql('k2', 'k1', 'dup', keys)} SELECT {_OUT} FROM k2"


@query("export_pipeline", _export_sql("image_id, class_id"))
def export_pipeline(spark, sf_dir):
    return pipelines.export_detections(fx.detections(spark, sf_dir), by_class=True).select("det_id", "image_id", "class_id", "conf")


@query("export_class_agnostic", _export_sql("image_id"))
def export_class_agnostic(spark, sf_dir):
    return pipelines.export_detections(fx.detections(spark, sf_dir)).select("det_id", "image_id", "class_id", "conf")


@query("metadata_join", f"WITH {fx.DETECTIONS}, {fx.RASTERS} SELECT image_id, count(*) AS n, min(w) AS w, min(h) AS h FROM detections JOIN rasters USING (image_id) GROUP BY image_id")
def metadata_join(spark, sf_dir):
    return fx.detections(spark, sf_dir).join(fx.rasters(spark, sf_dir), "image_id").groupBy("image_id").agg(F.count("*").alias("n"), F.min("w").alias("w"), F.min("h").alias("h"))


@query("metadata_missing", f"WITH {fx.DETECTIONS}, {fx.RASTERS} SELECT image_id, count(*) AS n FROM detections WHERE image_id NOT IN (SELECT image_id FROM rasters) GROUP BY image_id")
def metadata_missing(spark, sf_dir):
    return pipelines.images_without_raster(fx.detections(spark, sf_dir), fx.rasters(spark, sf_dir))


# --- evaluation --------------------------------------------------------------------------------------

_MATCH = fx.TRUTH + """, preds AS (SELECT * FROM detections WHERE conf>=0.25),
cand AS MATERIALIZED (SELECT det_id, image_id, list(gt_id ORDER BY iou DESC, gt_id) AS gts FROM (
    SELECT p.det_id, p.image_id, g.gt_id, inter/((p.x2-p.x1)*(p.y2-p.y1)+(g.x2-g.x1)*(g.y2-g.y1)-inter+cast(1e-6 AS double)) AS iou
    FROM preds p JOIN truth g ON p.image_id=g.image_id AND p.x1<=g.x2 AND p.x2>=g.x1 AND p.y1<=g.y2 AND p.y2>=g.y1,
    LATERAL (SELECT (least(p.x2,g.x2)-greatest(p.x1,g.x1))*(least(p.y2,g.y2)-greatest(p.y1,g.y1)) AS inter)) WHERE iou>=0.5 GROUP BY ALL),
ord AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY image_id ORDER BY det_id) rn FROM cand),
walk AS (SELECT image_id, rn, det_id, gts[1] AS got, [gts[1]] AS used FROM ord WHERE rn=1
  UNION ALL SELECT o.image_id, o.rn, o.det_id, list_filter(o.gts, lambda x: NOT list_contains(w.used, x))[1], CASE WHEN len(list_filter(o.gts, lambda x: NOT list_contains(w.used, x)))>0
    THEN list_append(w.used, list_filter(o.gts, lambda x: NOT list_contains(w.used, x))[1]) ELSE w.used END FROM walk w JOIN ord o ON o.image_id=w.image_id AND o.rn=w.rn+1),
matched AS MATERIALIZED (SELECT p.*, got AS matched_gt, cast(CASE WHEN got IS NULL THEN 0 ELSE 1 END AS int) AS tp FROM preds p LEFT JOIN walk USING (det_id)),
curve AS MATERIALIZED (SELECT det_id, image_id, conf, tp, row_number() OVER o AS seq, (sum(tp) OVER o)/(row_number() OVER o) AS precision, (sum(tp) OVER o)/((SELECT count(*) FROM truth)+cast(1e-6 AS double)) AS recall
  FROM matched WINDOW o AS (ORDER BY conf DESC, image_id, det_id ROWS UNBOUNDED PRECEDING))"""


def _matched(spark, sf_dir):
    preds = fx.detections(spark, sf_dir).filter(bx.confident(F.col("conf"), 0.25))
    return ev.greedy_match(preds, fx.truth(spark, sf_dir), 0.5)


def _curve(spark, sf_dir):
    return ev.pr_curve(_matched(spark, sf_dir), fx.truth(spark, sf_dir).count())


@query("gt_match", f"WITH RECURSIVE {_MATCH} SELECT det_id, image_id, coalesce(matched_gt, -1) AS matched_gt, tp FROM matched")
def gt_match(spark, sf_dir):
    return _matched(spark, sf_dir).select("det_id", "image_id", F.coalesce("matched_gt", F.lit(-1).cast("long")).alias("matched_gt"), "tp")


@query("pr_curve", f"WITH RECURSIVE {_MATCH} SELECT det_id, tp, seq, precision, recall FROM curve")
def pr_curve(spark, sf_dir):
    return _curve(spark, sf_dir).select("det_id", "tp", "seq", "precision", "recall")


_LEVELS = ", ".join(f"({t!r}::double, {i})" for i, t in enumerate(ev.LEVELS))
_AP = f", best AS (SELECT i, max(precision) AS p FROM (VALUES {_LEVELS}) l(t, i) LEFT JOIN curve ON recall>=t GROUP BY i), ap AS (SELECT round(sum(coalesce(p, 0))/11, 9) AS ap FROM best), fin AS (SELECT arg_max(precision, seq) AS p, arg_max(recall, seq) AS r FROM curve)"


@query("ap_11pt", f"WITH RECURSIVE {_MATCH}{_AP} SELECT ap, p AS precision, r AS recall, 2*p*r/(p+r+cast(1e-6 AS double)) AS f1 FROM ap, fin")
def ap_11pt(spark, sf_dir):
    out = ev.average_precision(_curve(spark, sf_dir)).withColumn("f1", bx.f1(F.col("precision"), F.col("recall")))
    return out.withColumn("ap", F.round("ap", 9))


def renamed(sql: str, names: tuple[str, ...], k: int) -> str:
    """The table names in ``sql`` with a number behind each."""
    import re

    return re.sub(rf"\b({'|'.join(names)})\b(?=\s*(?:AS (?:MATERIALIZED )?\(|[,.)]|\s|$))", rf"\g<1>{k}", sql)


def _map_sql(thresholds: tuple[float, ...]) -> str:
    """The matching walk once per threshold, under names of its own."""
    import re

    base, walk = _MATCH.split(",\ncand AS", 1)
    parts = [re.sub(r"\b(cand|ord|walk|matched|curve)\b", rf"\g<1>{k}", "cand AS" + walk.replace("iou>=0.5", f"iou>={t}::double")) for k, t in enumerate(thresholds)]
    best = [f"b{k} AS (SELECT sum(coalesce(p, 0))/11 AS ap FROM (SELECT i, max(precision) AS p FROM (VALUES {_LEVELS}) l(t, i) LEFT JOIN curve{k} ON recall>=t GROUP BY i))" for k in range(len(thresholds))]
    mean = "+".join(f"b{k}.ap" for k in range(len(thresholds)))
    return f"WITH RECURSIVE {base}, {', '.join([*parts, *best])} SELECT round(b0.ap, 9) AS map50, round(({mean})/{len(thresholds)}, 9) AS map50_95 FROM {', '.join(f'b{k}' for k in range(len(thresholds)))}"


@query("mean_average_precision", _map_sql(tuple((50 + 5 * k) / 100 for k in range(10))))
def mean_average_precision(spark, sf_dir):
    preds = fx.detections(spark, sf_dir).filter(bx.confident(F.col("conf"), 0.25))
    out = ev.mean_average_precision(preds, fx.truth(spark, sf_dir))
    return out.select(F.round("map50", 9).alias("map50"), F.round("map50_95", 9).alias("map50_95"))


_SIZE = "CASE WHEN (x2-x1)*(y2-y1)/262144<0.01 THEN 'small' WHEN (x2-x1)*(y2-y1)/262144<0.04 THEN 'medium' ELSE 'large' END"


@query("size_buckets", f"WITH {fx.DETECTIONS} SELECT size, count(*) AS n FROM (SELECT {_SIZE} AS size FROM detections) GROUP BY size")
def size_buckets(spark, sf_dir):
    return fx.detections(spark, sf_dir).groupBy(bx.size_class(bx.Box.of()).alias("size")).agg(F.count("*").alias("n"))


@query("metrics_by_size", f"WITH RECURSIVE {_MATCH}, d AS (SELECT {_SIZE} AS size, count(*) n, sum(tp) t FROM matched GROUP BY 1), g AS (SELECT {_SIZE} AS size, count(*) g FROM truth GROUP BY 1) "
       "SELECT size, p AS precision, r AS recall, 2*p*r/(p+r+cast(1e-6 AS double)) AS f1 FROM (SELECT size, coalesce(t,0)/greatest(coalesce(n,0),1) AS p, coalesce(t,0)/(coalesce(g,0)+cast(1e-6 AS double)) AS r FROM d FULL JOIN g USING (size))")  # fmt: skip
def metrics_by_size(spark, sf_dir):
    return ev.metrics_by_size(_matched(spark, sf_dir), fx.truth(spark, sf_dir))


@query("confusion_matrix", f"WITH RECURSIVE {_MATCH} SELECT coalesce(t.class_id,-1) AS true_class, coalesce(m.class_id,-1) AS pred_class, count(*) AS n FROM matched m FULL JOIN truth t ON m.matched_gt=t.gt_id GROUP BY 1, 2")
def confusion_matrix(spark, sf_dir):
    return ev.confusion_matrix(_matched(spark, sf_dir), fx.truth(spark, sf_dir))


# --- profiles ----------------------------------------------------------------------------------------


@query("layer_profile", f"WITH {fx.FEATURES}, f AS (SELECT *, CASE WHEN feature_id%3=0 THEN 'Polygon' ELSE 'MultiPolygon' END AS kind FROM features) SELECT image_id AS layer, kind AS geom_type, count(*) AS n, min(x1) minx, min(y1) miny, max(x2) maxx, max(y2) maxy FROM f GROUP BY 1, 2")
def layer_profile(spark, sf_dir):
    f = fx.features(spark, sf_dir).withColumn("kind", F.when(F.col("feature_id") % 3 == 0, "Polygon").otherwise("MultiPolygon"))
    b = bx.Box.of()
    made = profile.layer_profile(f.withColumn("layer", F.concat_ws("|", "image_id", "kind")), F.col("kind"), F.lit(True), F.lit(False), tuple(b))
    parts = F.split("layer", "\\|")
    return made.select(F.get(parts, 0).alias("layer"), F.get(parts, 1).alias("geom_type"), F.element_at(F.map_values("geom_types"), 1).alias("n"), "minx", "miny", "maxx", "maxy")


@query("infer_counters", f"WITH {fx.TILED} SELECT status, count(DISTINCT tile) AS tiles, count(x1) AS boxes FROM (SELECT *, CASE WHEN tile_c%11=0 THEN 'failed_read' ELSE 'ok' END AS status FROM tiled) GROUP BY status")
def infer_counters(spark, sf_dir):
    return profile.status_counts(fx.tiled_detections(spark, sf_dir).withColumn("status", F.when(F.col("tile_c") % 11 == 0, "failed_read").otherwise("ok")))


def _stub_scorer():
    """Stands for a model: boxes that a tile's content determines; some contents make it fail."""

    def scorer(content):
        v = int(content)
        if v % 11 == 0:
            raise ValueError("cannot be scored")
        return [(v % 50 + k, v % 40, v % 50 + k + 10, v % 40 + 5, (k + 1) / 8, k) for k in range(v % 4)]

    return scorer


_SCORE = fx.TILED + """, named AS (SELECT DISTINCT CASE WHEN tile_r%13=5 THEN replace(tile,'tile','tule') ELSE tile END AS tile, tile_r%13=5 AS bad, tile_r, tile_c, tile_c*7+tile_r AS v FROM tiled),
judged AS (SELECT *, CASE WHEN bad THEN 'bad_name' WHEN v%17=3 THEN 'failed_read' WHEN v%11=0 THEN 'failed_infer' ELSE 'ok' END AS status FROM named),
boxes AS (SELECT tile, tile_r, tile_c, v, k FROM (SELECT *, unnest(range(1, v%4)) AS k FROM judged WHERE status='ok'))
SELECT tile, status, CAST(NULL AS DOUBLE) AS x1, CAST(NULL AS DOUBLE) AS y2, CAST(NULL AS DOUBLE) AS conf FROM judged WHERE status<>'ok' OR v%4<2
UNION ALL SELECT tile, 'ok', v%50+k+tile_c*64, v%40+5+tile_r*64, (k+1)/8 FROM boxes"""


@query("score_tiles", f"WITH {_SCORE}")
def score_tiles(spark, sf_dir):
    d = fx.tiled_detections(spark, sf_dir).select("tile", "tile_r", "tile_c").distinct()
    v = F.col("tile_c") * 7 + F.col("tile_r")
    name = F.when(F.col("tile_r") % 13 == 5, F.replace("tile", F.lit("tile"), F.lit("tule"))).otherwise(F.col("tile"))
    tiles = d.select(name.alias("tile"), F.when(v % 17 != 3, v.cast("string").cast("binary")).alias("content"))
    return score.score_tiles(tiles, _stub_scorer, STRIDE, conf=0.25).select("tile", "status", "x1", "y2", "conf")


@query("draw_list", f"WITH {fx.TILED}, loc AS (SELECT *, " + ", ".join(f"greatest(0,least(cast(round_even({c}-{t}*64,0) AS int),255)) {o}" for c, t, o in (("x1", "tile_c", "lx1"), ("y1", "tile_r", "ly1"), ("x2", "tile_c", "lx2"), ("y2", "tile_r", "ly2"))) + " FROM tiled WHERE conf>=0.25) SELECT det_id, tile, least(lx1,lx2) dx1, least(ly1,ly2) dy1, greatest(lx1,lx2) dx2, greatest(ly1,ly2) dy2, greatest(0, least(ly1,ly2)-5) AS text_y FROM loc")
def draw_list(spark, sf_dir):
    return pipelines.draw_list(fx.tiled_detections(spark, sf_dir), STRIDE, 256, 256).select("det_id", "tile", "dx1", "dy1", "dx2", "dy2", "text_y")


@query("final_sort_rank", f"WITH {fx.DETECTIONS} SELECT det_id, cast(row_number() OVER (PARTITION BY image_id ORDER BY conf DESC, det_id) AS int) AS rank FROM detections")
def final_sort_rank(spark, sf_dir):
    return fx.detections(spark, sf_dir).select("det_id", F.row_number().over(Window.partitionBy("image_id").orderBy(F.desc("conf"), "det_id")).alias("rank"))
