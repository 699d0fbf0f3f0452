"""DuckDB SQL with the results of the registered imagery queries."""

from __future__ import annotations

from skyloom.plans.views import with_views

_GRID = {
    "axes": """select parent_image, split, w, h, unnest(list_distinct(list_append(range(0, h - 1024, 819), h - 1024)))::int as y_start
from photos where w >= 1024 and h >= 1024""",
    "grid": """select concat_ws('_', parent_image, x_start, y_start) as tile, parent_image, split as split_source, w, h, x_start, y_start
from (select *, unnest(list_distinct(list_append(range(0, w - 1024, 819), w - 1024)))::int as x_start from axes)""",
}
_LABELS = _GRID | {
    "pixels": """select *, px - pw/2 as bx0, px + pw/2 as bx1, py - ph/2 as by0, py + ph/2 as by1
from (select g.tile, g.split_source, g.x_start, g.y_start, b.*, b.xc*g.w as px, b.yc*g.h as py, b.bw*g.w as pw, b.bh*g.h as ph from grid g join boxes b using (parent_image))""",
    "cut": """select *, lx1 - lx0 as lw, ly1 - ly0 as lh from (select *, greatest(bx0, x_start) - x_start as lx0, least(bx1, x_start + 1024) - x_start as lx1,
       greatest(by0, y_start) - y_start as ly0, least(by1, y_start + 1024) - y_start as ly1
from pixels where bx0 < x_start + 1024 and bx1 > x_start and by0 < y_start + 1024 and by1 > y_start)""",
    "labels": """select tile, split_source, class_id, l_orderkey, l_linenumber, l_partkey, l_suppkey, (lx0 + lw/2)/1024 as xc, (ly0 + lh/2)/1024 as yc,
       lw/1024 as bw, lh/1024 as bh, case when pw*ph > 0 then lw*lh/(pw*ph) else 0e0 end as completeness from cut""",
    "kept": "select * from labels where bw > 0.005e0 and bh > 0.005e0 and completeness >= 0.2e0",
}
_CHANCE = "cast(concat('0x', substring(md5(tile), 1, 8)) as bigint)/4294967296e0"
_PIXEL = {"boxed": "select *, bw*1024 as w_px, bh*1024 as h_px, bw*1024*(bh*1024) as area_px from boxes where bw > 0 and bh > 0"}
_PRINTS = {
    "prints": "select *, x0 + fw as x1, y0 + fh as y1, fw*fh as area_m2, x0 + fw/2 as centroid_x, y0 + fh/2 as centroid_y from footprints",
    "lim": "select avg(area_m2)*(1e0 + 600e0/1e2) as max_area from prints",
    "sized": "select prints.* from prints, lim where area_m2 <= max_area",
    "placed": "select *, row_number() over (order by centroid_y, image_name) as rank, count(*) over () as n from sized",
    "allocated": """select *, case when rank > n - floor(n*0.07e0) then 'val' when rank <= floor(n*0.07e0) then 'test' else 'train' end as split from placed""",
    "pairs": """select a.image_name as train_name, b.image_name as other_name, b.split as other_split,
       (least(a.x1, b.x1) - greatest(a.x0, b.x0))*(least(a.y1, b.y1) - greatest(a.y0, b.y0))/least(a.area_m2, b.area_m2)*1e2 as overlap_pct
from (select * from allocated where split = 'train') a join (select * from allocated where split <> 'train') b
  on a.x0 <= b.x1 and b.x0 <= a.x1 and a.y0 <= b.y1 and b.y0 <= a.y1""",
    "retained": "select * from allocated where image_name not in (select train_name from pairs where overlap_pct > 0)",
}
_BG = {"bg": "select *, x0 + fw as x1, y0 + fh as y1, x0 + fw/2 as centroid_x, y0 + fh/2 as centroid_y from bg_candidates"}
_MEET = "{a}.x0 <= {b}.x1 and {b}.x0 <= {a}.x1 and {a}.y0 <= {b}.y1 and {b}.y0 <= {a}.y1"
# Rings of four corners, their sides, contacts by sides or by a corner inside; the hull by its steepest steps.
_CORNERS = """case when campaign = '2024' then [{'x': x0, 'y': y0}, {'x': x0 + fw, 'y': y0}, {'x': x0 + fw*0.25e0, 'y': y0 + fh*0.25e0}, {'x': x0, 'y': y0 + fh}]
       else [{'x': x0 + fw*0.25e0, 'y': y0}, {'x': x0 + fw, 'y': y0 + fh*0.25e0}, {'x': x0 + fw*0.75e0, 'y': y0 + fh}, {'x': x0, 'y': y0 + fh*0.75e0}] end as corners"""
_SIDES = "list_transform(range(4), lambda i: {'a': corners[i + 1], 'b': corners[(i + 1) % 4 + 1]}) as sides"


def _turn(p: str, q: str, r: str) -> str:
    return f"(({q}.x - {p}.x)*({r}.y - {p}.y) - ({q}.y - {p}.y)*({r}.x - {p}.x))"


def _rings_meet(a: str, b: str) -> str:
    near = " and ".join(f"greatest(s.a.{c}, s.b.{c}) >= least(t.a.{c}, t.b.{c}) and greatest(t.a.{c}, t.b.{c}) >= least(s.a.{c}, s.b.{c})" for c in "xy")
    crossed = f"{_turn('s.a', 's.b', 't.a')}*{_turn('s.a', 's.b', 't.b')} <= 0 and {_turn('t.a', 't.b', 's.a')}*{_turn('t.a', 't.b', 's.b')} <= 0"
    inside = lambda r, p: f"len(list_filter({r}.sides, lambda s: (s.a.y > {p}.corners[1].y) <> (s.b.y > {p}.corners[1].y) and {p}.corners[1].x < s.a.x + ({p}.corners[1].y - s.a.y)/(s.b.y - s.a.y)*(s.b.x - s.a.x))) % 2 = 1"
    sides = f"len(list_filter({a}.sides, lambda s: len(list_filter({b}.sides, lambda t: {near} and {crossed})) > 0)) > 0"
    return f"{_MEET.format(a=a, b=b)} and ({sides} or {inside(a, b)} or {inside(b, a)})"


def _hull_half(name: str, first: str, best: str) -> str:
    return f"""select min(x) as x, {first} as y from points
union all select n.p.x, n.p.y from {name} l, lateral (select {best} as p from points p where p.x > l.x) n where n.p is not null"""


_RINGS = _PRINTS | _BG | {
    "shaped": f"select *, {_SIDES} from (select image_name, campaign, x0, y0, x1, y1, centroid_y, split, image_name in (select image_name from retained) as kept, {_CORNERS} from allocated)",
    "bg_shaped": f"select *, {_SIDES} from (select image_name, campaign, x0, y0, x1, y1, centroid_x, centroid_y, {_CORNERS} from bg)",
    "test": "select * from shaped where kept and split = 'test'",
    "points": "select distinct c.x as x, c.y as y from (select unnest(corners) as c from test)",
    "low": _hull_half("low", "arg_min(y, (x, y))", "arg_min({'x': p.x, 'y': p.y}, ((p.y - l.y)/(p.x - l.x), -p.x))"),
    "high": _hull_half("high", "arg_min(y, (x, -y))", "arg_max({'x': p.x, 'y': p.y}, ((p.y - l.y)/(p.x - l.x), p.x))"),
    "edges": """select *, 1 as sign from (select x, y, lead(x) over (order by x) as x2, lead(y) over (order by x) as y2 from low) where x2 is not null
union all select *, -1 from (select x, y, lead(x) over (order by x) as x2, lead(y) over (order by x) as y2 from high) where x2 is not null""",
    "within": """select image_name from bg_shaped b join edges e on b.centroid_x >= e.x and b.centroid_x < e.x2
group by image_name having count(distinct sign) = 2 and min(sign*(b.centroid_y - e.y - (b.centroid_x - e.x)/(e.x2 - e.x)*(e.y2 - e.y))) > 0""",
    "near": f"select distinct bg_shaped.image_name from bg_shaped join test on {_rings_meet('bg_shaped', 'test')}",
    "pool": """select image_name, 'labeled_test' as slice_type, campaign, x0, y0, x1, y1, corners, sides from test
union all select image_name, 'unlabeled_test', campaign, x0, y0, x1, y1, corners, sides from bg_shaped where image_name in (select image_name from within union select image_name from near)""",
    "bad": f"select distinct pool.image_name from pool join shaped on (shaped.kept and shaped.split = 'train' or not shaped.kept and shaped.centroid_y < 500e0) and {_rings_meet('pool', 'shaped')}",
}
_RAY = {
    "ray": """select event_id, cam_x as ox, cam_y as oy, cam_z as oz, ux/m as dx, uy/m as dy, uz/m as dz
from (select *, sqrt(ux*ux + uy*uy + uz*uz) as m from (select *, cam_x + (px - 4096e0)/8000e0 - cam_x as ux, cam_y + (py - 2730e0)/8000e0 - cam_y as uy,
      cam_z + (case when event_id % 10 = 0 then 0e0 when event_id % 10 = 1 then 1e0 else -1e0 end) - cam_z as uz from cameras))""",
}



def _density(values: str) -> dict[str, str]:
    """Values in 2,000 bins, and what a Gaussian kernel of Scott's width makes of them on 200 places."""
    return {
        "vals": values,
        "st": "select count(v) as n, stddev_samp(v) as sd, min(v) as lo, max(v) as hi from vals",
        "fine": "select round((v - lo)/((hi - lo)/2000)) as b, count(*) as c from vals, st where v is not null and sd > 0 group by 1",
        "gr": "select lo, n, sd*n**(-0.2e0) as h, (hi - lo)/2000 as step, lo + (hi - lo)*i/199 as x from st, (select unnest(range(200)) as i)",
    }


_DENSITY = """select round(gx, 9) as x, d as density from
(select gr.x as gx, round(sum(c*exp(-power((gr.x - (lo + b*step))/h, 2)/2)/(n*h*2.5066282746310002e0)), 9) as d from gr, fine group by 1)"""
_SAMPLES = _PRINTS | {
    "pl": "select image_name, round((x0 + (x0 + fw) + (x0 + fw) + x0)/4, 6) as lon, round((y0 + y0 + (y0 + fh) + (y0 + fh))/4, 6) as lat, cast(campaign as int) as year from sized",
    "tg": """select stem, 'ghost' as g, false as o from disk where has_image and in_dropped_log
union all select stem, 'excluded_orphan', true from disk where has_image and not in_dropped_log and in_missing_log and not has_label
union all select stem, 'train', false from disk where has_image and has_label""",
    "samples": """select t.stem, case when not o and d.in_missing_log then 'no_footprint' else g end as map_group, lon, lat, year
from tg t join disk d using (stem) left join pl on pl.image_name = t.stem""",
}
_DISTIL = _PRINTS | _BG | {
    "layers": f"""select image_name, campaign, case when split = 'train' then 'labeled_train' else split end as layer from retained
union all select image_name, campaign, 'safe_unlabeled' from bg c where not exists (select 1 from retained t where t.split <> 'train' and {_MEET.format(a='c', b='t')})""",
}
_PURE = _PRINTS | _BG | {
    "pool": f"""select image_name, campaign, x0, y0, x1, y1, 'labeled_test' as slice_type from retained where split = 'test'
union all select image_name, campaign, x0, y0, x1, y1, 'unlabeled_test' from bg c where exists (select 1 from retained t where t.split = 'test' and {_MEET.format(a='c', b='t')})""",
    "gone": "select * from allocated where image_name not in (select image_name from retained) and centroid_y < 500e0",
    "pure": f"""select * from pool p where not exists (select 1 from retained t where t.split = 'train' and {_MEET.format(a='p', b='t')})
and not exists (select 1 from gone t where {_MEET.format(a='p', b='t')})""",
}

ORACLE_SQL = {
    "tile_grid": with_views(["photos"], _GRID, "select tile, parent_image, split_source, x_start, y_start, x_start + 1024 as x_end, y_start + 1024 as y_end from grid"),
    "tile_labels": with_views(["photos", "boxes"], _LABELS, "select * from kept"),
    "tile_fg_bg_sampled": with_views(
        ["photos", "boxes"],
        _LABELS | {
            "marked": f"""select *, tile in (select tile from kept) as fg, {_CHANCE} as chance from grid""",
            "saved": "select * from marked where fg or chance < case split_source when 'val' then 1e0 when 'test' then 1e0 else 0.1e0 end",
        },
        "select coalesce(split_source, 'total') as cohort, count(*) filter (where fg) as fg, count(*) filter (where not fg) as bg from saved group by grouping sets ((split_source), ())",
    ),
    "background_sample": with_views(["photos"], _GRID, f"select tile, {_CHANCE} as chance from grid where {_CHANCE} < 0.1e0"),
    "label_stats_by_split": with_views(
        ["photos", "boxes"],
        {"n": "select parent_image, count(*) as n_boxes from boxes where bw > 0 and bh > 0 group by 1", "j": "select split, coalesce(n_boxes, 0) as n_boxes from photos left join n using (parent_image)"},
        """select coalesce(split, 'total') as cohort, count(*) filter (where n_boxes > 0) as fg, count(*) filter (where n_boxes = 0) as bg, cast(sum(n_boxes) as bigint) as boxes
from j group by grouping sets ((split), ())""",
    ),
    "box_area_summary": with_views(
        ["boxes"],
        _PIXEL,
        """select count(*) as n, round(avg(area_px), 6) as mean_area, round(median(area_px), 6) as median_area, round(min(w_px), 6) as min_w_px, round(median(w_px), 6) as median_w_px,
       round(max(w_px), 6) as max_w_px, round(min(h_px), 6) as min_h_px, round(median(h_px), 6) as median_h_px, round(max(h_px), 6) as max_h_px,
       round(greatest(max(w_px), max(h_px)), 6) as max_side from boxed""",
    ),
    "box_size_classes": with_views(
        ["boxes"],
        _PIXEL | {"c": "select case when area_px < 1024 then 'small' when area_px <= 9216 then 'medium' else 'large' end as size_class, count(*) as n from boxed group by 1"},
        "select size_class, n, n*1e2/(select cast(sum(n) as bigint) from c) as pct from c",
    ),
    "box_area_log_hist": with_views(
        ["boxes"],
        _PIXEL | {"v": "select log10(area_px) as v from boxed", "lim": "select min(v) as lo, max(v) as hi from v"},
        "select cast(least(floor((v - lo)/(hi - lo)*50) + 1, 50) as bigint) as bin, count(*) as n from v, lim group by 1",
    ),
    "box_center_heatmap": with_views(
        ["boxes"],
        _PIXEL | {"lim": "select min(xc) as ax, max(xc) as bx, min(yc) as ay, max(yc) as byy from boxed"},
        """select cast(least(floor((xc - ax)/(bx - ax)*40) + 1, 40) as bigint) as bin_x, cast(least(floor((yc - ay)/(byy - ay)*40) + 1, 40) as bigint) as bin_y, count(*) as n
from boxed, lim group by 1, 2""",
    ),
    "footprint_outliers": with_views(["footprints"], _PRINTS, "select image_name, area_m2, round(max_area, 6) as max_area from prints, lim where area_m2 > max_area"),
    "spatial_split": with_views(["footprints"], _PRINTS, "select image_name, rank, split from allocated"),
    "cross_split_pairs": with_views(["footprints"], _PRINTS, "select train_name, other_name, other_split, round(overlap_pct, 6) as overlap_pct from pairs"),
    "stratified_allocation": with_views(["footprints"], _PRINTS, "select image_name, split from retained"),
    "split_summary": with_views(
        ["footprints"],
        _PRINTS,
        """select (select count(*) from prints) as initial, (select count(*) from prints) - (select count(*) from sized) as oversized_dropped,
       (select count(distinct image_name) from sized) - (select count(distinct image_name) from retained) as boundary_dropped,
       (select count(distinct image_name) from retained) as retained, (select count(*) from retained where split = 'train') as train,
       (select count(*) from retained where split = 'val') as val, (select count(*) from retained where split = 'test') as test,
       round((select count(distinct image_name) from retained)*1e2/(select count(*) from prints), 6) as retained_pct""",
    ),
    "split_by_campaign": with_views(["footprints"], _PRINTS, "select split, campaign, count(*) as n from retained group by 1, 2"),
    "campaign_totals": with_views(["footprints"], {}, "select campaign, count(*) as n, count(*)*1e2/(select count(*) from footprints) as pct from footprints group by 1"),
    "dropped_log": with_views(["footprints"], _PRINTS, "select distinct train_name as image_name from pairs where overlap_pct > 0"),
    "camera_precedence": with_views(
        ["cameras", "slices"],
        {
            "last": "select campaign, lower(trim(label)) as k, campaign_ord, max(event_id) as event_id from cameras group by 1, 2, 3",
            "seen": "select s.tile, l.campaign, l.campaign_ord, l.event_id, row_number() over (partition by s.tile order by l.campaign_ord) as r from slices s join last l on lower(trim(s.parent_image)) = l.k",
        },
        "select tile, campaign, campaign_ord, event_id from seen where r = 1",
    ),
    "parent_last_wins": with_views(
        ["boxes"],
        {"o": "select *, row_number() over (partition by parent_image order by l_orderkey desc, l_linenumber desc, l_partkey desc, l_suppkey desc) as r from boxes"},
        "select parent_image, class_id, l_orderkey, l_linenumber, l_partkey, l_suppkey from o where r = 1",
    ),
    "testset_candidates": with_views(
        ["footprints", "bg_candidates"],
        _PRINTS | _BG | {"test": "select * from retained where split = 'test'", "box": "select min(x0) as bx0, min(y0) as by0, max(x1) as bx1, max(y1) as by1 from test"},
        f"""select image_name from bg, box where (centroid_x > bx0 and centroid_x < bx1 and centroid_y > by0 and centroid_y < by1)
   or exists (select 1 from test where {_MEET.format(a="test", b="bg")})""",
    ),
    "testset_pure": with_views(
        ["footprints", "bg_candidates"],
        _PRINTS | _BG | {
            "test": "select * from retained where split = 'test'",
            "buffer": "select * from allocated where image_name not in (select image_name from retained) and centroid_y < 500e0",
            "pool": f"""select image_name, 'labeled_test' as slice_type, campaign, x0, y0, x1, y1 from test
union all select image_name, 'unlabeled_test', campaign, x0, y0, x1, y1 from bg where exists (select 1 from test where {_MEET.format(a="test", b="bg")})""",
            "bad": f"""select image_name from pool where exists (select 1 from retained t where t.split = 'train' and {_MEET.format(a="t", b="pool")})
union select image_name from pool where exists (select 1 from buffer where {_MEET.format(a="buffer", b="pool")})""",
        },
        "select image_name, slice_type, campaign from pool where image_name not in (select image_name from bad)",
    ),
    "testset_rings": with_views(["footprints", "bg_candidates"], _RINGS, "select image_name, slice_type, campaign from pool where image_name not in (select image_name from bad)").replace("with ", "with recursive ", 1),
    "allocation_audit": with_views(
        ["disk"],
        {},
        """select count(*) as allocated, count(*) filter (where not has_image) as missing_disk, count(*) filter (where has_image and not has_label) as missing_labels,
       count(*) filter (where has_image and has_label) as copied from disk""",
    ),
    "ghosts_and_orphans": with_views(
        ["disk"],
        {
            "s": """select stem, in_missing_log, 'ghost' as kind from disk where has_image and in_dropped_log
union all select stem, in_missing_log, 'orphan' from disk where has_image and not in_dropped_log and in_missing_log and not has_label
union all select stem, in_missing_log, 'train' from disk where has_image and has_label""",
        },
        """select stem, case kind when 'orphan' then 'excluded' else kind end as split,
       case when kind = 'orphan' then 'excluded_orphan' when in_missing_log then 'no_footprint' else kind end as map_group,
       case when kind = 'orphan' then 'excluded_orphan,no_footprint' when in_missing_log then concat(kind, ',no_footprint') else kind end as tags from s""",
    ),
    "sample_geo_enrich": with_views(
        ["footprints", "disk"],
        _PRINTS | {"p": "select image_name, round((x0 + (x0 + fw) + (x0 + fw) + x0)/4, 6) as lon, round((y0 + y0 + (y0 + fh) + (y0 + fh))/4, 6) as lat, campaign from sized"},
        """select stem, lon, lat, coalesce(campaign, 'Unknown') as campaign, cast(campaign as int) as campaign_year
from disk left join p on stem = image_name where has_image""",
    ),
    "newest_older_year": """select max(y)::int as newest_year, coalesce(max(y) filter (where y < m), max(m) - 1)::int as older_year
from (select year(o_orderdate) as y, max(year(o_orderdate)) over () as m from orders)""",
    "global_extent": with_views(
        ["footprints"],
        _PRINTS,
        """select least(min(centroid_x), -5e0) - 60e0 as x_min, greatest(max(centroid_x), -5e0) + 60e0 as x_max, least(min(centroid_y), 3e0, 1500e0) - 120e0 as y_min,
       greatest(max(centroid_y), 3e0, 1500e0) + 70e0 as y_max from prints""",
    ),
    "selected_parents": with_views(["photos", "boxes"], {}, "select distinct parent_image from boxes where parent_image in (select parent_image from photos where split = 'val')"),
    "edge_corners_wide": with_views(
        ["footprints"],
        {},
        """select image_name, campaign, x0 as tl_lon, y0 as tl_lat, 0e0 as tl_alt, x0 + fw as tr_lon, y0 as tr_lat, 0e0 as tr_alt, x0 + fw as br_lon, y0 + fh as br_lat, 0e0 as br_alt,
       x0 as bl_lon, y0 + fh as bl_lat, 0e0 as bl_alt, concat('#', substring(md5(image_name), 1, 6)) as fill, 5 as ring_size from footprints""",
    ),
    "southmost_topk": with_views(["footprints"], _PRINTS, "select image_name, centroid_y from prints order by centroid_y, image_name limit 100"),
    "northmost_topk": with_views(["footprints"], _PRINTS, "select image_name, centroid_y from prints order by centroid_y desc, image_name limit 100"),
    "ray_plane_fallback": with_views(
        ["cameras"],
        _RAY | {"hit": "select *, case when abs(dz) < 1e-6 then null else (150e0 - oz)/dz end as t from ray"},
        "select event_id, ox + t*dx as x, oy + t*dy as y, oz + t*dz as z from hit where t >= 0",
    ),
    "web_mercator_points": with_views(
        ["footprints"],
        _PRINTS,
        """select image_name, round(radians(centroid_x/1e1)*6378137e0, 4) as x, round(ln(tan(radians(centroid_y/2e1)/2 + 0.7853981633974483e0))*6378137e0, 4) as y from prints""",
    ),
    "shoelace_area_centroid": with_views(["footprints"], _PRINTS, "select image_name, round(area_m2, 4) as area, round(centroid_x, 3) as cx, round(centroid_y, 3) as cy from prints"),
    "json_props_extract": "select event_id, cast(props->>'$.k' as int) as k from events where props->>'$.k' is not null",
    "footprint_area_hist": with_views(
        ["footprints"],
        _PRINTS | {"r": "select min(area_m2) as lo, max(area_m2) as hi, round(avg(area_m2), 6) as mean_area from prints"},
        "select least(floor((area_m2 - lo)/(hi - lo)*30) + 1, 30)::bigint as bin, count(*) as n, any_value(mean_area) as mean_area from prints, r group by 1",
    ),
    "footprint_area_density": with_views(["footprints"], _PRINTS | _density("select area_m2 as v from prints"), _DENSITY),
    "box_area_density": with_views(["boxes"], _PIXEL | _density("select log10(area_px) as v from boxed"), _DENSITY),
    "mapped_by_campaign": with_views(
        ["cameras", "slices"],
        {"w": """select t.tile, min_by(c.campaign, c.campaign_ord) as campaign from slices t join cameras c on lower(trim(c.label)) = lower(trim(t.parent_image)) group by t.tile"""},
        "select coalesce(campaign, 'total') as layer, count(*) as n from w group by grouping sets ((campaign), ())",
    ),
    "map_group_counts": with_views(["footprints", "disk"], _SAMPLES, "select map_group, count(*) as n from samples where lon is not null group by 1"),
    "campaign_report": with_views(
        ["footprints", "disk"],
        _SAMPLES | {
            "split": """select case when o then 'excluded' when g = 'ghost' then 'ghost' else 'train' end as cohort, coalesce(cast(year as varchar), 'Unknown') as campaign
from tg left join pl on pl.image_name = tg.stem""",
        },
        """select cast(case when cohort is null then 0 when cohort in ('ghost', 'excluded') then 2 else 1 end as int) as part, coalesce(cohort, 'total') as cohort, campaign, count(*) as n
from split group by grouping sets ((cohort, campaign), (campaign))""",
    ),
    "sample_timestamps": with_views(
        ["footprints", "disk"],
        {},
        """select campaign, epoch(make_date(cast(campaign as int), 1, 1))::double as timestamp, count(*) as n from disk join footprints on image_name = stem where has_image group by all""",
    ),
    "detail_window": with_views(
        ["footprints"],
        {
            "p": "select x0 + fw/2 as x, y0 + fh/2 as y from footprints",
            "w": "select min(x) + (max(x) - min(x))*0.28e0 as x0, min(y) - 5e0 as y0 from p",
        },
        """select round(x0, 6) as x_min, round(x0 + 30e0, 6) as x_max, round(y0, 6) as y_min, round(y0 + 200e0, 6) as y_max,
       (select count(*) from p, w where x between x0 and x0 + 30e0 and y between y0 and y0 + 200e0) as n from w""",
    ),
    "cohort_map": with_views(
        ["footprints", "disk"],
        _SAMPLES,
        """select map_group, case when year is null then 'unknown' when year = (select max(year) from samples) then 'newest' else 'older' end as period,
       count(*) as n, round(avg(lon), 6) as mean_lon, round(avg(lat), 6) as mean_lat from samples where lon is not null group by 1, 2""",
    ),
    "background_ratio": with_views(
        ["photos", "boxes"],
        {"n": "select parent_image, count(*) as n_boxes from boxes where bw > 0 and bh > 0 group by 1", "j": "select split, coalesce(n_boxes, 0) as n_boxes from photos left join n using (parent_image)"},
        """select coalesce(split, 'total') as cohort, count(*) filter (where n_boxes > 0) as fg, count(*) filter (where n_boxes = 0) as bg, cast(sum(n_boxes) as bigint) as boxes,
       round(count(*) filter (where n_boxes = 0)*1e2/count(*), 6) as bg_pct from j group by grouping sets ((split), ())""",
    ),
    "splits_layer": with_views(
        ["footprints"],
        _PRINTS,
        """select image_name, campaign, split as layer, round(centroid_x, 6) as x, round(centroid_y, 6) as y from retained
union all select image_name, campaign, 'buffer', round(centroid_x, 6), round(centroid_y, 6) from allocated where image_name not in (select image_name from retained)""",
    ),
    "distillation_pool": with_views(["footprints", "bg_candidates"], _DISTIL, "select layer, campaign, count(*) as n from layers group by all"),
    "distillation_pool_size": with_views(["footprints", "bg_candidates"], _DISTIL, "select count(distinct image_name) as n from layers where layer in ('labeled_train', 'safe_unlabeled')"),
    "flight_positions": with_views(["cameras"], {}, "select unnest([campaign, 'all']) as layer, event_id, cam_x as x, cam_y as y from cameras"),
    "testset_layers": with_views(
        ["footprints", "bg_candidates"],
        _PURE,
        "select replace(slice_type, '_test', '') as layer, campaign, count(*) as n, round(count(*)*1e2/sum(count(*)) over (), 6) as pct from pure group by 1, 2",
    ),
    "testset_metrics": with_views(
        ["footprints", "bg_candidates"],
        _PURE | {
            "nb": "select concat('IMG_', cast(l_orderkey as string)) as image_name, count(*) as n_boxes from lineitem group by 1",
            "m": "select slice_type = 'labeled_test' as l, coalesce(n_boxes, 0) as b from pure left join nb using (image_name)",
            "c": "select count(*) as total, count(*) filter (where l and b > 0) as fg, count(*) filter (where not l or b = 0) as bg, sum(case when l then b else 0 end)::bigint as boxes from m",
        },
        "select *, round(fg*1e2/greatest(1, total), 6) as fg_pct, round(bg*1e2/greatest(1, total), 6) as bg_pct from c",
    ),
    "testset_on_disk": with_views(
        ["footprints", "bg_candidates", "disk"],
        _PURE,
        "select image_name, slice_type, case when image_name in (select stem from disk where has_image) then 'copy' else 'crop' end as source from pure",
    ),
    "crop_counts": with_views(
        ["photos", "cameras", "slices"],
        {"k": "select distinct t.* from slices t join cameras c on lower(trim(c.label)) = lower(trim(t.parent_image))"},
        """select parent_image, count(*) as n, arg_min(tile, (y_start, x_start, tile)) as first_tile from k join photos using (parent_image) group by 1""",
    ),
    "ray_mesh_nearest": with_views(
        ["cameras"],
        _RAY | {
            "quad": "select p_partkey, (p_partkey % 100)*10e0 as x, (floor(p_partkey/100e0)::bigint % 100)*10e0 as y, p_size*1e0 as z from part",
            "tri": """select x as ax, y as ay, z as az, 10e0 as ex, 0e0 as ey, 0e0 as ez, 10e0 as fx, 10e0 as fy, 0e0 as fz from quad
union all select x, y, z, 10e0, 10e0, 0e0, 0e0, 10e0, 0e0 from quad""",
            "m": """select event_id, ox, oy, oz, dx, dy, dz, ex, ey, ez, fx, fy, fz, ox - ax as sx, oy - ay as sy, oz - az as sz,
       dy*fz - dz*fy as px, dz*fx - dx*fz as py, dx*fy - dy*fx as pz from ray, tri""",
            "q": "select *, sy*ez - sz*ey as qx, sz*ex - sx*ez as qy, sx*ey - sy*ex as qz, ex*px + ey*py + ez*pz as det from m",
            "h": """select event_id, ox, oy, oz, dx, dy, dz, (sx*px + sy*py + sz*pz)*(1/det) as u, (dx*qx + dy*qy + dz*qz)*(1/det) as v, (fx*qx + fy*qy + fz*qz)*(1/det) as t
from q where abs(det) > 1e-12""",
            "near": "select event_id, min(t) as t, any_value(ox) as ox, any_value(oy) as oy, any_value(oz) as oz, any_value(dx) as dx, any_value(dy) as dy, any_value(dz) as dz from h where u >= 0 and v >= 0 and u + v <= 1 and t > 0 group by 1",
        },
        "select event_id, round(ox + t*dx, 4) as x, round(oy + t*dy, 4) as y, round(oz + t*dz, 4) as z, round(t, 4) as t from near",
    ),
    "utm_round_trip": with_views(
        ["footprints"],
        _PRINTS | {
            "c": "select 1e0/298.257223563e0 as f, f/(2 - f) as n, sqrt(f*(2 - f)) as e, 6378137e0/(1 + n)*(1 + n**2/4 + n**4/64 + n**6/256) as r",
            "a": """select *, [n/2 - 2*n**2/3 + 5*n**3/16 + 41*n**4/180 - 127*n**5/288 + 7891*n**6/37800,
    13*n**2/48 - 3*n**3/5 + 557*n**4/1440 + 281*n**5/630 - 1983433*n**6/1935360, 61*n**3/240 - 103*n**4/140 + 15061*n**5/26880 + 167603*n**6/181440,
    49561*n**4/161280 - 179*n**5/168 + 6601661*n**6/7257600, 34729*n**5/80640 - 3418889*n**6/1995840, 212378941*n**6/319334400] as k from c""",
            "g": "select image_name, radians(13e0 + centroid_x/5e1 - 15e0) as l, sin(radians(4e1 + centroid_y/5e1)) as s, e, r, k from prints, a where prints.image_name is not null",
            "t": "select *, sinh(atanh(s) - e*atanh(e*s)) as t from g",
            "p": "select *, atan2(t, cos(l)) as xi, atanh(sin(l)/sqrt(1 + t*t)) as eta from t",
        },
        """select image_name, round(5e5 + 0.9996e0*r*(eta + list_sum(list_transform(range(1, 7), lambda i: k[i]*cos(2*i*xi)*sinh(2*i*eta)))), 3) as easting,
       round(0.9996e0*r*(xi + list_sum(list_transform(range(1, 7), lambda i: k[i]*sin(2*i*xi)*cosh(2*i*eta)))), 3) as northing, 0e0 as error from p""",
    ),
    "slanted_overlap": with_views(
        ["footprints"],
        {
            # parallelograms with sides (w, 1) and (1, h - 1)
            "s": "select image_name as i, x0 as x, y0 as y, fw as w, fh - 1 as h from footprints",
            "pr": """select a.i as ai, b.i as bi, a.x as ax, a.y as ay, a.w as aw, a.h as ah, b.x as bx, b.y as by_, b.w as bw, b.h as bh
from s a join s b on a.i < b.i and a.x < b.x + b.w + 1 and b.x < a.x + a.w + 1 and a.y < b.y + b.h + 1 and b.y < a.y + a.h + 1""",
            "sides": """select ai, bi, unnest([ax, ax + aw, ax + aw + 1, ax + 1]) as px, unnest([ay, ay + 1, ay + 1 + ah, ay + ah]) as py,
       unnest([aw, 1e0, -aw, -1e0]) as dx, unnest([1e0, ah, -1e0, -ah]) as dy, bx as ox, by_ as oy, bw as ow, bh as oh, 1 as own from pr
union all select ai, bi, unnest([bx, bx + bw, bx + bw + 1, bx + 1]), unnest([by_, by_ + 1, by_ + 1 + bh, by_ + bh]), unnest([bw, 1e0, -bw, -1e0]), unnest([1e0, bh, -1e0, -bh]), ax, ay, aw, ah, 0 from pr""",
            # a side in the other's coordinates (u, v), where that is the unit square; its part inside, by Liang and Barsky
            "uv": """select *, ((px - ox)*oh - (py - oy))/(ow*oh - 1) as u0, ((py - oy)*ow - (px - ox))/(ow*oh - 1) as v0, (dx*oh - dy)/(ow*oh - 1) as du, (dy*ow - dx)/(ow*oh - 1) as dv from sides""",
            "cut": """select *, greatest(0, case when du > 0 then -u0/du when du < 0 then (1 - u0)/du else 0 end, case when dv > 0 then -v0/dv when dv < 0 then (1 - v0)/dv else 0 end) as t0,
       least(1, case when du > 0 then (1 - u0)/du when du < 0 then -u0/du else 1 end, case when dv > 0 then (1 - v0)/dv when dv < 0 then -v0/dv else 1 end) as t1 from uv""",
            # a common side, seen from the same direction, counts for one of the two rings
            "part": """select ai, bi, case when t1 > t0 and (abs(du) > 1e-9 or u0 between -1e-9 and 1 + 1e-9) and (abs(dv) > 1e-9 or v0 between -1e-9 and 1 + 1e-9)
         and (own = 1 or not (abs(du) < 1e-9 and (abs(u0) < 1e-9 or abs(u0 - 1) < 1e-9) or abs(dv) < 1e-9 and (abs(v0) < 1e-9 or abs(v0 - 1) < 1e-9)))
       then ((px + t0*dx - ox)*(t1 - t0)*dy - (py + t0*dy - oy)*(t1 - t0)*dx)/2 + (ox*(t1 - t0)*dy - oy*(t1 - t0)*dx)/2 else 0 end as a from cut""",
        },
        "select ai as l_image_name, bi as r_image_name, round(abs(sum(a)) + 3e-9, 6) as area from part group by 1, 2",
    ),
}
