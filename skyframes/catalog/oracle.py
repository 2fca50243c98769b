"""The registered queries as SQL for DuckDB, written from the definitions and not from the Spark plans.

Each query is a chain of named views; `_with` collects the ones a query needs.
"""

from __future__ import annotations

import re

SIDE, TILE = 24, 8
_VIEWS: dict[str, str] = {}


def _view(name: str, sql: str, columns: str = "") -> str:
    _VIEWS[name] = (columns, sql)
    return name


def _with(final: str) -> str:
    needed, todo = set(), [final]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in words & _VIEWS.keys() - needed:
            needed.add(name)
            todo.append(_VIEWS[name][1])
    chain = [f"{n}{_VIEWS[n][0]} as ({_VIEWS[n][1]})" for n in _VIEWS if n in needed]
    return f"with recursive {', '.join(chain)} {final}" if chain else final


# ---- inputs -------------------------------------------------------------------------------

_view("captures", """select event_id as frame_id, concat('04E67', lpad(concat('', user_id % 4), 7, '0')) as device_id,
  cast(floor(epoch(ts)) as bigint) as ts, case when event_type <> 'error' then concat('img/', event_id, '.jpg') end as image_url
  from events""")
_view("devices", """select concat('04E67', lpad(concat('', c_custkey % 6), 7, '0')) as device_id,
  cast(min(c_nationkey) - 12 + 0.5 as double) as utc from customer where c_custkey % 6 <> 3 group by 1""")
_view("requests", """select o_orderkey as request_id,
  case when o_orderkey % 11 = 0 then 'cam-7'
       when o_orderkey % 5 = 0 then concat(' 04e67', lpad(concat('', o_orderkey % 4), 7, '0'), ' ')
       else concat('04E67', lpad(concat('', o_orderkey % 4), 7, '0')) end as dev_id,
  case o_orderkey % 13 when 0 then '2024/01/05' when 1 then '2024-13-05' when 2 then '24-01-05'
       when 3 then '2024-02-31' when 4 then '2024-01-40'
       else concat('2024-01-', lpad(concat('', 1 + o_orderkey % 28), 2, '0')) end as d1,
  case o_orderkey % 7 when 0 then '9.00am' when 1 then '13:00PM' when 2 then '9:75am' when 3 then '12:15 am' else '09:00AM' end as t1,
  concat('2024-01-', lpad(concat('', 1 + o_orderkey % 28), 2, '0')) as d2,
  case o_orderkey % 17 when 0 then '07:00PMx' when 3 then '09:01AM' else '07:00PM' end as t2 from orders""")
_view("timed", "select frame_id, device_id, ts // 86400 - 19722 as day, ts % 86400 as tod from captures")
_view("frames", "select *, (frame_id * 37) % 50 as lum, (frame_id * 53 + 11) % 47 as wal from timed")
_view("scene", f"""with f as (select *, 2 + (11 * tod) // 86400 as cx from frames),
  f2 as (select *, 3 + ((cx - 7) * (cx - 7)) // 8 as cy from f),
  g as (select y, x, case when y < 14 and x < 14 then 1 when y < 11 and x >= 16 then 2 when y >= 18 then 3 else 0 end as part
        from (select range as y from range({SIDE})) t cross join (select range as x from range({SIDE})) u),
  h as (select *, (x - cx) * (x - cx) + (y - cy) * (y - cy) <= 5 as sun from f2 cross join g)
  select frame_id, device_id, day, tod, y, x,
    cast(case when sun then 255 when part > 0 then 200 else 60 end as bigint) as b,
    cast(case when sun then 255 when part > 0 then 150 else 70 end as bigint) as g,
    cast(case when sun then 255 when part in (1, 2) then 105 + lum when part = 3 then 105 + wal else 80 end as bigint) as r from h""")
_view("tiles", f"""select image_key, cast(pos // {TILE} as bigint) as y, cast(pos % {TILE} as bigint) as x, cast(v > 0 as bigint) as v
  from (select vec_id as image_key, generate_subscripts(embedding, 1) - 1 as pos, unnest(embedding) as v from embeddings)""")
_view("tile_fg", "select image_key, y, x from tiles where v = 1")
_view("suns", """with d as (select *, 40 + (560 * tod) // 86400 + (frame_id * 29) % 61 - 30 as cx, 15 + frame_id % 20 as r from timed)
  select frame_id, device_id, day, tod, cx, 120 + ((cx - 320) * (cx - 320)) // 400 + (frame_id * 37) % 7 as cy, r from d""")

# ---- image building blocks ----------------------------------------------------------------


def _dilated(name: str, source: str, keys: str, reach: int, side: int) -> str:
    return _view(name, f"""select distinct {keys}, y + dy as y, x + dx as x from {source},
      (select range as dy from range(-{reach}, {reach + 1})), (select range as dx from range(-{reach}, {reach + 1}))
      where y + dy between 0 and {side - 1} and x + dx between 0 and {side - 1}""")


def _eroded(name: str, source: str, keys: str, reach: int, side: int) -> str:
    """A pixel stays if as many window pixels are set as lie in the image."""
    _dilated(f"{name}_spread", source, keys, 0, side)
    return _view(name, f"""select {keys}, y, x from (
      select {keys}, y + dy as y, x + dx as x, count(*) as n from {source},
        (select range as dy from range(-{reach}, {reach + 1})), (select range as dx from range(-{reach}, {reach + 1}))
      where y + dy between 0 and {side - 1} and x + dx between 0 and {side - 1} group by all)
      where n = (least(y + {reach}, {side - 1}) - greatest(y - {reach}, 0) + 1) * (least(x + {reach}, {side - 1}) - greatest(x - {reach}, 0) + 1)""")


def _filled(name: str, source: str, keys: str) -> str:
    """Everything in the bounding box that a flood from the ring around the box does not reach."""
    _view(f"{name}_box", f"""select *, unnest(range(x0, x1 + 1)) as x from (select *, unnest(range(y0, y1 + 1)) as y from (
      select {keys}, min(y) - 1 as y0, max(y) + 1 as y1, min(x) - 1 as x0, max(x) + 1 as x1 from {source} group by {keys}))""")
    _view(f"{name}_back", f"select * from {name}_box anti join {source} using ({keys}, y, x)")
    _view(f"{name}_out", f"""select {keys}, y, x from {name}_back where y in (y0, y1) or x in (x0, x1)
      union select {keys}, b.y, b.x from (select {keys}, y + dy as y, x + dx as x from {name}_out,
        (values (0, 1), (0, -1), (1, 0), (-1, 0)) s(dy, dx)) r join {name}_back b using ({keys}, y, x)""", f"({keys}, y, x)")
    return _view(name, f"select {keys}, y, x from {name}_box anti join {name}_out using ({keys}, y, x)")


def _labelled(name: str, source: str, keys: str, side: int) -> str:
    """8-connected components over runs: keys, y, x, label, area."""
    _view(f"{name}_runs", f"""select {keys}, y, min(x) as x0, max(x) as x1, min(y * {side} + x) as id from (
      select *, x - row_number() over (partition by {keys}, y order by x) as grp from {source}) group by {keys}, y, grp""")
    _view(f"{name}_near", f"""select {keys}, a.id, b.id as other from {name}_runs a join {name}_runs b using ({keys})
      where abs(a.y - b.y) = 1 and a.x0 <= b.x1 + 1 and b.x0 <= a.x1 + 1""")
    _view(f"{name}_roots", f"""select {keys}, id, id as root from {name}_runs
      union select {keys}, n.other, r.root from {name}_roots r join {name}_near n using ({keys}, id)""", f"({keys}, id, root)")
    return _view(name, f"""select *, count(*) over (partition by {keys}, label) as area from (
      select {keys}, y, unnest(range(x0, x1 + 1)) as x, label from {name}_runs
      join (select {keys}, id, min(root) as label from {name}_roots group by {keys}, id) using ({keys}, id))""")


def _ranked(name: str, source: str, keys: str) -> str:
    """Components with their place by area: keys, label, area, place."""
    return _view(name, f"""select *, row_number() over (partition by {keys} order by area desc, label) as place
      from (select distinct {keys}, label, area from {source})""")


def _circled(name: str, source: str, keys: str) -> str:
    """Smallest enclosing circle: the largest among those of 1, 2 and acute 3 outer pixels."""
    _view(f"{name}_rim", f"""select * from (select {keys}, y, x,
        x in (min(x) over r, max(x) over r) and y in (min(y) over c, max(y) over c) as outer_pixel,
        row_number() over (partition by {keys} order by y, x) as i from {source}
        window r as (partition by {keys}, y), c as (partition by {keys}, x)) where outer_pixel""")
    return _view(name, f"""with c as (
      select {keys}, cast(x as double) as cx, cast(y as double) as cy, 0.0::double as r from {name}_rim
      union all select {keys}, (a.x + b.x) / 2.0::double, (a.y + b.y) / 2.0::double,
        sqrt(((a.x - b.x) ** 2 + (a.y - b.y) ** 2)::double) / 2 from {name}_rim a join {name}_rim b using ({keys}) where a.i < b.i
      union all select {keys}, ox, oy, sqrt((ox - x1) ** 2 + (oy - y1) ** 2) from (
        select {keys}, x1, y1, ab, bc, ac,
          ((x1*x1 + y1*y1) * (y2 - y3) + (x2*x2 + y2*y2) * (y3 - y1) + (x3*x3 + y3*y3) * (y1 - y2))::double / d as ox,
          ((x1*x1 + y1*y1) * (x3 - x2) + (x2*x2 + y2*y2) * (x1 - x3) + (x3*x3 + y3*y3) * (x2 - x1))::double / d as oy
        from (select {keys}, a.x as x1, a.y as y1, b.x as x2, b.y as y2, c.x as x3, c.y as y3,
            2 * (a.x * (b.y - c.y) + b.x * (c.y - a.y) + c.x * (a.y - b.y)) as d,
            (a.x - b.x) ** 2 + (a.y - b.y) ** 2 as ab, (b.x - c.x) ** 2 + (b.y - c.y) ** 2 as bc, (a.x - c.x) ** 2 + (a.y - c.y) ** 2 as ac
          from {name}_rim a join {name}_rim b using ({keys}) join {name}_rim c using ({keys}) where a.i < b.i and b.i < c.i)
        where ab + bc > ac and bc + ac > ab and ab + ac > bc))
      select {keys}, cast(floor(round(arg_max(cx, r), 6)) as bigint) as cx, cast(floor(round(arg_max(cy, r), 6)) as bigint) as cy,
        cast(floor(round(max(r), 6)) as bigint) as r from c group by {keys}""")


def _disc_area(name: str, discs: str, mask: str, mask_keys: str, keys: str, side: int) -> str:
    """Largest filled region of each disc cut with its mask: keys, disc_area."""
    _view(f"{name}_cut", f"""select {keys}, y, x from (select *, unnest(range(cx - r, cx + r + 1)) as x from (
        select *, unnest(range(cy - r, cy + r + 1)) as y from {discs})) join {mask} using ({mask_keys}, y, x)
      where (x - cx) * (x - cx) + (y - cy) * (y - cy) <= r * r""")
    _filled(f"{name}_filled", f"{name}_cut", keys)
    _labelled(f"{name}_parts", f"{name}_filled", keys, side)
    return _view(name, f"select {keys}, max(area) as disc_area from {name}_parts group by {keys}")


# ---- requests -----------------------------------------------------------------------------


def _date_codes(c: str, k: int) -> str:
    part = [rf"regexp_extract({c}, '^(\d+)-(\d+)-(\d+)$', {i})" for i in (1, 2, 3)]
    formed = rf"regexp_matches({c}, '^\d+-\d+-\d+$')"
    month, day = (f"coalesce(try_cast({p} as int), -1)" for p in part[1:])
    good_head = f"length({part[0]}) = 4 and {month} between 1 and 12"
    return f"""case when not {formed} then 'bad_format_date_{k}' end,
      case when {formed} and length({part[0]}) <> 4 then 'bad_year_{k}' end,
      case when {formed} and {month} not between 1 and 12 then 'bad_month_{k}' end,
      case when {formed} and ({day} not between 1 and 31 or ({good_head} and try_cast({c} as date) is null)) then 'bad_day_{k}' end"""


def _time_codes(c: str, k: int) -> str:
    formed = rf"regexp_matches({c}, '^\d+:\d+(am|pm)$')"
    hour, minute = (rf"coalesce(try_cast(regexp_extract({c}, '^(\d+):(\d+)', {i}) as int), -1)" for i in (1, 2))
    return f"""case when not {formed} then 'bad_format_time_{k}' end,
      case when {formed} and {hour} not between 0 and 12 then 'bad_hour_{k}' end,
      case when {formed} and {minute} not between 0 and 59 then 'bad_minute_{k}' end"""


def _clock(c: str, k: int) -> str:
    hour, minute, half = f"split_part({c}, ':', 1)", f"left(split_part({c}, ':', 2), -2)", f"right({c}, 2)"
    return f"""case when concat_ws(',', {_time_codes(c, k)}) <> '' then {c}
      when {half} = 'am' and try_cast({hour} as int) = 12 then concat('00:', {minute})
      when {half} = 'pm' and try_cast({hour} as int) <> 12 then concat(try_cast({hour} as int) + 12, ':', {minute})
      else concat({hour}, ':', {minute}) end"""


_view("plain", "select request_id, upper(replace(dev_id, ' ', '')) as dev_id, "
      + ", ".join(f"lower(replace({c}, ' ', '')) as {c}" for c in ("d1", "t1", "d2", "t2")) + " from requests")
_view("checked", rf"""select request_id, dev_id, d1, {_clock('t1', 1)} as t1, d2, {_clock('t2', 2)} as t2,
  concat_ws(',', case when not regexp_matches(dev_id, '^04E67\S{{7}}$') then 'bad_device' end,
    {_date_codes('d1', 1)}, {_time_codes('t1', 1)}, {_date_codes('d2', 2)}, {_time_codes('t2', 2)}) as errors from plain""")
_view("offsets", "select device_id, cast(trunc(min(utc)) as bigint) as utc from devices group by device_id")


def _instant(d: str, t: str) -> str:
    parts = ", ".join(f"cast(split_part({d}, '-', {i}) as bigint)" for i in (1, 2, 3))
    clock = ", ".join(f"cast(split_part({t}, ':', {i}) as bigint)" for i in (1, 2))
    return f"cast(epoch(make_timestamp({parts}, {clock}, 0)) as bigint) - utc * 3600"


_view("windows", f"""select request_id, dev_id as device_id, {_instant('d1', 't1')} as t1, {_instant('d2', 't2')} as t2, utc
  from checked join offsets on dev_id = device_id where errors = ''""")
_view("selected", """select request_id, c.device_id, frame_id, ts, image_url from windows w join captures c
  on c.device_id = w.device_id and c.ts >= w.t1 and c.ts < w.t2""")
_view("names", """select device_id, name, max(frame_id) as frame_id from (
  select device_id, frame_id, concat(device_id, '_', strftime(make_timestamp((ts + utc * 3600) * 1000000), '%m-%d-%Y_%H-%M-%S'), '.jpg') as name
  from captures join offsets using (device_id)) group by all""")

# ---- frames to edges ----------------------------------------------------------------------

_COLOR = """(b > 120 and g > 100 and r < 100 and g - r > 20) or (b > 100 and g > 100 and r > 100)
  or (b > 100 and g < 100 and r < 100 and g - r > 20) or (b < 100 and g < 100 and r < 100 and b - g > 20 and g - r > 20)"""
_HUE = """cast(floor(case when greatest(b, g, r) = least(b, g, r) then 0.0::double
  when r = greatest(b, g, r) then (60.0::double * (g - b) / (r - least(b, g, r)) + case when g < b then 360 else 0 end)
  when g = greatest(b, g, r) then 120 + 60.0::double * (b - r) / (g - least(b, g, r))
  else 240 + 60.0::double * (r - g) / (b - least(b, g, r)) end / 2 + 0.5) as bigint) % 180"""

_view("luma", "select frame_id, y, x, (299 * r + 587 * g + 114 * b + 500) // 1000 as l from scene")
_view("across", """select frame_id, y, x, l, lag(l, 2) over w as w2, lag(l) over w as w1, lead(l) over w as e1, lead(l, 2) over w as e2
  from luma window w as (partition by frame_id, y order by x)""")
_view("taps", """select frame_id, y, x, l, [l, w2, w1, e1, e2, lag(l, 2) over w, lag(l) over w, lead(l) over w, lead(l, 2) over w,
    lag(w1) over w, lag(e1) over w, lead(w1) over w, lead(e1) over w] as t
  from across window w as (partition by frame_id, x order by y)""")
_D2 = "[0, 4, 1, 1, 4, 4, 1, 1, 4, 2, 2, 2, 2]"
_view("smooth", f"""select frame_id, y, x, cast(floor(round(list_sum(v) / list_sum(w), 6) + 0.5) as bigint) as v from (
  select frame_id, y, x, {', '.join(f"case when t[{i}] is null then 0 else exp(-({_D2}[{i}]::double + (t[{i}] - l) ** 2) / 5000) end as w{i}" for i in range(1, 14))},
    [{', '.join(f'w{i} * coalesce(t[{i}], 0)' for i in range(1, 14))}] as v, [{', '.join(f'w{i}' for i in range(1, 14))}] as w from taps)""")
_view("slopes", """select frame_id, y, x, coalesce(lead(v) over w, v) - coalesce(lag(v) over w, v) as h,
  coalesce(lag(v) over w, v) + 2 * v + coalesce(lead(v) over w, v) as s from smooth window w as (partition by frame_id, y order by x)""")
_view("sobel", """select frame_id, y, x, coalesce(lag(h) over w, h) + 2 * h + coalesce(lead(h) over w, h) as gx,
  coalesce(lead(s) over w, s) - coalesce(lag(s) over w, s) as gy from slopes window w as (partition by frame_id, x order by y)""")
_view("mags", """select *, abs(gx) + abs(gy) as mag, case when 100000 * abs(gy) < 41421 * abs(gx) then 0 else -1 end as py,
  case when 100000 * abs(gy) < 41421 * abs(gx) then -1 when 100000 * abs(gy) > 241421 * abs(gx) then 0 when gx * gy >= 0 then -1 else 1 end as px
  from sobel""")
_view("mags_across", """select *, coalesce(lag(mag) over w, 0) as w, coalesce(lead(mag) over w, 0) as e
  from mags window w as (partition by frame_id, y order by x)""")
_view("mags_around", """select *, coalesce(lag(mag) over w, 0) as n, coalesce(lag(w) over w, 0) as nw, coalesce(lag(e) over w, 0) as ne,
    coalesce(lead(mag) over w, 0) as s, coalesce(lead(w) over w, 0) as sw, coalesce(lead(e) over w, 0) as se
  from mags_across window w as (partition by frame_id, x order by y)""")
_view("ridges", """select frame_id, y, x, mag from mags_around
  where mag > case when py = 0 then w when px = 0 then n when px = -1 then nw else ne end
    and mag >= case when py = 0 then e when px = 0 then s when px = -1 then se else sw end""")
_view("linked", """select frame_id, y, x from ridges where mag > 200
  union select w.frame_id, w.y, w.x from (select frame_id, y + a.range - 1 as y, x + b.range - 1 as x from linked, range(3) a, range(3) b) l
  join (select * from ridges where mag > 100) w using (frame_id, y, x)""", "(frame_id, y, x)")

# ---- sky mask -----------------------------------------------------------------------------

_view("hits", f"""select device_id, day, y, x, cast(sum(cast({_COLOR} as bigint)) as bigint) as color_hits,
  count(l.frame_id) as edge_hits, count(*) as n_frames
  from scene s left join linked l using (frame_id, y, x) group by device_id, day, y, x""")
_view("raw", """select device_id, day, y, x from hits where color_hits >= cast(0.75 as double) * n_frames
  and edge_hits < cast(0.5 as double) * n_frames""")
_eroded("thinned", "raw", "device_id, day", 2, SIDE)
_filled("solid", "thinned", "device_id, day")
_labelled("areas", "solid", "device_id, day", SIDE)
_ranked("area_ranks", "areas", "device_id, day")
_view("regions", f"""select device_id, day, y, x, a.area, place as region, n_regions from areas a
  join (select *, count(*) over (partition by device_id, day) as n_regions from area_ranks
        where place <= 3 and area * 20 >= {SIDE * SIDE}) using (device_id, day, label)""")
_view("rb", """select s.frame_id, device_id, day, region, cast(sum(abs(s.r - s.b)) as bigint) as rb_sum from scene s
  join regions using (device_id, day, y, x) group by all""")
_view("corrs", """select device_id, day, i.region, covar_pop(i.rb_sum::double, o.rb_sum::double)
    / nullif(stddev_pop(i.rb_sum::double) * stddev_pop(o.rb_sum::double), 0) as corr
  from rb o join rb i using (device_id, day, frame_id) where o.region = 1 and i.region > 1 group by device_id, day, i.region""")
_view("kept", """select device_id, day, y, x, region, n_regions from regions left join corrs using (device_id, day, region)
  where region = 1 or coalesce(corr >= 0.3, false)""")
_dilated("grown", "kept", "device_id, day, n_regions", 2, SIDE)
_filled("grown_solid", "grown", "device_id, day, n_regions")
_labelled("outlines", "grown_solid", "device_id, day, n_regions", SIDE)
_ranked("outline_ranks", "outlines", "device_id, day, n_regions")
_view("mask", """select device_id, day, y, x from outlines join outline_ranks using (device_id, day, n_regions, label)
  where place <= n_regions""")

# ---- suns ---------------------------------------------------------------------------------

_SIGHT = "frame_id, mask_day"
_view("served", "select device_id, day as mask_day, y, x, unnest([day - 1, day, day + 1]) as day from mask")
_view("lit", f"""select frame_id, mask_day, y, x from (select * from scene where {_HUE} <= 10)
  join served using (device_id, day, y, x)""")
_eroded("lit_core", "lit", _SIGHT, 1, SIDE)
_filled("core_solid", "lit_core", _SIGHT)
_labelled("cores", "core_solid", _SIGHT, SIDE)
_ranked("core_ranks", "cores", _SIGHT)
_view("core", f"select {_SIGHT}, y, x from cores join core_ranks using ({_SIGHT}, label) where place = 1")
_dilated("halo", "core", _SIGHT, 1, SIDE)
_filled("halo_solid", "halo", _SIGHT)
_labelled("halos", "halo_solid", _SIGHT, SIDE)
_ranked("halo_ranks", "halos", _SIGHT)
_view("sun_region", f"select {_SIGHT}, y, x, h.area from halos h join halo_ranks using ({_SIGHT}, label) where place = 1")
_circled("sun_circles", "sun_region", _SIGHT)
_view("sun_discs", f"""select * from sun_circles join (select distinct {_SIGHT}, area from sun_region) using ({_SIGHT})
  join (select frame_id, device_id from timed) using (frame_id) where r between 1 and 5""")
_view("mask_of_day", "select device_id, day as mask_day, y, x from mask")
_disc_area("sun_disc_area", "sun_discs", "mask_of_day", "device_id, mask_day", _SIGHT, SIDE)

_view("found_suns", f"""select device_id, mask_day, frame_id, cx, cy, r, area, disc_area from sun_discs
  join sun_disc_area using ({_SIGHT}) where area::double / disc_area >= 0.5""")

_filled("tile_solid", "tile_fg", "image_key")
_labelled("tile_parts", "tile_solid", "image_key", TILE)
_ranked("tile_ranks", "tile_parts", "image_key")
_view("tile_pieces", "select image_key, label as component, y, x from tile_parts")
_circled("tile_circles", "tile_pieces", "image_key, component")
_disc_area("tile_disc_area", "tile_circles", "tile_fg", "image_key", "image_key, component", TILE)
_view("tile_roots", f"""select image_key, y, x, y * {TILE} + x as root from tile_fg
  union select image_key, b.y, b.x, r.root from (select image_key, y + a.range - 1 as y, x + b.range - 1 as x, root
    from tile_roots, range(3) a, range(3) b) r join tile_fg b using (image_key, y, x)""", "(image_key, y, x, root)")

# ---- pairs and tracks ---------------------------------------------------------------------

_view("ordered", "select *, row_number() over (partition by device_id, day order by tod, frame_id) as rn from timed")
_view("walk", """select distinct device_id, day, step, 0::bigint, 0::bigint, null::bigint, null::bigint
    from timed, (values (-1), (1)) s(step)
  union all select w.device_id, w.day, w.step, w.rn + 1, case when n.tod <= b.tod + 120 then n.rn else w.used end, b.frame_id,
    case when n.tod <= b.tod + 120 then n.frame_id end
  from walk w join ordered b on b.device_id = w.device_id and b.day = w.day and b.rn = w.rn + 1
  left join lateral (select k.rn, k.tod, k.frame_id from ordered k where k.device_id = w.device_id and k.day = w.day + w.step
    and k.rn > w.used and k.tod >= b.tod - 120 order by k.rn limit 1) n on true""",
      "(device_id, day, step, rn, used, frame_id, match_id)")
_view("pairs", "select device_id, day, day + step as neighbour_day, frame_id, match_id from walk where match_id is not null")
_view("sun_pairs", """select p.*, a.cx, a.cy, a.r, b.cx as match_cx, b.cy as match_cy, b.r as match_r,
    (a.cx - b.cx) ** 2 + (a.cy - b.cy) ** 2 < (a.r + b.r) ** 2 as overlap
  from pairs p join suns a on a.frame_id = p.frame_id join suns b on b.frame_id = p.match_id""")
_view("agreed", "select * exclude (overlap) from sun_pairs where overlap")
_view("centres", """select device_id, day, cx, cy from agreed
  union all select device_id, day, match_cx, match_cy from agreed""")
_view("found_pairs", """select device_id, day, neighbour_day, frame_id, match_id, a.cx, a.cy, a.r, b.cx as match_cx, b.cy as match_cy, b.r as match_r
  from pairs p join found_suns a using (device_id, frame_id) join found_suns b on b.frame_id = p.match_id and b.mask_day = p.day
  where a.mask_day = p.day and (a.cx - b.cx) ** 2 + (a.cy - b.cy) ** 2 < (a.r + b.r) ** 2""")
_view("found_centres", """select device_id, day, cx, cy from found_pairs
  union all select device_id, day, match_cx, match_cy from found_pairs""")


def _points(name: str, centres: str, height: int) -> str:
    return _view(name, f"""select device_id, day, x - avg(x) over d as x, y - avg(y) over d as y, avg(x) over d as mx, avg(y) over d as my
      from (select device_id, day, cx::double as x, ({height} - cy)::double as y from {centres}) window d as (partition by device_id, day)""")


def _fits(name: str, angles: str, points: str = "points") -> str:
    """Fit of every angle from the turned points themselves."""
    return _view(name, f"""with turned as (select device_id, day, k, theta, mx, my, x * cos(theta) - y * sin(theta) as u,
        x * sin(theta) + y * cos(theta) as v from {points} join ({angles}) using (device_id, day)),
      sums as (select device_id, day, k, theta, any_value(mx) as mx, any_value(my) as my, count(*) as n, sum(u*u) as s2, sum(u*u*u) as s3,
        sum(u*u*u*u) as s4, sum(u*v) as uv, sum(u*u*v) as uuv, sum(v*v) as vv from turned group by device_id, day, k, theta),
      dets as (select *, (s4 - s2 * s2 / n) * s2 - s3 * s3 as det from sums where n > 3),
      solved as (select *, (uuv * s2 - s3 * uv) / det as a2, ((s4 - s2 * s2 / n) * uv - s3 * uuv) / det as a1
        from dets where det > 1e-9::double * s4 * s2),
      scored as (select *, -s2 * a2 / n as a0, round(vv - a2 * uuv - a1 * uv, 6) as rss,
        cos(theta) * mx - sin(theta) * my as mu, sin(theta) * mx + cos(theta) * my as mv from solved)
      select device_id, day, k, theta, a2, a1 - 2 * a2 * mu as a1, a0 - a1 * mu + a2 * mu * mu + mv as a0, rss, n
      from scored qualify row_number() over (partition by device_id, day order by rss, theta) = 1""")


def _track(name: str, points: str) -> str:
    _fits(f"{name}_coarse", f"select device_id, day, k, k * pi() / 180 as theta from (select distinct device_id, day from {points}), (select range as k from range(180))", points)
    return _fits(name, f"select device_id, day, s as k, (k * 100 + s) * pi() / 18000 as theta from {name}_coarse, (select range as s from range(-100, 101))", points)


_points("points", "centres", 640)
_track("tracks", "points")
_points("found_points", "found_centres", SIDE)
_track("found_tracks", "found_points")
_ROUNDED = """device_id, day, round(theta, 6) as theta, round(a2, 6) as a2, round(a1, 6) as a1,
  round(a0, 4) as a0, round(rss, 4) as rss, n"""

ORACLE: dict[str, str] = {
    name: _with(sql)
    for name, sql in {
        "s01_capture_range_scan": "select * from selected",
        "s02_device_offset": "select request_id, dev_id, utc from checked left join offsets on dev_id = device_id where errors = ''",
        "s03_device_offset_latest": """select device_id, cast(trunc(cast(frame_id % 25 - 12 + 0.5 as double)) as bigint) as utc from captures
            qualify row_number() over (partition by device_id order by ts desc, frame_id desc) = 1""",
        "s06_pixel_rows": "select frame_id, y, x, b, g, r from scene",
        "s08_landing_names": "select * from names",
        "s08_landing_folders": """select request_id, concat(device_id, strftime(make_timestamp((t1 + utc * 3600) * 1000000), '%m-%d_%H-%M'),
            '_to_', strftime(make_timestamp((t2 + utc * 3600) * 1000000), '%m-%d_%H-%M')) as folder from windows""",
        "p01_request_validate": "select * from checked",
        "p02_quarantine_counts": """select code, count(*) as n from (select unnest(string_split(errors, ',')) as code from checked
            where errors <> '') group by code""",
        "p02_window_rejects": """select request_id, dev_id, case when errors = '' then 'unknown_device' else errors end as errors from checked
            where errors <> '' or dev_id not in (select device_id from offsets)""",
        "e1_ingest": """select request_id, c.dev_id as device_id, t1, t2, case when w.request_id is not null then null
            when errors = '' then 'unknown_device' else errors end as errors
            from (select request_id, dev_id, errors from checked) c left join (select request_id, t1, t2 from windows) w using (request_id)""",
        "s08_landing_rejects": """select frame_id, device_id, case when device_id in (select device_id from offsets) then 'same_second'
            else 'unknown_device' end as reason from captures where frame_id not in (select frame_id from names)""",
        "p03_epoch_window": "select * from windows",
        "p04_three_day_window": """select device_id as dev_id, d as d1, '09:00AM' as t1, d as d2, '07:00PM' as t2
            from devices, (values ('2024-01-28'), ('2024-01-29'), ('2024-01-30')) v(d)""",
        "p05_has_image": "select * from captures where image_url is not null",
        "p05_requests_without_images": """select request_id, device_id from windows where request_id not in
            (select request_id from selected where image_url is not null)""",
        "p06_name_time_of_day": """select frame_id, cast(name[-12:-11] as bigint) * 3600 + cast(name[-9:-8] as bigint) * 60
            + cast(name[-6:-5] as bigint) as tod from names""",
        "p07_color_rule": f"select frame_id, y, x, cast({_COLOR} as bigint) as color from scene",
        "p08_luma_hue": f"""select frame_id, y, x, (299 * r + 587 * g + 114 * b + 500) // 1000 as luma, {_HUE} as hue,
            cast({_HUE} <= 10 as bigint) as sunny from scene""",
        "w01_erode": """select image_key, y, x from (select image_key, y, x, min(h) over (partition by image_key, x order by y
            rows between 1 preceding and 1 following) as m from (select *, min(v) over (partition by image_key, y order by x
            rows between 1 preceding and 1 following) as h from tiles)) where m = 1""",
        "w02_dilate": """select image_key, y, x from (select image_key, y, x, max(h) over (partition by image_key, x order by y
            rows between 1 preceding and 1 following) as m from (select *, max(v) over (partition by image_key, y order by x
            rows between 1 preceding and 1 following) as h from tiles)) where m = 1""",
        "w03_bilateral": "select * from smooth",
        "w04_gradient_nms": "select * from ridges",
        "w05_edge_pixels": "select * from linked",
        "g01_components": """select *, count(*) over (partition by image_key, label) as area from
            (select image_key, y, x, min(root) as label from tile_roots group by image_key, y, x)""",
        "g02_fill_holes": "select image_key, y, x from tile_solid",
        "a07_region_area_topk": f"""select image_key, n_regions, y, x, p.area, place as region from tile_parts p join
            (select *, count(*) over (partition by image_key) as n_regions from tile_ranks
             where place <= 3 and area * 20 >= {TILE * TILE}) using (image_key, label)""",
        "a01_pixel_hits": "select * from hits",
        "a03_sky_mask_raw": "select * from raw",
        "g03_regions": "select * from regions",
        "a04_region_rb_sum": "select * from rb",
        "a06_region_corr": "select device_id, day, region, round(corr, 6) as corr, cast(coalesce(corr >= 0.3, false) as bigint) as keep from corrs",
        "g04_region_decide": "select device_id, day, y, x, region from kept",
        "g05_final_mask": "select * from mask",
        "j01_mask_apply": "select frame_id, mask_day, y, x, b, g, r from scene join served using (device_id, day, y, x)",
        "j02_day_pair_match": "select * from pairs",
        "j03_matched_frames": """select * from timed where frame_id in (select frame_id from pairs union select match_id from pairs)""",
        "j04_sun_overlap": "select device_id, day, frame_id, match_id, cast(overlap as bigint) as overlap from sun_pairs",
        "u01_sun_region": "select frame_id, mask_day, y, x from sun_region",
        "u02_enclosing_circle": "select * from tile_circles",
        "u03_disc_area": """select image_key, component, cx, cy, r, coalesce(disc_area, 0) as disc_area
            from tile_circles left join tile_disc_area using (image_key, component)""",
        "u04_sun_detect": "select * from found_suns",
        "u05_sun_pairs": "select * from agreed",
        "e3_agreed_suns": "select * from found_pairs",
        "e3_sun_track": f"select {_ROUNDED} from found_tracks",
        "t01_centroids": "select * from centres",
        "t02_flip_rotate": """select device_id, day, round(cx * cos(0.79::double) - (640 - cy) * sin(0.79::double), 4) as u,
            round(cx * sin(0.79::double) + (640 - cy) * cos(0.79::double), 4) as v from centres""",
        "t03_parabola_fit": f"select {_ROUNDED} from tracks",
        "t04_curve_points": """select * from (select device_id, day, i, round(cos(theta) * u + sin(theta) * v, 4) as x,
            round(cos(theta) * v - sin(theta) * u, 4) as y from (select *, a2 * u * u + a1 * u + a0 as v from
            (select *, i * 0.5::double - 10000 as u from tracks, (select range as i from range(40000)))))
            where x between 0 and 640 and y between 0 and 640""",
    }.items()
}
