"""DuckDB text of the derived inputs, for the SQL oracle of ``__spark_entry__``.

Each fixture is a CTE over the pre-registered test tables; ``with_fixtures``
puts the ones a query needs (and what they depend on) in front of it.
"""

from __future__ import annotations

FIXTURES: dict[str, tuple[tuple[str, ...], str]] = {
    "readings": ((), """
        select event_id, cast(ts as timestamp) as ts, 'S' || cast(user_id as varchar) as name,
               ((user_id * 7919) % 3600 - 1800) / 10.0::double as lon,
               ((user_id * 104729) % 1800 - 900) / 10.0::double as lat,
               cast(hour(ts) as integer) as hour,
               value - 50 as temp
        from events"""),
    "messages": (("readings",), """
        select concat_ws(':', name, cast(lon as varchar), cast(lat as varchar), cast(hour as varchar)) as key,
               cast(temp as varchar) as value, 'currentTemp' as topic, 0 as "partition",
               event_id as "offset", ts as "timestamp"
        from readings"""),
    "bad_messages": (("readings",), """
        select case when k = 0 then concat_ws(':', name, cast(lon as varchar), cast(lat as varchar))
                    when k = 2 then concat_ws(':', 'New', name, cast(lon as varchar), cast(lat as varchar), cast(hour as varchar))
                    when k = 5 then concat_ws(':', name, '999', cast(lat as varchar), cast(hour as varchar))
                    when k = 6 then concat_ws(':', name, cast(lon as varchar), cast(lat as varchar), '99')
                    when k = 7 then null
                    when k = 9 then concat_ws(':', name, cast(lon as varchar), 'NaN', cast(hour as varchar))
                    else concat_ws(':', name, cast(lon as varchar), cast(lat as varchar), cast(hour as varchar))
               end as key,
               case k when 1 then 'n/a' when 3 then 'NaN' when 4 then 'Infinity' when 8 then '1e300'
                    else cast(temp as varchar) end as value,
               event_id as "offset"
        from (select *, event_id % 50 as k from readings)"""),
    "weather_json": (("readings",), """
        select event_id, '{"name":"' || name || '","main":{"temp":' || cast(temp as varchar)
               || '},"coord":{"lon":' || cast(lon as varchar) || ',"lat":' || cast(lat as varchar)
               || '},"dt":' || cast(1704067200 + event_id * 60 as varchar) || '}' as body
        from readings"""),
    "registry": ((), """
        select c_custkey as seq, c_custkey as id,
               ((c_custkey * 7919) % 3600 - 1800) / 10.0::double as lon,
               ((c_custkey * 104729) % 1800 - 900) / 10.0::double as lat
        from customer"""),
    "call_log": ((), """
        select timestamp '2024-01-01 00:00:00' + (event_id // 50) * interval '1' second as ts, event_id,
               'C' || cast(user_id % 10 as varchar) as client,
               event_id // 4 as request_id, cast(event_id % 4 + 1 as integer) as attempt,
               cast(case when (event_id * 7919) % 10 < 7 then 200
                         when (event_id * 7919) % 10 < 9 then 500 end as integer) as status
        from events"""),
    # decoded and parsed messages (P4/P5): the good rows only
    "parsed": (("messages",), """
        select regexp_extract(key, '^(.*):([^:]*)$', 1) as city_and_loc,
               try_cast(regexp_extract(key, '^(.*):([^:]*):([^:]*):([^:]*)$', 4) as integer) as "time",
               cast(try_cast(value as double) as float) as temperature,
               "timestamp", "partition", "offset"
        from messages
        where regexp_full_match(key, '^(.*):([^:]*):([^:]*):([^:]*)$')
          and try_cast(regexp_extract(key, '^(.*):([^:]*):([^:]*):([^:]*)$', 2) as double) is not null
          and try_cast(regexp_extract(key, '^(.*):([^:]*):([^:]*):([^:]*)$', 3) as double) is not null
          and try_cast(regexp_extract(key, '^(.*):([^:]*):([^:]*):([^:]*)$', 4) as integer) is not null
          and try_cast(value as double) is not null"""),
    # A2: newest row per (city_and_loc, time)
    "current": (("parsed",), """
        select city_and_loc, "time", arg_max(temperature, ("timestamp", "partition", "offset")) as temperature
        from parsed group by city_and_loc, "time\""""),
    "city_means": (("current",), """
        select city_and_loc, avg(cast(temperature as double)) as avg_temp
        from current group by city_and_loc"""),
    # Station key to name / lon / lat
    "stations": (("city_means",), """
        select city_and_loc,
               regexp_extract(city_and_loc, '^(.*):([^:]*):([^:]*)$', 1) as name,
               try_cast(regexp_extract(city_and_loc, '^(.*):([^:]*):([^:]*)$', 2) as double) as lon,
               try_cast(regexp_extract(city_and_loc, '^(.*):([^:]*):([^:]*)$', 3) as double) as lat,
               avg_temp
        from city_means"""),
    "event_days": (("readings",), """
        select distinct cast(dayofyear(ts) - 1 as integer) as day_number from readings"""),
    "climatology": (("event_days",), """
        select day_number, i - 89.5::double as latitude, j - 179.5::double as longitude,
               case when (i * 31 + j) % 97 = 0 then null
                    else 28 - 0.006::double * (i - 89.5::double) * (i - 89.5::double)
                         + 0.25::double * ((i * 13 + j * 7 + day_number) % 11)
               end as climatology
        from (select day_number, cast(cell // 360 as integer) as i, cast(cell % 360 as integer) as j
              from (select day_number, unnest(range(0, 64800)) as cell from event_days))"""),
}


def mask_sql(scale: float) -> str:
    rows, cols = int(round(180 * scale)), int(round(360 * scale))
    s = float(scale)
    return f"""
        select cast(id // {cols} as integer) as r, cast(id % {cols} as integer) as c,
               ((floor(floor((id // {cols}) / {s}) / 10) * 7 + floor(floor((id % {cols}) / {s}) / 10) * 3) % 10) < 6 as land
        from range(0, {rows * cols}) t(id)"""


def _order(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out:
            return
        for d in FIXTURES[n][0]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_fixtures(sql: str, *names: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``sql`` with the CTEs of ``names`` (dependencies first), then ``extra``."""
    parts = [f"{n} as ({FIXTURES[n][1]}\n)" for n in _order(list(names))]
    parts += [f"{k} as ({v}\n)" for k, v in (extra or {}).items()]
    if not parts:
        return sql
    return "with " + ",\n".join(parts) + "\n" + sql


def r6(expr: str) -> str:
    """The round6 rule of the oracle: a tiny offset, then six decimals."""
    return f"round(({expr}) + 0.00000013, 6)"


# ------------------------------------------------------------ grid oracles

def grid_dims(scale: float) -> tuple[int, int]:
    return int(round(180 * scale)), int(round(360 * scale))


def mirror_sql(expr: str, n: int) -> str:
    m = f"((({expr}) % {2 * n}) + {2 * n}) % {2 * n}"
    return f"(case when {m} >= {n} then {2 * n - 1} - {m} else {m} end)"


def points_sql(scale: float) -> str:
    s = float(scale)
    return f"""
        select city_and_loc as pid, {s} * (90.0 - lat) as x, {s} * (lon + 180.0) as y, avg_temp as v
        from stations"""


def nearest_sql(scale: float, pts: str = "pts") -> str:
    """Brute force: every cell against every point, smallest (d2, pid)."""
    rows, cols = grid_dims(scale)
    return f"""
        select r, c, arg_min(pid, (d2, pid)) as pid, arg_min(v, (d2, pid)) as v, min(d2) as d2
        from (select g.r, g.c, p.pid, p.v, (g.r - p.x) * (g.r - p.x) + (g.c - p.y) * (g.c - p.y) as d2
              from (select cast(id // {cols} as integer) as r, cast(id % {cols} as integer) as c
                    from range(0, {rows * cols}) t(id)) g
              cross join (select pid, x, y, v from {pts}) p)
        group by r, c"""


def blur_ctes(src: str, scale: float, sigma: float, prefix: str = "bl") -> dict[str, str]:
    """Separable Gaussian blur in SQL: tap table joins, mirrored edges."""
    rows, cols = grid_dims(scale)
    radius = int(4.0 * float(sigma) + 0.5)
    s2 = float(sigma) * float(sigma)
    return {
        f"{prefix}_taps": f"""
        select k, exp(-0.5 / {s2} * k * k) / sum(exp(-0.5 / {s2} * k * k)) over () as w
        from range({-radius}, {radius + 1}) t(k)""",
        f"{prefix}_p1": f"""
        select g.r, g.c, sum(t.w * s.v) as v
        from {src} g cross join {prefix}_taps t
        join {src} s on s.c = g.c and s.r = {mirror_sql('g.r + t.k', rows)}
        group by g.r, g.c""",
        f"{prefix}_out": f"""
        select g.r, g.c, sum(t.w * s.v) as v
        from {prefix}_p1 g cross join {prefix}_taps t
        join {prefix}_p1 s on s.r = g.r and s.c = {mirror_sql('g.c + t.k', cols)}
        group by g.r, g.c""",
    }


def blur_lines_ctes(src: str, scale: float, sigma: float, prefix: str = "bn") -> dict[str, str]:
    """The same blur for full grids: each line as a list with mirrored ends, and for each
    cell the inner product of a stretch of it with the list of taps."""
    rows, cols = grid_dims(scale)
    radius = int(4.0 * float(sigma) + 0.5)
    s2 = float(sigma) * float(sigma)

    def lines(table, line, pos, n):
        spot = f"((i + {4 * n}) % {2 * n})"
        at = f"case when {spot} >= {n} then {2 * n - 1} - {spot} else {spot} end"
        return f"""
        select {line}, list_transform(range({-radius}, {n + radius}), lambda i: vals[{at} + 1]) as vals
        from (select {line}, list(v order by {pos}) as vals from {table} group by {line})"""

    def cells(table, line, pos, n):
        return f"""
        select {line}, {pos}, list_inner_product(vals[{pos} + 1:{pos} + {2 * radius + 1}], (select ws from {prefix}_taps)) as v
        from (select {line}, vals, unnest(range(0, {n}))::int as {pos} from {table})"""

    return {
        f"{prefix}_taps": f"""
        select list(w order by k) as ws from (
          select k, exp(-0.5 / {s2} * k * k) / sum(exp(-0.5 / {s2} * k * k)) over () as w from range({-radius}, {radius + 1}) t(k))""",
        f"{prefix}_down": lines(src, "c", "r", rows),
        f"{prefix}_p1": cells(f"{prefix}_down", "c", "r", rows),
        f"{prefix}_along": lines(f"{prefix}_p1", "r", "c", cols),
        f"{prefix}_out": cells(f"{prefix}_along", "r", "c", cols),
    }


def keys_sql(t: str) -> str:
    a = f"abs({t})"
    return (f"(case when {a} <= 1 then 1.5 * {a} * {a} * {a} - 2.5 * {a} * {a} + 1 "
            f"when {a} < 2 then -0.5 * {a} * {a} * {a} + 2.5 * {a} * {a} - 4.0 * {a} + 2.0 else 0.0 end)")


def reference_ctes(scale: float, day: int | None, cells: str, shift: int = 1, prefix: str = "rf",
                   clim: str = "climatology") -> dict[str, str]:
    """Lattice upsampling (J5) of day ``day`` at the cells of ``cells`` (r, c):
    16 taps -> cubic, 4 -> bilinear, else nearest existing corner, null outside
    the lattice. ``day`` None: ``cells`` has a ``day_number``, each row its own."""
    s = float(scale)
    d = "day_number, " if day is None else ""
    g_d = "g.day_number, " if day is None else ""
    same = "l.day_number = g.day_number and " if day is None else ""
    only = "" if day is None else f"day_number = {int(day)} and "
    bw = ("((case when t.m = 1 then g.fu else 1 - g.fu end) * "
          "(case when t.n = 1 then g.fv else 1 - g.fv end))")
    return {
        f"{prefix}_lat": f"""
        select {d}cast(round(latitude + 89.5) as integer) as i, cast(round(longitude + 179.5) as integer) as j,
               climatology as val
        from {clim} where {only}climatology is not null and not isnan(climatology)""",
        f"{prefix}_cells": f"""
        select {d}r, c, u, v, cast(floor(u) as integer) as i0, cast(floor(v) as integer) as j0,
               u - floor(u) as fu, v - floor(v) as fv
        from (select {d}r, c, ({90.0 * s - shift} - r) / {s} + 89.5 as u, c / {s} - 180.0 + 179.5 as v from {cells})""",
        f"{prefix}_taps": """
        select cast(t // 4 - 1 as integer) as m, cast(t % 4 - 1 as integer) as n from range(0, 16) x(t)""",
        f"{prefix}_agg": f"""
        select {g_d}g.r, g.c, any_value(g.u) as u, any_value(g.v) as v,
               count(l.val) as n16,
               sum({keys_sql('g.fu - t.m')} * {keys_sql('g.fv - t.n')} * l.val) as cubic,
               count(*) filter (where t.m in (0, 1) and t.n in (0, 1)
                                and (l.val is not null or {bw} = 0)) as n4,
               sum(case when t.m in (0, 1) and t.n in (0, 1) then
                          (case when {bw} = 0 then 0.0 else {bw} * l.val end) end) as bil,
               arg_min(l.val, ((g.fu - t.m) * (g.fu - t.m) + (g.fv - t.n) * (g.fv - t.n), t.m, t.n))
                 filter (where t.m in (0, 1) and t.n in (0, 1) and l.val is not null) as near
        from {prefix}_cells g cross join {prefix}_taps t
        left join {prefix}_lat l on {same}l.i = g.i0 + t.m and l.j = g.j0 + t.n
        group by {g_d}g.r, g.c""",
        f"{prefix}_out": f"""
        select {d}r, c,
               case when not (u >= 0 and u <= 179 and v >= 0 and v <= 359) then null
                    when n16 = 16 then cubic when n4 = 4 then bil else near end as val,
               cast(case when not (u >= 0 and u <= 179 and v >= 0 and v <= 359) then 0
                         when n16 = 16 then 16 when n4 = 4 then 4 when near is not null then 1 else 0 end
                    as integer) as taps
        from {prefix}_agg""",
    }


def scattered_sql(pts: str, rows: int, cols: int) -> str:
    """Delaunay triangles of the table ``pts`` (id, x, y, v) by brute force over all edges and
    points, least-squares slopes, and the C1 cubic of each cell's triangle: r, c, v.

    The centres of the circles through an edge lie on its bisector; every other point bounds
    their height from above or below. The edge is one of the triangulation if a height
    remains, and the point of the least upper bound is the apex on that side. A first
    look at the points around an end (a necessary condition) thins out the edges.
    """
    height = ("(((q.x - mx) * (q.x - mx) + (q.y - my) * (q.y - my) - (ex * ex + ey * ey) / 4) "
              "/ (ex * (q.y - p.y) - ey * (q.x - p.x)))")
    bounds = f"""min({height}) filter (where ex * (q.y - p.y) - ey * (q.x - p.x) > 0) as up,
                 max({height}) filter (where ex * (q.y - p.y) - ey * (q.x - p.x) < 0) as down"""
    edge = "a.x - p.x as ex, a.y - p.y as ey, (a.x + p.x) / 2 as mx, (a.y + p.y) / 2 as my"

    def along(i, x, y):
        return f"(v{i} + (({x}) - x{i}) * gx{i} / 3 + (({y}) - y{i}) * gy{i} / 3)"

    three = "abc"
    other = {k: [m for m in three if m != k] for k in three}
    third = ", ".join(f"{along(i, f'x{j}', f'y{j}')} as t{i}{j}" for i in three for j in other[i])
    inward = ", ".join(f"{along(i, 'mx', 'my')} as w{i}" for i in three)
    foot = ", ".join(f"((mx - x{i}) * (x{j} - x{i}) + (my - y{i}) * (y{j} - y{i})) / ((x{j} - x{i}) ** 2 + (y{j} - y{i}) ** 2) as s{i}{j}"
                     for i, j in ("ab", "bc", "ca"))
    across = ", ".join(f"((-(1 - s{i}{j}) * v{i} - s{i}{j} * t{i}{j} + w{i}) + (-(1 - s{i}{j}) * t{j}{i} - s{i}{j} * v{j} + w{j})) / 2 "
                       f"+ (1 - s{i}{j}) * t{i}{j} + s{i}{j} * t{j}{i} as e{i}{j}" for i, j in ("ab", "bc", "ca"))
    e = lambda i, j: f"e{i}{j}" if i + j in ("ab", "bc", "ca") else f"e{j}{i}"
    ring = ", ".join(f"(w{i} + {e(i, other[i][0])} + {e(i, other[i][1])}) / 3 as r{i}" for i in three)

    def patch(k):
        i, j = other[k]
        s, u, w = f"(l{i} - l{k})", f"(l{j} - l{k})", f"(3 * l{k})"
        return (f"v{i} * {s} ** 3 + v{j} * {u} ** 3 + (ra + rb + rc) / 3 * {w} ** 3 + 3 * (t{i}{j} * {s} * {s} * {u} + t{j}{i} * {s} * {u} * {u} "
                f"+ w{i} * {s} * {s} * {w} + w{j} * {u} * {u} * {w} + r{i} * {s} * {w} * {w} + r{j} * {u} * {w} * {w}) + 6 * {e(i, j)} * {s} * {u} * {w}")

    xy = ", ".join(f"{c}{k}" for k in three for c in "xyv")
    return f"""
    with near as materialized (
      select p.id as p, q.id as q from {pts} p join {pts} q on p.id <> q.id
      qualify row_number() over (partition by p.id order by (p.x - q.x) ** 2 + (p.y - q.y) ** 2, q.id) <= 40),
    maybe as materialized (
      select pid, aid from (
        select p.id as pid, a.id as aid, {bounds}
        from (select p.id, p.x, p.y, a.id as a, {edge} from {pts} p join {pts} a on p.id <> a.id) p
        join {pts} a on a.id = p.a join near n on n.p = p.id join {pts} q on q.id = n.q and q.id <> a.id
        group by p.id, a.id)
      where up is null or down is null or down <= up),
    edges as materialized (
      select * from (
        select p.id as pid, p.a as aid, arg_min(q.id, {height}) filter (where ex * (q.y - p.y) - ey * (q.x - p.x) > 0) as apex, {bounds}
        from (select p.id, p.x, p.y, a.id as a, {edge} from maybe m join {pts} p on p.id = m.pid join {pts} a on a.id = m.aid) p
        join {pts} q on q.id <> p.id and q.id <> p.a
        group by p.id, p.a)
      where up is not null and (down is null or down <= up)),
    tri as materialized (
      select a.x as xa, a.y as ya, a.v as va, b.x as xb, b.y as yb, b.v as vb, c.x as xc, c.y as yc, c.v as vc, a.id as ia, b.id as ib, c.id as ic
      from edges e join {pts} a on a.id = e.pid join {pts} b on b.id = e.aid join {pts} c on c.id = e.apex
      where e.pid < e.aid and e.pid < e.apex),
    spokes as materialized (
      {" union all ".join(f"select i{i} as id, x{j} - x{i} as dx, y{j} - y{i} as dy, v{j} - v{i} as dv from tri" for i in three for j in other[i])}),
    sums as materialized (
      select id, sum(dx * dx / d) as xx, sum(dx * dy / d) as xy, sum(dy * dy / d) as yy, sum(dx * dv / d) as xv, sum(dy * dv / d) as yv
      from (select *, dx * dx + dy * dy as d from spokes) group by id),
    slopes as materialized (
      select id, (xv * yy - yv * xy) / (xx * yy - xy * xy) as gx, (yv * xx - xv * xy) / (xx * yy - xy * xy) as gy from sums),
    full_tri as materialized (
      select tri.*, (xa + xb + xc) / 3 as mx, (ya + yb + yc) / 3 as my, {", ".join(f"g{k}.gx as gx{k}, g{k}.gy as gy{k}" for k in three)}
      from tri {" ".join(f"join slopes g{k} on g{k}.id = i{k}" for k in three)}),
    one as materialized (select *, {third}, {inward}, {foot} from full_tri),
    two as materialized (select *, {across} from one),
    net as materialized (select *, {ring} from two),
    cells as materialized (select cast(id // {cols} as integer) as r, cast(id % {cols} as integer) as c from range(0, {rows * cols}) t(id)),
    met as materialized (
      select cells.r, cells.c, net.*, (xb - xa) * (yc - ya) - (yb - ya) * (xc - xa) as area
      from cells join net on cells.r >= least(xa, xb, xc) and cells.r <= greatest(xa, xb, xc)
                         and cells.c >= least(ya, yb, yc) and cells.c <= greatest(ya, yb, yc)),
    bary as materialized (
      select *, 1 - la - lb as lc from (
        select *, ((xb - r) * (yc - c) - (yb - c) * (xc - r)) / area as la, ((xc - r) * (ya - c) - (yc - c) * (xa - r)) / area as lb from met)),
    vals as materialized (
      select r, c, least(la, lb, lc) as inner_, case when la <= lb and la <= lc then {patch('a')} when lb <= lc then {patch('b')} else {patch('c')} end as v
      from bary where least(la, lb, lc) >= -1e-11)
    select cells.r, cells.c, {r6('b.v')} as v
    from cells left join (select r, c, arg_max(v, inner_) as v from vals group by r, c) b on b.r = cells.r and b.c = cells.c"""


def nearest_sphere_sql(rows: int, cols: int) -> str:
    """Brute force on the globe: squared chords between unit vectors, rounded to 12 digits, smallest (d2, pid)."""
    scale = rows / 180.0
    unit = "cos(radians({b})) * cos(radians({a})) as {n}x, cos(radians({b})) * sin(radians({a})) as {n}y, sin(radians({b})) as {n}z"
    return f"""
        with cells as (select r, c, {unit.format(a=f'(c / {scale} - 180.0)', b=f'(90.0 - r / {scale})', n='g')}
                       from (select cast(id // {cols} as integer) as r, cast(id % {cols} as integer) as c from range(0, {rows * cols}) t(id))),
        spots as (select city_and_loc as pid, avg_temp as v, {unit.format(a='lon', b='lat', n='p')} from stations)
        select r, c, arg_min(pid, (d2, pid)) as pid, arg_min(v, (d2, pid)) as v, min(d2) as d2
        from (select r, c, pid, v, round((gx - px) ** 2 + (gy - py) ** 2 + (gz - pz) ** 2, 12) as d2 from cells cross join spots)
        group by r, c"""
