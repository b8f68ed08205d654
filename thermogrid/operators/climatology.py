"""Climatology: clean, day filter, day check, unpivot, lattice upsampling.

The climatology is a 1 degree lattice, ``latitude = i - 89.5`` (i = 0..179),
``longitude = j - 179.5`` (j = 0..359), one value per day and lattice point.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermogrid.session import work_partitions

LAT0 = -89.5   # latitude of lattice row 0
LON0 = -179.5  # longitude of lattice column 0
NLAT = 180
NLON = 360
# Keys (1981) cubic convolution with a = -1/2.
KEYS_A = -0.5


def drop_missing(df: DataFrame, value: str = "climatology") -> DataFrame:
    """Drop null and NaN values."""
    v = F.col(value)
    return df.where(v.isNotNull() & ~F.isnan(v))


def climatology_for_day(df: DataFrame, day: int) -> DataFrame:
    """One day; on a table partitioned by ``day_number`` this prunes files."""
    return df.where(F.col("day_number") == F.lit(int(day)))


def distinct_days(df: DataFrame) -> DataFrame:
    """A4: the day numbers present."""
    return df.select("day_number").distinct()


def require_day(df: DataFrame, day: int) -> DataFrame:
    """Fail when ``day`` has no rows (a one-row probe, pruned to the day)."""
    if not 0 <= int(day) <= 364:
        raise ValueError(f"day {day} outside 0..364")
    if climatology_for_day(df, day).limit(1).count() == 0:
        raise ValueError(f"day {day} not in the climatology")
    return df


def unpivot_grid(lines: DataFrame, values: str = "vals", lon0: float = LON0, dlon: float = 1.0) -> DataFrame:
    """Line form ``day_number, latitude, vals array<double>`` to long rows.

    Entry k of ``vals`` is longitude ``lon0 + k*dlon``; nulls stay as rows.
    """
    return (lines.select("day_number", "latitude", F.posexplode(values).alias("k", "climatology"))
            .select("day_number", "latitude",
                    (F.lit(float(lon0)) + F.col("k") * F.lit(float(dlon))).alias("longitude"),
                    "climatology"))


def to_lines(df: DataFrame, value: str = "climatology") -> DataFrame:
    """Long rows to line form (one array per day and latitude, ordered by
    longitude). A line is bounded by the lattice width (360 entries)."""
    return (df.groupBy("day_number", "latitude")
            .agg(F.array_sort(F.collect_list(F.struct("longitude", value))).alias("_l"))
            .select("day_number", "latitude", F.transform("_l", lambda s: s[value]).alias("vals")))


def _keys(t):
    a = F.abs(t)
    inner = (KEYS_A + 2) * a * a * a - (KEYS_A + 3) * a * a + 1
    outer = KEYS_A * a * a * a - 5 * KEYS_A * a * a + 8 * KEYS_A * a - 4 * KEYS_A
    return F.when(a <= 1, inner).when(a < 2, outer).otherwise(F.lit(0.0))


def lattice_points(clim: DataFrame, value: str = "climatology", by=()) -> DataFrame:
    """Lattice position ``i, j`` and ``val`` of each non-missing value.

    Longitudes are wrapped into -180..180. A position that is not on the
    lattice, and a second value at one position (of one group ``by``), fail the job.
    """
    by = list(by)
    pts = drop_missing(clim, value)
    u = F.col("latitude") - F.lit(LAT0)
    v = F.pmod(F.col("longitude") - F.lit(LON0), F.lit(360.0))
    i, j = F.round(u).cast("int"), F.pmod(F.round(v).cast("int"), F.lit(NLON))
    on = F.coalesce((F.abs(u - F.round(u)) < 1e-6) & (F.abs(v - F.round(v)) < 1e-6)
                    & (F.round(u) >= 0) & (F.round(u) < NLAT), F.lit(False))
    here = F.concat(F.coalesce(F.col("latitude").cast("string"), F.lit("null")), F.lit(" "),
                    F.coalesce(F.col("longitude").cast("string"), F.lit("null")))
    row = F.when(on, i).otherwise(F.raise_error(F.concat(F.lit("not on the climatology lattice: "), here)).cast("int"))
    pts = pts.select(*by, row.alias("i"), j.alias("j"), F.col(value).cast("double").alias("val"))
    one = pts.groupBy(*by, "i", "j").agg(F.max("val").alias("_v"), F.count(F.lit(1)).alias("_n"))
    val = F.when(F.col("_n") == 1, F.col("_v")).otherwise(F.raise_error(F.concat(
        F.lit("more than one climatology value at lattice "), F.concat_ws(" ", "i", "j"))).cast("double"))
    return one.select(*by, "i", "j", val.alias("val"))


def neighbourhoods(clim: DataFrame, value: str = "climatology", by=()) -> DataFrame:
    """The 4x4 lattice values around each lattice cell ``(i0, j0)``.

    Each lattice value is sent to the 16 cells whose stencil it belongs to and
    regrouped, so the result has one row per lattice cell with columns
    ``t0..t15`` (tap ``(m, n)``, m, n in -1..2, is ``t[(m+1)*4 + n+1]``). For one
    day its size is bounded by the lattice (at most 184 x 364 rows), which is
    what makes broadcasting it safe; ``by`` names the day column for several.
    """
    by = list(by)
    pts = lattice_points(clim, value, by)
    t = F.col("t")
    m = (t / 4).cast("int") - 1
    n = F.pmod(t, F.lit(4)) - 1
    spread = pts.select(*by, "val", "i", "j", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("t")).select(
        *by, (F.col("i") - m).alias("i0"), (F.col("j") - n).alias("j0"), "t", "val")
    taps = [F.max(F.when(t == k, F.col("val"))).alias(f"t{k}") for k in range(16)]
    if by:
        return spread.groupBy(*by, "i0", "j0").agg(*taps)
    # few bytes but 16 aggregates per row: partition by the work (lattice
    # cells), not by bytes, so the regrouping does not collapse into one task
    nparts = work_partitions(NLAT * NLON * 16, 100_000)
    return spread.repartition(nparts, "i0", "j0").groupBy("i0", "j0").agg(*taps)


def cell_lattice_coords(df: DataFrame, scale: float, ref_row_shift: int = 1) -> DataFrame:
    """Lattice coordinates (u, v) of each cell ``r, c`` of the reference grid.

    Row r is latitude ``(90*scale - ref_row_shift - r)/scale``; the default
    shift 1 is the reference's (its flipped grid sits one row off the current
    grid), 0 aligns both grids. Column c is longitude ``c/scale - 180``.
    """
    s = float(scale)
    lat = (F.lit(90.0 * s - ref_row_shift) - F.col("r")) / F.lit(s)
    lon = F.col("c") / F.lit(s) - F.lit(180.0)
    x = df.select("*", (lat - F.lit(LAT0)).alias("_u"), (lon - F.lit(LON0)).alias("_v"))
    return x.select("*", F.floor("_u").cast("int").alias("i0"), F.floor("_v").cast("int").alias("j0"))


def interpolate(df: DataFrame, out: str = "ref") -> DataFrame:
    """Value from the joined taps ``t0..t15`` at fractional position (_u, _v).

    16 taps: cubic convolution; else the 4 bilinear taps; else the nearest
    existing one of those 4 corners; else null. Outside the lattice extent:
    null. Adds ``out`` and ``taps`` (16, 4, 1 or 0). The kernel weights are
    projected once in their own step, which keeps the generated code small.
    """
    keep = [c for c in df.columns if c not in ("_u", "_v", "i0", "j0") and not (c[:1] == "t" and c[1:].isdigit())]
    x = df.select("*", (F.col("_u") - F.col("i0")).alias("_fu"), (F.col("_v") - F.col("j0")).alias("_fv"))
    x = x.select("*", *[_keys(F.col("_fu") - m).alias(f"_wu{m + 1}") for m in (-1, 0, 1, 2)],
                 *[_keys(F.col("_fv") - n).alias(f"_wv{n + 1}") for n in (-1, 0, 1, 2)])
    fu, fv = F.col("_fu"), F.col("_fv")
    tap = [F.col(f"t{k}") for k in range(16)]
    cubic = None
    n16 = None
    for a in range(4):
        for b in range(4):
            term = F.col(f"_wu{a}") * F.col(f"_wv{b}") * tap[a * 4 + b]
            cubic = term if cubic is None else cubic + term
            one = tap[a * 4 + b].isNotNull().cast("int")
            n16 = one if n16 is None else n16 + one
    t00, t01, t10, t11 = tap[5], tap[6], tap[9], tap[10]
    # bilinear square: a corner with weight 0 (cell on a lattice line) is not needed
    n4 = None
    bil = None
    for wgt, t in (((1 - fu) * (1 - fv), t00), ((1 - fu) * fv, t01), (fu * (1 - fv), t10), (fu * fv, t11)):
        ok = (t.isNotNull() | (wgt == 0)).cast("int")
        part = F.when(wgt == 0, F.lit(0.0)).otherwise(wgt * t)
        n4 = ok if n4 is None else n4 + ok
        bil = part if bil is None else bil + part
    # nearest existing corner of the cell, ties to the smaller (m, n)
    near = F.least(*[F.when(t.isNotNull(), F.struct(((fu - m) * (fu - m) + (fv - n) * (fv - n)).alias("d"),
                                                   F.lit(m).alias("m"), F.lit(n).alias("n"), t.alias("val")))
                     for m, n, t in ((0, 0, t00), (0, 1, t01), (1, 0, t10), (1, 1, t11))])["val"]
    inside = ((F.col("_u") >= 0) & (F.col("_u") <= NLAT - 1) & (F.col("_v") >= 0) & (F.col("_v") <= NLON - 1))
    x = x.select(*keep, n16.alias("_n16"), n4.alias("_n4"), cubic.alias("_cubic"), bil.alias("_bil"),
                 near.alias("_near"), inside.alias("_in"))
    val = (F.when(~F.col("_in"), F.lit(None).cast("double"))
           .when(F.col("_n16") == 16, F.col("_cubic")).when(F.col("_n4") == 4, F.col("_bil"))
           .otherwise(F.col("_near")))
    taps = (F.when(~F.col("_in"), F.lit(0)).when(F.col("_n16") == 16, F.lit(16))
            .when(F.col("_n4") == 4, F.lit(4)).when(F.col("_near").isNotNull(), F.lit(1)).otherwise(F.lit(0)))
    return x.select(*keep, val.alias(out), taps.cast("int").alias("taps"))


def add_reference(cells: DataFrame, clim_day: DataFrame, scale: float, ref_row_shift: int = 1,
                  out: str = "ref", land: str | None = "land") -> DataFrame:
    """J5 on any cell table: adds the upsampled climatology as column ``out``.

    The lattice neighbourhoods (bounded by the lattice size) are broadcast, so
    the cell table is neither shuffled nor exploded; cells that are not land
    (when ``land`` is given) get null without being interpolated.
    """
    nb = neighbourhoods(clim_day)
    x = cell_lattice_coords(cells, scale, ref_row_shift)
    x = interpolate(x.join(F.broadcast(nb), ["i0", "j0"], "left"), out)
    if land:
        keep = [c for c in x.columns if c not in (out, "taps")]
        x = x.select(*keep, F.when(F.col(land), F.col(out)).alias(out),
                     F.when(F.col(land), F.col("taps")).otherwise(F.lit(0)).alias("taps"))
    return x


def upsample_reference(clim_day: DataFrame, cells: DataFrame, scale: float, ref_row_shift: int = 1) -> DataFrame:
    """Climatology of one day to grid cells ``r, c, v, taps`` (land only)."""
    land = cells.where(F.col("land")) if "land" in cells.columns else cells
    out = add_reference(land.select("r", "c"), clim_day, scale, ref_row_shift, out="v", land=None)
    return out.select("r", "c", "v", "taps")
