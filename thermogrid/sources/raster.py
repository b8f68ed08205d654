"""The map as pictures (S12): a pyramid of PNG tiles, written through a Python data source.

Level ``z`` of the deepest overview is one tile; each deeper level doubles the resolution,
the last one has a pixel per map cell. Overviews are means of the cells' differences over
blocks of cells, on the same colour scale. A pixel is the cell's ``level`` (0..255) as an index
into a palette from blue over grey to red; cells without a difference are transparent.

    <path>/map.json                 the served map: {"map": name, "levels": n, "tile": side, ...}
    <path>/<name>/<z>/<r>_<c>.png   its tiles
    <path>/pending-<attempt>/       tiles of tasks that are still running, or died

Tasks write their tiles to a folder of their own attempt. Commit moves the tiles of the
successful attempts into a folder with a new name, and only then replaces ``map.json``
by one rename, so a reader sees the old map or the new one. A failed job leaves the old
one; what it left pending goes with the next commit, like the map before the last.
Any file system that pyarrow knows by its URI will do, if all executors reach it.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from thermogrid.functions.columns import HEAT_HI, HEAT_LO, heat_clip, heat_level

TILE = 256
EMPTY = 256            # the pixel of a cell without a level, before it is packed
SCHEMA = "z int, tr int, tc int, i int, j int, level int"
_SIGNATURE = b"\x89PNG\r\n\x1a\n"


# ------------------------------------------------------------------ pictures

def palette() -> np.ndarray:
    """256 colours: blue, light grey in the middle, red."""
    t = np.linspace(-1, 1, 256)[:, None]
    grey, blue, red = (np.array(c, float) for c in ((221, 221, 221), (59, 76, 192), (180, 4, 38)))
    return np.where(t < 0, grey + (grey - blue) * t, grey + (red - grey) * t).round().astype(np.uint8)


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encode_png(levels: np.ndarray) -> bytes:
    """An indexed picture of ``levels`` (0..255, ``EMPTY`` = transparent). With empty pixels index 0 is
    the transparent one and the colours of levels 0 and 1 are the same."""
    rows, cols = levels.shape
    holes = bool((levels == EMPTY).any())
    pixels = np.where(levels == EMPTY, 0, np.maximum(levels, 1) if holes else levels).astype(np.uint8)
    raw = np.concatenate([np.zeros((rows, 1), np.uint8), pixels], axis=1).tobytes()  # no filter per line
    head = _chunk(b"IHDR", struct.pack(">IIBBBBB", cols, rows, 8, 3, 0, 0, 0)) + _chunk(b"PLTE", palette().tobytes())
    return _SIGNATURE + head + (_chunk(b"tRNS", b"\0") if holes else b"") + _chunk(b"IDAT", zlib.compress(raw, 6)) + _chunk(b"IEND", b"")


def decode_png(data: bytes) -> np.ndarray:
    """Levels of a picture of :func:`encode_png`, ``EMPTY`` where it is transparent."""
    if data[:8] != _SIGNATURE:
        raise ValueError("not a PNG")
    at, parts = 8, {}
    while at < len(data):
        n, kind = struct.unpack(">I4s", data[at:at + 8])
        body = data[at + 8:at + 8 + n]
        if struct.unpack(">I", data[at + 8 + n:at + 12 + n])[0] != zlib.crc32(kind + body):
            raise ValueError(f"broken {kind.decode()} chunk")
        parts[kind] = parts.get(kind, b"") + body
        at += 12 + n
    cols, rows = struct.unpack(">II", parts[b"IHDR"][:8])
    lines = np.frombuffer(zlib.decompress(parts[b"IDAT"]), np.uint8).reshape(rows, cols + 1)
    out = lines[:, 1:].astype(np.int32)
    return np.where(out == 0, EMPTY, out) if b"tRNS" in parts else out


# ------------------------------------------------------------------ the sink

def _open(path: str):
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


@dataclass
class TilesWritten(WriterCommitMessage):
    folder: str
    names: list[str]


class TileWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.path = options["path"].rstrip("/")
        self.tile = int(options.get("tile", TILE))
        self.about = {k: int(options[k]) for k in ("levels", "rows", "cols") if k in options}

    def write(self, iterator):
        """Rows come sorted by tile; one tile is held at a time."""
        fs, base = _open(self.path)
        folder = f"pending-{uuid.uuid4().hex}"
        names: list[str] = []
        here, picture = None, None

        def finish():
            if here is not None:
                z, r, c = here
                fs.create_dir(f"{base}/{folder}/{z}", recursive=True)
                name = f"{z}/{r}_{c}.png"
                with fs.open_output_stream(f"{base}/{folder}/{name}") as f:
                    f.write(encode_png(picture))
                names.append(name)

        for batch in iterator:
            z, tr, tc, i, j = (batch.column(n).to_numpy() for n in ("z", "tr", "tc", "i", "j"))
            level = batch.column("level").fill_null(EMPTY).to_numpy()
            key = np.stack([z, tr, tc], axis=1)
            cuts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]).any(axis=1)])) if len(key) else []
            for a, b in zip(cuts, [*cuts[1:], len(key)]):
                if tuple(key[a].tolist()) != here:
                    finish()
                    here, picture = tuple(key[a].tolist()), np.full((self.tile, self.tile), EMPTY, np.int32)
                picture[i[a:b], j[a:b]] = level[a:b]
        finish()
        return TilesWritten(folder, names)

    def commit(self, messages):
        fs, base = _open(self.path)
        name = f"map-{uuid.uuid4().hex}"
        fs.create_dir(f"{base}/{name}", recursive=True)
        for m in messages:
            for tile in m.names if m else []:
                fs.create_dir(f"{base}/{name}/{tile.split('/')[0]}", recursive=True)
                fs.move(f"{base}/{m.folder}/{tile}", f"{base}/{name}/{tile}")
        before = read_pointer(self.path)
        with fs.open_output_stream(f"{base}/map.json.{name}") as f:
            f.write(json.dumps({"map": name, "tile": self.tile, **self.about}).encode())
        fs.move(f"{base}/map.json.{name}", f"{base}/map.json")
        keep = {name, before and before["map"]}  # readers may still use the one before
        for x in fs.get_file_info(pafs.FileSelector(base)):
            if x.type == pafs.FileType.Directory and x.base_name.startswith(("map-", "pending-")) and x.base_name not in keep:
                fs.delete_dir(x.path)

    def abort(self, messages):
        fs, base = _open(self.path)
        for m in messages:
            if m:
                info = fs.get_file_info(f"{base}/{m.folder}")
                if info.type == pafs.FileType.Directory:
                    fs.delete_dir(f"{base}/{m.folder}")


class TileSource(DataSource):
    @classmethod
    def name(cls):
        return "heatmap_tiles"

    def schema(self):
        return SCHEMA

    def writer(self, schema, overwrite):
        return TileWriter(self.options)


def read_pointer(path: str) -> dict | None:
    """What ``map.json`` says, None when no map has been committed."""
    fs, base = _open(path.rstrip("/"))
    if fs.get_file_info(f"{base}/map.json").type != pafs.FileType.File:
        return None
    with fs.open_input_stream(f"{base}/map.json") as f:
        return json.loads(f.read())


def pyramid(cells: DataFrame, rows: int, cols: int, tile: int = TILE, lo: float = HEAT_LO, hi: float = HEAT_HI) -> DataFrame:
    """``z, tr, tc, i, j, level`` for all levels of the map ``cells`` (r, c, diff): the tile and the pixel in it.
    Each overview is made from sums and counts of the level below, so the cells are read once."""
    deepest = 0
    while tile << deepest < max(rows, cols):
        deepest += 1
    d = heat_clip("diff", lo, hi)
    level = cells.select("r", "c", F.coalesce(d, F.lit(0.0)).alias("s"), d.isNotNull().cast("long").alias("n"))
    parts = []
    for z in range(deepest, -1, -1):
        mean = F.when(F.col("n") > 0, F.col("s") / F.col("n"))
        at = lambda c: (F.floor(F.col(c) / tile).cast("int"), (F.col(c) % tile).cast("int"))
        (tr, i), (tc, j) = at("r"), at("c")
        parts.append(level.select(F.lit(z).alias("z"), tr.alias("tr"), tc.alias("tc"), i.alias("i"), j.alias("j"),
                                  heat_level(mean, lo, hi).alias("level")))
        level = (level.groupBy(F.floor(F.col("r") / 2).cast("int").alias("r"), F.floor(F.col("c") / 2).cast("int").alias("c"))
                 .agg(F.sum("s").alias("s"), F.sum("n").alias("n")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def write_map_tiles(cells: DataFrame, path: str, rows: int, cols: int, tile: int = TILE, lo: float = HEAT_LO, hi: float = HEAT_HI) -> None:
    """S12 as pictures: replace the served map at ``path`` by that of ``cells`` (r, c, diff)."""
    cells.sparkSession.dataSource.register(TileSource)
    p = pyramid(cells, rows, cols, tile, lo, hi)
    levels = 0
    while tile << levels < max(rows, cols):
        levels += 1
    (p.repartition("z", "tr", "tc").sortWithinPartitions("z", "tr", "tc").write.format("heatmap_tiles").mode("append")
     .option("path", path).option("tile", str(tile)).option("levels", str(levels + 1)).option("rows", str(rows))
     .option("cols", str(cols)).save())


def read_map_tiles(spark: SparkSession, path: str) -> DataFrame:
    """``z, r, c, level`` of the served map, from the pixels; transparent ones are left out."""
    told = read_pointer(path)
    if told is None:
        raise FileNotFoundError(f"no map at {path}")
    tile = told["tile"]
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.png")
             .load(f"{path.rstrip('/')}/{told['map']}").select("path", "content"))

    def run(batches):
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                *_, z, spot = name.split("/")
                tr, tc = map(int, spot[:-4].split("_"))
                i, j = np.nonzero((px := decode_png(data)) != EMPTY)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(i.size, int(z), np.int32)), pa.array((tr * tile + i).astype(np.int32)),
                     pa.array((tc * tile + j).astype(np.int32)), pa.array(px[i, j].astype(np.int32))], names=["z", "r", "c", "level"])

    return files.mapInArrow(run, "z int, r int, c int, level int")
