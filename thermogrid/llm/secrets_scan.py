"""Secret scan with multipart credential linking, in DataFrame functions only.

Base spans are found by pattern, leftmost and without overlap per kind:
``assign`` (a named secret and its value), ``access`` (access key ids) and
``hex`` (long hexadecimal strings). Weak candidates (``ident``: account names and
the like, ``opaque``: long mixed tokens, ``endpoint``: service addresses) are
reported only when complementary parts stand within ``SCOPE`` code points in the
same text: an identifier with a secret, a secret with an identifier, an
endpoint with both. The parts meet in an interval join on (text, block of
``SCOPE`` code points), so a group never holds more than a few blocks of one text.

Positions come from the lengths of the pieces between matches, summed up along
the text; they count code points, the end is exclusive.

Edge cases: null is empty, and an empty text has no span. Every row is scanned by
itself, equal rows and equal ids included. A weak candidate that overlaps a
base span is dropped. Only the id and text columns are read; :func:`redact`
keeps all columns as they are but the text and, where there, ``n_chars``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thermogrid.llm.common import stored, with_row_id

SCOPE = 400
MASK = "[SECRET]"

# Patterns of the base kinds (fixed values), in listed order.
ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # a maximal run of 24 or more: the same spans as runs of any length, then filtered
# Weak kinds.
IDENT = r"""(?i:user(?:_?name)?|login|account|client_?id|access_?key(?:_?id)?)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}"""
OPAQUE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"
ENDPOINT = (r"(?:https?|ftp|s3|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqps?)://[^\s\"'<>|]+"
            r"|(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?::[0-9]{1,5})?")
KINDS = [("assign", ASSIGN), ("access", ACCESS), ("hex", HEX), ("ident", IDENT), ("opaque", OPAQUE),
         ("endpoint", ENDPOINT)]
BASE = 3  # so many of them are base kinds
ROLE = {"access": "id", "ident": "id", "assign": "secret", "hex": "secret", "opaque": "secret",
        "endpoint": "endpoint"}


def _accepted(kind: str, match: Column) -> Column:
    """The length and content rules that a match must also meet."""
    if kind == "assign":
        return F.length(F.regexp_extract(match, "^" + ASSIGN, 2)) >= 6
    if kind == "access":
        return F.length(match) >= 20
    if kind == "opaque":
        return match.rlike("[0-9]") & match.rlike("[A-Za-z]")
    return F.lit(True)


def _part(k: int, kind: str):
    return lambda match, gap: F.struct(F.lit(k).alias("kind"), F.length(gap).alias("gap"),
                                       F.length(match).alias("len"), _accepted(kind, match).alias("ok"))


def _parts(docs: DataFrame, text: Column) -> DataFrame:
    """``docs`` with ``_parts``: for each match its kind, number in the text, the
    lengths of the piece before it and of itself, and whether it is accepted."""
    kinds = {f"_m{k}": F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(p), F.lit(0))
             for k, (_, p) in enumerate(KINDS)}
    found = docs.withColumns(kinds)
    lists = []
    for k, (kind, pattern) in enumerate(KINDS):
        m = F.col(f"_m{k}")
        between = F.split(text, pattern, -1)
        lists.append(F.when(F.size(m) > 0, F.zip_with(m, F.slice(between, 1, F.size(m)), _part(k, kind)))
                     .otherwise(F.array().cast("array<struct<kind:int,gap:int,len:int,ok:boolean>>")))
    return found.withColumn("_parts", F.flatten(F.array(*lists))).drop(*kinds)


def _spans(parts: DataFrame) -> DataFrame:
    """(_row, kind, start, end) of the accepted matches of ``parts`` (_row, _parts)."""
    rows = parts.select("_row", F.posexplode("_parts").alias("n", "p")).select("_row", "n", "p.*")
    along = Window.partitionBy("_row", "kind").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("len")).over(along)
    return rows.withColumn("end", end).where("ok").select("_row", "kind", (F.col("end") - F.col("len")).alias("start"), "end")


def _blocks(low: Column, high: Column) -> Column:
    block = lambda c: F.floor(c / SCOPE)
    return F.explode(F.sequence(block(low), block(high)))


def _linked(spans: DataFrame) -> DataFrame:
    """Base spans, and the weak ones whose complement is near."""
    base = spans.where(F.col("kind") < BASE)
    weak = spans.where(F.col("kind") >= BASE).withColumn("block", _blocks(F.col("start"), F.col("end") - 1))
    cover = base.select(F.col("_row").alias("r"), F.col("start").alias("s"), F.col("end").alias("e"),
                        _blocks(F.col("start"), F.col("end") - 1).alias("b"))
    touched = weak.join(cover, (F.col("_row") == F.col("r")) & (F.col("block") == F.col("b"))
                        & (F.col("start") < F.col("e")) & (F.col("s") < F.col("end")), "left_semi")
    key = ["_row", "kind", "start", "end"]
    weak = weak.select(*key).distinct().join(touched.select(*key).distinct(), key, "left_anti")

    names = [k for k, _ in KINDS]
    of = lambda role: [i for i, k in enumerate(names) if ROLE[k] == role]
    parts = base.unionByName(weak)

    def near(rows: DataFrame, role: str) -> DataFrame:
        """The rows with a part of this role no further than SCOPE from them."""
        mine = rows.withColumn("block", F.floor(F.col("start") / SCOPE))
        other = parts.where(F.col("kind").isin(of(role))).select(
            F.col("_row").alias("r"), F.col("start").alias("s"),
            _blocks(F.greatest(F.col("start") - SCOPE, F.lit(0)), F.col("start") + SCOPE).alias("b"))
        return mine.join(other, (F.col("_row") == F.col("r")) & (F.col("block") == F.col("b"))
                         & (F.abs(F.col("start") - F.col("s")) <= SCOPE), "left_semi").drop("block")

    kind = lambda k: weak.where(F.col("kind") == names.index(k))
    return (base.unionByName(near(kind("ident"), "secret")).unionByName(near(kind("opaque"), "id"))
            .unionByName(near(near(kind("endpoint"), "secret"), "id")))


def _listed(rows: Column) -> Column:
    """kind:start:end of spans (start, kind, end), comma-joined in order."""
    names = F.array(*[F.lit(k) for k, _ in KINDS])
    return F.array_join(F.transform(rows, lambda x: F.concat_ws(
        ":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans array<struct<start,kind,end>> in order, kind an index into
    ``KINDS``), one row per row of ``docs``."""
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    held = stored(_parts(with_row_id(src, "_row"), F.col("text")).select("_row", "doc_id", "_parts"), "secret-parts")
    found = (_linked(_spans(held)).groupBy("_row")
             .agg(F.sort_array(F.collect_list(F.struct("start", "kind", "end"))).alias("spans")))
    return held.join(found, "_row", "left").select(
        F.col("doc_id").alias(id_col),
        F.coalesce("spans", F.array().cast(found.schema["spans"].dataType)).alias("spans"))


def redact(docs: DataFrame, text_col: str = "text", mask: str = MASK) -> DataFrame:
    """``docs`` with every reported span replaced by ``mask``; overlapping spans
    are one. Texts without a match are not moved. Inside, the columns of ``docs`` stand
    under their numbers, so any name may occur among them."""
    columns = docs.columns
    number = [f"c{i}" for i in range(len(columns))]
    name = number[columns.index(text_col)]
    text = F.col(name)
    held = stored(_parts(with_row_id(docs.toDF(*number), "_row"), text), "secret-docs")
    spans = _linked(_spans(held.where(F.size("_parts") > 0).select("_row", "_parts")))
    order = Window.partitionBy("_row").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = (spans.withColumn("new", F.when(F.col("start") < reach, 0).otherwise(1))
            .withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy("_row", "run").agg(F.min("start").alias("s"), F.max("end").alias("e"))
            .groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("s", "e"))).alias("_cut")))
    both = held.where(F.size("_parts") > 0).join(runs, "_row", "left")
    pieces = F.transform("_cut", lambda x, i: F.concat(
        text.substr(F.when(i == 0, 1).otherwise(F.element_at("_cut", F.greatest(i, F.lit(1)))["e"] + 1).cast("int"),
                    (x["s"] - F.when(i == 0, 0).otherwise(F.element_at("_cut", F.greatest(i, F.lit(1)))["e"])).cast("int")),
        F.lit(mask)))
    rest = text.substr((F.element_at("_cut", -1)["e"] + 1).cast("int"), F.length(text))
    clean = F.when(F.col("_cut").isNull(), text).otherwise(F.concat(F.array_join(pieces, ""), rest))
    done = both.withColumn(name, clean)
    if "n_chars" in columns:
        size = number[columns.index("n_chars")]
        done = done.withColumn(size, F.when(F.col("_cut").isNull(), F.col(size))
                               .otherwise(F.length(text).cast(docs.schema["n_chars"].dataType)))
    return held.where(F.size("_parts") == 0).select(*number).unionByName(done.select(*number)).toDF(*columns)


def op5_secret_scans(docs: DataFrame) -> DataFrame:
    got = scan(docs)
    base = F.filter("spans", lambda x: x["kind"] < BASE)
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long")
    return got.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                      F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))
