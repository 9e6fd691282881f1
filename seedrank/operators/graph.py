"""Tag-graph build (G1–G5) and the proximity range join.

* G1 pulls positioned elements (or links) out of stored HTML with ``regexp_extract_all``.
* J7 is a grid-bucketed range join: cell size = radius, one side explodes its 3×3 neighbour
  cells, equi-join on the cell, exact distance filter, ``src < dst``. Work is proportional
  to the pairs that are actually near, not n²; dense cells are quartered, so none meets in one task.
* G4 walks are joins of walker states against per-node cumulative-weight intervals; the
  draw is a hash of (seed, walk, step), so a retried task takes the same steps.
* G5 factorises the walks' co-occurrences; the factors stay tables, a row per node.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seedrank.functions.params import bounded_broadcast, by_key, drop_table, release_shuffles, write_once

# Fixed values that must equal the reference's behaviour.
EDGE_RADIUS = 150.0           # px on the 2-D map
WALK_LENGTH = 5
WALKS_PER_NODE = 20
EMBED_DIM = 16
EMBED_WINDOW = 5
CELL_POINTS, CELL_DEPTH = 2_000, 5   # J7: our own: points of a cell before it is quartered, and how often
HUB_PARTS = 64
MAX_DRAW_BUCKETS = 1 << 20     # G4: our own: draw buckets of a node, else as many as it has edges
EMBED_ROUNDS = 6               # G5: our own: rounds of the subspace iteration
PASS_BYTES = 4_000_000_000     # G5: our own: products of pairs and factor that one pass shuffles
# Positioned element on the map page: name, link, left px, top px.
POSITIONED_PATTERN = (r'(?is)<div\b([^>]*)>([^<]*)<a\b([^>]*)>')
LINK_PATTERN = r'<a href="([^"]*)">([^<]*)</a>'


def extract_positions(pages: DataFrame, html: str = "html", id_col: str = "page_id") -> DataFrame:
    """G1: (page, pos, name, link, left, top) for every positioned element of every page."""
    tag, text, anchor = (F.regexp_extract_all(html, F.lit(POSITIONED_PATTERN), k) for k in (1, 2, 3))
    ex = pages.select(id_col, F.posexplode(F.arrays_zip(tag.alias("tag"), text.alias("name"), anchor.alias("anchor"))).alias("pos", "e"))

    def attribute(source: str, name: str):
        value = r"""(?i)(?:^|\s)""" + name + r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
        return F.concat(*(F.regexp_extract(source, value, k) for k in (1, 2, 3)))

    style = attribute("e.tag", "style")
    side = lambda s: F.regexp_extract(style, r"(?i)(?:^|[;\s])" + s + r"\s*:\s*(-?[\d.]+)\s*px", 1).try_cast("double")
    found = ex.filter(F.array_contains(F.split(F.trim(attribute("e.tag", "class")), r"\s+"), "genre"))
    w = Window.partitionBy(id_col).orderBy("pos")
    return found.select(id_col, (F.row_number().over(w) - 1).alias("pos"), F.trim("e.name").alias("name"),
                        attribute("e.anchor", "href").alias("link"), side("left").alias("left"), side("top").alias("top"))


def extract_links(pages: DataFrame, html: str = "html", id_col: str = "page_id") -> DataFrame:
    """G1 on plain links: (page, pos, href, text)."""
    arr = F.arrays_zip(F.regexp_extract_all(html, F.lit(LINK_PATTERN), 1).alias("href"),
                       F.regexp_extract_all(html, F.lit(LINK_PATTERN), 2).alias("text"))
    ex = pages.select(id_col, F.posexplode(arr).alias("pos", "e"))
    return ex.select(id_col, "pos", "e.href", "e.text")


def _cell(c: str, radius: float, level: int) -> Column:
    return F.floor(F.col(c) / F.lit(radius / (1 << level))).cast("long")


def dense_cells(points: DataFrame, x: str, y: str, radius: float, most: int, depth: int) -> list[DataFrame]:
    """Per level of a quad tree the cells (cx, cy, n) that hold more than ``most`` points: cells of the radius' size first, then
    their quarters, as long as there are any. At most points / ``most`` rows a level, written and size-checked for broadcast."""
    out, inside = [], points
    for level in range(depth + 1):
        counts = inside.groupBy(_cell(x, radius, level).alias("cx"), _cell(y, radius, level).alias("cy")).agg(F.count(F.lit(1)).alias("n"))
        dense = bounded_broadcast(counts.where(F.col("n") > most))
        if dense.isEmpty():
            break
        out.append(dense)
        inside = inside.withColumns({"cx": _cell(x, radius, level), "cy": _cell(y, radius, level)}).join(dense, ["cx", "cy"], "left_semi").drop("cx", "cy")
    return out


def proximity_edges(points: DataFrame, id_col: str = "id", x: str = "x", y: str = "y",
                    radius: float = EDGE_RADIUS, most: int = CELL_POINTS, depth: int = CELL_DEPTH) -> DataFrame:
    """Undirected edges (src < dst) between points closer than ``radius``, weight
    1 / (distance + 1).

    A cell of more than ``most`` points is quartered, and its quarters again, down to ``depth``; a point on the probing side is
    listed under the leaves that its circle touches, one on the other side under its own leaf. A leaf that is still
    dense (many points in one place) is dealt by hash. So no task meets more than about ``most`` points of the other side."""
    a = points.select(F.col(id_col).alias("src"), F.col(x).alias("ax"), F.col(y).alias("ay"))
    b = points.select(F.col(id_col).alias("dst"), F.col(x).alias("bx"), F.col(y).alias("by"))
    near = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in (-1, 0, 1) for dy in (-1, 0, 1)])
    a = a.select("src", "ax", "ay", _cell("ax", radius, 0).alias("cx"), _cell("ay", radius, 0).alias("cy"), F.explode(near).alias("o")).select(
        "src", "ax", "ay", (F.col("cx") + F.col("o.dx")).alias("cx"), (F.col("cy") + F.col("o.dy")).alias("cy"), F.lit(0).alias("level"), F.lit(0).alias("part"))
    b = b.select("*", _cell("bx", radius, 0).alias("cx"), _cell("by", radius, 0).alias("cy"), F.lit(0).alias("level"), F.lit(0).alias("part"))
    dense = dense_cells(points, x, y, radius, most, depth)
    for level, cells in enumerate(dense):
        here = cells.withColumn("level", F.lit(level))
        a, b = (side.join(here, ["level", "cx", "cy"], "left") for side in (a, b))
        split = F.col("n").isNotNull()
        if level == depth:  # as small as cells get: by hash
            parts = F.ceil(F.col("n") / F.lit(float(most))).cast("int")
            a = a.select("src", "ax", "ay", "cx", "cy", "level", F.explode(F.when(split, F.sequence(F.lit(0), parts - 1)).otherwise(F.array(F.lit(0)))).alias("part"))
            b = b.withColumn("part", F.when(split, F.pmod(F.xxhash64("dst"), parts).cast("int")).otherwise(0)).drop("n")
            break
        side = F.lit(radius / (2 << level))
        quarter = F.array(*[F.struct((F.col("cx") * 2 + i).alias("cx"), (F.col("cy") * 2 + j).alias("cy"), F.lit(level + 1).alias("level")) for i in (0, 1) for j in (0, 1)])
        gap = lambda p, c: F.greatest(c * side - p, p - (c + 1) * side, F.lit(0.0))  # noqa: E731  distance to the box, a side at a time
        touched = F.filter(quarter, lambda q: gap(F.col("ax"), q["cx"]) ** 2 + gap(F.col("ay"), q["cy"]) ** 2 < radius * radius * (1 + 1e-9))
        own = F.array(F.struct("cx", "cy", "level"))
        a = a.select("src", "ax", "ay", "part", F.explode(F.when(split, touched).otherwise(own)).alias("q")).select("src", "ax", "ay", "q.cx", "q.cy", "q.level", "part")
        b = b.select("dst", "bx", "by", "part", *[F.when(split, fine).otherwise(F.col(c)).alias(c) for c, fine in (
            ("cx", _cell("bx", radius, level + 1)), ("cy", _cell("by", radius, level + 1)), ("level", F.lit(level + 1)))])
    j = a.join(by_key(b), ["level", "cx", "cy", "part"]).where(F.col("src") < F.col("dst"))
    d = F.sqrt((F.col("ax") - F.col("bx")) ** 2 + (F.col("ay") - F.col("by")) ** 2)
    return j.where(d < radius).select("src", "dst", d.alias("distance"), (1.0 / (d + 1.0)).alias("weight"))


def connected_nodes(edges: DataFrame, out: str = "id") -> DataFrame:
    """The graph's nodes: the points with at least one edge."""
    return edges.select(F.explode(F.array("src", "dst")).alias(out)).distinct()


def graph_summary(edges: DataFrame) -> DataFrame:
    """Node and edge counts; a point without an edge is no node."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("__n"))
    return ends.agg(F.count_distinct("__n").alias("nodes"), (F.count("__n") / 2).cast("long").alias("edges"))


def _unit_draw(seed: int, *cols) -> F.Column:
    """Uniform [0, 1) from a 64-bit hash of (seed, cols...)."""
    h = F.xxhash64(F.lit(seed), *cols)
    return F.pmod(h, F.lit(1 << 52)).cast("double") / float(1 << 52)


def random_walks(nodes: DataFrame, edges: DataFrame, length: int = WALK_LENGTH, per_node: int = WALKS_PER_NODE,
                 seed: int = 42, node: str = "id") -> DataFrame:
    """``per_node`` weight-proportional walks of ``length`` nodes from every node
    (first-order, as node2vec with p = q = 1). Dead ends stop the walk."""
    both = edges.select("src", "dst", "weight").unionByName(
        edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
    # cumulative shares in two levels, so a hub's neighbours are never sorted in one task: the node's
    # hash parts first (at most HUB_PARTS rows a node), then the neighbours inside each part. Every
    # interval starts where the previous one ends, and the last one ends at 1.
    both = both.withColumn("__part", F.pmod(F.xxhash64("dst"), F.lit(HUB_PARTS)))
    node_w, part_w = Window.partitionBy("src").orderBy("__part"), Window.partitionBy("src", "__part").orderBy("dst")
    running = (Window.unboundedPreceding, Window.currentRow)
    parts = both.groupBy("src", "__part").agg(F.sum("weight").alias("__w"), F.count(F.lit(1)).alias("__c"))
    share = F.sum("__w").over(node_w.rowsBetween(*running)) / F.sum("__w").over(Window.partitionBy("src"))
    buckets = F.least(F.sum("__c").over(Window.partitionBy("src")), F.lit(MAX_DRAW_BUCKETS)).cast("int")
    parts = parts.withColumns({"__end": F.when(F.lead("__part").over(node_w).isNull(), 1.0).otherwise(share), "__nb": buckets})
    parts = parts.withColumn("__start", F.coalesce(F.lag("__end").over(node_w), F.lit(0.0)))
    cum = both.join(by_key(parts), ["src", "__part"])
    inside = F.col("__start") + (F.col("__end") - F.col("__start")) * F.sum("weight").over(part_w.rowsBetween(*running)) / F.col("__w")
    cum = cum.withColumn("hi", F.when(F.lead("dst").over(part_w).isNull(), F.col("__end")).otherwise(inside))
    cum = cum.select("src", "dst", F.coalesce(F.lag("hi").over(part_w), F.col("__start")).alias("lo"), "hi", "__nb")
    # each interval is listed under every draw bucket it overlaps, so a walker meets ~1-2
    # candidate edges on the equi-key (src, bucket) instead of the node's whole neighbour list. A node has as many buckets as
    # edges, so the list has at most two rows an edge; an edge knows the buckets of the node it leads to, for the next draw
    bucket = lambda u, nb: F.least(F.floor(u * nb).cast("int"), nb - 1)
    degree = both.groupBy(F.col("src").alias("__node")).agg(F.least(F.count(F.lit(1)), F.lit(MAX_DRAW_BUCKETS)).cast("int").alias("__next"))
    cum = cum.join(by_key(degree), F.col("dst") == F.col("__node")).select(
        "src", "dst", "lo", "hi", "__next", F.explode(F.sequence(bucket(F.col("lo"), F.col("__nb")), bucket(F.col("hi"), F.col("__nb")))).alias("bucket"))
    # a walker's steps are columns of their own: half the bytes of an array, which every step would shuffle
    walks = nodes.select(F.col(node).alias("start")).join(by_key(degree.withColumnRenamed("__next", "__nb")), F.col("start") == F.col("__node"), "left")
    walks = walks.select("start", F.explode(F.sequence(F.lit(0), F.lit(per_node - 1))).alias("walk"), "__nb")
    steps: list[str] = []
    for step in range(1, length):
        last = steps[-1] if steps else "start"
        at = F.coalesce(*[F.col(c) for c in reversed(steps)], F.col("start"))  # a stopped walk stays where it is
        s = walks.withColumns({"__cur": at, "__u": _unit_draw(seed, F.col("start"), F.col("walk"), F.lit(step))})
        s = s.withColumn("__b", F.coalesce(bucket(F.col("__u"), F.col("__nb")), F.lit(0))).drop("__nb")
        c = by_key(cum.alias("c"))
        nxt = s.join(c, (s["__cur"] == c["src"]) & (s["__b"] == c["bucket"]) & (s["__u"] >= c["lo"]) & (s["__u"] < c["hi"])
                     & s[last].isNotNull(), "left")
        walks = nxt.select("start", "walk", *steps, F.col("dst").alias(f"__p{step}"), F.col("__next").alias("__nb"))
        steps.append(f"__p{step}")
    went = F.filter(F.array(*[F.col(c) for c in steps]), lambda v: v.isNotNull()) if steps else F.slice(F.array("start"), 1, 0)
    return walks.select("start", "walk", F.concat(F.array("start"), went).alias("path"))


def cooccurrences(walks: DataFrame, window: int = EMBED_WINDOW) -> DataFrame:
    """(src, dst, n): how often two nodes stand at most ``window`` places apart on a walk, both ways. A pair is counted once, whichever
    node comes first, and then listed both ways."""
    pos = F.sequence(F.lit(0), F.size("path") - 1)
    def ahead(i):
        a = F.get("path", i)
        b = lambda j: F.get("path", j)
        return F.transform(F.filter(pos, lambda j: (j > i) & (j - i <= window)), lambda j: F.struct(F.least(a, b(j)).alias("src"), F.greatest(a, b(j)).alias("dst")))
    pairs = walks.select(F.explode(F.flatten(F.transform(pos, ahead))).alias("e")).select("e.src", "e.dst")
    once = pairs.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
    same = F.col("src") == F.col("dst")
    ways = F.when(same, F.array(F.struct("src", "dst", (F.col("n") * 2).alias("n")))).otherwise(
        F.array(F.struct("src", "dst", "n"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")))
    return once.select(F.explode(ways).alias("e")).select("e.src", "e.dst", "e.n")


def walk_embeddings(walks: DataFrame, dim: int = EMBED_DIM, window: int = EMBED_WINDOW, seed: int = 42, rounds: int = EMBED_ROUNDS) -> DataFrame:
    """Vectors of the walked nodes → (node, vec array<double>), nodes that share walks close together.

    Skip-gram factorises the windowed co-occurrences' mutual information; here that matrix is factorised itself: positive
    entries log(n · total / (degree · degree)) as a table of pairs, and its leading ``dim`` directions by subspace
    iteration. A round multiplies the factor table (a row per node) by the pairs, a join and a sum per node, of so many columns at
    a time as ``PASS_BYTES`` of products allow,
    and makes its columns orthonormal with the ``dim`` x ``dim`` matrix of their products, the only thing that reaches
    the driver. Nodes without a pair (walks that end at once) get zeros. The walks are walked once, the steps' tables are removed and their
    shuffles released when they have been read, so the disk holds one pass."""
    spark = walks.sparkSession
    written: dict[str, str] = {}

    def keep(df: DataFrame, name: str) -> DataFrame:
        written[name] = write_once(df, name)
        del df
        release_shuffles(spark)
        return spark.read.parquet(written[name])

    def drop(*names: str) -> None:
        for n in names:
            drop_table(spark, written.pop(n))

    # a node's walks lie together, so a task counts most repeats of a pair before it sends it
    paths = keep(walks.select("path").repartition(F.get("path", F.lit(0))), "paths")
    nodes = keep(paths.select(F.explode("path").alias("node")).distinct(), "nodes")
    pairs = keep(cooccurrences(paths, window), "pairs")
    drop("paths")
    kind = dict(nodes.dtypes)["node"]
    degree = pairs.groupBy("src").agg(F.sum("n").alias("d"))
    size = pairs.agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("pairs")).first()
    total, at_once = float(size["total"] or 0), max(1, min(dim, PASS_BYTES // (8 * max(size["pairs"], 1))))
    by_src, by_dst = degree.withColumnRenamed("d", "ds"), degree.select(F.col("src").alias("dst"), F.col("d").alias("dd"))
    info = pairs.join(by_key(by_src), "src").join(by_key(by_dst), "dst").select("src", "dst", F.log(F.col("n") * F.lit(total) / (F.col("ds") * F.col("dd"))).alias("m"))
    info = keep(info.where(F.col("m") > 0), "information")
    del degree, by_src, by_dst, pairs
    drop("pairs")
    factor = nodes.select("node", F.array(*[_unit_draw(seed, F.col("node").cast("string"), F.lit(c)) - 0.5 for c in range(dim)]).alias("vec"))

    def times(x: DataFrame, name: str) -> DataFrame:
        """The matrix times the factor, written: (node, vec)."""
        whole, parts = None, range(0, dim, at_once)
        for lo in parts:
            own = range(lo, min(lo + at_once, dim))
            few = x.select(F.col("node").alias("dst"), F.slice("vec", lo + 1, len(own)).alias("vec"))
            y = info.join(by_key(few), "dst").groupBy(F.col("src").alias("node")).agg(*[F.sum(F.col("m") * F.col("vec")[c - lo]).alias(f"y{c}") for c in own])
            y = keep(y, f"{name}-{lo}") if len(parts) > 1 else y
            whole = y if whole is None else whole.join(by_key(y), "node")
        out = keep(whole.select("node", F.array(*[F.col(f"y{c}") for c in range(dim)]).alias("vec")), name)
        drop(*[f"{name}-{lo}" for lo in parts if len(parts) > 1])
        return out

    def matrix(column) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)

    def products(x: DataFrame, right: str = "vec") -> np.ndarray:
        """The small matrix of products of the columns of ``vec`` and ``right``: tasks add up theirs, the sums meet per entry."""
        def run(batches):
            total = np.zeros((dim, dim))
            for b in batches:
                if b.num_rows:
                    total += matrix(b.column(0)).T @ matrix(b.column(b.num_columns - 1))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim * dim)), pa.array(total.ravel())], names=["i", "v"])

        out = np.zeros(dim * dim)
        for r in x.select("vec", *([right] if right != "vec" else [])).mapInArrow(run, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
            out[r["i"]] = r["v"]
        return out.reshape(dim, dim)

    def rotated(x: DataFrame, m: np.ndarray) -> DataFrame:
        """``vec`` times a small matrix."""
        def run(batches):
            for b in batches:
                v = np.ascontiguousarray(matrix(b.column(1)) @ m) if b.num_rows else np.zeros((0, dim))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(np.arange(0, v.size + 1, dim), pa.int32()), pa.array(v.ravel()))], names=["node", "vec"])

        return x.select("node", "vec").mapInArrow(run, f"node {kind}, vec array<double>")

    for k in range(rounds):
        y = times(factor, f"factor-{k}")
        if k:
            drop(f"factor-{k - 1}")
        value, vector = np.linalg.eigh(products(y))
        nonzero = value > 1e-12 * max(float(value.max()), 1e-300)
        factor = rotated(y, vector * np.where(nonzero, 1.0 / np.sqrt(np.where(nonzero, value, 1.0)), 0.0))
    last = keep(times(factor, "product").withColumnRenamed("vec", "vec2").join(by_key(factor), "node"), "last")
    drop("product", *([f"factor-{rounds - 1}"] if rounds else []))
    drop("information")
    inner = products(last, "vec2")
    value, vector = np.linalg.eigh((inner + inner.T) / 2)
    done = rotated(last.select("node", "vec"), vector * np.sqrt(np.maximum(value, 0.0)))
    return nodes.join(by_key(done), "node", "left").select(F.col("node").cast("string").alias("node"), F.coalesce("vec", F.array_repeat(F.lit(0.0), dim)).alias("vec"))
