"""Joins that match, enrich and exclude.

All are equi-joins on ``set_id`` plus a text key. The seed side is the small one; it is
not hinted: Catalyst/AQE broadcast it when its measured size is under the threshold and
otherwise shuffle on the key (AQE skew-join splits a hot set)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seedrank.functions.params import bounded_broadcast, materialize
from seedrank.operators.dedup import keep_first, track_key


def match_rate(seeds: DataFrame, items: DataFrame, name: str, owner: str, key: str = "set_id") -> DataFrame:
    """Per set, how many seed rows exist among the items by lower(name)|lower(owner)
    (not trimmed)."""
    s = seeds.select(key, track_key(name, owner, trim=False).alias("__k"))
    i = items.select(F.col(key).alias("__s"), track_key(name, owner, trim=False).alias("__ik")).distinct()
    hit = s.join(i, (s[key] == i["__s"]) & (s["__k"] == i["__ik"]), "left_semi")
    tot = s.groupBy(key).agg(F.count(F.lit(1)).alias("seed_rows"))
    got = hit.groupBy(key).agg(F.count(F.lit(1)).alias("matched"))
    return tot.join(got, key, "left").select(key, "seed_rows", F.coalesce("matched", F.lit(0)).alias("matched"))


def enrich_from_items(seeds: DataFrame, items: DataFrame, name: str, owner: str, tags: str | None,
                      vec: str | None, order_by: Sequence[str], key: str = "set_id") -> DataFrame:
    """For each seed row, the *first* item with the same lower(name)|lower(owner) fills
    the seed's tags only when missing, and overrides its vector when the item has one."""
    k = track_key(name, owner, trim=False)
    cols = [c for c in (tags, vec) if c]
    cat = items.select(key, k.alias("__k"), *order_by, *[F.col(c).alias(f"__cat_{c}") for c in cols])
    first = keep_first(cat, [key, "__k"], order_by).drop(*order_by)
    s = seeds.withColumn("__k", k)
    j = s.join(first, [key, "__k"], "left")
    out = []
    for c in seeds.columns:
        if c == tags:
            out.append(F.coalesce(F.col(c), F.col(f"__cat_{c}")).alias(c))
        elif c == vec:
            out.append(F.coalesce(F.col(f"__cat_{c}"), F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def exclude_seen(items: DataFrame, seeds: DataFrame, name: str, owner: str, key: str = "set_id") -> DataFrame:
    """Drop items whose set already holds the same lower(name)|lower(owner); the key
    comparison is null-safe (a NULL seed key removes NULL-key items, as ``isin`` does)."""
    s = _seed_keys(seeds, name, owner, key)
    cond = (items[key] == s["__s"]) & track_key(name, owner, trim=False).eqNullSafe(s["__k"])
    return items.join(s, cond, "left_anti")


def mark_seen(items: DataFrame, seeds: DataFrame, name: str, owner: str, key: str = "set_id", out: str = "seen") -> DataFrame:
    """J3 as a column: ``out`` is true for the rows that ``exclude_seen`` drops, so one table holds both."""
    s = _seed_keys(seeds, name, owner, key).withColumn("__hit", F.lit(True))
    cond = (items[key] == s["__s"]) & track_key(name, owner, trim=False).eqNullSafe(s["__k"])
    return items.join(s, cond, "left").select(*[items[c] for c in items.columns], F.col("__hit").isNotNull().alias(out))


def _seed_keys(seeds: DataFrame, name: str, owner: str, key: str) -> DataFrame:
    return seeds.select(F.col(key).alias("__s"), track_key(name, owner, trim=False).alias("__k")).distinct()


def fill_tags_by_owner(targets: DataFrame, catalogue: DataFrame, owner: str, tags: str, top: int = 3) -> DataFrame:
    """For target rows with no tags, the ``top`` most frequent lower-cased tags among
    catalogue rows whose owner equals the target's owner case-insensitively; if none and the
    owner has a ',', retry with the part before the first ','. Ties: count desc, tag asc.

    (owner, tag) counts are a partially-aggregated group-by; the per-owner top 3 is a
    literal-capped row_number (group limit before the shuffle)."""
    has = catalogue.where(F.col(tags).isNotNull() & (F.trim(F.col(tags)) != ""))
    ex = has.select(F.lower(F.col(owner)).alias("__o"), F.explode(F.split(F.col(tags), ",")).alias("__t"))
    ex = ex.select("__o", F.lower(F.trim("__t")).alias("__t")).where(F.col("__t") != "")
    cnt = ex.groupBy("__o", "__t").agg(F.count(F.lit(1)).alias("__n"))
    w = Window.partitionBy("__o").orderBy(F.col("__n").desc(), F.col("__t").asc())
    best = cnt.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= top)
    filled = best.groupBy("__o").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__r", "__t"))), lambda x: x["__t"]), ", ").alias("__fill"))
    missing = F.col(tags).isNull() | (F.col(tags) == "")
    t = targets.withColumn("__full", F.when(missing, F.lower(F.col(owner))))
    t = t.withColumn("__prim", F.when(missing & F.col(owner).contains(","),
                                      F.lower(F.trim(F.split(F.col(owner), ",").getItem(0)))))
    f1 = filled.select(F.col("__o").alias("__o1"), F.col("__fill").alias("__f1"))
    f2 = filled.select(F.col("__o").alias("__o2"), F.col("__fill").alias("__f2"))
    j = t.join(f1, t["__full"] == f1["__o1"], "left").join(f2, t["__prim"] == f2["__o2"], "left")
    val = F.when(missing, F.coalesce(F.col("__f1"), F.col("__f2"), F.col(tags))).otherwise(F.col(tags))
    return j.select(*[val.alias(c) if c == tags else F.col(c) for c in targets.columns])


def fill_tags(targets: DataFrame, catalogue: DataFrame, owner: str, tags: str, name: str | None = None,
              reference: DataFrame | None = None, top: int = 3) -> DataFrame:
    """J4 with its first step: rows without tags take those of the same track (name and owner in any case)
    in ``reference`` (columns ``name``, ``owner``, ``tags``; the smallest text of a track listed more than
    once), the rest as ``fill_tags_by_owner``."""
    if reference is not None and name is not None:
        known = reference.where(F.trim(F.col(tags)) != "").groupBy(track_key(name, owner).alias("__k")).agg(F.min(tags).alias("__ref"))
        missing = F.col(tags).isNull() | (F.col(tags) == "")
        t = targets.withColumn("__t", F.when(missing, track_key(name, owner)))
        j = t.join(known, F.col("__t") == F.col("__k"), "left")
        targets = j.select(*[F.coalesce(F.col("__ref"), F.col(tags)).alias(c) if c == tags else F.col(c) for c in targets.columns])
    return fill_tags_by_owner(targets, catalogue, owner, tags, top)


def lookup_vectors(rows: DataFrame, id_cols: Sequence[str], tags: str, lookup: DataFrame, dim: int,
                   key_col: str = "tag", vec_col: str = "vec", out: str = "vec") -> DataFrame:
    """J5 + V3: explode each row's tag list, try the tag, the tag with blanks→dashes and with
    dashes→blanks (first found wins), and mean-pool the vectors found; rows with none get
    ``dim`` zeros. ``tags`` must be an array column (V2)."""
    ex = rows.select(*id_cols, F.posexplode(tags).alias("__pos", "__tag"))
    pooled = lookup_vector_pairs(ex, id_cols, "__pos", "__tag", lookup, dim, key_col, vec_col, out="__pooled")
    j = rows.join(pooled, list(id_cols), "left")
    zeros = F.array_repeat(F.lit(0.0), dim)
    return j.select(*[c for c in rows.columns if c != out], F.coalesce(F.col("__pooled"), zeros).alias(out))


def lookup_vector_pairs(pairs: DataFrame, id_cols: Sequence[str], pos: str, tag: str, lookup: DataFrame, dim: int,
                        key_col: str = "tag", vec_col: str = "vec", out: str = "vec") -> DataFrame:
    """J5 + V3 over already exploded (ids..., pos, tag) rows: every distinct tag string is
    resolved once to the vector of its first key variant found in the lookup (a
    vocabulary-sized job), then occurrences join their tag's vector and are averaged per id (a
    repeated tag counts twice; ids without any hit are absent)."""
    del pos  # occurrences need no position: each row is one occurrence
    tags = pairs.select(F.col(tag).alias("__tag")).distinct()
    variants = F.array(
        F.struct(F.lit(0).alias("r"), F.col("__tag").alias("v")),
        F.struct(F.lit(1).alias("r"), F.regexp_replace("__tag", " ", "-").alias("v")),
        F.struct(F.lit(2).alias("r"), F.regexp_replace("__tag", "-", " ").alias("v")))
    ex = tags.select("__tag", F.explode(variants).alias("__var")).select("__tag", "__var.r", "__var.v")
    lk = lookup.select(F.col(key_col).alias("v"), F.col(vec_col).alias("__vec"))
    resolved = keep_first(ex.join(lk, "v").select("__tag", "r", "__vec"), ["__tag"], ["r"]).drop("r")
    # one row per resolved tag (≤ 3 per lookup key), numbered. Occurrences meet the numbers in a size-checked broadcast, so they
    # are never shuffled by tag (a hot tag would land in one task), and an id's are brought together as numbers, not as texts or as
    # half-pooled vectors of 8 bytes a dimension
    resolved = materialize(resolved.withColumn("__ref", F.monotonically_increasing_id()), "resolved")
    from seedrank.operators.vectors import mean_pool, pooled_rows, shared_vectors
    nested = any(k.startswith(("array", "struct", "map", "variant")) for k in (dict(pairs.dtypes)[c] for c in id_cols))
    shared = None if nested else shared_vectors(resolved, "__ref", "__vec", dim)
    if shared is None:
        occ = pairs.select(*id_cols, F.col(tag).alias("__tag")).repartition(*id_cols).join(bounded_broadcast(resolved.drop("__ref")), "__tag")
        return mean_pool(occ, id_cols, "__vec", dim, out=out)
    occ = pairs.select(*id_cols, F.col(tag).alias("__tag")).join(bounded_broadcast(resolved.select("__tag", "__ref")), "__tag")
    return pooled_rows(occ.select(*id_cols, "__ref").repartition(*id_cols), id_cols, "__ref", shared, out)
