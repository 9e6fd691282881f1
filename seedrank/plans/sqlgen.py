"""Builders for the DuckDB oracle SQL: the same definitions as the Spark operators, written
as plain SQL so the check is independent of Spark. Strings only; nothing here runs."""

from __future__ import annotations

from collections.abc import Sequence

from seedrank.plans.driver_views import ITEMS_SQL

# Fixed values, written out for the check (not taken from the operators).
ERA_PENALTY = {"decade": (10, 40.0), "recent": (20, 25.0), "tight": (15, 30.0), "standard": (25, 20.0)}
ADJ_EDGES = [-10, -5, 0, 5, 10, 20, 30, 40]
ADJ_LABELS = ["Bonus 5-10%", "Bonus 0-5%", "No adj.", "0-5%", "5-10%", "10-20%", "20-30%"]


def with_items(*ctes: str) -> str:
    """``WITH <items, seeds>, <ctes...>``."""
    parts = [ITEMS_SQL.strip()] + [c.strip() for c in ctes if c.strip()]
    return "WITH " + ",\n".join(parts) + "\n"


def release_year(c: str) -> str:
    t = f"trim({c})"
    return (f"CAST(coalesce(year(try_cast({t} AS DATE)), "
            f"CASE WHEN regexp_matches({t}, '^\\d{{4}}$') AND try_cast({t} AS INTEGER) BETWEEN 1900 AND 2030 "
            f"THEN try_cast({t} AS INTEGER) END, "
            f"try_cast(nullif(regexp_extract({t}, '\\b(19\\d{{2}}|20\\d{{2}})\\b', 1), '') AS INTEGER)) AS INTEGER)")


def clip(x: str, lo: str | None, hi: str | None) -> str:
    y = x
    if lo is not None:
        y = f"greatest({y}, {lo})"
    if hi is not None:
        y = f"least({y}, {hi})"
    return f"CASE WHEN ({x}) IS NULL THEN NULL ELSE {y} END"


def std1(s: str) -> str:
    return f"(CASE WHEN {s} IS NULL OR {s} = 0 THEN 1.0 ELSE {s} END)"


def sum_expr(terms: Sequence[str]) -> str:
    return " + ".join(terms)


def cosine(a: Sequence[str], b: Sequence[str], weights: Sequence[float] | None = None) -> str:
    weights = weights or [1.0] * len(a)

    def dot(x, y):
        return sum_expr([f"{p} * {q} * {w!r}" if w != 1.0 else f"{p} * {q}" for p, q, w in zip(x, y, weights)])

    na, nb = f"sqrt({dot(a, a)})", f"sqrt({dot(b, b)})"
    return f"(CASE WHEN {na} = 0 OR {nb} = 0 THEN 0.0 ELSE ({dot(a, b)}) / ({na} * {nb}) END)"


def items_with_year(name: str = "it") -> str:
    return f"{name} AS (SELECT *, {release_year('release_date')} AS release_year FROM items)"


def exclude_seen(src: str, seeds: str, out: str) -> str:
    k = "lower({t}.name) || '|' || lower({t}.owner)"
    return (f"{out} AS (SELECT * FROM {src} i WHERE NOT EXISTS (SELECT 1 FROM {seeds} s "
            f"WHERE s.set_id = i.set_id AND ({k.format(t='s')}) IS NOT DISTINCT FROM ({k.format(t='i')})))")


def cosine_score_ctes(cand: str, seeds: str, features: Sequence[str], out: str) -> list[str]:
    """M3 as CTEs ending in ``out`` = cand columns (features zero-filled) + cosine_similarity + cosine_score."""
    f0 = ", ".join(f"coalesce({f}, 0.0) AS {f}" for f in features)
    fl = ", ".join(features)
    zs = ", ".join(f"({f} - m_{f}) / {std1('s_' + f)} AS z_{f}" for f in features)
    ts = ", ".join(f"(c.{f} - m_{f}) / {std1('s_' + f)} AS t_{f}" for f in features)
    st = ", ".join(f"avg({f}) AS m_{f}, stddev_pop({f}) AS s_{f}" for f in features)
    cos = cosine([f"z_{f}" for f in features], [f"t_{f}" for f in features])
    return [
        f"{out}_c0 AS (SELECT * REPLACE ({f0}) FROM {cand})",
        f"{out}_s0 AS (SELECT set_id, {f0} FROM {seeds})",
        f"{out}_cen AS (SELECT set_id, {', '.join(f'avg({f}) AS {f}' for f in features)} FROM {out}_s0 GROUP BY set_id)",
        f"{out}_fit AS (SELECT set_id, {fl} FROM {out}_c0 UNION ALL SELECT set_id, {fl} FROM {out}_cen)",
        f"{out}_st AS (SELECT set_id, {st} FROM {out}_fit GROUP BY set_id)",
        f"{out}_t AS (SELECT c.set_id, {ts} FROM {out}_cen c JOIN {out}_st USING (set_id))",
        f"{out}_z AS (SELECT c.*, {zs} FROM {out}_c0 c JOIN {out}_st USING (set_id))",
        f"{out}_cs AS (SELECT z.* EXCLUDE ({', '.join('z_' + f for f in features)}), {cos} AS cosine_similarity "
        f"FROM {out}_z z JOIN {out}_t USING (set_id))",
        f"{out}_mm AS (SELECT set_id, min(cosine_similarity) AS lo, max(cosine_similarity) AS hi FROM {out}_cs GROUP BY set_id)",
        f"{out} AS (SELECT c.*, CASE WHEN hi > lo THEN (cosine_similarity - lo) / (hi - lo) * 100.0 ELSE 50.0 END "
        f"AS cosine_score FROM {out}_cs c JOIN {out}_mm USING (set_id))",
    ]


def era_params_ctes(seeds: str, out: str) -> list[str]:
    cls = (f"CASE WHEN avg_year >= 2019 THEN 'recent' WHEN focus_decade IS NOT NULL THEN 'decade' "
           f"WHEN std_year < 5 THEN 'tight' ELSE 'standard' END")
    md = "CASE era_class " + " ".join(f"WHEN '{k}' THEN {d}" for k, (d, p) in ERA_PENALTY.items()) + " END"
    mp = "CAST(CASE era_class " + " ".join(f"WHEN '{k}' THEN {p!r}" for k, (d, p) in ERA_PENALTY.items()) + " END AS DOUBLE)"
    return [
        f"{out}_ys AS (SELECT set_id, release_year AS y FROM {seeds} WHERE release_year IS NOT NULL)",
        f"{out}_b AS (SELECT set_id, CAST(trunc(avg(y)) AS INTEGER) AS avg_year, min(y) AS min_year, max(y) AS max_year, "
        f"stddev_samp(y) AS std_year, count(*) AS n_dated, max(y) - min(y) AS year_range FROM {out}_ys GROUP BY set_id)",
        f"{out}_d AS (SELECT set_id, CAST(floor(y / 10) * 10 AS INTEGER) AS decade, count(*) AS n FROM {out}_ys GROUP BY ALL)",
        f"{out}_f AS (SELECT d.set_id, d.decade AS focus_decade FROM {out}_d d JOIN {out}_b b USING (set_id) "
        f"WHERE d.n / b.n_dated >= 0.8)",
        f"{out}_c AS (SELECT b.*, f.focus_decade FROM {out}_b b LEFT JOIN {out}_f f USING (set_id))",
        f"{out}_k AS (SELECT *, {cls} AS era_class FROM {out}_c)",
        f"{out} AS (SELECT *, {md} AS max_dist, {mp} AS max_pen FROM {out}_k)",
    ]


def era_item_cols(y: str = "release_year", current_year: int = 2025) -> dict[str, str]:
    """Item-level era expressions over a row joined to era params (p.*)."""
    y0r, capr, y0m, capm = 2019, 15.0, 2022, 5.0
    dist = f"abs({y} - avg_year)"
    pen = clip(f"{dist} / max_dist * max_pen", "0.0", "max_pen")
    bonus = (f"coalesce(CASE WHEN era_class = 'recent' THEN (CASE WHEN {y} BETWEEN {y0r} AND {current_year} "
             f"THEN ({y} - {y0r}) / {float(current_year - y0r)!r} * {capr!r} END) ELSE (CASE WHEN {y} BETWEEN {y0m} "
             f"AND {current_year} THEN ({y} - {y0m}) / {float(current_year - y0m)!r} * {capm!r} END) END, 0.0)")
    adj = clip(f"({pen}) - ({bonus})", "-10.0", "max_pen")
    return {"year_distance": dist, "year_penalty": pen, "recency_bonus": bonus, "year_adjustment": adj}


def adj_bin(adj: str) -> tuple[str, str]:
    lab = "CASE " + " ".join(
        f"WHEN {adj} >= {ADJ_EDGES[i]} AND {adj} < {ADJ_EDGES[i + 1]} THEN '{ADJ_LABELS[i]}'"
        for i in range(len(ADJ_LABELS))) + " END"
    ordn = "CASE " + " ".join(
        f"WHEN {adj} >= {ADJ_EDGES[i]} AND {adj} < {ADJ_EDGES[i + 1]} THEN {i}"
        for i in range(len(ADJ_LABELS))) + " END"
    return f"CAST({ordn} AS INTEGER)", lab


def rounded(cols: Sequence[str], doubles: Sequence[str], places: int = 6) -> str:
    return ", ".join(f"round({c}, {places}) AS {c}" if c in doubles else c for c in cols)


SEEDS_CTE = "sd AS (SELECT * FROM it WHERE album = '1-URGENT' AND status = 'F')"


def base(*ctes: str) -> str:
    """items → it (with release_year) → sd (seeds) → cand (J3), then ``ctes``."""
    return with_items(items_with_year("it"), SEEDS_CTE, exclude_seen("it", "sd", "cand"), *ctes)


def extract_year_text(c: str) -> str:
    four = f"regexp_extract({c}, '\\b(\\d{{4}})\\b', 1)"
    run = f"regexp_extract({c}, '(\\d+)', 1)"
    return (f"CASE WHEN {c} IS NULL THEN NULL WHEN {four} <> '' THEN {four} "
            f"WHEN length({run}) >= 4 THEN substr({run}, 1, 4) ELSE {c} END")


def order_tags_cte(name: str = "otags") -> str:
    """(item_id, tags): the sorted distinct part-name words of an order's lines, ','-joined."""
    return (f"{name} AS (SELECT l.l_orderkey AS item_id, string_agg(DISTINCT w.word, ',' ORDER BY w.word) AS tags "
            f"FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey, "
            f"LATERAL (SELECT unnest(string_split(p.p_name, ' ')) AS word) w GROUP BY l.l_orderkey)")
