"""Network influence scores: a damped stationary solve followed by one step of transport.

For a cell (score year, universe, treatment): the vector p solves
``p = d * H p + (d * dangling mass + 1 - d) * a`` where H is the
column-normalised citation matrix without self-citations and a the article
shares; one further step ``H p`` without teleport, scaled to 100, is the
network share, and share over article share is the score per article
(null where a journal has no articles, 0 where it is not cited).

Two ways to solve, with the same steps, the same stopping rule and equal results:

* every cell in one Arrow group (NumPy, no shuffle per step), for cells whose edges fit a worker:
  nodes are numbered in the JVM, an edge travels as two 32-bit numbers and a weight;
* a DataFrame loop for larger cells: one aggregation of the edges per step, each step written.

Both are closed against failure: a cell without article mass, without any
citation flow, or that does not settle within ``MAX_STEPS`` with a residual of at most
``RESIDUAL``, is an error and no score.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quillmesh.operators.graph import column_normalised
from quillmesh.sources.stages import durable

DAMPING = 0.85
STEP_TOLERANCE = 1e-14
RESIDUAL = 1e-12
MAX_STEPS = 10_000
#: Edges of a cell that one worker holds: 16 bytes each as they arrive, about four times that in the solve.
WORKER_EDGES = 20_000_000

CELL = ["score_year", "universe", "treatment"]
OUT = "score_year int, universe string, treatment string, issn_l string, share double, article_share double, per_article double, normalised double, defined boolean, n_steps int, residual double"


def input_faults(counts: DataFrame, edges: DataFrame, states: DataFrame) -> DataFrame:
    """(rule, n) of what makes scores meaningless: missing or repeated keys, negative counts, filtered above raw, an empty state."""
    count_rules = {"count without key": "issn_l IS NULL OR score_year IS NULL", "negative article count": "a_raw < 0 OR a_filtered < 0", "filtered articles above raw": "a_filtered > a_raw"}
    edge_rules = {"edge without key": "citing IS NULL OR cited IS NULL OR score_year IS NULL", "negative citation count": "n_raw < 0 OR n_filtered < 0", "filtered citations above raw": "n_filtered > n_raw"}

    def broken(rows: DataFrame, rules: dict[str, str]) -> DataFrame:
        one = rows.agg(*[F.count_if(F.coalesce(F.expr(v), F.lit(False))).alias(k) for k, v in rules.items()])
        return one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), F.col(k).alias("n")) for k in rules])).alias("x")).select("x.rule", "x.n")

    def repeated(rows: DataFrame, keys: list[str], rule: str) -> DataFrame:
        return rows.groupBy(*keys).agg(F.count("*").alias("c")).agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("n")).select(F.lit(rule).alias("rule"), "n")

    years = counts.select("score_year", F.explode(F.array(F.lit("n"), F.lit("oa"))).alias("universe")).distinct()
    empty = years.join(states.select("score_year", "universe").distinct(), ["score_year", "universe"], "left_anti").agg(F.count("*").alias("n")).select(F.lit("empty state").alias("rule"), "n")
    return (
        broken(counts, count_rules)
        .unionByName(broken(edges, edge_rules))
        .unionByName(repeated(counts, ["score_year", "issn_l"], "repeated count"))
        .unionByName(repeated(edges, ["score_year", "citing", "cited"], "repeated edge"))
        .unionByName(empty)
    )


def cells(states: DataFrame, edges: DataFrame, counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) in long form: nodes (cell, issn_l, articles), edges (cell, citing, cited, w > 0)."""
    both = lambda raw, filtered, name: F.explode(F.array(F.struct(F.lit("raw").alias("treatment"), F.coalesce(raw, F.lit(0)).cast("double").alias(name)), F.struct(F.lit("filtered").alias("treatment"), F.coalesce(filtered, F.lit(0)).cast("double").alias(name))))
    nodes = states.join(counts.select("score_year", "issn_l", "a_raw", "a_filtered"), ["score_year", "issn_l"], "left").select("score_year", "universe", "issn_l", both(F.col("a_raw"), F.col("a_filtered"), "articles").alias("x")).select("score_year", "universe", "x.treatment", "issn_l", "x.articles")
    weighted = edges.select("score_year", "universe", "citing", "cited", both(F.col("n_raw"), F.col("n_filtered"), "w").alias("x")).select("score_year", "universe", "x.treatment", "citing", "cited", "x.w").where("w > 0")
    return nodes, weighted


def solve_arrays(n: int, citing: np.ndarray, cited: np.ndarray, weight: np.ndarray, articles: np.ndarray) -> tuple[np.ndarray, np.ndarray, int, float]:
    """(share, article share, steps, residual) of one cell given node numbers; raises where there is no solution to publish."""
    total = articles.sum()
    if not np.isfinite(total) or total <= 0 or (articles < 0).any():
        raise ValueError("a cell has no article mass")
    out_weight = np.bincount(citing, weight, n)
    h = weight / out_weight[citing]
    dangling = out_weight == 0
    a = articles / total
    following = lambda p: DAMPING * np.bincount(cited, h * p[citing], n) + (DAMPING * p[dangling].sum() + 1 - DAMPING) * a
    p = a.copy()
    for steps in range(1, MAX_STEPS + 1):
        new = following(p)
        moved, p = np.abs(new - p).sum(), new
        if moved <= STEP_TOLERANCE:
            break
    residual = float(np.abs(following(p) - p).sum())
    if not residual <= RESIDUAL:
        raise ValueError(f"a cell did not settle: residual {residual:.3e} after {steps} steps")
    flow = np.bincount(cited, h * p[citing], n)
    if not flow.sum() > 0:
        raise ValueError("no citation flows in a cell")
    if abs(flow.sum() - (1 - p[dangling].sum())) > 1e-9:
        raise ValueError("the transported mass is not that of the citing nodes")
    return 100 * flow / flow.sum(), a, steps, residual


def solve_in_workers(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Scores of all cells, one cogroup per cell."""
    # A cell's nodes fit a worker here, so numbering them is one window per cell.
    numbered = durable(nodes.withColumn("at", F.row_number().over(W.partitionBy(*CELL).orderBy("issn_l")) - 1))
    end = lambda side: numbered.select(*CELL, F.col("issn_l").alias(side), F.col("at").alias(f"{side}_at"))
    # Own names on the edge side: nodes and edges often come from the same plan.
    arcs = edges.join(end("citing"), [*CELL, "citing"]).join(end("cited"), [*CELL, "cited"]).select(*[F.col(c).alias(f"e_{c}") for c in CELL], "citing_at", "cited_at", "w")

    def one(key: tuple, v: pd.DataFrame, e: pd.DataFrame) -> pd.DataFrame:
        v = v.sort_values("at").reset_index(drop=True)
        share, a, steps, residual = solve_arrays(len(v), e["citing_at"].to_numpy(), e["cited_at"].to_numpy(), e["w"].to_numpy(float), v["articles"].to_numpy(float))
        defined = v["articles"].to_numpy(float) > 0
        with np.errstate(divide="ignore", invalid="ignore"):
            per_article = np.where(defined, share / 100 / a, np.nan)
        frame = pd.DataFrame({"issn_l": v["issn_l"], "share": share, "article_share": a, "per_article": per_article, "normalised": share * len(v) / 100, "defined": defined})
        return frame.assign(score_year=key[0], universe=key[1], treatment=key[2], n_steps=steps, residual=residual)[[c.split()[0] for c in OUT.split(", ")]]

    solved = numbered.groupBy(*CELL).cogroup(arcs.groupBy(*[f"e_{c}" for c in CELL])).applyInPandas(one, OUT)
    return solved.withColumn("per_article", F.when(F.col("defined"), F.col("per_article")))


def solve_in_frames(nodes: DataFrame, edges: DataFrame, tolerance: float = STEP_TOLERANCE) -> DataFrame:
    """The same scores by a loop of aggregations; per step one row for each open cell reaches the driver.

    A cell keeps the vector of the step at which it settled, as in a worker, while others go on.
    """
    total = nodes.groupBy(*CELL).agg(F.sum("articles").alias("all_articles"), F.count("*").alias("n"))
    if not total.where("NOT coalesce(all_articles > 0, false)").isEmpty():
        raise ValueError("a cell has no article mass")
    h = durable(column_normalised(edges, CELL).select(*CELL, "citing", "cited", "h").repartition(*CELL, "citing"))
    senders = h.select(*CELL, F.col("citing").alias("issn_l"), F.lit(True).alias("sends")).distinct()
    shared = nodes.join(total, CELL).select(*CELL, "issn_l", "articles", "n", (F.col("articles") / F.col("all_articles")).alias("a"))
    base = durable(shared.join(senders, [*CELL, "issn_l"], "left").withColumn("dangling", F.col("sends").isNull()).drop("sends"))

    def flow(p: DataFrame) -> DataFrame:
        return h.join(p.select(*CELL, F.col("issn_l").alias("citing"), "p"), [*CELL, "citing"]).groupBy(*CELL, F.col("cited").alias("issn_l")).agg(F.sum(F.col("h") * F.col("p")).alias("flow"))

    def following(p: DataFrame) -> DataFrame:
        """p with ``q``, the vector one step on."""
        lost = p.groupBy(*CELL).agg(F.sum(F.when(F.col("dangling"), F.col("p")).otherwise(0.0)).alias("lost"))
        stepped = DAMPING * F.coalesce("flow", F.lit(0.0)) + (DAMPING * F.col("lost") + 1 - DAMPING) * F.col("a")
        return p.join(flow(p), [*CELL, "issn_l"], "left").join(lost, CELL).select(*p.columns, stepped.alias("q"), "flow")

    gap = lambda p: p.groupBy(*CELL).agg(F.sum(F.abs(F.col("q") - F.col("p"))).alias("gap"))
    p, steps, settled, n_cells = base.withColumns({"p": F.col("a"), "n_steps": F.lit(0)}), 0, set(), total.count()
    while steps < MAX_STEPS:
        steps += 1
        both = durable(following(p).drop("flow"))
        # Cells that have settled stay as they are; their number is that of years, universes and treatments.
        closed = {tuple(r[:3]) for r in gap(both).where(F.col("gap") <= tolerance).collect()}
        frozen = F.concat_ws("|", *[F.col(c).cast("string") for c in CELL]).isin([f"{y}|{u}|{t}" for y, u, t in settled]) if settled else F.lit(False)
        p = both.select(*[c for c in both.columns if c not in ("p", "q", "n_steps")], F.when(frozen, F.col("p")).otherwise(F.col("q")).alias("p"), F.when(frozen, F.col("n_steps")).otherwise(F.lit(steps)).alias("n_steps"))
        settled |= closed
        if len(settled) >= n_cells:
            break
    last = durable(following(p))
    residual = gap(last).withColumnRenamed("gap", "residual")
    if not residual.where(~(F.col("residual") <= max(RESIDUAL, 10 * tolerance))).isEmpty():
        raise ValueError(f"a cell did not settle within {steps} steps")
    scale = last.groupBy(*CELL).agg(F.sum("flow").alias("all_flow"))
    if not scale.where("NOT coalesce(all_flow > 0, false)").isEmpty():
        raise ValueError("no citation flows in a cell")
    share, defined = 100 * F.coalesce("flow", F.lit(0.0)) / F.col("all_flow"), F.col("articles") > 0
    out = last.join(scale, CELL).join(residual, CELL)
    return out.select(*CELL, "issn_l", share.alias("share"), F.col("a").alias("article_share"), F.when(defined, share / 100 / F.col("a")).alias("per_article"), (share * F.col("n") / 100).alias("normalised"), defined.alias("defined"), "n_steps", "residual")


def network_scores(nodes: DataFrame, edges: DataFrame, worker_edges: int = WORKER_EDGES) -> DataFrame:
    """Scores of all cells by the way that the largest cell allows."""
    largest = edges.groupBy(*CELL).count().agg(F.max("count")).first()[0] or 0
    return solve_in_workers(nodes, edges) if largest <= worker_edges else solve_in_frames(nodes, edges)


def isolated(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes of a cell that neither cite nor are cited inside it."""
    ends = edges.select(*CELL, F.explode(F.array("citing", "cited")).alias("issn_l")).distinct()
    return nodes.join(ends, [*CELL, "issn_l"], "left_anti")


def score_audit(scores: DataFrame, edges: DataFrame) -> DataFrame:
    """Per cell: nodes, edges, weight, sums that must hold, and a digest of the node set that needs no ordering and combines map-side."""
    state = scores.groupBy(*CELL).agg(
        F.count("*").alias("n_nodes"),
        F.round(F.sum("share"), 6).alias("share_sum"),
        F.round(F.sum(F.col("article_share") * F.coalesce("per_article", F.lit(0.0))), 6).alias("mean_per_article"),
        F.count_if(~F.col("defined")).alias("n_undefined"),
        F.round(F.max("residual"), 9).alias("residual"),
        F.bit_xor(F.conv(F.substring(F.md5("issn_l"), 1, 15), 16, 10).cast("long")).alias("state_digest"),
    )
    weight = edges.groupBy(*CELL).agg(F.count("*").alias("n_edges"), F.sum("w").cast("long").alias("edge_weight"))
    return state.join(weight, CELL, "left")


def closed_share(edges: DataFrame, inside: DataFrame, scores: DataFrame) -> DataFrame:
    """Per cell: how much of the outgoing citation weight stays inside the state, weighted by the network share of the citing journal.

    ``edges`` are all edges without self-citations in long form (cell, citing, w), ``inside`` those of the state.
    """
    full = edges.groupBy(*CELL, "citing").agg(F.sum("w").alias("full"))
    kept = inside.groupBy(*CELL, "citing").agg(F.sum("w").alias("kept"))
    mass = scores.select(*CELL, F.col("issn_l").alias("citing"), "share").join(full, [*CELL, "citing"]).join(kept, [*CELL, "citing"], "left")
    ratio = F.coalesce("kept", F.lit(0.0)) / F.col("full")
    return mass.groupBy(*CELL).agg((F.sum(F.col("share") * ratio) / F.sum("share")).alias("closed_share"), F.count("*").alias("n_citing"))
