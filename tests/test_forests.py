"""Forests of many models: against trees grown row by row, across blocks, and whole runs with failing series."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.models import trees
from barloom.models.registry import ModelStore
from barloom.operators import evaluate
from barloom.plans import forests, strategies
from barloom.session import stage
from barloom.sources import bars as src, store as tables

CLASSES = 3


def data(models=("a", "b"), n=90, width=4, seed=5):
    rng = np.random.default_rng(seed)
    rows = []
    for m, model in enumerate(models):
        x = np.round(rng.normal(size=(n + 7 * m, width)), 1)
        y = (x[:, 0] + 0.5 * x[:, 1] ** 2 + rng.normal(size=len(x)) * 0.2 > 0.4).astype(int) + (x[:, 2] > 0.9)
        rows += [(model, f"r{i}", x[i].tolist(), int(y[i]), float(1 + i % 3), i % 3) for i in range(len(x))]
    return rows


FITS = [("a", "x", 1, 2, 4, 2, 5, "sqrt", [0, 1, 2, 3]), ("a", "y", None, 18, 2, 1, 2, "all", [0, 1]), ("b", "x", 0, 1, 5, 3, 8, "log2", [0, 1, 2, 3])]


def blocks_of(rows):
    """Rows of each model and block as they are packed."""
    return {(b["model"], b["block"]): b for b in (r.asDict() for r in rows.collect())}


def gini(weights):
    total = sum(weights)
    return total - sum(w * w for w in weights) / total if total else 0.0


def grow(rows, fit, tree, node, level, out):
    """The nodes below one node by a scan of its rows for each feature and each threshold. rows: (bins, label, weight, draws)."""
    model, name, fold, _, depth, min_leaf, min_split, subset, allowed = fit

    def weights(some):
        return [sum(w * d for _, y, w, d in some if y == c) for c in range(CLASSES)]

    def draws(some):
        return sum(d for *_, d in some)

    own = weights(rows)
    best = None
    if draws(rows) >= max(min_split, 2 * min_leaf) and level < depth and round(gini(own), 9) > 0:
        for f in trees.looked_at(trees.SEED, name, tree, node, allowed, subset).tolist():
            for b in range(trees.BINS - 1):
                left, right = [r for r in rows if r[0][f] <= b], [r for r in rows if r[0][f] > b]
                if draws(left) >= min_leaf and draws(right) >= min_leaf:
                    gain = round(gini(own) - gini(weights(left)) - gini(weights(right)), 9)
                    if gain > 0 and (best is None or gain > best[0]):
                        best = gain, f, b, left, right
    out[model, name, tree, node] = (best[1], best[2]) if best else (-1, 0), own
    if best:
        grow(best[3], fit, tree, 2 * node, level + 1, out)
        grow(best[4], fit, tree, 2 * node + 1, level + 1, out)


@pytest.mark.parametrize("block_rows", [1000, 25])
def test_all_trees_equal_trees_grown_row_by_row(spark, block_rows):
    rows = spark.createDataFrame(data(), trees.ROWS)
    blocks = trees.packed(rows, trees.bin_edges(rows), block_rows)
    packed = blocks_of(blocks)
    assert sum(b["n"] for b in packed.values()) == rows.count() and (len(packed) > 2) == (block_rows < 90)
    nodes = stage(trees.grown(blocks, spark.createDataFrame(FITS, trees.FIT), CLASSES), "nodes")
    found = {(n["model"], n["fit"], n["tree"], n["node"]): ((n["feature"], n["bin"]), n["value"]) for n in nodes.collect()}
    want = {}
    for fit in FITS:
        for tree in range(fit[3]):
            use = []
            for (model, number), b in packed.items():
                if model == fit[0]:
                    block = trees.Block.of(b)
                    draws = trees.bootstrap(trees.SEED, fit[1], tree, number, b["n"])
                    use += [(block.bins[i], block.labels[i], block.weights[i], draws[i]) for i in range(b["n"]) if draws[i] and block.folds[i] != fit[2]]
            grow(use, fit, tree, 1, 0, want)
    assert {k: v[0] for k, v in found.items()} == {k: v[0] for k, v in want.items()}
    assert all(found[k][1] == pytest.approx(want[k][1]) for k in want)

    # Scores: the mean of the trees' leaves, and with fits only what a fold left out.
    fits = spark.createDataFrame(FITS, trees.FIT)
    every, held = trees.scored(blocks, nodes, CLASSES).collect(), trees.scored(blocks, nodes, CLASSES, fits).collect()
    edges = {r["model"]: r["edges"] for r in trees.bin_edges(rows).collect()}
    plain = {(r[0], r[1]): r for r in data()}
    assert len(every) == 2 * 90 + 97
    assert {(r["fit"], r["fold"]) for r in held if r["model"] == "b"} == {("x", 0)}
    for r in every:
        _, _, x, label, _, fold = plain[r["model"], r["row_id"]]
        assert (r["label"], r["fold"]) == (label, fold)
        fit = next(f for f in FITS if f[:2] == (r["model"], r["fit"]))
        p = np.zeros(CLASSES)
        for tree in range(fit[3]):
            node = 1
            while (at := want[r["model"], r["fit"], tree, node])[0][0] >= 0:
                f, b = at[0]
                node = 2 * node + int(np.searchsorted(edges[r["model"]][f], x[f]) > b)
            p += np.array(at[1]) / sum(at[1])
        assert r["probability"] == pytest.approx((p / fit[3]).tolist())


def test_thresholds_are_the_edges_of_bins(spark):
    rows = spark.createDataFrame(data(("a",)), trees.ROWS)
    blocks = trees.packed(rows, trees.bin_edges(rows))
    nodes = trees.grown(blocks, spark.createDataFrame(FITS[:1], trees.FIT), CLASSES).where("feature >= 0").collect()
    edges = trees.bin_edges(rows).first()["edges"]
    assert nodes and all(n["threshold"] == edges[n["feature"]][n["bin"]] for n in nodes)


def test_folds_of_nothing_and_models_without_rows(spark):
    rows = spark.createDataFrame([r for r in data(("a",)) if r[5] == 1], trees.ROWS)
    blocks = trees.packed(rows, trees.bin_edges(rows))
    fits = spark.createDataFrame([("a", "none", 1, 2, 3, 1, 2, "all", [0]), ("c", "x", 0, 2, 3, 1, 2, "all", [0])], trees.FIT)
    nodes = trees.grown(blocks, fits, CLASSES)
    assert nodes.count() == 0 and trees.scored(blocks, nodes, CLASSES).count() == 0


SMALL = {"trees": (2, 4), "depth": (2, 4), "min_split": (2, 10), "min_leaf": (1, 4), "subset": ["sqrt", "log2"]}
RANGE = "2024-01-01|2030-01-01"


@pytest.fixture(scope="module")
def mixed(spark, bars):
    """Two ordinary series, one that moves once, one too short and one that does not move at all."""
    from barloom.session import Workspace

    few = bars.where("interval = '4h' and symbol in ('PERP_VIEW_USDC', 'PERP_CLICK_USDC')")
    one = bars.where("interval = '4h' and symbol = 'PERP_VIEW_USDC'")
    constant = {c: F.lit(5.0) for c in ("open", "high", "low", "close")}
    flat = one.withColumns({"symbol": F.lit("PERP_FLAT_USDC"), **constant})
    moves = one.withColumns({"symbol": F.lit("PERP_ONCE_USDC"), **constant}).withColumn(
        "close", F.when(F.col("start_timestamp") >= F.lit("2024-01-20").cast("timestamp"), 6.0).otherwise(5.0)
    )
    short = one.orderBy("start_timestamp").limit(9).withColumn("symbol", F.lit("PERP_SHORT_USDC"))
    whole = few.unionByName(flat).unionByName(moves).unionByName(short)
    return Workspace(spark, "test-bars-mixed", innermost=False).stage(whole, "mixed")


def test_run_trains_updates_and_reports_every_job(spark, mixed, scratch):
    store, metrics = ModelStore(spark, scratch.path("models")), scratch.path("metrics")
    names = "('Momentum Reversal', 'Volatility Breakout')"
    jobs = stage(strategies.job_list(src.series(mixed), strategies.strategy_table(spark)).where(f"strategy in {names}"), "jobs")
    first = forests.train_forests(mixed, jobs, store, metrics, RANGE, n_iter=5, folds=2, space=SMALL).collect()
    assert len(first) == 10
    status = {}
    for r in first:
        status.setdefault(r["symbol"].split("_")[1], {})[r["strategy"].split()[0]] = r["status"]
    assert status["VIEW"] == status["CLICK"] == {"Momentum": "ok", "Volatility": "ok"}
    assert status["ONCE"] == {"Momentum": "no complete rows", "Volatility": "a class with a single row cannot be balanced"}
    assert status["SHORT"] == {"Momentum": "no complete rows", "Volatility": "no complete rows"}
    trained = [r for r in first if r["status"] == "ok"]
    assert store.registered("forest").count() == len(trained) == tables.read_metrics(spark, metrics).count()
    before = {r["model"]: r["n"] for r in store.table("forests/nodes").groupBy("model").agg(F.count_distinct("fit", "tree").alias("n")).collect()}
    assert len(before) == len(trained) and set(before.values()) <= {2, 3}

    second = forests.train_forests(mixed, jobs, store, metrics, RANGE, n_iter=5, folds=2, space=SMALL, new_trees=2).collect()
    assert len([r for r in second if r["status"] == "ok"]) == len(trained)
    after = {r["model"]: r["n"] for r in store.table("forests/nodes").groupBy("model").agg(F.count_distinct("fit", "tree").alias("n")).collect()}
    assert after == {m: n + 2 for m, n in before.items()}
    assert {r["has"] for r in store.table("forests/fits").collect()} <= {4, 5}
    assert tables.read_metrics(spark, metrics).count() == 2 * len(trained)

    scored = forests.score_forests(mixed, jobs.where("symbol like 'PERP_VIEW%'"), store, RANGE).collect()
    assert scored and all(abs(sum(r["probability"]) - 1) < 1e-9 and r["prediction"] in (-1, 0, 1) for r in scored)


def test_search_takes_the_best_draw(spark):
    """A draw that can learn beats stumps of one random feature, and folds are scored by rows that they left out."""
    rows = stage(spark.createDataFrame(data(n=240), trees.ROWS), "rows")
    blocks = trees.packed(rows, trees.bin_edges(rows))
    good = {"trees": 8, "depth": 5, "min_leaf": 1, "min_split": 2, "subset": "all"}
    bad = {"trees": 1, "depth": 1, "min_leaf": 60, "min_split": 2, "subset": "log2"}
    models = spark.createDataFrame([("a", [0, 1, 2, 3]), ("b", [0, 1, 2, 3])], "model string, allowed array<int>")
    scores = forests.draw_scores(blocks, models, [bad, good], 3, trees.SEED)
    means = {(r["model"], r["draw"]): r["mean_score"] for r in evaluate.mean_score(scores, ["model", "draw"]).collect()}
    assert all(means[m, 1] > means[m, 0] for m in "ab")
    chosen = forests._chosen(blocks, models, [bad, good], 3, trees.SEED).collect()
    assert {(r["model"], r["trees"], r["depth"]) for r in chosen} == {("a", 8, 5), ("b", 8, 5)}
