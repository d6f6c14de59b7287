"""Neighbours in several features against all pairs in numpy."""

import numpy as np
import pandas as pd
import pytest

from tablewatch.operators.grid import knn_grid_scores
from tablewatch.params import Cols, Scale

COLS = Cols("sys", "t", "a", ("id",))


def plain(pdf, features, k, thresh=None):
    out = {}
    for _, g in pdf.dropna(subset=["sys"]).groupby("sys"):
        mean, std = g[features].mean(), g[features].std()
        z = ((g[features] - mean) / std.where(std > 0)).to_numpy(float)
        z[:, ~(std > 0).to_numpy()] = 0.0
        ok = np.isfinite(z).all(1)
        for i, row in enumerate(g["id"]):
            if not ok[i]:
                out[row] = None
                continue
            d = np.sqrt(((z - z[i]) ** 2).sum(1))
            d = np.sort(d[ok & (np.arange(len(d)) != i)])[:k]
            d = d if thresh is None else d[d < thresh]
            out[row] = float(d.mean()) if len(d) else None
    return out


def table(seed=5):
    r = np.random.default_rng(seed)
    dense = r.normal(0, 0.01, (700, 3)) + 3                        # a hot cell
    loose = r.uniform(-50, 50, (60, 3))
    far = np.array([[1e4, -1e4, 5.0], [1e4, -1e4, 5.0]])
    copies = np.tile([[1.0, 2.0, 3.0]], (300, 1))                  # a third of the rows alike
    a = np.concatenate([dense, loose, far, copies])
    frames = [pd.DataFrame(a, columns=list("abc")).assign(sys="hot")]
    frames.append(pd.DataFrame(r.integers(0, 4, (80, 3)).astype(float), columns=list("abc")).assign(sys="ties"))
    frames.append(pd.DataFrame([[1.0, 1.0, 1.0]], columns=list("abc")).assign(sys="alone"))
    frames.append(pd.DataFrame(np.full((9, 3), 2.0), columns=list("abc")).assign(sys="constant"))
    frames.append(pd.DataFrame(r.normal(0, 1, (4, 3)), columns=list("abc")).assign(sys="few"))
    frames.append(pd.DataFrame(r.normal(0, 1, (5, 3)), columns=list("abc")).assign(sys=None))
    pdf = pd.concat(frames, ignore_index=True)
    pdf["id"], pdf["t"] = range(len(pdf)), 0
    pdf.loc[pdf["sys"].eq("ties") & (pdf["id"] % 9 == 0), "b"] = None
    return pdf


@pytest.mark.parametrize("features,k,thresh,leaf", [(["a", "b"], 5, None, 16), (["a", "b", "c"], 3, 0.4, 4), (["c"], 7, None, 8)])
def test_neighbours_equal_all_pairs(spark, features, k, thresh, leaf):
    pdf = table()
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).to_dict("records"),
                               "a double, b double, c double, sys string, id long, t long")
    # A broadcast limit of nothing forces the shuffled plan throughout.
    scale = Scale() if thresh is None else Scale(broadcast_bytes=0)
    got = {r["id"]: r["knn_dist"] for r in knn_grid_scores(df, COLS, features, k, thresh, leaf=leaf, scale=scale).collect()}
    want = plain(pdf, features, k, thresh)
    assert got.keys() == want.keys()
    for i, w in want.items():
        assert (got[i] is None) == (w is None) and (w is None or abs(got[i] - w) < 1e-9), (i, got[i], w)


def test_empty_table_and_bad_features(spark):
    df = spark.createDataFrame([], "sys string, t long, a double, b double, id long")
    assert knn_grid_scores(df, COLS, ["a", "b"]).count() == 0
    for wrong in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            knn_grid_scores(df, COLS, wrong)


def test_kept_tables_have_about_a_row_per_point(spark, monkeypatch):
    """Neither pairs of points nor all cells in a point's reach are kept."""
    from tablewatch.operators import grid
    n = 6000
    r = np.random.default_rng(3)
    pdf = pd.DataFrame({"sys": "one", "t": 0, "a": r.uniform(0, 1, n), "b": r.uniform(0, 1, n), "id": range(n)})
    df = spark.createDataFrame(pdf.to_dict("records"), "sys string, t long, a double, b double, id long")
    kept = []

    def counted(keep):
        def run(*args):
            out = keep(*args)
            kept.append(out.count())
            return out
        return run

    for name in ("materialize", "_stored"):
        monkeypatch.setattr(grid, name, counted(getattr(grid, name, None)), raising=False)
    got = {x["id"]: x["knn_dist"] for x in grid.knn_grid(df, COLS, ["a", "b"], 5, 0.99).collect()}
    assert max(kept) <= 1.5 * n
    want = plain(pdf, ["a", "b"], 5)
    assert set(got) == set(sorted(want, key=want.get)[-len(got):]) and len(got) == 60
    assert all(abs(got[i] - want[i]) < 1e-9 for i in got)
