"""No linked pair is missed, whatever the data's dimension."""

import numpy as np
import pytest


def _points(kind, rng, n=2500):
    if kind == "clusters":
        x = np.repeat(rng.normal(size=(5, 64)), n // 5, 0)
        return x + rng.normal(size=x.shape) * rng.choice([0.05, 0.15, 0.3], (len(x), 1))
    basis = np.linalg.qr(rng.normal(size=(64, kind)))[0]
    return rng.normal(size=(n, kind)) @ basis.T


@pytest.mark.parametrize("kind", [2, 3, 4, 8, "clusters"])
def test_every_link_found(spark, kind):
    from charloom.llm.pq import PqRules, embedding_components
    x = _points(kind, np.random.default_rng(1))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    cos = u @ u.T
    np.fill_diagonal(cos, 0)
    for rules in (PqRules(), PqRules(tile=40)):
        got = embedding_components(df, rules).toPandas().sort_values("vec_id").n_links.to_numpy()
        assert ((cos >= 0.95 + 1e-12).sum(1) <= got).all() and (got <= (cos >= 0.95 - 1e-12).sum(1)).all()
