"""Principal components against the singular vectors of the centred rows."""

from __future__ import annotations

import numpy as np

from topicloom.operators.reduction import reduce_dims


def test_variance_and_signs(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=(200, 6)) * [5, 3, 1, 1, 0.5, 0.1] + [1, 0, 2, 0, 0, 0]
    df = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)],
                               "id bigint, v array<double>").repartition(4)
    got = reduce_dims(df, "v", 3)
    assert got.columns == ["id", "v", "reduced"]
    x = np.array([r.reduced for r in sorted(got.collect(), key=lambda r: r.id)])
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    _, s, axes = np.linalg.svd(unit - unit.mean(0), full_matrices=False)
    axes = axes[:3] * np.sign(axes[:3][np.arange(3), np.abs(axes[:3]).argmax(1)])[:, None]
    assert np.abs(x - unit @ axes.T).max() < 1e-8
    assert np.allclose(x.var(0), s[:3] ** 2 / 200)
