import numpy as np
import pytest

from test_simhash import groups
from trackwise.llm import embeddings as em


@pytest.mark.parametrize("block,sample", [(2000, 4096), (30, 40)])
def test_against_brute_force(spark, block, sample):
    rng = np.random.default_rng(block)
    centres = rng.normal(size=(12, 8))
    rows = []
    for i in range(400):
        c = centres[rng.integers(12)] if i % 3 else rng.normal(size=8)
        rows.append((i, int(rng.integers(3)), (c * rng.uniform(0.5, 2) + rng.normal(size=8) * 0.06).tolist()))
    rows += [(400 + i, 1, rows[5][2]) for i in range(50)]              # copies
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(4)
    x = np.array([r[2] for r in rows])
    x /= np.linalg.norm(x, axis=1)[:, None]
    label = np.array([r[1] for r in rows])
    hit = (x @ x.T >= 0.98) & (label[:, None] == label)
    np.fill_diagonal(hit, False)
    want = groups(range(len(rows)), list(zip(*np.nonzero(hit))))
    got = em.near_duplicates(df, block=block, sample=sample).collect()
    assert {r["vec_id"]: r["n_links"] for r in got} == dict(enumerate(hit.sum(1).tolist()))
    assert {r["vec_id"]: r["component_id"] for r in got} == {k: int(v) for k, v in want.items()}
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
