"""What the tree fits keep and deal out: joint codes, small state in the workers, the joined rows once."""

import numpy as np

from riskloom.operators import boosting as B
from riskloom.operators import histograms as H
from riskloom.plans import modeling

from tests.conftest import SF_SMALL


def bins(n, seed=4):
    rng = np.random.default_rng(seed)
    onehot = np.column_stack([1 + np.eye(k, dtype=int)[rng.integers(0, k, n)] for k in (25, 5, 3)])
    return np.column_stack([onehot, rng.integers(0, 256, n), rng.integers(1, 10, n), rng.integers(1, 60, n)]).astype(np.uint8)


def test_joint_codes_give_the_sums_of_every_column():
    x = bins(3000)
    cuts = [np.zeros(1)] * 33 + [np.zeros(254)] + [np.zeros(9), np.zeros(59)]
    offsets, columns = H.offsets_of(cuts), H.Columns(x)
    assert columns.at.shape[1] <= 5 and columns.at.dtype == np.uint16  # 36 columns
    rng = np.random.default_rng(1)
    rows = np.flatnonzero(rng.random(len(x)) < 0.7)
    slot, w = rng.integers(0, 3, len(rows)), rng.integers(-(1 << 24), 1 << 24, len(rows)).astype(float)
    got = columns.sums(rows, slot, 3, [w, None], int(offsets[-1]), columns.by_bin(offsets))
    for f in range(x.shape[1]):
        assert (columns.above(f, 1) == (x[:, f] > 1)).all() and (columns.above(f, 5, rows) == (x[rows, f] > 5)).all()
        want = np.zeros((3, 2, len(cuts[f]) + 2))
        np.add.at(want, (slot, 0, x[rows, f]), w)
        np.add.at(want, (slot, 1, x[rows, f]), 1)
        assert (got[:, :, offsets[f] : offsets[f + 1]] == want).all()


def test_a_worker_keeps_18_bytes_a_row_between_visits():
    x, y = bins(2000), np.random.default_rng(2).integers(0, 2, 2000).astype(np.uint8)
    offsets = H.offsets_of([np.zeros(254)] * x.shape[1])
    older = type("Sent", (), {"value": []})
    block = (b"name", H.Columns(x), y, None)
    first = list(B._visit("fit", offsets, 0.1, older, [], [], [0], [block]))[0]
    left = list(B._visit("fit", offsets, 0.1, older, [], [(0, 33, 99, 1)], [1], [block]))[0]
    assert first[0, : offsets[1], 2].sum() == 2000 and left[0, : offsets[1], 2].sum() == (x[:, 33] <= 99).sum()
    kept = [v for v in vars(B._SCORES[b"name"]).values() if isinstance(v, np.ndarray) and v is not offsets]
    assert B._SCORES[b"name"].columns is None and sum(v.nbytes for v in kept) <= 18 * 2000


def test_the_models_read_rows_that_are_joined_once(spark):
    design = modeling.bureau_design(modeling.bureau_rows(spark, SF_SMALL))
    files = {f.rsplit("/", 2)[-2] for f in design.inputFiles()}
    assert len(files) == 1 and files.pop().startswith("bureau-")


def test_blocks_are_dealt_as_binned_rows_over_few_tasks(spark):
    """Not the features as doubles, and not a task for every few blocks."""
    n, cores = 20_000, spark.sparkContext.defaultParallelism
    df = spark.range(n).selectExpr("array(cast(id % 7 as double), cast(id % 300 as double)) as x", "cast(id % 2 as int) as y")
    blocks = H.kept_blocks(df, [np.arange(6) + 0.5, np.arange(10) * 30.0], n)
    try:
        got = blocks.map(lambda b: (len(b[1]), b[1].at.shape[1], int(b[2].sum()))).collect()
        assert sum(g[0] for g in got) == n and sum(g[2] for g in got) == n // 2 and {g[1] for g in got} == {1}
        assert blocks.getNumPartitions() <= cores
    finally:
        blocks.unpersist()
