import numpy as np

from sievework.llm.tally import BLOCK, tally


def test_sums_of_tasks(spark):
    cells = 2 * BLOCK + 5

    def add(total, batch):
        np.add.at(total, batch.column(0).to_numpy() % cells, 1)

    df = spark.range(0, 60_000, 1, 70)
    assert (tally(df, cells, add) == np.bincount(np.arange(60_000) % cells)).all()
    assert tally(df.limit(0), 7, add).tolist() == [0] * 7
    assert tally(spark.range(3), 3, lambda total, b: total.__setitem__(0, total[0] + 0.5 * len(b)), "float64").tolist() == [1.5, 0, 0]
