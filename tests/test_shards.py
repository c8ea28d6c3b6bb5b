"""Matrices in shards by rows: read back, by ranges of rows, empty shards, repeated cells; dense numbers of names."""

import random

import numpy as np
import pytest

from locuslake.operators import counts
from locuslake.sources import readers, writers


def test_shards_read_back(spark, tmp_path):
    rng, path = random.Random(0), str(tmp_path / "m")
    rows = [(rng.choice([*range(0, 30), *range(60, 95)]), rng.randrange(12), rng.choice([0, 1, 2, -2, 7])) for _ in range(400)] + [(None, 1, 1), (1, None, 1), (1, 1, None)]
    x = spark.createDataFrame(rows, "row_id long, col_id long, value long")
    made = writers.csr(x, 100, 12, path, 10).collect()
    want = {}
    for r, c, v in rows:
        if None not in (r, c, v):
            want[r, c] = want.get((r, c), 0) + v
    want = sorted((*k, float(v)) for k, v in want.items() if v)
    assert len(made) == 10 and sum(m["cells"] for m in made) == len(want) and sum(m["rows"] for m in made) == 100 and [m["cells"] for m in made if m["shard"] in (3, 4, 5)] == [0, 0, 0]
    assert sorted(map(tuple, readers.csr(spark, path).collect())) == want
    assert sorted(map(tuple, readers.csr(spark, path, 25, 63).collect())) == [w for w in want if 25 <= w[0] < 63]
    assert readers.csr(spark, path, 30, 60).count() == 0
    for m in made:  # each archive is a whole matrix by rows
        a = np.load(f"{path}/{m['name']}")
        assert a["indptr"][-1] == len(a["data"]) == m["cells"] and len(a["indptr"]) == m["rows"] + 1 and tuple(a["shape"]) == (m["rows"], 12)
    with pytest.raises(ValueError, match="outside"):
        writers.csr(x, 50, 12, str(tmp_path / "n"), 10)
    writers.csr(x.where("false"), 0, 0, str(tmp_path / "e"), 10)
    assert readers.csr(spark, str(tmp_path / "e")).count() == 0


def test_names_are_numbered_in_order(spark):
    names = [f"n{random.Random(k).randrange(500)}" for k in range(900)]
    got = {r["x"]: r["i"] for r in counts.dense_ids(spark.createDataFrame([(n,) for n in names + [None]], "x string"), "x", "i", 7).collect()}
    assert got == {n: k for k, n in enumerate(sorted(set(names)))}
