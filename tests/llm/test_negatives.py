"""Hard negatives against plain integer products."""

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from headway.llm.negatives import PRIMES, hard_negatives, primes_for, products, residues

SCHEMA = "vec_id bigint, embedding array<float>, label int"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def _plainly(rows, every=50):
    rows = [(i, v, y) for i, v, y in rows if i is not None and y is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    whole = [[int(np.floor(256 * float(np.float32(x)))) for x in v] for _, v, _ in rows]
    out = []
    for (anchor, _, label), q in zip(rows, whole):
        if anchor % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, p)), i, y) for (i, _, y), p in zip(rows, whole))
        for score, positive, _ in [s for s in scored if s[2] == label and s[1] != anchor][:5]:
            inside = [s for s in scored if s[2] != label and -50 * score <= -100 * s[0] <= -95 * score][:3]
            out.extend((anchor, positive, k + 1, i, -score, -s) for k, (s, i, _) in enumerate(inside))
    return sorted(out)


def _found(frame):
    assert frame.columns == COLUMNS and frame.schema["rank"].dataType.simpleString() == "int"
    return sorted(tuple(r) for r in frame.collect())


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 6), st.integers(1, 6), st.sampled_from([1, 3, 64, 1024, 1500, 2100]), st.sampled_from([9, 300, 1 << 14, 1 << 20]), st.integers(0, 99))
def test_residue_products_are_exact(n, m, width, largest, seed):
    rng = np.random.default_rng(seed)
    a, b = (rng.integers(-largest, largest + 1, (k, width)) for k in (n, m))
    a[0], b[0] = largest, -largest  # the largest there is
    primes = primes_for(float(width) * largest * largest)
    assert (products(residues(a.astype(float), primes), residues(b.astype(float), primes), primes) == a @ b.T).all()


def test_primes_cover_all_allowed_scores():
    assert primes_for(100.0) == PRIMES[:1] and len(primes_for(2.0 ** 56)) == 8
    with pytest.raises(ValueError):
        primes_for(2.0 ** 63)


@pytest.mark.parametrize("cell, anchors", [(1 << 22, 1 << 21), (400, 30)])
def test_small_table(llm, sf_dir, cell, anchors):
    rows = llm.read.parquet(f"{sf_dir}/embeddings.parquet")
    plain = [(r["vec_id"], r["embedding"], r["label"]) for r in rows.collect()]
    # Other cells, the same rows.
    assert _found(hard_negatives(rows, cell=cell * 64, anchor_cell=anchors * 64)) == _plainly(plain)


def test_ties_repeats_and_hot_vectors(llm):
    rng = np.random.default_rng(5)
    rows = [(i, [1.0, 0.5, 0.25], i % 3) for i in range(60)]  # one vector in a third of all rows
    rows += [(100 + i, [float(x) for x in rng.integers(-2, 3, 3)], i % 3) for i in range(120)]
    rows += [(150, [1.0, 0.5, 0.25], 0), (150, [1.0, 0.5, 0.25], 0), (150, [0.9, 0.5, 0.25], 1)]
    assert _found(hard_negatives(llm.createDataFrame(rows, SCHEMA).repartition(5), cell=90, anchor_cell=12)) == _plainly(rows)


def test_odd_rows(llm):
    rows = [
        (0, [1.0, 1.0], 1), (1, [1.0, 0.9], 1), (2, [0.7, 0.7], 2), (3, [0.5], 2), (4, [], 2), (50, [], 1), (None, [1.0, 1.0], 2), (6, None, 2),
        (7, [1.0, None], 2), (8, [1.0, float("nan")], 2), (9, [float("inf"), 1.0], 2), (10, [1.0, 1.0], None), (100, [0.8, 0.8, 0.0], 2), (11, [-1.0, -1.0], 1),
    ]
    odd = llm.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", rank int, anchor string")
    assert _found(hard_negatives(odd)) == _plainly(rows)
    assert _found(hard_negatives(odd.limit(0))) == []
    assert _found(hard_negatives(odd.where("vec_id % 50 != 0"))) == []


def test_large_components(llm):
    rows = [(0, [3e5, 2e4], 1), (1, [2.9e5, -1e3], 1), (2, [1.6e5, 7.0], 2), (3, [2.5e5, 9.5], 2)]
    assert _found(hard_negatives(llm.createDataFrame(rows, SCHEMA))) == _plainly(rows)
    with pytest.raises(ValueError):
        hard_negatives(llm.createDataFrame([(0, [1e30], 1), (1, [1e30], 1)], SCHEMA))
