import numpy as np
import pytest

from chromaloom.llm import packing as p


def brute(sizes, capacity):
    """Sum of squares by trying every place."""
    gaps, out = [], []
    for size in sizes:
        best = None
        for place in [*range(len(gaps)), None]:
            after = list(gaps)
            if place is None:
                after.append(capacity - size)
            elif gaps[place] >= size:
                after[place] -= size
            else:
                continue
            count = np.bincount([g for g in after if g > 0], minlength=1)
            left = capacity - size if place is None else gaps[place] - size
            cost = (int((count.astype(int) ** 2).sum()), left)
            if best is None or cost < best[0]:
                best = (cost, place)
        place = best[1]
        if place is None:
            gaps.append(capacity - size)
            out.append(len(gaps) - 1)
        else:
            gaps[place] -= size
            out.append(place)
    return sorted(g for g in gaps)


@pytest.mark.parametrize("seed", range(6))
def test_gaps_are_those_of_brute_force(seed):
    r = np.random.default_rng(seed)
    capacity = int(r.integers(5, 40))
    sizes = r.integers(1, capacity + 1, 60)
    place = p.sum_of_squares(sizes, capacity)
    used = np.bincount(place, weights=sizes).astype(int)
    assert used.max() <= capacity and sorted((capacity - used).tolist()) == brute(sizes.tolist(), capacity)


def test_pieces():
    of, first, size, place = p.pack_shard(np.array([0, 5, 25, 10, 0, 20]), 10)
    assert of.tolist() == [0, 1, 2, 2, 2, 3, 4, 5, 5] and first.tolist() == [0, 0, 0, 10, 20, 0, 0, 0, 10] and size.tolist() == [0, 5, 10, 10, 5, 10, 0, 10, 10]
    used = np.bincount(place, weights=size)
    assert used.max() <= 10 and len(used) == 6  # 60 tokens in all, nothing left over


def test_whole_and_tight(spark):
    r = np.random.default_rng(4)
    sizes = np.minimum(r.lognormal(5, 1, 3000).astype(int), 9000)
    df = spark.createDataFrame([(i, int(s), "x") for i, s in enumerate(sizes)], "doc_id long, n_tokens long, shard string")
    out = p.pack(df, "doc_id", "n_tokens", [("a", 512), ("b", 2048)], shard_items=1000).toPandas()
    for kind, capacity in (("a", 512), ("b", 2048)):
        own = out[out.container_kind == kind]
        assert (own.groupby("doc_id").n_tokens.sum().reindex(range(3000)).to_numpy() == sizes).all()
        assert (own.groupby("doc_id").size() == np.maximum(1, -(-sizes // capacity))).all()
        used = own.groupby("container_id").n_tokens.sum()
        assert used.max() <= capacity and 1 - used.sum() / (len(used) * capacity) < 0.02
        cut = own.sort_values(["doc_id", "first_token"])
        assert (cut.first_token + cut.n_tokens).groupby(cut.doc_id).max().to_numpy().tolist() == sizes.tolist()


def test_edges(spark):
    df = spark.createDataFrame([(1, 0), (2, None), (None, 5), (3, 4), (3, 4)], "doc_id long, n_tokens long")
    out = p.pack(df, "doc_id", "n_tokens", [("a", 4), ("zero", 0)]).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in out) == [(1, 0), (2, 0), (3, 4), (3, 4)] and {r.container_kind for r in out} == {"a"}
    assert len({r.container_id for r in out if r.doc_id == 3}) == 2
    assert p.pack(df.limit(0), "doc_id", "n_tokens", [("a", 4)]).count() == 0 and p.pack(df, "doc_id", "n_tokens", []).count() == 0
