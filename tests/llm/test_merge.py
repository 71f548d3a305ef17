import numpy as np

from visitmap.llm.bwt_dedup import Shard, merge_shards


def test_merged_order_equals_sorting_all_suffixes():
    rng = np.random.default_rng(4)
    for length in (1, 2, 5, 8):
        texts = [rng.integers(1, 4, rng.integers(length, 20)).astype(np.uint8) for _ in range(12)]
        shards, rotations, offset = [], [], []
        for part in (texts[:5], texts[5:6], texts[6:]):
            closed = [np.append(t, 0).astype(np.uint8) for t in part]
            shards.append(Shard(np.concatenate(closed), np.array([len(c) for c in closed]), length, 4))
            offset.append(len(rotations))
            for c in closed:
                rotations += [tuple(np.resize(np.roll(c, -i), length + len(c))[:length]) for i in range(len(c))]
        z, group, prefix = merge_shards(shards, length)
        at = np.empty(len(z), dtype=np.int64)
        at[np.argsort(z, kind="stable")] = np.concatenate([s.order + o for s, o in zip(shards, offset)])
        merged = [rotations[i] for i in at]
        assert merged == sorted(rotations)
        for i in range(1, len(merged)):
            same = next((k for k in range(length) if merged[i][k] != merged[i - 1][k]), length)
            assert (group[i] == group[i - 1]) == (same == length)
            assert prefix[i] == same or prefix[i] == same - same % 2
