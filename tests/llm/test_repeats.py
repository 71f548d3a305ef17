import numpy as np

from visitmap.llm.bwt_dedup import Grams, Shard, merge_shards
from visitmap.llm.repeats import bucket_bits, order_by
from visitmap.llm.textnum import anchor_runs


def test_messages_of_a_block_stay_few_as_the_input_grows(spark):
    sizes = spark.createDataFrame([(4 << 20,)], "size long")
    blocks = lambda n: sizes.crossJoin(spark.range(n))
    assert bucket_bits(blocks(1), 1 << 20) == 6
    assert bucket_bits(blocks(100), 1 << 20) == 9  # 400 MB
    assert bucket_bits(blocks(2_500), 1 << 20) == 9  # 10 GB: 512 buckets, not 16,384
    assert bucket_bits(blocks(50_000), 1 << 20) == 13  # 200 GB: a bucket's share stays under 32 MB


def test_anchors_fall_evenly_into_buckets():
    text = np.random.default_rng(3).integers(97, 123, 400_000).astype(np.uint8)
    runs = anchor_runs(text, np.array([0, len(text)]), 50, 20)
    share = np.bincount((runs.anchor >> np.uint64(58)).astype(np.int64), minlength=64) / len(runs) * 64
    assert 0.7 < share.min() and share.max() < 1.4


def test_order_by_equals_lexsort():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 500):
        for top in (2, 30, 1 << 40):
            a, b, c = (rng.integers(0, t, n).astype(np.uint64) for t in (top, 3, 4))
            assert (order_by(a, b, c) == np.lexsort((c, b, a))).all()


def test_merge_by_long_runs_equals_sorting_all_suffixes():
    rng = np.random.default_rng(6)
    for length, letters in ((1, 4), (7, 4), (50, 4), (13, 200), (7, 257)):
        texts = [rng.integers(1, letters, rng.integers(length, length + 20)).astype(np.uint16) for _ in range(30)]
        texts += [t.copy() for t in texts[::3]]
        closed = [np.append(t, 0).astype(np.uint16) for t in texts]
        text, sizes = np.concatenate(closed), np.array([len(c) for c in closed])
        grams = Grams(text, sizes, letters, length)
        assert sum(grams.steps(length)) == length
        if length == 50:
            assert len(grams.steps(length)) <= 13  # two symbols at a time: 25
        shards, place, begin = [], [], 0
        for part in (closed[:12], closed[12:13], closed[13:]):
            n = sum(map(len, part))
            shards.append(Shard(np.concatenate(part), np.array([len(c) for c in part]), length, letters, grams, begin))
            place.append(shards[-1].order + begin)
            begin += n
        z, group, _ = merge_shards(shards, length)
        at = np.empty(len(z), dtype=np.int64)
        at[np.argsort(z, kind="stable")] = np.concatenate(place)
        rotations = [tuple(np.resize(np.roll(c, -i), length)) for c in closed for i in range(len(c))]
        merged = [rotations[i] for i in at]
        assert merged == sorted(rotations)
        assert (np.diff(group) == [x != y for x, y in zip(merged[1:], merged[:-1])]).all()
