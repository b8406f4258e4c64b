import numpy as np
import pytest

from trajspark.operators import stats as s

STATE = {"observation.state": {"dtype": "float64", "shape": [2], "names": ["x", "y"]}}


def histogram_quantile(x, q):
    edges = np.linspace(min(x) - 1e-10, max(x) + 1e-10, 5001)
    hist, _ = np.histogram(x, bins=edges)
    cum = np.cumsum(hist)
    i = np.searchsorted(cum, q * len(x))
    if i == 0:
        return edges[0]
    before = cum[i - 1]
    return edges[i] + (q * len(x) - before) / hist[i] * (edges[i + 1] - edges[i])


def test_episode_stats_match_numpy(frames, rows, lengths, blocks):
    got = {(r.episode_index, r.dim): r for r in s.episode_stats(frames, STATE).collect()}
    assert len(got) == 2 * len(lengths)
    for (e, d), r in got.items():
        x = np.array([q[5][d] for q in rows if q[0] == e])
        assert (r["min"], r["max"], r["count"]) == (x.min(), x.max(), len(x))
        assert r["mean"] == pytest.approx(x.mean()) and r["std"] == pytest.approx(x.std() if len(x) > 1 else 0, abs=1e-9)
        for q, name in zip(s.QUANTILES, ("q01", "q10", "q50", "q90", "q99")):
            want = histogram_quantile(x, q) if len(x) > 1 else x[0]
            assert r[name] == pytest.approx(want, abs=1e-9)
        assert r.q01 <= r.q10 <= r.q50 <= r.q90 <= r.q99


def test_combine_known_answer(spark):
    parts = spark.createDataFrame([("a", 0, 1.0, 10.0, 5.0, 2.0, 1), ("a", 0, 2.0, 12.0, 6.0, 2.5, 1)], "feature string, dim int, min double, max double, mean double, std double, count long")
    r = s.combine_stats(parts).first()
    assert (r["min"], r["max"], r["count"]) == (1.0, 12.0, 2)
    assert r["mean"] == pytest.approx(5.5) and r["std"] == pytest.approx(2.318405, abs=1e-6)


def test_combine_drops_a_quantile_some_part_lacks(spark):
    rows = [("a", 0, 0.0, 1.0, 0.5, 0.1, 2, 0.4, 0.9), ("a", 0, 0.0, 1.0, 0.5, 0.1, 6, 0.8, None)]
    parts = spark.createDataFrame(rows, "feature string, dim int, min double, max double, mean double, std double, count long, q50 double, q90 double")
    r = s.combine_stats(parts).first()
    assert r["q50"] == pytest.approx(0.7) and r["q90"] is None


@pytest.mark.parametrize("n,k", [(1, 1), (50, 50), (100, 100), (1000, 177), (5000, 594), (20000, 1681)])
def test_sample_size(spark, n, k):
    from pyspark.sql import functions as F

    row = spark.range(1).select(s.sample_size(F.lit(n)).alias("k"), s.sample_indices(F.lit(n)).alias("i")).first()
    assert row.k == k
    assert row.i == np.round(np.linspace(0, n - 1, k)).astype(int).tolist()


def test_axis_errors(frames):
    with pytest.raises(ValueError):
        s.stats_by_axis(frames, STATE, 5)


def test_image_stats_strided(spark):
    pixels = np.random.default_rng(1).integers(0, 256, size=(3, 3, 320, 2))
    df = spark.createDataFrame([(i, p.reshape(-1).tolist()) for i, p in enumerate(pixels)], "index long, pixels array<int>")
    got = {r.dim: r for r in s.image_stats(df, "pixels", 3, 320, 2).collect()}
    seen = pixels[:, :, ::2, ::2]
    for d in range(3):
        assert got[d]["mean"] == pytest.approx(seen[:, d].mean() / 255)
        assert got[d]["std"] == pytest.approx(seen[:, d].std() / 255) and got[d]["count"] == 3


def test_running_stats_merge_equals_one_pass(spark, frames):
    from pyspark.sql import functions as F

    from trajspark.streaming.ops import merge_bins

    values = frames.select("episode_index", F.posexplode("`observation.state`").alias("slot", "value"))
    bins = spark.createDataFrame([], "slot int, bin int, n bigint, s1 double, s2 double, lo double, hi double")
    for e in range(5):
        bins = merge_bins(bins, values.filter(F.col("episode_index") == e).select("slot", "value"))
    merged = {r.slot: r for r in s.stats_from_bins(bins, ["slot"]).collect()}
    whole = {r.dim: r for r in s.dataset_quantiles(frames, STATE).collect()}
    for d in range(2):
        for name in ("min", "max", "mean", "std", "count"):
            assert merged[d][name] == pytest.approx(whole[d][name])
        for name in ("q10", "q50", "q90"):
            assert merged[d][name] == pytest.approx(whole[d][name], abs=0.01)


def test_counted_percentiles(spark, blocks):
    """Many equal values, negative zero, one value only, nulls; groups above the hot limit and below."""
    rng = np.random.default_rng(5)
    rows = [(k, float(v)) for k, n, top in ((0, 300, 4), (1, 40, 40), (2, 1, 3), (3, 11, 2)) for v in rng.integers(-2, top, n)]
    table = spark.createDataFrame([*rows, (0, None), (4, None)], "k int, v double")
    got = {r.k: (r.q10, r.q50, r.q90) for r in s.counted_percentiles(table, "v", (0.1, 0.5, 0.9), ["k"]).collect()}
    want = {k: tuple(np.quantile([v for i, v in rows if i == k], (0.1, 0.5, 0.9))) for k in range(4)}
    assert got.keys() == want.keys()
    for k in want:
        assert got[k] == pytest.approx(want[k]), k


def test_normalisation_queries_number_the_lines_once(spark, monkeypatch):
    """The statistics come from the frames that are normalised, whose numbering is most of the work."""
    from tests.conftest import SF
    from trajspark.plans import function_queries as q

    calls, real = [], q.frames_lineitem
    monkeypatch.setattr(q, "frames_lineitem", lambda *args: calls.append(1) or real(*args))
    for query in (q.n1, q.n4, q.n5, q.tokenizer_windows):
        calls.clear()
        query(spark, SF)
        assert len(calls) == 1


def test_short_episodes_equal_the_bins_of_long_ones(spark, monkeypatch):
    """Episodes worked out as one row give what ranges and bins give: ties, nulls, NaN, infinities, single and null rows."""
    nan, inf = float("nan"), float("inf")
    rng = np.random.default_rng(3)
    episodes = [rng.normal(size=(37, 2)).tolist(), [[1.0, 2.0]], [[None, 1.0], [3.0, None], [3.0, 3.0]], [[None, 5.0], [None, 5.0]]]
    episodes += [[[nan, 1.0], [2.0, inf], [0.5, -1.0]], [[-inf, 1e9], [1.0, 1e9], [2.0, 1e9 + 1]], rng.integers(0, 4, (20, 2)).astype(float).tolist()]
    rows = [(e, f, x) for e, xs in enumerate(episodes) for f, x in enumerate(xs)] + [(7, 0, None), (None, 0, [1.0, 1.0])]
    frames = spark.createDataFrame(rows, "episode_index long, frame_index long, `observation.state` array<double>")

    def got():
        return sorted(tuple("nan" if x != x else x if isinstance(x, str) else round(x, 9) for x in r) for r in s.episode_stats(frames, STATE).collect())

    short = got()
    monkeypatch.setattr(s, "TILE_NUMBERS", 1)
    assert short == got()


def test_sampled_frames_lists_no_positions(spark, blocks):
    lengths = [0, 1, 5, 100, 101, 130, 1000, 2345]
    rows = [(e, f) for e, n in enumerate(lengths) for f in range(n)]
    frames = spark.createDataFrame(rows, "episode_index long, frame_index long").repartition(5)
    episodes = spark.createDataFrame([*enumerate(lengths), (99, 3), (None, 3), (5, 130), (6, None)], "episode_index long, length long")
    out = s.sampled_frames(frames, episodes)
    want = [(e, i) for e, n in enumerate(lengths) if n for i in np.unique(np.round(np.linspace(0, n - 1, max(min(100, n), min(int(n**0.75), 10000)))).astype(int))]
    assert sorted((r.episode_index, r.frame_index) for r in out.collect()) == want
    plan = out._jdf.queryExecution().toString()
    assert "Aggregate" not in plan and "transform" not in plan


@pytest.mark.parametrize("hot", [3, 500, 2_000_000])
def test_frames_are_shuffled_once_without_a_hot_group(spark, hot):
    """The same frames whether a group is hot, none is, or the table is too small for one; texts are not salted unless it is small."""
    from tests.conftest import SF
    from trajspark.sources.adapters import frames_events

    spark.conf.set("spark.trajspark.hotGroupRows", str(hot))
    try:
        frames = frames_events(spark, SF).frames
        got = sorted(map(str, frames.collect()))
        plan = frames._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.trajspark.hotGroupRows")
    assert ("_salt" in plan) == (hot == 2_000_000) and ("_block" in plan) == (hot == 3)
    assert got == sorted(map(str, frames_events(spark, SF).frames.collect()))
