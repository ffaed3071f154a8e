import numpy as np

from tidewheel.llm.filters import BITS, among, bits_of


def test_a_filter_loses_nothing_and_lets_little_through(spark):
    rng = np.random.default_rng(1)
    hashes = rng.integers(-(2**63), 2**63 - 1, 20_000)
    edges = np.array([0, -1, 1, (1 << BITS) - 1, 1 << BITS, 2**63 - 1, -(2**63), 32767, 32768])
    some = np.concatenate([hashes[:10_000], edges])
    bits = bits_of(spark.createDataFrame([(int(h),) for h in some], "h long"))
    assert among(bits, some).all()
    assert among(bits, hashes[10_000:]).sum() < 50
    assert not bits_of(spark.createDataFrame([], "h long")).any()
    assert among(bits, np.zeros(0, np.int64)).shape == (0,)
