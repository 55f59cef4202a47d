import numpy as np

from tristrata.llm import lines
from tristrata.llm.rows import code_points
from tristrata.llm.shingles import FACTOR, multisets, rolling

import pyarrow as pa


def test_rolling_equals_the_polynomial():
    rng = np.random.default_rng(5)
    for size in (0, 3, 7, 8, 40):
        points = rng.integers(1, 0x110000, size).astype(np.uint32)
        for n in (1, 2, 3, 5, 8):
            for kind, bits in ((np.uint32, 32), (np.uint64, 64)):
                factor = int(FACTOR) % 2**bits
                plain = [
                    sum(int(p) * factor ** (n - 1 - k) for k, p in enumerate(points[i : i + n])) % 2**bits
                    for i in range(max(0, size - n + 1))
                ]
                assert rolling(points, n, kind).tolist() == plain


def test_multisets_count_by_text():
    hashes = np.array([9, 1, 9, 1, 1], np.uint64) << np.uint64(30)
    got = multisets(hashes, np.array([0, 0, 0, 1, 1]))
    assert [x.tolist() for x in got] == [[1 << 10, 9 << 10, 1 << 10], [1, 2, 2], [0, 0, 1]]
    assert [len(x) for x in multisets(hashes[:0], np.zeros(0, np.int64))] == [0, 0, 0]


def test_signatures_depend_on_the_line_alone():
    texts = ["a line of text", "12345678", "ünï¢ode line that is longer than others", "12345678"]
    together = lines.signatures(*code_points(pa.array(texts)))
    for text, found in zip(texts, together):
        assert (lines.signatures(*code_points(pa.array([text])))[0] == found).all()
    assert (together != lines.NONE).all()


def test_signatures_estimate_the_overlap():
    rng = np.random.default_rng(7)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz "))
    texts = []
    for _ in range(60):
        common = "".join(rng.choice(letters, 900))
        texts += [common + "".join(rng.choice(letters, 100)), common + "".join(rng.choice(letters, 100))]
    found = lines.signatures(*code_points(pa.array(texts)))
    share = (found[::2] == found[1::2]).mean()
    assert abs(share - 893 / 1093) < 0.03
