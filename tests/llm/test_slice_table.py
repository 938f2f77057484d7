"""The cache of slices, also when far more distinct slices come at once than it has places."""

import signal

import numpy as np
import pytest
from vulnlake.llm import bpe
from vulnlake.llm.slice_table import SliceTable


@pytest.fixture(autouse=True)
def ends():
    """A search that never ends is a failure."""

    def stop(*_):
        raise TimeoutError

    before = signal.signal(signal.SIGALRM, stop)
    signal.alarm(60)
    yield
    signal.alarm(0)
    signal.signal(signal.SIGALRM, before)


def learn(new):
    return [np.frombuffer(x, np.uint8).astype(np.int32).tobytes() for x in new]


@pytest.mark.parametrize("bits", [4, 6, 21])
def test_one_long_text_of_distinct_slices(bits):
    cache = SliceTable(learn, bits)
    words = [b"%d" % (k * 7919) for k in range(500)] + [b"a word of over sixteen bytes %d" % (k % 40) for k in range(90)] + [b"7919"] * 50
    for _ in range(2):
        text = b"".join(words)
        stops = np.cumsum([len(w) for w in words])
        numbers, sizes = cache.ids(text, np.concatenate([[0], stops[:-1]]), stops)
        assert sizes.tolist() == [len(w) for w in words]
        assert bytes(numbers.tolist()) == text
    assert (cache.entry >= 0).sum() <= 3 << (bits - 2)


def test_long_text_through_a_small_table(monkeypatch):
    monkeypatch.setattr(bpe, "SCAN", 64)
    text = " ".join(str(k) for k in range(2000)).encode()
    parts = list(bpe.encode_slices([b"x y", text, b""], SliceTable(learn, 4)))
    assert b"".join(bytes(ids.tolist()) for ids, _ in parts) == b"x y" + text
    assert np.concatenate([n for _, n in parts]).tolist() == [3, len(text), 0]
