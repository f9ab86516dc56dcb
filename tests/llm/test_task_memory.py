"""What a task holds besides its slice of texts."""

import tracemalloc

import numpy as np
import pyarrow as pa

from keelson.llm import lines, phrases, toxicity, vectors

M64 = (1 << 64) - 1


def peak(work):
    """MB that ``work`` allocates at most."""
    tracemalloc.start()
    try:
        work()
        return tracemalloc.get_traced_memory()[1] / (1 << 20)
    finally:
        tracemalloc.stop()


def texts(size: int) -> pa.Array:
    r = np.random.default_rng(1)
    words = ["w" * int(k) + str(k) for k in r.integers(3, 9, 400)]
    one = " ".join(words[i] for i in r.integers(0, 400, 1000)) + ".\n"
    return pa.array([one] * (size // len(one)), pa.large_string())


def test_words_of_a_slice_take_few_times_its_bytes():
    column = texts(4 << 20)
    assert peak(lambda: phrases.coded(column)) < 15 * 4


def test_lines_of_a_slice_take_few_times_its_bytes():
    column = texts(4 << 20).to_pylist()
    assert peak(lambda: lines.Lines(column)) < 18 * 4


def test_powers_are_not_kept_for_a_whole_slice():
    vectors._powers.clear()
    t = vectors.Texts(texts(4 << 20))
    t.words()
    assert sum(p.nbytes for p in vectors._powers.values()) <= 8 << 20


def test_sums_and_powers_across_blocks():
    n = 2 * vectors.BLOCK + 5
    values = np.arange(n, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    sums, total, power = vectors.power_sums(values), 0, 1
    for i in range(n):
        assert i % 4099 or int(sums[i]) == total
        total = (total + int(values[i]) * power) & M64
        power = power * vectors.BASE & M64
    assert int(sums[n]) == total
    at = np.array([0, 1, vectors.BLOCK - 1, vectors.BLOCK, n])
    assert vectors.powers_at(vectors.INVERSE, at).tolist() == [
        pow(vectors.INVERSE, int(i), 1 << 64) for i in at]
    assert vectors.power_sums(values[:0]).tolist() == [0]


def test_pieces_end_at_breaks_and_texts():
    column = pa.array(["", "a,b  c", "", "d", ".e", "f\ng\th"], pa.large_string())
    codes, words = phrases.coded(column)
    said = [words[c].as_py() if c >= 0 else "|" for c in codes.tolist()]
    assert said == ["a", "|", "b", "c", "|", "d", "|", "e", "|", "f", "|", "g", "h"]


def test_vocabulary_by_parts_is_that_of_all():
    data = [f"common{i % 5} rare{i} twice{i // 2} {'x ' * (i % 3)}" for i in range(50)] + ["", "--"]
    keys, some = toxicity._vocabulary(data, 7)
    every = toxicity.Words(pa.array(data, pa.large_string()))
    owner = np.repeat(np.arange(len(data)), np.diff(every.first))
    pairs = np.unique(every.place.astype(np.int64) << 32 | owner)
    seen = np.bincount(pairs >> 32, minlength=len(every.key))
    assert keys.tolist() == every.key[seen >= toxicity.MIN_COUNT].tolist()
    assert some.tolist() == list(range(50))
    assert toxicity._vocabulary([], 7)[0].tolist() == []
