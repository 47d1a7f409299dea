import random

import numpy as np
import pyarrow as pa

from burnup.llm import columns as C


def thue_morse(n, letters):
    return "".join(letters[bin(i).count("1") & 1] for i in range(n))


def hashes(texts):
    _, _, buf, bounds = next(C.chunks(pa.array(texts)))
    return C.word_hashes(buf, bounds[:-1], bounds[1:] - 1)


def test_regular_long_words_differ():
    words = [thue_morse(n, pair) for n in (32, 64, 1024, 4096) for pair in ("ab", "ba", "cd", "dc")]
    assert len(set(hashes(words).tolist())) == len(words)


def test_equal_words_equal_hashes_wherever_they_stand():
    r = random.Random(1)
    words = ["".join(r.choices("abé", k=r.choice([0, 1, 5, 31, 32, 33, 200]))) for _ in range(500)]
    a, b = hashes(words), hashes(words[::-1])[::-1]
    assert np.array_equal(a, b)
    assert len(set(a.tolist())) == len(set(words))
