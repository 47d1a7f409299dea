"""The stream of push answers: attempts, back-off and restart, against a fold in plain Python."""
import datetime as dt
import random

import pytest

from burnup.streaming import push_retry as pr

T0 = dt.datetime(2024, 1, 24, 12)
MINUTE = dt.timedelta(minutes=1)


def run(spark, base, batches, **limits):
    """Each batch lands and the stream is started anew, from its progress."""
    for batch in batches:
        spark.createDataFrame(batch, pr.ANSWERS).coalesce(1).write.mode("append").parquet(f"{base}/answers")
        pr.start_retry_stream(spark, f"{base}/answers", f"{base}/events", f"{base}/progress", **limits).awaitTermination()
    return sorted(tuple(r) for r in spark.read.schema(pr.EVENTS).parquet(f"{base}/events").collect())


def tick(minutes):
    """A later answer of another chunk moves the stream's time."""
    return [(999, 999, "tick", 0, False, T0 + minutes * MINUTE)]


def test_back_off_and_restart(spark, tmp_path):
    a, b = (1, 1, "2024/01/02"), (2, 1, "2024/01/02")
    batches = [
        [(*a, 0, False, T0), (*b, 0, False, T0), (3, 1, "x", 0, True, T0), (None, 1, "x", 0, False, T0), (4, 1, "x", 0, False, None)],
        tick(30),  # both were due at 5 minutes
        [(*a, 1, False, T0 + 31 * MINUTE), (*a, 1, False, T0 + 31 * MINUTE), (*b, 1, True, T0 + 31 * MINUTE)],
        tick(60),  # a is due again 10 minutes after its second failure
        [(*b, 2, False, T0 + 61 * MINUTE), (*a, 2, None, T0 + 61 * MINUTE)],
        tick(200),
    ]
    got = [x for x in run(spark, str(tmp_path), batches, max_failures=3, late="1 minute") if x[2] != "tick"]
    assert got == sorted([(*a, "retry", 1, T0 + 5 * MINUTE), (*b, "retry", 1, T0 + 5 * MINUTE), (*b, "accepted", 1, T0 + 31 * MINUTE),
                          (*a, "retry", 2, T0 + 41 * MINUTE), (*a, "given_up", 3, T0 + 61 * MINUTE)])


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_ends_the_same(spark, tmp_path, seed):
    r = random.Random(seed)
    chunks = [(i, i % 3, f"2024/01/{1 + i % 9:02d}") for i in range(30)]
    answers, accepted, given_up = [], set(), set()
    for c in chunks:
        n, good = r.randint(1, 4), r.random() < 0.5
        for attempt in range(n):
            ok = good and attempt == n - 1
            answers.append((*c, attempt, ok, T0 + attempt * MINUTE))
            if ok and attempt:
                accepted.add(c)
        if not good and n == 4:
            given_up.add(c)
    answers += r.sample(answers, 20)
    r.shuffle(answers)
    got = run(spark, str(tmp_path), [answers[:40], answers[40:]], max_failures=4)
    ends = [x for x in got if x[3] != "retry"]
    assert sorted(x[:3] for x in ends if x[3] == "accepted") == sorted(accepted)
    assert sorted(x[:3] for x in ends if x[3] == "given_up") == sorted(given_up)
