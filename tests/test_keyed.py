import math
import random

import pandas as pd

from topicwake.plans.modeling import Params
from topicwake.streaming import jobs, keyed

SCHEMA = "user string, id long, dominant_topic int"


def plain(batches, window, k=10):
    """Windows of each key by a plain loop; a batch's rows count in id order."""
    out, held, last, number = [], {}, {}, {}
    for batch in batches:
        for user, i, topic in sorted(batch, key=lambda r: r[1]):
            if topic is None or topic < 0:
                continue
            tally = held.setdefault(user, [0] * k)
            tally[topic] += 1
            if sum(tally) == window:
                p = [(c + 1e-10) / (window + k * 1e-10) for c in tally]
                q = last.get(user)
                js = 0.0
                if q:
                    js = math.sqrt(max(0.0, sum(a * math.log(2 * a / (a + b)) + b * math.log(2 * b / (a + b)) for a, b in zip(p, q)) / 2))
                out.append((user, number.get(user, 0), i, round(js, 4), bool(q) and js > 0.15))
                number[user], last[user], held[user] = number.get(user, 0) + 1, p, [0] * k
    return sorted(out, key=str)


def test_windows_of_each_key_go_on_from_batch_to_batch(spark, tmp_path):
    rng = random.Random(4)
    users = ["hot"] * 6 + ["a", "b", None]
    rows = [(rng.choice(users), i, rng.choice([-1, None, 0, 1, 2, 3 if i > 300 else 0])) for i in range(600)]
    batches = [rows[:250], rows[250:260], rows[260:]]
    for n, batch in enumerate(batches):
        shuffled = rng.sample(batch, len(batch))
        spark.createDataFrame(shuffled, SCHEMA).coalesce(2).write.parquet(str(tmp_path / "in" / str(n)))
        stream = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
        jobs.drain(jobs.stream_drift_by_key(stream, str(tmp_path / "out"), str(tmp_path / "cp"), "user", Params(window=20)))
    found = [(r.user, r.window_id, r.closing_id, r.js_divergence, r.drift_detected) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(found, key=str) == plain(batches, 20) and len(found) > 15


class Kept:
    """A value state in memory."""

    value = None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def test_many_keys_of_a_share_are_worked_on_in_one_call():
    rng = random.Random(9)
    users = [(1 << 60) + i for i in range(400)]
    batches = [[(rng.choice(users), 10_000 * n + i, rng.randrange(4)) for i in range(5000)] for n in range(3)]
    work = keyed.KeyedWindows(5, 10, keyed.T.LongType())
    work.carry, found = Kept(), []
    for batch in batches:
        frame = pd.DataFrame(rng.sample(batch, len(batch)), columns=["key", "id", "topic"])
        for out in work.handleInputRows((7,), iter([frame[:2000], frame[2000:]]), None):
            found += [(r.key, r.window_id, r.closing_id, r.previous_dist is not None) for r in out.itertuples()]
    assert sorted(found) == sorted((user, window, closing, window > 0) for user, window, closing, _, _ in plain(batches, 5))


def test_keys_beyond_the_shares_and_null_keys(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "_SHARES", 3)
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 1)  # null keys come in one batch with others
    rng = random.Random(11)
    users = [(1 << 60) + i for i in range(20)] + [None, -1]
    for n in range(2):
        rows = [(rng.choice(users), 1000 * n + i, rng.randrange(4)) for i in range(400)]
        spark.createDataFrame([*rows, (users[0], None, 1)], "user long, id long, dominant_topic int").write.parquet(str(tmp_path / "in" / str(n)))
        stream = spark.readStream.schema("user long, id long, dominant_topic int").option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
        jobs.drain(jobs.stream_drift_by_key(stream, str(tmp_path / "out"), str(tmp_path / "cp"), "user", Params(window=5)))
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    read = spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "in")).where("id is not null").collect()
    batches = [[tuple(r) for r in read if r.id // 1000 == n] for n in range(2)]
    found = [(r.user, r.window_id, r.closing_id, r.js_divergence, r.drift_detected) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(found, key=str) == plain(batches, 5)
