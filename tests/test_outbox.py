"""Outbox: one outcome per job, also if a worker dies between sending and the commit; a repeated job sends only what is in doubt."""

from __future__ import annotations

import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from postweave.operators import deliver as D
from postweave.operators.outbox import Outbox


def payloads(spark, n):
    return spark.range(n).select(F.concat(F.lit("j"), "id").alias("job_id"), F.array(F.lit("Python")).alias("required_skills"), F.current_timestamp().alias("submitted_at"))


def sender(log, dies_at=None):
    def send(body):
        if body["job_id"] == dies_at and not os.path.exists(f"{log}.died"):
            open(f"{log}.died", "w").close()
            os._exit(1)
        with open(log, "a") as f:
            f.write(body["job_id"] + "\n")
        if body["job_id"] == "j3":
            raise D.SendError("refused", 400)
    return send


def calls(log):
    return Counter(open(log).read().split())


def test_a_worker_dies_between_sending_and_the_commit(spark, tmp_path):
    box, log = Outbox(f"{tmp_path}/box"), f"{tmp_path}/log"
    with pytest.raises(Exception):
        box.deliver(payloads(spark, 60), sender(log, "j41"), "run-1", tasks=2, batch=5)
    states = {r.job_id: r.state for r in box.ledger(spark).collect()}
    assert states["j41"] == "claimed" and "confirmed" not in states.values() and "sent" in states.values()
    first = calls(log)
    out = box.deliver(payloads(spark, 60), sender(log, "j41"), "run-1", tasks=2, batch=5)
    assert out.count() == 60 and out.filter("ok").count() == 59
    states = {r.job_id: r.state for r in box.ledger(spark).collect()}
    assert Counter(states.values()) == {"confirmed": 59, "failed": 1}
    # Every job was sent; only those whose batch had no outcome yet, and the refused one, were sent again.
    both = calls(log)
    assert set(both) == {f"j{i}" for i in range(60)}
    again = {j for j in both if both[j] > 1} - {"j3"}
    assert len(again) <= 2 * 5 and all(first[j] for j in again)


def test_a_repeated_job_sends_nothing_that_was_sent(spark, tmp_path):
    box, log = Outbox(f"{tmp_path}/box"), f"{tmp_path}/log"
    box.deliver(payloads(spark, 20), sender(log), "run-1", tasks=3, batch=4)
    out = box.deliver(payloads(spark, 25), sender(log), "run-2", tasks=3, batch=4)
    assert {r.job_id: (r.ok, r.attempts) for r in out.collect()} == {f"j{i}": (i != 3, 1) for i in range(25)}
    assert {j: n for j, n in calls(log).items() if n > 1} == {"j3": 2}


def test_no_payloads(spark, tmp_path):
    box = Outbox(f"{tmp_path}/box")
    assert box.deliver(payloads(spark, 0), sender(f"{tmp_path}/log"), "run-1").count() == 0
    assert box.ledger(spark).count() == 0


def test_the_sender_gets_what_a_plain_delivery_gives_it(spark, tmp_path):
    def tell(body):
        raise D.SendError(repr(sorted(body.items())), 400)

    jobs = payloads(spark, 5).withColumn("submitted_at", F.timestamp_seconds(F.lit(7)))
    boxed = Outbox(f"{tmp_path}/box").deliver(jobs, tell, "run-1", tasks=2, batch=2)
    assert sorted(boxed.collect()) == sorted(D.deliver(jobs, tell).collect())
