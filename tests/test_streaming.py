import random

from pyspark.sql import functions as F

from conftest import PACKET_DDL
from flowspark.operators import flows as fl
from flowspark.session import scratch_path
from flowspark.streaming import flow_stream as fs
from plain_fold import fold

CFG = fl.FlowConfig(idle_us=120_000_000, udp_us=90_000_000, active_us=400_000_000)


def ordered_packets(n=240):
    rng, out, ts = random.Random(11), [], 1_000_000_000
    for i in range(n):
        ts += rng.randint(0, 25) * 1_000_000
        k = 0 if rng.random() < 0.4 else rng.randrange(4)
        ends = [(f"10.0.0.{k}", 1000 + k), ("10.9.9.9", 80)]
        (s, sp), (d, dp) = reversed(ends) if rng.random() < 0.4 else ends
        proto = 17 if k == 2 else 6
        out.append(("c", i, ts, s, d, sp, dp, proto, rng.choice([0, 10, 70]), 20, rng.choice([0, 16, 16, 1, 4]) if proto == 6 else 0, 1))
    return out


def test_stream_over_several_batches_equals_batch(spark):
    packets = ordered_packets()
    end = ("end", 0, packets[-1][2] + 10**12, "0", "0", 0, 0, 6, 0, 0, 0, 0)
    path = scratch_path(spark, "in")
    out, log = scratch_path(spark, "out"), scratch_path(spark, "log")
    for part in (packets[:90], packets[90:91], packets[91:], [end]):
        spark.createDataFrame(part, PACKET_DDL).coalesce(1).write.mode("append").parquet(path)
        stream = fs.stream_flows(fs.open_stream(spark, path, spark.createDataFrame([], PACKET_DDL).schema), CFG)
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", log).trigger(
            availableNow=True).start().awaitTermination()
    rows = fs.numbered(spark.read.parquet(out)).where(F.col("capture_id") == "c").collect()
    want = {}
    for (_, no), (seq, start, fwd) in fold(packets, CFG.idle_us, CFG.udp_us, CFG.active_us).items():
        p = packets[no]
        lo = min((p[3], p[5]), (p[4], p[6]))
        f = want.setdefault((*lo, p[7], seq), [start, 0, 0, 0, 0])
        f[1 if fwd else 2] += 1
        f[3 if fwd else 4] += p[8]
    got = {(r.lo_ip, r.lo_port, r.protocol, r.flow_seq): [r.flow_start, r.fwd_pkts, r.bwd_pkts, r.fwd_bytes, r.bwd_bytes] for r in rows}
    assert len(rows) == len(want) and got == want
    assert {r.end_reason for r in rows} == {"rst", "fin", "timeout"}


def test_streamed_features_equal_the_batch_ones(spark):
    """Over several micro-batches, flows continued across them included."""
    from flowspark.operators import features as fx

    packets = ordered_packets()
    end = ("end", 0, packets[-1][2] + 10**12, "0", "0", 0, 0, 6, 0, 0, 0, 0)
    path, out, log = (scratch_path(spark, n) for n in ("in", "out", "log"))
    for part in (packets[:100], packets[100:170], packets[170:], [end]):
        spark.createDataFrame(part, PACKET_DDL).coalesce(1).write.mode("append").parquet(path)
        stream = fs.stream_features(fs.open_stream(spark, path, spark.createDataFrame([], PACKET_DDL).schema, max_files=1), CFG)
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", log).trigger(
            availableNow=True).start().awaitTermination()
    key = ("Source_IP", "Destination_IP", "Source_Port", "Destination_Port", "flow_start")
    got = {tuple(r[k] for k in key): r for r in fs.numbered(spark.read.parquet(out)).where("capture_id = 'c'").collect()}
    want = {tuple(r[k] for k in key): r for r in fx.flow_features(spark.createDataFrame(packets, PACKET_DDL), CFG).collect()}
    assert set(got) == set(want)
    for k, w in want.items():
        for name in w.asDict():
            a, b = got[k][name], w[name]
            assert a == b or abs(a - b) <= 1e-9 * max(1.0, abs(b)), (k, name, a, b)


def test_state_ends_with_its_flows_and_bursts_go_by_time(spark):
    """Packets up to three seconds out of order over several batches: features as at rest, and no state left at the end."""
    from flowspark.operators import features as fx

    rng = random.Random(12)
    cfg = fl.FlowConfig(idle_us=120_000_000, udp_us=90_000_000, active_us=400_000_000, burst_us=2_000_000)
    packets = [(*p[:2], p[2] + rng.choice([0, 0, 0, -3, 2]) * 1_000_000, *p[3:]) for p in ordered_packets(300)]
    end = ("end", 0, packets[-1][2] + 10**12, "0", "0", 0, 0, 6, 0, 0, fl.RST, 0)  # its flow ends with it
    path, out, log = (scratch_path(spark, n) for n in ("in", "out", "log"))
    left = []
    for part in (packets[:80], packets[80:81], packets[81:200], packets[200:], [end]):
        spark.createDataFrame(part, PACKET_DDL).coalesce(1).write.mode("append").parquet(path)
        stream = fs.stream_features(fs.open_stream(spark, path, spark.createDataFrame([], PACKET_DDL).schema), cfg, "10 seconds")
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", log).trigger(availableNow=True).start()
        query.awaitTermination()
        left.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert left[0] > 0 and left[-1] == 0
    key = ("Source_IP", "Destination_IP", "Source_Port", "Destination_Port", "flow_start")
    got = {tuple(r[k] for k in key): r for r in fs.numbered(spark.read.parquet(out)).where("capture_id = 'c'").collect()}
    want = {tuple(r[k] for k in key): r for r in fx.flow_features(spark.createDataFrame(packets, PACKET_DDL), cfg).collect()}
    assert set(got) == set(want)
    for k, w in want.items():
        for name in w.asDict():
            a, b = got[k][name], w[name]
            assert a == b or abs(a - b) <= 1e-9 * max(1.0, abs(b)), (k, name, a, b)
    assert sum(w["Idle Mean"] is not None and w["Idle Mean"] > 0 for w in want.values()) > 5


def test_squares_are_exact():
    import numpy as np

    for values in ([3, 4], [1_200_000_000] * 5000, [(1 << 40) - 1] * 9, [1 << 50, 7], [-5, -(1 << 33)]):
        assert fs._squares(np.array(values, np.int64)) == sum(v * v for v in values)


def test_flows_within_one_batch_are_taken_at_once(monkeypatch):
    """400 flows of one connection in one batch: running totals are kept for the one that stays open, not for each."""
    import numpy as np
    import pandas as pd

    class Handle:
        value, getValueState, registerTimer = None, lambda self, *_: self, lambda self, _: None
        exists, get, update = lambda self: self.value is not None, lambda self: self.value, lambda self, v: setattr(self, "value", v)
        clear, getCurrentWatermarkInMs = lambda self: setattr(self, "value", None), lambda self: 0

    n = 1601
    i = np.arange(n)
    packets = pd.DataFrame({"pkt_no": i, "ts_us": i * 3_000_000, "flags": np.where(i % 4 == 3, fl.RST, 16), "dir": i % 2,
                            "payload_len": i % 7, "header_len": 20, "win": 100}).sample(frac=1, random_state=1)
    taken, took = [], fs._take
    monkeypatch.setattr(fs, "_take", lambda s, known, ts, *rest: (taken.append(len(ts)), took(s, known, ts, *rest)))
    processor, handle = fs.FlowProcessor(CFG, True), Handle()
    processor.init(handle)
    out = pd.concat(processor.handleInputRows(("c", "a", 1, "b", 2, 6), iter([packets[:700], packets[700:]]), handle))
    assert taken == [1] and handle.value is not None and len(out) == 400 and set(out["end_reason"]) == {"rst"}
    assert (out["flow_start"] == 4 * np.arange(400)).all() and (out["fwd_pkts"] == 2).all() and (out["iat_mean"] == 3e6).all()
    assert (out["fwd_iat_total"] == 6e6).all() and (out["idle_min"] == 3e6).all() and out["active_mean"].isna().all()
    sizes = [[(4 * k + j) % 7 for j in range(4)] for k in range(400)]
    assert out["len_max"].tolist() == [max(v) for v in sizes] and np.allclose(out["len_var"], [np.var(v) for v in sizes])


def test_squares_of_runs_are_exact():
    import numpy as np

    for values in ([3, 4, 5], [1_200_000_000] * 5000, [(1 << 40) - 1] * 9, [1 << 50, 7, 1 << 51], [-5, -(1 << 33), 2]):
        whole = [sum(v * v for v in part) for part in (values[:2], values[2:])]
        assert fs._run_squares(np.array(values, np.int64), np.array([0, 2])) == whole
