import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import PACKET_DDL
from flowspark.operators import features as fx
from flowspark.operators import flows as fl
from plain_fold import fold

CFG = fl.FlowConfig()
A, B = True, False


def sequence(packets, cfg=CFG):
    rows = fl.assign_flows(packets, cfg).orderBy("pkt_no").collect()
    return [(r.flow_seq, r.is_fwd) for r in rows]


@pytest.mark.parametrize("rows, protocol, want", [
    ([(1.0, A, 0), (1.1, B, 0)], 6, [(0, True), (0, False)]),                      # both directions, one flow
    ([(1.0, B, 0), (1.1, A, 0)], 6, [(0, True), (0, False)]),                      # the first packet is forward
    ([(1.0, A, 1), (1.1, B, 17), (1.2, A, 2)], 6, [(0, True), (0, False), (1, True)]),  # two FINs
    ([(1.0, A, 2), (1.1, A, 4)], 6, [(0, True), (0, True)]),                       # RST ends after itself
    ([(1.0, A, 4), (1.1, A, 2)], 6, [(0, True), (1, True)]),                       # reuse after RST
    ([(1.0, A, 0), (150.0, B, 0)], 6, [(0, True), (1, True)]),                     # idle
    ([(1.0, A, 0), (121.0, A, 0)], 6, [(0, True), (0, True)]),                     # a gap equal to the limit stays
    ([(1.0, A, 0), (200.0, A, 0)], 17, [(0, True), (1, True)]),                    # UDP idle
    ([(i * 100.0, A, 0) for i in range(20)], 6, [(int(i > 18), True) for i in range(20)]),  # active timeout
])
def test_boundaries(make_packets, rows, protocol, want):
    assert sequence(make_packets(*rows, protocol=protocol)) == want


def random_packets(seed, n, keys, hot):
    rng, out, ts = random.Random(seed), [], 0
    for i in range(n):
        ts += rng.randint(0, 30)
        k = 0 if rng.random() < hot else rng.randrange(keys)
        proto, flip = (17 if k % 3 == 2 else 6), rng.random() < 0.4
        ends = [(f"10.0.0.{k}", 1000 + k), ("10.9.9.9", 80)]
        (s, sp), (d, dp) = reversed(ends) if flip else ends
        flags = 0 if proto == 17 else rng.choice([0, 2, 16, 16, 16, 24, 1, 17, 16, 16, 16, 16, 4])
        out.append((f"c{k % 2}", i, ts + rng.choice([0, 0, 0, -25, 15]), s, d, sp, dp, proto, rng.choice([0, 10, 1400]), 20, flags, i % 7))
    return out


@pytest.mark.parametrize("limits", [dict(), dict(heavy_packets=40, block_packets=60, fan_in=2)])
def test_random_traces_match_packet_by_packet(spark, limits):
    """Out-of-order times and one connection with a third of all packets, with and without splitting it."""
    cfg = fl.FlowConfig(idle_us=120, udp_us=90, active_us=400, burst_us=20)
    packets = random_packets(3, 700, 9, 0.33)
    df = spark.createDataFrame(packets, PACKET_DDL)
    got = {(r.capture_id, r.pkt_no): (r.flow_seq, r.flow_start, r.is_fwd) for r in fl.assign_flows(df, replace(cfg, **limits)).collect()}
    assert got == fold(packets, 120, 90, 400)


def test_split_connections_give_the_same_features(spark):
    cfg = fl.FlowConfig(idle_us=120, udp_us=90, active_us=400, burst_us=20)
    df = spark.createDataFrame(random_packets(4, 500, 5, 0.4), PACKET_DDL)
    whole = fx.flow_features(df, cfg)
    split = fx.flow_features(df, replace(cfg, heavy_packets=50, block_packets=80, fan_in=2))

    def rows(t):
        doubles = [F.round(f"`{c}`", 6).alias(c) if ty == "double" else F.col(f"`{c}`") for c, ty in t.dtypes]
        return sorted(map(tuple, t.select(*doubles).collect()))

    assert rows(whole) == rows(split)


def test_keys_ignore_direction(make_packets):
    keyed = fl.with_key(make_packets((1, A, 0), (2, B, 0)))
    assert keyed.select(*fl.KEY).distinct().count() == 1
    assert [r.dir for r in keyed.orderBy("pkt_no").collect()] == [0, 1]


def test_header_lengths(spark):
    df = spark.createDataFrame(
        [(4, 5, 6, 5, 100, 86), (6, 0, 6, 0, 100, 86), (4, 6, 17, 9, 40, 26), (4, 5, 6, 8, 30, 20)],
        "ip_version int, ihl int, protocol int, data_offset int, frame_len int, ip_len int")
    assert [r.payload_len for r in fl.header_lengths(df).collect()] == [60, 40, 8, 0]
    assert [r.payload_len for r in fl.header_lengths(df, "ip").collect()] == [46, 26, 0, 0]


@pytest.mark.parametrize("fan_in", [2, 3])
@pytest.mark.parametrize("seed", [5, 6])
def test_steps_as_rows_match_packet_by_packet(spark, seed, fan_in):
    """Step functions composed as rows, where nearly every packet is a step of its own."""
    packets = random_packets(seed, 600, 5, 0.6)
    packets = [p[:10] + (16 if p[10] & 5 and i % 3 else p[10], p[11]) for i, p in enumerate(packets)]  # few FINs and RSTs: long stretches
    cfg = fl.FlowConfig(idle_us=None, udp_us=90, active_us=400, heavy_packets=60, block_packets=50, fan_in=fan_in, table_steps=0)
    df = spark.createDataFrame(packets, PACKET_DDL)
    got = {(r.capture_id, r.pkt_no): (r.flow_seq, r.flow_start, r.is_fwd) for r in fl.assign_flows(df, cfg).collect()}
    assert got == fold(packets, None, 90, 400)


def one_connection(spark, n, step_us):
    return spark.range(n).select(
        F.lit("c").alias("capture_id"), F.col("id").alias("pkt_no"), (F.col("id") * step_us).alias("ts_us"), F.lit("10.0.0.1").alias("src_ip"),
        F.lit("10.0.0.2").alias("dst_ip"), F.lit(1000).alias("src_port"), F.lit(80).alias("dst_port"), F.lit(6).alias("protocol"),
        F.lit(10).alias("payload_len"), F.lit(20).alias("header_len"), F.lit(16).alias("flags"), F.lit(1).alias("win"))


@pytest.mark.parametrize(("n", "step_us", "steps"), [(5_000_000, 300, 0), (300_000, 30_000, None)])
def test_connection_of_millions_of_packets_has_no_large_row(spark, monkeypatch, n, step_us, steps):
    """5 M packets within one active timeout and without FIN; and one of several timeouts, each with 60 000 packets."""
    written = {}
    keep = fl.materialize

    def watched(df, name):
        out = keep(df, name)
        written[name] = out
        return out

    monkeypatch.setattr(fl, "materialize", watched)
    cfg = fl.FlowConfig(table_steps=2000, heavy_packets=100_000)
    got = fl.assign_flows(one_connection(spark, n, step_us), cfg)
    per = cfg.active_us // step_us + 1
    want = -(-n // per)
    r = got.agg(F.count("*").alias("n"), F.max("flow_seq").alias("last"), F.sum((F.col("flow_start") != F.floor(F.col("pkt_no") / per) * per).cast("int")).alias("wrong")).first()
    assert (r.n, r.last, r.wrong) == (n, want - 1, 0)
    runs = written["runs"].selectExpr("max(aggregate(steps, 0, (n, a) -> n + size(a))) as longs", "sum(size(steps[0]) + size(steps[6])) as steps").first()
    assert runs.longs * 8 < 1 << 20 and written["blocks"].selectExpr("max(size(rows)) as n").first().n * 32 < 1 << 20
    assert runs.steps == 0 if steps == 0 else runs.steps > 2000


def test_packets_with_a_large_connection_are_decoded_and_keyed_once(spark, make_packets):
    """One look to count, one to write: the blocks, marks and cuts read what was written."""
    seen = spark.sparkContext.accumulator(0)

    def look(ip):
        seen.add(1)
        return ip

    packets = make_packets(*[(i, i % 3 > 0, 16) for i in range(400)])
    watched = packets.withColumn("src_ip", F.udf(look, "string")("src_ip"))
    cfg = fl.FlowConfig(active_us=50_000_000, heavy_packets=100, block_packets=32)
    assert fl.assign_flows(watched, cfg).count() == 400 and 0 < seen.value <= 800
