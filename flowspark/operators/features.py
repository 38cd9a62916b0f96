"""The 65 statistical features of a flow.

Everything is one grouped aggregation over marked packets. Names are short inside and become the
canonical ones in `canonical`. Standard deviations and variances are those of the population.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowspark.functions.schema import FEATURES
from flowspark.operators.flows import (
    ACK, FIN, KEY, PSH, SYN, TCP, UDP, URG, FlowConfig, mark_flows,
)

FLOW = [*KEY, "flow_start"]
META = ["Source_IP", "Destination_IP", "Source_Port", "Destination_Port", "Protocol", "Packets", "Bytes"]


def _fwd(value) -> Column:
    return F.when(F.col("dir") == F.col("start_dir"), value)


def _bwd(value) -> Column:
    return F.when(F.col("dir") != F.col("start_dir"), value)


def _zero(value: Column) -> Column:
    return F.coalesce(value.cast("double"), F.lit(0.0))


def _stats(prefix: str, value: Column, total: str | None = None) -> dict[str, Column]:
    out = {
        f"{prefix}_max": _zero(F.max(value)), f"{prefix}_min": _zero(F.min(value)),
        f"{prefix}_mean": _zero(F.avg(value)), f"{prefix}_std": _zero(F.stddev_pop(value)),
    }
    if total:
        out[total] = _zero(F.sum(value))
    return out


def length_stats() -> dict[str, Column]:
    p = F.col("payload_len").cast("bigint")
    return {
        **_stats("fwd_len", _fwd(p), "fwd_bytes"), **_stats("bwd_len", _bwd(p), "bwd_bytes"),
        **_stats("len", p), "len_var": _zero(F.var_pop(p)),
    }


def iat_stats() -> dict[str, Column]:
    gap, same = F.col("gap_us"), F.col("dir_gap_us")
    return {
        **_stats("iat", gap),
        **_stats("fwd_iat", _fwd(same), "fwd_iat_total"), **_stats("bwd_iat", _bwd(same), "bwd_iat_total"),
    }


def flag_counts() -> dict[str, Column]:
    def count(bit: int, keep=lambda c: c) -> Column:
        return _zero(F.sum(keep(F.when(F.col("flags").bitwiseAND(bit) > 0, 1).otherwise(0))))

    return {
        "fwd_psh": count(PSH, _fwd), "fin_cnt": count(FIN), "syn_cnt": count(SYN), "psh_cnt": count(PSH),
        "ack_cnt": count(ACK), "urg_cnt": count(URG),
    }


def header_stats() -> dict[str, Column]:
    h = F.col("header_len").cast("bigint")
    return {
        "fwd_header": _zero(F.sum(_fwd(h))), "bwd_header": _zero(F.sum(_bwd(h))),
        "init_win_fwd": F.coalesce(F.min_by(_fwd(F.col("win")), _fwd(F.col("pkt_no"))), F.lit(-1)).cast("double"),
        "init_win_bwd": F.coalesce(F.min_by(_bwd(F.col("win")), _bwd(F.col("pkt_no"))), F.lit(-1)).cast("double"),
        "act_data_fwd": _zero(F.count_if(_fwd(F.col("payload_len")) > 0)),
        "min_seg_fwd": F.coalesce(F.min(_fwd(h)), F.lit(20)).cast("double"),
    }


def counts() -> dict[str, Column]:
    return {
        "fwd_pkts": _zero(F.count(_fwd(F.lit(1)))), "bwd_pkts": _zero(F.count(_bwd(F.lit(1)))),
        "start_dir": F.first("start_dir"),
        "dur": F.greatest(
            F.lit(0), F.max_by("ts_us", "pkt_no") - F.min_by("ts_us", "pkt_no")
        ).cast("double"),
    }


def burst_stats() -> dict[str, Column]:
    out = {}
    for name in ("active", "idle"):
        v = F.col(f"{name}_us")
        out.update({
            f"{name}_mean": F.avg(v), f"{name}_std": F.stddev_pop(v),
            f"{name}_max": F.max(v).cast("double"), f"{name}_min": F.min(v).cast("double"),
        })
    return out


def _with_bursts(marked: DataFrame, burst_us: int) -> DataFrame:
    """`active_us` on the last packet of each burst, `idle_us` on the first packet after a pause."""
    w = Window.partitionBy(*FLOW).orderBy("ts_us", "pkt_no")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    pause = F.col("ts_us") - F.lag("ts_us").over(w)
    ahead = F.lead("ts_us").over(w) - F.col("ts_us")
    df = marked.withColumns({"pause": pause, "ahead": ahead})
    opens = F.col("pause").isNull() | (F.col("pause") > burst_us)
    closes = F.col("ahead").isNull() | (F.col("ahead") > burst_us)
    df = df.withColumn("burst_start", F.max(F.when(opens, F.col("ts_us"))).over(upto))
    length = F.col("ts_us") - F.col("burst_start")
    return df.withColumns({
        "active_us": F.when(closes & (length > 0), length),
        "idle_us": F.when(F.col("pause") > burst_us, F.col("pause")),
    })


def burst_rows(marked: DataFrame, burst_us: int) -> DataFrame:
    """Bursts and pauses of flows of any size, one row per occupied slot of `burst_us`.

    Packets of one slot are never a pause apart, so a slot reduces to its first and last time
    before the shuffle and only slots are sorted.
    """
    slots = marked.groupBy(*FLOW, F.expr(f"ts_us div {burst_us}").alias("slot")).agg(
        F.min("ts_us").alias("lo"), F.max("ts_us").alias("hi")
    )
    w = Window.partitionBy(*FLOW).orderBy("slot")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    df = slots.withColumns({
        "pause": F.col("lo") - F.lag("hi").over(w), "ahead": F.lead("lo").over(w) - F.col("hi"),
    })
    opens = F.col("pause").isNull() | (F.col("pause") > burst_us)
    closes = F.col("ahead").isNull() | (F.col("ahead") > burst_us)
    df = df.withColumn("burst_start", F.max(F.when(opens, F.col("lo"))).over(upto))
    length = F.col("hi") - F.col("burst_start")
    return df.select(
        *FLOW,
        F.when(closes & (length > 0), length).alias("active_us"),
        F.when(F.col("pause") > burst_us, F.col("pause")).alias("idle_us"),
    )


BLOCKS = {
    "counts": counts, "lengths": length_stats, "iat": iat_stats, "flags": flag_counts, "headers": header_stats,
}


def _aggregate(marked, cfg: FlowConfig, blocks: list[str], bursts: bool) -> DataFrame:
    """Flow rows of both kinds of connection; a flow lies wholly within one branch."""
    aggs = {k: v for b in ["counts", *blocks] for k, v in BLOCKS[b]().items()}
    named = [v.alias(k) for k, v in aggs.items()]
    burst_named = [v.alias(k) for k, v in burst_stats().items()] if bursts else []
    named.append(F.first("flow_seq").alias("flow_seq"))
    rows = _with_bursts(marked.ordinary, cfg.burst_us) if bursts else marked.ordinary
    out = rows.groupBy(*FLOW).agg(*named, *burst_named)
    if marked.oversized is not None:
        # Marking again for the bursts moves only key, time and number; writing whole packets would move more.
        rows = marked.oversized
        big = rows.groupBy(*FLOW).agg(*named)
        if bursts:
            big = big.join(burst_rows(rows, cfg.burst_us).groupBy(*FLOW).agg(*burst_named), FLOW)
        out = out.unionByName(big)
    return out


def _derive(flows: DataFrame, blocks: list[str], bursts: bool) -> DataFrame:
    cols: dict[str, Column] = {"down_up": F.when(F.col("fwd_pkts") > 0, F.col("bwd_pkts") / F.col("fwd_pkts")).otherwise(0.0)}
    seconds = F.when(F.col("dur") > 0, F.col("dur") / 1e6).otherwise(F.lit(1e-6))
    packets = F.col("fwd_pkts") + F.col("bwd_pkts")
    cols.update({
        "pkts_s": packets / seconds, "fwd_pkts_s": F.col("fwd_pkts") / seconds, "bwd_pkts_s": F.col("bwd_pkts") / seconds,
    })
    if "lengths" in blocks:
        total = F.col("fwd_bytes") + F.col("bwd_bytes")
        cols.update({"bytes_s": total / seconds, "avg_size": total / packets})
    if bursts:
        # Without any burst of positive length the whole flow counts as one.
        for stat in ("mean", "max", "min"):
            cols[f"active_{stat}"] = F.coalesce(F.col(f"active_{stat}"), F.col("dur"))
            cols[f"idle_{stat}"] = F.coalesce(F.col(f"idle_{stat}"), F.lit(0.0))
        cols["active_std"] = F.coalesce(F.col("active_std"), F.lit(0.0))
        cols["idle_std"] = F.coalesce(F.col("idle_std"), F.lit(0.0))
    forward = F.col("start_dir") == 0
    cols.update({
        "Source_IP": F.when(forward, F.col("lo_ip")).otherwise(F.col("hi_ip")),
        "Destination_IP": F.when(forward, F.col("hi_ip")).otherwise(F.col("lo_ip")),
        "Source_Port": F.when(forward, F.col("lo_port")).otherwise(F.col("hi_port")),
        "Destination_Port": F.when(forward, F.col("hi_port")).otherwise(F.col("lo_port")),
        "Protocol": F.when(F.col("protocol") == TCP, F.lit("TCP")).when(
            F.col("protocol") == UDP, F.lit("UDP")).otherwise(F.col("protocol").cast("string")),
        "Packets": packets.cast("bigint"),
    })
    if "lengths" in blocks:
        cols["Bytes"] = (F.col("fwd_bytes") + F.col("bwd_bytes")).cast("bigint")
    # `protocol` and `Protocol` are one name to Spark: keep the key's number in a struct-free copy.
    keep = [c for c in flows.columns if c not in cols and c != "protocol"]
    return flows.select(*keep, *[c.alias(n) for n, c in cols.items()])


# Short name of each feature, in model order.
_SHORT = [
    "Destination_Port", "dur", "fwd_pkts", "bwd_pkts", "fwd_bytes", "bwd_bytes",
    "fwd_len_max", "fwd_len_min", "fwd_len_mean", "fwd_len_std",
    "bwd_len_max", "bwd_len_min", "bwd_len_mean", "bwd_len_std", "bytes_s", "pkts_s",
    "iat_mean", "iat_std", "iat_max", "iat_min",
    "fwd_iat_total", "fwd_iat_mean", "fwd_iat_std", "fwd_iat_max", "fwd_iat_min",
    "bwd_iat_total", "bwd_iat_mean", "bwd_iat_std", "bwd_iat_max", "bwd_iat_min",
    "fwd_psh", "fwd_header", "bwd_header", "fwd_pkts_s", "bwd_pkts_s",
    "len_min", "len_max", "len_mean", "len_std", "len_var",
    "fin_cnt", "syn_cnt", "psh_cnt", "ack_cnt", "urg_cnt", "down_up", "avg_size", "fwd_len_mean", "bwd_len_mean",
    "fwd_pkts", "fwd_bytes", "bwd_pkts", "bwd_bytes", "init_win_fwd", "init_win_bwd", "act_data_fwd", "min_seg_fwd",
    "active_mean", "active_std", "active_max", "active_min", "idle_mean", "idle_std", "idle_max", "idle_min",
]
SHORT_NAMES = dict(zip(FEATURES, _SHORT))


def flow_table(packets: DataFrame, cfg: FlowConfig = FlowConfig(), blocks: list[str] | None = None,
               bursts: bool = True) -> DataFrame:
    """Flow rows under short names; `blocks` limits the feature groups computed."""
    blocks = list(BLOCKS)[1:] if blocks is None else blocks
    return _derive(_aggregate(mark_flows(packets, cfg), cfg, blocks, bursts), blocks, bursts)


def derive(flows: DataFrame) -> DataFrame:
    """Rates, ratios, burst defaults and metadata from the aggregates of every block."""
    return _derive(flows, list(BLOCKS)[1:], True)


def canonical(flows: DataFrame) -> DataFrame:
    """Metadata and the 65 features under their canonical names."""
    return flows.select(
        "capture_id", "flow_start", "flow_seq", *META,
        *[F.col(short).cast("double").alias(name) for name, short in SHORT_NAMES.items()],
    )


def flow_features(packets: DataFrame, cfg: FlowConfig = FlowConfig()) -> DataFrame:
    return canonical(flow_table(packets, cfg))


def active_idle_periods(packets: DataFrame, cfg: FlowConfig = FlowConfig()) -> DataFrame:
    """One row per burst of positive length ('active') and per pause ('idle') of each flow."""
    marked = mark_flows(packets, cfg)
    rows = marked.ordinary if marked.oversized is None else marked.ordinary.unionByName(marked.oversized)
    kinds = F.array(
        F.struct(F.lit("active").alias("kind"), F.col("active_us").alias("us")),
        F.struct(F.lit("idle").alias("kind"), F.col("idle_us").alias("us")),
    )
    return (
        burst_rows(rows, cfg.burst_us)
        .select("capture_id", "flow_start", F.inline(kinds))
        .where(F.col("us").isNotNull())
    )


def extraction_summary(packets: DataFrame, flows: DataFrame, max_packets: int | None = None) -> DataFrame:
    """Per capture: packets taken, flows found, and whether the cap cut the capture short."""
    seen = packets.groupBy("capture_id").agg(F.count(F.lit(1)).alias("frames"))
    found = flows.groupBy("capture_id").agg(F.count(F.lit(1)).alias("flows_extracted"))
    cap = F.lit(max_packets).cast("bigint")
    return seen.join(found, "capture_id", "left").select(
        "capture_id",
        (F.col("frames") if max_packets is None else F.least("frames", cap)).alias("packets_processed"),
        F.coalesce("flows_extracted", F.lit(0)).cast("bigint").alias("flows_extracted"),
        (F.lit(False) if max_packets is None else F.col("frames") > cap).alias("was_truncated"),
        cap.alias("max_packets"),
    )
