"""Packets, flows and flow features (inventory sections D and E, part of A)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from flowspark.operators import features as fx
from flowspark.operators import flows as fl
from flowspark.operators import sampling
from flowspark.plans.registry import query
from flowspark.plans.views import duck, view

# The events view has gaps of hours, so the timeouts are scaled up from minutes to days.
CFG = fl.FlowConfig(
    idle_us=86_400_000_000, udp_us=43_200_000_000, active_us=172_800_000_000, burst_us=3_600_000_000
)
# Small limits, so that ordinary keys already take the path of very large connections.
SPLIT_CFG = replace(CFG, heavy_packets=85, block_packets=2500, fan_in=3)

_KEYED = """keyed AS (
 SELECT *, CASE WHEN low THEN src_ip ELSE dst_ip END AS lo_ip, CASE WHEN low THEN src_port ELSE dst_port END AS lo_port,
  CASE WHEN low THEN dst_ip ELSE src_ip END AS hi_ip, CASE WHEN low THEN dst_port ELSE src_port END AS hi_port
 FROM (SELECT *, src_ip < dst_ip OR (src_ip = dst_ip AND src_port <= dst_port) AS low FROM packets))"""
_K = "capture_id, lo_ip, lo_port, hi_ip, hi_port, protocol"


def _on(a: str, b: str) -> str:
    return " AND ".join(f"{a}.{c} = {b}.{c}" for c in _K.split(", "))


def assigned(idle: int | None = CFG.idle_us, udp: int | None = CFG.udp_us, active: int | None = CFG.active_us,
             rst: bool = True, fin: bool = True) -> str:
    """Packet by packet assignment of flows as CTEs ending in `f` (all packets with flow_seq, fst)."""
    never = 4_000_000_000_000_000_000
    gap = f"CASE WHEN protocol = 17 THEN {udp or never} ELSE {idle or never} END"
    fin_bit = "cast(flags & 1 AS int)" if fin else "0"
    rst_bit = "(flags & 4) > 0" if rst else "false"
    return duck("packets").replace("WITH ", "WITH RECURSIVE ", 1).rstrip() + f""",
{_KEYED},
p AS (SELECT *, row_number() OVER (PARTITION BY {_K} ORDER BY pkt_no) AS rn, {gap} AS gap_us, {fin_bit} AS fin,
  {rst_bit} AS rst FROM keyed),
f AS (
 SELECT {_K}, rn, pkt_no, ts_us AS start_us, ts_us AS last_us, fin AS nfin, 0::BIGINT AS flow_seq, rst AS done,
  pkt_no AS fst FROM p WHERE rn = 1
 UNION ALL
 SELECT {", ".join("x." + c for c in _K.split(", "))}, x.rn, x.pkt_no, CASE WHEN cut THEN ts_us ELSE start_us END, ts_us,
  CASE WHEN cut THEN fin ELSE nfin + fin END, flow_seq + CASE WHEN cut THEN 1 ELSE 0 END,
  rst OR (CASE WHEN cut THEN fin ELSE nfin + fin END) >= 2, CASE WHEN cut THEN pkt_no ELSE fst END
 FROM (SELECT p.*, f.start_us, f.nfin, f.flow_seq, f.fst,
         (f.done OR p.ts_us - f.last_us > p.gap_us OR p.ts_us - f.start_us > {active or never}) AS cut
       FROM f JOIN p ON {_on('p', 'f')} AND p.rn = f.rn + 1) x)
"""


_PKT = assigned() + """, q AS (
 SELECT p.*, f.flow_seq, f.fst, first_value(p.src_ip) OVER w AS s_ip, first_value(p.src_port) OVER w AS s_port,
  first_value(p.dst_ip) OVER w AS d_ip, first_value(p.dst_port) OVER w AS d_port,
  p.ts_us - lag(p.ts_us) OVER w AS gap
 FROM p JOIN f ON p.capture_id = f.capture_id AND p.pkt_no = f.pkt_no
 WINDOW w AS (PARTITION BY p.capture_id, p.lo_ip, p.lo_port, p.hi_ip, p.hi_port, p.protocol, f.flow_seq ORDER BY p.pkt_no)),
d AS (SELECT *, src_ip = s_ip AND src_port = s_port AS fwd FROM q),
e AS (SELECT *, ts_us - lag(ts_us) OVER (PARTITION BY capture_id, fst, fwd ORDER BY pkt_no) AS same FROM d),
bursts AS (SELECT *, ts_us - lag(ts_us) OVER (PARTITION BY capture_id, fst ORDER BY ts_us, pkt_no) AS pause FROM d),
numbered AS (SELECT *, sum(CASE WHEN pause > 3600000000 THEN 1 ELSE 0 END)
   OVER (PARTITION BY capture_id, fst ORDER BY ts_us, pkt_no) AS burst FROM bursts),
periods AS (
 SELECT capture_id, fst, 'active' AS kind, max(ts_us) - min(ts_us) AS us FROM numbered GROUP BY capture_id, fst, burst
  HAVING max(ts_us) > min(ts_us)
 UNION ALL SELECT capture_id, fst, 'idle', pause FROM numbered WHERE pause > 3600000000),
ai AS (SELECT capture_id, fst,
  avg(us) FILTER (kind = 'active') AS am, stddev_pop(us) FILTER (kind = 'active') AS asd,
  max(us) FILTER (kind = 'active') AS ax, min(us) FILTER (kind = 'active') AS an,
  avg(us) FILTER (kind = 'idle') AS im, stddev_pop(us) FILTER (kind = 'idle') AS isd,
  max(us) FILTER (kind = 'idle') AS ix, min(us) FILTER (kind = 'idle') AS inn FROM periods GROUP BY capture_id, fst)
"""


def _stat(value: str, where: str, prefix: str) -> list[tuple[str, str]]:
    return [
        (f"{prefix}_{n}", f"coalesce({fn}({value}) FILTER ({where}), 0)")
        for n, fn in (("max", "max"), ("min", "min"), ("mean", "avg"), ("std", "stddev_pop"))
    ]


_BASE = [
    ("capture_id", "capture_id"), ("fst", "fst"), ("flow_seq", "max(flow_seq)"),
    ("dur", "greatest(0, arg_max(ts_us, pkt_no) - arg_min(ts_us, pkt_no))"),
    ("fwd_pkts", "count(*) FILTER (fwd)"), ("bwd_pkts", "count(*) FILTER (NOT fwd)"), ("n", "count(*)"),
    ("dport", "max(d_port)"), ("sport", "max(s_port)"), ("sip", "max(s_ip)"), ("dip", "max(d_ip)"), ("proto", "max(protocol)"),
]
_LENGTHS = [
    ("fwd_bytes", "coalesce(sum(payload_len) FILTER (fwd), 0)"), ("bwd_bytes", "coalesce(sum(payload_len) FILTER (NOT fwd), 0)"),
    *_stat("payload_len", "fwd", "fwd_len"), *_stat("payload_len", "NOT fwd", "bwd_len"), *_stat("payload_len", "true", "len"),
    ("len_var", "coalesce(var_pop(payload_len), 0)"),
]
_IAT = [
    *_stat("gap", "true", "iat"),
    ("fwd_iat_total", "coalesce(sum(same) FILTER (fwd), 0)"), *_stat("same", "fwd", "fwd_iat"),
    ("bwd_iat_total", "coalesce(sum(same) FILTER (NOT fwd), 0)"), *_stat("same", "NOT fwd", "bwd_iat"),
]
_FLAGS = [("fwd_psh", "coalesce(sum(CASE WHEN flags & 8 > 0 THEN 1 ELSE 0 END) FILTER (fwd), 0)")] + [
    (f"{n}_cnt", f"sum(CASE WHEN flags & {b} > 0 THEN 1 ELSE 0 END)")
    for n, b in (("fin", 1), ("syn", 2), ("psh", 8), ("ack", 16), ("urg", 32))
]
_HEADERS = [
    ("fwd_header", "coalesce(sum(header_len) FILTER (fwd), 0)"), ("bwd_header", "coalesce(sum(header_len) FILTER (NOT fwd), 0)"),
    ("init_win_fwd", "coalesce(arg_min(win, pkt_no) FILTER (fwd), -1)"),
    ("init_win_bwd", "coalesce(arg_min(win, pkt_no) FILTER (NOT fwd), -1)"),
    ("act_data_fwd", "count(*) FILTER (fwd AND payload_len > 0)"),
    ("min_seg_fwd", "coalesce(min(header_len) FILTER (fwd), 20)"),
]
_DUR_S = "(CASE WHEN dur > 0 THEN dur / 1e6::DOUBLE ELSE 1e-6::DOUBLE END)"
_DERIVED = {
    "bytes_s": f"(fwd_bytes + bwd_bytes) / {_DUR_S}", "pkts_s": f"n / {_DUR_S}", "fwd_pkts_s": f"fwd_pkts / {_DUR_S}",
    "bwd_pkts_s": f"bwd_pkts / {_DUR_S}", "down_up": "CASE WHEN fwd_pkts > 0 THEN bwd_pkts / fwd_pkts ELSE 0 END",
    "avg_size": "(fwd_bytes + bwd_bytes) / n", "Destination_Port": "dport",
    "active_mean": "coalesce(am, dur)", "active_std": "coalesce(asd, 0)", "active_max": "coalesce(ax, dur)",
    "active_min": "coalesce(an, dur)", "idle_mean": "coalesce(im, 0)", "idle_std": "coalesce(isd, 0)",
    "idle_max": "coalesce(ix, 0)", "idle_min": "coalesce(inn, 0)",
}
_ID = "capture_id, fst AS flow_start"


def _flow_rows(*groups: list) -> str:
    cols = ", ".join(f"{expr} AS {name}" for g in (_BASE, *groups) for name, expr in g)
    return _PKT + f", g AS (SELECT {cols} FROM e GROUP BY capture_id, fst)\n"


def _digits(short: str) -> int:
    """Times are in microseconds and reach 1e11: whole ones. Everything else to four digits."""
    return 0 if "iat" in short or short.startswith(("active_", "idle_")) else 4


def _value(short: str) -> str:
    return f"round(cast({_DERIVED.get(short, short)} AS DOUBLE), {_digits(short)}) + 0.0"


def _num(names: list[str]) -> str:
    return ", ".join(f"{_value(n)} AS {n}" for n in names)


def _block_sql(names: list[str], *groups: list, bursts: bool = False) -> str:
    joined = "g LEFT JOIN ai USING (capture_id, fst)" if bursts else "g"
    return _flow_rows(*groups) + f"SELECT {_ID}, {_num(names)} FROM {joined}"


# ---- packets -----------------------------------------------------------------------------------


@query("packet_filter", duck("frames") + "SELECT capture_id, order_no, line_no, protocol FROM frames WHERE protocol IN (6, 17)")
def packet_filter(spark, sf):
    return fl.keep_transport(view(spark, sf, "frames")).select("capture_id", "order_no", "line_no", "protocol")


@query("packet_lengths", duck("frames") + """SELECT order_no, line_no, protocol, frame_len,
 CASE WHEN ip_version = 4 THEN ihl * 4 ELSE 40 END AS ip_header_len,
 CASE WHEN protocol = 17 THEN 8 WHEN data_offset > 0 THEN data_offset * 4 ELSE 20 END AS header_len,
 greatest(0, frame_len - CASE WHEN ip_version = 4 THEN ihl * 4 ELSE 40 END
   - CASE WHEN protocol = 17 THEN 8 WHEN data_offset > 0 THEN data_offset * 4 ELSE 20 END) AS payload_len
FROM frames WHERE protocol IN (6, 17)""")
def packet_lengths(spark, sf):
    out = fl.header_lengths(fl.keep_transport(view(spark, sf, "frames")))
    return out.select("order_no", "line_no", "protocol", "frame_len", "ip_header_len", "header_len", "payload_len")


@query("tcp_flag_decode", duck("frames") + """SELECT order_no, line_no, flags, """ + ", ".join(
    f"CASE WHEN flags & {b} > 0 THEN 1 ELSE 0 END AS {n}"
    for n, b in (("fin", 1), ("syn", 2), ("rst", 4), ("psh", 8), ("ack", 16), ("urg", 32))
) + " FROM frames WHERE protocol = 6")
def tcp_flag_decode(spark, sf):
    tcp = view(spark, sf, "frames").where(F.col("protocol") == fl.TCP)
    return fl.decode_flags(tcp).select("order_no", "line_no", "flags", "fin", "syn", "rst", "psh", "ack", "urg")


@query("packet_cap_truncation", duck("packets") + """SELECT capture_id, least(count(*), 1500) AS packets_processed,
 count(*) > 1500 AS was_truncated FROM packets GROUP BY capture_id""")
def packet_cap_truncation(spark, sf):
    return sampling.truncation(view(spark, sf, "packets"), 1500)


@query("packet_cap_rows", duck("packets") + """SELECT capture_id, pkt_no FROM (SELECT *, row_number() OVER
 (PARTITION BY capture_id ORDER BY pkt_no) AS rn FROM packets) WHERE rn <= 1500""")
def packet_cap_rows(spark, sf):
    return sampling.first_packets(view(spark, sf, "packets"), 1500, bucket=512).select("capture_id", "pkt_no")


# ---- flows -------------------------------------------------------------------------------------


@query("canonical_flow_key", duck("packets").rstrip() + f", {_KEYED} SELECT {_K}, pkt_no, CASE WHEN low THEN 0 ELSE 1 END AS dir FROM keyed")
def canonical_flow_key(spark, sf):
    return fl.with_key(view(spark, sf, "packets")).select(*fl.KEY, "pkt_no", "dir")


@query("conversation_rollup", duck("packets").rstrip() + f""", {_KEYED} SELECT {_K}, count(*) AS packets,
 cast(sum(payload_len) AS BIGINT) AS bytes, min(ts_us) AS first_us, max(ts_us) AS last_us FROM keyed GROUP BY {_K}""")
def conversation_rollup(spark, sf):
    return fl.conversation_rollup(view(spark, sf, "packets"))


def _seq(cfg: fl.FlowConfig):
    return lambda spark, sf: fl.assign_flows(view(spark, sf, "packets"), cfg).select("capture_id", "pkt_no", "flow_seq")


_SEQ = "SELECT capture_id, pkt_no, flow_seq FROM f"
query("idle_sessions", assigned(udp=CFG.idle_us, active=None, rst=False, fin=False) + _SEQ)(
    _seq(CFG.only(idle_us=CFG.idle_us, udp_us=CFG.idle_us)))
query("idle_sessions_udp", assigned(active=None, rst=False, fin=False) + _SEQ)(
    _seq(CFG.only(idle_us=CFG.idle_us, udp_us=CFG.udp_us)))
query("active_timeout_split", assigned(idle=None, udp=None, rst=False, fin=False) + _SEQ)(
    _seq(CFG.only(active_us=CFG.active_us)))
query("rst_split", assigned(idle=None, udp=None, active=None, fin=False) + _SEQ)(_seq(CFG.only(use_rst=True)))
query("fin_split", assigned(idle=None, udp=None, active=None, rst=False) + _SEQ)(_seq(CFG.only(use_fin=True)))
query("assign_flows", assigned() + _SEQ)(_seq(CFG))
query("assign_flows_split_keys", assigned() + _SEQ)(_seq(SPLIT_CFG))


@query("flow_generation", assigned() + f"SELECT {_K}, max(flow_seq) + 1 AS generations, count(*) AS packets FROM f GROUP BY {_K}")
def flow_generation(spark, sf):
    return fl.assign_flows(view(spark, sf, "packets"), CFG).groupBy(*fl.KEY).agg(
        (F.max("flow_seq") + 1).alias("generations"), F.count(F.lit(1)).alias("packets"))


@query("flow_direction", _PKT + "SELECT capture_id, pkt_no, fst AS flow_start, fwd AS is_fwd FROM d")
def flow_direction(spark, sf):
    return fl.assign_flows(view(spark, sf, "packets"), CFG).select("capture_id", "pkt_no", "flow_start", "is_fwd")


# ---- features ----------------------------------------------------------------------------------


def _round(value, short: str):
    return F.round(value.cast("double"), _digits(short)) + F.lit(0.0)


def _all_features(spark, sf, cfg):
    return rounded_features(fx.flow_features(view(spark, sf, "packets"), cfg))


def rounded_features(flows):
    return flows.withColumns({name: _round(F.col(f"`{name}`"), short) for name, short in fx.SHORT_NAMES.items()})


def _block(names: list[str], blocks: list[str], bursts: bool = False):
    def run(spark, sf):
        flows = fx.flow_table(view(spark, sf, "packets"), CFG, blocks, bursts)
        return flows.select("capture_id", "flow_start", *[_round(F.col(n), n).alias(n) for n in names])

    return run


_LEN_NAMES = [n for n, _ in _LENGTHS] + ["avg_size"]
query("flow_length_stats", _block_sql(_LEN_NAMES, _LENGTHS))(_block(_LEN_NAMES, ["lengths"]))
_RATE_NAMES = ["dur", "bytes_s", "pkts_s", "fwd_pkts_s", "bwd_pkts_s"]
query("flow_rates", _block_sql(_RATE_NAMES, _LENGTHS))(_block(_RATE_NAMES, ["lengths"]))
_IAT_NAMES = [n for n, _ in _IAT]
query("flow_iat_stats", _block_sql(_IAT_NAMES, _IAT))(_block(_IAT_NAMES, ["iat"]))
_FLAG_NAMES = [n for n, _ in _FLAGS]
query("flow_flag_counts", _block_sql(_FLAG_NAMES, _FLAGS))(_block(_FLAG_NAMES, ["flags"]))
_HEADER_NAMES = [n for n, _ in _HEADERS]
query("flow_header_stats", _block_sql(_HEADER_NAMES, _HEADERS))(_block(_HEADER_NAMES, ["headers"]))
_RATIO_NAMES = ["down_up", "fwd_pkts", "fwd_bytes", "bwd_pkts", "bwd_bytes"]
query("flow_ratios", _block_sql(_RATIO_NAMES, _LENGTHS))(_block(_RATIO_NAMES, ["lengths"]))
_BURST_NAMES = [f"{a}_{b}" for a in ("active", "idle") for b in ("mean", "std", "max", "min")]
query("active_idle_summary", _block_sql(_BURST_NAMES, bursts=True))(_block(_BURST_NAMES, [], True))


@query("active_idle_periods", _PKT + "SELECT capture_id, fst AS flow_start, kind, us FROM periods")
def active_idle_periods(spark, sf):
    return fx.active_idle_periods(view(spark, sf, "packets"), CFG)


_ALL_SQL = _flow_rows(_LENGTHS, _IAT, _FLAGS, _HEADERS) + """SELECT capture_id, fst AS flow_start, flow_seq, sip AS "Source_IP", dip AS "Destination_IP",
 sport AS "Source_Port", dport AS "Destination_Port", CASE proto WHEN 6 THEN 'TCP' WHEN 17 THEN 'UDP' ELSE cast(proto AS VARCHAR) END AS "Protocol",
 n AS "Packets", cast(fwd_bytes + bwd_bytes AS BIGINT) AS "Bytes", """ + ", ".join(
    f'{_value(short)} AS "{name}"' for name, short in fx.SHORT_NAMES.items()
) + " FROM g LEFT JOIN ai USING (capture_id, fst)"


@query("flow_features_65", _ALL_SQL)
def flow_features_65(spark, sf):
    return _all_features(spark, sf, CFG)


@query("flow_features_split_keys", _ALL_SQL)
def flow_features_split_keys(spark, sf):
    return _all_features(spark, sf, SPLIT_CFG)


@query("flow_metadata", _flow_rows(_LENGTHS) + """SELECT capture_id, flow_seq, sip AS source_ip, dip AS destination_ip,
 sport AS source_port, dport AS destination_port, CASE proto WHEN 6 THEN 'TCP' WHEN 17 THEN 'UDP' END AS protocol,
 n AS packets, cast(fwd_bytes + bwd_bytes AS BIGINT) AS bytes FROM g""")
def flow_metadata(spark, sf):
    flows = fx.flow_table(view(spark, sf, "packets"), CFG, ["lengths"], False)
    return flows.select("capture_id", "flow_seq", *[F.col(c).alias(c.lower()) for c in fx.META])


@query("extraction_summary", assigned() + """SELECT capture_id, count(*) AS packets_processed,
 count(DISTINCT fst) AS flows_extracted, false AS was_truncated, cast(NULL AS BIGINT) AS max_packets FROM f GROUP BY capture_id""")
def extraction_summary(spark, sf):
    packets = view(spark, sf, "packets")
    return fx.extraction_summary(packets, fx.flow_table(packets, CFG, [], False))
