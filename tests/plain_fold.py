"""Flow assignment packet by packet, as the yardstick for the distributed versions."""


def fold(packets, idle, udp, active, use_rst=True, use_fin=True):
    """{(capture, pkt_no): (flow_seq, flow_start, is_fwd)} of packet tuples in capture order."""
    state, out = {}, {}
    for cap, no, ts, sip, dip, sport, dport, proto, _len, _hdr, flags, _win in sorted(packets, key=lambda p: (p[0], p[1])):
        ends = tuple(sorted([(sip, sport), (dip, dport)]))
        s = state.setdefault((cap, ends, proto), {"seq": -1, "open": False})
        limit = udp if proto == 17 else idle
        late = s["open"] and ((limit is not None and ts - s["last"] > limit)
                              or (active is not None and ts - s["start"] > active))
        if not s["open"] or late:
            s.update(seq=s["seq"] + 1, open=True, start=ts, fins=0, first=no, src=(sip, sport))
        s["last"] = ts
        s["fins"] += 1 if use_fin and flags & 1 else 0
        if (use_rst and flags & 4) or s["fins"] >= 2:
            s["open"] = False
        out[cap, no] = (s["seq"], s["first"], (sip, sport) == s["src"])
    return out
