import math

from flowspark.functions.schema import ALIASES, FEATURES, canonical_name
from flowspark.operators import features as fx
from flowspark.operators.flows import FlowConfig


def test_names():
    assert len(FEATURES) == len(set(FEATURES)) == 65
    assert len(ALIASES) == 136 and len(set(ALIASES.values())) == 66
    assert canonical_name(" Dst Port ") == "Destination Port"
    assert canonical_name("Flow_Bytes/s") == "Flow Bytes/s"
    assert canonical_name("total_length_of_fwd_packets") == "Total Length of Fwd Packets"
    assert canonical_name(" Mystery ") == "Mystery"


def test_five_packets_by_hand(make_packets):
    packets = make_packets(
        (10.0, True, 2, dict(len=0, hdr=40, win=500)), (10.2, False, 18, dict(len=0, hdr=32, win=700)),
        (10.3, True, 24, dict(len=100, hdr=20)), (12.3, True, 24, dict(len=300, hdr=24)), (12.4, False, 16, dict(len=50, hdr=20)),
    )
    got = fx.flow_features(packets).first().asDict()
    want = {
        "Destination Port": 80, "Flow Duration": 2_400_000, "Total Fwd Packets": 3, "Total Backward Packets": 2,
        "Total Length of Fwd Packets": 400, "Total Length of Bwd Packets": 50,
        "Fwd Packet Length Max": 300, "Fwd Packet Length Min": 0, "Fwd Packet Length Mean": 400 / 3,
        "Fwd Packet Length Std": math.sqrt(100_000 / 3 - (400 / 3) ** 2),
        "Bwd Packet Length Max": 50, "Bwd Packet Length Min": 0, "Bwd Packet Length Mean": 25, "Bwd Packet Length Std": 25,
        "Flow Bytes/s": 450 / 2.4, "Flow Packets/s": 5 / 2.4,
        "Flow IAT Mean": 600_000, "Flow IAT Std": math.sqrt((200**2 + 100**2 + 2000**2 + 100**2) / 4 - 600**2) * 1000,
        "Flow IAT Max": 2_000_000, "Flow IAT Min": 100_000,
        "Fwd IAT Total": 2_300_000, "Fwd IAT Mean": 1_150_000, "Fwd IAT Std": 850_000, "Fwd IAT Max": 2_000_000, "Fwd IAT Min": 300_000,
        "Bwd IAT Total": 2_200_000, "Bwd IAT Mean": 2_200_000, "Bwd IAT Std": 0, "Bwd IAT Max": 2_200_000, "Bwd IAT Min": 2_200_000,
        "Fwd PSH Flags": 2, "Fwd Header Length": 84, "Bwd Header Length": 52, "Fwd Packets/s": 3 / 2.4, "Bwd Packets/s": 2 / 2.4,
        "Min Packet Length": 0, "Max Packet Length": 300, "Packet Length Mean": 90,
        "Packet Length Std": math.sqrt(102_500 / 5 - 90**2), "Packet Length Variance": 102_500 / 5 - 90**2,
        "FIN Flag Count": 0, "SYN Flag Count": 2, "PSH Flag Count": 2, "ACK Flag Count": 4, "URG Flag Count": 0,
        "Down/Up Ratio": 2 / 3, "Average Packet Size": 90, "Avg Fwd Segment Size": 400 / 3, "Avg Bwd Segment Size": 25,
        "Subflow Fwd Packets": 3, "Subflow Fwd Bytes": 400, "Subflow Bwd Packets": 2, "Subflow Bwd Bytes": 50,
        "Init_Win_bytes_forward": 500, "Init_Win_bytes_backward": 700, "act_data_pkt_fwd": 2, "min_seg_size_forward": 20,
        "Active Mean": 200_000, "Active Std": 100_000, "Active Max": 300_000, "Active Min": 100_000,
        "Idle Mean": 2_000_000, "Idle Std": 0, "Idle Max": 2_000_000, "Idle Min": 2_000_000,
    }
    assert set(want) == set(FEATURES)
    assert {k: v for k, v in want.items() if not math.isclose(got[k], v, rel_tol=1e-9, abs_tol=1e-6)} == {}
    assert (got["Source_IP"], got["Destination_Port"], got["Protocol"], got["Packets"], got["Bytes"]) == ("10.0.0.1", 80, "TCP", 5, 450)


def test_one_packet_and_no_answer(make_packets):
    got = fx.flow_features(make_packets((1.0, True, 2))).first()
    assert got["Flow Duration"] == 0 and got["Bwd Packet Length Max"] == 0 and got["Init_Win_bytes_backward"] == -1
    assert got["Flow Packets/s"] == 1e6 and got["Active Mean"] == 0 and got["Idle Max"] == 0


def test_bursts(make_packets):
    packets = make_packets(*[(t, True, 0) for t in (1.0, 1.1, 1.2, 5.0, 5.1, 10.0, 10.1)])
    rows = fx.active_idle_periods(packets).collect()
    assert sorted(r.us for r in rows if r.kind == "active") == [100_000, 100_000, 200_000]
    assert sorted(r.us for r in rows if r.kind == "idle") == [3_800_000, 4_900_000]


def test_bursts_sort_by_time(make_packets):
    packets = make_packets((3.0, True, 0), (1.0, True, 0), (3.5, True, 0), (1.4, True, 0))
    got = fx.flow_features(packets, FlowConfig()).first()
    assert (got["Active Max"], got["Active Min"], got["Idle Mean"]) == (500_000, 400_000, 1_600_000)
    assert got["Flow IAT Min"] == -2_100_000 and got["Flow Duration"] == 0
