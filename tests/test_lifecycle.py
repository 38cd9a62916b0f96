import pytest
from pyspark.sql import functions as F

from flowspark.functions.schema import FEATURES
from flowspark.plans import lifecycle
from test_captures import folder  # noqa: F401


@pytest.fixture
def csv_folder(tmp_path):
    head = " Dst Port,flow_duration,Flow Byts/s, Fwd Avg Bytes/Bulk, Label\n"
    (tmp_path / "a.csv").write_bytes((head + "80,5,inf,0,BENIGN\n443,7,1.5,0,DDoS\n").encode("cp1252"))
    (tmp_path / "b.csv").write_bytes((head + "22,9,2.5,0,Web Attack – XSS\n1,x,1,0,Bot\n25,1,1,0,DDoS\n").encode("cp1252"))
    return tmp_path


def test_labeled_csv(spark, csv_folder):
    df = lifecycle.load_labeled_csv(spark, str(csv_folder))
    got = {(r["Destination Port"], r["Flow Bytes/s"], r["Binary_Label"], r["Attack_Category"], r["Capture_ID"]) for r in df.collect()}
    assert got == {(443.0, 1.5, "MALICIOUS", "DDoS", "a.csv"), (22.0, 2.5, "MALICIOUS", "Web Attack", "b.csv"),
                   (25.0, 1.0, "MALICIOUS", "DDoS", "b.csv")}
    assert not [c for c in df.columns if "Bulk" in c]
    assert lifecycle.load_labeled_csv(spark, str(csv_folder), cap=1).groupBy("Original_Label").count().agg(F.max("count")).first()[0] == 1


def test_prelabeled_csv_and_missing_label(spark, tmp_path):
    (tmp_path / "p.csv").write_text("Flow Duration,Attack_Category\n1,BENIGN\n2,DoS\n")
    rows = lifecycle.load_labeled_csv(spark, str(tmp_path)).orderBy("`Flow Duration`").collect()
    assert [(r.Binary_Label, r.Attack_Category, r.Original_Label) for r in rows] == [("BENIGN", "Benign", "BENIGN"), ("MALICIOUS", "DoS", "DoS")]
    (tmp_path / "p.csv").write_text("Flow Duration\n1\n")
    with pytest.raises(ValueError):
        lifecycle.load_labeled_csv(spark, str(tmp_path))


def test_doh_captures_and_union(spark, folder, csv_folder, tmp_path):  # noqa: F811
    doh = str(tmp_path / "doh")
    spark.createDataFrame([(1.0, 2.0, "NonDoH"), (1.0, 2.0, "DoH")], "Duration double, PacketLengthMean double, Label string").write.parquet(
        f"{doh}/{lifecycle.DOH_LEVEL1}")
    spark.createDataFrame([(3.0, 4.0, "Malicious"), (3.0, 5.0, "Benign")], "Duration double, PacketLengthMean double, Label string").write.parquet(
        f"{doh}/{lifecycle.DOH_LEVEL2}")
    d = lifecycle.load_doh(spark, doh)
    assert sorted((r["Original_Label"], r["Binary_Label"], r["Flow Duration"], r["Flow Bytes/s"]) for r in d.collect()) == [
        ("Benign", "BENIGN", 3e6, 0.0), ("Malicious", "MALICIOUS", 3e6, 0.0), ("NonDoH", "BENIGN", 1e6, 0.0)]
    c = lifecycle.load_capture_flows(spark, folder)
    assert {(r.Capture_ID, r.Binary_Label, r.Specific_Family) for r in c.collect()} == {
        ("one.pcap", "MALICIOUS", "Zeus"), ("Gmail.pcapng", "BENIGN", "Gmail")}
    table = lifecycle.prepare([c, d, lifecycle.load_labeled_csv(spark, str(csv_folder))], str(tmp_path / "all"))
    assert table.groupBy("Dataset").count().count() == 3 and set(FEATURES) <= set(table.columns)


def test_evaluate(spark):
    rows = [("d1", "MALICIOUS", "MALICIOUS", 90.0), ("d1", "BENIGN", "MALICIOUS", 70.0), ("d1", "BENIGN", "BENIGN", 10.0), ("d2", "BENIGN", "BENIGN", 1.0)]
    df = spark.createDataFrame(rows, "Dataset string, Binary_Label string, Predicted_Verdict string, `Threat_Confidence_%` double")
    got = {r.Dataset: r for r in lifecycle.evaluate(df, ["Dataset"]).collect()}
    assert (got["d1"].precision, got["d1"].recall, got["d1"].fpr, got["d1"].roc_auc, got["d1"].average_precision) == (0.5, 1.0, 0.5, 1.0, 1.0)
    assert got["d2"].roc_auc is None and got["d2"].accuracy == 1.0
    assert lifecycle.evaluate(df).first().total == 4 and lifecycle.evaluate(df, ["Dataset"], {"Dataset": ["d2"]}).count() == 1


def flow_rows(df):
    return sorted((r.Capture_ID, r.Specific_Family, r["Flow Duration"], r["Total Fwd Packets"]) for r in df.collect())


@pytest.fixture
def extracted(monkeypatch):
    """Names of the captures that are read, in calls."""
    calls, keep = [], lifecycle.captures.read_captures

    def watched(spark, found, *more):
        calls.append(sorted(r.path.rsplit("/", 1)[-1] for r in found.select("path").collect()))
        return keep(spark, found, *more)

    monkeypatch.setattr(lifecycle.captures, "read_captures", watched)
    return calls


def test_store_reads_each_capture_once(spark, folder, tmp_path, extracted):  # noqa: F811
    import shutil

    root, store = str(tmp_path / "caps"), str(tmp_path / "store")
    shutil.copytree(folder, root)
    plain = flow_rows(lifecycle.load_capture_flows(spark, root))
    extracted.clear()
    assert flow_rows(lifecycle.load_capture_flows(spark, root, store=store)) == plain
    assert flow_rows(lifecycle.load_capture_flows(spark, root, store=store)) == plain
    assert extracted == [["Gmail.pcapng", "one.pcap"]]
    shutil.copy(f"{root}/Malware/Zeus/one.pcap", f"{root}/Malware/Zeus/two.pcap")
    assert len(flow_rows(lifecycle.load_capture_flows(spark, root, store=store))) == len(plain) + 3 - 3 + sum(r[0] == "one.pcap" for r in plain)
    assert extracted[1:] == [["two.pcap"]]
    assert flow_rows(lifecycle.load_capture_flows(spark, root, store=store, exclude=["Zeus"])) == [r for r in plain if r[0] == "Gmail.pcapng"]
    assert len(extracted) == 2


@pytest.mark.parametrize("rule", [dict(idle_us=5), dict(active_us=7), dict(udp_us=3), dict(use_rst=False), dict(use_fin=False), dict(burst_us=1)])
def test_every_rule_is_part_of_the_ledger(spark, folder, rule):  # noqa: F811
    from dataclasses import replace

    cfg = lifecycle.FlowConfig()
    keys = {lifecycle.captures.config_key(c) for c in (cfg, replace(cfg, **rule))} | {lifecycle.captures.config_key(cfg, 5), lifecycle.captures.config_key(cfg, None, "ip")}
    assert len(keys) == 4
    assert lifecycle.captures.config_key(replace(cfg, heavy_packets=3, fan_in=2)) == lifecycle.captures.config_key(cfg)


def test_changed_timeouts_extract_again_through_the_loader(spark, folder, tmp_path, extracted):  # noqa: F811
    store, cfg = str(tmp_path / "store"), lifecycle.FlowConfig()
    short = lifecycle.FlowConfig(idle_us=500_000, udp_us=500_000)
    first = flow_rows(lifecycle.load_capture_flows(spark, folder, cfg, store=store))
    other = flow_rows(lifecycle.load_capture_flows(spark, folder, short, store=store))
    assert len(other) > len(first) and len(extracted) == 2
    assert flow_rows(lifecycle.load_capture_flows(spark, folder, cfg, store=store)) == first
    assert flow_rows(lifecycle.load_capture_flows(spark, folder, short, store=store)) == other and len(extracted) == 2
    done = lifecycle.CaptureStore(spark, store).manifest()
    assert lifecycle.load_capture_flows(spark, folder, cfg, done=done).count() == 0
    assert lifecycle.load_capture_flows(spark, folder, lifecycle.FlowConfig(active_us=1), done=done).count() > 0


def test_a_run_that_stops_before_its_manifest_is_done_again(spark, folder, tmp_path, monkeypatch, extracted):  # noqa: F811
    store = str(tmp_path / "store")
    keep = lifecycle.materialize

    def stops(df, name):
        if name == "bad":
            raise KeyboardInterrupt
        return keep(df, name)

    monkeypatch.setattr(lifecycle, "materialize", stops)
    with pytest.raises(KeyboardInterrupt):
        lifecycle.load_capture_flows(spark, folder, store=store)
    monkeypatch.setattr(lifecycle, "materialize", keep)
    assert (tmp_path / "store" / "flows").exists() and lifecycle.CaptureStore(spark, store).manifest().count() == 0
    want = flow_rows(lifecycle.load_capture_flows(spark, folder))
    assert flow_rows(lifecycle.load_capture_flows(spark, folder, store=store)) == want
    assert flow_rows(lifecycle.load_capture_flows(spark, folder, store=store)) == want
    assert len(extracted) == 3 and len(list((tmp_path / "store" / "flows").iterdir())) == 1


def test_store_sets_bad_captures_aside_and_tries_them_again(spark, folder, tmp_path, extracted):  # noqa: F811
    import shutil

    root, store = tmp_path / "caps", str(tmp_path / "store")
    shutil.copytree(folder, root)
    (root / "Benign" / "late.pcap").write_bytes(b"")
    want = flow_rows(lifecycle.load_capture_flows(spark, folder))
    assert flow_rows(lifecycle.load_capture_flows(spark, str(root), store=store)) == want
    assert [(r.path.rsplit("/", 1)[-1], r.bad_at) for r in lifecycle.CaptureStore(spark, store).bad().collect()] == [("late.pcap", 0)]
    shutil.copy(root / "Malware" / "Zeus" / "one.pcap", root / "Benign" / "late.pcap")
    assert len(flow_rows(lifecycle.load_capture_flows(spark, str(root), store=store))) > len(want)
    assert extracted[-1] == ["late.pcap"]
