import pytest
from pyspark.sql import functions as F

from flowspark.functions.schema import FEATURES
from flowspark.operators import labels, normalize as nz, sampling
from flowspark.sources import tables


def test_normalize_keeps_the_first_of_duplicates(spark):
    df = spark.createDataFrame([("1", "2", "x")], "` Dst Port` string, `Destination Port` string, Label string")
    out = nz.normalize(df)
    assert out.columns == ["Destination Port", "Label"] and out.first()["Destination Port"] == "1"


def test_matrix_cleans_numbers(spark):
    df = spark.createDataFrame([("inf", " 5 "), ("abc", "NaN"), (None, "-inf")], "dport string, duration string")
    rows = nz.feature_matrix(df).collect()
    assert [r["Destination Port"] for r in rows] == [0, 0, 0] and [r["Flow Duration"] for r in rows] == [5, 0, 0]
    assert len(rows[0]) == 65


def test_schema_check(spark):
    half = spark.createDataFrame([tuple([1.0] * 33)], ", ".join(f"`{c}` double" for c in FEATURES[:33]))
    assert len(nz.check_schema(half, strict=False)) == 32
    with pytest.raises(ValueError):
        nz.check_schema(half, strict=True)
    with pytest.raises(ValueError):
        nz.feature_matrix(half.select(f"`{FEATURES[0]}`"), strict=True)


def test_label_rules_differ_where_they_should(spark):
    raw = [" BENIGN ", "benign", "DoS Hulk", "Web Attack – XSS", "Weird", None]
    df = spark.createDataFrame([(r,) for r in raw], "raw string")
    exact = [(r.binary_label, r.attack_category) for r in labels.exact_label(df, "raw").collect()]
    assert exact[:5] == [("BENIGN", "Benign"), ("BENIGN", "Benign"), ("MALICIOUS", "DoS"), ("MALICIOUS", "Web Attack"),
                         ("MALICIOUS", "Other Attack")]
    loose = [r[0] for r in df.select(labels.substring_label(F.col("raw"))).collect()]
    assert loose[:5] == ["BENIGN", "Other Attack", "DoS", "Web Attack", "Other Attack"]


def test_truth_rules(spark):
    df = spark.createDataFrame([("1", None), (" 0 ", "BENIGN"), (None, "DDoS")], "Is_Malicious string, Label string")
    assert [r[0] for r in df.select(labels.benign_by_values("Is_Malicious")).collect()] == ["MALICIOUS", "BENIGN", "MALICIOUS"]
    assert [r[0] for r in df.drop("Is_Malicious").select(labels.truth_target(df.drop("Is_Malicious"))).collect()] == [1, 0, 1]
    with pytest.raises(ValueError):
        labels.truth_target(df.select(F.lit(1).alias("other")))


def skewed(spark, n=4000):
    return spark.range(n).select(
        F.col("id").alias("row_id"), F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("cls"))


def test_lowest_hashes_match_brute_force(spark):
    df = skewed(spark)
    got = {r.row_id for r in sampling.cap_per_class(df, ["cls"], 150, 7, "row_id").collect()}
    rows = df.withColumn("h", sampling.row_hash(7, "row_id")).collect()
    want = set()
    for c in {r.cls for r in rows}:
        want |= {r.row_id for r in sorted((r for r in rows if r.cls == c), key=lambda r: r.h)[:150]}
    assert got == want


def test_split_is_complete_and_stratified(spark):
    df = sampling.stratified_split(skewed(spark, 1003), ["cls"], 0.2, 0.1, 1, "row_id")
    counts = {(r.cls, r.split): r["count"] for r in df.groupBy("cls", "split").count().collect()}
    assert sum(counts.values()) == 1003 and df.select("row_id").distinct().count() == 1003
    for c in {c for c, _ in counts}:
        n = sum(v for (k, _), v in counts.items() if k == c)
        test = -(-n * 2 // 10)
        assert counts[c, "test"] == test and counts[c, "val"] == -(-(n - test) // 8)


def test_capture_split_does_not_leak(spark):
    df = spark.range(500).select(
        F.lit("d").alias("dataset"), F.concat(F.lit("cap"), F.col("id") % 23).alias("capture"), (F.col("id") % 23 % 2).alias("y"))
    split = sampling.capture_split(df, "dataset", "capture", "y", 0.2, 0.1, 1)
    assert split.count() == 500 and sampling.leaking_captures(split, ["capture"]).count() == 0
    assert split.select("split").distinct().count() == 3


def test_first_packets_per_capture(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 4 > 0, "big").otherwise("small").alias("capture_id"), F.col("id").alias("pkt_no"))
    got = sampling.first_packets(df, 120, bucket=64).groupBy("capture_id").agg(F.count("*").alias("n"), F.max("pkt_no").alias("m"))
    assert {r.capture_id: (r.n, r.m) for r in got.collect()} == {"big": (120, 159), "small": (120, 476)}


def test_mixed_encodings(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("Label,x\nWeb Attack – XSS,1\n".encode("utf-8"))
    (tmp_path / "b.csv").write_bytes("Label,x\ncaf\xe9,2\n".encode("latin-1"))
    rows = tables.scan_csv_any(spark, str(tmp_path)).collect()
    assert {r.x: r.Label for r in rows} == {"1": "Web Attack – XSS", "2": "café"}


def test_union_fills_missing_columns(spark):
    out = sampling.combine([spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([(2,)], "b int")])
    assert sorted(map(tuple, out.collect()), key=str) == [(1, None), (None, 2)]


def test_headers_in_another_order_meet_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Flow Duration,Flow Bytes/s\n1,2\n")
    (tmp_path / "b.csv").write_text("Flow Bytes/s,Flow Duration,Extra\n2,1,z\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "crlf.csv").write_bytes(b"\xef\xbb\xbfFlow Duration,Flow Bytes/s\r\n1,2\r\n")
    frames = tables.scan_by_header(spark, str(tmp_path))
    got = [(r["Flow Duration"], r["Flow Bytes/s"]) for f in frames for r in f.collect()]
    assert got == [("1", "2")] * 3
    rows = tables.scan_csv_any(spark, str(tmp_path), "[ab].csv").collect()
    assert sorted((r["Flow Duration"], r["Flow Bytes/s"], str(r["Extra"])) for r in rows) == [("1", "2", "None"), ("1", "2", "z")]


def test_missing_classes_are_capped_and_split(spark):
    rows = spark.range(600).select("id", F.when(F.col("id") < 100, "a").alias("c"))
    capped = sampling.cap_per_class(rows, ["c"], 10, 1, "id").groupBy("c").count().collect()
    assert {r.c: r["count"] for r in capped} == {"a": 10, None: 10}
    split = sampling.stratified_split(rows, ["c"], 0.2, 0.1, 1, "id").where("c IS NULL").groupBy("split").count().collect()
    assert {r.split: r["count"] for r in split} == {"test": 100, "val": 50, "train": 350}


@pytest.mark.parametrize(("column", "kind", "values", "want"), [
    ("Is_Malicious", "boolean", [True, False, None], [1, 0, 0]), ("Is_Malicious", "double", [1.0, 0.0, 2.0], [1, 0, 0]),
    ("Is_Malicious", "string", ["1", "x", None], [1, 0, 0]), ("Binary_Label", "string", ["malicious", "BENIGN", None], [1, 0, 0]),
    ("Expected_Verdict", "string", ["THREAT", "benign", None], [1, 0, 1]), ("Label", "string", ["DDoS", "BENIGN", None], [1, 0, 1]),
    ("label", "int", [3, 0, None], [1, 1, 1]),
])
def test_truth_by_type(spark, column, kind, values, want):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {column} {kind}")
    assert [r.t for r in df.select("i", labels.truth_target(df).alias("t")).orderBy("i").collect()] == want


def test_scratch_needs_a_shared_folder_off_local_masters(spark, monkeypatch):
    from types import SimpleNamespace

    from flowspark import session

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    far = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=context)
    with pytest.raises(RuntimeError):
        session.shared_dir(far)
    far.conf.get = lambda *a: "hdfs://x/y/"
    assert session.shared_dir(far) == "hdfs://x/y"
    far.conf.get, context.getCheckpointDir = (lambda *a: None), (lambda: "hdfs://z")
    assert session.shared_dir(far) == "hdfs://z"


def test_headers_of_a_small_table_are_dealt_over_tasks(spark):
    """4 million headers come from 40 000 rows in one file; no task holds more than a bounded part of them."""
    from flowspark.plans import views
    from flowspark.session import scratch_path

    sf = scratch_path(spark, "sf")
    spark.range(40_000).select(F.col("id").alias("p_partkey"), F.when(F.col("id") % 9 > 0, 50).alias("p_size")).coalesce(1).write.parquet(
        f"{sf}/part.parquet")
    headers = views.view(spark, sf, "headers")
    sizes = [r["count"] for r in headers.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 100 * sum(i % 9 > 0 for i in range(40_000)) and max(sizes) < 2 * views.TASK_ROWS
