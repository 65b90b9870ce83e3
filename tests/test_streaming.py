from carbonledger.streaming import ingest_drops

from .conftest import write_drops


def test_incremental_ingest_is_idempotent(spark, tmp_path):
    root, target = str(tmp_path / "drops"), str(tmp_path / "missions")
    missions, _ = write_drops(root)
    with open(f"{root}/DROP_OSLO/DROP_OSLO_MISSION/MISSION_20240503.txt", "a", encoding="utf-8") as f:
        f.write(" ;P1;N;P;2024-05-03 10:00:00;Conference;a;b;c;d;Train;non\n")  # no key
        f.write(" ;P2;N;P;2024-05-03 10:00:00;Conference;a;b;c;d;Train;non\n")  # no key, another row
        f.write("X1;P;N;P;yesterday;Conference;a;b;c;d;Train;non\n")  # malformed date
        f.write("X1;P;N;P;yesterday;Conference;a;b;c;d;Train;non\n")  # delivered twice
    n = len(missions) + 3
    ingest_drops(spark, root, "mission", target, str(tmp_path / "ck")).awaitTermination(300)
    first = spark.read.parquet(target)
    assert first.count() == n
    assert first.filter("_corrupt_record is not null").count() == 1
    # Same files again with a fresh checkpoint: the anti-join append adds nothing, rows without a key included.
    ingest_drops(spark, root, "mission", target, str(tmp_path / "ck2")).awaitTermination(300)
    assert spark.read.parquet(target).count() == n
