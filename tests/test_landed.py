"""Quoted line feeds, the data sources of landed files, and archives issued again."""
import csv
import io
import os
import random
import time
import zipfile

import pytest

from claimlake import schemas as S
from claimlake.plans.ingest import ingest, read_ingested
from claimlake.plans.jobs import ingest_all
from claimlake.sources.archives import CSV_GLOB, scan_zip_csv
from claimlake.sources.landed import read_records
from claimlake.streaming.reissued import run_reissued_ingest

RAW2 = S.raw_struct([("A", "string"), ("B", "string")])
TABLE = "prescription_drug_events"
COLS = [n for n, _ in S.DRUG_EVENTS]


def _text(rows, header=("A", "B"), end="\n"):
    out = io.StringIO()
    w = csv.writer(out, lineterminator=end)
    w.writerow(header)
    w.writerows(rows)
    return out.getvalue()


def _rows(seed, n=400):
    rng = random.Random(seed)
    return [(f"k{i}", "".join(rng.choice(["x", "\n", '"', ",", "y z", "\n\n", 'q"']) for _ in range(rng.randint(1, 12))).strip() or "v") for i in range(n)]


def _got(df):
    return sorted((r.A, r.B) for r in df.collect())


@pytest.mark.parametrize("block,span", [(7, 13), (64, 100), (1000, 333), (1 << 20, 1 << 27)])
def test_quoted_line_feeds_at_every_block_and_range(spark, tmp_dir, block, span):
    rows = _rows(block)
    with open(os.path.join(tmp_dir, "a.csv"), "w", newline="") as f:
        f.write(_text(rows[:200]))
    with open(os.path.join(tmp_dir, "b.csv"), "w", newline="") as f:
        f.write(_text(rows[200:300]).rstrip("\n"))  # no line end at the end of the file
    with open(os.path.join(tmp_dir, "c.csv"), "w", newline="") as f:
        f.write(_text([(b, a) for a, b in rows[300:]], ("b", "a")))  # other order of columns
    got = scan_zip_csv(spark, tmp_dir, RAW2, glob=CSV_GLOB, multiline=True, block_bytes=block, range_bytes=span)
    assert _got(got) == sorted(rows)
    assert got.where("_corrupt_record IS NOT NULL").count() == 0


def test_quoted_line_feeds_in_archives_and_by_the_data_source(spark, tmp_dir):
    rows = _rows(5)
    for k in range(4):
        with zipfile.ZipFile(os.path.join(tmp_dir, f"{k}.zip"), "w") as z:
            z.writestr("m.csv", _text(rows[100 * k:100 * k + 100], end="\r\n"))
    want = sorted((a, b.replace("\n", "\n")) for a, b in rows)
    assert _got(scan_zip_csv(spark, tmp_dir, RAW2, multiline=True, block_bytes=50)) == want
    assert _got(read_records(spark, tmp_dir, ["A", "B"], multiline="true", blockBytes=50)) == want


def test_a_file_whose_quotes_do_not_balance_is_read_line_by_line(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "bad.csv"), "w") as f:
        f.write('A,B\n1,"one\n2,two\n3,three\n')
    with open(os.path.join(tmp_dir, "good.csv"), "w") as f:
        f.write('A,B\n4,"fo\nur"\n')
    got = scan_zip_csv(spark, tmp_dir, RAW2, glob=CSV_GLOB, multiline=True, range_bytes=5).collect()
    assert sorted((r.A, r.B) for r in got if r._corrupt_record is None) == [("2", "two"), ("3", "three"), ("4", "fo\nur")]
    assert len(got) == 4


def test_a_record_may_not_grow_without_end(spark, tmp_dir, monkeypatch):
    from claimlake.sources import archives
    monkeypatch.setattr(archives, "MAX_RECORD_BYTES", 1000)
    reader = archives.RecordReader(("A", "B"), block_bytes=100, multiline=True)
    path = os.path.join(tmp_dir, "x.csv")
    with open(path, "w") as f:
        f.write('A,B\n1,"' + "x\n" * 2000 + '"\n')
    with pytest.raises(ValueError, match="over 1000 bytes"):
        list(reader.read(path, 0, False, True))


def test_data_source_reads_ranges_and_names_a_missing_column(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "a.csv"), "w") as f:
        f.write("b,A\n" + "".join(f"{i * i},{i}\n" for i in range(500)))
    got = read_records(spark, tmp_dir, ["A", "B"], glob=CSV_GLOB, rangeBytes=64, blockBytes=40)
    assert sorted((int(r.A), int(r.B)) for r in got.collect()) == [(i, i * i) for i in range(500)]
    with pytest.raises(Exception, match="columns missing"):
        read_records(spark, tmp_dir, ["A", "C"], glob=CSV_GLOB).collect()
    with pytest.raises(Exception, match="needs the option log"):
        read_records(spark, tmp_dir, ["A"], stream=True).writeStream.format("noop").option("checkpointLocation", tmp_dir + "/ck").trigger(availableNow=True).start().awaitTermination()


def test_session_credentials_reach_the_store(spark, monkeypatch):
    import pyarrow.fs as pafs

    from claimlake.sources import archives, landed
    for k, v in {"access.key": "AK", "secret.key": "SK", "endpoint": "http://store:9000"}.items():
        spark.conf.set(f"spark.hadoop.fs.s3a.{k}", v)
    try:
        found = archives.storage_options(spark)
        assert found == {"access_key": "AK", "secret_key": "SK", "endpoint_override": "http://store:9000"}
        asked = {}
        monkeypatch.setattr(pafs, "S3FileSystem", lambda **kw: asked.update(kw) or "fs")
        opts = landed._Options({"path": "s3a://bucket/in", "columns": "A", **landed.source_options(spark)})
        assert archives.arrow_fs(opts.path, opts.reader.storage) == ("fs", "bucket/in") and asked == found
    finally:
        for k in ("access.key", "secret.key", "endpoint"):
            spark.conf.unset(f"spark.hadoop.fs.s3a.{k}")


# files of one name, and files issued again -------------------------------------------

def _drop(folder, name, ids, cost=1.0, ext="zip"):
    os.makedirs(folder, exist_ok=True)
    body = "\n".join([",".join(COLS)] + [f"P{i},{i},20090101,{i},30,30,0.5,{cost}" for i in ids]) + "\n"
    path = os.path.join(folder, f"{name}.{ext}")
    if ext == "csv":
        with open(path, "w") as f:
            f.write(body)
    else:
        with zipfile.ZipFile(path, "w") as z:
            z.writestr(f"{name}.csv", body)
    return path


def _lake(spark, path):
    return sorted((r.PDE_ID, r.TOT_RX_CST_AMT) for r in read_ingested(spark, path, TABLE).collect())


def test_files_of_one_name_in_two_folders(spark, tmp_dir):
    landing, name = os.path.join(tmp_dir, "landing"), "DE1_0_2008_to_2010_Prescription_Drug_Events_Sample_1"
    _drop(f"{landing}/2024-01", name, range(3), ext="csv")
    _drop(f"{landing}/2024-02", name, range(3, 8), ext="csv")
    want = [(i, 1.0) for i in range(8)]
    one = os.path.join(tmp_dir, "one")
    res = ingest(spark, landing, TABLE, one, CSV_GLOB)  # one call
    assert _lake(spark, res.path) == want
    two = os.path.join(tmp_dir, "two")
    for folder in ("2024-01", "2024-02", "2024-01"):  # a call a folder, and one again
        res = ingest(spark, f"{landing}/{folder}", TABLE, two, CSV_GLOB)
    assert _lake(spark, res.path) == want
    ingest(spark, f"file://{landing}", TABLE, two, CSV_GLOB)  # the same files by another spelling of the path
    assert _lake(spark, res.path) == want


def test_ingest_all_keeps_files_of_one_name(spark, tmp_dir):
    landing, name = os.path.join(tmp_dir, "landing"), "DE1_0_2008_to_2010_Prescription_Drug_Events_Sample_1"
    _drop(f"{landing}/2024-01", name, range(3))
    out = [ingest_all(spark, landing, f"{tmp_dir}/lake")]
    _drop(f"{landing}/2024-02", name, range(3, 8))
    out += [ingest_all(spark, f"{landing}/2024-02", f"{tmp_dir}/lake"), ingest_all(spark, landing, f"{tmp_dir}/lake")]
    assert [o[TABLE]["rows"] for o in out] == [3, 5, 8]
    assert _lake(spark, out[0][TABLE]["path"]) == [(i, 1.0) for i in range(8)]


def test_archives_issued_again(spark, tmp_dir):
    landing, lake, ck = (os.path.join(tmp_dir, x) for x in ("landing", "lake", "ck"))

    def run():
        return run_reissued_ingest(spark, landing, TABLE, lake, ck)

    first = _drop(f"{landing}/x", "a", range(4))
    _drop(f"{landing}/y", "a", range(10, 12))
    _drop(landing, "c", range(20, 23))
    assert run() == {"batches": 1, "files": 3, "rows": 9}
    path = f"{lake}/Prescription_Drug_Events"
    assert run() == {"batches": 0, "files": 0, "rows": 0}
    _drop(f"{landing}/x", "a", range(2), 2.0)  # other rows under the same name
    _drop(landing, "d", [30])
    assert run() == {"batches": 1, "files": 2, "rows": 3}
    want = [(0, 2.0), (1, 2.0), *[(i, 1.0) for i in (10, 11, 20, 21, 22, 30)]]
    assert _lake(spark, path) == want
    os.utime(first, (time.time() + 60, time.time() + 60))  # touched, not changed
    assert run() == {"batches": 0, "files": 0, "rows": 0}
    _drop(landing, "c", [])  # issued again without a row: the old rows go
    assert run() == {"batches": 1, "files": 1, "rows": 0}
    assert _lake(spark, path) == [r for r in want if not 20 <= r[0] < 23]
    fresh = os.path.join(tmp_dir, "fresh")
    assert _lake(spark, ingest(spark, landing, TABLE, fresh).path) == _lake(spark, path)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", "default") != "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def test_a_batch_repeated_after_a_failure_reads_the_same_files(spark, tmp_dir, monkeypatch):
    from claimlake.streaming import reissued
    landing, lake, ck = (os.path.join(tmp_dir, x) for x in ("landing", "lake", "ck"))
    _drop(landing, "a", range(4))
    real = reissued.ingest
    monkeypatch.setattr(reissued, "ingest", lambda *a, **k: (real(*a, **k), 1 / 0))
    with pytest.raises(Exception, match="division"):
        run_reissued_ingest(spark, landing, TABLE, lake, ck)
    monkeypatch.setattr(reissued, "ingest", real)
    _drop(landing, "b", range(4, 6))
    got = run_reissued_ingest(spark, landing, TABLE, lake, ck)
    assert got["files"] == 2 and _lake(spark, f"{lake}/Prescription_Drug_Events") == [(i, 1.0) for i in range(6)]
