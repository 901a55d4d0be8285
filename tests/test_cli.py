from ledgerline.__main__ import main


def test_list(capsys):
    assert main(["list"]) == 0
    out = capsys.readouterr().out.split("\n")
    assert "api_lookup" in out and "chunk_counts" in out


def test_run_writes_output(spark, tmpdir_fresh):
    path = tmpdir_fresh + "/hist"
    assert main(["run", "latency_histogram", "--data", "/root/testdata/sf0.001", "--out", path]) == 0
    assert spark.read.parquet(path).count() == 5


def test_unknown_job():
    assert main(["run", "no_such_job", "--data", "/root/testdata/sf0.001"]) == 2
