"""The command line, in-process: publish -> ingest (file form) -> verify,
backfill, preview, audit."""

from ordwave.cli import main
from ordwave.streaming.sinks import read_landed, read_quarantine


def test_cli_round_trip(spark, sf_small, tmp_path, capsys):
    assert main(["publish", "--sf-dir", sf_small], spark) == 0
    topics = capsys.readouterr().out.strip().splitlines()[-1]
    sink = str(tmp_path / "landed")
    ck = str(tmp_path / "ck")
    assert main(["ingest", "--topics-dir", topics, "--sink-root", sink, "--checkpoint-root", ck,
                 "--available-now", "--max-files-per-trigger", "4", "--validator", "strict", "--progress"], spark) == 0
    n_good = read_landed(spark, sink, "orders").count()
    n_bad = read_quarantine(spark, sink, "orders").count()
    assert n_good > 0 and n_bad > 0
    assert main(["verify", "--sink-root", sink], spark) == 0
    out = capsys.readouterr().out
    assert "orders_quarantine" in out and "rows per day" in out and "ingestion audit" in out
    assert main(["backfill", "--topics-dir", topics, "--sink-root", str(tmp_path / "bf")], spark) == 0
    assert "landed" in capsys.readouterr().out
    assert main(["preview", "--topics-dir", topics, "-n", "2"], spark) == 0
    out = capsys.readouterr().out
    assert "--- orders-topic: first 2 events" in out and " | " in out
    assert main(["audit", "--sink-root", sink, "--sf-dir", sf_small], spark) == 0
    assert "competitor_band" in capsys.readouterr().out
    assert main(["compact", "--sink-root", sink], spark) == 0
    assert "orders: 2 batches folded" in capsys.readouterr().out
    assert main(["verify", "--sink-root", sink], spark) == 0          # history after compaction
    assert f"{n_good}" in capsys.readouterr().out.replace(",", "")


def test_cli_routed_ingest(spark, sf_small, tmp_path, capsys):
    main(["publish", "--sf-dir", sf_small], spark)
    topics = capsys.readouterr().out.strip().splitlines()[-1]
    sink = str(tmp_path / "landed")
    assert main(["ingest", "--routed", "--topics-dir", topics, "--sink-root", sink, "--checkpoint-root",
                 str(tmp_path / "ck"), "--available-now", "--max-files-per-trigger", "8"], spark) == 0
    assert read_landed(spark, sink, "orders").count() > 0
    assert read_landed(spark, sink, "pricing_events").count() > 0
