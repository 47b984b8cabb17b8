from __future__ import annotations

import pytest

from cardtide import jobs
from cardtide.streaming.reconcile import stored_statistics
from tests.helpers import drop_file, event


def test_stream_export_and_report(spark, tmp_path, capsys):
    frauds = [event(f"00:00:{i:02d}", is_fraud=True, fraud_type="card_testing") for i in range(25)]
    drop_file(tmp_path / "log", 0, [*frauds, event("00:09:00")])
    data = str(tmp_path / "data")
    jobs.main(["stream", "--folder", str(tmp_path / "log"), "--format", "text", "--once",
               "--option", "maxFilesPerTrigger=1", "--data-dir", data])
    jobs.main(["export", "--data-dir", data])
    assert capsys.readouterr().out.startswith("1 windows, ")
    jobs.main(["report", "--data-dir", data])
    shown = capsys.readouterr().out
    assert "100.0%" in shown and "$250" in shown and "amber" in shown


def test_late_rows_are_corrected(spark, tmp_path, capsys):
    for i, times in enumerate([["00:00:10", "00:30:00"], ["02:00:00"], ["00:00:20", "00:00:30", "02:01:00"]]):
        drop_file(tmp_path / "log", i, [event(t) for t in times])
    data = str(tmp_path / "data")
    jobs.main(["stream", "--folder", str(tmp_path / "log"), "--format", "text", "--once", "--bronze-by-date", "--windows-by-date",
               "--option", "maxFilesPerTrigger=1", "--data-dir", data])
    jobs.main(["correct", "--data-dir", data, "--closed-before", "2024-01-01 01:00:00"])
    assert capsys.readouterr().out.startswith("1 dates corrected: 2024-01-01")
    stored = stored_statistics(spark, f"{data}/windows", f"{data}/corrections").orderBy("window_start")
    assert [r.tx_count for r in stored.collect()] == [3, 1]
    jobs.main(["correct", "--data-dir", data])
    jobs.main(["correct", "--data-dir", data])
    assert capsys.readouterr().out.endswith("nothing was late\n")


def test_a_source_is_needed(spark, capsys):
    with pytest.raises(SystemExit):
        jobs.main(["stream", "--data-dir", "/tmp/none"])
    capsys.readouterr()
