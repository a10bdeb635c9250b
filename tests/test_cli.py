"""The command line runs models, checks and reports against a Hive-partitioned source."""

import json

from daybook.__main__ import main
from daybook.operators import export
from daybook.sources import adapters as A
from tests.conftest import SF_SMALL


def test_cli_run_test_report(spark, tmp_path, capsys):
    src, wh = str(tmp_path / "src"), str(tmp_path / "wh")
    export.partitioned_export(A.events_source(spark, SF_SMALL), src)
    assert main(["run", "--source", src, "--warehouse", wh, "--version", "3"]) == 0
    assert main(["run", "--source", src, "--warehouse", wh, "--version", "3",
                 "--from-date", A.EVENTS_FROM_DATE, "--preview"]) == 0
    out = [json.loads(x) for x in capsys.readouterr().out.splitlines()]
    modes = [o["mode"] for o in out if "mode" in o]
    assert modes == ["first_run", "first_run", "incremental", "incremental"]
    previews = [o["preview"][0] for o in out if "preview" in o]
    assert previews[0]["day_count"] == 14
    assert main(["test", "--warehouse", wh]) == 0
    assert main(["report", "latest", "--warehouse", wh, "-n", "3"]) == 0
    latest = [json.loads(x) for x in capsys.readouterr().out.splitlines()][-3:]
    assert [r["order_date"] for r in latest] == ["2024-01-30", "2024-01-29", "2024-01-28"]


def test_cli_stream_processes_arrived_files(spark, tmp_path, capsys):
    src, wh, ck = str(tmp_path / "src"), str(tmp_path / "wh"), str(tmp_path / "ck")
    export.partitioned_export(A.events_source(spark, SF_SMALL), src)
    assert main(["stream", "--source", src, "--warehouse", wh, "--checkpoint", ck, "--bigint-keys"]) == 0
    assert main(["report", "overview", "--warehouse", wh]) == 0
    overview = json.loads(capsys.readouterr().out.splitlines()[-1])
    assert overview["record_count"] == 30 and overview["last_date"] == "2024-01-30"
