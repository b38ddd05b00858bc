from __future__ import annotations

from datetime import datetime, timezone

import pytest

from ledgerstrata.__main__ import main, new_run_id
from tests import sample


def test_run_id_format():
    first, second = (new_run_id(datetime(2024, 2, 1, tzinfo=timezone.utc)) for _ in range(2))
    assert first.startswith("20240201_") and len(first) == 17 and first != second


def test_historical_verify_and_a_failure(spark, tmp_path, capsys):
    sample.write_week(f"{tmp_path}/source", 1)
    where = ["--lake", f"{tmp_path}/lake", "--source", f"{tmp_path}/source"]
    assert main(["historical", *where, "--start-date", "2024-07-01", "--end-date", "2024-07-01"]) == 0
    assert "watermark 2024-07-01" in capsys.readouterr().out
    assert main(["verify", *where, "--end-date", "2024-07-01"]) == 0
    assert main(["verify", *where, "--end-date", "2024-07-02"]) == 1
    assert "FAIL  AT-01" in capsys.readouterr().out
    sample.write(f"{tmp_path}/source/transactions_2024-07-02.csv", ["wrong,header", "1,2"])
    assert main(["incremental", *where]) == 1
    assert "bronze_transactions 2024-07-02" in capsys.readouterr().out


def test_bad_dates_are_refused():
    with pytest.raises(SystemExit):
        main(["verify", "--lake", "l", "--source", "s", "--end-date", "01.02.2024"])
