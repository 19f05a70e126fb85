from __future__ import annotations

import pytest

from tests.test_streaming import message, windows
from tidemark import jobs
from tidemark.schemas import QUOTA_ALERT
from tidemark.sources.logged import LoggedTable
from tidemark.sources.sinks import FileTable

USERS = "id;name;email;quota\nu;Una;una@x;10\nv;Vic;vic@x;1000\n"


def test_jobs_from_the_command_line(spark, tmp_path):
    at = lambda name: str(tmp_path / name)
    (tmp_path / "users.csv").write_text(USERS)
    (tmp_path / "feed").mkdir()
    lines = [message("16:00:10", 8, "u"), message("16:00:20", 4, "u"), "broken", message("17:30:00", 1, "v")]
    (tmp_path / "feed" / "1.txt").write_text("\n".join(lines))
    for _ in range(2):
        jobs.main(["provision", "--users", at("users.csv"), "--tables", at("tables")])
    jobs.main(
        ["speed", "--files", at("feed"), "--landing", at("landing"), "--checkpoints", at("checkpoints"),
         "--rejected", at("rejected"), "--tables", at("tables"), "--once"]
    )
    jobs.main(
        ["batch", "--landing", at("landing"), "--archive", at("archive"), "--tables", at("tables"),
         "--hour", "2024-01-01T16:00:00Z"]
    )
    assert [w[1:] for w in windows(FileTable(at("tables/bytes")), spark)] == [
        ("antenna_id_total_bytes", "A1", 12), ("app_total_bytes", "web", 12), ("id_total_bytes", "u", 12),
    ]
    assert ("16:00", "email_total_bytes", "una@x", 12) in windows(FileTable(at("tables/bytes_hourly")), spark)
    alerts = FileTable(at("tables/user_quota_limit")).read(spark, QUOTA_ALERT)
    assert [(r.email, r.usage, r.quota) for r in alerts.collect()] == [("una@x", 12, 10)]
    assert FileTable(at("rejected")).read(spark).first().payload == "broken"
    assert spark.read.parquet(at("archive")).count() == 2


def test_the_single_read_jobs(spark, tmp_path):
    """The batch layer reads the logged landing; a compaction changes no row, and a second run of all adds none."""
    at = lambda name: str(tmp_path / name)
    (tmp_path / "users.csv").write_text(USERS)
    (tmp_path / "feed").mkdir()
    tables = ["--tables", at("tables")]
    landing = ["--landing", at("landing")]
    jobs.main(["provision", "--users", at("users.csv"), *tables])
    batches = [
        [message("16:00:10", 8, "u"), "broken", message("17:30:00", 1, "v")],
        [message("17:30:30", 5, "u"), message("17:59:59", 7, "v"), message("18:30:00", 1, "v")],
    ]
    speed = ["speed", "--single-read", "--once", "--files", at("feed"), "--checkpoints", at("c"), *landing, *tables]
    hourly = ["batch", "--archive", at("archive"), *landing, *tables, "--hour", "2024-01-01T16:00:00Z", "--hours", "2"]
    for i, lines in enumerate(batches):
        (tmp_path / "feed" / f"{i}.txt").write_text("\n".join(lines))
        jobs.main(speed)
    seen = []
    for keep in ("7", "0"):
        jobs.main(hourly)
        bytes_ = windows(LoggedTable(at("tables/bytes_logged")), spark)
        seen.append((bytes_, windows(FileTable(at("tables/bytes_hourly")), spark), spark.read.parquet(at("archive")).count()))
        jobs.main(["compact", "--keep-days", keep, *landing, *tables])
        jobs.main(speed)
    assert seen[0] == seen[1] and seen[0][2] == 4
    assert ("17:30", "id_total_bytes", "v", 1) in seen[0][0] and ("17:00", "email_total_bytes", "vic@x", 8) in seen[0][1]
    assert len(LoggedTable(at("landing")).snapshot(spark).folders) == 1
    with pytest.raises(ValueError, match="needs --tables"):
        jobs.main(speed[:-2])


def test_database_settings_come_from_the_environment(monkeypatch):
    for name in ("URL", "USER", "PASSWORD", "DRIVER"):
        monkeypatch.delenv(f"TIDEMARK_JDBC_{name}", raising=False)
    with pytest.raises(ValueError, match="TIDEMARK_JDBC_URL"):
        jobs.jdbc_settings()
    for name in ("URL", "USER", "PASSWORD", "DRIVER"):
        monkeypatch.setenv(f"TIDEMARK_JDBC_{name}", name.lower())
    assert jobs.jdbc_settings() == {"url": "url", "user": "user", "password": "password", "driver": "driver"}
