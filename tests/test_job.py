"""The command line, end to end, with message folders in place of a broker."""

import pytest

import job
from sparkelt import schemas as S
from sparkelt.fixtures import raw_feed


def test_publish_ingest_model_check(spark, sf_dir, tmp_path, capsys):
    wh, trips = str(tmp_path / "wh"), {}
    for feed in S.FEEDS.values():
        source, messages = str(tmp_path / f"{feed.name}.parquet"), str(tmp_path / f"{feed.name}_msg")
        df = raw_feed(spark, sf_dir, feed)
        df.drop("trip_id", "loaded_at").write.parquet(source)
        trips[feed.name] = df.count()
        where = ["--feed", feed.name, "--messages", messages, "--format", "json"]
        assert job.main(["publish", "--source", source, *where]) == 0
        assert job.main(["ingest", "--warehouse", wh, "--once", *where]) == 0
    assert job.main(["models", "--warehouse", wh]) == 0
    assert "fact_trip: full" in capsys.readouterr().out
    assert job.main(["models", "--warehouse", wh]) == 0
    assert "fact_trip: none" in capsys.readouterr().out
    assert job.main(["compact", "--warehouse", wh, "--keep-hours", "0"]) == 0
    assert "fact_trip: folders removed: 0" in capsys.readouterr().out
    dead = ["--checkpoint", str(tmp_path / "cp_dead"), "--mode", "DEAD_LETTER"]
    assert job.main(["ingest", "--warehouse", str(tmp_path / "other"), "--once", *where, *dead]) == 0
    json_path = str(tmp_path / "json")
    more = ["--once", "--json-path", json_path, "--checkpoint", str(tmp_path / "cp"), "--max-files", "1", "--mode", "PERMISSIVE"]
    assert job.main(["ingest", "--warehouse", wh, *more, *where]) == 0
    assert spark.read.json(json_path).count() == trips["yellow"]
    # the fixture has a third vendor, which the accepted values do not know
    assert job.main(["run", "--warehouse", wh]) == 1
    assert "fact_trip: none" in capsys.readouterr().out
    assert job.main(["checks", "--warehouse", wh]) == 1
    out = capsys.readouterr().out.splitlines()
    assert len(out) == 48
    assert {line.split()[2] for line in out if line.startswith("FAIL")} == {"accepted_values"}
    assert job.main(["profile", "--source", source]) == 0
    assert "row_count" in capsys.readouterr().out


def test_a_source_of_messages_is_required():
    with pytest.raises(SystemExit):
        job.parser().parse_args(["ingest", "--feed", "green", "--warehouse", "w"])
