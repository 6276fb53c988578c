"""The two programs, on files."""

import pytest

from signalmart import cli
from signalmart.sources.store import Store
from tests.test_load import AS_OF, snapshot, write_source

CLOCK = ["--as-of", AS_OF.isoformat()]


def test_stream_then_quality(spark, tmp_path, capsys):
    write_source(spark, tmp_path / "source")
    mart = str(tmp_path / "mart")
    run = ["stream", "--mart", mart, "--files", str(tmp_path / "source"), "--dead-letters", str(tmp_path / "dlq"),
           "--checkpoints", str(tmp_path / "checkpoints"), "--max-files", "1", "--drain", *CLOCK]
    assert cli.main(run) == 0
    store = Store(spark, mart)
    assert store.read("fact_recharges").count() == 2 and store.read("dlq_records").count() == 5
    done = snapshot(store)
    assert cli.main(run) == 0  # nothing new
    assert snapshot(store) == done

    assert cli.main(["quality", "--mart", mart, "--constraints", *CLOCK]) == 0
    said = capsys.readouterr().out
    assert "PASS  fact_calls" in said and "FAIL" not in said

    batch = store.begin("events", 99)
    batch.write("fact_calls", store.read("fact_calls").limit(1))  # past the index of ids
    batch.commit()
    assert cli.main(["quality", "--mart", mart, *CLOCK]) == 1
    said = capsys.readouterr().out
    assert "FAIL  fact_calls" in said and "FAILED fact_calls: unique event_id, 2 of 3" in said
    assert "PASS  fact_sms" in said


def test_arguments(tmp_path):
    with pytest.raises(SystemExit):
        cli.main(["stream", "--mart", "m", "--files", "f", "--checkpoints", "c"])
    with pytest.raises(SystemExit):
        cli.main(["stream", "--mart", "m", "--checkpoints", "c"])
    args = cli.parser().parse_args(["stream", "--mart", "m", "--brokers", "b:1", "--checkpoints", "c"])
    assert (args.max_records, args.interval, args.drain, args.fail_on_data_loss) == (20_000, "5 seconds", False, False)
