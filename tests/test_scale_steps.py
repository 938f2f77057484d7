"""Steps of the driver's queries that must not gather wide rows or heavy work in one task."""

import glob

from driver_queries import ingest_queries, inputs, log_queries

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_vectors_are_dealt_by_key(spark):
    """A file of parts is small, the work on a vector is not."""
    assert "hashpartitioning(p_partkey" in _plan(inputs.vectors(spark, SF))


def test_events_and_orders_are_dealt_before_they_are_wrapped(spark):
    """Files of few row groups do not leave hashing and JSON to as few tasks."""
    assert "hashpartitioning(event_id" in _plan(ingest_queries.event_envelopes(spark, SF))
    assert "hashpartitioning(o_orderkey" in _plan(ingest_queries.kev_catalogs(spark, SF))


def test_the_log_is_numbered_by_ranges(spark):
    """No task orders a whole partition of the log, and no value is spelled before the numbers are there."""
    plan = _plan(log_queries._log(spark, SF))
    assert "row_number" not in plan and "hashpartitioning(event_type" not in plan


def test_events_of_one_file_are_wrapped_where_they_are_written(spark):
    rows = ingest_queries.by_type(spark, SF, "view").sortWithinPartitions("ingestion_run_id")
    assert "Exchange" not in _plan(rows) and "Sort" not in _plan(rows) and "Coalesce 1" in _plan(rows)


def test_unreadable_file_is_compressed(spark, monkeypatch):
    """The one file that cannot be read holds all its records in fewer bytes than their plain lines."""
    made = []
    new_dir = log_queries.new_dir
    monkeypatch.setattr(log_queries, "new_dir", lambda s, name: made.append(new_dir(s, name)) or made[-1])
    found = log_queries.bronze_unreadable(spark, SF).first()
    assert (found.missing_manifest, found.parse_errors, found.passed) == (0, 1, 0)
    files = glob.glob(f"{made[0]}/**/run_id=click/*.gz", recursive=True)
    records = inputs.table(spark, SF, "events").where("event_type = 'click'").count()
    assert len(files) == 1 and len(open(files[0], "rb").read()) < 200 * records
