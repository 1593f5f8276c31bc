"""Workers as table functions: outcomes, failures as statuses, types, refusals."""
from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException

from contactforge.operators import workers
from contactforge.streaming import incremental


def half_worker():
    def halves(row):  # local, so that workers get its code and not this module's name
        if row["n"] % 2:
            return None, "no_half"
        return row["n"] // 2, "ok"

    return halves


ROWS = [("a", 4), ("b", 3), ("c", None), ("a", 4), (None, 8)]
WANT = [("None", "ok", "4"), ("a", "ok", "2"), ("a", "ok", "2"), ("b", "no_half", "None"), ("c", "retry:TypeError", "None")]


@pytest.mark.parametrize("by", [None, "id"])
def test_every_row_has_an_outcome(frame, by):
    items = frame(ROWS, "id string, n long")
    out = workers.run_worker(items, half_worker(), "long", by=by)
    assert out.schema.simpleString() == "struct<id:string,status:string,record:bigint>"
    assert sorted(tuple(map(str, r)) for r in out.collect()) == WANT
    assert workers.run_worker(items.limit(0), half_worker(), "long", by=by).count() == 0


def test_failed_rows_are_asked_for_again(spark, frame, tmp_path):
    items = frame([("a", 4), ("b", None), ("c", 3)], "id string, n long")
    path = str(tmp_path / "records")
    incremental.append_records(workers.run_worker(items, half_worker(), "long"), path, "half", "s1")
    assert [r.id for r in incremental.unrecorded(items, path, "half", "s1").collect()] == ["b"]


def test_a_table_without_the_key_is_refused(frame):
    with pytest.raises(AnalysisException, match="no column id"):
        workers.run_worker(frame([(1,)], "n long"), half_worker(), "long")


def test_columns_named_like_the_output_reach_the_worker(frame):
    items = frame([(7, "old", "x")], "id int, status string, record string")
    out = workers.run_worker(items, lambda row: ({"was": row["status"] + row["record"]}, "ok"), "struct<was: string>")
    assert [(r.id, r.status, r.record.was) for r in out.collect()] == [(7, "ok", "oldx")]
