"""The incremental job as a stream over a growing folder."""

from __future__ import annotations

import pytest

from msgmart.plans import jobs
from msgmart.plans.control import LOG
from msgmart.plans.jobs.common import MESSAGES
from msgmart.sources.tables import Tables
from msgmart.streaming.incremental import follow

from .test_runs import OLD, PSO, column, land


def test_new_files_are_taken_once_late_stamps_included(spark, tmp_path, monkeypatch):
    tables = Tables(spark, root=str(tmp_path / "tables"))
    spec, checkpoint = jobs.PRESALES, str(tmp_path / "checkpoint")

    def go():
        follow(spark, tables.full_name(MESSAGES), spec, tables, checkpoint).awaitTermination()

    land(tables, PSO, "1", [("1", "20200105000000", OLD)])
    go()
    go()
    assert column(tables, spec.target, "acl_id_int") == ["1"]
    land(tables, PSO, "1", [("2", "20200101000000", OLD)])
    land(tables, "other", "1", [("9", "20200101000000", OLD)])

    save = Tables._save

    def failing(self, writer, name):
        if name == "cl_f_presalesorder_history_mt":
            raise OSError("lost the driver")
        save(self, writer, name)

    monkeypatch.setattr(Tables, "_save", failing)
    with pytest.raises(Exception, match="lost the driver"):
        go()
    monkeypatch.setattr(Tables, "_save", save)
    go()
    assert column(tables, spec.target, "acl_id_int") == ["1", "2"]
    assert column(tables, "cl_f_presalesorder_orderitem_mt", "acl_id_int") == ["1", "1", "2", "2"]
    assert column(tables, "cl_f_presalesorder_history_mt", "acl_id_int") == ["1", "2"]
    assert tables.read(LOG).filter("log_entry = 'end of process'").count() == 2


def test_a_snapshot_cannot_follow(spark, tmp_path):
    tables = Tables(spark, root=str(tmp_path))
    with pytest.raises(ValueError):
        follow(spark, str(tmp_path), jobs.LATEST_PRESALES, tables, str(tmp_path / "c"))
