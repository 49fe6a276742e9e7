from __future__ import annotations

import json

import pytest
from test_refresh import resume

from probity.operators import quality as Q
from probity.plans import arrivals as A
from probity.plans import silver as S
from probity.sources.resumes import read_resumes


@pytest.fixture
def drop(tmp_path):
    (tmp_path / "raw").mkdir()

    def write(numbers, category="senadores", text=None):
        folder = tmp_path / "raw" / category / "sub"
        folder.mkdir(parents=True, exist_ok=True)
        for n in numbers:
            (folder / f"{n}.json").write_text(json.dumps(resume(n)) if text is None else text, encoding="utf-8")
        return str(tmp_path / "raw")

    return write


def rows(df):
    return sorted(map(str, df.collect()))


def batch_run(spark, root, tmp_path, name):
    whole = S.to_silver(read_resumes(spark, root))
    return Q.write_routed(whole, str(tmp_path / name), S.reject_reason(whole), helpers=(S.CORRUPT,))


def test_drops_and_a_replayed_batch_equal_one_batch_run(spark, tmp_path, drop):
    to = A.Arrivals(str(tmp_path / "table"), str(tmp_path / "checkpoint"))
    root = drop(range(10_000_001, 10_000_004))
    A.take_in(spark, root, to, files_per_batch=2)
    drop([10_000_011], "diputados")
    drop([5], "elsewhere")
    drop(["broken"], text="{no json")
    schema = A.take_in(spark, root, to)
    assert A.take_in(spark, root, to) == schema  # nothing new

    valid, rejected, report = batch_run(spark, root, tmp_path, "whole")
    assert rows(A.valid_arrivals(spark, to, schema)) == rows(valid) and valid.count() == 4
    assert rows(A.rejected_arrivals(spark, to, schema)) == rows(rejected)
    assert [r.motivo_rechazo for r in rejected.collect()] == [S.UNREADABLE]
    assert A.arrival_quality(spark, to, schema) == report == Q.QualityReport(5, 1)

    # the last batch was written, but the job broke off before it was marked as done
    commits = sorted((tmp_path / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()
    (commits[-1].parent / f".{commits[-1].name}.crc").unlink(missing_ok=True)
    A.take_in(spark, root, to)
    assert rows(A.valid_arrivals(spark, to, schema)) == rows(valid)
    drop([10_000_012])
    A.take_in(spark, root, to)
    assert A.arrival_quality(spark, to, schema).total == 6


def test_nothing_has_arrived(spark, tmp_path, drop):
    to = A.Arrivals(str(tmp_path / "table"), str(tmp_path / "checkpoint"))
    schema = A.take_in(spark, drop([]), to)
    assert A.valid_arrivals(spark, to, schema).count() == 0 and A.arrival_quality(spark, to, schema).ratio == 0
