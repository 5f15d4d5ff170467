"""A published set changes as one, and a broken run goes on."""

import csv
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tourledger.plans import run
from tourledger.sources.releases import MANIFEST, Release, manifest


def published(out: Path) -> dict[str, list]:
    found = {}
    for folder in sorted(p for p in out.iterdir() if p.is_dir()):
        part, = folder.glob("part-*.csv")
        with part.open(newline="") as file:
            found[folder.name] = list(csv.reader(file))
    return found


def report(spark, n, value="x"):
    return lambda: spark.range(n).select(F.col("id").alias("n"), F.lit(value).alias("text"))


@pytest.fixture
def out(spark, tmp_path):
    """A published set of two reports."""
    release = Release(spark, str(tmp_path / "out"), {"day": "1"})
    assert release.add("a", report(spark, 2)) and release.add("b", report(spark, 3, "two\nlines"))
    release.switch(["a", "b"])
    return tmp_path / "out"


def test_manifest_counts_rows(spark, out):
    assert manifest(spark, str(out)) == {"a": 2, "b": 3}
    assert manifest(spark, str(out / "none")) == {}
    assert sorted(p.name for p in out.parent.iterdir()) == ["out"]


def test_a_broken_run_leaves_the_old_set_whole_and_goes_on(spark, out):
    before = published(out)
    release = Release(spark, str(out), {"day": "2"})
    release.add("a", report(spark, 5))

    def fails():
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        release.add("b", fails)
    with pytest.raises(ValueError, match="not finished: b"):
        release.switch(["a", "b"])
    assert published(out) == before and manifest(spark, str(out)) == {"a": 2, "b": 3}

    again = Release(spark, str(out), {"day": "2"})
    assert not again.add("a", fails)  # finished, so not made again
    assert again.add("b", report(spark, 6))
    again.switch(["a", "b"])
    assert manifest(spark, str(out)) == {"a": 5, "b": 6} and len(published(out)["a"]) == 6


def test_half_written_reports_and_other_runs_are_made_anew(spark, out):
    first = Release(spark, str(out), {"day": "2"})
    first.add("a", report(spark, 5))
    (out.parent / "out.staging" / "b").mkdir()
    (out.parent / "out.staging" / "b" / "part-0.csv").write_text("half")
    same = Release(spark, str(out), {"day": "2"})
    assert same.entry("a")["rows"] == 5 and same.entry("b") is None
    assert same.add("b", report(spark, 1))
    other = Release(spark, str(out), {"day": "3"})
    assert other.entry("a") is None and other.add("a", report(spark, 1))


@pytest.mark.parametrize("whole", [True, False])
def test_a_run_broken_between_both_renames_is_completed(spark, out, whole):
    before = published(out)
    release = Release(spark, str(out), {"day": "2"})
    release.add("a", report(spark, 7))
    if whole:
        release.files.write(f"{release.staging}/{MANIFEST}", '[{"report": "a", "rows": 7, "columns": []}]')
    release.files.rename(release.out, release.previous)
    Release(spark, str(out), {"day": "4"})
    assert manifest(spark, str(out)) == ({"a": 7} if whole else {"a": 2, "b": 3})
    assert whole or published(out) == before


def test_a_full_run_broken_half_way(spark, tables, tmp_path, monkeypatch):
    """The old set stays whole; the next run makes only what is missing."""
    made = []

    def counted(name, broken=False):
        def make(t):
            made.append(name)
            if broken:
                raise RuntimeError("executor lost")
            return run.REPORTS_BEFORE[name](t)

        return make

    names = ["arrivals", "departures", "departure_type"]
    monkeypatch.setattr(run, "REPORTS_BEFORE", run.REPORTS, raising=False)
    out, about = str(tmp_path / "out"), {"as_of": "x"}
    monkeypatch.setattr(run, "REPORTS", {n: counted(n) for n in names[:2]})
    run.publish_all(tables.inputs, out, str(tmp_path / "s1"), about=about)
    old = published(tmp_path / "out")
    assert set(old) == {"quality", *names[:2]}

    monkeypatch.setattr(run, "REPORTS", {n: counted(n, n == "departures") for n in names})
    with pytest.raises(RuntimeError):
        run.publish_all(tables.inputs, out, str(tmp_path / "s2"), about=about)
    assert published(tmp_path / "out") == old
    made.clear()
    monkeypatch.setattr(run, "REPORTS", {n: counted(n) for n in names})
    run.publish_all(tables.inputs, out, str(tmp_path / "s3"), about=about)
    assert made == ["departures", "departure_type"]
    assert set(published(tmp_path / "out")) == {"quality", *names} == set(manifest(spark, out))
