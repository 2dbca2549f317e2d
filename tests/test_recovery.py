import json
import os
import time
import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from siftline.operators import journal, responses
from siftline.plans import cli, enrichment, runs
from siftline.sources import versions

FIELDS = {"email": "a@b.fr", "phone": "0478001122", "website": "b.fr", "website_type": "official_site", "email_source": "b.fr", "phone_source": "b.fr", "website_source": "b.fr", "identity_verified": True, "identity_match_type": "siret", "identity_source": "b.fr"}


class Counted:
    """A provider that leaves a file for each call it gets, and breaks down where ``broken`` is there."""

    def __init__(self, folder):
        self.folder = str(folder)

    def __call__(self):
        def ask(request, key):
            if "Broken" in request and os.path.exists(f"{self.folder}/broken"):
                raise SystemExit("the machine is gone")
            Path(f"{self.folder}/{key}-{uuid.uuid4().hex}").touch()
            return json.dumps({"output_text": json.dumps(FIELDS)})

        return ask

    def calls(self):
        return sorted(f.rsplit("-", 1)[0] for f in os.listdir(self.folder) if f != "broken")


@pytest.fixture
def counted(tmp_path):
    (tmp_path / "calls").mkdir()
    return Counted(tmp_path / "calls")


def test_versions_and_their_pointer(spark, tmp_path):
    folder = str(tmp_path / "table")
    with pytest.raises(versions.VersionError, match="no current"):
        versions.read(spark, folder)
    first = versions.write(spark.range(3), folder).rpartition("/")[2]
    second = versions.write(spark.range(5), folder).rpartition("/")[2]
    assert versions.versions(spark, folder) == [first, second] and versions.current(spark, folder) == second and versions.read(spark, folder).count() == 5

    # a version that breaks off is no version, and the pointer stays
    @F.udf("long")
    def bad(x):
        raise RuntimeError("broken off")

    with pytest.raises(Exception, match="broken off"):
        versions.write(spark.range(9).select(bad("id").alias("id")), folder)
    assert versions.current(spark, folder) == second and versions.versions(spark, folder) == [first, second]
    versions.restore(spark, folder, first)
    assert versions.read(spark, folder).count() == 3 and versions.read(spark, folder, second).count() == 5
    with pytest.raises(versions.VersionError):
        versions.restore(spark, folder, "v-none")
    gone = versions.expire(spark, folder, 0)
    assert second in gone and versions.versions(spark, folder) == [first] and versions.read(spark, folder).count() == 3


def test_pacing():
    clock = [0.0]
    slept = []

    def sleep(s):
        slept.append(round(s, 6))
        clock[0] += s

    pacer = responses.Pacer(4, lambda: clock[0], sleep)
    for _ in range(3):
        pacer.wait()
    clock[0] += 10
    pacer.wait()
    assert slept == [0.25, 0.25]
    free = responses.Pacer(None, lambda: clock[0], sleep)
    free.wait()
    free.wait()
    assert len(slept) == 2


def test_calls_a_second_over_all_tasks(spark, tmp_path):
    folder = str(tmp_path)

    def make():
        def ask(request, key):
            Path(f"{folder}/{time.time()}-{uuid.uuid4().hex}").touch()
            return json.dumps({"output_text": json.dumps(FIELDS)})

        return ask

    asked = spark.createDataFrame([(i, "{}") for i in range(24)], "row_index int, request string")
    assert len(responses.call(asked, make, concurrency=4, calls_per_second=8).collect()) == 24
    times = sorted(float(f.split("-")[0]) for f in os.listdir(folder))
    assert max(sum(t <= u < t + 1 for u in times) for t in times) <= 8 + 4  # a task's first call needs no wait
    assert times[-1] - times[0] >= (24 / 4 - 1) * 4 / 8 - 0.1
    with pytest.raises(ValueError, match="bound on tasks"):
        responses.call(asked, make, calls_per_second=8)


def test_no_answer_is_asked_for_twice(spark, tmp_path, counted):
    rows = [(i, json.dumps({"input": "Broken" if i == 17 else f"row {i}"})) for i in range(40)]
    asked = spark.createDataFrame(rows, "row_index int, request string")
    (tmp_path / "calls" / "broken").touch()
    with pytest.raises(Exception):  # noqa: B017
        responses.call_once(asked, counted, str(tmp_path / "answers"), concurrency=1, chunk=4)
    first = counted.calls()
    assert 0 < len(first) < 40
    (tmp_path / "calls" / "broken").unlink()
    got = responses.call_once(asked, counted, str(tmp_path / "answers"), concurrency=1, chunk=4).collect()
    assert sorted(r.row_index for r in got) == list(range(40)) and counted.calls() == sorted(f"{i}-0" for i in range(40))
    assert len(responses.call_once(asked, counted, str(tmp_path / "answers")).collect()) == 40 and len(counted.calls()) == 40


CSV = "Note,Numéro SIRET,Raison sociale,Ville\nkept 1,11111111111111,Atelier,Lyon\nkept 2,22222222222222,Broken,Nice\nkept 3,x,Bad number,Nice\n"


def enrich(spark, tmp_path, counted, monkeypatch, *more):
    monkeypatch.setattr(cli, "_named", lambda name: counted)
    return cli.main(["enrich", str(tmp_path / "c.csv"), str(tmp_path / "out"), "--provider", "any", "--wait-s", "0", *more], spark)


def table(spark, tmp_path, folder="out"):
    return {r["Raison sociale"]: (r["Note"], r["Email"], r["Enrichment Status"]) for r in versions.read(spark, str(tmp_path / folder)).collect()}


DONE = {"Atelier": ("kept 1", "a@b.fr", "success"), "Broken": ("kept 2", "a@b.fr", "success"), "Bad number": ("kept 3", None, "invalid_input")}


def test_a_run_that_broke_off_before_its_table_is_recovered(spark, tmp_path, counted, monkeypatch):
    (tmp_path / "c.csv").write_text(CSV)
    with monkeypatch.context() as m:
        m.setattr(versions, "write", lambda df, out: (_ for _ in ()).throw(OSError("disk full")))
        with pytest.raises(OSError, match="disk full"):
            enrich(spark, tmp_path, counted, monkeypatch)
    assert counted.calls() == ["2-0", "3-0"] and versions.current(spark, str(tmp_path / "out")) is None
    home = runs.Folder(spark, str(tmp_path / "out"))
    assert len(home.pending()) == 1

    # by the command, from what the run wrote
    assert cli.main(["recover", str(tmp_path / "c.csv"), str(tmp_path / "out" / "journal"), str(tmp_path / "again")], spark) == 0
    assert table(spark, tmp_path, "again") == DONE
    # and by the next run, which asks for nothing again
    assert enrich(spark, tmp_path, counted, monkeypatch) == 0
    assert counted.calls() == ["2-0", "3-0"] and table(spark, tmp_path) == DONE and home.pending() == []
    # marked runs are not replayed
    assert cli.main(["recover", str(tmp_path / "c.csv"), str(tmp_path / "out" / "journal"), str(tmp_path / "third")], spark) == 0
    assert {v[2] for v in table(spark, tmp_path, "third").values()} == {None}


def test_a_run_that_broke_off_before_its_journal_goes_on(spark, tmp_path, counted, monkeypatch):
    (tmp_path / "c.csv").write_text(CSV)
    (tmp_path / "calls" / "broken").touch()
    with pytest.raises(Exception):  # noqa: B017
        enrich(spark, tmp_path, counted, monkeypatch, "--concurrency", "1")
    (tmp_path / "calls" / "broken").unlink()
    assert enrich(spark, tmp_path, counted, monkeypatch, "--concurrency", "1") == 0
    assert counted.calls() == ["2-0", "3-0"] and table(spark, tmp_path) == DONE
    assert len(versions.folders(spark, str(tmp_path / "out" / "runs"))) == 1
    # other settings are another run
    assert enrich(spark, tmp_path, counted, monkeypatch, "--concurrency", "2", "--max-rows", "1") == 0
    assert len(versions.folders(spark, str(tmp_path / "out" / "runs"))) == 2


def test_an_empty_journal_is_an_error(spark, tmp_path):
    (tmp_path / "c.csv").write_text(CSV)
    (tmp_path / "journal").mkdir()
    (tmp_path / "journal" / "a.json").write_text("\n")
    with pytest.raises(journal.JournalError, match="no records"):
        cli.main(["recover", str(tmp_path / "c.csv"), str(tmp_path / "journal"), str(tmp_path / "out")], spark)


def test_a_journal_of_another_table_stops_the_run(spark, tmp_path, counted, monkeypatch):
    (tmp_path / "c.csv").write_text(CSV)
    with monkeypatch.context() as m:
        m.setattr(versions, "write", lambda df, out: (_ for _ in ()).throw(OSError("disk full")))
        with pytest.raises(OSError):
            enrich(spark, tmp_path, counted, monkeypatch)
    (tmp_path / "c.csv").write_text(CSV.replace("Atelier", "Someone else"))
    with pytest.raises(journal.JournalError, match="other companies"):
        enrich(spark, tmp_path, counted, monkeypatch)


def test_settings_from_the_environment():
    c = enrichment.Config.from_environment({"SIFTLINE_MAX_ROWS": "0", "SIFTLINE_AUDIT": "oui", "SIFTLINE_WAIT_S": " ", "SIFTLINE_TRIES": "7", "SIFTLINE_MODEL": "m", "SIFTLINE_READ_SITES": "perhaps"})
    assert (c.max_rows, c.audit, c.wait_s, c.tries, c.model, c.read_sites) == (0, True, 5.0, 7, "m", True)
    with pytest.raises(ValueError, match="concurrency"):
        enrichment.Config.from_environment({"SIFTLINE_CONCURRENCY": "99"})
    with pytest.raises(ValueError):
        enrichment.Config.from_environment({"SIFTLINE_TRIES": "many"})
