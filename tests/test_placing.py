"""Cost of many small files: what the driver does for each, and how they are listed."""

from tidemark.functions import files
from tidemark.sources.landing import list_sink_files


def _staged(tmp_path, count):
    for n in range(count):
        folder = tmp_path / f"staged/stream=s{n % 3}/name={n:03}.json.gz"
        folder.mkdir(parents=True)
        (folder / "part-0").write_text(str(n))
    return f"{tmp_path}/staged"


def test_names_are_looked_up_once(spark, tmp_path, monkeypatch):
    staged, asked = _staged(tmp_path, 90), []
    resolve = files.hadoop_path
    monkeypatch.setattr(files, "hadoop_path", lambda spark, name: asked.append(name) or resolve(spark, name))
    files.place_parts(spark, staged, f"{tmp_path}/placed")
    for n in range(90):
        assert (tmp_path / f"placed/s{n % 3}/{n:03}.json.gz").read_text() == str(n)
    assert len(asked) <= 2


def test_nothing_staged(spark, tmp_path):
    files.place_parts(spark, f"{tmp_path}/none", f"{tmp_path}/placed")
    assert not (tmp_path / "placed").exists()


def test_a_listing_is_few_tasks(spark, tmp_path):
    for n in range(200):
        (tmp_path / f"{n}").mkdir()
        (tmp_path / f"{n}/a.json.gz").write_bytes(b"x")
    sc = spark.sparkContext
    sc.setJobGroup("listing", "listing")
    try:
        assert list_sink_files(spark, f"{tmp_path}/*").select("file").distinct().count() == 200
        stages = [s for j in sc.statusTracker().getJobIdsForGroup("listing")
                  for s in sc.statusTracker().getJobInfo(j).stageIds]
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert max(sc.statusTracker().getStageInfo(s).numTasks for s in stages if sc.statusTracker().getStageInfo(s)) <= 64
