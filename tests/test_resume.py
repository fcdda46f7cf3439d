"""A job that broke off is taken up where it was."""

import pytest

from catalog_star import staging
from catalog_star.plans import etl
from catalog_star.sinks.versions import VersionedWarehouse
from tests import fixture_data as fx


@pytest.fixture
def files(spark, tmp_path):
    fx.tracks(spark).write.parquet(f"{tmp_path}/tracks")
    fx.awards(spark).write.parquet(f"{tmp_path}/awards")
    return lambda: [spark.read.parquet(f"{tmp_path}/{x}") for x in ("tracks", "awards")]


def test_finished_stages_are_taken_up(spark, files, tmp_path, monkeypatch):
    house = VersionedWarehouse(spark, str(tmp_path / "house"), buckets=4)
    seen = []

    class Breaking:
        """Fails at the n-th stage, leaving a folder without marker."""

        def __init__(self, stop):
            self.stop = stop

        def place(self, scope, label, whole=staging.ResumableScope.place):
            path = whole(scope, label)
            if scope.count == self.stop:
                spark.range(3).write.mode("overwrite").parquet(path)
                marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
                marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(marker, False)
                raise OSError(label)
            return path

    for stop in (1, 3, 6, 8):
        breaking = Breaking(stop)
        monkeypatch.setattr(staging.ResumableScope, "place", lambda scope, label, b=breaking: b.place(scope, label))
        with pytest.raises(OSError):
            etl.run(*files(), house, resume=True)
        monkeypatch.undo()
        seen.append(stop)
        assert house.versions() == []
    done = etl.run(*files(), house, resume=True)
    assert len(done.stages.taken_up) == max(seen) - 1 < done.stages.count
    fresh = VersionedWarehouse(spark, str(tmp_path / "fresh"), buckets=4)
    plain = etl.run(*files(), fresh)
    for name in (*plain.transformed.star.tables(),):
        assert sorted(map(str, house.snapshot().read(name).collect())) == sorted(map(str, fresh.snapshot().read(name).collect()))
    assert done.audit.frame().collect() == plain.audit.frame().collect()
    done.drop_stages()


def test_fingerprints_follow_files_and_parameters(spark, files, tmp_path):
    one = staging.fingerprint(files(), "a")
    assert one == staging.fingerprint(files(), "a") != staging.fingerprint(files(), "b")
    assert one != staging.fingerprint([files()[0].where("popularity > 1"), files()[1]], "a")
    fx.tracks(spark).limit(2).write.mode("append").parquet(f"{tmp_path}/tracks")
    assert one != staging.fingerprint(files(), "a")
