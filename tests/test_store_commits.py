import threading

import pytest

from sievework.sources import sinks


def test_second_writer_is_refused(spark, tmp_path):
    root, df = str(tmp_path / "s"), spark.range(5)
    assert sinks.store_version(spark, root) == 0
    assert sinks.commit_store(df, root, 0) == 1 and sinks.commit_store(df.union(df), root, 1) == 2
    for base in (0, 1, 3):
        with pytest.raises(sinks.ConflictError):
            sinks.commit_store(df.limit(1), root, base)
    assert sinks.load_store(spark, root).count() == 10 and sinks.load_store(spark, root, 1).count() == 5
    assert len(list((tmp_path / "s" / "data").iterdir())) == 2 and not list((tmp_path / "s" / "waiting").glob("[!.]*"))  # nothing of the refused is left
    with pytest.raises(FileNotFoundError):
        sinks.load_store(spark, root, 9)
    with pytest.raises(FileNotFoundError):
        sinks.load_store(spark, str(tmp_path / "none"))


def test_the_name_of_a_version_is_taken_once(spark, tmp_path, monkeypatch):
    """The rename itself refuses a second manifest, also for a writer that looked before the first one committed."""
    root, df = str(tmp_path / "s"), spark.range(3)
    sinks.commit_store(df, root, 0)
    real = sinks.store_version
    monkeypatch.setattr(sinks, "store_version", lambda *_: 0)
    with pytest.raises(sinks.ConflictError):
        sinks.commit_store(df.union(df), root, 0)
    assert real(spark, root) == 1 and len(list((tmp_path / "s" / "data").iterdir())) == 1


def test_readers_and_writers_at_once(spark, tmp_path):
    root, seen, errors = str(tmp_path / "s"), [], []
    sinks.commit_store(spark.range(1), root, 0)

    def read():
        try:
            while not done.is_set():
                seen.append(sinks.load_store(spark, root).count())
        except Exception as error:
            errors.append(error)

    done, reader = threading.Event(), threading.Thread(target=read)
    reader.start()
    for _ in range(4):
        sinks.update_store(spark, root, lambda df: df.union(spark.range(1)))
    done.set()
    reader.join()
    assert not errors and seen == sorted(seen) and sinks.load_store(spark, root).count() == 5


def test_change_is_applied_anew_after_a_faster_writer(spark, tmp_path):
    root, calls = str(tmp_path / "s"), []
    sinks.commit_store(spark.range(1), root, 0)

    def change(df):
        if not calls:
            calls.append(1)
            sinks.commit_store(df.union(spark.range(7)), root, 1)
        return df.union(spark.range(1))

    assert sinks.update_store(spark, root, change) == 3 and sinks.load_store(spark, root).count() == 9
