import pytest

from sievework import common


def test_clear_removes_what_the_application_has_stored(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(common, "shared_folder", lambda _: str(tmp_path))
    held = common.stored(spark.range(5))
    assert held.count() == 5 and list((tmp_path / "tables").glob("*/*"))
    other = tmp_path / "tables" / "another-application"
    other.mkdir()
    common.clear(spark)
    assert [p.name for p in (tmp_path / "tables").iterdir()] == ["another-application"]
    with pytest.raises(Exception, match="exist"):
        held.count()
    common.clear(spark)
