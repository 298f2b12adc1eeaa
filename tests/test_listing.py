"""Listings written group by group, compared with another engine's."""

import duckdb
import pytest

from basalt.sources import listing


def _tree(root, folders, files):
    n = 0
    for i in range(folders):
        folder = root / f"year={2000 + i % 20}" / f"part {i}"
        folder.mkdir(parents=True)
        for j in range(files):
            (folder / f"f{j}.txt").write_bytes(b"x" * ((n := n + 1) % 700))
    return n


def _keys(m):
    return {r["key"]: r["size"] for r in m.collect()}


@pytest.mark.parametrize(("depth", "group"), [(1, 3), (2, 50)])
def test_sizes_are_those_of_read_blob(spark, tmp_path, depth, group):
    root = tmp_path / "store [1]"
    n = _tree(root, 200, 30)
    for odd in ("top.txt", "year=2001/mid.txt", "year=2001/a{b}*?[c] %20+/x.txt", "deep/a/b/c/d.txt"):
        (root / odd).parent.mkdir(parents=True, exist_ok=True)
        (root / odd).write_text("odd " + odd)
    (root / "empty").mkdir()
    (root / "deep/a/nothing %.txt").touch()
    for hidden in ("_hidden/x.txt", ".x", "year=2001/_SUCCESS"):
        (root / hidden).parent.mkdir(exist_ok=True)
        (root / hidden).write_text("hidden")
    rows = listing.write_listing(spark, str(root), str(tmp_path / "out"), depth=depth, group_folders=group)
    got = _keys(listing.list_written(rows, str(root), "raw"))
    want = duckdb.execute(f"SELECT filename, size FROM read_blob('{tmp_path}/store ?1?/**')").fetchall()
    want = {f.removeprefix(f"{root}/"): size for f, size in want}
    assert got == {k: v for k, v in want.items() if not any(p.startswith(("_", ".")) for p in k.split("/"))}
    assert len(got) == n + 5 and got["deep/a/nothing %.txt"] == 0


def test_listing_of_an_empty_store(spark, tmp_path):
    (tmp_path / "store").mkdir()
    assert listing.write_listing(spark, str(tmp_path / "store"), str(tmp_path / "out")).collect() == []


def test_the_driver_indexes_one_group_at_a_time(spark, tmp_path, monkeypatch):
    _tree(tmp_path / "store", 20, 5)
    seen, real = [], listing._index
    monkeypatch.setattr(listing, "_index", lambda s, paths: seen.append(len(paths)) or real(s, paths))
    rows = listing.write_listing(spark, str(tmp_path / "store"), str(tmp_path / "out"), depth=2, group_folders=8)
    assert seen == [8, 8, 4] and rows.count() == 100
    whole = listing.list_files(spark, str(tmp_path / "store"), "raw")
    written = listing.list_written(rows, str(tmp_path / "store"), "raw")
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, written.collect()))
