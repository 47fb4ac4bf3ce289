"""Archive members, streamed dump rows, refusals and resuming."""

from __future__ import annotations

import io
import tarfile
import zipfile

import pytest

from glyphloom.sources import archives

POSTS = '<?xml version="1.0"?>\n<posts>\n' + "".join(f'<row Id="{k}" PostTypeId="1" Title="t&amp;{k}"/>\n' for k in range(5000)) + "</posts>"


def test_rows_of_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("Posts.xml", POSTS)
        z.writestr("readme.txt", "x")
    with tarfile.open(tmp_path / "b.tar.gz", "w:gz") as t:
        info = tarfile.TarInfo("site/Comments.xml")
        data = b'<comments><row Id="1" PostId="2" Text="&#951;"/></comments>'
        info.size = len(data)
        t.addfile(info, io.BytesIO(data))
    rows = archives.archive_rows(spark, f"{tmp_path}/*").cache()
    posts = archives.table_of(rows, "Posts")
    assert posts.count() == 5000 and posts.where("Title = 't&17'").first()["Id"] == "17"
    assert archives.table_of(rows, "Comments").first()["Text"] == "η"
    assert archives.archive_rows(spark, f"{tmp_path}/*", streamed=False).count() == rows.count() == 5001
    name = posts.first()["archive"]
    done = spark.createDataFrame([(name, "Posts", 4990)], "archive string, table string, ordinal bigint")
    assert archives.resumed(rows, done).count() == 11
    assert archives.shrunk(rows, done).count() == 0
    assert archives.shrunk(rows, spark.createDataFrame([(name, "Posts", 6000)], done.schema)).count() == 1


@pytest.mark.parametrize("text", ['<!DOCTYPE x><posts><row Id="1"/></posts>', "<other><row/></other>", "<posts><row><b/></row></posts>", "<posts><x/></posts>"])
def test_refused_documents(text):
    with pytest.raises(ValueError):
        list(archives.dump_rows(io.BytesIO(text.encode()), "Posts"))


def test_refused_rows_and_members(monkeypatch):
    monkeypatch.setattr(archives, "MOST_ROW_BYTES", 1 << 17)
    with pytest.raises(ValueError):
        list(archives.dump_rows(io.BytesIO(f'<posts><row Id="{"x" * (1 << 19)}"/></posts>'.encode()), "Posts"))
    assert not any(map(archives.safe_member, ("/a", "../a", "a/../b", "C:/x", "")))
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w") as z:
        z.writestr("../Posts.xml", "x")
    with pytest.raises(ValueError):
        list(archives.members(raw.getvalue()))


def test_member_tables():
    assert archives.member_table("x/posts.XML") == "Posts" and archives.member_table("Votes.xml") is None
