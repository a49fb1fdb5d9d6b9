"""The WARC writer and reader against plain Python."""
import base64
import hashlib
import os

import pytest

from renewcast.llm.shared import scratch
from renewcast.llm.warc import op3_warc, put, read_warc, write_warc


def brute(rows, least=0):
    best = {}
    for p, _, h in rows:
        b = (h or "").encode()
        if p is not None and len(b) >= least:
            best[b] = max(best.get(b, p), p)
    out, seen = [], set()
    for p, _, h in sorted(rows, key=lambda r: str(r[1])):
        b = (h or "").encode()
        to = best.get(b) if p is not None and len(b) >= least else None
        if to == p and b not in seen:
            seen.add(b)
            to = None
        out.append((p, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if to is None else "revisit", to))
    return sorted(out, key=str)


def digest(df):
    return sorted(map(tuple, df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def test_table(spark, sf):
    rows = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()
    got = digest(op3_warc(spark, sf))
    assert got == brute([tuple(r) for r in rows])


def test_odd_rows_and_repeats(spark):
    rows = [(1, "http://a/", "same"), (2, "http://b/\r\nx", "same"), (3, None, None), (4, "u", ""), (5, "v", "é" * 3000), (5, "w", "é" * 3000), (5, "w", "é" * 3000), (None, "n", "same"), (9, "q", "a\r\n\r\nb")]
    rows += [(i, f"u{i}", f"page {i} " + "text " * i) for i in range(20, 300)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for least in (0, 3):
        a, b = scratch(spark, "warc"), scratch(spark, "warc")
        for folder, parts in ((a, 3), (b, 7)):
            files = write_warc(df.repartition(parts), folder, revisit_from=least, roll_bytes=2000, shard_bytes=20000)
            assert files.count() > 5
            assert digest(read_warc(spark, folder)) == brute(rows, least)
        a, b = a.removeprefix("file://"), b.removeprefix("file://")
        assert sorted(os.listdir(a)) == sorted(os.listdir(b)) and not [x for x in os.listdir(a) if x.endswith(".tmp")]
        assert all(open(f"{a}/{x}", "rb").read() == open(f"{b}/{x}", "rb").read() for x in os.listdir(a))
    back = {r["page_id"]: r["payload"] for r in read_warc(spark, scratch_of(spark, df)).where("record_type = 'response'").collect()}
    assert bytes(back[9]) == b"a\r\n\r\nb"
    empty = scratch(spark, "warc")
    write_warc(df.limit(0), empty)
    assert read_warc(spark, empty).count() == 0


def scratch_of(spark, df):
    folder = scratch(spark, "warc")
    write_warc(df, folder)
    return folder


def test_hot_payload(spark):
    """A third of all pages are empty, more than a join's task should hold of one key."""
    rows = [(i, f"u{i}", "" if i % 3 == 0 else f"page {i % 2500}") for i in range(4000)] + [(3, "again", "")]
    folder = scratch(spark, "warc")
    write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5), folder, shard_bytes=10000)
    assert digest(read_warc(spark, folder)) == brute(rows)


class Strict:
    """A store that refuses to rename onto a name that is taken, also one taken between look and rename."""

    def __init__(self, files, late=None):
        self.files, self.late = files, late

    def get_file_info(self, path):
        from pyarrow.fs import FileInfo, FileType

        return FileInfo(path, FileType.File if path in self.files else FileType.NotFound)

    def move(self, temp, path):
        if self.late:
            self.files[path], self.late = self.late, None
        if path in self.files:
            raise FileExistsError(path)
        self.files[path] = self.files.pop(temp)

    def delete_file(self, path):
        del self.files[path]


def test_second_attempt():
    for files, late in (({"t": 1}, None), ({"t": 1, "p": 1}, None), ({"t": 1}, 1)):
        put(Strict(files, late), "t", "p")
        assert files == {"p": 1}
    with pytest.raises(KeyError):
        put(Strict({}), "t", "p")
