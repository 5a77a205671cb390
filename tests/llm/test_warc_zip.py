import io
import random
import zipfile

import duckdb
import pytest

from strandweave.functions.scaling import scratch_path
from strandweave.llm import warc_zip

PAGES = "page_id long, url string, html string"


class Bytes:
    def __init__(self, data):
        self.data = data

    def read_at(self, n, at):
        return self.data[at:at + n]


def pages(spark):
    r = random.Random(3)
    rows = [(i, f"http://x/{i}", "".join(r.choice("<p>é\r\n\U0001f642 ") for _ in range(r.randrange(400)))) for i in range(300)]
    same, short = "é" * 60, "s" * 99
    rows += [(i, "http://x\r\nX-Evil: 1", same) for i in (900, 905, 910)] + [(i, None, short) for i in (920, 921)]
    rows += [(None, None, same), (None, None, "t" * 300), (None, None, "t" * 300), (900, "http://again", same), (930, "u", None),
             (931, "long", "y" * 300_000)]
    return spark.createDataFrame(rows, PAGES).repartition(4)


@pytest.mark.parametrize("empty", [False, True])
def test_query_and_sql(spark, tmp_path, empty):
    from pyspark.sql import functions as F
    data = spark.createDataFrame([], PAGES) if empty else pages(spark)
    data.withColumns({"digest": F.lit("mine"), "first": F.lit(1)}).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    got = [tuple(r) for r in warc_zip.op9_zip_archives(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(con.sql(warc_zip.OP9_SQL).fetchall(), key=repr)


def test_payloads_come_back_from_rolled_archives(spark, monkeypatch):
    data = pages(spark)
    archives = warc_zip.write_archives(data, scratch_path(spark, "warc"))
    assert archives.selectExpr("sum(records)").first()[0] == data.count()
    for row in archives.collect():  # the library's own reader agrees on the members
        with zipfile.ZipFile(row["archive"].removeprefix("file:")) as z:
            assert z.testzip() is None and z.namelist() == [warc_zip.DATA, warc_zip.INDEX]
            assert all(i.compress_type == zipfile.ZIP_STORED for i in z.infolist())
    texts = {r["html"].encode() for r in data.fillna("", ["html"]).collect()}
    read = warc_zip.read_archives(archives).collect()
    assert {bytes(r["payload"]) for r in read if r["payload"] is not None} == texts
    assert all((r["payload"] is None) == (r["record_type"] == "revisit") for r in read)


def test_directories(monkeypatch):
    plain = {"a": b"x" * 50, "b/é": b"", "c": b"yy"}
    for limit, comment in ((None, b""), (10, b"a comment"), (None, b"c" * 65_535), (None, b"PK\x05\x06" + b"x" * 40), (10, b"ab" + b"PK\x05\x06" * 9)):
        out = io.BytesIO()
        if limit:  # makes the library write ZIP64 records for small sizes
            monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
            monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
        with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
            for name, data in plain.items():
                with z.open(name, "w", force_zip64=True) as f:
                    f.write(data)
            z.comment = comment
        monkeypatch.undo()
        data = out.getvalue()
        found = warc_zip.central_directory(Bytes(data), len(data))
        assert {n: data[at:at + size] for n, (at, size) in found.items()} == plain


def test_what_has_no_ranges_is_refused():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("a", "x" * 100)
    for data in (out.getvalue(), b"no archive"):
        with pytest.raises(ValueError):
            warc_zip.central_directory(Bytes(data), len(data))
