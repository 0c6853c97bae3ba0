import gzip

import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from permscope.llm import warc
from permscope.llm.tables import scratch_path


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(k, f"http://h{k % 3}.example/a?b={k}", f"<p>{k % 7}</p>") for k in range(60)]
    rows += [(100 + k, "http://hot.example/", "same" * 3000) for k in range(30)]
    rows += [(200, None, None), (201, "http://x/", ""), (None, "http://y z/\n", "same" * 3000), (202, "http://é/", "naïve 日本"),
             (203, "u", "x\r\n\r\ny"), (100, "http://hot.example/", "same" * 3000), (0, "twice", "another")]
    return rows, spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, key string").repartition(4)


def expected(rows, least):
    first = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if i is not None and len(b) >= least:
            first[b] = min(first.get(b, i), i)
    out = []
    for i, u, h in rows:
        b = (h or "").encode()
        again = i is not None and len(b) >= least and first[b] != i
        out.append((i, len(b), warc.sha1_base32(b), "revisit" if again else "response", first[b] if again else None))
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


@pytest.mark.parametrize("least", [0, 10])
def test_round_trip(spark, pages, least):
    rows, df = pages
    path = scratch_path(spark, "warc")
    assert warc.write_warc(df, path, min_bytes=least) > 0
    got = warc.read_pages(spark, path)
    assert order(map(tuple, got.drop("url", "payload").collect())) == order(expected(rows, least))
    payload = {(r.page_id, bytes(r.payload)) for r in got.where("record_type = 'response'").collect()}
    assert payload == {(i, (h or "").encode()) for (i, _, h), e in zip(rows, expected(rows, least)) if e[3] == "response"}
    urls = {r.url for r in got.collect()}
    assert None in urls and "http://y%20z/%0A" in urls and "http://é/" in urls
    # ordinary gzip members: any reader can unpack them
    fs, root = pafs.FileSystem.from_uri(path)
    for f in fs.get_file_info(pafs.FileSelector(root)):
        with fs.open_input_stream(f.path, compression=None) as s:
            assert gzip.decompress(s.read()).startswith(b"WARC/1.1\r\n")


def test_plain_files_and_members_without_skip_lengths(spark):
    path = scratch_path(spark, "plain")
    fs, root = pafs.FileSystem.from_uri(path)
    fs.create_dir(root)
    many = [warc.record("response", f"urn:x-page:{k}:D", "http://a/", "2020-01-01T00:00:00Z", bytes([65 + k]) * (100_000 * k),
                        warc.sha1_base32(bytes([65 + k]) * (100_000 * k))) for k in range(4)]
    info = b"WARC/1.0\r\nWARC-Type: warcinfo\r\nContent-Type: application/warc-fields\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    for name, data in (("a.warc", info + b"".join(many)), ("b.warc.gz", b"".join(map(gzip.compress, [info, *many]))),
                       ("c.warc.gz", b"".join(map(warc.gzip_member, [info, *many]))), ("_skip.warc", b"junk"), ("d.txt", b"junk")):
        with fs.open_output_stream(f"{root}/{name}", compression=None) as s:
            s.write(data)
    warc.register(spark)
    df = spark.read.format("warc").option("verify", "true").load(path)
    got = df.select("file", "record_id", "payload_bytes", "http_status").collect()
    assert len(got) == 15
    for name in ("a.warc", "b.warc.gz", "c.warc.gz"):
        mine = [r for r in got if r.file.endswith(name)]
        assert [r.payload_bytes for r in mine] == [5, 0, 100_000, 200_000, 300_000]
        assert [r.http_status for r in mine] == [None, 200, 200, 200, 200]
    bare = spark.read.format("warc").option("payload", "false").load(path)
    assert bare.where("payload is not null").count() == 0 and bare.count() == 15
    assert df.where("record_id = 'urn:x-page:2:D'").count() == 3


def test_predicates_skip_payloads(spark, pages, monkeypatch):
    path = scratch_path(spark, "warc")
    warc.write_warc(pages[1], path)
    warc.register(spark)
    reader = warc.WarcReader({"path": path})
    left = list(reader.pushFilters([warc.EqualTo(("warc_type",), "revisit"), warc.StringStartsWith(("target_uri",), "http://hot"),
                                    warc.EqualTo(("payload_bytes",), 3)]))
    assert [f.attribute for f in left] == [("payload_bytes",)]
    decoded = []
    own = warc.WarcReader._payload
    monkeypatch.setattr(warc.WarcReader, "_payload", lambda self, *a: decoded.append(1) or own(self, *a))
    n = sum(b.num_rows for p in reader.partitions() for b in reader.read(p))
    assert n == len(decoded) == 29
    df = spark.read.format("warc").load(path)
    assert df.where((F.col("warc_type") == "revisit") & F.col("target_uri").startswith("http://hot")).count() == 29
    assert df.where("refers_to is null and target_uri in ('twice', 'u')").count() == 2
    assert df.where("target_uri is null").count() == 1


def test_damaged_files_are_reported(spark):
    path = scratch_path(spark, "bad")
    fs, root = pafs.FileSystem.from_uri(path)
    fs.create_dir(root)
    whole = warc.gzip_member(warc.record("response", "urn:x-page:1:D", None, "2020-01-01T00:00:00Z", b"x" * 9000, "WRONG"))
    for name, data, what in (("a.warc.gz", whole[:60], "cut off"), ("b.warc.gz", b"PK" + whole, "no gzip member"),
                             ("c.warc.gz", whole, "digest differs")):
        with fs.open_output_stream(f"{root}/{name}", compression=None) as s:
            s.write(data)
        reader = warc.WarcReader({"path": f"{path}/{name}", "verify": "true"})
        with pytest.raises(ValueError, match=what):
            for p in reader.partitions():
                list(reader.read(p))


def test_empty_table(spark, pages):
    path = scratch_path(spark, "none")
    assert warc.write_warc(pages[1].limit(0), path) == 0
    assert warc.read_pages(spark, path).count() == 0
