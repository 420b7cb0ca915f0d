import collections
import hashlib
import zlib

from pyspark.sql import functions as F

from quantloom.llm import warc

from . import cases


def pages(spark, n=300):
    rows = [(i, f"https://host{i % 7}.example/{i}", cases.prose(i, 5 + i % 90)) for i in range(n)]
    rows += [(400, None, "no url"), (401, "https://null.example", None), (402, "https://a.example/\r\nX: y", "line\r\n\r\nWARC/1.1\r\n\r\nin the body"),
             (403, "https://long.example", "x" * 300_000), (404, "https://é.example", "ß漢字"), (405, "https://twice.example", "same"),
             (405, "https://twice.example", "same"), (None, "https://noid.example", "no id")]
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def records_of(path):
    found = {}
    for file in path.rglob("part-*"):
        segment = int(file.parent.name.partition("=")[2])
        found[segment] = file.read_bytes()
    return found


def test_files_are_warc_and_the_manifest_lists_them(spark, tmp_path):
    first = tmp_path / "first"
    warc.write_warc(pages(spark), str(first), per_segment=128)
    files = records_of(first)
    listed = warc.manifest(spark, str(first)).collect()
    assert len(listed) == 308
    for r in listed:
        data = files[r.segment][r.offset:r.offset + r.length]
        assert data.startswith(b"WARC/1.1\r\n") and data.endswith(b"\r\n\r\n") and hashlib.sha256(data).hexdigest() == r.digest
    for segment, data in files.items():
        assert sum(r.length for r in listed if r.segment == segment) == len(data)


def test_equal_replicas_have_no_differences(spark, tmp_path):
    first, second = str(tmp_path / "a"), str(tmp_path / "b")
    warc.write_warc(pages(spark).repartition(5), first, per_segment=128)
    warc.write_warc(pages(spark).coalesce(1), second, per_segment=128)
    assert warc.audit(spark, first, second, span=256, fan=2).collect() == []


def test_every_damage_is_located(spark, tmp_path):
    """A changed character, a lost file, bytes cut from a file's end, and a broken header, against a plain comparison."""
    first, second = tmp_path / "a", tmp_path / "b"
    warc.write_warc(pages(spark), str(first), per_segment=64)
    changed = pages(spark).withColumn("html", F.when(F.col("page_id") == 17, F.overlay("html", F.lit("#"), F.lit(3), F.lit(1))).otherwise(F.col("html")))
    warc.write_warc(changed.where("page_id <> 255"), str(second), per_segment=64)
    for file in second.rglob("part-*"):
        data = file.read_bytes()
        crc = file.with_name(f".{file.name}.crc")
        if "segment=1" in str(file.parent):
            file.write_bytes(data[:-20])
            crc.unlink(missing_ok=True)
        if "segment=2" in str(file.parent):
            file.write_bytes(data.replace(b"Content-Length", b"Content-Lengxh", 1))
            crc.unlink(missing_ok=True)
        if "segment=4" in str(file.parent):
            file.unlink()
            crc.unlink(missing_ok=True)
    want = differences(*(warc.manifest(spark, str(p)).collect() for p in (first, second)))
    for span, fan in ((256, 2), (1 << 16, 16)):
        found = warc.audit(spark, str(first), str(second), span=span, fan=fan).collect()
        assert sorted((r.segment, r.offset, r.status) for r in found) == want
    assert {k[0] for k in want} >= {0, 1, 2, 3, 4}


def differences(a, b):
    """Records by id and digest, then by id in order; the plain way."""
    left = []
    for own, other in ((a, b), (b, a)):
        rest = collections.Counter((r.segment, r.record_id, r.digest) for r in other)
        mine = []
        for r in sorted(own, key=lambda r: r.offset):
            key = (r.segment, r.record_id, r.digest)
            if rest[key]:
                rest[key] -= 1
            else:
                mine.append(r)
        left.append(mine)
    out, second = [], list(left[1])
    for r in left[0]:
        twin = next((x for x in second if r.record_id is not None and (x.segment, x.record_id) == (r.segment, r.record_id)), None)
        if twin is not None:
            second.remove(twin)
        out.append((r.segment, r.offset, "missing" if twin is None else "changed"))
    return sorted(out + [(r.segment, r.offset, "extra") for r in second])


def test_damage_that_changes_a_length_is_that_record_alone(spark, tmp_path):
    first, second = str(tmp_path / "a"), str(tmp_path / "b")
    longer = F.when(F.col("page_id") == 17, F.concat("html", F.lit(" and more"))).when(F.col("page_id") == 18, F.lit("")).otherwise(F.col("html"))
    warc.write_warc(pages(spark), first)
    warc.write_warc(pages(spark).withColumn("html", longer), second)
    found = warc.audit(spark, first, second, span=256, fan=2).collect()
    assert sorted((r.uri, r.status) for r in found) == [("https://host3.example/17", "changed"), ("https://host4.example/18", "changed")]


def test_replicas_written_together_and_compressed(spark, tmp_path):
    """As if written one by one; gzip changes neither offsets nor digests."""
    warc.write_warc(pages(spark), str(tmp_path / "plain"), per_segment=64)
    warc.write_warc(pages(spark), {f"{tmp_path}/both/first": lambda p, own: p, f"{tmp_path}/both/second": lambda p, own: warc.damaged(p, own, 64)}, per_segment=64, compress=True)
    lists = [sorted(map(tuple, warc.manifest(spark, str(p)).collect()), key=repr) for p in (tmp_path / "plain", tmp_path / "both" / "replica=first")]
    assert lists[0] == lists[1] and len(lists[0]) == 308
    assert all(f.read_bytes()[:2] == b"\x1f\x8b" for f in (tmp_path / "both").rglob("part-*"))
    found = warc.audit(spark, f"{tmp_path}/both/replica=first", f"{tmp_path}/both/replica=second", span=256, fan=2).collect()
    hurt = {i for i in range(300) if i % 50 == 7}
    assert {r.uri for r in found if r.status == "changed"} == {f"https://host{i % 7}.example/{i}" for i in hurt}
    assert {r.uri for r in found if r.status == "missing"} == {f"https://host{i % 7}.example/{i}" for i in range(300) if i % 64 == 63}
    assert not [r for r in found if r.status == "extra"]


def test_damaged_gzip_and_empty_tables(spark, tmp_path):
    assert warc.unpacked(b"plain") == b"plain"
    two = b"".join(zlib.compress(x, wbits=31) for x in (b"one", b"two"))
    assert warc.unpacked(two) == b"onetwo" and warc.unpacked(two[:-12]).startswith(b"one")
    none = pages(spark).where("false")
    warc.write_warc(none, str(tmp_path / "a"))
    warc.write_warc(none, str(tmp_path / "b"))
    assert warc.audit(spark, str(tmp_path / "a"), str(tmp_path / "b")).collect() == []
    clash = pages(spark, 20).withColumns({c: F.lit("clash") for c in ("segment", "part", "node", "replica", "value", "digest")})
    warc.write_warc(clash, str(tmp_path / "c"))
    assert warc.manifest(spark, str(tmp_path / "c")).count() == 28


def test_root_follows_the_definition(spark):
    records = [(0, 0, 10, "a"), (0, 10, 10, "b"), (0, 20, 10, "c"), (0, 70, 5, "d")]
    df = spark.createDataFrame(records, "segment long, offset long, length long, digest string")
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    low = {0: sha("0:10:a\n10:10:b"), 1: sha("20:10:c"), 3: sha("70:5:d")}
    nodes = warc.ranges(df, 20)
    assert {r.node: r.hash for r in nodes.collect()} == low
    top = warc.parents(warc.parents(nodes, 2), 2).collect()
    middle = {0: sha(f"0:{low[0]}\n1:{low[1]}"), 1: sha(f"3:{low[3]}")}
    assert [r.hash for r in top] == [sha(f"0:{middle[0]}\n1:{middle[1]}")]


def test_no_file_grows_with_pages_of_one_segment(spark, tmp_path):
    """Pages without id, and copies of one page, are spread over files of bounded size, none lost, and damage is found in any of them."""
    rows = [(i, f"https://a.example/{i}", cases.prose(i, 30)) for i in range(100)]
    rows += [(None, f"https://b.example/{i}", cases.prose(i, 30)) for i in range(400)] + [(2000, "https://c.example", "twice")] * 400
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for name, n, table in (("a", 3, df), ("b", 5, df), ("c", 4, df.withColumn("html", F.when(F.col("url") == "https://b.example/7", F.translate("html", "e", "#")).otherwise(F.col("html"))))):
        warc.write_warc(table.repartition(n), str(tmp_path / name), per_segment=1024, file_bytes=40_000)
    sizes = [f.stat().st_size for f in (tmp_path / "a").rglob("part-*")]
    assert max(sizes) < 50_000 and len(sizes) > 8
    listed = warc.manifest(spark, str(tmp_path / "a")).collect()
    assert len(listed) == len(rows) and len({(r.segment, r.offset) for r in listed}) == len(rows)
    assert sum(r.length for r in listed) == sum(sizes) and {r.segment for r in listed} == {-1, 0, 1}
    assert warc.audit(spark, str(tmp_path / "a"), str(tmp_path / "b"), span=256, fan=2).collect() == []
    assert "https://b.example/7" in {r.uri for r in warc.audit(spark, str(tmp_path / "a"), str(tmp_path / "c"), span=256, fan=2).collect()}
