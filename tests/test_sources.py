"""Sources and streams, on small files."""

import datetime
import json
import struct

import pytest
from pyspark.sql import types as T

from hexapla.sources import files, records
from hexapla.streaming import snapshots


def test_pages(spark, tmp_path):
    (tmp_path / "page_1.json").write_text(json.dumps({"data": [{"no": "1", "name": "a", "lyrics": [{"text": "x"}]}, {"no": "2"}], "current_page": 1, "last_page": 3, "total": 4}, indent=1))
    (tmp_path / "page_2.json").write_text("{broken")
    (tmp_path / "page_3.json").write_text('[{"no": "9"}]')
    pages = records.pages(spark, f"file://{tmp_path}")
    assert sorted(r.no for r in records.records(pages).collect()) == ["1", "2", "9"]
    check = records.total_check(pages).first()
    assert (check.declared, check.there, check.agrees) == (4, 2, False)
    assert records.first_pages(pages, 1, 2).count() == 2


def test_url_map(spark, tmp_path):
    (tmp_path / "map.txt").write_text("1|d1|http://h/x?y\nbad\n2|d2|http://h/x\n3|d3|http://h/z\n")
    assert sorted(tuple(r) for r in records.url_map(spark, f"file://{tmp_path}/map.txt").collect()) == [("x", "2", "d2", "http://h/x"), ("z", "3", "d3", "http://h/z")]


def test_reports(spark, tmp_path):
    schema = T.StructType([T.StructField("no", T.StringType())])
    assert records.report(spark, f"file://{tmp_path}/none.json", schema).count() == 0
    (tmp_path / "r.json").write_text('[{"no": "1"},\n {"no": "2"}]\n')
    assert records.report(spark, f"file://{tmp_path}/r.json", schema).count() == 2
    records.append_lines(spark.createDataFrame([("1", None, "u")], "id string, d string, url string"), ["id", "d", "url"], f"file://{tmp_path}/out")
    assert spark.read.text(f"file://{tmp_path}/out").first()[0] == "1||u"


def test_files(spark, tmp_path):
    for d, n, data in (("001_12_a", "x_12.pdf", b"%PDF-1"), ("001_12_a", "y.mp3", b"ID3xx"), ("002_7", "z_12.pdf", b"no")):
        (tmp_path / d).mkdir(exist_ok=True)
        (tmp_path / d / n).write_bytes(data)
    found = files.files(spark, f"file://{tmp_path}", content=True)
    assert {r.no for r in files.record_directories(found).collect()} == {"12_a", "7"}
    assert {r.path[-8:]: r.strict for r in files.integrity(found).collect()} == {"x_12.pdf": True, "_a/y.mp3": True, "z_12.pdf": False}
    assert files.index_by_number(found).first()["path"].endswith("001_12_a/x_12.pdf")
    assert {r.directory: len(r.manifest) for r in files.checksums(found).collect()} == {"001_12_a": 2, "002_7": 1}
    assert files.stale(found, found).count() == 0
    numbers = spark.createDataFrame([("7",), ("1234",)], "number string")
    assert sorted(tuple(r) for r in files.name_candidates(numbers).collect()) == [("1234", "1234"), ("7", "007"), ("7", "7")]
    for n in ("s10.txt", "s9.txt"):
        (tmp_path / n).write_text(n)
    assert [r.text for r in files.texts_in_order(spark, f"file://{tmp_path}/*.txt").collect()] == ["s9.txt", "s10.txt"]


def test_merge_stream(spark, tmp_path):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
    source = T.StructType([*schema.fields, T.StructField("o", T.LongType())])
    data, target = f"file://{tmp_path}/in", f"file://{tmp_path}/out"
    for batch in ([(1, "a", 0), (2, "b", 1), (1, "c", 2)], [(1, "", 3), (3, "d", 4)]):
        spark.createDataFrame(batch, source).coalesce(1).write.mode("append").parquet(data)
        stream = spark.readStream.schema(source).parquet(data)
        snapshots.merge_stream(stream, target, f"file://{tmp_path}/cp", "k", "o", {"v": "text"}, schema=schema).awaitTermination()
    assert sorted(tuple(r) for r in spark.read.parquet(f"{target}/1").collect()) == [(1, "c"), (2, "b"), (3, "d")]


def test_session_stream(spark, tmp_path):
    at = lambda m: datetime.datetime(2024, 1, 1, 0, m)
    spark.createDataFrame([(1, at(0)), (1, at(4)), (1, at(30))], "u long, t timestamp").coalesce(1).write.parquet(f"file://{tmp_path}/ev")
    seen = []
    stream = snapshots.session_stream(spark.readStream.schema("u long, t timestamp").parquet(f"file://{tmp_path}/ev"), ["u"], "t", "5 minutes", "1 minute")
    snapshots.run_to_end(stream, lambda df, n: seen.extend(r.n for r in df.collect()), f"file://{tmp_path}/cp2")
    assert seen == [2]


def test_a_failed_report_leaves_the_old_one(spark, tmp_path):
    from pyspark.sql import functions as F

    path = f"file://{tmp_path}/report"
    records.write_report(spark.createDataFrame([(1, "a")], "k int, v string"), path)
    broken = spark.createDataFrame([(2, "b")], "k int, v string").withColumn("v", F.expr("raise_error('no')"))
    try:
        records.write_report(broken, path)
    except Exception as e:  # noqa: BLE001
        assert "no" in str(e)
    assert [tuple(r) for r in spark.read.schema("k int, v string").json(path).collect()] == [(1, "a")]
    assert records.rebuild_table(spark.createDataFrame([(3, "c"), (4, "d")], "k int, v string"), path) == 2
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [3, 4]


def test_overlaps_of_all_lengths(spark):
    import random

    from hexapla.operators import sequence

    r = random.Random(5)
    make = lambda n: [(r.choice("xy"), i, a := r.uniform(-50, 50), a + r.choice((0, 0.5, 3, 40, 10_000)) * r.random()) for i in range(n)]
    a, b = make(80), make(80)
    a += [("x", 900, 1.0, 2.0), ("x", 901, 1.0, 2.0)]
    b += [("x", 900, 1.0, 2.0), ("x", 901, 2.0, 3.0), ("x", 902, 0.0, 1.0)]
    one = spark.createDataFrame(a, "k string, i int, s double, t double")
    two = spark.createDataFrame(b, "k string, j int, s double, t double")
    got = sorted(tuple(x) for x in sequence.overlaps(one, two, "k", "i", "j", ("s", "t"), ("s", "t"), 2.0).collect())
    assert got == sorted((k, i, j) for k, i, s, t in a for m, j, u, v in b if k == m and s < t and u < v and s < v and u < t)


def test_records_of_decks():
    import struct

    from hexapla.sources import media

    leaf = lambda kind, data: struct.pack("<HHI", 0, kind, len(data)) + data
    box = lambda data: struct.pack("<HHI", 15, 1, len(data)) + data
    role = lambda k: leaf(media.ROLE, struct.pack("<I", k))
    a, b = leaf(media.WIDE, "詩一".encode("utf-16-le")), leaf(media.NARROW, b"two")
    assert list(media.text_records(box(role(5) + a) + box(box(role(0)) + b))) == [(5, "詩一"), (0, "two")]
    broken = struct.pack("<HHI", 0, media.WIDE, 999)
    # a record that its container can't hold ends the container, not what is behind it
    assert list(media.text_records(box(role(5) + a + broken) + b)) == [(5, "詩一"), (5, "two")]
    assert list(media.text_records(a + broken + b)) == [(None, "詩一")]
    assert list(media.text_records(b"")) == [] and list(media.text_records(b"\x00" * 5)) == []
    deep = b""
    for _ in range(3000):
        deep = box(deep)
    assert list(media.text_records(deep + b)) == [(None, "two")]


def test_durations_and_bad_files(spark):
    import struct

    from hexapla.sources import media

    box = lambda kind, data: struct.pack(">I4s", len(data) + 8, kind) + data
    old = box(b"moov", box(b"mvhd", bytes(12) + struct.pack(">II", 1000, 144117)))
    new = box(b"moov", box(b"udta", b"x") + box(b"mvhd", b"\x01" + bytes(19) + struct.pack(">IQ", 1000, 2500)))
    frame = b"\xff\xfb\x90\x00"
    xing = frame + bytes(32) + b"Xing" + struct.pack(">II", 1, 1000) + bytes(100)
    tagged = b"ID3\x03\x00\x00\x00\x00\x00\x0a" + b"\xff\xfb\x90\x00aaaaaa" + frame + bytes(1596)
    data = [("a", "m4a", box(b"ftyp", b"M4A ") + old), ("b", "mp4", new), ("c", "mp3", xing), ("d", "mp3", tagged), ("e", "mp3", b"\x00" * 50), ("f", "m4a", b"\x00\x00\x00\x30moov"), ("g", "mp3", None), ("h", "wav", b"RIFF"), ("i", "m4a", box(b"moov", box(b"mvhd", bytes(20))))]
    got = {r.path: (r.seconds, r.reason) for r in media.durations(spark.createDataFrame(data, "path string, ext string, content binary").repartition(3)).collect()}
    assert got["a"] == (144.117, None) and got["b"] == (2.5, None) and got["c"] == (round(1000 * 1152 / 44100, 3), None) and got["d"] == (0.1, None)
    assert all(got[k][0] is None and got[k][1] for k in "efghi") and got["g"][1] == "no file"
    named = spark.createDataFrame([("1", "piano", "a"), ("1", "vocal", "zz"), ("1", "_error", "a"), ("2", "piano", "e")], "no string, version string, path string")
    maps = {r.no: (r.seconds, r.reasons) for r in media.duration_maps(named, media.durations(spark.createDataFrame(data, "path string, ext string, content binary"))).collect()}
    assert maps["1"] == ({"piano": 144.117, "vocal": None}, {"vocal": "no file"}) and maps["2"] == ({"piano": None}, {"piano": "no frame"})


def test_paged_source(spark, tmp_path):
    """Cache first, a broken cached page is a miss, refresh passes over it, missing and broken pages are rows, limits hold."""
    from hexapla.sources import paged

    site, cache = tmp_path / "site", tmp_path / "cache"
    site.mkdir()
    for k in (1, 2, 4, 5):
        (site / f"page_{k}.json").write_text("{broken" if k == 4 else json.dumps({"data": [k], "last_page": 5}))
    spark.dataSource.register(paged.PagedSource)
    read = lambda **o: {r.number: (r.origin, r.raw and json.loads(r.raw)["data"]) for r in spark.read.format("paged").option("path", str(site)).options(**o).load().collect()}
    plain = {1: ("site", [1]), 2: ("site", [2]), 3: ("missing", None), 4: ("corrupt", None), 5: ("site", [5])}
    assert read() == plain and not cache.exists()
    assert read(cache=f"file://{cache}") == plain
    assert read(cache=str(cache)) == {k: ("cache" if v[0] == "site" else v[0], v[1]) for k, v in plain.items()}
    (cache / "page_2.json").write_text("[oh")
    (site / "page_1.json").write_text(json.dumps({"data": ["new"], "last_page": 2}))
    assert read(cache=str(cache))[2] == ("site", [2]) and read(cache=str(cache))[1] == ("cache", [1])
    assert read(cache=str(cache), pages="2").keys() == {1, 2}
    assert read(cache=str(cache), refresh="true") == {1: ("site", ["new"]), 2: ("site", [2])}
    assert read(cache=str(cache))[1] == ("cache", ["new"])
    assert {r.origin for r in spark.read.format("paged").option("path", str(tmp_path / "none")).load().collect()} == {"missing"}


@pytest.mark.parametrize("last", [1, 32, 33, 90_000, 1_000_000])
def test_many_pages_are_few_partitions(tmp_path, last):
    """Each page is in one partition, in order, and a partition is not as small as a page where there are many."""
    from hexapla.sources import paged

    (tmp_path / "page_1.json").write_text(json.dumps({"data": [], "last_page": last}))
    parts = paged.PagedReader({"path": str(tmp_path)}).partitions()
    assert len(parts) <= max(32, -(-last // 1024))
    assert [k for p in parts for k in range(p.first, p.last + 1)] == list(range(1, last + 1))


@pytest.mark.parametrize("backward", [False, True])
def test_compound_files(spark, backward):
    """Streams of all sizes, in order and backward; circles, broken chains and cut files are errors of their own row."""
    import random

    from hexapla.sources import compound, media

    r = random.Random(1)
    streams = {f"s{n}": r.randbytes(n) for n in (0, 1, 63, 64, 65, 511, 513, 4095, 4096, 4097, 70_000)}
    data = compound.written(streams, backward)
    got = compound.Compound(data)
    assert set(got.names()) == set(streams) and all(got.stream(k) == v for k, v in streams.items())
    with pytest.raises(ValueError, match="no stream"):
        got.stream("other")
    for size in (0, 100, 511):
        with pytest.raises(ValueError, match="not a compound"):
            compound.Compound(data[:size])
    errors = set()
    for _ in range(300):  # whatever is broken, it ends, with bytes or a reason
        broken = bytearray(data[: r.choice([len(data), r.randint(512, len(data))])])
        for _ in range(r.randint(0, 4)):
            at = r.choice([r.randrange(len(broken)), r.randrange(len(broken) - 512 * 3, len(broken)), r.randrange(44, 80)])
            broken[max(at, 0) % len(broken)] = r.randrange(256)
        try:
            one = compound.Compound(bytes(broken))
            for name in one.names():
                one.stream(name)
        except (ValueError, struct.error) as e:
            errors.add(str(e))
    assert {"the file is cut off", "a chain of sectors is broken"} <= errors
    atom = lambda kind, body: struct.pack("<HHI", 0, kind, len(body)) + body
    deck = atom(media.ROLE, struct.pack("<I", media.BODY)) + atom(media.NARROW, b"la la " * 900)
    rows = [("a", compound.written({media.DECK: deck}, backward)), ("b", compound.written({"other": b"x"})), ("c", data[:700]), ("d", deck), ("e", None)]
    found = {x.path: (x.text, x.error) for x in media.decks(spark.createDataFrame(rows, "path string, content binary")).collect()}
    assert found["a"] == found["d"] == ("la la " * 900, None) and found["b"] == (None, f"no stream {media.DECK}") and found["c"] == (None, "the file is cut off") and found["e"][0] is None
