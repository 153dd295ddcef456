"""Edge cases of text and value functions."""

import pytest
from pyspark.sql import functions as F

from hexapla.functions import notation, text, values


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    ("function", "value", "want"),
    [
        (text.normalise_newlines, " a\r\nb\rc \t", "a\nb\nc"), (text.normalise_newlines, None, ""), (text.strip, " x\n", " x"),
        (text.html_to_text, "<p>a &amp; b</p><p>c<br>d</p>", "a & b\nc\nd"), (text.html_to_text, None, ""), (text.html_to_text, "<script>x</script>y", "y"),
        (text.keep_alnum, "a-b 1!é", "ab1é"), (text.safe_name, "a/b?c", "abc"), (text.safe_name, "??", "Unknown"), (text.safe_name, None, "Unknown"),
        (text.extension, ".MP4", "m4a"), (text.extension, "", ""), (text.url_name, "http://h/a/b.pdf?x=1#y", "b.pdf"), (text.url_extension, "http://h/a/b.PDF?x", "pdf"), (text.url_extension, "http://h/a/", ""),
        (text.path_number, "012_34_a/x", "34_a"), (text.number_head, "51_a", 51), (text.number_head, "x", 1_000_000), (text.code_of_hex, "zz", None), (text.code_of_hex, "00ff", 255),
        (text.syllable_count, "你好, ab c1!", 3), (text.syllable_count, "3. 主愛我", 3), (text.syllable_count, "ひかり", 3), (text.syllable_count, "hello 12", 1), (text.syllable_count, "hello world", 1), (text.syllable_count, "a=b 2c", 3), (text.grade, "x5y", "5"), (text.grade, "x", None), (text.font_family, "ABCDEF+Song", "Song"), (text.drop_space, " a \n b", "ab"),
        (text.nfkc, "Ａ１", "A1"), (text.plain_key, "Ａ．１ b", "a1b"), (text.display_width, "a你", 3), (text.ocr_line, "[1, 2] a……b | c", "a b c"),
    ],
)
def test_text(spark, function, value, want):
    assert one(spark, function, value) == want


@pytest.mark.parametrize(("label", "want"), [("副歌", ("chorus", 0)), (" 三 ", ("verse", 3)), ("十一", ("verse", 0)), ("12", ("verse", 12)), ("和散那", ("verse", 0)), ("", ("", 0)), (None, ("", 0))])
def test_labels(spark, label, want):
    assert tuple(one(spark, notation.label_kind, label)) == want


@pytest.mark.parametrize(
    ("line", "want"),
    [
        ("349 (475) 、救主正在等待   降E大调 3/4 ♩=88", ("349", "475", "", "", "救主正在等待", "降E大调", "3/4", "♩=88")),
        ("51 (乙)万古灵磐", ("51", "", "乙", "", "万古灵磐", "", "", "")), ("(甲) 51、万古灵磐 G调", ("51", "", "甲", "", "万古灵磐", "G调", "", "")),
        ("7、来 ♩=80   (三)", ("7", "", "", "三", "来", "", "", "♩=80")), ("没有编号的标题", ("", "", "", "", "", "", "", "")), ("", ("",) * 8),
    ],
)
def test_headers(spark, line, want):
    h = one(spark, notation.header, line)
    assert (h.old_no, h.new_no, h.version, h.tail_label, h.title, h.key_sig, h.time_sig, h.tempo) == want and h.title_line == line.strip()


@pytest.mark.parametrize(("line", "want"), [("1 2 3/|5`", True), ("救主", False), ("", False), ("  ", False), ("1救", False), ("zzzz1", False), ("bbcc12345 6", True), ("- . &", True)])
def test_notation_lines(spark, line, want):
    assert one(spark, notation.is_notation, line) is want


def test_notation_parts(spark):
    assert one(spark, notation.noise, "1–2。–") == ["–", "。"] and one(spark, notation.signature, "\\1 2|3 |?") == "12|3"
    assert one(spark, lambda c: notation.count_of(c, notation.NOTE_HEADS), "1q!A/|`") == 4
    assert tuple(one(spark, notation.marker, " 2 / 3 ")) == (2, 3) and one(spark, notation.marker, "2/x") is None
    assert one(spark, notation.label_of_line, "（副歌）") == "副歌" and one(spark, notation.label_of_line, "x (三)") == ""


def test_similarity(spark):
    df = spark.createDataFrame([("abcd", "bcde"), ("", "x"), (None, "x"), ("bc", "abcd")], "a string, b string")
    assert [r[0] for r in df.select(text.seq_ratio("a", "b")).collect()] == [0.75, 0.0, None, pytest.approx(2 / 3)]
    assert [r[0] for r in df.select(text.seq_coverage("a", "b")).collect()] == [0.75, 1.0, None, 1.0]


def test_values(spark):
    assert one(spark, lambda c: values.half_even(c), 2.5, "double") == 2.0
    assert one(spark, lambda c: values.floor_percent(c, F.lit(0)), 3, "int") == 300
    assert one(spark, lambda c: values.json_map(c), "{bad") == {}
    assert one(spark, lambda c: values.json_array(c), '["a"]') == ["a"]
    assert one(spark, lambda c: values.json_path(c, "$.a.b[0]", "string", "none"), '{"a": {"b": ["x"]}}') == "x"
    assert one(spark, lambda c: values.json_path(c, "$.a.b[0]", "string", "none"), "7") == "none"
    assert one(spark, values.real_keys, {"": "1", "_m": "2", "k": "3"}, "map<string,string>") == {"k": "3"}
    assert [one(spark, values.retryable, s, "int") for s in (429, 503, 404, None)] == [True, True, False, False]
    assert [one(spark, values.failure_class, s, "int") for s in (429, 404, None)] == ["network", "http_4xx", "network"]


@pytest.mark.parametrize(("signature", "want"), [(["a"], (1, True)), ([], (0, False)), (["a", "b", "a"], (2, True)), (["a", "b"], (0, False)), (["a", "a"], (1, True))])
def test_period(spark, signature, want):
    assert tuple(one(spark, values.period, signature, "array<string>")) == want


@pytest.mark.parametrize(("boxes", "want"), [([["a", "c", "d"], ["b", "c", "d"]], ["c", "d"]), ([["a", "c", "x"], ["b", "c", "y"]], ["c"]), ([["a", "c"]], []), ([["a"], ["b"]], []), ([["a", "c", "d"], ["b", "c"]], ["c"])])
def test_shared_tail(spark, boxes, want):
    assert one(spark, values.shared_tail, boxes, "array<array<string>>") == want


@pytest.mark.parametrize(("data", "kind", "want"), [(b"%PDF-1", "pdf", (True, True)), (b"", "pdf", (False, False)), (b"xxxxftyp", "m4a", (True, True)), (b"\xff\xfbx", "mp3", (True, True)), (b"y" * 101, "mp3", (False, True)), (b"ID3", "mp3", (True, True)), (b"z", "txt", (True, True))])
def test_intact(spark, data, kind, want):
    row = spark.createDataFrame([(bytearray(data), kind)], "c binary, k string").select(values.intact(F.col("c"), F.col("k")).alias("i")).first()["i"]
    assert tuple(row) == want


def test_conversion_takes_the_longest_phrase(spark):
    import random

    from hexapla.operators import slides

    table = {"后": "後", "皇后": "皇后", "皇": "王", "头发": "頭髮", "发": "發", "𠀀后": "x", "ab": "1", "abc": "2", "bcd": "3", "": "never"}

    def naive(t):
        out = ""
        while t:
            k = next((n for n in range(len(t), 0, -1) if t[:n] in table), 0)
            out, t = out + (table[t[:k]] if k else t[0]), t[k or 1 :]
        return out

    r = random.Random(3)
    texts = ["".join(r.choices(["后", "皇", "头", "发", "𠀀", "a", "b", "c", "d", " "], k=r.randint(0, 12))) for _ in range(300)] + ["皇后后面头发发", ""]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)] + [(999, None)], "k int, t string")
    got = {x.k: (x.c, x.key) for x in df.select("k", text.converted(F.col("t"), table).alias("c"), slides.compare_text(F.col("t"), table).alias("key")).collect()}
    assert all(got[k][0] == naive(t) for k, t in enumerate(texts)) and got[999] == (None, "") and got[300] == ("皇后後面頭髮發", "皇后後面頭髮發")
