import pytest

from textjury.sources.lines import (
    BAD_LABEL,
    NO_TAB,
    OTHER_LABEL,
    checked_lines,
    parse_labelled,
    parse_or_quarantine,
    read_labelled,
    read_messages,
)


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value STRING")


@pytest.mark.parametrize(
    "line, label, text",
    [
        ("1\tabc", 1.0, "abc"),
        ("1\ta\tb", 1.0, "a\tb"),
        ("0\t", 0.0, ""),
        ("1.5\tx", 1.5, "x"),
        (" 1 \tx", 1.0, "x"),
        ("0\t一次\t价值", 0.0, "一次\t价值"),
        ("1\tline\nbreak", 1.0, "line\nbreak"),
    ],
)
def test_first_tab_splits(spark, line, label, text):
    assert parse_labelled(lines(spark, line)).collect() == [(label, text)]


@pytest.mark.parametrize("line, problem", [("1 abc", NO_TAB), ("x\tabc", BAD_LABEL), ("1d\tabc", BAD_LABEL), ("\tabc", BAD_LABEL)])
def test_bad_line_fails_or_is_set_aside(spark, line, problem):
    with pytest.raises(Exception, match=problem):
        parse_labelled(lines(spark, line)).collect()
    with pytest.raises(Exception, match=problem):
        parse_labelled(lines(spark, line)).select("text").collect()
    with pytest.raises(Exception, match=problem):
        parse_labelled(lines(spark, line, "1\tok")).count()
    parsed, rejected = parse_or_quarantine(lines(spark, line, "1\tok"))
    assert [tuple(r) for r in parsed.collect()] == [(1.0, "ok")]
    assert [(r["value"], r["problem"]) for r in rejected.collect()] == [(line, problem)]


@pytest.mark.parametrize("label", ["2", "-1", "NaN", "0.5", "Infinity"])
def test_other_labels_are_set_aside(spark, label):
    got = checked_lines(lines(spark, f"{label}\ta", "1.0\tb", "0\tc")).collect()
    assert [r["problem"] for r in got] == [OTHER_LABEL, None, None]


def test_first_messages_are_the_first_of_the_files_in_order(spark, tmp_path):
    for name in "cab":
        (tmp_path / f"{name}.txt").write_text("".join(f"{name}{i}\n" for i in range(50)))
    got = [r["text"] for r in read_messages(spark, str(tmp_path), first=70).collect()]
    assert got == [f"a{i}" for i in range(50)] + [f"b{i}" for i in range(20)]


def test_fail_fast_without_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(Exception, match=BAD_LABEL):
            parse_labelled(lines(spark, "x\tabc")).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_files_with_crlf(spark, tmp_path):
    path = tmp_path / "labelled.txt"
    path.write_bytes("0\tabc\r\n1\txxx号 　店\r\n".encode())
    rows = read_labelled(spark, str(path)).select("label", "text").collect()
    assert sorted(map(tuple, rows)) == [(0.0, "abc"), (1.0, "xxx号 　店")]
    messages = tmp_path / "messages.txt"
    messages.write_bytes(b"a\r\nb\r\nc\r\n")
    assert [r["text"] for r in read_messages(spark, str(messages)).collect()] == ["a", "b", "c"]
    assert [r["text"] for r in read_messages(spark, str(messages), first=2).collect()] == ["a", "b"]


def test_identical_lines_share_their_id(spark, tmp_path):
    path = tmp_path / "labelled.txt"
    path.write_text("0\ta\n0\ta\n1\ta\n")
    ids = [r["doc_id"] for r in read_labelled(spark, str(path)).collect()]
    assert len(ids) == 3 and len(set(ids)) == 2
