import random

from conftest import rows

import slicewise as sw
from slicewise.sources.files import _lines


def write(folder, **contents):
    for name, text in contents.items():
        (folder / f"{name}.csv").write_bytes(text.encode())
    return str(folder)


def test_file_profile(spark, tmp_path):
    path = write(
        tmp_path,
        closed="h1,h2\n1,2\n3,4\n",
        open="h1,h2\n1,2\n3,4",
        header_only="h1,h2\n",
        empty="",
        windows="h1,h2\r\n1,2\r\n",
        blank_lines="h1\n\n\n",
        accents="é,ü\nß\n",
    )
    found = rows(sw.file_profile(spark, path, "7", list_empty=True), "file_name", "n_lines", "n_newlines", "header", "size")
    assert rows(sw.file_profile(spark, path, "7"), "file_name", "n_lines", "n_newlines", "header", "size") == [r for r in found if r[4]]
    assert found == [
        ("accents.csv", 2, 2, "é,ü", 9),
        ("blank_lines.csv", 3, 3, "h1", 5),
        ("closed.csv", 3, 3, "h1,h2", 14),
        ("empty.csv", 0, 0, "", 0),
        ("header_only.csv", 1, 1, "h1,h2", 6),
        ("open.csv", 3, 2, "h1,h2", 13),
        ("windows.csv", 2, 2, "h1,h2\r", 12),
    ]


def test_profile_text(spark, tmp_path):
    row = sw.file_profile(spark, write(tmp_path, f="a|b\n1|2\n"), "7").first()
    parts = row["profile_text"].split("|||")
    assert [parts[0], parts[2], parts[4], parts[5]] == ["7", "2", "a|b", "8"]
    assert parts[3].endswith("/f.csv") and len(parts[1]) == 26


def test_a_file_read_in_many_splits(spark, tmp_path):
    """The header is the first line of the file, whichever task reads which part."""
    rng = random.Random(5)
    lines = ["h1,h2,h3"] + [",".join("x" * rng.randrange(1, 40) for _ in range(rng.choice([3, 3, 3, 4]))) for _ in range(5000)]
    path = write(tmp_path, big="\n".join(lines) + "\n", small="only\nx\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        assert _lines(spark, path).rdd.getNumPartitions() > 8
        found = rows(sw.file_profile(spark, path, "1"), "file_name", "n_newlines", "header")
        assert found == [("big.csv", 5001, "h1,h2,h3"), ("small.csv", 2, "only")]
        checked = rows(sw.line_consistency(spark, path, ","), "n_header_fields", "n_lines", "n_bad_lines", "status")
        bad = sum(line.count(",") != 2 for line in lines)
        assert checked == [(1, 2, 0, "Pass"), (3, 5001, bad, "Fail")]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_delimiter_is_taken_literally(spark, tmp_path):
    path = write(tmp_path, bars="a|||b\n1|||2\n1||2\n")
    assert rows(sw.line_consistency(spark, path, "|||"), "n_header_fields", "n_bad_lines") == [(2, 1)]


def test_merge_frames_and_files(spark, tmp_path):
    one, two = spark.sql("SELECT 1 AS a, 'x' AS b"), spark.sql("SELECT 2 AS a, 2.5D AS c")
    assert rows(sw.merge_frames([one, two])) == [(1, "x", None), (2, None, 2.5)]
    for fmt in ("parquet", "orc", "json", "csv"):
        paths = [str(tmp_path / f"{fmt}{i}") for i in range(2)]
        for df, path in zip((one, two), paths):
            df.write.format(fmt).option("header", "true").save(path)
        merged = sw.merge_files(spark, paths, fmt)
        assert rows(merged.selectExpr("int(a) a", "string(b) b", "double(c) c")) == [(1, "x", None), (2, None, 2.5)]
