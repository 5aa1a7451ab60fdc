"""Names and paths against a restatement with pathlib."""

import random
from pathlib import PurePosixPath

import pytest
from pyspark.sql import functions as F

from genflow.functions.naming import expected_output, normalize_output_path, output_filename, posix_path, with_index
from genflow.functions.text import WHITESPACE, strict_json, strip


def restated(name, sub=None):
    if name is None or not name.strip():
        return None
    path = PurePosixPath(name.strip())
    tail = "" if sub is None else f"_{sub:02d}"
    if path.suffix.lower() in (".png", ".jpg", ".jpeg") and path.stem.strip("."):
        return str(path)[: -len(path.suffix)] + tail + path.suffix.lower()
    return str(path) + tail + ".png"


GOLDEN = {
    "aaa/bb/1": "aaa/bb/1.png", "aaa/bb/1.png": "aaa/bb/1.png", "aaa/bb/1.jpg": "aaa/bb/1.jpg",
    "aaa/bb/1.jpeg": "aaa/bb/1.jpeg", "a/b/c.webp": "a/b/c.webp.png", "landscapes/sunset": "landscapes/sunset.png",
    "a//b/./c.PNG/": "a/b/c.png", "../x": "../x.png", "//a/b": "//a/b.png", "///a": "/a.png", ".png": ".png.png",
    "　 x.JPG\t": "x.jpg", "   ": None, "": None,
}


def test_golden(spark):
    rows = spark.createDataFrame(list(GOLDEN.items()), "name string, want string")
    got = rows.select("name", "want", normalize_output_path("name").alias("got")).collect()
    assert [(r["name"], r["got"]) for r in got] == [(r["name"], r["want"]) for r in got]


def test_against_pathlib(spark):
    rng = random.Random(7)
    pieces = ["a", "b.c", ".", "..", "", "x.PNG", "y.jpeg", "z.webp", ".png", "q.", "...jpg", " ", "w.Jpg ", "é.png"]
    names = {"/".join(rng.choice(pieces) for _ in range(rng.randint(1, 5))) for _ in range(1500)}
    cases = [(n, s) for n in names for s in (None, 3)]
    rows = spark.createDataFrame([(n, s, restated(n, s)) for n, s in cases], "name string, sub int, want string")
    bad = rows.withColumn("got", normalize_output_path("name", F.col("sub"))).where("not (got <=> want)").collect()
    assert bad == []


def test_numbers_are_never_cut(spark):
    row = spark.range(1).select(
        output_filename(F.lit(7)).alias("a"), output_filename(F.lit(1234567)).alias("b"),
        output_filename(F.lit(7), 123).alias("c"), output_filename(F.lit(-5)).alias("d")).first()
    assert tuple(row) == ("000007.png", "1234567.png", "000007_123.png", "-00005.png")


@pytest.mark.parametrize("n,want", [(1, ["000001.png", "d/x.png"]), (4, ["000001_00.png", "d/x_00.png"])])
def test_resume_probe_is_the_first_image(spark, n, want):
    rows = spark.createDataFrame([(1, " "), (2, "d//x")], "index long, name string")
    assert [r[0] for r in rows.orderBy("index").select(expected_output("index", "name", n)).collect()] == want


def test_strip_is_python_strip(spark):
    texts = [c + "x" + c for c in WHITESPACE] + ["​x​", WHITESPACE, "a b"]
    rows = spark.createDataFrame([(t, t.strip()) for t in texts], "t string, want string")
    assert rows.where(strip("t") != F.col("want")).count() == 0


def test_strict_json(spark):
    texts = ['[1] x', '[1],[2]', '[1]],[[2]', '{"a": 1}', ' 1 ', '[1, 2', '["a"]', '', '[1],7],[', '{"a": 1} {"b": 2}']
    good = {'{"a": 1}', ' 1 ', '["a"]'}
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r[0] for r in rows.where(strict_json("t").isNotNull()).collect()} == good


def test_posix_path_empty(spark):
    row = spark.range(1).select(*[posix_path(F.lit(t)) for t in (".", "/", "//", "a/..")]).first()
    assert tuple(row) == (".", "/", "//", "a/..")


def test_index_rules(spark):
    rows = spark.createDataFrame([("1", 0), (" 2 ", 1), ("x", 2), (None, 3)], "index string, _pos long")
    assert sorted(r["index"] for r in with_index(rows).collect()) == [1, 2]
    assert sorted(r["index"] for r in with_index(rows, fallback="_pos").collect()) == [1, 2, 2, 3]
