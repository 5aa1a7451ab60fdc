"""Readers on small files."""

import json
import random
import re
import shutil
import struct
import zlib

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from genflow.functions.images import image_header
from genflow.operators import images
from genflow.operators.images import fetch_images, load_image_bytes
from genflow.sinks.blobs import write_named_blobs
from genflow.sinks.results import merge_results, read_progress, save_progress, write_results
from genflow.sources.endpoints import endpoints_from_config, single_endpoint
from genflow.sources.logs import read_worker_logs
from genflow.sources.outputs import list_outputs
from genflow.sources.requests import read_edit_requests, read_generate_requests
from genflow.sources import outputs, pieces
from genflow.sources.tasks import (
    load_prompts, read_parquet_dir_reindexed, read_prompts, read_prompts_json, read_prompts_jsonl, read_tasks,
    read_tasks_csv, read_tasks_parquet,
)


def parquet(path, **columns):
    pq.write_table(pa.table(columns), path)


def test_parquet_folder_in_name_then_row_order(spark, tmp_path):
    parquet(tmp_path / "b.parquet", index=[5, 6], instruction=["e", "f"])
    parquet(tmp_path / "a.parquet", index=[9, 1, 9], instruction=["a", "b", "c"])
    (tmp_path / "sub").mkdir()
    parquet(tmp_path / "sub" / "c.parquet", index=[7], instruction=["x"])
    rows = read_tasks(spark, str(tmp_path)).orderBy("_pos").collect()
    assert [(r["_pos"], r["index"], r["instruction"]) for r in rows] == [
        (0, 9, "a"), (1, 1, "b"), (2, 9, "c"), (3, 5, "e"), (4, 6, "f")]
    again = read_parquet_dir_reindexed(spark, str(tmp_path)).orderBy("index").collect()
    assert [(r["index"], r["instruction"]) for r in again] == list(enumerate("abcef"))


def test_parquet_index_only_and_missing_index(spark, tmp_path):
    parquet(tmp_path / "t.parquet", index=["3", "x", "4"], name=["n", "m", " "], blob=[b"1", b"2", b"3"])
    df = read_tasks_parquet(spark, str(tmp_path / "t.parquet"), True, "name")
    assert set(df.columns) == {"index", "name", "_file", "_row", "_pos"}
    assert sorted((r["index"], r["_pos"]) for r in df.collect()) == [(3, 0), (4, 2)]
    assert "blob" not in df._jdf.queryExecution().executedPlan().toString()
    parquet(tmp_path / "u.parquet", instruction=["a", "b"])
    with pytest.warns(UserWarning, match="no column"):
        plain = read_tasks_parquet(spark, str(tmp_path / "u.parquet"))
    assert sorted((r["index"], r["instruction"]) for r in plain.collect()) == [(0, "a"), (1, "b")]


def test_csv(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('input_images,instruction,output_path\ncat.jpg,"Add a ""hat"",\nnow",a/b\ndog.jpg,,\n', encoding="utf-8")
    rows = read_tasks(spark, str(path)).orderBy("_pos").collect()
    assert [(r["index"], r["instruction"], r["output_path"]) for r in rows] == [(0, 'Add a "hat",\nnow', "a/b"), (1, "", "")]
    path.write_text("index,prompt\n7,a\n9,b\n", encoding="utf-8")
    assert [(r["index"], r["prompt"]) for r in read_prompts(spark, str(path)).orderBy("_pos").collect()] == [(7, "a"), (9, "b")]
    one_line = read_tasks_csv(spark, str(path), multiline=False).orderBy("_pos").collect()
    assert [r["_pos"] for r in one_line] == [0, 1]


def test_jsonl_counts_blank_lines(spark, tmp_path):
    path = tmp_path / "p.JSONL"
    path.write_text('{"prompt": "a", "height": 512}\n\n"b"\n  {"prompt": "c", "index": 40}\n   \n"d"\n', encoding="utf-8")
    rows = read_prompts(spark, str(path)).orderBy("_pos").collect()
    assert [(r["index"], r["prompt"], r["height"]) for r in rows] == [(0, "a", 512), (2, "b", None), (40, "c", None), (5, "d", None)]


def test_jsonl_line_numbers_over_splits(spark, tmp_path):
    path = tmp_path / "big.jsonl"
    path.write_text("".join(f'"prompt number {i}"\n' if i % 3 else "\n" for i in range(5000)), encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        df = read_prompts_jsonl(spark, str(path))
        assert df.rdd.getNumPartitions() >= 1
        rows = df.select("index", "prompt").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(map(tuple, rows)) == [(i, f"prompt number {i}") for i in range(5000) if i % 3]


def test_json_array(spark, tmp_path):
    path = tmp_path / "p.json"
    path.write_text(json.dumps([{"prompt": "a"}, "b", {"prompt": "c", "index": 40}, "d"]))
    rows = read_prompts(spark, str(path)).orderBy("_pos").collect()
    assert [(r["index"], r["prompt"]) for r in rows] == [(0, "a"), (1, "b"), (40, "c"), (3, "d")]
    path.write_text('{"prompt": "a"}')
    with pytest.raises(Exception, match="must contain an array"):
        read_prompts_json(spark, str(path)).collect()


def test_txt_single_prompt_and_dispatch(spark, tmp_path):
    path = tmp_path / "p.txt"
    path.write_text("a\n\n b \n", encoding="utf-8")
    assert [(r["index"], r["prompt"]) for r in read_prompts(spark, str(path)).orderBy("index").collect()] == [(0, "a"), (2, "b")]
    assert [tuple(r) for r in load_prompts(spark, "wins", str(path)).collect()] == [(0, "wins")]
    for reader in (read_tasks, read_prompts):
        with pytest.raises(ValueError, match="unsupported file format"):
            reader(spark, "x.yaml")
    with pytest.raises(ValueError, match="unsupported file format"):
        read_tasks(spark, "x.jsonl")


def test_outputs_and_blobs(spark, tmp_path):
    blobs = spark.createDataFrame(
        [("a/b/1.png", b"one"), ("2 x.png", b"two"), ("../evil.png", b"no"), ("a/b/1.png", b"one")], "path string, data binary")
    manifest = write_named_blobs(blobs, str(tmp_path / "out")).collect()
    assert {(r["path"], r["length"]) for r in manifest if r["error"] is None} == {("a/b/1.png", 3), ("2 x.png", 3)}
    assert [r["path"] for r in manifest if r["error"]] == ["../evil.png"]
    assert (tmp_path / "out/a/b/1.png").read_bytes() == b"one"
    assert not list((tmp_path / "out").rglob("*.tmp"))
    listed = list_outputs(spark, str(tmp_path / "out"))
    assert {r["path"] for r in listed.collect()} == {"a/b/1.png", "2 x.png"}
    assert "content" not in listed._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


def test_local_images(spark, tmp_path):
    (tmp_path / "x.png").write_bytes(b"bytes")
    refs = spark.createDataFrame([(str(tmp_path / "x.png"),), (str(tmp_path / "gone.png"),), ("http://h/x",)], "ref string")
    rows = {r["key"]: (r["data"], r["error"]) for r in load_image_bytes(refs, str(tmp_path)).collect()}
    assert bytes(rows[str(tmp_path / "x.png")][0]) == b"bytes" and rows[str(tmp_path / "x.png")][1] is None
    assert rows[str(tmp_path / "gone.png")] == (None, "cannot read " + str(tmp_path / "gone.png"))
    assert len(rows) == 2


def test_fetch_once_and_cache(spark, tmp_path):
    log = tmp_path / "calls"
    log.mkdir()

    def fetcher(url, timeout):
        import uuid
        (log / uuid.uuid4().hex).write_text(url)
        if "bad" in url:
            raise OSError("no")
        return url.encode()

    refs = spark.createDataFrame([("http://h/a.png",), ("http://h/a.png",), ("http://h/bad",), ("local",)], "ref string")
    cache = str(tmp_path / "cache")
    first = fetch_images(refs, fetcher, cache)
    assert sorted((r["data"] is not None, r["error"]) for r in first.collect()) == [(False, "OSError: no"), (True, None)]
    assert sorted(f.read_text() for f in log.iterdir()) == ["http://h/a.png", "http://h/bad"]
    fetch_images(refs, fetcher, cache).collect()
    assert sorted(f.read_text() for f in log.iterdir()) == ["http://h/a.png", "http://h/bad", "http://h/bad"]


def test_worker_logs(spark, tmp_path):
    (tmp_path / "node1_process2.log").write_text(
        "2024-01-01 00:00:05 - [Rank 2] - w.Edit - INFO - [Process 2] Saved: a/b.png\n"
        "2024-01-01 00:00:06 - [Rank 2] - w.Edit - ERROR - [E1004] Failed to edit row 3\nTraceback (most recent call last):\n"
        "2024-01-01 00:00:07 - [Rank 2] - w.Edit - INFO - [Process 2] Completed: 10 successful, 2 failed\n")
    (tmp_path / "process_0.log").write_text("2024-01-01 00:00:05 - [Rank 0] - w - INFO - [Process 0] Processing batch 3/9...\n")
    (tmp_path / "other.txt").write_text("x\n")
    rows = read_worker_logs(spark, str(tmp_path)).collect()
    found = {(r["node"], r["file_process"], r["kind"], r["path"], r["batch"], r["batches"], r["successful"], r["failed"], r["code"]) for r in rows}
    assert found == {
        (1, 2, "saved", "a/b.png", None, None, None, None, None), (1, 2, "other", None, None, None, None, None, "E1004"),
        (1, 2, None, None, None, None, None, None, None), (1, 2, "completed", None, None, None, 10, 2, None),
        (0, 0, "batch", None, 3, 9, None, None, None)}
    assert [r["raw"] for r in rows if r["raw"]] == ["Traceback (most recent call last):"]


def test_request_files(spark, tmp_path):
    path = tmp_path / "r.jsonl"
    path.write_text('{"prompt": "p", "n": 3, "style": "vivid"}\n{"prompt": "q", "images": [{"image_url": "http://x"}]}\nnot json\n')
    rows = read_generate_requests(spark, str(path)).select("request.*").collect()
    assert [(r["prompt"], r["n"], r["output_format"], r["response_format"]) for r in rows] == [
        ("p", 3, "png", "b64_json"), ("q", 1, "png", "b64_json"), (None, None, None, None)]
    edits = read_edit_requests(spark, str(path)).select("request.images").collect()
    assert edits[1]["images"][0]["image_url"] == "http://x"


def test_endpoint_settings(spark):
    df = endpoints_from_config(spark, "http://a, ,http://c", "k1,, k2", "60,30", "1")
    assert [tuple(r) for r in df.orderBy("endpoint").collect()] == [
        (0, "http://a", 60, 1, 2), (1, None, 30, 1, 2), (2, "http://c", 0, 1, 2)]
    assert "k1" not in df._jdf.queryExecution().toString()
    assert [tuple(r) for r in endpoints_from_config(spark, keys="k").collect()] == [(0, None, 0, 1, 1)]
    assert endpoints_from_config(spark).count() == 0
    assert [tuple(r) for r in single_endpoint(spark, key="k", rate=5).collect()] == [(0, None, 5, 1, 1)]
    assert single_endpoint(spark).count() == 0


def test_results_csv(spark, tmp_path):
    done = spark.createDataFrame([(0, "x,\"y\"\nz", "a.png"), (1, None, "b.png")], "index long, instruction string, output_image string")
    assert write_results(done, str(tmp_path / "r"))
    back = read_tasks_csv(spark, str(tmp_path / "r") + "/*.csv").orderBy("index").collect()
    assert [(r["index"], r["instruction"], r["output_image"]) for r in back] == [(0, 'x,"y"\nz', "a.png"), (1, "", "b.png")]
    assert not write_results(done.where("index > 5"), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()
    more = spark.createDataFrame([(2, "w")], "index long, instruction_enhanced string")
    assert merge_results([done, more]).columns == ["index", "instruction", "output_image", "instruction_enhanced"]


def test_progress_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "p")
    rows = spark.createDataFrame([(0, "a"), (1, "b")], "index long, output_image string")
    save_progress(rows, path, "r1")
    save_progress(rows, path, "r1")
    save_progress(rows.limit(1), path, "r2")
    assert sorted((r["run_id"], r["index"]) for r in read_progress(spark, path).collect()) == [("r1", 0), ("r1", 1), ("r2", 0)]


def png(w, h):
    def chunk(tag, data):
        return struct.pack(">I", len(data)) + tag + data + struct.pack(">I", zlib.crc32(tag + data))

    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 0, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(b"\0" * (w + 1) * h)) + chunk(b"IEND", b""))


def test_image_headers(spark):
    webp = b"RIFF\0\0\0\0WEBPVP8X" + b"\0" * 8 + (9).to_bytes(3, "little") + (19).to_bytes(3, "little")
    lossless = b"RIFF\0\0\0\0WEBPVP8L" + b"\0" * 4 + b"\x2f" + ((99) | (49 << 14)).to_bytes(4, "little")
    lossy = b"RIFF\0\0\0\0WEBPVP8 " + b"\0" * 10 + struct.pack("<HH", 33, 44)
    jpeg = b"\xff\xd8\xff\xe0\x00\x04AA\xff\xc2\x00\x11\x08" + struct.pack(">HH", 20, 30) + b"\x03"
    blobs = [png(10, 20), png(1, 1), png(4096, 16), png(10, 20)[:20], b"", b"text", None, webp, lossless, lossy, jpeg]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(blobs)], "i int, b binary")
    rows = df.select("i", image_header("b").alias("h")).orderBy("i").select("h.*").collect()
    assert [tuple(r) for r in rows] == [
        ("PNG", 10, 20), ("PNG", 1, 1), ("PNG", 4096, 16), (None, None, None), (None, None, None), (None, None, None),
        (None, None, None), ("WEBP", 10, 20), ("WEBP", 100, 50), ("WEBP", 33, 44), ("JPEG", 30, 20)]


def _write(spark, path, sql):
    spark.sql(sql).coalesce(1).write.mode("overwrite").parquet(str(path) + ".tmp")
    import glob
    import shutil

    shutil.copy(glob.glob(str(path) + ".tmp/part-*.parquet")[0], path)


def test_a_column_of_later_files_is_kept(spark, tmp_path):
    folder = tmp_path / "tasks"
    folder.mkdir()
    _write(spark, folder / "a.parquet", "select 1L as index, 'x' as instruction")
    _write(spark, folder / "b.parquet", "select 2L as index, 'y' as instruction, 'out/b.png' as output_path")
    rows = {r["index"]: r["output_path"] for r in read_tasks_parquet(spark, str(folder)).collect()}
    assert rows == {1: None, 2: "out/b.png"}
    assert [r["output_path"] for r in read_parquet_dir_reindexed(spark, str(folder)).orderBy("index").collect()] == [None, "out/b.png"]


def test_a_text_index_is_cast_row_by_row(spark, tmp_path):
    folder = tmp_path / "tasks"
    folder.mkdir()
    _write(spark, folder / "a.parquet", "select 1L as index, 'x' as instruction")
    _write(spark, folder / "b.parquet", "select * from values ('7', 'y'), ('bad', 'z') as t(index, instruction)")
    assert sorted(r["index"] for r in read_tasks_parquet(spark, str(folder)).collect()) == [1, 7]
    _write(spark, folder / "c.parquet", "select 3L as index, 4 as instruction")
    with pytest.raises(ValueError, match="instruction"):
        read_tasks_parquet(spark, str(folder))


@pytest.mark.parametrize("name", ["_c.parquet", ".c.parquet"])
def test_hidden_files_are_refused_by_name(spark, tmp_path, name):
    folder = tmp_path / "tasks"
    folder.mkdir()
    _write(spark, folder / "a.parquet", "select 1L as index")
    (folder / name).write_bytes((folder / "a.parquet").read_bytes())
    with pytest.raises(ValueError, match=name):
        read_tasks_parquet(spark, str(folder))
    with pytest.raises(ValueError, match=name):
        read_tasks_parquet(spark, str(folder / name))


def test_fetch_cache_runs_and_buckets(spark, tmp_path):
    def refs(*names):
        return spark.createDataFrame([(f"http://h/{n}",) for n in names], "ref string")

    def got(df):
        return {bytes(r["data"]).decode() if r["data"] is not None else r["error"] for r in df.collect()}

    def never(url, timeout):
        raise AssertionError(url)

    cache = tmp_path / "cache"
    names = [f"{i}.png" for i in range(40)]
    fetch_images(refs(*names), lambda url, timeout: url.encode(), str(cache))
    (first,) = cache.iterdir()
    assert len(list(first.glob("bucket=*"))) > 20
    # Nothing is fetched or written again; only the bucket of the wanted key is opened.
    again = fetch_images(refs("7.png"), never, str(cache))
    assert got(again) == {"http://h/7.png"}
    assert re.search(r"PartitionFilters: \[[^]]*bucket#\d+ (=|IN)", again._jdf.queryExecution().executedPlan().toString())
    assert [list(run.rglob("*.parquet")) for run in cache.iterdir() if run != first] == [[]]
    # What two runs fetched at once is there twice and returned once.
    shutil.copytree(first, cache / "run=zz")
    twice = fetch_images(refs(*names, "new.png"), lambda url, timeout: b"fresh", str(cache))
    assert twice.count() == 41 and got(twice) == {f"http://h/{n}" for n in names} | {"fresh"}
    assert fetch_images(refs(), never, str(cache)).count() == 0


def test_large_images_are_handed_on_as_they_come():
    sent = []

    def rows():
        for i in range(5):
            sent.append(i)
            yield str(i), b"x" * (images.LOADED_BYTES // 2), None

    parts = images._by_bytes(rows())
    assert list(next(parts)["key"]) == ["0", "1"] and sent == [0, 1]
    assert [list(p["key"]) for p in parts] == [["2", "3"], ["4"]]


@pytest.mark.parametrize("index", ["", "x1"])
def test_a_bad_csv_index_is_an_error(spark, tmp_path, index):
    path = tmp_path / "tasks.csv"
    path.write_text(f"index,instruction\n1,a\n{index},b\n")
    with pytest.raises(Exception, match="record 1"):
        read_tasks_csv(spark, str(path)).select("index").collect()


def test_outputs_and_images_below_hidden_folders(spark, tmp_path):
    names = ["a.png", "_drafts/b.png", ".h/c.png", "x/_d.png", "x/e f.png", "x/.y/z/g.png"]
    for name in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(name.encode())
    assert sorted(r["path"] for r in list_outputs(spark, str(tmp_path)).collect()) == sorted(names)
    refs = spark.createDataFrame([(str(tmp_path / n),) for n in [*names, "none.png"]] + [("/etc/hostname",)], "ref string")
    got = {r["key"]: r for r in load_image_bytes(refs, str(tmp_path)).collect()}
    assert all(bytes(got[str(tmp_path / n)]["data"]) == n.encode() for n in names)
    assert got[str(tmp_path / "none.png")]["error"].startswith("cannot read") and got["/etc/hostname"]["data"] is None


def test_listing_walks_deep_and_flat_folders_in_batches(spark, tmp_path):
    names = [f"flat/{i}.png" for i in range(25)] + ["/".join("abcdefgh"[:d]) + f"/{d}.png" for d in range(1, 9)]
    for name in names:
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_bytes(b"")
    (tmp_path / "empty/inner").mkdir(parents=True)
    assert sorted(r["path"] for r in list_outputs(spark, str(tmp_path), batch_rows=10).collect()) == sorted(names)
    sizes = [b.num_rows for b in outputs._level(f"file://{tmp_path}", 10)(iter([pa.RecordBatch.from_arrays([pa.array(["flat", "gone"])], names=["path"])]))]
    assert sizes == [10, 10, 5, 0]
    assert list_outputs(spark, str(tmp_path / "empty")).count() == 0
    with pytest.raises(FileNotFoundError):
        list_outputs(spark, str(tmp_path / "nothing"))


def small_splits(spark):
    """Files cut every few bytes, as large ones are cut on a cluster."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "61b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")


@pytest.fixture
def tiny_splits(spark):
    small_splits(spark)
    yield
    for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.unset(name)


def test_quoted_line_breaks_across_splits(spark, tmp_path, tiny_splits):
    rng = random.Random(4)
    cells = ["plain", "two\nlines", 'said ""so""', "a,b", "", " spaced ", 'x\n\n"" \n', "é,\n€", "0"]
    for k, end in enumerate(("\n", "\r\n")):
        rows = [[rng.choice(cells) for _ in range(3)] for _ in range(120)]
        body = end.join(",".join([str(i), *(f'"{c}"' if set(c) & set('\n,"') or rng.random() < 0.3 else c for c in r)]) for i, r in enumerate(rows))
        path = tmp_path / f"t{k}.csv"
        path.write_bytes(("\ufeff" * k + "index,a,b,c" + end + end + body + end * 3).encode())
        got = read_tasks_csv(spark, str(path))
        assert got.columns[:4] == ["index", "a", "b", "c"]
        found = [tuple(r)[:4] for r in got.orderBy("_pos").collect()]
        assert found == [(i, *(c.replace('""', '"') for c in r)) for i, r in enumerate(rows)]
        assert [r["_row"] for r in got.orderBy("_pos").collect()] == list(range(120))
        lines = pieces.pieces(spark, str(path), "\n")
        assert lines.select("_split").distinct().count() > 20  # one file, many tasks


def test_csv_files_with_odd_ends(spark, tmp_path):
    for name, text, want in (("a", "index,v\n1,x", [(1, "x")]), ("b", "index,v\n", []), ("c", 'v\n"open\nend', [(0, "open\nend")]), ("d", "index,v\n1\n2,y,z\n", [(1, ""), (2, "y")])):
        path = tmp_path / f"{name}.csv"
        path.write_text(text)
        rows = read_tasks_csv(spark, str(path))
        assert sorted((r["index"], r["v"]) for r in rows.collect()) == want, name


def test_json_arrays_across_splits(spark, tmp_path, tiny_splits):
    rng = random.Random(5)
    values = ["a, b", 'quote " here', "back \\ slash", "\\", 'end \\"', "[not, an] {array}", "é€", "", "line\nbreak", "},{", '","']
    items = []
    for i in range(150):
        text = rng.choice(values)
        items.append(rng.choice([text + "x", {"prompt": text, "index": i + 1000}, {"prompt": text, "extra": [1, [2, {"k": "],["}], text]}, {"index": i, "prompt": "p", "o": {}}]))
    for indent in (None, 1):
        path = tmp_path / f"p{indent}.json"
        path.write_text(json.dumps(items, indent=indent, ensure_ascii=bool(indent)))
        rows = read_prompts_json(spark, str(path)).orderBy("_pos").collect()
        assert [r["prompt"] for r in rows] == [i if isinstance(i, str) else i["prompt"] for i in items]
        assert [r["index"] for r in rows] == [i["index"] if isinstance(i, dict) and "index" in i else k for k, i in enumerate(items)]
        assert pieces.pieces(spark, str(path), ",").select("_split").distinct().count() > 20


@pytest.mark.parametrize("text", ['{"prompt": "a"}', "", "[1, 2", "1, 2]", '["a",]', '["a" "b"]', '[{"prompt": }]', "nothing"])
def test_what_is_no_json_array_is_an_error(spark, tmp_path, text):
    path = tmp_path / "p.json"
    path.write_text(text)
    if not text:
        assert read_prompts_json(spark, str(path)).count() == 0
        return
    with pytest.raises(Exception, match="must contain an array"):
        read_prompts_json(spark, str(path)).collect()


@pytest.mark.parametrize("text", ["[]", " [ \n ] ", "[\t]"])
def test_empty_json_arrays(spark, tmp_path, text):
    path = tmp_path / "p.json"
    path.write_text(text)
    assert read_prompts_json(spark, str(path)).collect() == []
