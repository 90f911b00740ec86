"""JSON arrays by byte ranges: the same rows and order as the whole-file reader, however the ranges fall."""

import json
import random
import tempfile
from pathlib import Path

import pytest

from textmart.sources import files
from textmart.sources import json_arrays as J

SCHEMA = "id long, s string, a array<struct<x:string>>, m struct<k:string,n:int>"


def awkward(rng, n):
    parts = ["\\", '"', "{", "}", "[", "]", ",", ":", "é", "日", "😀", "\n", "a", '\\"', "\\\\", " "]
    some = lambda: "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
    return [{"id": i, "s": some() if i % 7 else None, "a": [{"x": some()} for _ in range(rng.randrange(3))], "m": {"k": some(), "n": i}} for i in range(n)]


def written(text, name="news.json", raw=False):
    p = Path(tempfile.mkdtemp(prefix="textmart-test-")) / name
    p.write_bytes(text if raw else text.encode())
    return str(p)


class Bytes:
    def __init__(self, data):
        self.data = data

    def read_at(self, n, at):
        return self.data[at:at + n]


def pieces_of(data, chunk):
    f = Bytes(data)
    found = [("f", len(data), s, min(s + chunk, len(data)), J.looked_through(f, s, min(s + chunk, len(data)), len(data))) for s in range(0, len(data), chunk)]
    return f, J.chained(found)


@pytest.mark.parametrize("style", [{}, {"ensure_ascii": False}, {"indent": 2, "ensure_ascii": False}])
def test_every_chunk_size_gives_the_objects(style):
    rng = random.Random(6)
    rows = awkward(rng, 30)
    data = json.dumps(rows, **style).encode()
    for chunk in [*range(1, 60), 97, 256, 1000, len(data), len(data) + 9]:
        f, pieces = pieces_of(data, chunk)
        got = [(p["first"] + k, json.loads(o)) for p in pieces for k, o in enumerate(J.objects(f, p, more=16))]
        assert got == list(enumerate(rows)), chunk
        assert sum(p["n"] for p in pieces) == len(rows)


def test_same_rows_as_the_whole_file_reader(spark):
    rows = awkward(random.Random(3), 400)
    path = written(json.dumps(rows, ensure_ascii=False))
    got = J.read_json_arrays(spark, path, SCHEMA, chunk_bytes=4096)
    assert got.rdd.getNumPartitions() > 5
    want = files.read_json_array(spark, path, SCHEMA)
    assert got.dtypes == want.dtypes
    plain = lambda df: [r.asDict(True) | {"file": None} for r in df.orderBy("doc_id").collect()]
    assert plain(got) == plain(want) and len(plain(got)) == 400


def test_roots_empty_and_broken_files(spark):
    one = written('﻿ {"id": 5, "s": "x"} ')
    assert [(r.ord, r.id, r.s) for r in J.read_json_arrays(spark, one, SCHEMA).collect()] == [(0, 5, "x")]
    for text in ("", "  ", "[]", " [ \n ] "):
        assert J.read_json_arrays(spark, written(text), SCHEMA).count() == 0
    for text in ('[{"id": 1}', '[{"id": 1}, 7]', '[1, 2]x"', '{"id": 1} {"id": 2}', '[{"s": "open}]'):
        with pytest.raises(ValueError, match="not a JSON array"):
            J.read_json_arrays(spark, written(text), SCHEMA)
    with pytest.raises(Exception):  # noqa: B017
        J.read_json_arrays(spark, written('[{"id": 1 "s": 2}]'), SCHEMA).collect()


def test_files_by_key_hot_key_in_several_and_back(spark):
    rows = [(i, None if i % 11 == 0 else f"t{i}", "hot key!" if i % 3 else f"k{i % 4}") for i in range(900)] + [(901, "x", None)]
    df = spark.createDataFrame(rows, "id long, s string, product string")
    path = tempfile.mkdtemp(prefix="textmart-test-")
    J.write_json_arrays(df, path, key="product", order=["id"], file_rows=100)
    names = json.loads((Path(path) / "_files.json").read_text())
    assert sum(n.startswith("hot_key-") for n in names) == 6 and sum(n.startswith("product-") for n in names) == 1
    for n in names:
        ids = [o["id"] for o in json.loads((Path(path) / n).read_text())]
        assert ids == sorted(ids) and ids
    back = J.read_json_arrays(spark, path, "id long, s string, product string", chunk_bytes=512)
    assert sorted(map(tuple, back.select("id", "s", "product").collect()), key=repr) == sorted(rows, key=repr)
    assert sorted(r.doc_id for r in back.collect()) == list(range(901))
    with pytest.raises(Exception, match="already holds"):
        J.write_json_arrays(df, path)
