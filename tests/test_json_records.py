"""JSON arrays and maps read in splits, against the JSON parser, with every cut of a file."""

import json
import random

import pytest
from pyspark.sql import types as T

from paceline.sources.json_records import json_records, split_json_array, split_json_map

INNER = T.StructType([T.StructField("x", T.LongType()), T.StructField("t", T.StringType())])
RECORD = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("sub", INNER), T.StructField("list", T.ArrayType(INNER))])
ODD = ['a "quoted" one', "back\\slash \\", "{not [a] record}", "}, {", '"', "line\nbreak", "é漢𠀀", "", "\\\"}", "]"]


@pytest.fixture
def tiny_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "48")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def records(n, seed=1):
    rng = random.Random(seed)
    sub = lambda: {"x": rng.randrange(9), "t": rng.choice(ODD)}
    return [{"id": i, "name": rng.choice(ODD), "sub": sub(), "list": [sub() for _ in range(rng.choice([0, 1, 3, 20]))]} for i in range(n)]


def rows(df):
    return sorted((r.id, r.name, r.sub.x, r.sub.t, [(e.x, e.t) for e in r.list]) for r in df.collect())


def expected(found):
    return sorted((r["id"], r["name"], r["sub"]["x"], r["sub"]["t"], [(e["x"], e["t"]) for e in r["list"]]) for r in found)


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("ascii_only", [True, False])
def test_an_array_is_read_by_many_tasks(spark, tmp_path, tiny_splits, indent, ascii_only):
    data = records(60)
    (tmp_path / "a.json").write_text(json.dumps(data, indent=indent, ensure_ascii=ascii_only), encoding="utf-8")
    path = str(tmp_path / "a.json")
    assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() > 50
    assert rows(split_json_array(spark, path, RECORD)) == expected(data)
    assert rows(split_json_array(spark, path, RECORD)) == rows(spark.read.schema(RECORD).option("multiLine", True).json(path))


def test_a_file_cut_off_anywhere_gives_its_whole_records(spark, tmp_path, tiny_splits):
    data = records(5, seed=4)
    whole = json.dumps(data, ensure_ascii=False).encode()
    ends, decoder, text = [], json.JSONDecoder(), whole.decode()
    at = 1
    for _ in data:
        _, at = decoder.raw_decode(text, at)
        ends.append(len(text[:at].encode()))
        at += 2
    cuts = sorted({0, 1, 2, len(whole), len(whole) - 1, *ends, *(e - 1 for e in ends), *(e + 1 for e in ends), *random.Random(3).sample(range(len(whole)), 12)})
    for cut in cuts:
        (tmp_path / f"{cut}.json").write_bytes(whole[:cut])
    for cut in cuts:
        found = split_json_array(spark, str(tmp_path / f"{cut}.json"), RECORD)
        assert rows(found) == expected(data[: sum(e <= cut for e in ends)]), cut


def test_many_files_maps_and_lines(spark, tmp_path, tiny_splits):
    data = records(40, seed=2)
    (tmp_path / "arrays").mkdir()
    for k in range(4):
        (tmp_path / f"arrays/{k}.json").write_text(json.dumps(data[10 * k : 10 * k + 10]))
    (tmp_path / "arrays/empty.json").write_text("")
    (tmp_path / "arrays/none.json").write_text("[]")
    assert rows(split_json_array(spark, str(tmp_path / "arrays"), RECORD)) == expected(data)
    (tmp_path / "map.json").write_text(json.dumps({"n": 3} | {f'key "{i}"': r for i, r in enumerate(data)}, indent=1))
    found = split_json_map(spark, str(tmp_path / "map.json"), RECORD)
    assert rows(found) == expected(data) and {r.key: r.id for r in found.collect()} == {f'key "{i}"': i for i in range(40)}
    (tmp_path / "lines.json").write_text("\n".join(map(json.dumps, data)))
    assert json_records(spark, str(tmp_path / "lines.json"), level=0).count() == 40


def test_broken_records_and_scalars(spark, tmp_path):
    (tmp_path / "a.json").write_text('[1, "x", {"id": 1, "name": "a"}, null, {"id": "no number", "name": "b"}, {"id": 3, "name": }, {"id": 4}, [5]]')
    path = str(tmp_path / "a.json")
    assert [r.id for r in split_json_array(spark, path, RECORD).orderBy("id").collect()] == [1, 4]
    kept = split_json_array(spark, path, RECORD, keep_bad=True)
    assert kept.count() == 4 and kept.where("_corrupt_record is not null").count() == 2


def test_an_unbalanced_quote_collects_nothing_large(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 1}, {"id": 2, "name": "open}, ' + ", ".join(json.dumps({"id": i}) for i in range(3, 200)) + "]")
    out = json_records(spark, str(tmp_path / "a.json"), max_bytes=200)
    assert max(len(r.text) for r in out.collect()) <= 200
    assert [r.id for r in split_json_array(spark, str(tmp_path / "a.json"), RECORD).collect()][:1] == [1]


def test_the_text_of_records_is_not_shuffled(spark, tmp_path):
    rng = random.Random(5)
    (tmp_path / "a.json").write_text(json.dumps([{"id": i, "name": rng.randbytes(100).hex()} for i in range(5000)]))
    before = shuffled(spark)
    split_json_array(spark, str(tmp_path / "a.json"), RECORD).write.format("noop").mode("overwrite").save()
    assert shuffled(spark) - before < 0.05 * (tmp_path / "a.json").stat().st_size


def test_the_text_of_a_map_is_not_shuffled(spark, tmp_path):
    rng = random.Random(6)
    (tmp_path / "m.json").write_text(json.dumps({f"key {i}": {"id": i, "name": rng.randbytes(100).hex()} for i in range(5000)}))
    before = shuffled(spark)
    split_json_map(spark, str(tmp_path / "m.json"), RECORD).write.format("noop").mode("overwrite").save()
    assert shuffled(spark) - before < 0.05 * (tmp_path / "m.json").stat().st_size


def shuffled(spark):
    """Bytes that all stages so far wrote to shuffles."""
    store, gateway = spark.sparkContext._jsc.sc().statusStore(), spark.sparkContext._gateway
    stages = store.stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))
