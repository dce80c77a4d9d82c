import json
import random

import pytest
from pyspark.sql import types as T

from voicegrid import cli
from voicegrid.schemas import CORRUPT
from voicegrid.sources import files, json_arrays

SCHEMA = T.StructType([T.StructField("i", T.LongType()), T.StructField("text", T.StringType()), T.StructField("sub", T.StructType([T.StructField("t", T.StringType()), T.StructField("n", T.ArrayType(T.StructType([T.StructField("m", T.LongType())])))]))])
BITS = ["}", "{", '"', "\\", "\\\\", "]", "[", ",", "a", "é", "🐾", "\n", "}{", '"}', "x" * 40]


def documents(seed, n):
    r = random.Random(seed)
    text = lambda: "".join(r.choice(BITS) for _ in range(r.randrange(30)))
    return [{"i": i, "text": text(), "sub": {"t": text(), "n": [{"m": k} for k in range(r.randrange(3))]}} for i in range(n)]


@pytest.mark.parametrize("indent", [None, 1])
@pytest.mark.parametrize("ascii_only", [True, False])
def test_equals_multiline_over_many_ranges(spark, tmp_path, indent, ascii_only):
    for k, n in enumerate((300, 1, 0)):
        (tmp_path / f"{k}.json").write_text(json.dumps(documents(k, n), indent=indent, ensure_ascii=ascii_only), encoding="utf-8")
    (tmp_path / "one.json").write_text(json.dumps(documents(9, 1)[0]))
    (tmp_path / "long.json").write_text(json.dumps([{"i": -1, "text": "}" * 9000, "sub": None}, *documents(3, 5)]))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    want = sorted(map(str, files.read_document(spark, str(tmp_path), SCHEMA).collect()))
    try:
        for size in ("700", "5000", "1000000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "100")
            read = json_arrays.read_array(spark, str(tmp_path), SCHEMA)
            assert sorted(map(str, read.drop(CORRUPT).collect())) == want and read.filter(f"{CORRUPT} is not null").count() == 0
            assert json_arrays.pieces(spark, str(tmp_path)).rdd.getNumPartitions() > (10 if size == "700" else 0)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(want) == 308


def test_unify_keeps_what_does_not_parse(spark, tmp_path):
    (tmp_path / "in.json").write_text('[{"content": "a }"}, {"content": bad}, {"content": "b"}]', encoding="utf-8")
    cli.main(["unify", "--input_file", str(tmp_path / "in.json"), "--output_file", str(tmp_path / "out"), "--originals"], spark)
    assert sorted(r.content for r in files.read_originals(spark, str(tmp_path / "out")).collect()) == ["a }", "b"]
    assert [r.value for r in spark.read.text(str(tmp_path / "out_corrupt")).collect()] == ['{"content": bad}']


def test_arrays_round_trip(spark, tmp_path):
    df = spark.createDataFrame(documents(4, 100), SCHEMA).repartition(3)
    json_arrays.write_arrays(df, str(tmp_path / "x"))
    for part in (tmp_path / "x").glob("*.txt"):
        assert part.stat().st_size == 0 or isinstance(json.loads(part.read_text(encoding="utf-8")), list)
    assert sorted(map(str, json_arrays.read_array(spark, str(tmp_path / "x"), SCHEMA).drop(CORRUPT).collect())) == sorted(map(str, df.collect()))
