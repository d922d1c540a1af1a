import json

import pytest

from strataframe.operators import metrics
from strataframe.sources import settings as S


def test_settings_of_the_project_come_first(tmp_path):
    pytest.importorskip("yaml")
    own, package = tmp_path / "project" / "config", tmp_path / "package"
    own.mkdir(parents=True)
    package.mkdir()
    (package / "a.yml").write_text("x: 1\ny: 2\n")
    assert S.read_settings("a.yml", tmp_path / "project", package) == {"x": 1, "y": 2}
    (own / "a.yml").write_text("x: 3\n")
    assert S.read_settings("a.yml", tmp_path / "project", package) == {"x": 3}  # as a whole
    with pytest.raises(FileNotFoundError):
        S.read_settings("b.yml", tmp_path / "project", package)


def test_specs_paths_and_requests(tmp_path):
    assert S.parse_benchmark(" n : in : ") == ("n", "in", None)
    for bad in ("a:b", "a:b:c:d"):
        with pytest.raises(ValueError):
            S.parse_benchmark(bad)
    with pytest.raises(ValueError):
        S.parse_benchmark(f"n:{tmp_path}:{tmp_path}/none", must_exist=True)
    assert S.below_common_root(["/a/b/c", "/a/b/d/e"]) == ["c", "d/e"] and S.below_common_root(["/a/b"]) == ["a/b"] and S.below_common_root([]) == []
    assert S.parent_key(["/a/y", "/a/x"]) == "multi:x | y"
    S.check_request("f.pdf", 1, "text")
    for bad in (("",), ("f", 0), ("f", 1, "music")):
        with pytest.raises(ValueError):
            S.check_request(*bad)


def test_failures_are_added_and_broken_files_replaced(tmp_path):
    at = tmp_path / "out" / "api_failure.json"
    S.append_failures([], tmp_path / "out")
    assert not at.exists()
    S.append_failures([{"n": 1}], tmp_path / "out")
    S.append_failures([{"n": 2}], tmp_path / "out")
    assert json.loads(at.read_text()) == [{"n": 1}, {"n": 2}]
    at.write_text("{")
    S.append_failures([{"n": 3}], tmp_path / "out")
    assert json.loads(at.read_text()) == [{"n": 3}]


def test_records(spark, tmp_path):
    d = spark.createDataFrame([("b", 1.0, 2), ("a", 3.0, 4)], "source string, f1 double, docs int")
    S.write_summary(metrics.benchmark_summary(d, "source", ["f1"], "docs"), str(tmp_path / "s"), "source")
    text = next((tmp_path / "s").glob("*.csv")).read_text().split()
    assert text == ["source,f1,docs", "a,3.0,4", "b,1.0,2", "mean,2.0,6"]
    (tmp_path / "old.json").write_text(json.dumps({"f.pdf": [{"tag": "Material description", "text": "Sand"}, {"tag": "Depth", "text": "1"}]}))
    (row,) = S.legacy_descriptions(spark, str(tmp_path / "old.json")).collect()
    assert row.file == "f.pdf" and [x.material_description for x in row.layers] == ["Sand"] and row.layers[0].depth_interval.start is None
    truth = spark.createDataFrame([("f", "x", "c"), ("g", "y", "c")], "file string, text string, classification string")
    some, every = S.classification_inputs(spark, truth, truth, subset=truth.filter("file = 'f'"))
    assert some.count() == 1 and every.count() == 2 and S.classification_inputs(spark, truth)[0].count() == 2
    with pytest.raises(ValueError):
        S.classification_inputs(spark, truth, None, subset=truth)
    with pytest.raises(ValueError):
        S.classification_inputs(spark, truth.drop("classification"))


def test_unknown_language_raises(spark):
    t = spark.createDataFrame([("x/A", "core#prefLabel", "a", "es")], "subject string, predicate string, object string, language string")
    with pytest.raises(Exception, match="unknown language: es"):
        S.concept_rows(t).collect()


def test_predictions_keep_their_layers(spark, tmp_path):
    from strataframe.sources import tables

    spot = {"page": 1, "rect": [0.0, 1.0, 2.0, 3.0]}
    layer = {"material_description": {"text": "Kies!", "lines": [{"text": "Kies!", **spot}]}, "depths": {"start": None, "end": {"value": 2.5, **spot}}}
    file = {"file_metadata": {"language": "de"}, "boreholes": [{"borehole_index": 1, "layers": [layer], "groundwater": []}, {"borehole_index": 0, "layers": [layer, {"material_description": {"text": "Ton"}}], "metadata": {"name": {"name": "B", "confidence": 1.0, **spot}}}]}
    (tmp_path / "p.json").write_text(json.dumps({"a.pdf": file}))
    p = tables.read_predictions(spark, str(tmp_path / "p.json"))
    rows = [(r.borehole_index, r.layer_index, r.start, r.end, r.text, r.end_page) for r in tables.prediction_layers(p).orderBy("borehole_index", "layer_index").collect()]
    assert rows == [(0, 0, None, 2.5, "kies", 1), (0, 1, None, None, "ton", None), (1, 0, None, 2.5, "kies", 1)]
    (back,) = tables.nest_predictions_json(p).collect()
    again = tmp_path / "again.json"
    again.write_text(json.dumps({back.file: json.loads(back.json)}))
    assert sorted(map(str, tables.prediction_layers(tables.read_predictions(spark, str(again))).collect())) == sorted(map(str, tables.prediction_layers(p).collect()))
    (tmp_path / "bad.json").write_text("{")
    assert tables.read_predictions(spark, str(tmp_path / "bad.json")).count() == 0


def test_block_intervals(spark):
    from strataframe.operators import sequence

    rows = [(1, 0, "FILL 0,5 - 1,0 m: gravel"), (1, 1, "grey"), (1, 2, "1,0 - 2,5 m: sand"), (1, 3, "0,1 - 0,2 m"), (2, 0, "2,0 -"), (2, 1, "3,0 m clay"), (2, 2, ""), (3, 0, "no depth"), (4, 0, None)]
    got = sequence.block_intervals(spark.createDataFrame(rows, "page bigint, pos int, text string"), "page", "pos").orderBy("page", "place").collect()
    assert [tuple(r) for r in got] == [(1, 0, 0.5, 1.0, "FILL 0,5 - 1,0 m: gravel grey"), (1, 1, 1.0, 2.5, "sand 0,1 - 0,2 m"), (2, 0, 2.0, 3.0, "2,0 - 3,0 m clay"), (3, 0, None, None, "no depth")]
