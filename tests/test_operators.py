import os
import random

import pytest
from pyspark.sql import functions as F

from strataframe.functions import geometry as G
from strataframe.functions.text import ratio
from strataframe.operators import classify, matching, metrics, sequence
from strataframe.plans import catalog
from strataframe.sources import tables
from strataframe.streaming import incremental

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("line", [
    "1 1.05 2 3 4 5.78 6 > 1 2 3 4", "10 20 30 40 50 > 10 20 30 40 50", "5 10 15 20 25 30.5 40.7 > 5 10 15 20 25", "3 7 12 20 >", "10 >", ">", "1.1 2.2 3.3 4.4 > 1.1 2.2 3.3 4.4",
    "8 16 20 24 28 52 56 60 72 88 92 100 >", "1 2 3 4 5 6 7 8 9 10 20 > 1 2 3 4 5 6 7 8 9 10", "0.8 2.4 4.0 >", "0.2 0.3 0.4 > 0.2 0.3 0.4", "2 4 6 8 12 > 2 4 6 8",
    "0 0.8 1 1.7 2 2.7 3 3.1 3.5 3.9 4 5 6 7 7.4 8 8.5 8.8 9 10 > 0 1 2 3 4 5 6 7 8 9 10",
])
def test_progression(line):
    values, want = ([float(x) for x in part.split()] for part in line.split(">"))
    assert sequence.progression(values) == want


def layer(text, start, end):
    return {"text": text, "start": start, "end": end}


TRUTH = [layer("A", 0.0, 1.0), layer("B", 1.0, 2.0), layer("C", 2.0, 3.0)]


@pytest.mark.parametrize(
    "pred,truth,kind,pairs,score",
    [([layer("C", 0.0, 1.0), layer("B", 1.0, 2.0), layer("A", 0.0, 1.0)], TRUTH, "layer", "0-0 1-1 2-2", 0.5), ([layer("C", 0.0, 1.5), layer("B", 1.5, 2.5), layer("A", 0.0, 1.0)], TRUTH, "layer", "2-0", 1 / 3),
     ([layer("B", 0.0, 1.0), layer("C", 1.0, 2.0), layer("D", 2.0, 3.0)], TRUTH, "layer", "0-0 1-1 2-2", 0.5), ([layer("B", 0.0, 1.0), layer("C", 1.0, 2.0), layer("D", 2.0, 3.0)], TRUTH, "depth", "0-0 1-1 2-2", 1.0),
     ([layer("B", 0.0, 1.0), layer("C", 1.0, 2.0), layer("D", 2.0, 3.0)], TRUTH, "text", "0-1 1-2", 2 / 3), ([layer("B", 0.0, 1.0), layer("C", 1.0, 2.0), layer("D", 2.0, 3.0)], [*TRUTH[:2], layer("C", 24.0, 35.0)], "layer", "0-0 1-1 2-2", 1 / 3)],
)
def test_layer_alignment(pred, truth, kind, pairs, score):
    got, found = matching.align([[matching.layer_score(p, t, kind) for t in truth] for p in pred])
    assert " ".join(f"{i}-{j}" for i, j in found) == pairs and got == pytest.approx(score)
    assert matching.align([]) == (0.0, [])


@pytest.mark.parametrize("second,want", [(0, {0: [0, 1], 1: [2]}), (-1, {0: [0], 1: [1, 2]})])
def test_zone_alignment(second, want):
    # two zones, y 10-20 and 30-40; lines at 11-14, 15-19 and 31-39
    import math

    mids, zones = [12.5, 17.0, 35.0], [(10, 20), (30, 40)]
    scores = [[(float(a <= y <= z) + math.exp(-abs((a + z) / 2 - y) / 30)) / 2 for y in mids] for a, z in zones]
    assert dict(matching.align_zones(scores, [0.0, float(second), 0.0])[1]) == want
    assert matching.align_zones([], [0.0]) == (0.0, [])


def brute_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    return row[-1]


def test_ratio_matches_the_table():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ("".join(rng.choice("abcä") for _ in range(rng.randrange(0, 40))) for _ in "xy")
        assert ratio(a, b) == pytest.approx(2 * brute_lcs(a, b) / (len(a) + len(b)) if a or b else 1.0)
    assert ratio(None, "a") is None


def test_references(spark):
    earlier = [(1, 0, "Sand, brown, medium-grained", 1.0), (1, 1, "Clay, grey, soft", 2.0), (1, 2, "Gravel, coarse", 3.0)]
    same = ["Silt, dark and stiff", "Dolomite, pale", "Dirt with 1.0-2.0m depth"]
    cases = [(t, t) for t in same] + [tuple(x.split(" => ")) for x in (
        "Same as 2.0m, but wetter => Clay, grey, soft, but wetter", "Do but rounder. => Gravel, coarse but rounder.", "wie 2.0 m.ü.M => Clay, grey, soft", "wie 2.0  => Clay, grey, soft ", "wie 2.0 mit etwas kies. => Clay, grey, soft mit etwas kies.",
    )]
    rows = [(k, *r[1:]) for k in range(len(cases)) for r in earlier] + [(k, 3, t, 9.0) for k, (t, _) in enumerate(cases)] + [(99, 0, "dito", 1.0), (99, 1, None, 2.0)]
    df = spark.createDataFrame(rows, "k long, pos long, text string, start double")
    got = {(r.k, r.pos): r.resolved for r in sequence.resolve_references(df, ["k"], ["pos"], "text", "start").collect()}
    assert [got[k, 3] for k in range(len(cases))] == [w for _, w in cases]
    assert got[99, 0] == "dito" and got[99, 1] == ""


def test_page_stitching(spark):
    rows = [
        (1, 1, 0, None, 1.0, "topsoil"), (1, 1, 1, 1.0, 2.0, "sand"), (1, 1, 2, 2.0, None, "clay"), (1, 2, 0, None, 4.0, "stiff"), (1, 2, 1, 4.0, 5.0, "rock"),
        (2, 1, 0, 0.0, 1.0, "first layer"), (2, 1, 1, 1.0, 2.0, "second layer"), (2, 2, 0, 1.0, 2.0, "second layer"), (2, 2, 1, 2.0, 3.0, "third layer"),
    ]
    df = spark.createDataFrame(rows, "f long, page long, pos long, start double, end double, text string")
    got = [(r.f, r.start, r.end, r.text) for r in matching.stitch_pages(df, "f").orderBy("f", "pos").collect()]
    assert got == [(1, 0.0, 1.0, "topsoil"), (1, 1.0, 2.0, "sand"), (1, 2.0, 4.0, "clay stiff"), (1, 4.0, 5.0, "rock"), (2, 0.0, 1.0, "first layer"), (2, 1.0, 2.0, "second layer"), (2, 2.0, 3.0, "third layer")]


def test_many_groups_share_a_batch(spark):
    rows = [(g, i, float(i) if i % 3 else None, "ä" if i % 2 else None) for g in [None, *range(40)] for i in range(1 + (g or 9) % 7 * 5)]
    random.Random(2).shuffle(rows)
    df = spark.createDataFrame(rows, "g long, i int, v double, t string")
    fold = lambda part: [{"g": part[0]["g"], "n": len(part), "shown": repr([(r["i"], r["v"], r["t"]) for r in part])}]
    want = {g: repr([(r[1], r[2], r[3]) for r in sorted((r for r in rows if r[0] == g), key=lambda r: r[1])]) for g in {r[0] for r in rows}}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)  # so that batches break groups off
    try:
        out = sequence.grouped(df, ["g"], ["i"], fold, "g long, n int, shown string")
        assert "FlatMapGroups" not in out._jdf.queryExecution().executedPlan().toString()  # a call a group takes longer than the fold
        got = out.collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == len(want) and {r.g: r.shown for r in got} == want
    assert sequence.grouped(df.limit(0), ["g"], ["i"], fold, "g long, n int, shown string").count() == 0


def test_range_join_against_all_pairs(spark):
    rng = random.Random(4)

    def rows(n, sides):
        for i in range(n):
            x, y = rng.uniform(-200, 900), rng.uniform(-200, 900)
            w = rng.choice([5, 40, 300, -20])  # some boxes are turned round
            yield (1 if i % 3 else 2 if i % 2 else None, i, x, y, x + w, None if i % 50 == 0 else y + rng.choice([0, 30, 120]), sides)

    shape = "page long, id long, x0 double, y0 double, x1 double, y1 double, side string"
    a, b = list(rows(260, "a")), list(rows(240, "b"))
    left, right = spark.createDataFrame(a, shape), spark.createDataFrame(b, shape)
    meets = lambda p, q: p[0] is not None and p[0] == q[0] and None not in (p[5], q[5]) and p[2] < q[4] and q[2] < p[4] and p[3] < q[5] and q[3] < p[5]
    want = sorted((p[1], q[1]) for p in a for q in b if meets(p, q))
    j = matching.range_join(left, right, ["page"])
    assert j.columns == left.columns + [f"r_{c}" for c in right.columns] and "Generate" not in j._jdf.queryExecution().executedPlan().toString()  # no row a cell is shuffled
    got = j.collect()
    assert sorted((r.id, r.r_id) for r in got) == want and len(want) > 200 and all(r.side == "a" and r.r_side == "b" for r in got)
    other = matching.range_join(left, right.selectExpr("cast(page as int) as page", "cast(id as string) as id", "x0", "cast(y0 as float) as y0", "x1", "y1"), ["page"]).collect()  # columns of other types
    assert abs(len(other) - len(want)) < 3 and all(isinstance(r.r_id, str) for r in other)
    assert matching.range_join(left.limit(0), right, ["page"]).count() == 0


def test_near_lines_once(spark):
    box = "page long, id long, x0 double, y0 double, x1 double, y1 double"
    keys = spark.createDataFrame([(1, 1, 0.0, 0.0, 10.0, 10.0)] * 2, box)
    lines = spark.createDataFrame([(1, 2, 5.0, 5.0, 8.0, 12.0), (1, 2, 5.0, 5.0, 8.0, 12.0), (1, 3, 25.0, 2.0, 30.0, 8.0), (1, 4, 2.0, 15.0, 8.0, 18.0), (1, 5, 25.0, 15.0, 30.0, 18.0)], box)
    n = matching.near_lines(keys, lines, ["page"], 1, 2, 1, 0)
    assert sorted((r.id, r.x1, r.r_id) for r in n.collect()) == [(1, 10.0, 2), (1, 10.0, 3), (1, 10.0, 4)]  # the last one lies in neither band


def test_page_components_of_large_ids(spark):
    from strataframe.operators import page

    nodes = spark.createDataFrame([(p, i) for p in (1, 2) for i in (1, 2, 5, 1 << 21, 1 << 40)], "page long, id long")
    edges = spark.createDataFrame([(1, 2, 1 << 40), (1, 5, 1 << 40), (2, 1, 1 << 21)], "page long, id long, r_id long")
    got = {(r.page, r.id): r.group for r in page._components(nodes, edges).collect()}
    assert got == {(p, i): i for p in (1, 2) for i in (1, 2, 5, 1 << 21, 1 << 40)} | {(1, 5): 2, (1, 1 << 40): 2, (2, 1 << 21): 1}


def test_greedy_pairs(spark):
    df = spark.createDataFrame([(1, 1, 1, 0.9), (1, 1, 2, 0.95), (1, 2, 2, 0.9), (1, 2, 1, 0.2), (1, 3, 3, 0.0)], "g long, a long, b long, s double")
    assert {(r.a, r.b) for r in matching.greedy_pairs(df, "g", "a", "b", "s", 0.1).collect()} == {(1, 2), (2, 1)}


@pytest.mark.parametrize(
    "rect,tolerance,want",
    [((100, 20, 200, 30), 0, True), ((50, 20, 150, 30), 0.5, True), ((49, 0, 149, 10), 0.5, False), ((151, 0, 251, 10), 0.5, False), ((100, 20, 250, 30), 0.5, True), ((100, 10, 251, 20), 0.5, False), ((100, 10, 149, 20), 0.5, False)],
)
def test_sections_align(spark, rect, tolerance, want):
    a, b = (G.Box(*[F.lit(float(x)) for x in r]) for r in ((100, 10, 200, 20), rect))
    assert spark.range(1).select(G.aligned(a, b, tolerance)).first()[0] is want


def test_segments(spark):
    a, b, c = (G.Box(*[F.lit(float(x)) for x in r]) for r in ((0, 0, 10, 10), (0, 10, 10, 0), (0, 1, 10, 11)))
    got = spark.range(1).select(
        G.segments_intersect(a, b), G.segments_intersect(a, c), G.are_parallel(a, c, 1), G.are_mergeable(a, a, 5, 5), G.distance_to_segment(a, F.lit(20.0), F.lit(10.0)), G.point_near_line(a, F.lit(12.0), F.lit(12.0), 3, 1)
    ).first()
    assert tuple(got) == (True, False, True, True, 10.0, True)


def test_matched_counts(spark):
    v = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (1, 3), (2, 1)], "f long, v long")
    t = spark.createDataFrame([(1, 2), (1, 3), (1, 4), (3, 9), (3, None)], "f long, v long")
    got = {r.f: (r.tp, r.fp, r.fn) for r in metrics.matched_counts(v, t, "v", "f").collect()}
    assert got == {1: (2, 2, 1), 2: (0, 1, 0), 3: (0, 0, 2)}


def test_coordinates_match_in_either_frame(spark):
    cases = [((600000.0, 150000.0), (2600002.0, 1150000.0), True), ((2600000.0, 1150000.0), (600000.0, 150001.0), True), ((1800000.0, 150000.0), (3800001.0, 1150000.0), True), ((600000.0, 150000.0), (600003.0, 150000.0), False),
             ((600000.0, 150000.0), (2600000.0, 150000.0), False), ((600000.0, 150000.0), (600000.0, 150000.0), True), ((None, 150000.0), (600000.0, 150000.0), False)]
    df = spark.createDataFrame([(k, *a, *b) for k, (a, b, _) in enumerate(cases)], "k int, e1 double, n1 double, e2 double, n2 double")
    got = df.orderBy("k").select(metrics.coordinates_match(F.col("e1"), F.col("n1"), F.col("e2"), F.col("n2"))).collect()
    assert [r[0] for r in got] == [w for _, _, w in cases]


def test_classifiers(spark):
    df = spark.createDataFrame([("silty sand with gravel",), ("clay",), (None,)], "text string")
    run = classify.make("baseline", patterns={"SM": [["silty", "sand"]], "S": [["sand"]], "CL": [["clay"]]}, default="kA")
    assert [r.prediction_class for r in run(df).collect()] == ["SM", "CL", "kA"]
    with pytest.raises(ValueError):
        classify.make("none")
    replies = spark.createDataFrame([("x <answer> cl-ml </answer>",), ("no",)], "reply string")
    assert [r.prediction_class for r in classify.make("answers", names=["CL_ML"], default="kA")(replies).collect()] == ["CL_ML", "kA"]


def test_records(spark, tmp_path):
    (tmp_path / "t.json").write_text('{"a.pdf": [{"metadata": {"name": "B1"}, "borehole_index": 0, "layers": [{"material_description": "Sand!", "depth_interval": {"end": 1.0, "start": null}}, {"material_description": null}], "groundwater": null}]}')
    r = tables.read_records(spark, str(tmp_path / "t.json"))
    assert [(x.start, x.end, x.text) for x in tables.layers(r).orderBy("layer_index").collect()] == [(None, 1.0, "sand"), (None, None, "")]
    assert tables.groundwater(r).count() == 0 and tables.read_predictions(spark, str(tmp_path / "none.json")).count() == 0
    assert tables.metadata_by_borehole(r).first()["key"] == "a.pdf_0"
    tables.write_layers_csv(r, str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 2
    assert "m__name" in tables.flatten(r.selectExpr("named_struct('name', file) as m")).columns
    assert tables.pending(r, r).count() == 0


def test_stream_takes_only_new_files(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("in", "out", "cp"))
    run = lambda: incremental.process_new(spark, src, "id long", lambda d: d.withColumn("twice", F.col("id") * 2), out, cp)
    spark.range(5).write.parquet(src)
    run()
    spark.range(5, 8).write.mode("append").parquet(src)
    run()
    assert sorted(r.twice for r in spark.read.parquet(out).collect()) == [2 * i for i in range(8)]


@pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")
def test_queries_match_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        p = f"{SF}/{t}.parquet"
        con.execute(f"create view {t} as select * from read_parquet('{p + '/*' if os.path.isdir(p) else p}')")
    for name in ("exact_class_metrics", "keyword_match", "nearest_prior", "nms_boxes", "components", "interval_contains"):
        got, want = catalog.QUERIES[name](spark, SF).toPandas(), con.execute(catalog.SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want), name
