from pyspark.sql import functions as F

from strataframe.functions import fuzzy
from strataframe.operators import layout as L


def test_stems():
    for word, want in {"aufeinander": "aufeinand", "kategorien": "kategori", "häuser": "haus", "sandigen": "sandig", "beispielhaft": "beispielhaft", "kiesige": "kiesig", "ton": "ton", "möglichkeiten": "moglich"}.items():
        assert fuzzy.stem_german(word) == want, word


def test_fuzzy_columns(spark):
    d = spark.createDataFrame([("eine Ko0rdinate hier", ["Tone", None], "sandsteine"), (None, None, None), ("nichts", [], "xyz")], "t string, w array<string>, c string")
    got = d.select(fuzzy.fuzzy_key("t", ["Koordinate"]).alias("k"), fuzzy.stems("w").alias("s"), fuzzy.compound_parts("c", ["sand", "steine"]).alias("p")).collect()
    assert [tuple(r) for r in got] == [("Ko0rdinate", ["ton"], ["sand", "steine"]), (None, None, None), (None, [], ["xyz"])]
    m = spark.range(1).select(fuzzy.match_across_lines(F.array(F.lit("x 2600"), F.lit("1200 y")), r"\d+ \d+").alias("m")).first()["m"]
    assert tuple(m) == ("2600 1200", 0, 1)


def test_columns():
    y = [0, 10, 20, 30, 40]
    assert L.is_column_valid(y, [0, 1, 2, 3, 4]) and not L.is_column_valid(y, [0, 1, 1, 3, 4]) and not L.is_column_valid(y[:2], [0, 1])
    assert L.reduce_to_valid(y, [0, 1, 99, 3, 4]) == ([0, 10, 30, 40], [0, 1, 3, 4]) and L.reduce_to_valid(y[:3], [3, 2, 1]) is None
    assert L.repair_decimals(y, [1.5, 25, 3.5, 4.5, 5.5], [True, False, True, True, True]) == [1.5, 2.5, 3.5, 4.5, 5.5]
    assert L.rising([1, 3, 2]) == 2


def test_interval_hierarchy():
    kinds = L.interval_hierarchy
    assert kinds([(0, 3), (0, 1), (1, 3), (3, 9), (4, 5), (9, None)]) == ["parent", "plain", "plain", "plain", "sub", "sub"]
    assert kinds([(0, 5), (0, 5)]) == ["parent", "plain"]  # one equal interval parts the first exactly
    assert kinds([(0, None), (1, 2), (7, 9)]) == ["plain", "sub", "sub"]  # an open end holds all that follow
    assert kinds([(0, 4), (1, None), (0, 2), (2, 4)]) == ["parent", "plain", "sub", "sub"]  # an open one takes no part in a partition, but holds what follows
    assert kinds([]) == [] and kinds([(2, None)]) == ["plain"]


def test_clusters():
    rows = lambda xs, w=10.0: [(x, 20.0 * i, x + w, 20.0 * i + 8) for i, x in enumerate(xs)]
    assert L.alignment_clusters(rows([0, 0, 0, 0])) == [[0, 1, 2, 3]]
    assert L.alignment_clusters(rows([0, 90, 0, 90, 0])) == [[0, 2, 4]]  # a pair alone makes no column
    assert [1, 3] in L.alignment_clusters(rows([0, 90, 0, 90, 0]), pairs=True)
    assert L.alignment_clusters(rows([0, 0])) == [] and L.alignment_clusters([]) == []
    assert L.is_misaligned(rows([0, 0, 30, 30, 0, 0])) and not L.is_misaligned(rows([0, 1, 0, 1, 0, 1]))


def test_segments_and_pairs():
    assert L.merge_segments([(0, 0, 10, 0), (12, 0, 20, 0), (0, 50, 10, 50)]) == [(0, 0, 20, 0), (0, 50, 10, 50)]
    assert L.pair_depths([(1, 0, 0), (2, 10, 0), (5, 0, 40)], 20, 2) == [(1, 2)]
    assert L.entry_shifts([(0, 10), (20, 30)], [(6, 26), (24, 20)]) == [20, 5]  # the second may not come before half of the first
    assert L.entry_shifts([(0, 10)], [(40, 90)]) == [0] and L.entry_shifts([], []) == []
    assert L.description_columns([(0, 10), (1, 9), (50, 60)], [False, False, True]) == [[0, 1]]


def test_page_rules(spark):
    from strataframe.operators import page

    lines = spark.createDataFrame([(1, 1, 0.0, 0.0, 50.0, 10.0), (1, 2, 5.0, 12.0, 50.0, 22.0), (1, 3, 5.0, 24.0, 50.0, 34.0), (1, 4, 0.0, 36.0, 50.0, 46.0), (2, 1, 3.0, 0.0, 9.0, 10.0)], "page bigint, id bigint, x0 double, y0 double, x1 double, y1 double")
    assert [r.indentation for r in page.indentation(lines).orderBy("page", "id").collect()] == [0, 1, 3, -1, 0]
    none = lines.limit(0)
    first = page.line_affinity(lines, none, none).filter("page = 2").first()
    assert all(first[c] == 0 for c in page.AFFINITIES)
    for out in (page.line_starts(none), page.indentation(none), page.line_affinity(none, none, none), page.compact_overlaps(none)):
        assert out.count() == 0
    e = spark.createDataFrame([(1, 1, 0, 5.0, 0.0, 0.0), (1, 2, 0, 1.0, 100.0, 0.0)], "file bigint, id bigint, page int, y0 double, px double, py double")
    b = spark.createDataFrame([(1, k, 0, 100.0 * k, 0.0, 100.0 * k + 10, 9.0) for k in range(3)], "file bigint, box bigint, page int, x0 double, y0 double, x1 double, y1 double")
    assert sorted((r.box, r.id) for r in page.one_to_one(e, b).collect()) == [(0, 1), (1, 2), (2, 1)]  # the first element serves twice
    try:
        page.zones(lines, "other")
        raise AssertionError
    except ValueError:
        pass


def test_zone_alignment_against_all_assignments():
    """J4 by trying every way to give lines to zones in order."""
    import itertools
    import random

    from strataframe.operators import matching

    rng = random.Random(3)
    for _ in range(60):
        n, m = rng.randrange(1, 4), rng.randrange(1, 5)
        score = [[rng.random() for _ in range(m)] for _ in range(n)]
        bonus = [0.0] + [rng.uniform(-1, 1) for _ in range(m - 1)]  # the first line has none before it
        best = max(
            # a line may open a zone, or join it where it was passed over as empty, for the penalty and its bonus
            sum(score[z][j] + (bonus[j] if j and ways[j - 1] == z else max(0, bonus[j] - 0.2)) for j, z in enumerate(ways)) - 0.2 * (n - len(set(ways)))
            for ways in itertools.product(range(n), repeat=m)
            if list(ways) == sorted(ways)
        )
        got, found = matching.align_zones(score, bonus)
        assert abs(got * max(n, m) - best) < 1e-9 and sorted(j for _, mine in found for j in mine) == list(range(m))


def test_lines_are_folded_with_their_page(spark):
    from strataframe.operators import page

    box = "page bigint, id bigint, x0 double, y0 double, x1 double, y1 double"
    lines = spark.createDataFrame([(1, i, 0.0 if i != 3 else 5.0, 12.0 * i, 50.0, 12.0 * i + 10) for i in range(1, 6)] + [(1, 6, None, 72.0, 50.0, 82.0)], box)
    starts = page.line_starts(lines)
    assert {r.id: r.starts for r in starts.collect()} == {1: True, 2: True, 3: False, 4: True, 5: True, 6: False}
    rules = spark.createDataFrame([(1, 1, 0.0, 23.0, 50.0, 23.0), (1, 2, 0.0, 0.0, 9.0, 9.0), (2, 1, 0.0, 0.0, 9.0, 0.0)], box)
    found = page.line_affinity(lines, rules, rules.filter("id = 2"))
    got = {r.id: (r.long_lines, r.left_lines, r.diagonal, r.gap, r.indentation) for r in found.collect()}
    assert got == {1: (0, 0, 0, 0, 0), 2: (-1, -1, 0, 1, 0), 3: (0, 0, 0, 1, 1), 4: (0, 0, 0, 1, -1), 5: (0, 0, 0, 1, 0), 6: (0, 0, 0, 0, 0)}
    for d in (starts, found):
        plan = d._jdf.queryExecution().executedPlan().toString()
        assert "MapInArrow" in plan and "Join" not in plan  # neither arrays in expressions nor a table for each rule
