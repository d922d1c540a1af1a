from strataframe.operators import features as X

BOX = "page long, id long, x0 double, y0 double, x1 double, y1 double"


def test_symbols(spark):
    segs = spark.createDataFrame([(1, 1, 0.0, 12.0, 20.0, 12.0), (1, 2, 5.0, 14.0, 15.0, 14.0), (1, 3, 5.0, 30.0, 6.0, 30.0)], BOX)
    texts = spark.createDataFrame([(1, 9, 0.0, 0.0, 20.0, 10.0)], BOX)
    assert [tuple(r) for r in X.symbol_pairs(segs, texts, texts).collect()] == [(1, 9, 1, 2)]
    between = texts.union(spark.createDataFrame([(1, 8, 0.0, 11.0, 20.0, 13.0)], BOX))
    assert X.symbol_pairs(segs, between, texts).count() == 0


def test_sections_and_tables(spark):
    sec = spark.createDataFrame([(1, 1, 0.0, 0.0, 10.0, 10.0), (1, 2, 50.0, 0.0, 60.0, 10.0), (1, 3, 90.0, 0.0, 99.0, 10.0)], BOX)
    texts = spark.createDataFrame([(1, 7, 0.0, 0.0, 10.0, 10.0, "grey clay with sand"), (1, 8, 50.0, 0.0, 60.0, 10.0, "0o|1 8")], BOX + ", text string")
    assert {r.id: r.is_text for r in X.has_text(sec, texts).collect()} == {1: True, 2: False, 3: False}
    pages = spark.createDataFrame([(1, 10.5), (2, 100.0)], "page long, height double")
    assert [r.page for r in X.fallback_pages(pages, sec, sec.limit(0)).collect()] == [1]
    assert [r.id for r in X.unused(sec, texts).collect()] == [3]
    head = spark.createDataFrame([(1, 5, 0.0, -20.0, 8.0, -5.0)], BOX)
    assert [r.id for r in X.below_header(sec, head).collect()] == [1]
    assert {r.page: r.n_tables for r in X.page_features(pages, tables=sec).collect()} == {1: 3, 2: 0}


def test_pairs_and_keys(spark):
    s = spark.createDataFrame([(1, 1, 1, 5.0, 0.0, 0.0, 10.0, 10.0), (1, 2, 1, 4.0, 0.0, 0.0, 12.0, 10.0), (1, 2, 2, 3.0, 50.0, 0.0, 60.0, 10.0), (1, 3, 1, 1.0, 0.0, 0.0, 10.0, 10.0)], "page long, sidebar long, rect long, score double, x0 double, y0 double, x1 double, y1 double")
    assert sorted((r.sidebar, r.rect) for r in X.pair_columns(s).collect()) == [(1, 1), (2, 2), (3, 1)]
    keys = spark.createDataFrame([(1, 1, 0.0, 0.0, 10.0, 10.0)], BOX)
    lines = spark.createDataFrame([(1, 2, 20.0, 1.0, 40.0, 9.0, "430.25 m u.M."), (1, 3, 12.0, 1.0, 18.0, 9.0, "2.50 m u.T. 12.05.1998"), (1, 4, 900.0, 1.0, 910.0, 9.0, "999.1")], BOX + ", text string")
    assert [r.elevation for r in X.elevation_near_key(keys, lines).collect()] == [430.25]
    got = X.groundwater_near_key(keys, lines).first()
    assert (got["depth"], got["elevation"], str(got["date"])) == (2.5, 430.25, "1998-05-12")
