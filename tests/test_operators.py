import random

from pyspark.sql import functions as F

from quernstone.operators import evaluation, export, extract, ontology, ranking, resolve, scoring
from quernstone.plans.components import connected_components
from quernstone.plans.joins import heavy_light_join
from quernstone.queries.resolve import PLACES


def test_components(spark):
    r = random.Random(3)
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, 100 + k) for k in range(1, 30)] + [(r.randrange(200, 300), r.randrange(200, 300)) for _ in range(80)] + [(500, 500), (None, 3)]
    got = {x.node: x.component for x in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {x: x for e in edges for x in e if x is not None}
    for _ in range(100):
        for a, b in edges:
            if a is not None:
                label[a] = label[b] = min(label[a], label[b])
    linked = {x for a, b in edges if a is not None and a != b for x in (a, b)}
    assert got == {x: label[x] for x in linked}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_heavy_light_join_is_a_join(spark):
    rows = spark.range(1000).select((F.col("id") % 37 * F.col("id") % 5).alias("k"), "id")
    keyed = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
    got = heavy_light_join(rows, keyed, ["k"], "n", 10_000_000).orderBy("id").collect()
    assert got == rows.join(keyed.drop("n"), "k").select("k", "id", "top").orderBy("id").collect()
    assert heavy_light_join(rows, keyed.filter("k = 0").select("k", "n"), ["k"], "n", 10, "left_semi").count() == rows.filter("k = 0").count()


def test_page_selection(spark):
    rows = [(1, k, float(k), 9 if k > 2 else 0, False) for k in range(20)] + [(2, k, float(k), 9, True) for k in range(20)]
    df = spark.createDataFrame(rows, "page int, id int, score double, penalty int, listing boolean")
    got = ranking.select_per_page(df, "page", [F.desc("score")], "listing", "penalty")
    assert {r.page: r.n for r in got.groupBy("page").agg(F.count(F.lit(1)).alias("n")).collect()} == {1: 3, 2: 12}


def test_votes(spark):
    votes = spark.createDataFrame([(1, "Museum", 3.0), (1, "Museum", 3.0), (1, "Place", 9.0), (2, "Museum", 3.1), (3, "Church", 4.0), (3, "Chapel", 3.5)], "id int, label string, w double")
    assert {r.id: r.elected for r in ranking.elect(votes, ["id"], "label", "w").collect()} == {1: "Museum", 2: "Unknown", 3: "Unknown"}


def test_closure_handles_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "a")], "child string, parent string")
    assert {(r["class"], r.ancestor) for r in ontology.closure(edges).collect()} == {(x, y) for x in "abcd" for y in "abc"} | {("d", "d")}


def test_resolution(spark):
    groups = {r.id: r.group_id for r in resolve.merge_entities(PLACES.frame(spark)).collect()}
    assert groups[2] == 1 and groups[4] == 3 and groups[8] == 8 and groups[9] == 7 and groups[10] == 10
    assert {r.id for r in resolve.weak_variants(PLACES.frame(spark)).collect()} >= {6}


def test_range_join_equals_brute_force(spark):
    r = random.Random(1)
    rows = [(k, r.uniform(-60, 70), r.uniform(-20, 20)) for k in range(150)] + [(200 + k, 40 + k / 500, -3.0) for k in range(40)]
    points = spark.createDataFrame(rows, "id long, lat double, lng double")
    from quernstone.functions.similarity import haversine_km

    all_pairs = points.alias("a").join(points.alias("b"), F.col("a.id") < F.col("b.id")).select(F.col("a.id").alias("a"), F.col("b.id").alias("b"), haversine_km(F.col("a.lat"), F.col("a.lng"), F.col("b.lat"), F.col("b.lng")).alias("km"))
    for km in (1.0, 300.0):
        assert {(x.a, x.b) for x in resolve.near_points(points, km).collect()} == {(x.a, x.b) for x in all_pairs.filter(F.col("km") <= km).collect()}


def test_candidates(spark):
    blocks = spark.createDataFrame([(1, 0, "Visita la Catedral de Burgos; también el Museo del Prado"), (1, 1, "Catedral de Burgos y Burgos Centro")], "page_id int, pos int, text string")
    got = [r.name for r in extract.candidates(blocks, ["page_id"]).orderBy("pos").collect()]
    assert "Museo del Prado" in got and len(got) == len({x.lower() for x in got})


def test_closed_world(spark):
    df = spark.createDataFrame([("Museum",), ("Place",), ("Xyz",), (None,)], "class string")
    known = spark.createDataFrame([("Museum",), ("Place",)], "class string")
    assert {(r["class"], r.rejection) for r in ontology.closed_world(df, known).collect()} == {("Museum", None), (None, "generic_class"), (None, "class_not_in_ontology"), (None, "missing_class")}


def test_evaluation(spark):
    truth = spark.createDataFrame([("u", "a"), ("u", "b"), ("v", "c"), ("v", "c")], "url string, name string")
    found = spark.createDataFrame([("u", "a"), ("u", "x")], "url string, name string")
    row = evaluation.micro(truth, found, ["url", "name"]).first()
    assert (row.tp, row.fp, row.fn, row.precision, row.recall, row.f1) == (1, 1, 2, 0.5, 0.333333, 0.4)
    nothing = evaluation.micro(truth.limit(0), found.limit(0), ["url", "name"]).first()
    assert nothing is not None


def test_exports(spark, tmp_path):
    e = spark.createDataFrame([("p", "1", None, 'A "b"', 1.5), ("p", "2", "1", "C\nd", None), ("q", "3", "9", "E", 2.0)], "page string, id string, parent string, name string, score double")
    nested = {r.page: r for r in export.hierarchy(e, "page", "id", "parent", ["id"]).collect()}
    assert nested["p"].entity_count == 2 and [c.id for c in nested["p"].roots[0].children] == ["2"] and nested["q"].roots[0].id == "3"
    lines = [r.value for r in export.turtle_lines(export.triples(e, F.col("id"), {}, {"score": "score"}, "name")).collect()]
    assert f'<{export.ENTITY_NS}1> <{export.RDFS_LABEL}> "A \\"b\\"" .' in lines and len(lines) == 3 * 2 + 2
    export.write_by(e, "page", f"{tmp_path}/by")
    export.write_delimited(e.select("page", "id"), f"{tmp_path}/csv")
    export.write_lines(export.turtle_lines(export.triples(e, F.col("id"), {}, {}, "name")), f"{tmp_path}/ttl")
    from quernstone.sources import files

    assert spark.read.json(f"{tmp_path}/by").count() == 3 and files.delimited(spark, f"{tmp_path}/csv").columns == ["page", "id"]
    back = files.ntriples(spark, f"{tmp_path}/ttl")
    assert {r.object for r in back.filter("predicate LIKE '%label'").collect()} == {'A "b"', "C\nd", "E"}
    assert "</script" in export.graph_page(["a"], [("a", "</script>")]) and "&lt;" in export.map_page([("<b>", 1.0, 2.0)], (1.0, 2.0))


def test_scores(spark):
    row = spark.range(1).select(scoring.leading_class(F.lit("El Museo del Prado")).alias("a"), scoring.leading_class(F.lit("Torre")).alias("b"), scoring.sane_types(F.array(F.lit("hotels"), F.lit("Thing"), F.lit("Hotel"))).alias("c"), scoring.class_quality(F.lit("Place")).alias("d")).first()
    assert (row.a, row.b, row.c, row.d) == ("Museum", "", ["Hotel"], "generic")


def test_names(spark):
    from quernstone.operators import names

    rows = spark.createDataFrame([("Ver mas", None), ("Catedral de Burgos", "Cathedral"), ("por supuesto Plaza Mayor tambien", None), ("", None)], "name string, cls string")
    got = [r.x for r in rows.select(names.name_score(F.col("name"), F.lit("texto"), F.col("cls")).alias("x")).collect()]
    assert [g.decision for g in got] == ["reject", "keep", "keep", "reject"]
    assert got[1].score == 1 + 3 + 2 + 1 + 2 and "instance_indicator" in got[1].reasons and got[3].reasons == ["empty_name"]


def test_consolidation(spark):
    from quernstone.operators import consolidate

    rows = spark.createDataFrame(
        [("La Plaza Mayor", "Place", 0.5, None, "corta", "", None, 1), ("Plaza Mayor", "Square", 0.9, "una descripción larga", "visita sevilla y más texto de portal que es muy largo pero vale menos", "1", "a@b", 2), (None, "X", 1.0, "x", "x", "x", "x", 3)],
        "name string, class string, score double, short_description string, long_description string, phone string, email string, pos int",
    )
    row = consolidate.consolidated(rows).collect()
    assert len(row) == 1 and (row[0].key, row[0]["class"], row[0].score, row[0].phone, row[0].email, row[0].n) == ("plaza mayor", "Square", 0.9, "1", "a@b", 2)
    assert row[0].short_description == "una descripción larga" and row[0].long_description == "corta"
    maps = spark.createDataFrame([(1, {"a": "x", "b": "long"}), (1, {"a": "xyz", "b": ""}), (2, None)], "id int, p map<string,string>")
    assert {r.id: r.p for r in consolidate.merge_properties(maps, "id", "p").collect()} == {1: {"a": "xyz", "b": "long"}}
    assert maps.limit(1).select(consolidate.merged_maps(F.col("p"), F.create_map(F.lit("a"), F.lit("xy"), F.lit("c"), F.lit("z"))).alias("m")).first().m == {"a": "xy", "b": "long", "c": "z"}
    images = spark.createDataFrame([(1, "", "u.jpg"), (2, None, "v.jpg"), (3, None, "v.jpg"), (4, "w.jpg", "q.jpg"), (5, None, "logo.png"), (6, None, None)], "id int, image string, candidate string")
    assert {r.id: r.image for r in consolidate.promoted_images(images, "id", "image", "candidate").collect()} == {1: "u.jpg", 2: None, 3: None, 4: "w.jpg", 5: None, 6: None}
    d = spark.range(1).select(consolidate.image_decision(F.lit(4), F.lit(2), F.lit(None).cast("string")).alias("a"), consolidate.image_decision(F.lit(3), F.lit(9), F.lit(None).cast("string")).alias("b")).first()
    assert d.a.accepted and not d.b.accepted and d.b.reason == "weak_image_affinity"


def test_lookups(spark):
    from quernstone.operators import consolidate
    from quernstone.sources import crawl

    wanted, cache = spark.createDataFrame([("a",), ("b",)], "k string"), spark.createDataFrame([("a", 1.0)], "k string, lat double")
    found, missing = consolidate.from_cache(wanted, cache, "k")
    assert [r.lat for r in found.collect()] == [1.0] and [r.k for r in missing.collect()] == ["b"]
    links = spark.createDataFrame([("https://x.es/lugar/a#z",), ("https://x.es/b/",), ("https://x.es/en/c",), ("https://y.es/d",), ("https://x.es/seen",), (None,)], "link string")
    seen = spark.createDataFrame([("https://x.es/seen",)], "url string")
    assert {(r.url, r.detail) for r in crawl.next_round(links, seen, ["x.es"]).collect()} == {("https://x.es/lugar/a", True), ("https://x.es/b", False)}
    assert crawl.next_round(links, seen, ["x.es"], most=1).first().detail


def test_crawl_frontier_covers_every_host(spark, tmp_path):
    from quernstone.queries.consolidation import crawl_frontier

    rows = [(k, f"https://h{k:02}.es/", f'<html><body><a href="https://h{k:02}.es/lugar/a">a</a><a href="https://other{k}.es/b">b</a></body></html>') for k in range(30)]
    schema = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").schema
    have = dict(zip(("page_id", "url", "html"), range(3)))
    filled = [tuple(r[have[f.name]] if f.name in have else None for f in schema) for r in rows]
    spark.createDataFrame(filled, schema).write.parquet(f"{tmp_path}/pages.parquet")
    assert {r.url for r in crawl_frontier(spark, str(tmp_path)).collect()} == {f"https://h{k:02}.es/lugar/a" for k in range(30)}


def test_equal_scores_go_to_the_first_event_as_in_sql(spark, tmp_path):
    import duckdb

    from quernstone.queries.reports import REGISTRY

    rows = [(k, k % 7, "view" if k % 2 else "buy", float(k % 7)) for k in range(400)]
    rows += [(500, 50, "view", None), (501, 51, "view", 1.0), (502, 51, "view", None), (None, 52, "view", 9.0), (503, 52, "view", 3.0), (504, 53, "buy", float("nan")), (505, 53, "buy", 2.0)]
    events = spark.createDataFrame(rows, "event_id long, user_id long, event_type string, value double")
    events.orderBy("event_id").coalesce(1).write.parquet(f"{tmp_path}/first")
    # Partitions in which the later events come first.
    events.repartitionByRange(6, F.desc("event_id")).sortWithinPartitions(F.desc("event_id")).write.parquet(f"{tmp_path}/events.parquet")
    got = {tuple(r) for r in REGISTRY.queries["best_image_per_source"](spark, str(tmp_path)).filter("user_id <> 53").collect()}
    con = duckdb.connect(config={"threads": 1})
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/first/*.parquet')")
    assert got == {tuple(r) for r in con.execute(REGISTRY.sql["best_image_per_source"]).fetchall() if r[0] != 53}


def test_points_of_one_place_are_paired_like_any_other(spark):
    rows = [(k, 40.0 + (k % 3) / 100, -3.0) for k in range(600)] + [(7, 40.005, -3.0), (None, 40.0, -3.0), (900, None, -3.0)] + [(1000, 41.0, -3.0)] * 2 + [(1001, 41.001, -3.0)]
    points = spark.createDataFrame(rows, "id long, lat double, lng double")
    from collections import Counter

    from quernstone.functions.similarity import haversine_km

    far = haversine_km(F.col("a.lat"), F.col("a.lng"), F.col("b.lat"), F.col("b.lng"))
    every = points.alias("a").join(points.alias("b"), F.col("a.id") < F.col("b.id")).select(F.col("a.id").alias("a"), F.col("b.id").alias("b"), F.round(far, 6).alias("km")).filter("km <= 1.5")
    # Repeated rows are paired each, as SQL does.
    assert Counter(map(tuple, resolve.near_points(points, 1.5).collect())) == Counter(map(tuple, every.collect()))
