from pyspark.sql import functions as F

from quernstone.functions import properties as P
from quernstone.functions import similarity as S
from quernstone.functions import text as X
from quernstone.functions import urls as U


def one(spark, value, make):
    return spark.createDataFrame([(value,)], "c string").select(make(F.col("c")).alias("x")).first().x


def test_text(spark):
    cases = [
        (X.squeeze, " a \n b ", "a b"), (X.strip_accents, "ÁñüŞe", "AnuSe"), (X.canonical_name, "La Catedral «Santa María» de Burgos", "catedral santa maria burgos"),
        (X.eval_name, "Dónde comprar: Museo (Prado)", "museo prado"), (X.plain_words, "Sant-Pere, 3ª", "sant-pere 3"), (X.heading, "Museo | Burgos - Turismo", "Museo"),
        (X.entity_name, "Plaza Mayor. Un lugar", "Plaza Mayor"), (X.strip_navigation, "ES EN FR IT PT DE Leer más Museo del vino", "Museo del vino"), (X.repair_mojibake, "BÂ¿Ç§", "B¿ú"),
        (X.cut_repeated_start, "uno dos tres cuatro cinco uno dos tres cuatro seis", "uno dos tres cuatro cinco"), (X.slug, "Plaza del Río!", "plaza_del_rio"), (X.local_name, "http://x/core#Museum", "Museum"),
        (X.last_words, "a b c d e f", "c d e f"), (X.nz, "  ", None), (X.fix_latin1, "EspaÃ±a", "España"),
    ]
    for make, value, expected in cases:
        assert one(spark, value, make) == expected, (make.__name__, value)
    assert one(spark, "[a, 'b'| a\nc]", X.listed) == ["a", "b", "c"]
    assert one(spark, "uno", lambda c: X.cut_at_first(c, ["dos"])) == "uno"
    assert one(spark, "texto Descubre pie", lambda c: X.cut_at_first(c, ["descubre"])) == "texto"
    assert one(spark, "el el Museo de", lambda c: X.strip_edges(c, ["el"], ["de"])) == "Museo"
    assert [one(spark, v, X.person_like) for v in ("Ana Gómez", "ana gómez", "Uno", "A B C D E")] == [True, False, False, False]
    assert one(spark, "aa Museo bb", lambda c: X.around(c, F.lit("museo"), 1)) == " Museo "


def test_urls(spark):
    cases = [
        (U.crawl_url, "HTTPS://WWW.X.es//a/b/#f", "https://www.x.es/a/b"), (U.crawl_url, "ftp://x.es/", None), (U.crawl_url, "http://x.es", "http://x.es/"),
        (U.eval_url, "http://www.X.es/A/#z", "https://x.es/a"), (U.source_url, "https://X.es/es/a%20b/?q", "https://x.es/a b"), (U.source_url, "https://x.es/web/guest", "https://x.es/"),
        (U.slug_text, "https://x.es/a/puente-de_hierro/", "puente de hierro"), (U.page_type, "https://x.es/lugar/a", "place_detail"), (U.page_type, None, "unknown"),
    ]
    for make, value, expected in cases:
        assert one(spark, value, make) == expected, (make.__name__, value)
    skipped = {"https://x.es/en/a": True, "https://x.es/zh-tw/a": True, "https://x.es/a.pdf": True, "https://x.es/feed": True, "https://x.es/lugar/a?s=": True, "https://x.es/lugar/a?b=1": False, "https://x.es/a?themeId=3": True}
    for url, expected in skipped.items():
        assert one(spark, url, U.skipped) is expected, url
    links = {"/a/b": True, "/a": False, "/a/de": False, "{x}/a/b": False, "https://x.es/a/b": True, "a/b/c": False}
    for link, expected in links.items():
        assert one(spark, link, U.plausible_link) is expected, link
    assert spark.createDataFrame([("https://x.es/a/", "../b"), (None, None)], "a string, b string").select(U.absolute("a", "b").alias("x")).collect()[0].x == "https://x.es/b"


def test_properties(spark):
    cases = [
        (P.email, "write to a.b@c.es now", "a.b@c.es"), (P.phone, "tel +34 948 123 456", "+34 948 123 456"), (P.phone, "1234", None), (P.hours, "10:00 - 14:30", "10:00 - 14:30"),
        (P.price, "5,50 €", "5,50 €"), (P.rating, "4,5/5", "4.5"), (P.number, "1,5", 1.5), (P.email, None, None),
    ]
    for make, value, expected in cases:
        assert one(spark, value, make) == expected, (make.__name__, value)
    assert one(spark, "x @42.8,-1.6,15z", P.coordinates).asDict() == {"lat": 42.8, "lng": -1.6}
    assert one(spark, "lat: 142 lng: 1", P.coordinates) is None


def test_similarity(spark):
    df = spark.createDataFrame([(["a", "b"], ["b", "c"], [1.0, 0.0], [1.0, 1.0])], "a array<string>, b array<string>, v array<double>, w array<double>")
    row = df.select(S.jaccard(F.col("a"), F.col("b")).alias("j"), S.overlap(F.col("a"), F.col("b")).alias("o"), F.round(S.cosine(F.col("v"), F.col("w")), 6).alias("c"), S.ratio(F.lit("abcd"), F.lit("bcde")).alias("r"), F.round(S.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)), 3).alias("h")).first()
    assert (row.j, row.o, row.c, row.r, row.h) == (1 / 3, 0.5, 0.707107, 0.75, 111.195)


def test_candidate_and_route_names(spark):
    cases = [
        (X.candidate_name, "Qué ver Hoteles Museo del Prado Ver", "Museo del Prado"), (X.candidate_name, "Ayuntamiento de Pamplona Plaza Mayor", "Plaza Mayor"), (X.merge_name, "Compartir: Museo, Prado", "museo prado"),
        (X.route_name, "Planifica tu viaje Ruta del vino Distancia 3 km | Web", "Ruta del vino"), (X.stop_name, "DÍA 2: Plaza Mayor / Derecha algo", "Plaza Mayor"), (X.stop_name, "de San Juan catedral", "San Juan"),
        (X.candidate_name, None, None), (X.stop_name, "", ""),
    ]
    for make, value, expected in cases:
        assert one(spark, value, make) == expected, (make.__name__, value)
    assert one(spark, "Visita Museo del Prado | Web", X.heading_names) == ["Visita Museo del Prado", "Museo del Prado"]
    assert one(spark, "Torre (A) Torre (A) torre (a) es alta. Compartir todo", lambda c: X.compact_description(c, F.lit("Torre (A)"))) == "Torre (A) es alta."
