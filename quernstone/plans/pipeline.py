"""Pages to entities, end to end: parse, filter, extract, clean, type, score, resolve."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.functions import text as X
from quernstone.functions import urls as U
from quernstone.operators import extract, plausible, ranking, scoring
from quernstone.sources import html
from quernstone.plans.scratch import stored


def entity_candidates(pages: DataFrame) -> DataFrame:
    """(page_id, url, pos, name, source_text, title, h1) of pages that aren't legal or technical."""
    fit = pages.filter(~F.lower(F.coalesce("url", F.lit(""))).rlike("elementor_library=|/aviso-legal|privacidad|cookies|accesibilidad|/feed|wp-json"))
    parsed = stored(html.parse_pages(fit), "parsed")
    rows = extract.candidates(html.blocks(parsed, ["page_id"]), ["page_id"])
    signals = parsed.select("page_id", "url", "title", "h1")
    return extract.drop_contained(rows, ["page_id"]).join(signals, "page_id")


def entities_of_pages(pages: DataFrame) -> DataFrame:
    """The scored entities of each page, the best few of each."""
    named = entity_candidates(pages).withColumn("name", X.entity_name(F.col("name"))).withColumn("page_type", U.page_type(F.col("url")))
    name, context = F.col("name"), F.col("source_text")
    typed = named.withColumn("primary_class", F.coalesce(X.nz(scoring.leading_class(name)), scoring.rescued_class(F.lit("Unknown"), name)))
    typed = typed.withColumn("role", scoring.mention_role(name, X.heading(F.col("h1")), context))
    evidence = scoring.evidence(name, context, F.lit(False), F.lit(False), F.lit(False))["score"]
    scored = typed.withColumn("evidence", evidence).withColumn("reason", plausible.candidate_verdict(name, F.col("primary_class"), F.col("page_type"), F.col("role"), context))
    judged = scored.withColumn("listing", F.col("page_type").isin("listing_page", "category_page")).withColumn("penalty", F.when(F.col("reason") == "keep", 0).otherwise(6))
    return ranking.select_per_page(judged, "page_id", [F.desc("evidence"), F.desc(F.length("name")), F.asc("pos")], "listing", "penalty").select("page_id", "url", "name", "primary_class", "page_type", "role", "evidence", "reason", "rank")
