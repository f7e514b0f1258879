"""The registered queries of the vote analytics, over the star-schema tables and the page tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatloom.functions.text import first_filled, seat_key
from seatloom.operators import choropleth, exchange, extract, keywords, results
from seatloom.sources import blocs, boundaries, files, pages, tables
from seatloom.sources.tables import BLOCS, table


def _votes(spark: SparkSession, d: str) -> DataFrame:
    return extract.vote_rows(tables.seats(spark, d), tables.results(spark, d), tables.candidates(spark, d))


def vote_rows(spark, d):
    return _votes(spark, d).select("seat_id", "seat_name", "res_pos", "diid", "votes", "candidate_name", "party")


def null_votes_filtered(spark, d):
    """Results whose votes are missing go, zero stays: here every third candidate's are missing, every fifth's zero."""
    votes = F.when(F.col("res_pos") % 3 == 0, F.lit(None).cast("long")).when(F.col("res_pos") % 5 == 0, F.lit(0).cast("long")).otherwise(F.col("votes"))
    return extract.counted(tables.results(spark, d).withColumn("votes", votes)).select("seat_id", "res_pos", "votes")


def candidate_last_wins(spark, d):
    """Candidates listed under ids that repeat within a seat, and without one."""
    key = F.col("c_custkey") % 4
    rows = table(spark, d, "customer").select(F.col("c_nationkey").cast("string").alias("seat_id"), F.col("c_custkey").alias("cand_pos"), F.when(key != 3, key.cast("string")).alias("diid"), F.col("c_name").alias("candidate_name"), F.col("c_mktsegment").alias("party"))
    return extract.last_candidates(rows)


def party_by_seat(spark, d):
    return results.party_by_seat(_votes(spark, d))


def party_totals(spark, d):
    return results.party_totals(_votes(spark, d))


def top_parties(spark, d):
    return results.top_parties(_votes(spark, d))


def distinct_parties(spark, d):
    return results.parties(_votes(spark, d))


def seat_totals(spark, d):
    return results.seat_totals(tables.seats(spark, d), _votes(spark, d)).select("seat_id", "seat_name", "total_votes")


def seat_party_long(spark, d):
    return results.seat_party(tables.seats(spark, d), _votes(spark, d))


def seat_party_wide(spark, d):
    return results.seat_party_wide(tables.seats(spark, d), _votes(spark, d))


def party_bloc_match(spark, d):
    return results.party_blocs(_votes(spark, d), BLOCS)


def seat_bloc_votes(spark, d):
    return results.seat_blocs(tables.seats(spark, d), _votes(spark, d), BLOCS)


def seat_rank_top3(spark, d):
    return results.seat_top(_votes(spark, d)).withColumn("rank", F.col("rank").cast("long"))


def seat_top3_candidates(spark, d):
    return results.seat_top_texts(_votes(spark, d)).select("seat_id", "top_three_candidates")


def seat_top3_parties(spark, d):
    return results.seat_top_texts(_votes(spark, d)).select("seat_id", "top_three")


def seat_results(spark, d):
    return results.seat_results(tables.seats(spark, d), _votes(spark, d), BLOCS)


def script_payload(spark, d):
    """The first script of each page that holds the mark of its kind."""
    return table(spark, d, "pages").select("page_id", extract.script_payload(F.col("html"), "track(").alias("script"))


def page_guard(spark, d):
    return table(spark, d, "pages").where(pages.long_enough(F.col("html"))).select("page_id", F.length("html").cast("long").alias("characters"))


def brace_slice(spark, d):
    """The first balanced object of each page, and of the page within a nested one."""
    html = F.col("html")
    first = extract.balanced_object(F.substring(html, F.locate("{", html), F.length(html)))
    nested = F.concat(F.lit('x = {"a": {"b": {'), F.col("page_id").cast("string"), F.lit("}}, c} trailing }"))
    return table(spark, d, "pages").select("page_id", first.alias("first_object"), extract.balanced_object(F.substring(nested, 5, 1 << 20)).alias("nested_object"))


def props_votes(spark, d):
    """Votes held in JSON text: per seat and party."""
    votes = F.from_json("props", "struct<k:bigint>")["k"]
    rows = table(spark, d, "events").select((F.col("user_id") % 25).cast("string").alias("seat_id"), F.col("event_type").alias("party"), votes.alias("votes"))
    return extract.counted(rows).groupBy("seat_id", "party").agg(F.sum("votes").alias("votes"), F.count("*").alias("n"))


def _noisy_features(spark: SparkSession, d: str) -> DataFrame:
    """Boundary features named like the seats, with noise; every ninth under another name."""
    name, key = F.col("n_name"), F.col("n_nationkey")
    noisy = (
        F.when(key % 9 == 8, F.concat(F.lit("Elsewhere "), key.cast("string")))
        .when(key % 5 == 0, F.concat(F.lit(" \t"), F.lower(name), F.lit(" ")))
        .when(key % 5 == 1, F.concat(F.substring(name, 1, 2), F.lit("."), F.substring(name, 3, 100)))
        .when(key % 5 == 2, F.concat(name, F.lit("'!")))
        .otherwise(name)
    )
    return table(spark, d, "nation").select(key.cast("long").alias("feature_pos"), noisy.alias("raw_name"))


def seat_keys(spark, d):
    """The normaliser over seat names in the spellings that it unites."""
    places = ["Chattogram-", "Barishal-", "Chapai  Nawabganj-", "Jhalakathi-", "Moulvibazar-", "Netrokona-", "Parbatya Khagrachhari", "Parbatya Bandarban-"]
    key = F.col("n_nationkey")
    picked = F.element_at(F.array(*[F.lit(p) for p in places]), (key % len(places) + 1).cast("int"))
    raw = F.concat(F.lit(" "), picked, F.when(key % 3 == 0, F.lit("")).otherwise((key % 3).cast("string")), F.lit(" ("), F.col("n_name"), F.lit(") "))
    return table(spark, d, "nation").select("n_nationkey", raw.alias("raw_name"), seat_key(raw).alias("seat_key")).where("seat_key <> ''")


def _shares(spark: SparkSession, d: str) -> DataFrame:
    seats = tables.seats(spark, d)
    rows = results.seat_results(seats, _votes(spark, d), BLOCS).join(seats.select("seat_id", F.col("seat_pos").alias("row_pos")), "seat_id")
    return choropleth.seat_shares(rows, BLOCS)


def pair_share(spark, d):
    rows = results.seat_blocs(tables.seats(spark, d), _votes(spark, d), BLOCS)
    share, defined = choropleth.pair_share(F.col("alpha_ratio"), F.col("beta_ratio"))
    return rows.select("seat_id", share.alias("share"), defined.alias("defined"))


def _joined(spark: SparkSession, d: str) -> DataFrame:
    return choropleth.joined(_noisy_features(spark, d), _shares(spark, d), BLOCS)


def feature_join(spark, d):
    return _joined(spark, d).select("feature_pos", "code", "seat_key", "has_data", "ratio", "ratio_defined", "seat_name", "top_three")


def feature_join_stored(spark, d):
    """The same from both sides as they are kept for later maps: stored in buckets by seat key, joined where they lie."""
    at, buckets = files.scratch(spark, "seats"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = "seats_" + at.rsplit("-", 1)[1]
    keyed = choropleth.stored(choropleth.keyed_features(_noisy_features(spark, d)), f"{name}_features", f"{at}/features", buckets)
    shares = choropleth.stored(choropleth.shares_by_seat(_shares(spark, d)), f"{name}_shares", f"{at}/shares", buckets)
    return choropleth.joined_by_seat(keyed, shares, BLOCS).select("feature_pos", "code", "seat_key", "has_data", "ratio", "ratio_defined", "seat_name", "top_three")


def fill_linear(spark, d):
    return choropleth.with_style(_joined(spark, d), BLOCS).select("feature_pos", "code", "fill")


def fill_palette(spark, d):
    return choropleth.with_palettes(_joined(spark, d), BLOCS).select("feature_pos", "code", "palette", "shown_fill")


def tooltip_html(spark, d):
    return _joined(spark, d).where(F.col("code") == BLOCS[0].code).select("feature_pos", choropleth.tooltip().alias("html"))


def legend(spark, d):
    """The legends of the blocs of each region's configuration."""
    return choropleth.legends(blocs.bloc_rows(tables.config_texts(spark, d), "page"), "page")


def candidate_name(spark, d):
    """The first filled name of several columns, stripped."""
    key, name = F.col("c_custkey"), F.col("c_name")
    pick = lambda m: F.when(key % 5 == m, F.concat(F.lit(" "), name, F.lit(" \t"))).when(key % 5 == 4, F.lit(""))
    return table(spark, d, "customer").select("c_custkey", first_filled(pick(0), pick(1), pick(2), default=extract.NO_NAME).alias("candidate_name"))


def keyword_documents(spark, d):
    """Documents of each source that hold a bloc's keyword, and all."""
    text = F.col("text")
    hits = [F.count_if(results.in_bloc(text, b)).alias(b.code) for b in BLOCS[:3]]
    return table(spark, d, "documents").groupBy("source").agg(F.count("*").alias("documents"), *hits)


def page_votes(spark, d):
    """The long table of many pages: script, balanced object, JSON, unnested results, candidates."""
    return extract.elections(tables.election_pages(spark, d))[1]


def page_seats(spark, d):
    return extract.elections(tables.election_pages(spark, d))[0]


def page_errors(spark, d):
    """Pages that can't be read and results whose votes aren't whole numbers, each with what is wrong."""
    return extract.elections(tables.election_pages(spark, d))[2]


def page_results(spark, d):
    """The seat table of all pages at once, seats told apart by page."""
    seats, votes, _ = extract.elections(tables.election_pages(spark, d))
    return results.seat_results(seats, votes, BLOCS)


def marked_objects(spark, d):
    """The object after a mark, nested ones within, with objects before and after it."""
    key = F.col("n_nationkey")
    deep = F.to_json(F.struct(F.struct(F.struct(key.alias("k"), F.col("n_name").alias("n")).alias("b"), F.array(F.struct(key.alias("c"))).alias("l")).alias("a"), F.col("n_regionkey").alias("r")))
    text = F.concat(F.lit('x = {"m": {"y": 1}}; z = {"mark" : '), deep, F.lit(', "after": {"q": 2}} } tail'))
    return table(spark, d, "nation").select("n_nationkey", extract.marked_object(text, '"mark"').alias("found"))


def same_seat_keys(spark, d):
    """Seats whose names come to one key: the last of them holds."""
    key = F.col("n_nationkey")
    name = F.concat(F.lit("Region "), F.col("n_regionkey").cast("string"), F.element_at(F.array(*[F.lit(x) for x in ("", "!", "'", "..")]), (key % 4 + 1).cast("int")))
    rows = table(spark, d, "nation").select(
        key.cast("long").alias("row_pos"), name.alias("seat_name"), F.concat(F.col("n_name"), F.lit(" (x) 1.0%")).alias("top_three"),
        *[(key.cast("double") / n).alias(f"{b.code}_ratio") for n, b in enumerate(BLOCS[:3], 32)],
    )
    return choropleth.seat_shares(rows, BLOCS)


def boundary_features(spark, d):
    """Features of boundary collections: names that are there, null or missing; geometry as it stands."""
    rows = boundaries.features_of(tables.boundary_texts(spark, d), "value", "source")
    return rows.select("source", F.col("feature_pos").cast("long").alias("feature_pos"), "raw_name", F.element_at("properties", "cst").alias("cst"), F.size("properties").cast("long").alias("n_properties"), "geometry")


def bloc_config(spark, d):
    """Configurations, one a region, as they are understood."""
    rows = blocs.bloc_rows(tables.config_texts(spark, d), "page")
    return rows.select("page", F.col("place").cast("long").alias("place"), "code", "display_name", F.array_join("keywords", ",").alias("keywords"), "low", "high", F.coalesce(F.array_join("pair", "/"), F.lit("")).alias("pair"))


def seat_code_votes(spark, d):
    """What blocs have in each seat, from keywords that are a table; blocs overlap."""
    return keywords.seat_code_votes(_votes(spark, d), tables.region_blocs(spark, d))


def keyword_table_documents(spark, d):
    """How many documents hold one of an item's pairs of words: some thousand keywords over all texts."""
    words = F.split("text", " ")
    pairs = F.zip_with(F.slice(words, F.lit(1), F.size(words) - 1), F.slice(words, F.lit(2), F.size(words) - 1), lambda a, b: F.concat(a, F.lit(" "), b))
    table_ = table(spark, d, "benchmark").select(F.col("item_id").alias("code"), F.explode(pairs).alias("keyword"))
    found = keywords.text_codes(table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text"), table_)
    return found.groupBy("code").agg(F.count("*").alias("documents"))


def _written(spark: SparkSession, df: DataFrame, order: tuple[str, ...] = ()) -> DataFrame:
    """Written in order, read back, with each row's number in the order it was read in."""
    path = files.scratch(spark, "csv")
    told = files.write_ordered_csv(df, path, order)
    rows = exchange.numbered(files.read_csv(spark, path, df.drop(*order).schema, row_pos=True), ["row_pos"], "place").drop("row_pos")
    return rows.withColumn("written", F.lit(told["rows"]).cast("long"))


def csv_round_trip(spark, d):
    """The seat table written as CSV and read back, row by row, in its order."""
    return _written(spark, results.seat_results(tables.seats(spark, d), _votes(spark, d), BLOCS))


def csv_round_trip_votes(spark, d):
    """The other two result tables written as CSV and read back, row by row, in their order."""
    votes = _votes(spark, d)
    shown = ("seat_id", "seat_name", "party", "votes", "place", "written")
    nation = _written(spark, results.ranked_parties(votes)).withColumns({"seat_id": F.lit(None).cast("string"), "seat_name": F.lit(None).cast("string")})
    seats = _written(spark, results.party_by_seat(votes), ("seat_pos", "res_pos"))
    return nation.select(F.lit("party_totals").alias("result"), *shown).union(seats.select(F.lit("party_by_seat").alias("result"), *shown))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        vote_rows, null_votes_filtered, candidate_last_wins, party_by_seat, party_totals, top_parties, distinct_parties, seat_totals, seat_party_long, seat_party_wide,
        party_bloc_match, seat_bloc_votes, seat_rank_top3, seat_top3_candidates, seat_top3_parties, seat_results, script_payload, page_guard, brace_slice, props_votes,
        seat_keys, pair_share, feature_join, feature_join_stored, fill_linear, fill_palette, tooltip_html, legend, candidate_name, keyword_documents, csv_round_trip, csv_round_trip_votes,
        page_votes, page_seats, page_results, page_errors, marked_objects, same_seat_keys, boundary_features, bloc_config, seat_code_votes, keyword_table_documents,
    )
}
