"""The star-schema tables as an election: nations are seats, customers candidates, market segments parties, orders votes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatloom.sources.blocs import Bloc

#: Overlapping blocs over the segments, and one derived from two others.
BLOCS = [
    Bloc("alpha", "Alpha", ("auto", "machin"), ("#FFFFCC", "#0060C9")),
    Bloc("beta", "Beta", ("build", "furni")),
    Bloc("gamma", "Gamma", ("auto", "house"), ("#FEE8C8", "#990000")),
    Bloc("alpha_vs_beta", "Alpha against Beta", (), ("#800026", "#41AB5D"), ("alpha", "beta")),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def seats(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(key.cast("long").alias("seat_pos"), key.cast("string").alias("seat_id"), key.cast("string").alias("seat_number"), F.col("n_name").alias("seat_name"))


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(seat_id, res_pos, diid, votes): a candidate's votes are their orders; every tenth seat has no results."""
    votes = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("votes"))
    held = table(spark, sf_dir, "customer").where("c_nationkey % 10 <> 9")
    return held.join(votes, held["c_custkey"] == votes["o_custkey"]).select(F.col("c_nationkey").cast("string").alias("seat_id"), F.col("c_custkey").alias("res_pos"), F.col("c_custkey").cast("string").alias("diid"), "votes")


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(seat_id, cand_pos, diid, candidate_name, party); every seventh result has no candidate."""
    rows = table(spark, sf_dir, "customer").where("c_custkey % 7 <> 0")
    return rows.select(F.col("c_nationkey").cast("string").alias("seat_id"), F.col("c_custkey").alias("cand_pos"), F.col("c_custkey").cast("string").alias("diid"), F.col("c_name").alias("candidate_name"), F.col("c_mktsegment").alias("party"))


#: Customers of how many consecutive numbers one page holds.
PAGE_CUSTOMERS = 2000


def election_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(url, html): the tables as pages with their data in a script, for the extraction. A page has the customers of one nation
    and PAGE_CUSTOMERS consecutive numbers, so no page grows with the tables. Its seats are 0 to 3, by the customer's number;
    seat 3 holds a list instead of results, seat 2 no results at all. Results stand in order of customer; every third
    one's votes are null, some are no whole numbers. Each candidate is listed twice, an outdated entry first; some have no
    party or their name under another key. By nation and block some pages don't balance, have no mark, or no JSON."""
    number, key = F.col("o_custkey").cast("string"), F.col("o_custkey")
    votes = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("votes"))
    rows = table(spark, sf_dir, "customer").join(votes, F.col("c_custkey") == key)
    counted = F.when(key % 29 == 28, F.lit("1.5")).when(key % 3 == 0, F.lit("null")).otherwise(F.col("votes").cast("string"))
    result = F.concat(F.lit('"'), number, F.lit('":{"votes":'), counted, F.lit("}"))
    name = F.when(key % 13 == 0, F.concat(F.lit('"name":"","full_name":" '), F.col("c_name"), F.lit(' "'))).otherwise(F.concat(F.lit('"candidate_name":"'), F.col("c_name"), F.lit('"')))
    party = F.when(key % 11 == 0, F.lit("")).otherwise(F.col("c_mktsegment"))
    person = F.concat(F.lit('{"diid":"'), number, F.lit('","party":"OUTDATED","name":"old"},{"diid":'), number, F.lit(',"party":"'), party, F.lit('",'), name, F.lit("}"))
    page = ["c_nationkey", "block"]
    rows = rows.withColumns({"block": F.floor(key / PAGE_CUSTOMERS), "seat": (key % 4).cast("int"), "result": result, "person": F.when(key % 7 != 0, person)})
    listed = lambda order, x: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, F.col(x).alias("x")))), lambda e: e["x"]), ",")
    held = rows.groupBy(*page, "seat").agg(listed("o_custkey", "result").alias("results"), listed("o_custkey", "person").alias("people"))
    every = rows.select(*page).distinct().select(*page, F.explode(F.sequence(F.lit(0), F.lit(3))).alias("seat"))
    seats_ = every.join(held, [*page, "seat"], "left").join(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey")
    text = F.col("seat").cast("string")
    own = F.when(F.col("seat") == 3, F.lit(',"election_results":[]')).when(F.col("seat") == 2, F.lit("")).otherwise(F.concat(F.lit(',"election_results":{'), F.coalesce("results", F.lit("")), F.lit("}")))
    seat = F.concat(F.lit('"'), text, F.lit('":{"seat_number":'), text, F.lit(',"seat_name":"'), F.col("n_name"), F.lit("-"), text, F.lit('"'), own, F.lit("}"))
    people = F.concat(F.lit('"'), text, F.lit('":['), F.coalesce("people", F.lit("")), F.lit("]"))
    made = seats_.withColumns({"one": seat, "all": people}).groupBy(*page).agg(listed("seat", "one").alias("seats"), listed("seat", "all").alias("people"))
    fault = (F.col("c_nationkey") + F.col("block")) % 7
    html = F.concat(
        F.lit('<html><script>var a = {"b": 1};</script><script>window.data = {"k": {"z": 0}, "election'), F.when(fault == 5, "2025").otherwise("2026"), F.lit('" : {"constituencies": {'), F.when(fault == 6, ",").otherwise(""), F.col("seats"),
        F.lit('}, "candidates": {'), F.col("people"), F.when(fault == 3, "}").otherwise("}}}"), F.lit("; done();</script></html>"),
    )
    return made.select(F.concat(F.lit("nation/"), F.col("c_nationkey").cast("string"), F.lit("/"), F.col("block").cast("string")).alias("url"), html.alias("html"))


def region_blocs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(code, keyword): a bloc for each region, with parts of the parties' names for keywords."""
    names = table(spark, sf_dir, "customer").select("c_mktsegment").distinct().select(F.col("c_mktsegment").alias("party"), (F.length("c_mktsegment") % 2).alias("parity"))
    regions = table(spark, sf_dir, "region").select(F.col("r_name").alias("code"), F.col("r_regionkey").cast("int").alias("r"), (F.col("r_regionkey") % 2).cast("int").alias("parity"))
    return names.join(regions, "parity").select("code", F.substring(F.col("party"), F.col("r") + 1, F.col("r") % 4 + 1).alias("keyword"))


def config_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page, value): a bloc configuration for each region, its nations being blocs: some without keywords or colours, with one
    colour too few, or derived from two others."""
    rows, key = table(spark, sf_dir, "nation"), F.col("n_nationkey")
    code = lambda k: F.concat(F.lit("n"), k.cast("string"))
    words = F.when(key % 4 != 0, F.concat(F.lit(',"keywords":["'), F.col("n_name"), F.lit('","Of '), F.col("n_regionkey").cast("string"), F.lit('"]'))).otherwise("")
    colours = F.when(key % 3 == 0, F.lit(',"color_scale":["#FFFFCC","#0060C9"]')).when(key % 3 == 1, F.lit(',"color_scale":["#FFFFCC"]')).otherwise("")
    pair = F.when(key % 5 == 2, F.concat(F.lit(',"derived":["'), code(key - 1), F.lit('","'), code(key + 1), F.lit('"]'))).otherwise("")
    name = F.when(key % 6 != 5, F.concat(F.lit('"display_name":"'), F.initcap("n_name"), F.lit('"'))).otherwise(F.lit('"other":1'))
    one = F.concat(F.lit('"'), code(key), F.lit('":{'), name, words, colours, pair, F.lit("}"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", one.alias("x")))), lambda e: e["x"]), ",")
    return rows.groupBy(F.col("n_regionkey").alias("page")).agg(F.concat(F.lit("{"), listed, F.lit("}")).alias("value"))


def boundary_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, value): boundary collections of PAGE_CUSTOMERS customers each: names that are there, null or missing."""
    key = F.col("c_custkey")
    props = F.when(key % 6 == 5, F.lit('"cst_n":null,')).when(key % 6 == 4, F.lit("")).otherwise(F.concat(F.lit('"cst_n":"'), F.col("c_name"), F.lit('",')))
    one = F.concat(F.lit('{"type":"Feature","properties":{'), props, F.lit('"cst":'), key.cast("string"), F.lit('},"geometry":{"type":"Point","coordinates":['), key.cast("string"), F.lit(",23]}}"))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c_custkey", one.alias("x")))), lambda e: e["x"]), ",")
    return table(spark, sf_dir, "customer").groupBy(F.floor(key / PAGE_CUSTOMERS).alias("source")).agg(F.concat(F.lit('{"type":"FeatureCollection","features":['), listed, F.lit("]}")).alias("value"))
