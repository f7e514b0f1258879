import csv
import json

from pyspark.sql import functions as F

from seatloom import cli
from seatloom.functions import colors
from seatloom.operators import choropleth, exchange
from seatloom.sources import blocs, boundaries, files, map_pages, pages
from tests import plain, test_election

GEO = {
    "type": "FeatureCollection",
    "features": [
        {"type": "Feature", "properties": {"cst_n": name, "cst": i}, "geometry": {"type": "Point", "coordinates": [90.0 + i, 23.5]}}
        for i, name in enumerate([" SEAT one-1", "Seat Two", "Nowhere", "", None, "Chattogram-1"])
    ] + [{"type": "Feature", "properties": {"other": 1}, "geometry": None}],
}
ROWS = [
    ("1", "Seat One-1", 100, "", "Front (60.0%)", 0.6, 0.3, 60), ("2", "seat two", 10, "A, Jr. (x) 50.0%, B (y) 50.0%", "", 0.0, 0.5, 0), ("3", "Chittagong-1", 0, "", "", None, 0.2, 0), ("4", "Seat Two!", 10, "Last <b> & more", "", 0.25, 0.75, 2), ("5", None, 1, "", "", 1.0, 1.0, 1), ("6", "???", 1, "", "", 1.0, 1.0, 1),
]


def table(spark):
    schema = "seat_id string, seat_name string, total_votes long, top_three_candidates string, top_three string, one_ratio double, two_ratio double, one_votes long"
    return spark.createDataFrame([(*r, i) for i, r in enumerate(ROWS)], schema + ", row_pos long")


def features(spark):
    return boundaries.features_of(spark.createDataFrame([(json.dumps(GEO),)], "value string"))


def test_join_fill_and_tooltip(spark):
    known = test_election.BLOCS
    shown = choropleth.shown_blocs(table(spark).columns, known)
    assert [b.code for b in shown] == ["one", "two", "pair"]
    shares = choropleth.seat_shares(table(spark), shown)
    rows = choropleth.with_style(choropleth.joined(features(spark), shares, shown), shown).withColumn("html", choropleth.tooltip()).withColumn("safe", choropleth.tooltip(escape=True))
    got = {(r.feature_pos, r.code): r for r in rows.collect()}
    assert sorted({k[0] for k in got}) == [0, 1, 2, 4, 5]
    one = {k[0]: v for k, v in got.items() if k[1] == "one"}
    assert (one[0].ratio, one[0].ratio_defined, one[0].fill) == (0.6, True, plain.mixed("#FFFFCC", "#0060C9", 0.6, int, "%02X"))
    assert (one[1].ratio, one[1].seat_name) == (0.25, "Seat Two!")  # the later of two seats with one key
    assert (one[2].has_data, one[2].fill, one[2].seat_name) == (False, "#000000", "Nowhere") and one[4].seat_key == "none"
    assert (one[5].ratio, one[5].ratio_defined, one[5].fill, one[5].has_data) == (0.0, False, "#000000", True)
    assert one[0].html == '<div class="tooltip-title">Seat One-1</div><div class="tooltip-subtitle">Top three candidates</div><ol class="tooltip-list"><li>Front (60.0%)</li></ol>'
    assert one[2].html == '<div class="tooltip-title">Nowhere</div><div class="tooltip-empty">No data</div>'
    assert "No candidate data" in one[5].html and "<b> &" in one[1].html and "&lt;b&gt; &amp;" in one[1].safe
    pair = {k[0]: v for k, v in got.items() if k[1] == "pair"}
    assert pair[0].ratio == 0.6 / (0.6 + 0.3) and (pair[5].ratio, pair[5].ratio_defined) == (0.0, False)


def test_pair_share(spark):
    cases = [(0.5, 0.25), (0.0, 0.5), (0.5, 0.0), (None, 0.5), (0.5, None), (0.0, 0.0), (-0.1, 0.5)]
    share, defined = choropleth.pair_share(F.col("a"), F.col("b"))
    got = [tuple(r) for r in spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, a double, b double").orderBy("i").select(share, defined).collect()]
    assert got == [(0.5 / 0.75, True), (0.0, False), (0.0, False), (None, False), (None, False), (0.0, False), (0.0, False)]


def test_palettes(spark):
    known = test_election.BLOCS[:1]
    rows = spark.createDataFrame([("one", 0.4, True), ("one", 0.4, False)], "code string, ratio double, ratio_defined boolean")
    got = {(r.palette, r.ratio_defined): r.shown_fill for r in choropleth.with_palettes(rows, known).collect()}
    assert len(got) == 22 and {v for (_, d), v in got.items() if not d} == {"#000000"}
    assert got["yellow_blue", True] != got["blue_yellow", True] and choropleth.palette_or_default("nope") == "default"


def test_command_line_round_trip(spark, tmp_path, monkeypatch):
    document = {
        "constituencies": {"1": {"seat_number": 1, "seat_name": "Seat One-1", "election_results": {"7": {"votes": 3}, "8": {"votes": 1}}}, "2": {"seat_number": 2, "seat_name": 'Quote "q", comma', "election_results": []}},
        "candidates": {"1": [{"diid": 7, "party": "Front A", "name": "Ann"}, {"diid": 8, "party": "Party of C", "name": "Bo, Jr."}]},
    }
    (tmp_path / "page.html").write_bytes(test_election.page(document).encode() + b"\xff")
    (tmp_path / "blocs.json").write_text(test_election.CONFIG)
    (tmp_path / "geo.json").write_text(json.dumps(GEO))
    out = {k: str(tmp_path / "results" / f"{k}.csv") for k in ("seat_results", "party_votes", "party_by_seat")}
    monkeypatch.setattr(pages, "fetch", lambda url: None)
    cli.main(["results", "--config", str(tmp_path / "blocs.json"), "--url", "http://x", "--local_html", str(tmp_path / "page.html"), *[x for k, v in out.items() for x in (f"--output_{k}", v)]])
    rows = list(csv.DictReader(open(out["seat_results"], newline="", encoding="utf-8")))
    want, _, _ = plain.election(document, test_election.BLOCS)
    assert [{k: str(v) for k, v in w.items()} for w in want] == rows
    assert list(csv.reader(open(out["party_votes"], newline=""))) == [["party", "votes"], ["Front A", "3"], ["Party of C", "1"]]
    back = files.read_seat_results(spark, out["seat_results"]).orderBy("row_pos").collect()
    assert back[1].seat_name == 'Quote "q", comma' and back[0].one_ratio == 0.75
    cli.main(["maps", "--config", str(tmp_path / "blocs.json"), "--results_csv", out["seat_results"], "--geojson", str(tmp_path / "geo.json"), "--output_dir", str(tmp_path / "site")])
    page = (tmp_path / "site" / "maps" / "one.html").read_text()
    made = json.loads(page.split("const features = ")[1].split("\n];")[0].rstrip(",\n") + "]")
    assert len(made) == 7 and made[0]["properties"]["ratio"] == 0.75 and set(made[0]["properties"]["fills"]) == {"default", *colors.PALETTES} and "fills" not in made[3]["properties"]
    index = (tmp_path / "site" / "index.html").read_text()
    assert '<option value="pair" selected>' in index and '<option value="blue_yellow" selected>Blue to Yellow' in index and index.count(" selected") == 2 and "Boundaries:" in index


def test_config_and_files(spark, tmp_path):
    by = {b.code: b for b in test_election.BLOCS}
    assert by["one"].keywords == ("front", "alliance") and by["two"].gradient == colors.DEFAULT_GRADIENT and by["missing"].keywords == ()
    (tmp_path / "c.json").write_text(test_election.CONFIG)
    assert blocs.read_blocs(spark, str(tmp_path / "c.json")) == test_election.BLOCS
    (tmp_path / "r.csv").write_text("seat_name,one_ratio\nNA,0.5\n,\n")
    rows = files.read_seat_results(spark, str(tmp_path / "r.csv")).collect()
    assert [(r.seat_name, r.one_ratio) for r in rows] == [(None, 0.5), (None, None)]
    files.write_ordered_csv(spark.createDataFrame([], "party string, votes long"), str(tmp_path / "e.csv"))
    assert (tmp_path / "e.csv").read_text().strip() == "party,votes"


def test_results_in_order_over_many_files(spark, tmp_path):
    """A table that more than one task writes: numbered part files, each with the header, read back in the order they hold; of
    seats with one key the last row of the last file holds."""
    n = 3000
    rows = spark.range(n).select((F.lit(n - 1) - F.col("id")).alias("pos"), F.concat(F.lit("Seat "), (F.col("id") % 7).cast("string")).alias("seat_name"), (F.col("id") / n).alias("one_ratio"), F.col("id").alias("own_votes")).repartition(8)
    path = str(tmp_path / "r.csv")
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        told = files.write_ordered_csv(rows, path, ["pos"], {"votes": F.sum("own_votes")})
        assert told == {"rows": n, "votes": n * (n - 1) // 2} and len([x for x in (tmp_path / "r.csv").iterdir() if x.name.startswith("part-")]) == 4
        spark.conf.set("spark.sql.files.maxPartitionBytes", "9k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        back = files.read_seat_results(spark, path)
        assert back.rdd.getNumPartitions() > 5
        assert [r.own_votes for r in back.orderBy("row_pos").collect()] == list(range(n - 1, -1, -1))
        shares = {r.seat_key: r.ratio for r in choropleth.seat_shares(back, test_election.BLOCS[:1]).collect()}
        assert shares == {f"seat {k}": k / n for k in range(7)}
        exact = exchange.numbered(back, ["row_pos"], "place")
        assert all(r.place == n - 1 - r.own_votes for r in exact.select("place", "own_votes").collect())
        plan = back._jdf.queryExecution().executedPlan().toString()
        assert "Coalesce" not in plan and "Exchange" not in plan
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_map_pages_are_written_by_tasks(spark, tmp_path):
    """Two collections' worth of features, in order, scripts closed safely, codes that no path could hold; no rows to the driver."""
    bad = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"cst_n": "</script>", "seat_key": "own"}, "geometry": {"type": "Point", "note": "</script>", "coordinates": [1, 2]}}] * 40}
    known = [*test_election.BLOCS[:2], test_election.BLOCS[4]]
    rows = features(spark).union(boundaries.features_of(spark.createDataFrame([(json.dumps(bad),)], "value string")).withColumn("feature_pos", F.col("feature_pos") + 7))
    paths = map_pages.write_maps(rows, table(spark), known, str(tmp_path / "site"))
    assert [p.rsplit("/", 1)[1] for p in paths] == ["one.html", "two.html", "pair.html"] and sorted(x.name for x in (tmp_path / "site").iterdir() if x.name[0] != ".") == ["index.html", "maps"]
    for p in paths:
        with open(p, encoding="utf-8") as f:
            page = f.read()
        made = json.loads(page.split("const features = ")[1].split("\n];")[0].rstrip(",\n") + "]")
        assert len(made) == 47 and page.count("</script>") == 2 and [f["properties"].get("cst") for f in made[:6]] == [str(i) for i in range(6)]
        assert made[0]["geometry"]["coordinates"][0] == 90.0 and made[7]["properties"]["cst_n"] == "</script>" and made[7]["properties"]["seat_key"] == "script" and made[6]["geometry"] is None


def test_legends_and_configurations_as_tables(spark):
    rows = blocs.bloc_rows(spark.createDataFrame([(test_election.CONFIG,)], "value string")).orderBy("place").collect()
    assert [(r.code, r.display_name, tuple(r.keywords), (r.low, r.high), tuple(r.pair) if r.pair else None) for r in rows] == [(b.code, b.display_name, b.keywords, b.gradient, b.pair) for b in test_election.BLOCS]
    words = choropleth.legends(blocs.bloc_rows(spark.createDataFrame([(test_election.CONFIG,)], "value string"))).collect()
    assert {r.code: {k: r[k] for k in ("title", "subtitle", "no_data", "low_label", "high_label")} for r in words} == {b.code: w for b, w in zip(test_election.BLOCS, choropleth.legend_words(test_election.BLOCS), strict=True)}
