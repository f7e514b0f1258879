"""Map pages: one self-contained document for each bloc, and the page that selects among them.

Fills of every palette come from the plan (``choropleth.fills``); the page's script only swaps them. A page is written by an
executor, line by line: its head, a line for each feature in order, its end. The driver only names the files.
"""

from __future__ import annotations

import json
import uuid
from string import Template

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatloom.functions.colors import PALETTES
from seatloom.functions.text import seat_key
from seatloom.operators import choropleth
from seatloom.sources import files
from seatloom.sources.blocs import Bloc

# Where the maps are centred, and how near.
CENTRE, ZOOM = (23.7, 90.35), 7
# Fixed value: the palette that the selector begins with; it begins with a derived bloc, if there is one.
FIRST_PALETTE = "blue_yellow"
#: What stands under the map about the data, unless the caller says more.
CREDITS = ("Votes: the page that the results were read from.", "Boundaries: the boundary file that the maps were drawn with.")

PAGE = Template("""<!doctype html>
<html><head><meta charset="utf-8"><title>$title</title>
<link rel="stylesheet" href="https://unpkg.com/leaflet@1.9.4/dist/leaflet.css">
<script src="https://unpkg.com/leaflet@1.9.4/dist/leaflet.js"></script>
<style>html,body,#map{height:100%;margin:0;font:13px sans-serif} .box{position:fixed;z-index:1000;background:#fff;border:1px solid #bbb;padding:8px 11px;max-width:270px}
#legend{left:20px;bottom:20px} #bar{height:10px;margin:6px 0 2px} #ends{display:flex;justify-content:space-between;font-size:11px;gap:40px}
.tip{max-width:270px;white-space:normal} .tooltip-title{font-weight:700} .tooltip-subtitle,.tooltip-empty{color:#666} .tooltip-list{margin:0;padding-left:18px}</style></head>
<body><div id="map"></div>
<div id="legend" class="box"><b>$title</b><div>$subtitle</div><div><span style="background:$blank">&emsp;</span> $no_data</div><div id="bar"></div><div id="ends"><span>$low_label</span><span>$high_label</span></div></div>
<script>
const ramps = $ramps;
const features = [
$features
];
const asked = new URLSearchParams(location.search).get("palette"), palette = Object.hasOwn(ramps, asked) ? asked : "default";
document.getElementById("bar").style.background = "linear-gradient(to right, " + ramps[palette].join(",") + ")";
const plain = {weight: $weight}, marked = {weight: 2};
const map = L.map("map", {center: $centre, zoom: $zoom, layers: [L.tileLayer("https://tile.openstreetmap.org/{z}/{x}/{y}.png", {attribution: "&copy; OpenStreetMap contributors"})]});
const fill = ({properties: {fills}}) => fills ? fills[palette] : "$blank";
const areas = L.geoJSON(features, {style: f => ({...plain, fillColor: fill(f), fillOpacity: $opacity, color: "$line"})}).addTo(map);
areas.bindTooltip(area => area.feature.properties.tooltip ?? "", {sticky: true, className: "tip"});
areas.on("mouseover", e => e.propagatedFrom.setStyle(marked)).on("mouseout", e => e.propagatedFrom.setStyle(plain));
</script></body></html>
""")

SELECTOR = Template("""<!doctype html>
<html><head><meta charset="utf-8"><title>$title</title><style>body{margin:0;font:14px sans-serif} header{padding:8px} iframe{border:0;width:100%;height:calc(100vh - 110px)} footer{padding:4px 8px;font-size:12px}</style></head>
<body><header><b>$title</b> <select id="bloc">$blocs</select> <select id="palette">$palettes</select></header><iframe id="map"></iframe><footer>$credits</footer>
<script>
const bloc = document.getElementById("bloc"), palette = document.getElementById("palette");
const show = () => { document.getElementById("map").src = "maps/" + bloc.value + ".html?palette=" + palette.value; };
bloc.onchange = palette.onchange = show; show();
</script></body></html>
""")


def _script_safe(value) -> str:
    return json.dumps(value).replace("</", "<\\/")


def _escaped(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


def _safe(json_text: Column) -> Column:
    return F.replace(json_text, F.lit("</"), F.lit("<\\/"))


def _members(json_object: Column) -> Column:
    """A JSON object's text without its braces; null for one without members."""
    inside = F.substring(json_object, F.lit(2), F.length(json_object) - 2)
    return F.nullif(inside, F.lit(""))


def feature_lines(features: DataFrame, results: DataFrame, blocs: list[Bloc]) -> DataFrame:
    """(code, feature_pos, line): every feature of each bloc's map as JSON, with fills of all palettes, tooltip, share and name
    where it has a seat key."""
    shown = choropleth.shown_blocs(results.columns, blocs)
    keyed = choropleth.joined(features, choropleth.seat_shares(results, shown), shown)
    own = F.struct("seat_key", "seat_name", "ratio", "ratio_defined", "top_three", choropleth.tooltip(escape=True).alias("tooltip"), choropleth.fills(shown).alias("fills"))
    keyed = keyed.select("code", "feature_pos", "geometry", "properties", F.to_json(own, {"ignoreNullFields": "false"}).alias("own"))
    codes = F.explode(F.array(*[F.lit(b.code) for b in shown]))
    bare = features.where(seat_key(F.col("raw_name")) == "").select(codes.alias("code"), "feature_pos", "geometry", "properties", F.lit("{}").alias("own"))
    # of a name that both have, the later counts
    members = F.concat_ws(",", _members(F.to_json("properties", {"ignoreNullFields": "false"})), _members(F.col("own")))
    line = F.concat(F.lit('{"type":"Feature","geometry":'), F.coalesce("geometry", F.lit("null")), F.lit(',"properties":{'), members, F.lit("}},"))
    return keyed.union(bare).select("code", F.col("feature_pos").cast("long").alias("feature_pos"), _safe(line).alias("line"))


def page_lines(features: DataFrame, results: DataFrame, blocs: list[Bloc]) -> DataFrame:
    """(code, part, feature_pos, line): the pages of all blocs; part is 0 for a page's head, 1 for features, 2 for its end."""
    ends = []
    for b, words in zip(blocs, choropleth.legend_words(blocs), strict=True):
        page = PAGE.substitute(
            **{k: _escaped(v) for k, v in words.items()}, blank="#000000", features="\0", ramps=_script_safe({"default": b.gradient, **PALETTES}),
            centre=json.dumps(CENTRE), zoom=ZOOM, opacity=choropleth.OPACITY, weight=choropleth.WEIGHT, line=choropleth.LINE,
        )
        ends += [(b.code, part, 0, text.strip("\n")) for part, text in zip((0, 2), page.split("\0"), strict=True)]
    frame = features.sparkSession.createDataFrame(ends, "code string, part int, feature_pos long, line string")
    return frame.union(feature_lines(features, results, blocs).select("code", F.lit(1), "feature_pos", "line"))


def write_maps(features: DataFrame, results: DataFrame, blocs: list[Bloc], folder: str, credits: tuple[str, ...] = CREDITS) -> list[str]:
    """A page for each bloc under folder/maps and the selector in folder (any file system that Spark knows); the paths
    written. A page is one file for one browser, so one task writes it, as its lines come; none holds a map."""
    spark, shown = features.sparkSession, choropleth.shown_blocs(results.columns, blocs)
    at = f"{folder.rstrip('/')}/maps.parts-{uuid.uuid4().hex}"
    # folders are told by a bloc's place, as codes may hold what a path can't
    place = F.element_at(F.create_map(*[x for i, b in enumerate(shown) for x in (F.lit(b.code), F.lit(i))]), F.col("code")) if shown else F.lit(0)
    lines = page_lines(features, results, shown).withColumn("bloc", place).repartition("bloc").sortWithinPartitions("bloc", "part", "feature_pos")
    lines.select("bloc", "line").write.partitionBy("bloc").text(at)
    paths = []
    for i, b in enumerate(shown):
        (part,) = files.part_files(spark, f"{at}/bloc={i}")
        paths.append(f"{folder.rstrip('/')}/maps/{b.code}.html")
        files.put(spark, part, paths[-1])
    files.remove(spark, at)
    first = next((b.code for b in shown if b.pair), shown[0].code if shown else None)
    option = lambda value, text, chosen: f'<option value="{value}"{" selected" if value == chosen else ""}>{_escaped(text)}</option>'
    page = SELECTOR.substitute(
        title="Vote shares by constituency", blocs="".join(option(b.code, b.display_name, first) for b in shown),
        palettes="".join(option(p, p.replace("_", " to ").title().replace(" To ", " to "), FIRST_PALETTE) for p in PALETTES), credits="<br>".join(map(_escaped, credits)),
    )
    files.put_text(spark, page, f"{folder.rstrip('/')}/index.html")
    return paths
