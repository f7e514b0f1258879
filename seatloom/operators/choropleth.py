"""Maps: bloc shares joined to boundary features by seat key, with fill, tooltip and legend. One plan for all blocs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatloom.functions import colors
from seatloom.functions.text import seat_key, strip
from seatloom.sources.blocs import Bloc

# A polygon's constant style.
OPACITY, WEIGHT, LINE = 0.7, 0.5, "black"
# The legend's words for a bloc's share of all votes.
LEGEND = {"subtitle": "Percentage of total votes cast in each constituency", "no_data": "No candidates nominated", "low": "Weaker support (0%)", "high": "Stronger support (100%)"}

PAIR_LEGEND = {"subtitle": "Share of {0} in the votes of {0} and {1}", "no_data": "At least one group missing data", "end": "{0} dominated"}


def pair_share(part: Column, other: Column) -> tuple[Column, Column]:
    """part / (part + other) and whether it is defined: not if one is missing (null) or not positive (0)."""
    missing, none = part.isNull() | other.isNull(), (part <= 0) | (other <= 0)
    share = F.when(missing, F.lit(None).cast("double")).when(none, 0.0).otherwise(part / F.when(~none, part + other))
    return share, F.coalesce(~missing & ~none, F.lit(False))


def shown_blocs(columns: list[str], blocs: list[Bloc]) -> list[Bloc]:
    """Blocs that a map can be drawn of: derived ones, and those with a ratio in the results."""
    return [b for b in blocs if b.pair or f"{b.code}_ratio" in columns]


def _share(columns: list[str], bloc: Bloc) -> tuple[Column, Column]:
    column = lambda code: F.col(f"{code}_ratio").cast("double") if f"{code}_ratio" in columns else F.lit(None).cast("double")
    if bloc.pair:
        return pair_share(column(bloc.pair[0]), column(bloc.pair[1]))
    ratio = F.nanvl(column(bloc.code), F.lit(None).cast("double"))
    return ratio, ratio.isNotNull()


def seat_shares(results: DataFrame, blocs: list[Bloc], order: str = "row_pos") -> DataFrame:
    """(code, seat_key, ratio, ratio_defined, seat_name, top_three): of seats with one key the last row holds."""
    columns = results.columns
    text = lambda c: F.nullif(F.col(c), F.lit("")) if c in columns else F.lit(None).cast("string")
    made = []
    for b in shown_blocs(columns, blocs):
        ratio, defined = _share(columns, b)
        made.append(F.struct(F.lit(b.code).alias("code"), F.coalesce(ratio, F.lit(0.0)).alias("ratio"), defined.alias("ratio_defined")))
    top = F.coalesce(text("top_three_candidates"), text("top_three"), F.lit(""))
    rows = results.select(order, "seat_name", seat_key(F.coalesce("seat_name", F.lit("nan"))).alias("seat_key"), top.alias("top_three"), F.explode(F.array(*made)).alias("b"))
    rows = rows.where("seat_key <> ''")
    kept = rows.groupBy("b.code", "seat_key").agg(F.max_by(F.struct("b.ratio", "b.ratio_defined", "seat_name", "top_three"), order).alias("d"))
    return kept.select("code", "seat_key", "d.*")


def joined(features: DataFrame, shares: DataFrame, blocs: list[Bloc]) -> DataFrame:
    """Every feature with a key, for every bloc: its seat's share, or none. feature: feature_pos, raw_name, ..."""
    keyed = keyed_features(features).withColumn("code", F.explode(F.array(*[F.lit(b.code) for b in blocs])))
    data = shares.withColumn("found", F.lit(True))
    rows = keyed.join(data, ["code", "seat_key"], "left").withColumn("has_data", F.coalesce("found", F.lit(False))).drop("found")
    return (rows.withColumn("ratio", F.coalesce("ratio", F.lit(0.0))).withColumn("ratio_defined", F.coalesce("ratio_defined", F.lit(False)))
            .withColumn("top_three", F.coalesce("top_three", F.lit(""))).withColumn("seat_name", F.when(F.col("has_data"), F.col("seat_name")).otherwise(F.col("own_name"))))


def keyed_features(features: DataFrame) -> DataFrame:
    """Features with a seat key, and the name they have themselves."""
    return features.withColumn("own_name", strip(F.col("raw_name"))).withColumn("seat_key", seat_key(F.col("raw_name"))).where("seat_key <> ''")


def shares_by_seat(shares: DataFrame) -> DataFrame:
    """(seat_key, shares): of each seat a map from bloc to its share, as many as there are blocs."""
    one = F.struct("ratio", "ratio_defined", "seat_name", "top_three")
    return shares.groupBy("seat_key").agg(F.map_from_entries(F.collect_list(F.struct("code", one.alias("d")))).alias("shares"))


def stored(df: DataFrame, name: str, path: str, buckets: int, key: str = "seat_key") -> DataFrame:
    """The table of that name, written to path in buckets by key: joins of tables with as many buckets move no rows."""
    df.write.format("parquet").mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return df.sparkSession.table(name)


def joined_by_seat(keyed: DataFrame, by_seat: DataFrame, blocs: list[Bloc]) -> DataFrame:
    """What joined() gives, from keyed_features() and shares_by_seat(), both of which may be stored(): the join is by seat alone
    and blocs are told apart behind it, so all blocs come from one pass over the features."""
    rows = keyed.join(by_seat, "seat_key", "left").withColumn("code", F.explode(F.array(*[F.lit(b.code) for b in blocs])))
    d = F.try_element_at("shares", F.col("code"))
    name = F.when(d.isNotNull(), d["seat_name"]).otherwise(F.col("own_name"))
    data = {"has_data": d.isNotNull(), "ratio": F.coalesce(d["ratio"], F.lit(0.0)), "ratio_defined": F.coalesce(d["ratio_defined"], F.lit(False)), "top_three": F.coalesce(d["top_three"], F.lit("")), "seat_name": name}
    return rows.withColumns(data).drop("shares")


def _gradient(blocs: list[Bloc], i: int) -> Column:
    out = F.lit(None).cast("string")
    for b in blocs:
        out = F.when(F.col("code") == b.code, F.lit(b.gradient[i])).otherwise(out)
    return out


def _blank(ratio: Column, defined: Column) -> Column:
    return (ratio <= 0) | ~defined


def with_style(rows: DataFrame, blocs: list[Bloc]) -> DataFrame:
    """Add fill (linear in the bloc's own gradient, black without data) and the constant style."""
    fill = F.when(_blank(F.col("ratio"), F.col("ratio_defined")), colors.NO_DATA).otherwise(colors.gradient(_gradient(blocs, 0), _gradient(blocs, 1), F.col("ratio")))
    return rows.withColumn("fill", fill).withColumns({"fill_opacity": F.lit(OPACITY), "weight": F.lit(WEIGHT), "line": F.lit(LINE)})


def palette_fill(low: str | None, high: str | None, blocs: list[Bloc]) -> Column:
    """A palette's colour at the contrast curve of the ratio; without ends of its own, in the bloc's gradient."""
    ends = [F.lit(c) if c else _gradient(blocs, i) for i, c in enumerate((low, high))]
    fill = colors.gradient_rounded(*ends, colors.contrast(F.col("ratio")))
    return F.when(_blank(F.col("ratio"), F.col("ratio_defined")), colors.NO_DATA).otherwise(fill)


def with_palettes(rows: DataFrame, blocs: list[Bloc]) -> DataFrame:
    """A row for each of the fixed palettes, with shown_fill: literals in the plan, so nothing is read or joined for them."""
    each = F.array(*[F.struct(F.lit(n).alias("palette"), palette_fill(low, high, blocs).alias("shown_fill")) for n, low, high in colors.palettes()])
    return rows.withColumn("_p", F.explode(each)).select(*rows.columns, "_p.palette", "_p.shown_fill")


def fills(blocs: list[Bloc]) -> Column:
    """A map from palette to colour."""
    return F.create_map(*[x for n, low, high in colors.palettes() for x in (F.lit(n), palette_fill(low, high, blocs))])


def palette_or_default(name: str) -> str:
    return name if name in colors.PALETTES else "default"


def tooltip(escape: bool = False) -> Column:
    """The tooltip's HTML, from seat_name, own_name, has_data and top_three. Items are parted at commas."""

    def safe(c: Column) -> Column:
        return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")) if escape else c

    div = lambda kind, body: F.concat(F.lit(f'<div class="tooltip-{kind}">'), body, F.lit("</div>"))
    items = F.transform(F.split("top_three", ",", -1), lambda x: F.concat(F.lit("<li>"), safe(strip(x)), F.lit("</li>")))
    body = F.when(F.col("top_three") == "", div("empty", F.lit("No candidate data"))).otherwise(F.concat(F.lit('<ol class="tooltip-list">'), F.array_join(items, ""), F.lit("</ol>")))
    label = F.coalesce(F.nullif("seat_name", F.lit("")), F.nullif("own_name", F.lit("")), F.lit("Unknown seat"))
    full = F.concat(div("title", safe(F.coalesce("seat_name", F.lit("nan")))), div("subtitle", F.lit("Top three candidates")), body)
    return F.when(F.col("has_data"), full).otherwise(F.concat(div("title", safe(label)), div("empty", F.lit("No data"))))


def legend_words(blocs: list[Bloc]) -> list[dict[str, str]]:
    """Of each bloc: title, subtitle, no_data, low_label, high_label."""
    names, out = {b.code: b.display_name for b in blocs}, []
    for b in blocs:
        words = {"subtitle": LEGEND["subtitle"], "no_data": LEGEND["no_data"], "low_label": LEGEND["low"], "high_label": LEGEND["high"]}
        if b.pair:
            part, other = (names.get(c, c) for c in b.pair)
            words = {"subtitle": PAIR_LEGEND["subtitle"].format(part, other), "no_data": PAIR_LEGEND["no_data"], "low_label": PAIR_LEGEND["end"].format(other), "high_label": PAIR_LEGEND["end"].format(part)}
        out.append({"title": b.display_name, **words})
    return out


def _filled(words: str, *names: Column) -> Column:
    """The words with names in their places."""
    out = F.lit(words)
    for i, name in enumerate(names):
        out = F.replace(out, F.lit(f"{{{i}}}"), name)
    return out


def legends(rows: DataFrame, *within: str) -> DataFrame:
    """The same from a table of blocs (code, display_name, pair, low, high, and the columns named, within which codes are told
    apart): code, title, subtitle, no_data, low_label, high_label, low, high."""
    names = rows.select(*within, F.col("code").alias("_code"), F.col("display_name").alias("_name"))
    for i in (0, 1):
        own = names.withColumnsRenamed({"_code": f"_code{i}", "_name": f"_name{i}", **{w: f"_{w}{i}" for w in within}})
        on = F.get("pair", F.lit(i)) == F.col(f"_code{i}")
        for w in within:
            on &= F.col(w) == F.col(f"_{w}{i}")
        rows = rows.join(own, on, "left")
    part, other = (F.coalesce(f"_name{i}", F.get("pair", F.lit(i))) for i in (0, 1))
    pick = lambda mine, paired: F.when(F.col("pair").isNull(), F.lit(mine)).otherwise(paired)
    return rows.select(
        *within, "code", F.col("display_name").alias("title"), pick(LEGEND["subtitle"], _filled(PAIR_LEGEND["subtitle"], part, other)).alias("subtitle"), pick(LEGEND["no_data"], F.lit(PAIR_LEGEND["no_data"])).alias("no_data"),
        pick(LEGEND["low"], _filled(PAIR_LEGEND["end"], other)).alias("low_label"), pick(LEGEND["high"], _filled(PAIR_LEGEND["end"], part)).alias("high_label"), "low", "high",
    )
