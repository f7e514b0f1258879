"""Results: totals, bloc shares, rankings, the wide seat table. All from (seat_dim, vote_rows, blocs).

The seat table takes its totals, bloc sums and party columns from one aggregate by seat over sums by (seat, party), and
its strongest results from a ranking that keeps a few rows of each seat before they are shuffled.
Blocs overlap: a party counts in every bloc of which a keyword is part of its name, so a bloc is a condition on a
party, never an attribute of it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seatloom.functions.text import one_decimal, thousands
from seatloom.operators.exchange import materialised, numbered
from seatloom.operators.extract import seat_keys
from seatloom.sources.blocs import Bloc

TOP, SUMMARY = 3, 15
SEAT = ["seat_id", "seat_number", "seat_name"]


def in_bloc(party: Column, bloc: Bloc) -> Column:
    """Whether any keyword is part of the party's name, letter case apart; false without keywords or a name."""
    name = F.lower(party)
    return reduce(lambda acc, k: acc | F.coalesce(name.contains(k), F.lit(False)), bloc.keywords, F.lit(False))


def party_by_seat(votes: DataFrame) -> DataFrame:
    """One row for each counted result, in the document's order at the sink."""
    return votes.select(*seat_keys(votes)[:-1], "seat_pos", "res_pos", *SEAT, "party", "votes")


def party_totals(votes: DataFrame) -> DataFrame:
    """(party, votes, first_seat, first_result): national sums and where a party first appears."""
    return votes.groupBy("party").agg(F.sum("votes").alias("votes"), F.min(F.struct("seat_pos", "res_pos")).alias("first")).select("party", "votes", F.col("first.seat_pos").alias("first_seat"), F.col("first.res_pos").alias("first_result"))


def ranked_parties(votes: DataFrame) -> DataFrame:
    """(party, votes), most votes first, ties by first appearance."""
    return party_totals(votes).orderBy(F.desc("votes"), "first_seat", "first_result").select("party", "votes")


def top_parties(votes: DataFrame, n: int = SUMMARY) -> DataFrame:
    """The n largest parties with their votes as text."""
    return ranked_parties(votes).limit(n).withColumn("shown", thousands(F.col("votes")))


def parties(votes: DataFrame) -> DataFrame:
    return votes.select("party").distinct()


def party_names(votes: DataFrame) -> list[str]:
    """The columns of the wide table: as many as parties, so bounded by what a table's width can be."""
    return sorted(r.party for r in parties(votes).collect())


def seat_totals(seats: DataFrame, votes: DataFrame) -> DataFrame:
    """total_votes of every seat, 0 for one without results."""
    sums = votes.groupBy(*seat_keys(votes)).agg(F.sum("votes").alias("total_votes"))
    return seats.join(sums, seat_keys(seats), "left").withColumn("total_votes", F.coalesce("total_votes", F.lit(0)))


def seat_party(seats: DataFrame, votes: DataFrame) -> DataFrame:
    """Every seat with every party, 0 where it has no votes. Parties are numbered where they are; only how many there are
    comes to the driver. The votes are read once."""
    keys = seat_keys(seats)
    sums = materialised(votes.groupBy(*keys, "party").agg(F.sum("votes").alias("votes")))
    codes = numbered(parties(sums), ["party"], "code")
    n = codes.count()
    grid = seats.select(*keys, F.explode(F.sequence(F.lit(0), F.lit(n - 1)) if n else F.array().cast("array<int>")).alias("code"))
    named = grid.join(codes.select(F.col("code").cast("int").alias("code"), "party"), "code").drop("code")
    return named.join(sums, [*keys, "party"], "left").withColumn("votes", F.coalesce("votes", F.lit(0)))


def seat_party_wide(seats: DataFrame, votes: DataFrame, names: list[str] | None = None) -> DataFrame:
    """The seat's key and a column of votes for each party, by name."""
    names, keys = party_names(votes) if names is None else names, seat_keys(seats)
    wide = votes.groupBy(*keys).pivot("party", names).agg(F.sum("votes")) if names else votes.select(*keys).distinct()
    rows = seats.select(*keys).join(wide, keys, "left")
    return rows.select(*keys, *[F.coalesce(F.col(_quoted(n)), F.lit(0)).alias(n) for n in names])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def party_blocs(votes: DataFrame, blocs: list[Bloc]) -> DataFrame:
    """(party, code) for each bloc that a party is in."""
    inside = F.array_compact(F.array(*[F.when(in_bloc(F.col("party"), b), F.lit(b.code)) for b in blocs]))
    return parties(votes).select("party", F.explode(inside).alias("code"))


def _seat_sums(votes: DataFrame, blocs: list[Bloc], names: list[str]) -> DataFrame:
    """One row a seat with votes: total_votes, _bloc<i> for each bloc, _party<i> for each name. Sums by (seat, party) come
    first, so that a bloc's keywords are looked for once a party and seat."""
    keys = seat_keys(votes)
    sums = votes.groupBy(*keys, "party").agg(F.sum("votes").alias("votes"))
    own = [F.sum(F.when(in_bloc(F.col("party"), b), F.col("votes")).otherwise(0)).alias(f"_bloc{i}") for i, b in enumerate(blocs)]
    each = [F.sum(F.when(F.col("party") == n, F.col("votes")).otherwise(0)).alias(f"_party{i}") for i, n in enumerate(names)]
    return sums.groupBy(*keys).agg(F.sum("votes").alias("total_votes"), *own, *each)


def _bloc_columns(blocs: list[Bloc]) -> list[Column]:
    """<code>_votes and <code>_ratio from _seat_sums(); ratios are 0 where the total is 0."""
    total, out = F.coalesce("total_votes", F.lit(0)), []
    for i, b in enumerate(blocs):
        own = F.coalesce(f"_bloc{i}", F.lit(0))
        out += [own.alias(f"{b.code}_votes"), F.when(total == 0, 0.0).otherwise(own.cast("double") / F.nullif(total, F.lit(0)).cast("double")).alias(f"{b.code}_ratio")]
    return out


def seat_blocs(seats: DataFrame, votes: DataFrame, blocs: list[Bloc]) -> DataFrame:
    """total_votes, <code>_votes and <code>_ratio of each bloc in every seat."""
    rows = seats.join(_seat_sums(votes, blocs, []), seat_keys(seats), "left")
    return rows.select(*seat_keys(seats), F.coalesce("total_votes", F.lit(0)).alias("total_votes"), *_bloc_columns(blocs))


def _strongest(votes: DataFrame, n: int) -> DataFrame:
    """The n strongest results of each seat with their rank from 1, ties in document order."""
    order = Window.partitionBy(*seat_keys(votes)).orderBy(F.desc("votes"), "res_pos")
    return votes.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n).select(*seat_keys(votes), "rank", "candidate_name", "party", "votes")


def seat_top(votes: DataFrame, n: int = TOP) -> DataFrame:
    """The n strongest results of each seat with votes, with their share in per cent."""
    keys = seat_keys(votes)
    totals = votes.groupBy(*keys).agg(F.sum("votes").alias("total")).where("total > 0")
    rows = _strongest(votes, n).join(totals, keys)
    return rows.select(*keys, "rank", "candidate_name", "party", "votes", (F.col("votes") / F.col("total") * 100).alias("share"))


def _top_texts(votes: DataFrame, totals: DataFrame, how: str) -> DataFrame:
    """totals (seat_id, total_votes, ...) with top_three_candidates and top_three, null for seats without votes."""
    row = F.struct("rank", "candidate_name", "party", "votes")
    rows = totals.join(_strongest(votes, TOP).groupBy(*seat_keys(votes)).agg(F.array_sort(F.collect_list(row)).alias("_top")), seat_keys(votes), how)
    share = lambda x: one_decimal(x["votes"] / F.col("total_votes") * 100)
    person = lambda x: F.concat(x["candidate_name"], F.lit(" ("), x["party"], F.lit(") "), share(x), F.lit("%"))
    party = lambda x: F.concat(x["party"], F.lit(" ("), share(x), F.lit("%)"))
    text = lambda one: F.when(F.col("total_votes") > 0, F.array_join(F.transform("_top", one), ", "))
    return rows.withColumns({"top_three_candidates": text(person), "top_three": text(party)}).drop("_top")


def seat_top_texts(votes: DataFrame) -> DataFrame:
    """(seat_id, top_three_candidates, top_three): the strongest results of each seat with votes, as text."""
    totals = votes.groupBy(*seat_keys(votes)).agg(F.sum("votes").alias("total_votes")).where("total_votes > 0")
    return _top_texts(votes, totals, "inner").drop("total_votes")


def seat_results(seats: DataFrame, votes: DataFrame, blocs: list[Bloc], names: list[str] | None = None) -> DataFrame:
    """The wide seat table. A party named like a fixed column takes that column's place, as the last writer does."""
    names = party_names(votes) if names is None else names
    rows = seats.join(_top_texts(votes, _seat_sums(votes, blocs, names), "left"), seat_keys(seats), "left")
    columns = {c: F.col(c) for c in [*seat_keys(seats)[:-1], *SEAT]} | {"total_votes": F.coalesce("total_votes", F.lit(0)).alias("total_votes")}
    columns |= {c: F.coalesce(c, F.lit("")).alias(c) for c in ("top_three_candidates", "top_three")}
    columns |= {f"{b.code}_{k}": made for b, pair in zip(blocs, zip(*[iter(_bloc_columns(blocs))] * 2, strict=True), strict=True) for k, made in zip(("votes", "ratio"), pair, strict=True)}
    columns |= {n: F.coalesce(f"_party{i}", F.lit(0)).alias(n) for i, n in enumerate(names)}
    return rows.orderBy(*seat_keys(seats)[:-1], "seat_pos").select(*columns.values())
