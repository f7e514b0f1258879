"""From pages to the long table of votes: script, balanced object, JSON, unnested results, candidates.

Everything downstream takes two tables:
seat_dim(seat_pos, seat_id, seat_number, seat_name) and
vote_rows(seat_pos, seat_id, seat_number, seat_name, res_pos, diid, votes, candidate_name, party).
Tables of several pages have the page as a further column, and every group and join below is within a page.
Positions are those of the document, since ties are decided by them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatloom.functions.text import first_filled

# The script's mark, the keys that may hold a candidate's name, what stands in for a name and a party.
MARK = '"election2026"'
NAME_KEYS = ["candidate_name", "name", "candidate", "full_name", "candidateName"]
NO_NAME, NO_PARTY, NO_ID = "Unknown", "UNKNOWN", "None"
NO_SCRIPT, UNBALANCED, NOT_JSON, BAD_VOTES = "no script holds the election data", "the election data's braces don't balance", "the election data isn't JSON of its shape", "votes aren't a whole number in seat "

_CANDIDATE = "struct<diid:string,party:string," + ",".join(f"{k}:string" for k in NAME_KEYS) + ">"
#: election_results stays raw text: it may be a list, which means none.
DOCUMENT = f"struct<broken:string,constituencies:map<string,struct<seat_number:string,seat_name:string,election_results:string>>,candidates:map<string,array<{_CANDIDATE}>>>"


def script_payload(html: Column, mark: str = MARK) -> Column:
    """The text of the first script that holds the mark; null if none does."""
    scripts = F.regexp_extract_all(html, F.lit(r"(?is)<script\b[^>]*>(.*?)</script\s*>"), F.lit(1))
    return F.get(F.filter(scripts, lambda s: s.contains(mark)), F.lit(0))


def balanced_object(text: Column) -> Column:
    """From the first brace to the one that closes it, braces in strings counting too; null if none closes it.

    Split at closing braces, the object ends with the first piece up to which there are as many opening braces as
    pieces. The last piece has no closing brace after it and can't be that one.
    """
    pieces = F.split(text, r"\}", -1)
    start = F.struct(F.lit(0).alias("opened"), F.lit(0).alias("length"), F.lit(0).alias("pieces"), F.lit(0).alias("end"))

    def step(acc: Column, piece: Column) -> Column:
        opened = acc["opened"] + F.length(piece) - F.length(F.replace(piece, F.lit("{"), F.lit("")))
        length, n = acc["length"] + F.length(piece) + 1, acc["pieces"] + 1
        end = F.when(acc["end"] > 0, acc["end"]).when(opened == n, length).otherwise(0)
        return F.struct(opened.alias("opened"), length.alias("length"), n.alias("pieces"), end.alias("end"))

    end = F.aggregate(F.slice(pieces, 1, F.size(pieces) - 1), start, step)["end"]
    return F.when(end > 0, F.left(text, end))


def marked_object(payload: Column, mark: str = MARK) -> Column:
    """The object that follows the mark, the next colon and the next opening brace."""
    after = lambda what, start: F.call_function("locate", F.lit(what), payload, start)
    colon = after(":", after(mark, F.lit(1)))
    brace = after("{", colon)
    return F.when((colon > 0) & (brace > 0), balanced_object(F.substring(payload, brace, F.length(payload))))


def seat_keys(df: DataFrame) -> list[str]:
    """What tells a table's seats apart: their ids, within a page where there are several."""
    return ["page", "seat_id"] if "page" in df.columns else ["seat_id"]


def documents(pages: DataFrame, mark: str = MARK) -> DataFrame:
    """(page, doc, error) of pages (url, html): doc is the page's data, or error says why there is none: no marked script, an
    unbalanced object, or text that isn't JSON of the document's shape."""
    rows = pages.select(F.col("url").alias("page"), script_payload(F.col("html"), mark).alias("script"))
    rows = rows.select("page", F.col("script").isNull().alias("lost"), marked_object(F.col("script"), mark).alias("json"))
    rows = rows.select("page", "lost", F.col("json").isNull().alias("open"), F.from_json("json", DOCUMENT, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"}).alias("doc"))
    error = F.when(F.col("lost"), NO_SCRIPT).when(F.col("open"), UNBALANCED).when(F.col("doc").isNull() | F.col("doc.broken").isNotNull(), NOT_JSON)
    return rows.select("page", F.when(error.isNull(), F.col("doc")).alias("doc"), error.alias("error"))


def election_document(pages: DataFrame, mark: str = MARK) -> DataFrame:
    """(page, doc) of pages: fails where documents() has an error."""
    rows = documents(pages, mark)
    fail = F.raise_error(F.concat(F.coalesce("page", F.lit("a page")), F.lit(": "), F.col("error"))).cast("string")
    # the failure is part of the key, so that no plan can do without it
    return rows.select(F.when(F.col("error").isNotNull(), fail).otherwise(F.col("page")).alias("page"), "doc")


def seat_dim(document: DataFrame) -> DataFrame:
    """The seats of documents with their raw results: page, seat_pos, seat_id, seat_number, seat_name, raw_results."""
    flat = document.select("page", F.posexplode(F.map_entries("doc.constituencies")).alias("pos", "e"))
    one = flat.groupBy("page", F.col("e.key").alias("seat_id")).agg(F.min("pos").cast("long").alias("seat_pos"), F.max_by(F.struct("e.value"), "pos").alias("s"))
    return one.select("page", "seat_pos", "seat_id", F.col("s.value.seat_number").alias("seat_number"), F.col("s.value.seat_name").alias("seat_name"), F.col("s.value.election_results").alias("raw_results"))


def all_results(seats: DataFrame) -> DataFrame:
    """(page, seat_id, res_pos, diid, votes, bad): results in document order; a list, null or nothing means none. bad: the votes
    are neither a whole number nor null."""
    whole = F.from_json("raw_results", "map<string,struct<votes:bigint>>")
    text = F.from_json("raw_results", "map<string,struct<votes:string>>")
    flat = seats.select("page", "seat_id", F.posexplode(F.map_entries(whole)).alias("pos", "e"), F.map_entries(text).alias("texts"))
    bad = F.col("e.value.votes").isNull() & F.get("texts", F.col("pos"))["value"]["votes"].isNotNull()
    flat = flat.select("page", "seat_id", "pos", F.col("e.key").alias("diid"), F.struct(F.col("e.value.votes").alias("votes"), bad.alias("bad")).alias("v"))
    one = flat.groupBy("page", "seat_id", "diid").agg(F.min("pos").cast("long").alias("res_pos"), F.max_by("v", "pos").alias("v"))
    return one.select("page", "seat_id", "res_pos", "diid", "v.votes", "v.bad")


def results(seats: DataFrame) -> DataFrame:
    """(page, seat_id, res_pos, diid, votes) of all_results(); fails where votes are bad."""
    fail = F.raise_error(F.concat(F.lit(BAD_VOTES), F.col("seat_id"))).cast("bigint")
    return all_results(seats).withColumn("votes", F.when(F.col("bad"), fail).otherwise(F.col("votes"))).drop("bad")


def candidates(document: DataFrame) -> DataFrame:
    """(page, seat_id, cand_pos, diid, candidate_name, party) of every seat's list; of equal seats the last list holds."""
    flat = document.select("page", F.posexplode(F.map_entries("doc.candidates")).alias("pos", "e"))
    lists = flat.groupBy("page", F.col("e.key").alias("seat_id")).agg(F.max_by(F.struct("e.value"), "pos").alias("l"))
    rows = lists.select("page", "seat_id", F.posexplode("l.value").alias("cand_pos", "c"))
    name = first_filled(*[F.col(f"c.{k}") for k in NAME_KEYS], default=NO_NAME)
    return rows.select("page", "seat_id", F.col("cand_pos").cast("long").alias("cand_pos"), F.col("c.diid").alias("diid"), name.alias("candidate_name"), F.col("c.party").alias("party"))


def last_candidates(cands: DataFrame) -> DataFrame:
    """One candidate of a seat and id: the last listed. A missing id is the id 'None'."""
    keyed, keys = cands.withColumn("diid", F.coalesce("diid", F.lit(NO_ID))), [*seat_keys(cands), "diid"]
    one = keyed.groupBy(*keys).agg(F.max_by(F.struct("candidate_name", "party"), "cand_pos").alias("c"))
    return one.select(*keys, "c.candidate_name", "c.party")


def counted(found: DataFrame) -> DataFrame:
    """Results with votes; 0 counts."""
    return found.where("votes IS NOT NULL")


def vote_rows(seats: DataFrame, found: DataFrame, cands: DataFrame) -> DataFrame:
    """The long table: every counted result with its seat and, if there is one, its candidate."""
    party = F.coalesce(F.nullif("party", F.lit("")), F.lit(NO_PARTY))
    keys = seat_keys(seats)
    rows = counted(found).join(seats.select(*keys, "seat_pos", "seat_number", "seat_name"), keys).join(last_candidates(cands), [*keys, "diid"], "left")
    return rows.select(*keys[:-1], "seat_pos", "seat_id", "seat_number", "seat_name", "res_pos", "diid", "votes", F.coalesce("candidate_name", F.lit(NO_NAME)).alias("candidate_name"), party.alias("party"))


def election(pages: DataFrame, mark: str = MARK) -> tuple[DataFrame, DataFrame]:
    """(seat_dim, vote_rows) of one page, which must be whole."""
    document = election_document(pages, mark)
    seats = seat_dim(document)
    return seats.drop("raw_results", "page"), vote_rows(seats, results(seats), candidates(document)).drop("page")


def elections(pages: DataFrame, mark: str = MARK) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(seat_dim, vote_rows, errors) of many pages, all with their page, which tells seats of one id apart. Pages are told by
    their url; rows with one url are taken for one page. errors (page, seat_id, error): pages without readable data, which
    have no seats, and results whose votes aren't whole numbers, which don't count."""
    found = documents(pages, mark)
    seats = seat_dim(found)
    rows = all_results(seats)
    errors = found.where("error is not null").select("page", F.lit(None).cast("string").alias("seat_id"), "error")
    bad = rows.where("bad").select("page", "seat_id", F.concat(F.lit(BAD_VOTES), F.col("seat_id")).alias("error"))
    return seats.drop("raw_results"), vote_rows(seats, rows.where("not bad").drop("bad"), candidates(found)), errors.union(bad)
