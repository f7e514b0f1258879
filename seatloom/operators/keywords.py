"""Keywords as a table: which texts hold which code's keywords, by joins on words and on what stands around blanks.

A keyword without blanks is part of a text if it is part of one of the text's words (what blanks part). It is looked for in the
distinct words of all texts: one of three characters or more can only be part of a word that holds all of its
three-character pieces, a shorter one is a piece itself; of each keyword the piece that fewest words hold is looked up, and what
is found is verified. A keyword with one blank is part of a text if its halves end and begin two neighbouring words. The
characters next to the blank are looked up among the text's distinct pairs of neighbouring words, and the pair verifies what is
found. Of a keyword with more blanks each pair of neighbouring words is such a keyword; the texts that hold its rarest pair meet it
once, by the text's key, and verify it. So the plan doesn't grow with the keywords, no text is held against all of them, a text
gives a few short rows a word and texts are shuffled once at most for each kind of keywords.

Defined cases: letter case doesn't count; an empty keyword is part of every text but an empty or null one; null keywords and
codes without keywords match nothing; texts without id are texts like others; of texts that share an id each is searched by itself.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seatloom.operators.exchange import broadcast_if_small, materialised
from seatloom.operators.extract import seat_keys
from seatloom.sources.blocs import Bloc

LONGEST = 3
#: How many characters before and after a blank are looked up: the most of these that a keyword has there.
BESIDE = (0, 1, 3)


def keyword_table(spark: SparkSession, blocs: list[Bloc]) -> DataFrame:
    return spark.createDataFrame([(b.code, k) for b in blocs for k in b.keywords], "code string, keyword string")


def _pieces(text: Column, size: int) -> Column:
    """The distinct stretches of so many characters."""
    if size == 0:
        return F.array(F.lit(""))
    return F.array_distinct(F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1)))


def _piece_hits(texts: DataFrame, words: DataFrame) -> DataFrame:
    """(text, keyword): each keyword that is part of the text. texts (text): distinct and not empty, read twice; words (keyword): distinct and
    not empty."""
    size = F.least(F.length("keyword"), F.lit(LONGEST))
    sizes = [r[0] for r in words.select(size).distinct().collect()]  # 1 to LONGEST
    own = F.coalesce(*[F.when(size == n, _pieces(F.col("keyword"), n)) for n in sizes])
    words = materialised(words.select("keyword", F.explode(own).alias("piece")))
    pieces = texts.select("text", F.explode(F.concat(*[_pieces(F.col("text"), n) for n in sizes])).alias("piece"))
    wanted = broadcast_if_small(materialised(words.select("piece").distinct()))
    counts = pieces.join(wanted, "piece", "left_semi").groupBy("piece").agg(F.count("*").alias("n"))
    # a keyword with a piece that no text holds is in none
    rarest = words.join(counts, "piece", "left").groupBy("keyword").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "piece")).alias("r"))
    rarest = broadcast_if_small(materialised(rarest.where("r.n > 0").select("keyword", F.col("r.piece").alias("piece"))))
    return pieces.join(rarest, "piece").where(F.col("text").contains(F.col("keyword"))).select("text", "keyword")


def _word_hits(rows: DataFrame, words: DataFrame) -> DataFrame:
    """(id, keyword) of keywords without blanks: found in the distinct words of all texts, then brought to the texts."""
    own = rows.select("id", F.explode(F.array_distinct(F.split("text", " "))).alias("word")).where("word <> ''")
    hits = broadcast_if_small(materialised(_piece_hits(materialised(own.select(F.col("word").alias("text")).distinct()), words)))
    return own.join(hits.withColumnRenamed("text", "word"), "word").select("id", "keyword")


def _pairs(rows: DataFrame, *kept: str) -> DataFrame:
    """The distinct neighbouring words of each text, each two joined by their blank, as column `pair`."""
    words = rows.select(*kept, F.explode(F.array(F.split("text", " "))).alias("words"))  # split once: an expression is put in wherever it is named
    n = F.size("words") - 1
    pairs = F.zip_with(F.slice("words", F.lit(1), n), F.slice("words", F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b))
    return words.select(*kept, F.explode(F.array_distinct(pairs)).alias("pair"))


def _beside(pair: str, shapes: list[tuple[int, int]]) -> list[Column]:
    """Of a column with one blank, for each shape: so many characters before the blank, the blank, and so many after it."""
    left, right = F.substring_index(pair, " ", 1), F.substring_index(pair, " ", -1)
    return [F.concat(F.substring(left, -a, a) if a else F.lit(""), F.lit(" "), F.substring(right, 1, b)) for a, b in shapes]


def _pair_hits(rows: DataFrame, words: DataFrame) -> DataFrame:
    """(id, keyword) of keywords with one blank: found among the texts' pairs of words."""
    sizes = [F.greatest(*[F.when(F.length(F.substring_index("keyword", " ", side)) >= n, F.lit(n)) for n in BESIDE]) for side in (1, -1)]
    words = words.withColumn("shape", F.struct(*[s.alias(c) for s, c in zip(sizes, "ab", strict=True)]))
    shapes = [tuple(r[0]) for r in words.select("shape").distinct().collect()]  # len(BESIDE) ** 2 at most
    own = [F.when((F.col("shape.a") == a) & (F.col("shape.b") == b), key) for (a, b), key in zip(shapes, _beside("keyword", shapes), strict=True)]
    words = broadcast_if_small(materialised(words.select("keyword", F.coalesce(*own).alias("key"))))
    keys = _pairs(rows, "id").select("id", "pair", F.explode(F.array(*_beside("pair", shapes))).alias("key"))
    return keys.join(words, "key").where(F.col("pair").contains(F.col("keyword"))).select("id", "keyword")


def keyword_hits(texts: DataFrame, keywords: DataFrame) -> DataFrame:
    """(id, keyword), distinct, of texts (id, text) and keywords (keyword, ...), in lower case: each keyword that is part of a text of
    that id."""
    words = materialised(keywords.select(F.lower("keyword").alias("keyword")).where("keyword is not null").distinct())
    blanks = F.least(F.size(F.split("keyword", " ")) - 1, F.lit(2))
    kinds = {r[0] for r in words.select(F.when(F.col("keyword") == "", F.lit(-1)).otherwise(blanks)).distinct().collect()}
    # dealt out anew: a file of few row groups would be read and searched by as few tasks
    rows = texts.select("id", F.lower("text").alias("text")).where("text <> ''").repartition("id", "text")
    found = [rows.select("id", F.lit("").alias("keyword"))] if -1 in kinds else []
    if 0 in kinds:
        found.append(_word_hits(rows, words.where((blanks == 0) & (F.col("keyword") != ""))))
    if 1 in kinds and 2 not in kinds:
        found.append(_pair_hits(rows, words.where(blanks == 1)))
    if 2 in kinds:
        parts = _pairs(words.where(blanks == 2).withColumn("text", F.col("keyword")), "keyword").withColumnRenamed("pair", "part")
        hits = materialised(_pair_hits(rows, parts.select(F.col("part").alias("keyword")).union(words.where(blanks == 1)).distinct()).distinct())
        found.append(hits.join(words.where(blanks == 1), "keyword", "left_semi").select("id", "keyword"))
        counts = hits.groupBy(F.col("keyword").alias("part")).agg(F.count("*").alias("n"))
        # a keyword with a pair that no text holds is in none
        rarest = parts.join(counts, "part", "left").groupBy("keyword").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "part")).alias("r"))
        rarest = broadcast_if_small(materialised(rarest.where("r.n > 0").select(F.col("keyword").alias("whole"), F.col("r.part").alias("keyword"))))
        maybe = hits.join(rarest, "keyword").groupBy("id").agg(F.collect_set("whole").alias("maybe")).withColumnRenamed("id", "_id")
        both = rows.join(maybe, F.col("id").eqNullSafe(F.col("_id")))
        found.append(both.select("id", F.explode(F.filter("maybe", lambda k: F.col("text").contains(k))).alias("keyword")))
    return reduce(DataFrame.union, found or [texts.select("id", F.lit("").alias("keyword")).where("false")]).distinct()


def text_codes(texts: DataFrame, keywords: DataFrame) -> DataFrame:
    """(id, code), distinct: texts that hold any of a code's keywords (code, keyword)."""
    codes = keywords.select("code", F.lower("keyword").alias("keyword")).distinct()
    return keyword_hits(texts, keywords).join(codes, "keyword").select("id", "code").distinct()


def seat_code_votes(votes: DataFrame, keywords: DataFrame) -> DataFrame:
    """The seat's key, code, votes and ratio: what each code's parties have in every seat where they have results; ratios are 0
    where the seat's total is 0. Sums by seat and party are made once."""
    keys = seat_keys(votes)
    sums = materialised(votes.groupBy(*keys, "party").agg(F.sum("votes").alias("votes")))
    codes = text_codes(sums.select(F.col("party").alias("id"), F.col("party").alias("text")).distinct(), keywords).withColumnRenamed("id", "party")
    totals = sums.groupBy(*keys).agg(F.sum("votes").alias("total"))
    rows = sums.join(codes, "party").groupBy(*keys, "code").agg(F.sum("votes").alias("votes")).join(totals, keys)
    ratio = F.when(F.col("total") == 0, 0.0).otherwise(F.col("votes").cast("double") / F.nullif("total", F.lit(0)).cast("double"))
    return rows.select(*keys, "code", "votes", ratio.alias("ratio"))
