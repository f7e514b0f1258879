"""Personal data by weak supervision, in DataFrame functions alone (operator 4, native).

1. One pass over the texts finds the base spans (e-mail, ip, card, phone: the contract's patterns and checks) and
   candidates of further kinds, each with the sentence before it and the characters after it. Positions come from the
   lengths of the pieces between matches, so a text is read once per pattern, in code points.
2. Labelers vote on each candidate: yes, no or abstain. Three read its form (regex, check digits, fillers), two look words
   up (gazetteer: cue words in the sentence before it, given names in it), two its neighbourhood (context).
3. Expectation-maximisation over the counts of vote patterns (a bounded table, whatever the corpus) estimates, for each
   kind by itself, how often its candidates are personal data and how reliable each labeler is where it votes. Stated beliefs
   weigh as much as the candidates, for most kinds have one or two labelers that tell candidates apart, too few to fix
   what the classes are; and a labeler that says the same of all of a kind's candidates keeps its beliefs.
   It runs as one fold inside a SQL expression.
4. The final span classifier is naive Bayes, a kind at a time, over features of the span that the labelers don't see as
   votes (shape, neighbours, the words before it), trained on all candidates with EM's probabilities as soft labels.
   Spans it finds likelier than not are added; base spans stay whatever it says.

Defined cases: null text is empty and has no spans; base_sha256 is then that of the empty string. Matches that
fail a check are dropped without another try inside them. Added spans overlap neither base spans of the same document
nor each other: from left to right, of two that do the likelier one stays, on a tie the first (of one start the shorter, then
the kind listed first). Texts of any length are read whole; of the sentence before a candidate at most AROUND characters count.
Repeated rows give equal rows; extra columns are not read; an empty table gives no rows.

The patterns are written with possessive quantifiers and begin only where a run of their first class begins, or
at the end of the match before (\\G): the same matches as the contract's, without quadratic time on long runs.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatloom.llm.common import cut, fields, text_or_empty

# The contract's kinds in order, as patterns of the JVM.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# What a text must hold for a base pattern to be worth trying.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){15}", "phone": r"\+[0-9]"}
# Common given and family names (gazetteers; longer ones are parameters of private_spans).
GIVEN = """
Aaron Adam Adrian Albert Alejandro Alexander Alfred Alice Alicia Amanda Amy Ana Andrea Andreas Andrew Angela Anita Ann Anna Anne Annette Anthony Antoine
Antonio Arthur Barbara Beatriz Benjamin Bernard Bernd Betty Birgit Brandon Brenda Brian Bruno Camille Carlos Carmen Carol Caroline Catherine Charles Charlotte Chloé
Christian Christine Christopher Claire Claudia Clara Cristina Cynthia Daniel David Deborah Dennis Diana Diego Dieter Dominique Donald Donna Dorothy Edward Eduardo
Elena Elizabeth Emily Emma Eric Esther Eva Fabian Felix Fernando Florian Francisco François Frank Franz Friedrich Gabriel Gary George Gerald Gerhard Günter
Hannah Hans Harold Heather Heinz Helen Helena Helga Helmut Henri Henry Holger Hugo Inés Ingrid Isabel Jack Jacob Jacques James Jan Janet Javier Jean Jeffrey Jennifer
Jessica Joan Johanna John Jonathan Jorge Joseph Joshua José Juan Juana Judith Julia Julian Julie Jürgen Karen Karin Karl Katharina Katherine Kathleen Kenneth Kevin
Klaus Larry Laura Lauren Linda Lisa Louis Lucas Lucía Luis Léa Manuel Manuela Marcel Margaret Maria Marie Mark Markus Martha Martin Martina Mary María Matthew
Matthias Melissa Michael Michel Michelle Miguel Monika Nancy
""".split()  # fmt: skip
FAMILY = """
Adams Allen Alonso Álvarez Anderson Bailey Baker Bauer Becker Bernard Bertrand Brown Campbell Carter Clark Collins Cook Cooper Cruz Davis Diaz Díaz Domínguez Dubois Dupont Durand
Edwards Evans Fernández Fischer Flores Foster Fournier García Gil Girard Gómez González Gray Green Gutiérrez Hall Harris Hartmann Hernández Hill Hoffmann Howard Hughes Jackson
Jiménez Johnson Jones Kelly King Klein Koch Krause Krüger Lambert Lange Laurent Lee Lefebvre Lehmann Leroy Lewis López Maier Martin Martínez Meyer Miller Mitchell Moore Morales
Moreau Moreno Morgan Morris Müller Muñoz Murphy Myers Navarro Nelson Neumann Ortega Ortiz Parker Pérez Petit Phillips Ramírez Ramos Reed Reyes Richard Richter Rivera Robert Roberts
Robinson Rodríguez Rogers Romero Ross Roux Rubio Ruiz Sánchez Schäfer Schmid Schmidt Schmitt Schneider Schröder Schulz Schwarz Scott Simon Smith Stewart Suárez Taylor Thomas Thompson
Torres Turner Vázquez Vincent Wagner Walker Ward Watson Weber Werner White Williams Wilson Wolf Wood Wright Young Zimmermann
""".split()  # fmt: skip
TITLES = "Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Mme|Sra?"
# Loose patterns of further kinds.
MORE = {
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}[\x20-][0-9]{2}[\x20-][0-9]{4}(?![0-9A-Za-z-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "secret": r"(?<![A-Za-z0-9_])[A-Za-z0-9_]{24,}+",
    "account": r"(?<![0-9A-Za-z])[0-9]{8,}+(?![0-9A-Za-z])",
    "name": rf"(?<!\p{{L}})(?=\p{{Lu}})(?:(?:{TITLES})\.?\x20\p{{Lu}}\p{{Ll}}+(?:\x20\p{{Lu}}\p{{Ll}}+)?|(?:GIVEN)\x20\p{{Lu}}\p{{Ll}}+)(?!\p{{L}})",
    "handle": r"(?<![A-Za-z0-9._%+@-])@[A-Za-z0-9_]{3,30}(?![A-Za-z0-9_.@])",
    "password": r"(?<=(?:password|passwd|passphrase|passwort|pwd|contraseña|Password|Passwort|PASSWORD)[\"']?\x20?[:=]\x20?[\"']?)[^\s\"'<>,;]{4,}+",
}
MORE_NEEDS = {
    "ssn": r"[0-9]{3}[\x20-][0-9]{2}[\x20-]", "iban": r"[A-Z]{2}[0-9]{2}", "secret": r"[A-Za-z0-9_]{24}", "account": r"[0-9]{8}",
    "name": r"\p{Lu}\p{Ll}+\.?\x20\p{Lu}\p{Ll}", "handle": "@", "password": r"(?i)passw|pwd|passphrase|contraseña",
}
# How each further kind looks at its strictest (a name says so by its title or not at all).
STRICT = {
    "ssn": r"^(?!000|666|9)[0-9]{3}[\x20-](?!00)[0-9]{2}[\x20-](?!0000)[0-9]{4}$",
    "iban": r"^[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?$",
    "secret": r"^(?=.*[0-9].*[0-9].*[0-9])(?=.*[A-Za-z].*[A-Za-z].*[A-Za-z])(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}|(?:sk|pk|ghp|xox[bp]|AKIA)_?[A-Za-z0-9_]{16,})$",
    "account": r"^[0-9]{9,12}$",
    "name": rf"^(?:{TITLES})\.?\x20",
    "handle": r"^@[A-Za-z][A-Za-z0-9_]{2,19}$",
    "password": r"^(?=.*[0-9])(?=.*\p{L}).{6,64}$",
}
# What a kind's candidates hold when they are something else.
FILLERS = {
    "name": r"(?i)(?<!\p{L})(?:president|minister|speaker|chairman|secretary|chancellor|pepper|beach|river|street|avenue|road|lake|county|city|texas|university|college|school|church|hospital|award|prize|day|museum|park)(?!\p{L})",
    "handle": r"(?i)^@(?:override|media|import|param|return|returns|property|deprecated|test|author|since|see|throws|staticmethod|classmethod|dataclass|interface|autowired|bean|nullable|everyone|here|charset|keyframes|supports|component|injectable|input|output)$",
    "password": r"(?i)^(?:required|optional|none|null|true|false|string|password|secret|changeme|unset|empty|hidden|your.*|my.*|\*+|\.+|\$\{?.*|%.*|\{.*)$",
}
# Cue words by kind.
CUES = {
    "ssn": "ssn|social security|sozialversicherung(?:snummer)?|sécurité sociale|seguridad social",
    "iban": "iban|account|konto(?:nummer)?|compte|cuenta|bank",
    "secret": "token|secret|password|passwd|passwort|api[_ -]?key|key|bearer|contraseña|mot de passe",
    "account": "account|acct|konto(?:nummer)?|compte|cuenta|passport|routing|customer (?:id|number|no)|policy (?:id|number|no)",
    "name": "dear|contact|signed|attn|name|sincerely|regards|sehr geehrte[r]?|chère?|estimad[oa]",
    "handle": "follow|twitter|instagram|telegram|mastodon|tiktok|user(?:name)?|handle|dm",
}
# Beliefs that estimation begins with: how often a kind's candidates are personal, and for each labeler how often
# its vote is yes on one that is and on one that isn't.
PRIORS = {"ssn": 0.2, "iban": 0.5, "secret": 0.3, "account": 0.2, "name": 0.5, "handle": 0.3, "password": 0.6}
BELIEFS = ((0.9, 0.4), (0.9, 0.1), (0.98, 0.6), (0.85, 0.06), (0.85, 0.3), (0.3, 0.1), (0.3, 0.1))

KINDS = [*BASE, *MORE]
LABELERS = len(BELIEFS)
AROUND = 160
AFTER = 40
ROUNDS = 30
#: Beliefs count as much as a kind's candidates do, and as this many at least.
LEAST = 8.0
SMOOTH = 1.0
#: Words before a candidate that are features, and their buckets a kind; feature numbers a kind, the last one its prior.
WORDS, BUCKETS, SHAPES = 4, 256, 24
SLOTS = BUCKETS + SHAPES + 1

SPAN = "struct<kind:int,start:int,end:int,value:string,before:string,after:string>"


def _empty(kind: str) -> Column:
    return F.array().cast(f"array<{kind}>")


def matches(pattern: str, number: int, needs: str) -> Column:
    """All matches of a pattern in text, in order, as SPAN; the text is only searched if it holds `needs`."""
    gaps = F.split("text", pattern, -1)
    hits = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("tail"), _empty(SPAN).alias("spans"))

    def add(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.length(x["hit"])
        before = F.right(F.concat(acc["tail"], F.right(x["gap"], F.lit(AROUND))), F.lit(AROUND))
        one = F.struct(F.lit(number).alias("kind"), begin.alias("start"), end.alias("end"), x["hit"].alias("value"), before.alias("before"), F.left(x["next"], F.lit(AFTER)).alias("after"))
        tail = F.right(F.concat(before, F.right(x["hit"], F.lit(AROUND))), F.lit(AROUND))
        return F.struct(end.alias("at"), tail.alias("tail"), F.concat(acc["spans"], F.array(one)).alias("spans"))

    parts = F.transform(hits, lambda hit, i: F.struct(F.get(gaps, i).alias("gap"), hit.alias("hit"), F.get(gaps, i + 1).alias("next")))
    found = F.aggregate(parts, start, add)["spans"]
    return F.when(F.col("text").rlike(needs), found).otherwise(_empty(SPAN))


def _valid(number: int) -> Column | None:
    part = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})"
    digits = lambda v: F.regexp_replace(v, "[^0-9]", "")
    return {
        "email": lambda x: F.lit(True),
        "ip": lambda x: x["value"].rlike(rf"^{part}(?:\.{part}){{3}}$"),
        "card": lambda x: F.length(digits(x["value"])).between(16, 19) & F.call_function("luhn_check", digits(x["value"])),
        "phone": lambda x: F.length(digits(x["value"])).between(8, 15),
    }[KINDS[number]]


def _sentence(before: Column) -> Column:
    """What of the text before a span is in its own sentence; a full stop after an abbreviation ends none."""
    return F.regexp_replace(before, r"(?is)^.*(?:(?<!\b(?:no|nr|num|acct|mr|mrs|ms|dr|prof))[.!?]\s|\n)", "")


def spans_of(docs: DataFrame, given: Sequence[str] = GIVEN) -> DataFrame:
    """doc_id, base (checked spans by kind and start) and candidates (those that overlap no base span)."""
    rows = fields(docs, "doc_id", "text").select("doc_id", text_or_empty())
    more = MORE | {"name": MORE["name"].replace("GIVEN", "|".join(rf"\Q{n}\E" for n in given) or r"(?!)")}
    base = [F.filter(matches(p, i, NEEDS[k]), _valid(i)) for i, (k, p) in enumerate(BASE.items())]
    others = [matches(p, len(BASE) + i, MORE_NEEDS[k]) for i, (k, p) in enumerate(more.items())]
    rows = rows.select("doc_id", F.concat(*base).alias("base"), F.concat(*others).alias("candidates"))
    free = F.filter("candidates", lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    slim = F.transform("base", lambda b: F.struct(b["kind"].alias("kind"), b["start"].alias("start"), b["end"].alias("end")))
    return rows.select("doc_id", slim.alias("base"), F.transform(free, lambda c: c.withField("before", _sentence(c["before"]))).alias("candidates"))


# ---------------------------------------------------------------- votes and features of a candidate


def _by_kind(c: Column, patterns: dict[str, str], field: str, form: str = "{}") -> Column:
    out = F.lit(False)
    for kind, p in patterns.items():
        out = F.when(_is(c, kind), c[field].rlike(form.format(p))).otherwise(out)
    return out


def _is(c: Column, *kinds: str) -> Column:
    return c["kind"].isin([KINDS.index(k) for k in kinds])


def _iban_holds(value: Column) -> Column:
    """Whether the remainder by 97 is 1, first four characters last, letters as numbers from 10 on."""
    bare = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(bare, F.lit(5)), F.left(bare, F.lit(4)))
    digit = lambda ch: F.conv(ch, 36, 10).cast("int")
    return F.aggregate(F.split(turned, "(?!^)"), F.lit(0), lambda acc, ch: (acc * F.when(digit(ch) > 9, 100).otherwise(10) + digit(ch)) % 97) == 1


def votes(c: Column, given: Sequence[str] = GIVEN, family: Sequence[str] = FAMILY) -> list[Column]:
    """1 personal data, 0 not, -1 abstains."""
    value, before, after = c["value"], c["before"], c["after"]
    yes_no = lambda x: F.when(x, 1).otherwise(0)
    yes = lambda x: F.when(x, 1).otherwise(-1)
    letters = F.length(F.regexp_replace(value, r"[^\p{L}]", ""))
    mixes = F.regexp_count(value, F.lit("[0-9][A-Za-z]|[A-Za-z](?=[0-9])")) >= 4
    words = F.split(value, " ")
    cued = _by_kind(c, CUES, "before", r"(?i)(?<![\p{{L}}0-9])(?:{})(?![\p{{L}}0-9])")
    strict = _by_kind(c, STRICT, "value")
    filler = value.rlike(r"(?i)(.)\1\1\1") | _by_kind(c, FILLERS, "value") | (_is(c, "secret") & (letters > 2 * F.length(value) / 3))
    known = F.get(words, F.size(words) - 2).isin(*given) | F.get(words, F.size(words) - 1).isin(*family)
    apart = F.coalesce(before.rlike("[\"'(<]$") & after.rlike("^[\"')>]"), F.lit(False))
    return [
        F.when(_is(c, "name"), yes(strict)).otherwise(yes_no(strict)),  # regex: strict form
        F.when(_is(c, "iban"), yes_no(_iban_holds(value))).when(_is(c, "secret"), yes_no(mixes)).otherwise(-1),  # regex: check digits, mixture
        yes_no(~filler),  # regex: fillers
        F.when(_is(c, "name", "password"), yes(cued)).otherwise(yes_no(cued)),  # gazetteer: cue words
        F.when(_is(c, "name"), yes_no(known)).otherwise(-1),  # gazetteer: names
        F.when(_is(c, "password"), -1).otherwise(yes_no(before.rlike("[:=#][ \"']*$"))),  # context: an assignment before it
        yes_no(apart),  # context: set apart
    ]


def features(c: Column) -> Column:
    """Numbers of the features that a candidate has, each kind with its own SLOTS numbers."""
    value, before, after = c["value"], F.lower(c["before"]), c["after"]
    size = F.length(value)
    share = F.length(F.regexp_replace(value, "[^0-9]", "")) / F.greatest(size, F.lit(1))
    bucket = lambda x, *ends: reduce(lambda acc, e: acc + F.when(x >= e, 1).otherwise(0), ends, F.lit(0))
    edge = lambda x: F.when(x.rlike(r"\p{L}"), 0).when(x.rlike("[0-9]"), 1).when(x.rlike(r"\s"), 2).when(F.coalesce(x, F.lit("")) == "", 3).otherwise(4)
    shape = [
        bucket(size, 10, 16, 24, 36, 48),
        6 + bucket(share, 0.1, 0.3, 0.6, 0.9),
        11 + edge(F.right(before, F.lit(1))),
        16 + edge(F.left(after, F.lit(1))),
        21 + F.when(value.rlike("[A-Z]") & value.rlike("[a-z]"), 2).when(value.rlike("[A-Z]"), 1).otherwise(0),
    ]
    words = F.slice(F.reverse(F.regexp_extract_all(before, F.lit(r"\p{L}+"), F.lit(0))), 1, WORDS)
    spoken = F.array_distinct(F.transform(words, lambda w: (SHAPES + F.pmod(F.xxhash64(w), F.lit(BUCKETS))).cast("int")))
    return F.transform(F.concat(F.array(*shape).cast("array<int>"), spoken), lambda f: c["kind"] * SLOTS + f)


# ---------------------------------------------------------------- expectation-maximisation as one fold


def _posterior(theta: Column, v: Column) -> Column:
    """P(personal | votes v). theta: the prior, then by labeler P(yes | 1) and P(yes | 0) where it votes."""

    def told(acc: Column, j: Column) -> Column:
        one, other, vote = F.get(theta, j * 2 + 1), F.get(theta, j * 2 + 2), F.get(v, j)
        return acc + F.when(vote == 1, F.ln(one) - F.ln(other)).when(vote == 0, F.ln(1 - one) - F.ln(1 - other)).otherwise(F.lit(0.0))

    labelers = F.sequence(F.lit(0), F.lit(LABELERS - 1))
    log_odds = F.aggregate(labelers, F.ln(F.get(theta, F.lit(0))) - F.ln(1 - F.get(theta, F.lit(0))), told)
    return 1 / (1 + F.exp(-log_odds))


def estimate(patterns: DataFrame) -> DataFrame:
    """(kind, theta) by EM over rows (kind, v, n): vote patterns and their counts. One row a kind that has candidates."""
    rows = patterns.groupBy("kind").agg(F.collect_list(F.struct("v", F.col("n").cast("double").alias("n"))).alias("rows"))
    prior = F.get(F.array(*[F.lit(PRIORS.get(k, 0.0)) for k in KINDS]), F.col("kind"))
    labelers = F.sequence(F.lit(0), F.lit(LABELERS - 1))

    def total(told_rows: Column, weight) -> Column:
        return F.aggregate(told_rows, F.lit(0.0), lambda s, r: s + r["n"] * weight(r))

    rows = rows.select(
        "kind", "rows", F.concat(F.array(prior), F.array(*[F.lit(x) for both in BELIEFS for x in both])).alias("begin"),
        F.greatest(F.lit(LEAST), total(F.col("rows"), lambda r: F.lit(1.0))).alias("weight"),
        F.transform(labelers, lambda j: F.size(F.array_distinct(F.transform("rows", lambda r: F.get(r["v"], j)))) == 1).alias("alike"),
    )

    def turn(theta: Column, _: Column) -> Column:
        told = F.transform("rows", lambda r: F.struct(r["v"].alias("v"), r["n"].alias("n"), _posterior(theta, r["v"]).alias("p")))

        def share(told_rows: Column, place: Column) -> Column:
            labeler, belief = F.floor((place - 1) / 2).cast("int"), F.get(F.col("begin"), place)
            p = lambda r: F.when(place % 2 == 1, r["p"]).otherwise(1 - r["p"])
            said = total(told_rows, lambda r: F.when(F.get(r["v"], labeler) == 1, p(r)).otherwise(0.0))
            voted = total(told_rows, lambda r: F.when(F.get(r["v"], labeler) >= 0, p(r)).otherwise(0.0))
            return F.when(F.get(F.col("alike"), labeler), belief).otherwise((said + F.col("weight") * belief) / (voted + F.col("weight")))

        def updated(told_rows: Column) -> Column:
            often = (total(told_rows, lambda r: r["p"]) + F.col("weight") * F.get(F.col("begin"), F.lit(0))) / (total(told_rows, lambda r: F.lit(1.0)) + F.col("weight"))
            return F.concat(F.array(often), F.transform(F.sequence(F.lit(1), F.lit(2 * LABELERS)), lambda place: share(told_rows, place)))

        # one element, so that the table with probabilities is made once a turn
        return F.get(F.transform(F.array(told), updated), F.lit(0))

    theta = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), F.col("begin"), turn)
    return rows.select("kind", theta.alias("theta"))


def train(spans: DataFrame, given: Sequence[str] = GIVEN, family: Sequence[str] = FAMILY) -> list[float]:
    """The classifier's weight of each feature number, and as each kind's last number its prior log odds."""
    c = F.col("c")
    rows = spans.select(F.explode("candidates").alias("c")).select(c["kind"].alias("kind"), F.array(*votes(c, given, family)).alias("v"), features(c).alias("f"))
    every = F.concat(F.array((F.col("kind") + 1) * SLOTS - 1), F.col("f"))
    counts = cut(rows.select("kind", "v", F.explode(every).alias("f")).groupBy("kind", "v", "f").agg(F.count("*").alias("n")))  # bounded by patterns and features
    whole = F.col("f") == (F.col("kind") + 1) * SLOTS - 1
    theta = estimate(counts.where(whole).select("kind", "v", "n"))  # a row a kind
    soft = counts.join(F.broadcast(theta), "kind").withColumn("p", _posterior(F.col("theta"), F.col("v")))
    sums = soft.groupBy("kind", "f").agg(F.sum(F.col("n") * F.col("p")).alias("yes"), F.sum(F.col("n") * (1 - F.col("p"))).alias("no"))
    rate = (F.col("yes") + SMOOTH) / (F.col("yes") + F.col("no") + 2 * SMOOTH)
    sums = sums.join(F.broadcast(sums.where(whole).select("kind", rate.alias("rate"))), "kind")
    prior = F.ln(F.col("rate")) - F.ln(1 - F.col("rate"))
    weight = F.ln(F.col("yes") + SMOOTH * F.col("rate")) - F.ln(F.col("no") + SMOOTH * (1 - F.col("rate"))) - prior
    out = [0.0] * (len(KINDS) * SLOTS)
    for r in sums.select("f", F.when(whole, prior).otherwise(weight).alias("w")).collect():  # at most len(out) rows
        out[r.f] = r.w
    return out


def odds(weights: list[float], c: Column) -> Column:
    """Log odds that a candidate is personal data, by the trained weights."""
    table = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")
    return F.aggregate(features(c), F.get(table, (c["kind"] + 1) * SLOTS - 1), lambda acc, f: acc + F.get(table, f))


def disjoint(scored: Column) -> Column:
    """Of spans (start, end, kind, odds) that overlap the likelier one, from left to right; in order of kind and start."""

    def add(kept: Column, x: Column) -> Column:
        last = F.get(kept, F.size(kept) - 1)
        free = (F.size(kept) == 0) | (last["end"] <= x["start"])
        return F.when(free, F.concat(kept, F.array(x))).when(x["odds"] > last["odds"], F.concat(F.slice(kept, F.lit(1), F.size(kept) - 1), F.array(x))).otherwise(kept)

    kept = F.aggregate(F.array_sort(scored), F.array().cast("array<struct<start:int,end:int,kind:int,odds:double>>"), add)
    return F.array_sort(F.transform(kept, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"))))


def private_spans(docs: DataFrame, given: Sequence[str] = GIVEN, family: Sequence[str] = FAMILY) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (kind:start:end of base and added spans), n_added."""
    spans = cut(spans_of(docs, given))
    weights = train(spans, given, family)
    scored = F.transform("candidates", lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind"), odds(weights, c).alias("odds")))
    names = F.array(*[F.lit(k) for k in KINDS])
    shown = lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))
    rows = spans.select("doc_id", "base", disjoint(F.filter(scored, lambda x: x["odds"] > 0)).alias("added"))
    count = lambda i: F.size(F.filter("base", lambda x: x["kind"] == i)).cast("long")
    base = F.array_join(F.transform("base", shown), ",")
    more = F.array_join(F.transform("added", shown), ",")
    return rows.select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(BASE)], F.sha2(base.cast("binary"), 256).alias("base_sha256"),
        F.concat_ws(",", F.nullif(base, F.lit("")), F.nullif(more, F.lit(""))).alias("spans"), F.size("added").cast("long").alias("n_added"),
    )
