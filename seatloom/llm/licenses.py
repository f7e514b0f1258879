"""License scans: an Aho-Corasick automaton finds notice phrases and identifier tags in whole texts, and a
shunting-yard parser reads and evaluates the expressions that follow the tags (operator 2).

Texts become words (``common.ALNUM``) with one blank between; the automaton runs over them once and reports every
place of every phrase, overlapping ones too. After an identifier tag the expression is read from the raw text to
the end of its line, as far as it is well formed; WITH binds before AND, AND before OR.

Operators are upper case, or lower case where a listed operand follows ("mit or apache-2.0"), so prose that goes on after
an identifier ("MIT and then") ends the expression. "or later" after a version of the GNU family is part of its identifier.
Operands are looked up in the list of identifiers, those after WITH in that of exceptions; an operand that isn't
listed gives the label "unlisted" (a LicenseRef one "licenseref") and stands in the column unlisted as written.

Defined cases: null text is empty; no words give n_words 0, n_base 0, null first and last words, empty labels and
score 0. An expression that is broken from its first token on gives no labels of its own; the tag still counts
as one ("identifier"). Repeated rows give equal rows; extra columns are not read.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from seatloom.llm.automaton import AhoCorasick
from seatloom.llm.common import ALNUM, bound_batches, fields, tidy

# The phrases that the contract counts, with their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Further notice phrases, in words, with their labels.
NOTICES = {
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "cc0": "cc0",
    "creative commons zero": "cc0",
    "creative commons attribution": "cc-by",
    "attribution sharealike": "cc-by-sa",
    "attribution noncommercial": "cc-by-nc",
    "attribution noderivatives": "cc-by-nd",
    "mit license": "mit",
    "permission is hereby granted free of charge to any person": "mit",
    "apache license": "apache",
    "apache license version 2 0": "apache-2.0",
    "apache software license": "apache",
    "mozilla public license": "mpl",
    "mozilla public license version 2 0": "mpl-2.0",
    "eclipse public license": "epl",
    "eclipse distribution license": "edl",
    "common development and distribution license": "cddl",
    "european union public licence": "eupl",
    "general public license version 2": "gpl-2.0",
    "general public license version 3": "gpl-3.0",
    "lesser general public license": "lgpl",
    "library general public license": "lgpl",
    "affero general public license": "agpl",
    "free documentation license": "gfdl",
    "bsd license": "bsd",
    "2 clause bsd": "bsd-2-clause",
    "3 clause bsd": "bsd-3-clause",
    "redistribution and use in source and binary forms": "bsd",
    "isc license": "isc",
    "permission to use copy modify and or distribute this software": "isc",
    "boost software license": "bsl",
    "artistic license": "artistic",
    "zlib license": "zlib",
    "unlicense": "unlicense",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "public domain dedication": "public-domain",
    "open data commons": "odc",
    "open database license": "odbl",
    "open font license": "ofl",
    "server side public license": "sspl",
    "business source license": "busl",
    "proprietary and confidential": "proprietary",
    "no part of this publication may be reproduced": "reserved",
    "do not copy or distribute": "proprietary",
}
TAG = "spdx license identifier"
#: How surely a listed label after a tag is meant, and one that isn't listed.
SURE_TAG, SURE_UNLISTED = 0.9, 0.5
# Common public identifiers, in lower case as letter case doesn't tell them apart; scan_licenses takes more.
IDENTIFIERS = frozenset("""
0bsd aal afl-1.1 afl-2.0 afl-2.1 afl-3.0 apache-1.0 apache-1.1 apache-2.0 apsl-2.0 artistic-1.0 artistic-1.0-perl artistic-2.0 beerware blueoak-1.0.0
bsd-1-clause bsd-2-clause bsd-2-clause-patent bsd-3-clause bsd-3-clause-clear bsd-4-clause bsl-1.0 busl-1.1 bzip2-1.0.6 catosl-1.1
cc-by-1.0 cc-by-2.0 cc-by-2.5 cc-by-3.0 cc-by-4.0 cc-by-sa-1.0 cc-by-sa-2.0 cc-by-sa-2.5 cc-by-sa-3.0 cc-by-sa-4.0
cc-by-nc-1.0 cc-by-nc-2.0 cc-by-nc-2.5 cc-by-nc-3.0 cc-by-nc-4.0 cc-by-nd-1.0 cc-by-nd-2.0 cc-by-nd-2.5 cc-by-nd-3.0 cc-by-nd-4.0
cc-by-nc-sa-2.0 cc-by-nc-sa-3.0 cc-by-nc-sa-4.0 cc-by-nc-nd-2.0 cc-by-nc-nd-3.0 cc-by-nc-nd-4.0 cc0-1.0 cddl-1.0 cddl-1.1 cecill-2.1 cpal-1.0 cpl-1.0
ecl-2.0 efl-2.0 elastic-2.0 epl-1.0 epl-2.0 eupl-1.1 eupl-1.2 fsfap ftl hpnd icu ijg ipl-1.0 isc json libpng libpng-2.0 lppl-1.3c mit mit-0 mit-cmu mit-modern-variant
mpl-1.0 mpl-1.1 mpl-2.0 mpl-2.0-no-copyleft-exception ms-pl ms-rl mulanpsl-2.0 naist-2003 ncsa odbl-1.0 odc-by-1.0 ofl-1.0 ofl-1.1 oldap-2.8 openssl osl-1.0 osl-2.0 osl-3.0
bsd-2-clause-views bsd-3-clause-attribution bsd-3-clause-lbnl bsd-3-clause-modification bsd-3-clause-open-mpi bsd-4-clause-uc bsd-protection bsd-source-code cc-pddc cdla-permissive-1.0 cdla-permissive-2.0
cecill-1.0 cecill-2.0 cecill-b cecill-c curl hpnd-sell-variant imagemagick miros mit-advertising mit-enna mit-feh mit-festival mit-khronos-old mit-open-group mit-wu mitnfa ogl-uk-3.0 osl-1.1 osl-2.1 rpl-1.5 sissl spl-1.0
pddl-1.0 php-3.0 php-3.01 postgresql psf-2.0 python-2.0 qpl-1.0 ruby sleepycat sspl-1.0 tcl unicode-3.0 unicode-dfs-2016 unlicense upl-1.0 vim w3c wtfpl x11 xnet zlib zpl-2.1
""".split())  # fmt: skip
# Families whose identifiers are made of a version and how later ones are meant.
GNU = {"gpl": ("1.0", "2.0", "3.0"), "lgpl": ("2.0", "2.1", "3.0"), "agpl": ("1.0", "3.0"), "gfdl": ("1.1", "1.2", "1.3")}
LATER = ("", "-only", "-or-later")
# Identifiers of exceptions, in lower case.
EXCEPTIONS = frozenset("""
389-exception autoconf-exception-2.0 autoconf-exception-3.0 bison-exception-2.2 bootloader-exception classpath-exception-2.0 clisp-exception-2.0 ecos-exception-2.0
font-exception-2.0 gcc-exception-2.0 gcc-exception-3.1 gpl-cc-1.0 lgpl-3.0-linking-exception libtool-exception linux-syscall-note llvm-exception mif-exception
openjdk-assembly-exception-1.0 openvpn-openssl-exception qt-gpl-exception-1.0 qt-lgpl-exception-1.1 swift-exception u-boot-exception-2.0 universal-foss-exception-1.0 wxwindows-exception-3.1
""".split())  # fmt: skip
# Identifiers whose terms allow use with no more than a notice.
PERMISSIVE = frozenset(["0bsd", "apache-2.0", "blueoak-1.0.0", "bsd-2-clause", "bsd-3-clause", "bsl-1.0", "cc-by-4.0", "cc0-1.0", "isc", "mit", "mit-0", "ncsa", "postgresql", "python-2.0", "unlicense", "upl-1.0", "x11", "zlib"])


def listed(name: str, more: frozenset[str] = frozenset()) -> bool:
    """Whether an identifier in lower case is in the lists or among more; a plus means that version or a later one."""
    bare = name.removesuffix("+")
    family, _, rest = bare.partition("-")
    return bare in IDENTIFIERS or bare in more or any(rest == v + later for v in GNU.get(family, ()) for later in LATER if not (later and bare != name))


def sureness(words: int) -> float:
    """How surely a notice of so many words is meant: longer ones less often stand there by chance."""
    return 1 - 0.5 ** (words / 2)


# ---------------------------------------------------------------- expressions

_TOKEN = re.compile(r"\s*(\(|\)|[A-Za-z0-9][A-Za-z0-9.+:-]*)")
_BINDS = {"OR": 1, "AND": 2, "WITH": 3}
_OPERAND_NEXT = re.compile(r"[\s(]*([A-Za-z0-9][A-Za-z0-9.+:-]*)")
_OR_LATER = re.compile(r"\s+or\s+(?:any\s+)?later(?:\s+versions?)?(?![A-Za-z0-9+:-])", re.I)


def parse(line: str, more: frozenset[str] = frozenset()) -> list[str]:
    """The longest well-formed expression that the line begins with, in postfix order (empty: none). Operators become
    upper case, operands lower case; more are listed identifiers besides the fixed ones."""

    def operator(token: str, end: int) -> str:
        """The operator that a token in lower case stands for, if what follows it is listed; else the token."""
        follows = _OPERAND_NEXT.match(line, end) if token.islower() and token.upper() in _BINDS else None
        name = follows.group(1).rstrip(".").lower() if follows else ""
        return token.upper() if name and (name in EXCEPTIONS if token == "with" else listed(name, more)) else token

    output, stack, depth, best = [], [], 0, []
    want_operand, at = True, 0

    def drained() -> list[str]:
        return output + [op for op in reversed(stack) if op != "("]

    while m := _TOKEN.match(line, at):
        at, token = m.end(), m.group(1)
        token = token if want_operand else operator(token, at)
        if token in _BINDS:
            if want_operand:
                break
            while stack and stack[-1] != "(" and _BINDS[stack[-1]] >= _BINDS[token]:
                output.append(stack.pop())
            stack.append(token)
            want_operand = True
        elif token == "(":
            if not want_operand:
                break
            stack.append(token)
            depth += 1
        elif token == ")":
            if want_operand or not depth:
                break
            while stack[-1] != "(":
                output.append(stack.pop())
            stack.pop()
            depth -= 1
        else:
            if not want_operand:
                break
            name = token.rstrip(".").lower()
            family, _, version = name.partition("-")
            if version in GNU.get(family, ()) and (later := _OR_LATER.match(line, at)):
                at, name = later.end(), f"{name}-or-later"
            output.append(name)
            want_operand = False
        if not want_operand and not depth:
            best = drained()
    return best


def evaluate(postfix: list[str], allowed: frozenset[str] = PERMISSIVE, more: frozenset[str] = frozenset()) -> tuple[set[str], bool, str, set[str]]:
    """Labels, whether the terms can be met within the allowed identifiers, the expression in full brackets, and the
    operands that no list has. Terms with an exception, or unlisted ones, are allowed as their identifier is."""
    stack: list[tuple[set[str], bool, str, set[str]]] = []
    for token in postfix:
        if token not in _BINDS:
            label = token if listed(token, more) else "licenseref" if token.startswith(("licenseref-", "documentref-")) else "unlisted"
            stack.append(({label}, token in allowed, token, {token} if label == "unlisted" else set()))
            continue
        b, a = stack.pop(), stack.pop()
        if token == "WITH":
            known = b[2] in EXCEPTIONS
            labels = {f"{x}-with-{b[2]}" if known else x for x in a[0]} | (set() if known else {"unlisted"})
            stack.append((labels, a[1], f"{a[2]} with {b[2]}", a[3] | (set() if known else {b[2]})))
        else:
            ok = (a[1] and b[1]) if token == "AND" else (a[1] or b[1])
            stack.append((a[0] | b[0], ok, f"({a[2]} {token.lower()} {b[2]})", a[3] | b[3]))
    return stack[0] if stack else (set(), False, "", set())


# ---------------------------------------------------------------- scanning


@functools.lru_cache(1)
def _automaton() -> tuple[AhoCorasick, list[tuple[str, str]], frozenset[bytes]]:
    """The automaton over words, (kind, label) of its phrases by number, and the words that any of them has."""
    entries = [(phrase, kind, label) for kind, table in (("base", BASE), ("notice", NOTICES), ("tag", {TAG: ""})) for phrase, label in table.items()]
    phrases = [tuple(phrase.encode().split()) for phrase, _, _ in entries]
    return AhoCorasick([(p, i) for i, p in enumerate(phrases)]), [e[1:] for e in entries], frozenset(w for p in phrases for w in p)


_TABLE = ALNUM.tobytes()
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def scan(text: str, more: frozenset[str] = frozenset()) -> dict:
    raw = text.encode()
    words = raw.translate(_TABLE).split()
    automaton, entries, vocabulary = _automaton()
    places: list[tuple[str, int, int, str]] = []
    node, after = 0, 0
    for i in [i for i, w in enumerate(words) if w in vocabulary]:
        node, after = automaton.step(node if i == after else 0, words[i]), i + 1
        for n, number in automaton.outputs(node):
            kind, label = entries[number]
            places.append((label, i + 1 - n, i + 1, kind))
    base = [p for p in places if p[3] == "base"]
    labels, doubt, expressions, allowed, unlisted = {}, 1.0, [], None, set()
    for label, first, last, kind in places:
        if kind != "tag":
            labels[label] = max(labels.get(label, 0), sureness(last - first))
    tags = [p for p in places if p[3] == "tag"]
    if tags:
        ends = [m.end() for m in _WORD.finditer(raw.translate(_TABLE))]
        for _, _, last, _ in tags:
            line = raw[ends[last - 1] :].split(b"\n", 1)[0].lstrip(b" \t:=\"'").decode("utf-8", "replace")
            found, ok, shown, odd = evaluate(parse(line, more), more=more)
            if found:
                expressions.append(shown)
                allowed = ok if allowed is None else allowed and ok
            unlisted |= odd
            for label in found or {"identifier"}:
                labels[label] = max(labels.get(label, 0), SURE_UNLISTED if label in ("unlisted", "identifier") else SURE_TAG)
    for sure in labels.values():
        doubt *= 1 - sure
    return {
        "n_words": len(words), "n_base": len(base), "first_word": min((p[1] for p in base), default=None), "last_word": max((p[1] for p in base), default=None),
        "base_labels": ",".join(sorted({p[0] for p in base})), "labels": ",".join(sorted(labels)), "score": 1 - doubt if labels else 0.0,
        "expressions": expressions, "allowed": allowed, "unlisted": sorted(unlisted), "places": [{"label": p[0] or "identifier", "start": p[1], "end": p[2]} for p in places],
    }


_SCHEMA = [
    ("n_words", "long", pa.int64()), ("n_base", "long", pa.int64()), ("first_word", "long", pa.int64()), ("last_word", "long", pa.int64()), ("base_labels", "string", pa.string()), ("labels", "string", pa.string()), ("score", "double", pa.float64()),
    ("expressions", "array<string>", pa.list_(pa.string())), ("allowed", "boolean", pa.bool_()), ("unlisted", "array<string>", pa.list_(pa.string())), ("places", "array<struct<label:string,start:bigint,end:bigint>>", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))),
]


def scan_licenses(docs: DataFrame, identifiers: Iterable[str] = ()) -> DataFrame:
    """One row a document: word count, base places, labels, score, expressions in full brackets, whether all of them can
    be met by permissive terms (null: no expression), unlisted operands, and every place found, in words from 0. Identifiers
    are listed ones besides the fixed list, such as a newer public list."""
    more = frozenset(x.lower() for x in identifiers)
    bound_batches(docs.sparkSession)
    rows = fields(docs, "doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, len(whole), 500):
                batch = whole.slice(i, 500)
                found = [scan(t or "", more) for t in batch.column("text").to_pylist()]
                columns = [pa.array([f[name] for f in found], kind) for name, _, kind in _SCHEMA]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *[n for n, _, _ in _SCHEMA]])

    out = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"{n} {t}" for n, t, _ in _SCHEMA)
    return rows.mapInArrow(tidy(run), out)
