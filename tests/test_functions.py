import math
import random

from pyspark.sql import functions as F

from seatloom.functions import colors, text
from tests import plain


def one(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(list(enumerate(rows)) if not isinstance(rows[0], tuple) else [(i, *r) for i, r in enumerate(rows)], "i int, " + schema).orderBy("i").select(*columns).collect()]


KEYS = {
    None: "", "": "", "  ": "", "Dhaka - 1": "dhaka - 1", "a  -  b": "a - b", " \tSeat\u2003": "seat", "A.B'c!": "abc", "É\u2011x İ": "x i",
    "Chattogram-1": "chittagong-1", "BARISHAL-2": "barisal-2", "Chapai Nawabganj-3": "chapai nababganj-3", "Chapai  Nawabganj-3": "chapai nawabganj-3", "Jhalakathi": "jhalokathi",
    "Moulvibazar-4": "maulvibazar-4", "Netrokona-5": "netrakona-5", "Parbatya Khagrachhari": "khagrachari-1", "Parbatya Bandarban-2": "bandarban-2", "parbatya ": "parbatya", "Parbatya x": "x-1",
    "Not Parbatya x": "not parbatya x", "barishalbarishal": "barisalbarisal", "x\x1c": "x", "a\tb": "ab",
}


def test_seat_key(spark):
    got = one(spark, list(KEYS), "name string", text.seat_key(F.col("name")))
    assert dict(zip(KEYS, [g[0] for g in got], strict=True)) == KEYS


def test_seat_key_of_any_text(spark):
    """Whatever the name: only the key's characters, never two blanks, and letter case and outer white space don't matter."""
    r = random.Random(1)
    bits = ["Chattogram", "barishal ", "-", "1", " ", "\t", "Parbatya ", "É", ".", "\x1c", "Netrokona", "\u2003"]
    names = ["".join(r.choice(bits) for _ in range(r.randrange(1, 6))) for _ in range(800)]
    got = one(spark, names, "name string", text.seat_key(F.col("name")), text.seat_key(F.concat(F.lit("\u00a0 "), F.upper("name"), F.lit("\n"))))
    assert all(a == b and set(a) <= set("abcdefghijklmnopqrstuvwxyz0123456789- ") and "  " not in a for a, b in got)


def test_strip_and_decimals(spark):
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    got = one(spark, [f"{s}x{s}y{s}" for s in spaces], "s string", text.strip(F.col("s")))
    assert len(spaces) == 29 and [g[0] for g in got] == [f"x{s}y" for s in spaces]
    pairs = [(float(v), float(t)) for t in (16, 80, 400, 2000, 7, 3) for v in range(0, t + 1, max(1, t // 80))]
    got = one(spark, pairs, "v double, t double", text.one_decimal(F.col("v") / F.col("t") * 100))
    assert [g[0] for g in got] == [f"{v / t * 100:.1f}" for v, t in pairs]


def test_colors(spark):
    ends = [("#FFF7BC", "#003F87"), ("#003F87", "#FFF7BC"), ("#f0f9e8", "#0868ac")]
    cases = [(a, b, t) for a, b in ends for t in (0.0, 0.5, 1.0, -1.0, 2.0, 0.3, 1 / 3, 0.999)]
    got = one(spark, cases, "a string, b string, t double", colors.gradient(F.col("a"), F.col("b"), F.col("t")), colors.gradient_rounded(F.col("a"), F.col("b"), F.col("t")))
    assert got == [(plain.mixed(a, b, t, int, "%02X"), plain.mixed(a, b, t, lambda x: math.floor(x + 0.5), "%02x")) for a, b, t in cases]
    curve = one(spark, [0.0, 0.5, 1.0, 0.25, 0.75], "t double", colors.contrast(F.col("t")))
    assert curve[0][0] == 0 and curve[1][0] == 0.5 and curve[2][0] == 1 and abs(curve[3][0] + curve[4][0] - 1) < 1e-9 and curve[3][0] < 0.02


def test_first_filled(spark):
    rows = [(None, None), ("", "b "), ("  ", "b"), (" a ", "b"), ("", "")]
    got = one(spark, rows, "a string, b string", text.first_filled(F.col("a"), F.col("b"), default="Unknown"))
    assert [g[0] for g in got] == ["Unknown", "b", "", "a", "Unknown"]
