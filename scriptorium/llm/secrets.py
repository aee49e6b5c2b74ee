"""Secret scans: fixed patterns and a randomness test battery (native)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The patterns of the base kinds, in their order.
NAMES = r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
ASSIGN = NAMES + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
TOKEN = r"[A-Za-z0-9+/_-]{18,}={0,2}"
ORDER = ["assign", "access", "hex", "random"]

# Shortest token the battery judges, its false-discovery rate, and the level
# below which one randomness test alone rejects a token.
MIN_TOKEN, RATE, REJECT = 20, 0.01, 1e-4
# Sum of squared letter frequencies of running text (index of coincidence).
TEXT_COINCIDENCE = 0.065


def spans_of(text: Column, pattern: str, group: int, shortest: int) -> Column:
    """Leftmost matches of ``pattern`` whose ``group`` has ``shortest`` or more
    code points, as structs (start, end, value). Spark gives the matches and
    the texts between them; running lengths give the places."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g))
    rows = F.filter(
        F.arrays_zip(gaps.alias("gap"), whole.alias("found"), value.alias("value")),
        lambda r: r["found"].isNotNull())
    step = "struct<at:int,out:array<struct<start:int,end:int,value:string>>>"
    walk = F.aggregate(
        rows,
        F.struct(F.lit(0).alias("at"), F.array().cast(
            "array<struct<start:int,end:int,value:string>>").alias("out")).cast(step),
        lambda s, m: F.struct(
            (s["at"] + m["gap"] + F.length(m["found"])).alias("at"),
            F.when(F.length(m["value"]) >= shortest, F.concat(s["out"], F.array(F.struct(
                (s["at"] + m["gap"]).alias("start"),
                (s["at"] + m["gap"] + F.length(m["found"])).alias("end"), m["value"].alias("value"),
            )))).otherwise(s["out"]).alias("out"),
        ).cast(step),
    )
    return walk["out"]


def let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def below(z: Column) -> Column:
    """The normal distribution function, by its logistic approximation."""
    x = F.greatest(F.lit(-8.0), F.least(F.lit(8.0), z))
    return 1 / (1 + F.exp(-1.5976 * x - 0.070565776 * x * x * x))


def judged(token: Column) -> Column:
    """The battery's result for one token: (p, random).

    The encoding is the smallest alphabet that holds the token: hexadecimal,
    base 32, upper or lower case with digits, base 62, base 64. Letters or
    digits alone are words or numbers. ``p`` is how often running text in that
    alphabet would look as uniform (chi-squared). ``random`` says that none of
    the three tests (uniformity, runs above and below the middle value, serial
    correlation) rejects a uniform source.
    """
    alphabet = F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/-_")

    def sized(body: Column) -> Column:
        chars = F.split(body, "")
        squares = F.aggregate(F.array_distinct(chars), F.lit(0.0), lambda s, c: s + F.pow(
            F.length(body).cast("double") - F.length(F.replace(body, c, F.lit(""))), F.lit(2.0)))
        size = (
            F.when(body.rlike(r"^([0-9a-f]+|[0-9A-F]+)$"), 16.0)
            .when(body.rlike(r"^[A-Z2-7]+$"), 32.0)
            .when(body.rlike(r"^([0-9a-z]+|[0-9A-Z]+)$"), 36.0)
            .when(body.rlike(r"^[0-9A-Za-z]+$"), 62.0).otherwise(64.0)
        )
        codes = F.transform(chars, lambda c: F.position(c, alphabet).cast("double"))
        mixed = body.rlike("[0-9]") & body.rlike("[A-Za-z]")
        return F.struct(
            F.length(body).cast("double").alias("n"), size.alias("size"), codes.alias("codes"),
            squares.alias("squares"), mixed.alias("mixed"))

    def moments(b: Column) -> Column:
        sums = F.aggregate(b["codes"], F.struct(
            F.lit(0.0).alias("s"), F.lit(0.0).alias("q"), F.lit(0.0).alias("x"), F.lit(-1.0).alias("last")),
            lambda a, v: F.struct(
                (a["s"] + v).alias("s"), (a["q"] + v * v).alias("q"),
                F.when(a["last"] < 0, a["x"]).otherwise(a["x"] + a["last"] * v).alias("x"),
                v.alias("last")))
        return let(sums, lambda m: F.struct(b.alias("b"), m.alias("m"), (m["s"] / b["n"]).alias("mean")))

    def runs(c: Column) -> Column:
        mean = c["mean"]
        signs = F.aggregate(c["b"]["codes"], F.struct(
            F.lit(0.0).alias("up"), F.lit(1.0).alias("runs"),
            (F.get(c["b"]["codes"], F.lit(0)) > mean).alias("last")),
            lambda a, v: F.struct(
                (a["up"] + (v > mean).cast("double")).alias("up"),
                (a["runs"] + ((v > mean) != a["last"]).cast("double")).alias("runs"),
                (v > mean).alias("last")))
        return let(signs, lambda g: F.struct(
            c["b"]["n"].alias("n"), c["b"]["size"].alias("size"), c["b"]["mixed"].alias("mixed"),
            (c["b"]["size"] / c["b"]["n"] * c["b"]["squares"] - c["b"]["n"]).alias("chi"),
            ((c["m"]["x"] + c["m"]["last"] * F.get(c["b"]["codes"], F.lit(0)) - c["b"]["n"] * mean * mean)
             / F.greatest(c["m"]["q"] - c["b"]["n"] * mean * mean, F.lit(1e-9))).alias("serial"),
            g["runs"].alias("runs"),
            (2 * g["up"] * (c["b"]["n"] - g["up"]) / c["b"]["n"] + 1).alias("expect")))

    def verdict(r: Column) -> Column:
        n, size = r["n"], r["size"]
        z_serial = (r["serial"] + 1 / (n - 1)) * F.sqrt(n)
        z_runs = (r["runs"] - r["expect"]) / F.sqrt(
            F.greatest((r["expect"] - 1) * (r["expect"] - 2) / (n - 1), F.lit(1e-9)))
        z_chi = (r["chi"] - (size - 1)) / F.sqrt(2 * (size - 1))
        shift = F.when(size == 16.0, 1.0).otherwise(size * TEXT_COINCIDENCE - 1)
        p = below((r["chi"] - (size - 1 + n * shift)) / F.sqrt(2 * (size - 1) + 4 * n * shift))
        sound = (
            (below(-z_chi) > REJECT) & (2 * below(-F.abs(z_runs)) > REJECT)
            & (2 * below(-F.abs(z_serial)) > REJECT) & r["mixed"]
        )
        return F.struct(p.alias("p"), sound.alias("random"))

    body = F.regexp_replace(token, r"=+$", "")
    return let(let(let(let(body, sized), moments), runs), verdict)


def random_spans(text: Column) -> Column:
    """Tokens of the battery kept by a weighted Benjamini-Hochberg procedure.

    The tests of one text are one family, so a text's result depends on it
    alone. A token's weight is its length over the family's mean length: the
    power of the tests grows with length, so long tokens get more of the rate.
    """
    tokens = F.filter(
        spans_of(text, TOKEN, 0, MIN_TOKEN),
        lambda t: t["value"].rlike("[0-9]") & t["value"].rlike("[A-Za-z]"))
    tested = F.transform(tokens, lambda t: F.struct(
        t["start"].alias("start"), t["end"].alias("end"), judged(t["value"]).alias("j")))
    return tested


def controlled(tested: Column) -> Column:
    """The tokens the step-up procedure keeps and no single test rejects."""
    def keep(f: Column) -> Column:
        m = F.size(f["tested"]).cast("double")
        ranked = F.array_sort(F.transform(f["tested"], lambda t: F.struct(
            (t["j"]["p"] * f["total"] / m / (t["end"] - t["start"])).alias("q"),
            t["start"].alias("start"), t["end"].alias("end"), t["j"]["random"].alias("random"))))
        return let(ranked, lambda r: let(F.aggregate(
            F.transform(r, lambda x, i: F.when(x["q"] <= RATE * (i + 1) / m, x["q"])),
            F.lit(-1.0), lambda s, q: F.greatest(s, F.coalesce(q, F.lit(-1.0)))),
            lambda bound: F.filter(r, lambda x: (x["q"] <= bound) & x["random"])))

    total = F.aggregate(tested, F.lit(0.0), lambda s, t: s + (t["end"] - t["start"]))
    return let(F.struct(tested.alias("tested"), total.alias("total")), keep)


def scan_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row with ``secrets``: its spans (start, rank, kind, end) in code
    points, end exclusive, sorted.

    Base kinds are matched over the whole text, leftmost and without overlap
    within a kind, then short ones are dropped. The battery's spans (kind
    ``random``) are added where they meet no base span. A null or empty text
    has no spans; rows repeat as they came; no rows are shuffled.
    """
    t = F.coalesce(F.col(text), F.lit(""))

    def when_hit(hit: str, spans: Column) -> Column:
        empty = F.array().cast("array<struct<start:int,end:int,value:string>>")
        return F.when(t.rlike(hit), spans).otherwise(empty)

    def named(col: str, kind: str) -> Column:
        return F.transform(col, lambda s: F.struct(
            s["start"].alias("start"), F.lit(ORDER.index(kind)).alias("rank"),
            F.lit(kind).alias("kind"), s["end"].alias("end")))

    out = docs.select(
        "*",
        when_hit(ASSIGN, spans_of(t, ASSIGN, 2, 6)).alias("_assign"),
        when_hit(r"AKIA[A-Z0-9]{16}", spans_of(t, ACCESS, 0, 20)).alias("_access"),
        when_hit(r"[0-9a-f]{24}", spans_of(t, HEX, 0, 24)).alias("_hex"),
        F.when(t.rlike(r"[A-Za-z0-9+/_-]{%d}" % (MIN_TOKEN - 2)), random_spans(t)).alias("_tested"),
    )
    out = out.withColumn("_base", F.sort_array(F.concat(
        named("_assign", "assign"), named("_access", "access"), named("_hex", "hex"))))
    extra = F.filter(
        F.when(F.size("_tested") > 0, controlled(F.col("_tested"))),
        lambda r: ~F.exists("_base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))
    out = out.withColumn("_extra", F.transform(extra, lambda r: F.struct(
        r["start"].alias("start"), F.lit(3).alias("rank"), F.lit("random").alias("kind"),
        r["end"].alias("end"))))
    return out.withColumn("secrets", F.sort_array(F.concat(
        "_base", F.coalesce("_extra", F.array().cast(
            "array<struct<start:int,rank:int,kind:string,end:int>>"))))).drop(
        "_assign", "_access", "_hex", "_tested", "_base", "_extra")


def joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def mask_secrets(docs: DataFrame) -> DataFrame:
    """The rows with each found span replaced by ``[secret]``; spans that
    overlap are replaced as one. Texts without secrets are untouched, and
    ``n_chars``, where there is one, is the new text's length. All other
    columns stay as they are, whatever their names. A null text stays null;
    an empty table gives no rows."""
    found = scan_secrets(docs.select(F.struct(*docs.columns).alias("row"), "text"))
    step = "struct<at:int,out:array<string>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out")).cast(step)
    cut = F.aggregate("secrets", start, lambda a, s: F.struct(
        F.greatest(a["at"], s["end"]).alias("at"),
        F.when(s["start"] < a["at"], a["out"]).otherwise(F.concat(a["out"], F.array(
            F.substring(F.col("text"), a["at"] + 1, s["start"] - a["at"]), F.lit("[secret]")
        ))).alias("out")).cast(step))
    masked = F.concat(
        F.concat_ws("", cut["out"]), F.substring(F.col("text"), cut["at"] + 1, F.length("text")))
    hit = F.size("secrets") > 0
    out = found.withColumn("text", F.when(hit, masked).otherwise(F.col("text")))
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(
            hit, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
    return out.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
