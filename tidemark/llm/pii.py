"""Personal data: candidate spans scored by boosted trees, with built-in
functions only.

High-recall generators propose spans, which may overlap. Matches of the base
patterns are checked (part sizes, Luhn, digit counts); those that pass are
always kept. They also are the labelled examples: boosted trees learn from
format and context features which candidates pass, and a threshold per kind is
calibrated on held-out documents. Candidates of the further generators (a card
or phone number that runs into other digits, a national phone number, a
spelled-out mail address) that reach their kind's threshold are added where
they overlap neither a kept span nor a better candidate.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .boosting import BoostedTrees, calibrate, fit

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.95
CONTEXT = 24
_BLOCK = 64
_TEXT_BLOCK = 4096

# Each pattern finds what its plain form in the comment finds. Possessive
# loops and the look-behind keep the search linear in very long runs; \G is
# the end of the match before, where a run may go on.
_LOCAL = "A-Za-z0-9._%+-"
_GENERATORS = (
    # (kind, base pattern?, pattern, quick test)
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+
    ("email", True, rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    ("ip", True, r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}", r"[0-9]\.[0-9]"),
    # [0-9]([\x20-]?[0-9])+
    ("card", True, r"[0-9](?:[\x20-]?[0-9])++", "[0-9][0-9 -]"),
    # \+[0-9][\x20().0-9-]+[0-9]
    ("phone", True, r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]"),
    ("email", False, rf"[{_LOCAL}]{{1,64}}\x20?[\[(]at[\])]\x20?[A-Za-z0-9-]{{1,63}}"
                     r"(?:(?:\.|\x20?[\[(]dot[\])]\x20?)[A-Za-z0-9-]{1,63}){1,8}", r"[\[(]at[\])]"),
    ("card", False, r"(?<![0-9])(?:[0-9]{12,19}|[0-9]{4}([\x20-])[0-9]{4}\1[0-9]{4}\1[0-9]{4})(?![0-9])",
     "[0-9]{4}"),
    ("phone", False, r"(?:\+[0-9]{1,3}[\x20.-]?)?\([0-9]{2,4}\)[\x20.-]?[0-9]{3,4}[\x20.-]?[0-9]{4}(?![0-9])", r"[0-9]\)"),
)
_CUE = r"(?i)(call|phone|tel|fax|mobile|mail|contact|card|visa|address|host|server|\bip)[^\n]{0,12}$"
_COUNTER_CUE = r"(?i)(token|secret|key|hash|sha|isbn|version|order|invoice)[^\n]{0,12}$|[=\"'/#][\x20]?$"
FEATURES = ("kind", "digits", "length", "separators", "marks", "luhn", "parts", "left", "right", "cue")


def _starts(lens: list[str], rows: DataFrame) -> DataFrame:
    """Replaces array columns of lengths by their running sums, block by
    block, so that many matches in one text stay far from quadratic."""
    keep = [c for c in rows.columns if c not in lens]
    zero = F.lit(0)

    def total(c: str, first: Column, last: Column) -> Column:
        # Slicing would walk the whole array each time.
        return F.aggregate(F.sequence(first, last), zero, lambda a, i: a + F.get(c, i))

    def blocks(c: str) -> Column:
        n = F.ceil(F.size(c) / _BLOCK).cast("int")
        sums = F.transform(F.sequence(zero, n - 1), lambda b: total(c, b * _BLOCK, F.least((b + 1) * _BLOCK, F.size(c)) - 1))
        return F.when(n > 0, sums).otherwise(F.array().cast("array<int>"))

    rows = rows.select(*keep, *lens, *[blocks(c).alias(f"{c}_block") for c in lens])

    def before(c: str) -> Column:
        return F.transform(f"{c}_block", lambda x, b: total(f"{c}_block", zero, b) - x)

    rows = rows.select(*keep, *lens, *[before(c).alias(f"{c}_before") for c in lens])

    def running(c: str) -> Column:
        def end(_: Column, i: Column) -> Column:
            b = F.floor(i / _BLOCK).cast("int")
            return F.get(f"{c}_before", b) + total(c, b * _BLOCK, i)
        # Naming the sums outside the lambda too keeps the optimizer from
        # moving their computation into it, once per element.
        return F.when(F.size(f"{c}_before") == 0, F.col(c)).otherwise(F.transform(c, end))

    return rows.select(*keep, *[running(c).alias(c) for c in lens])


def _luhn(digits: Column) -> Column:
    doubled = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(
        i % 2 == 1, F.element_at(F.array(*[F.lit(v) for v in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), c.cast("int") + 1)).otherwise(c.cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10 == 0


def _parts_fit(m: Column) -> Column:
    def fits(p: Column) -> Column:
        x = F.regexp_replace(p, "^0+", "")
        return F.when(F.length(x) > 3, F.lit(False)).when(x == "", F.lit(True)).otherwise(x.try_cast("int") <= 255)
    return F.forall(F.split(m, r"\."), fits)


def _char_class(c: Column) -> Column:
    return (F.when(c.rlike(r"^\s?$"), 0).when(c.rlike(r"^\p{L}"), 1).when(c.rlike("^[0-9]"), 2).otherwise(3))


def _describe(c: Column) -> Column:
    """A candidate with its features, which are small integers."""
    m, start, kind, left = c["m"], c["start"], c["kind"], c["left"]
    digits = F.regexp_replace(m, "[^0-9]", "")
    n = F.length(digits)
    luhn = F.when((n >= 12) & (n <= 19), F.when(_luhn(digits), 1).otherwise(0)).otherwise(0)
    parts = F.when(kind == KINDS.index("ip"), F.when(_parts_fit(m), 1).otherwise(0)).otherwise(0)
    has = lambda s: F.when(F.contains(m, F.lit(s)), 1).otherwise(0)
    values = (
        kind,
        F.least(n, F.lit(20)),
        F.least(F.length(m), F.lit(40)),
        has(" ") + has("-") + has("."),
        F.when(F.startswith(m, F.lit("+")), 2).otherwise(0) + has("("),
        luhn, parts,
        _char_class(F.right(left, F.lit(1))),
        _char_class(c["right"]),
        F.when(left.rlike(_COUNTER_CUE), 2).when(left.rlike(_CUE), 1).otherwise(0))
    return F.struct(kind.alias("kind"), c["base"].alias("base"), start.alias("start"), c["end"].alias("end"),
                    *[v.cast("int").alias(f"f_{name}") for name, v in zip(FEATURES, values)])


def candidates(rows: DataFrame, keep: list[str]) -> DataFrame:
    """``keep, text, cands``: all candidates of each text (null: empty) in an
    array. Context is what stands between a match and its generator's last
    one, as far as ``CONTEXT`` characters: everything is cut from the pieces
    between matches, so a long text is walked once, not once per match."""
    text = F.coalesce(F.col("text"), F.lit(""))
    cols = []
    none_g, none_s = F.array().cast("array<struct<n:int,tail:string,head:string>>"), F.array().cast("array<string>")

    def gap(s: Column) -> Column:
        return F.struct(F.length(s).alias("n"), F.right(s, F.lit(CONTEXT)).alias("tail"), F.left(s, F.lit(1)).alias("head"))

    for j, (_, _, p, quick) in enumerate(_GENERATORS):
        maybe = F.col("text").rlike(quick)
        cols.append(F.when(maybe, F.transform(F.split(F.col("text"), p, -1), gap)).otherwise(none_g).alias(f"gap_{j}"))
        cols.append(F.when(maybe, F.regexp_extract_all(F.col("text"), F.lit(p), F.lit(0))).otherwise(none_s).alias(f"m_{j}"))
    d = rows.select(*keep, text.alias("text")).select(*keep, "text", *cols)
    n = len(_GENERATORS)
    # Text before a match plus the match itself; the sums are the ends.

    def advance(j: int) -> Column:
        return F.transform(f"m_{j}", lambda m, i: F.get(f"gap_{j}", i)["n"] + F.length(m))

    def place(j: int, kind: str, base: bool) -> Column:
        def of(m: Column, i: Column) -> Column:
            end = F.get(f"end_{j}", i)
            return F.struct(F.lit(KINDS.index(kind)).alias("kind"), F.lit(base).alias("base"),
                            (end - F.length(m)).alias("start"), end.alias("end"), m.alias("m"),
                            F.get(f"gap_{j}", i)["tail"].alias("left"), F.get(f"gap_{j}", i + F.lit(1))["head"].alias("right"))
        return F.transform(f"m_{j}", of)

    d = d.select(*keep, "text", *[f"{c}_{j}" for j in range(n) for c in ("m", "gap")], *[advance(j).alias(f"end_{j}") for j in range(n)])
    d = _starts([f"end_{j}" for j in range(n)], d)
    found = [place(j, kind, base) for j, (kind, base, _, _) in enumerate(_GENERATORS)]
    d = d.select(*keep, "text", F.concat(*found).alias("found"))
    d = d.select(*keep, "text", F.transform("found", _describe).alias("cands"))
    return d


def _passes(c: Column) -> Column:
    n = c["f_digits"]
    by_kind = (F.lit(True), c["f_parts"] == 1, (n >= 12) & (n <= 19) & (c["f_luhn"] == 1), (n >= 9) & (n <= 15))
    out = F.lit(False)
    for k, ok in enumerate(by_kind):
        out = F.when(c["kind"] == k, ok).otherwise(out)
    return c["base"] & out


@dataclass
class PiiModel:
    trees: BoostedTrees
    thresholds: tuple[float, ...]


def fit_model(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", precision: float = PRECISION) -> PiiModel:
    """Learns from the base matches of all documents. What reaches the driver
    is one row for each distinct feature vector; the features' few values bound
    their number whatever the corpus holds. Half of the documents, by id, are
    held out to calibrate the thresholds. A kind without held-out examples
    gets no threshold, so nothing is added for it."""
    fold = F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(2)).cast("int")
    c = candidates(docs.select(fold.alias("fold"), F.col(text_col).alias("text")), ["fold"])
    c = c.select("fold", F.explode(F.filter("cands", lambda x: x["base"])).alias("c"))
    names = [f"f_{n}" for n in FEATURES]
    cells = (c.select("fold", *[F.col("c")[n].alias(n) for n in names], _passes(F.col("c")).alias("passed"))
             .groupBy("fold", *names).agg(F.count_if("passed").alias("p"), F.count_if(~F.col("passed")).alias("n")).collect())
    part = {f: [(tuple(r[n] for n in names), r["p"], r["n"]) for r in cells if r["fold"] == f] for f in (0, 1)}
    trees = fit(part[0])
    limits = tuple(calibrate([(trees.margin(x), p, n) for x, p, n in part[1] if x[0] == k], precision) for k in range(len(KINDS)))
    return PiiModel(trees, limits)


def find_pii(docs: DataFrame, model: PiiModel, keep: list[str], *, text_col: str = "text") -> DataFrame:
    """``keep, text, spans`` of every row; ``spans`` is an array of ``start,
    kind, end, base`` by start, then kind. Null texts are empty, texts without
    candidates have an empty array."""
    d = candidates(docs.select(*keep, F.col(text_col).alias("text")), keep)
    names = [f"f_{n}" for n in FEATURES]

    def margin(c: Column) -> Column:
        return model.trees.column([c[n] for n in names])

    def limit(c: Column) -> Column:
        out = F.lit(math.inf)
        for k, t in enumerate(model.thresholds):
            out = F.when(c["kind"] == k, F.lit(float(t))).otherwise(out)
        return out

    span = lambda c, extra: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"), extra)
    kept = F.transform(F.filter("cands", _passes), lambda c: span(c, F.lit(0.0).alias("margin")))
    scored = F.transform(F.filter("cands", lambda c: ~c["base"] & (margin(c) >= limit(c) - 1e-6)),
                         lambda c: span(c, margin(c).alias("margin")))
    d = d.select(*keep, "text", kept.alias("kept"), scored.alias("more"))
    overlap = lambda a, b: (a["start"] < b["end"]) & (b["start"] < a["end"])
    better = lambda a, b: (b["margin"] > a["margin"]) | ((b["margin"] == a["margin"]) & (
        (b["start"] < a["start"]) | ((b["start"] == a["start"]) & (b["kind"] < a["kind"]))))
    free = F.filter("more", lambda a: ~F.exists("kept", lambda b: overlap(a, b)))
    d = d.select(*keep, "text", "kept", F.when(F.size("more") > 0, free).otherwise(F.col("more")).alias("free"))
    added = F.filter("free", lambda a: ~F.exists("free", lambda b: overlap(a, b) & better(a, b)))
    flag = lambda v: lambda c: F.struct(c["start"].alias("start"), c["kind"].alias("kind"), c["end"].alias("end"), F.lit(v).alias("base"))
    return d.select(*keep, "text", F.array_sort(F.concat(F.transform("kept", flag(True)), F.transform(added, flag(False)))).alias("spans"))


def _listed(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def pii_report(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", precision: float = PRECISION) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans`` of every
    row; counts and the digest are those of the base spans."""
    model = fit_model(docs, id_col=id_col, text_col=text_col, precision=precision)
    d = find_pii(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), model, ["doc_id"])
    d = d.select("doc_id", "spans", F.filter("spans", lambda s: s["base"]).alias("base"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return d.select("doc_id", *counts, F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", precision: float = PRECISION) -> DataFrame:
    """The rows with every span of ``text_col`` replaced by its kind in square
    brackets (overlapping spans by that of the first); other columns and the
    rows without spans stay as they are."""
    model = fit_model(docs, id_col=id_col, text_col=text_col, precision=precision)
    columns = docs.columns
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(text_col).alias("text"))
    d = find_pii(packed, model, ["row"])
    span = "array<struct<start:int,kind:int,end:int>>"

    def merge(acc: Column, s: Column) -> Column:
        last = F.element_at(acc, -1)
        s = F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
        joined = F.struct(last["start"].alias("start"), last["kind"].alias("kind"), F.greatest(last["end"], s["end"]).alias("end"))
        apart = F.when(F.size(acc) == 0, F.lit(True)).otherwise(last["end"] <= s["start"])
        return F.when(apart, F.concat(acc, F.array(s))).otherwise(F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(joined)))

    d = d.select("row", "text", F.when(F.size("spans") > 0, F.aggregate("spans", F.array().cast(span), merge)).alias("cuts"))
    # Blocks of the text, so that a piece is cut from the blocks it touches.
    blocks = F.regexp_extract_all(F.when(F.col("cuts").isNotNull(), F.col("text")), F.lit(f"(?s).{{1,{_TEXT_BLOCK}}}"), F.lit(0))
    d = d.select("row", "cuts", F.length("text").alias("n"), blocks.alias("blocks"))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def between(begin: Column, end: Column) -> Column:
        first = F.floor(begin / _TEXT_BLOCK).cast("int")
        last = F.floor((end - 1) / _TEXT_BLOCK).cast("int")
        joined = F.array_join(F.transform(F.sequence(first, last), lambda i: F.get("blocks", i)), "")
        return F.when(end > begin, F.substr(joined, begin - first * _TEXT_BLOCK + 1, end - begin)).otherwise(F.lit(""))

    def piece(s: Column, i: Column) -> Column:
        begin = F.when(i > 0, F.get("cuts", i - 1)["end"]).otherwise(F.lit(0))
        return F.concat(between(begin, s["start"]), F.element_at(names, s["kind"] + 1))

    tail = F.element_at("cuts", -1)["end"]
    clean = F.concat(F.array_join(F.transform("cuts", piece), ""), between(tail, F.col("n")))
    new = F.when(F.col("cuts").isNull(), F.col("row")[text_col]).otherwise(clean)
    return d.select(*[new.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in columns])
