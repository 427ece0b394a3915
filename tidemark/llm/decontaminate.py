"""Benchmark decontamination by winnowing, with built-in functions only.

Fingerprints: hashes of all runs of K words; of every W consecutive ones the
smallest is kept (the rightmost of equal ones). Any shared run of K + W - 1
words holds one whole such window on both sides, so both keep the same
fingerprint from it. Documents and benchmark items are joined on fingerprints
and each hit is extended word by word to both sides; runs of at least
K + W - 1 words are shared windows.

A fingerprint is one long: 36 bits of hash above the 28-bit place of its run,
counted backwards, so that the smallest long is the rightmost smallest hash.
Equal fingerprints of different runs only cost an extension that fails.

Items with fewer words than a window are one window of their own; they are
looked up among all runs of their length, in the same pass over the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

K = 5
WINDOW = 10
_PLACE_BITS = 28
_PLACE = (1 << _PLACE_BITS) - 1
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def word_hashes(text: Column) -> Column:
    """One hash per word of a text; none for null."""
    words = F.regexp_extract_all(F.coalesce(ascii_lower(text), F.lit("")), F.lit(_WORD), F.lit(0))
    return F.transform(words, lambda w: F.xxhash64(w))


def count_words(text: Column) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_WORD_ANY_CASE), F.lit(0))).cast("long")


def _run_hash(h: Column, i: Column, n: int) -> Column:
    return F.xxhash64(*[F.get(h, i + F.lit(j)) for j in range(n)])


def _no_longs() -> Column:
    return F.array().cast("array<bigint>")


def fingerprints(rows: DataFrame, keys: list[str], *, k: int = K, window: int = WINDOW,
                 lengths: list[int] | None = None, whole: bool = False) -> DataFrame:
    """Selected fingerprints of rows of ``keys, h`` (word hashes): ``keys, n``
    (0), ``fp, place``, and the words around: ``before`` (up to window - k words
    that end before the run) and ``after`` (up to ``window`` words from its
    start). Runs of each length in ``lengths`` follow (``whole``: only those
    that are the whole text), with ``n`` their length.

    A text of more words than places can number is an error.
    """
    w = window - k + 1
    tagged = F.transform(
        F.sequence(F.lit(0), F.size("h") - F.lit(k)),
        lambda i: _run_hash(F.col("h"), i, k).bitwiseAND(F.lit(~_PLACE)).bitwiseOR(F.lit(_PLACE) - i.cast("long")))
    too_long = F.raise_error(F.lit(f"a text has more than {_PLACE} words")).cast("array<bigint>")
    v = F.when(F.size("h") > _PLACE, too_long).when(F.size("h") >= window, tagged).otherwise(_no_longs())
    runs = rows.select(*keys, "h", v.alias("v"))
    smallest = F.transform(F.sequence(F.lit(0), F.size("v") - F.lit(w)),
                           lambda i: F.least(*[F.get(F.col("v"), i + F.lit(j)) for j in range(w)]))
    kept = runs.select(*keys, "h", F.when(F.size("v") >= w, F.array_distinct(smallest)).otherwise(_no_longs()).alias("m"))

    def described(x: Column) -> Column:
        place = (F.lit(_PLACE) - x.bitwiseAND(F.lit(_PLACE))).cast("int")
        side = F.least(place, F.lit(window - k))
        return F.struct(F.lit(0).alias("n"), F.shiftright(x, _PLACE_BITS).alias("fp"), place.alias("place"),
                        F.slice("h", place - side + F.lit(1), side).alias("before"),
                        F.slice("h", place + F.lit(1), F.lit(window)).alias("after"))

    found = F.transform("m", described)
    return kept.select(*keys, F.inline(F.concat(found, _short(lengths, whole)) if lengths else found))


def _equal_prefix(same: list[Column]) -> Column:
    """How many of the conditions hold, up to the first that does not."""
    out = F.lit(len(same))
    for i in range(len(same) - 1, -1, -1):
        out = F.when(F.coalesce(same[i], F.lit(False)), out).otherwise(F.lit(i))
    return out


def _short(lengths: list[int], whole: bool) -> Column:
    """Runs of the given lengths as an array of ``n, fp, place, before,
    after``: all runs of a text, or the one that is the whole text."""
    def runs(n: int) -> Column:
        at = lambda i: F.struct(F.lit(n).alias("n"), _run_hash(F.col("h"), i, n).alias("fp"), i.cast("int").alias("place"),
                                _no_longs().alias("before"), _no_longs().alias("after"))
        if whole:
            return F.when(F.size("h") == n, F.array(at(F.lit(0))))
        return F.when(F.size("h") >= n, F.transform(F.sequence(F.lit(0), F.size("h") - F.lit(n)), at))

    none = F.array().cast("array<struct<n:int,fp:bigint,place:int,before:array<bigint>,after:array<bigint>>>")
    return F.concat(none, *[F.coalesce(runs(n), none) for n in lengths])


def shared_runs(docs: DataFrame, items: DataFrame, keys: list[str], *, k: int = K, window: int = WINDOW,
                lengths: list[int] | None = None) -> DataFrame:
    """``keys, first, last, item_id``: runs of at least ``window`` words of a
    document (words first to last - 1) that the item has as well. Together
    they cover every word inside an occurrence of an item's window. Items of
    fewer words, whose ``lengths`` are given, are looked up whole among all
    runs of their length, in the same pass and join (``n`` is the length, 0 for
    a fingerprint).

    An item's fingerprints with equal words around them are joined once: the
    join says how far a document's words agree, wherever the item has them. So
    a text that repeats few words many times meets few rows of such an item.
    """
    lengths = lengths or []
    side = window - k
    d = fingerprints(docs, keys, k=k, window=window, lengths=lengths)
    i = fingerprints(items, ["item_id"], k=k, window=window, lengths=lengths, whole=True).select(
        "item_id", "n", "fp", F.col("before").alias("item_before"), F.col("after").alias("item_after")).distinct()
    left = _equal_prefix([F.get("before", F.size("before") - F.lit(j + 1)) ==
                          F.get("item_before", F.size("item_before") - F.lit(j + 1)) for j in range(side)])
    right = _equal_prefix([F.get("after", F.lit(j)) == F.get("item_after", F.lit(j)) for j in range(window)])
    return (d.join(i, ["fp", "n"]).select(*keys, "item_id", "n", "place", left.alias("l"), right.alias("r"))
            .where((F.col("n") > 0) | ((F.col("l") + F.col("r") >= window) & (F.col("r") >= k)))
            .select(*keys, (F.col("place") - F.col("l")).alias("first"),
                    (F.col("place") + F.when(F.col("n") > 0, F.col("n")).otherwise(F.col("r"))).alias("last"), "item_id"))


def find_contamination(docs: DataFrame, benchmark: DataFrame, *, k: int = K, window: int = WINDOW,
                       id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                       item_text_col: str = "text") -> DataFrame:
    """``doc_id, version, n_words, n_hit, n_items, items_sha256,
    contaminated`` of every document row; ``version`` is a hash of the text.

    Null and empty texts have no words and no hits; an item without words
    occurs nowhere, an item without an id is not counted or listed. Rows that
    repeat an id are judged each by its own text. An empty benchmark leaves
    every document clean, an empty table gives no rows. Long texts are read
    whole; other columns, whatever their names, are not looked at.
    """
    d = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("version"), F.col(text_col).alias("text"))
    items = benchmark.select(F.col(item_col).alias("item_id"), word_hashes(F.col(item_text_col)).alias("h"))
    hashed = d.select("doc_id", "version", word_hashes(F.col("text")).alias("h"))
    keys = ["doc_id", "version"]
    sizes = items.select(F.size("h").alias("n")).where(F.col("n").between(1, window - 1)).distinct().collect()
    runs = shared_runs(hashed, items, keys, k=k, window=window, lengths=sorted(r.n for r in sizes))
    # Hits are few; items of a run are gathered first, then runs of a document.
    per_run = runs.groupBy(*keys, "first", "last").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
    spans = F.array_sort(F.collect_list(F.struct("first", "last")))
    zero = F.struct(F.lit(0).alias("at"), F.lit(0).cast("long").alias("n"))

    def cover(acc: Column, s: Column) -> Column:
        fresh = F.greatest(s["last"] - F.greatest(s["first"], acc["at"]), F.lit(0))
        return F.struct(F.greatest(acc["at"], s["last"]).alias("at"), (acc["n"] + fresh).alias("n"))

    hits = per_run.groupBy(*keys).agg(
        spans.alias("spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"))
    hits = hits.select(F.col("doc_id").alias("hit_id"), F.col("version").alias("hit_version"),
                       F.aggregate("spans", zero, cover)["n"].alias("n_hit"), F.array_sort("items").alias("items"))
    rows = d.select("doc_id", "version", count_words(F.col("text")).alias("n_words"))
    out = rows.join(hits, rows["doc_id"].eqNullSafe(hits["hit_id"]) & (rows["version"] == hits["hit_version"]), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return out.select("doc_id", "version", "n_words", n_hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"),
                      F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                      **settings) -> DataFrame:
    """The rows of ``docs`` without a shared window, all columns as they are."""
    found = find_contamination(docs, benchmark, id_col=id_col, text_col=text_col, **settings).where("contaminated")
    found = found.select(F.col("doc_id").alias("__hit_id"), F.col("version").alias("__hit_version")).distinct()
    same = docs[id_col].eqNullSafe(found["__hit_id"]) & (F.xxhash64(docs[text_col]) == found["__hit_version"])
    return docs.join(found, same, "left_anti")
