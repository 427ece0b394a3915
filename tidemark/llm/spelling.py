"""Spelling variants by a frequency-vector trie.

A word's vector is its length and then how often letters of each group occur
in it. One inserted, deleted or replaced letter raises at most one of these
counts by one (the surplus) and lowers at most one other (the deficit). Words
are kept in a trie of successive counts; a search goes down it depth first and
spends at most one surplus and one deficit, and the words at the leaves it
reaches are verified letter by letter. A search only looks up, to larger
vectors, and tells both words of what it finds.

The top of the trie (every node with more than ``cap`` words) is a small set of
vector prefixes that all tasks know. The nodes right below it are the buckets:
a word lives in one bucket and searches all those it reaches, so a task holds
one bucket at a time. A leaf that is itself above ``cap`` cannot be split by
counts. Words that live in such a leaf or reach one also meet on keys of the
word with one place left out, where at most one word per letter meets.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .workers import send_code

MIN_LETTERS = 5
MIN_COUNT = 3
#: One run in so many loses a letter (see ``counted_words``).
ONE_IN = 97
#: Letter groups in the order of the trie's levels; letters of no group come last.
GROUPS = ("e", "a", "i", "n", "r", "s", "t", "o", "u", "dl", "cm", "gpbh", "fvwyjkqxz")
LEVELS = len(GROUPS) + 2
#: A bucket has at most so many words, or a 1 in MAX_BUCKETS share of all of
#: them if that is more: the nodes every task knows stay below
#: (LEVELS + 1) * MAX_BUCKETS.
CAP = 4096
MAX_BUCKETS = 8192
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LEAF = 6
_FLUSH = 20_000
_PRIME, _BASE = (1 << 61) - 1, 1_000_003


def counted_words(docs: DataFrame, *, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT, one_in: int = ONE_IN,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n``: maximal runs of letters of all whole texts, A-Z lower-cased,
    with at least ``min_letters`` letters and ``min_count`` occurrences.

    A run whose ``crc32("<id>:<run>")`` is a multiple of ``one_in`` loses the
    letter at that number modulo its length, which plants misspellings. A null
    id counts as an empty text, a null text has no runs.
    """
    run = F.col("run")
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(
        F.translate(F.col(text_col), _UPPER, _LOWER), F.lit("[a-zÀ-ÿ]{%d,}" % min_letters), 0)).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), run).cast("binary"))
    at = F.pmod(F.col("h"), F.length(run)).cast("int")
    word = F.when(F.pmod(F.col("h"), F.lit(one_in)) == 0, F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))).otherwise(run)
    return (runs.select("run", h.alias("h")).select(word.alias("word")).where(F.length("word") >= min_letters)
            .groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count))


def vector(word: str) -> bytes:
    """Counts along the trie's levels. Counts stop at 255; that can only bring
    words closer, and words that meet are verified."""
    count = word.count
    c = [sum(map(count, g)) if len(g) > 1 else count(g) for g in GROUPS]
    return bytes([min(x, 255) for x in (len(word), *c, len(word) - sum(c))])


def is_near(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced letter makes ``a`` into ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    for x, y in zip(a, b):
        if x != y:
            break
        i += 1
    if len(a) == len(b):
        return i < len(a) and a[i + 1:] == b[i + 1:]
    return a[i:] == b[i + 1:]


#: What a search can still spend, going from a word up to words whose vector is
#: larger in order (or equal): of two near words just one finds the other.
#: 0 start, 1 same length, 2 same length with a deficit due, 3 one letter more,
#: 4 all spent. Keys are (state, difference of the counts).
_SPEND = {(0, 0): 1, (0, 1): 3, (1, 0): 1, (1, 1): 2, (2, 0): 2, (2, -1): 4, (3, 0): 3, (3, 1): 4, (4, 0): 4}
_STEPS = {state: [(step, to) for (of, step), to in _SPEND.items() if of == state] for state in range(5)}


def reached(v: bytes, crowded: frozenset | set) -> list[bytes]:
    """Buckets that a word with this vector finds near words in."""
    out, stack = [], [(b"", 0)]
    while stack:
        node, state = stack.pop()
        if node not in crowded:
            out.append(node)
        elif (level := len(node)) < LEVELS:
            for step, to in _STEPS[state]:
                if 0 <= (c := v[level] + step) <= 255:
                    stack.append((node + bytes((c,)), to))
    return out


def meets_crowd(v: bytes, crowded: frozenset | set) -> bool:
    """Whether a crowded leaf is at most one surplus and one deficit away, in
    any order."""
    stack = [(b"", 1, 1)]
    while stack:
        node, surplus, deficit = stack.pop()
        if node not in crowded:
            continue
        if len(node) == LEVELS:
            return True
        c = v[len(node)]
        # The first level is the length, which is no letter of its own.
        cost = 1 if node else 0
        stack.append((node + bytes((c,)), surplus, deficit))
        if surplus and c < 255:
            stack.append((node + bytes((c + 1,)), surplus - cost, deficit))
        if deficit and c:
            stack.append((node + bytes((c - 1,)), surplus, deficit - cost))
    return False


def gap_keys(word: str) -> tuple[list[bytes], set[bytes]]:
    """Keys on which words meet that are equal but for one place: those of the
    same length (place and the rest), and those with one letter more."""
    m = len(word)
    head, power = [0], [1]
    for ch in word:
        head.append((head[-1] * _BASE + ord(ch) + 1) % _PRIME)
        power.append(power[-1] * _BASE % _PRIME)
    whole = head[m]
    rest = [(head[p] * power[m - 1 - p] + whole - head[p + 1] * power[m - 1 - p]) % _PRIME for p in range(m)]
    same = [b"S%d:%d:%d" % (m, p, r) for p, r in enumerate(rest)]
    return same, {b"I%d:%d" % (m - 1, r) for r in rest} | {b"I%d:%d" % (m, whole)}


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([vector(w) for w in b.column(0).to_pylist()], pa.binary())],
                                         names=["word", "n", "v"])


_ROUTED = "bucket binary, asks boolean, word string, n long, v binary, packed boolean"


def _router(crowded):
    """Rows for the buckets: one where a word lives, one for each it asks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = crowded.value
        leaves = any(len(x) == LEVELS for x in known)
        for b in batches:
            rows: list[tuple] = []
            routes: dict[bytes, tuple] = {}
            for w, n, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                packed = v in known
                if not packed:
                    if (route := routes.get(v)) is None:
                        home = next(v[:d] for d in range(LEVELS + 1) if v[:d] not in known)
                        route = routes[v] = (b"T" + home, [b"T" + x for x in reached(v, known)])
                    rows.append((route[0], False, w, n, v, False))
                    rows += [(x, True, w, n, v, False) for x in route[1]]
                if leaves and (packed or meets_crowd(v, known)):
                    same, other = gap_keys(w)
                    rows += [(k, True, w, n, v, packed) for k in (*same, *other)]
                if len(rows) >= _FLUSH:
                    yield _batch(rows)
                    rows = []
            if rows:
                yield _batch(rows)
    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.binary(), pa.bool_(), pa.string(), pa.int64(), pa.binary(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                      names=["bucket", "asks", "word", "n", "v", "packed"])


class Leaf:
    """Words of one leaf. Two near words share all letters before or all
    letters after the shorter one's middle, so a larger leaf is looked up by
    both halves."""

    def __init__(self, words: list[tuple[str, int, bytes]]):
        self.words, self.before, self.after = words, None, None
        if len(words) > _LEAF:
            self.before, self.after = {}, {}
            for x in words:
                w = x[0]
                # As seen by a word of its own length, and by one with a letter less.
                for cut in {len(w) // 2, (len(w) - 1) // 2}:
                    self.before.setdefault(w[:cut], []).append(x)
                for rest in {w[len(w) // 2:], w[(len(w) - 1) // 2 + 1:]}:
                    self.after.setdefault(rest, []).append(x)

    def candidates(self, w: str):
        if self.before is None:
            return self.words
        half = len(w) // 2
        first, last = self.before.get(w[:half], ()), self.after.get(w[half:], ())
        return {*first, *last} if first and last else first or last


def build_trie(words: list[tuple[str, int, bytes]], level: int):
    """Nested tables from counts to what lies below; few words, or words of
    one vector, are a leaf."""
    if len(words) <= _LEAF or level == LEVELS:
        return Leaf(words)
    below: dict = {}
    for w in words:
        below.setdefault(w[2][level], []).append(w)
    return {c: build_trie(ws, level + 1) for c, ws in below.items()}


def search_trie(trie, v: bytes, prefix: bytes) -> list[Leaf]:
    """Leaves below ``prefix`` that a word with this vector reaches."""
    state = 0
    for c, mine in zip(prefix, v):
        state = _SPEND.get((state, c - mine))
        if state is None:
            return []
    out, stack = [], [(trie, len(prefix), state)]
    while stack:
        node, level, state = stack.pop()
        if type(node) is Leaf:
            out.append(node)
            continue
        c = v[level]
        for step, to in _STEPS[state]:
            if (child := node.get(c + step)) is not None:
                stack.append((child, level + 1, to))
    return out


def _rows(batches: Iterator[pa.RecordBatch]):
    for b in batches:
        yield from zip(*(b.column(i).to_pylist() for i in range(6)))


def _answers(bucket: bytes, members) -> Iterator[tuple[str, int, int, str]]:
    """``word, near words, largest n of them, first word with it`` of one bucket."""
    if bucket[:1] != b"T":
        # Same-length keys pair all their words (one a letter), the others only
        # words with the gap and the one word without it.
        by_length: dict[int, list] = {}
        for _, _, w, n, _, packed in members:
            by_length.setdefault(len(w), []).append((w, n, packed))
        step = 0 if bucket[:1] == b"S" else 1
        for w, _, mine in (x for group in by_length.values() for x in group):
            met = [x for k in {len(w) - step, len(w) + step} for x in by_length.get(k, ())]
            near = [(-n, x) for x, n, other in met if (mine or other) and is_near(w, x)]
            if near:
                n, x = min(near)
                yield w, len(near), -n, x
        return
    words, trie, asked, found = [], None, None, []
    here: dict[str, list] = {}
    for _, asks, w, n, v, _ in members:  # the words that live here come first
        if not asks:
            words.append((w, n, v))
            continue
        if not words:
            return
        if trie is None:
            trie = build_trie(words, len(bucket) - 1)
        if v != asked:
            asked, found = v, search_trie(trie, v, bucket[1:])
        near = [x for leaf in found for x in leaf.candidates(w) if is_near(w, x[0]) and (x[2], x[0]) > (v, w)]
        if near:
            best, x = min((-x[1], x[0]) for x in near)
            yield w, len(near), -best, x
            for x, *_ in near:
                if (mine := here.get(x)) is None:
                    here[x] = [1, (-n, w)]
                else:
                    mine[0] += 1
                    mine[1] = min(mine[1], (-n, w))
    for w, (n_near, (minus, x)) in here.items():
        yield w, n_near, -minus, x


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    for bucket, members in groupby(_rows(batches), key=lambda r: r[0]):
        for answer in _answers(bucket, members):
            out.append(answer)
            if len(out) >= _FLUSH:
                yield _answer_batch(out)
                out = []
    if out:
        yield _answer_batch(out)


def _answer_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                      names=["word", "n_near", "best_n", "best"])


def near_words(spark: SparkSession, words: DataFrame, base: str, *, cap: int = CAP) -> DataFrame:
    """``word, n_near, best_n, best`` of every row of ``word, n`` (distinct
    words) that has near words; ``best`` is the one of largest n, of equal ones
    the first in code-point order. Writes its steps below ``base``."""
    words.select("word", "n").mapInArrow(_vectors, "word string, n long, v binary").write.parquet(f"{base}/words")
    words = spark.read.schema("word string, n long, v binary").parquet(f"{base}/words")
    most = max(cap, -(-words.count() // MAX_BUCKETS))
    crowded = (words.groupBy("v").agg(F.count("*").alias("n"))
               .select("n", F.explode(F.transform(F.sequence(F.lit(0), F.lit(LEVELS)), lambda i: F.substr("v", F.lit(1), i))).alias("node"))
               .groupBy("node").agg(F.sum("n").alias("n")).where(F.col("n") > most).select("node"))
    known = spark.sparkContext.broadcast(frozenset(bytes(r.node) for r in crowded.collect()))
    found = (words.mapInArrow(_router(known), _ROUTED).repartition("bucket")
             .sortWithinPartitions("bucket", "asks", "v").mapInArrow(_search, "word string, n_near long, best_n long, best string"))
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), F.col("best").alias("word")))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b"))
            .select("word", "n_near", (-F.col("b.minus")).alias("best_n"), F.col("b.word").alias("best")))


def _roots(spark: SparkSession, forms: DataFrame, base: str) -> DataFrame:
    """``word, root`` of every row of ``word, form``: follows forms to the end,
    twice as far in every round. A form's n is at least twice as large, so
    there are no circles and about log(log(n)) rounds."""
    forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")).write.parquet(f"{base}/root-0")
    k = 0
    while True:
        at = spark.read.schema("word string, root string, moved boolean").parquet(f"{base}/root-{k}")
        if k and at.where("moved").limit(1).count() == 0:
            return at.select("word", "root")
        further = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        k += 1
        (at.select("word", "root").join(further, "root", "left")
         .select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
         .write.parquet(f"{base}/root-{k}"))


def spelling_variants(spark: SparkSession, docs: DataFrame, *, min_letters: int = MIN_LETTERS, min_count: int = MIN_COUNT,
                      one_in: int = ONE_IN, times: int = 2, cap: int = CAP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``counted_words``.

    Near words differ by exactly one inserted, deleted or replaced code point;
    ``form`` is the near word of largest n (of equal ones the first in
    code-point order) if that is at least ``times`` the word's own n, else
    null. ``root`` follows forms from the word to the last. Null, empty and
    very long texts, very long words, repeated rows and ids, and other columns
    of any name are fine; an empty table, or one without words, gives no rows.
    """
    if times < 2:
        raise ValueError("a form must be at least twice as frequent, or forms could go in circles")
    send_code(spark)
    base = scratch_dir(spark, "spelling")
    counted_words(docs, min_letters=min_letters, min_count=min_count, one_in=one_in, id_col=id_col, text_col=text_col
                  ).write.parquet(f"{base}/counts")
    words = spark.read.schema("word string, n long").parquet(f"{base}/counts")
    near = near_words(spark, words, base, cap=cap)
    ok = F.col("best_n") >= F.col("n") * times
    (words.join(near, "word", "left")
     .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
             F.when(ok, F.col("best")).alias("form"), F.when(ok, F.col("best_n")).alias("form_n")).write.parquet(f"{base}/forms"))
    forms = spark.read.schema("word string, n long, n_near long, form string, form_n long").parquet(f"{base}/forms")
    roots = _roots(spark, forms.where("form is not null"), base)
    return (forms.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
