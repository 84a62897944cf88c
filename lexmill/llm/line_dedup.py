"""Line dedup: an exact set-similarity join of lines, after which later matches go.

A line's set is its distinct words in lower case. Two lines match if their sets' Jaccard similarity is at
least THRESHOLD. Each word is hashed once; the sets are written, and lines of equal sets are one class (node) from
there on. Tokens are ordered by rarity: by the count of their bucket (2^18 buckets, counted over all lines), then by
hash, which is one order for all lines, as prefix filters need. A line's prefix are its first n - ceil(t n) + 1 tokens;
matching sets share one. Sets of under four tokens match equal sets only.

Groups of near copies cost what their lines do, not their pairs. First, stars: under the least and the greatest hash of
its set, each node is compared with the earliest node there. A node's home is the earliest star it was verified with, at
the distance d (tokens in one set only). For x and y of one home the triangle inequality gives distance(x, y) <= d_x + d_y,
and similarity of at least 4/5 is distance <= (n_x + n_y) / 9: so where 9 d - n of both add up to 0 or less, they match
without a look at their sets, and such pairs are counted from a histogram of each home. Second, the prefix join with
length and positional filters, for what the stars leave open: pairs of two homes, or of one home and a greater sum;
or, if matches need not be counted, later lines that no star has removed. A set meets others in bands of sizes, and the
smaller of two by the first n / 9 + 1 tokens only. The join compares parities of the sets (64 bits; 128 and 256 for sets of
over LONG and HUGE tokens, which fill 64 and 128), which bound their distance from below; then the whole sets decide.

A line goes if a line of an equal or matching set stands earlier in (doc_id, line number) order. Words are told apart by
64-bit hashes, sets by a 64-bit hash of those.

Defined results: lines without words stay, and match nothing; a null text has no lines; null ids come last; an empty
table gives an empty one; other columns pass through dedup whatever their names. In judge_lines (op10) rows that share a
doc_id are ordered as lines of one document, and of rows repeated whole each line is one place, which stays. In dedup each
row is a document of its own, named by doc_id and its text's hash and ordered by them, so what is removed from a row was
found in it; of rows that share both, one is read and the others lose all their lines.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmill.llm.common import ASCII_SPACE, discarding, free, materialise, single, table

THRESHOLD = 0.8
BUCKETS = 1 << 18
_NUM, _DEN = 4, 5  # THRESHOLD as a fraction: filters in whole numbers
#: Parities have one word of 64 bits, two for sets of over LONG tokens, four for sets of over HUGE.
LONG, HUGE = 64, 192
WIDE = ["w1", "w2", "w3"]
#: Sets of fewer tokens match equal sets only.
SHORT = 4
#: The prefix join takes its keys in so many parts (a power of two), one after the other: only a part of its rows is on disk at once.
PASSES = 4
#: Bands of sizes are so wide (as a logarithm): two steps of the greatest ratio of matching sizes.
BAND = -2 * math.log(THRESHOLD)
#: Up to so many nodes (24 MB) are broadcast to a join; more are joined by shuffle.
BROADCAST_NODES = 1_000_000


def tokens(line: Column, odd: Column) -> Column:
    """array<long>: hashes of the line's distinct words in lower case. odd: it may have white space other than blanks."""
    low = even = F.lower(line)
    for c in ASCII_SPACE[1:]:
        even = F.replace(even, F.lit(c), F.lit(" "))
    parts = F.split(F.when(odd, even).otherwise(low), " ")
    return F.array_remove(F.array_distinct(F.transform(parts, lambda w: F.xxhash64(w))), F.xxhash64(F.lit("")))


def lines(docs: DataFrame, doc_id: str, text: str, by_row: bool) -> DataFrame:
    """doc (the id), text_key (the text's hash; 0 without by_row), line (from 0), sig, n, toks for the lines with a word."""
    said, key = F.coalesce(F.col(text), F.lit("")), F.xxhash64(text) if by_row else F.lit(0).cast("long")
    odd = functools.reduce(Column.__or__, (F.contains(said, F.lit(c)) for c in ASCII_SPACE[1:] if c != "\n"))
    # in a projection of their own, once a text: beside the explode they would be made for each line
    out = docs.select(F.col(doc_id).alias("doc"), key.alias("text_key"), odd.alias("odd"), F.split(said, "\n").alias("all"))
    out = out.select("doc", "text_key", "odd", F.posexplode("all").alias("line", "said"))
    # told by the line itself: a condition on the tokens would be pushed below them, and make them twice
    out = out.where(F.btrim("said", F.lit(ASCII_SPACE)) != "").select("doc", "text_key", "line", tokens(F.col("said"), F.col("odd")).alias("toks"))
    return out.select("doc", "text_key", "line", F.xxhash64(F.sort_array("toks")).alias("sig"), F.size("toks").alias("n"), "toks")


def rarity(found: DataFrame) -> Column:
    """array<tinyint>, as a literal: for each bucket of words 1 to 127, four to each doubling of the lines that have it. Its
    size is fixed. The driver gets it as one string, not as a row for each bucket."""
    spark = found.sparkSession
    # a task has up to BUCKETS rows whatever it reads: few tasks for each core
    few = found.select("toks").coalesce(2 * spark.sparkContext.defaultParallelism)
    buckets = few.select(F.explode("toks").alias("w")).select(F.col("w").bitwiseAND(F.lit(BUCKETS - 1)).cast("int").alias("b"))
    every = spark.range(0, BUCKETS, 1, 1).select(F.col("id").cast("int").alias("b"))
    counts = buckets.unionByName(every).groupBy("b").agg((F.count("*") - 1).alias("n"))
    ranks = counts.select("b", F.when(F.col("n") == 0, 1).otherwise(F.least(F.lit(127), 1 + F.floor(4 * F.log2(1 + F.col("n"))))).cast("int").alias("r"))
    one = ranks.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("b", "r"))), lambda x: x["r"].cast("string")), ",").alias("ranks"))
    return F.split(F.lit(one.first()["ranks"]), ",").cast("array<tinyint>")


def _ordered(toks: Column, ranks: Column) -> Column:
    """Rank and hash in one number, ascending from the rarest."""
    rank = lambda h: F.coalesce(F.get(ranks, h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")), F.lit(0).cast("tinyint")).cast("long")
    # never null, which sorts as plain numbers
    return F.sort_array(F.transform(toks, lambda h: F.shiftleft(rank(h), 56).bitwiseOR(F.shiftrightunsigned(h, 8))))


def _prefix(n: Column) -> Column:
    return F.least(n, n - F.ceil(n * _NUM / F.lit(_DEN)) + 1).cast("int")


def _bit(tok: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), tok.bitwiseAND(F.lit(63)).cast("int"))


def _bits(toks: Column) -> Column:
    """The parity of the tokens that fall on each of 64 bits: two sets' parities differ in no more bits than the sets do in tokens."""
    return F.aggregate(toks, F.lit(0).cast("long"), lambda s, t: s.bitwiseXOR(_bit(t)))


def _wide(toks: Column, n: Column) -> list[Column]:
    """The tokens' further bits: of two words the second, of four all but the first (which follows from _bits and these); 0 for
    sets that don't need them. Two of the four words, w1 and w3, add up to the second of two."""

    def word(mask: int, k: int) -> Column:
        return _bits(F.filter(toks, lambda t: t.bitwiseAND(F.lit(mask << 6)) == k << 6))

    none = F.lit(0).cast("long")
    return [F.when(n > HUGE, word(3, 1)).when(n > LONG, word(1, 1)).otherwise(none), *(F.when(n > HUGE, word(3, k)).otherwise(none) for k in (2, 3))]


def _apart(x: str, y: str) -> Column:
    """A lower bound of the distance of two sets, by their parities."""
    whole, w1, w2, w3 = (F.col(f"{c}{x}").bitwiseXOR(F.col(f"{c}{y}")) for c in ("bits", *WIDE))
    odd = w1.bitwiseXOR(w3)
    two = F.bit_count(odd) + F.bit_count(whole.bitwiseXOR(odd))
    four = F.bit_count(w1) + F.bit_count(w2) + F.bit_count(w3) + F.bit_count(whole.bitwiseXOR(odd).bitwiseXOR(w2))
    over = lambda size: (F.col(f"n{x}") > size) & (F.col(f"n{y}") > size)
    return F.when(over(HUGE), four).when(over(LONG), two).otherwise(F.bit_count(whole))


def _within(d: Column, na: Column, nb: Column) -> Column:
    """d <= _limit(na, nb), in whole numbers."""
    return d * (_NUM + _DEN) <= (na + nb) * (_DEN - _NUM)


def _limit(na: Column, nb: Column) -> Column:
    """The greatest distance at which sets of these sizes match."""
    return F.floor((na + nb) * (_DEN - _NUM) / F.lit(_NUM + _DEN))


def _place(x: str = "") -> Column:
    return F.struct(F.col(f"doc{x}").isNull().alias("last"), F.col(f"doc{x}").alias("doc"), F.col(f"text_key{x}").alias("text_key"), F.col(f"line{x}").alias("line"))


def _held(small: DataFrame) -> DataFrame:
    return F.broadcast(small) if small.count() <= BROADCAST_NODES else small


def nodes(found: DataFrame, ranks: Column) -> DataFrame:
    """A row for each set: sig, its earliest line (doc, text_key, line), copies, n, parities, lo and hi (least and greatest hash), prefix."""
    n, order = F.col("n"), _ordered(F.col("toks"), ranks)
    prefix = F.when(n >= SHORT, F.slice(order, F.lit(1), _prefix(n)))
    wide = [w.alias(name) for name, w in zip(WIDE, _wide(F.col("toks"), n), strict=True)]
    each = found.select("sig", _place().alias("place"), "n", _bits(F.col("toks")).alias("bits"), *wide, F.array_min("toks").alias("lo"), F.array_max("toks").alias("hi"), prefix.alias("prefix"))
    # lines that a task meets again are dropped before the shuffle by the partial aggregate
    out = each.groupBy("sig").agg(F.min("place").alias("place"), F.count("*").alias("copies"), *(F.first(c).alias(c) for c in ("n", "bits", *WIDE, "lo", "hi", "prefix")))
    return out.select("sig", "place.doc", "place.text_key", "place.line", "copies", "n", "bits", *WIDE, "lo", "hi", "prefix")


def verify(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Of pairs of distinct sets, those that match: a, b (a the earlier), n_b, d (the tokens that only one has)."""
    named = pairs.select(F.col("a").alias("sig")).unionByName(pairs.select(F.col("b").alias("sig"))).distinct()
    one = found.select("sig", "n", "toks", _place().alias("place")).join(_held(materialise(named, "line-named")), "sig", "left_semi")
    one = one.groupBy("sig").agg(F.first("n").alias("n"), F.first("toks").alias("toks"), F.min("place").alias("place"))
    sets = materialise(one, "line-sets")
    side = lambda x: sets.select(F.col("sig").alias(x), F.col("n").alias(f"n_{x}"), F.col("toks").alias(f"toks_{x}"), F.col("place").alias(f"place_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    far = F.col("n_a") + F.col("n_b") - 2 * F.size(F.array_intersect("toks_a", "toks_b"))
    told = both.select("a", "b", "n_a", "n_b", (F.col("place_a") < F.col("place_b")).alias("ahead"), far.alias("d")).where(_within(F.col("d"), F.col("n_a"), F.col("n_b")))
    pick = lambda x, y: F.when(F.col("ahead"), F.col(x)).otherwise(F.col(y))
    return told.select(pick("a", "b").alias("a"), pick("b", "a").alias("b"), pick("n_b", "n_a").alias("n_b"), "d")


def stars(own: DataFrame, found: DataFrame) -> DataFrame:
    """a, b, n_b, d, doc, text_key, line (a's): b matches a, the earliest node under one of its two keys."""
    keyed = own.where(F.col("n") >= SHORT).select("sig", "n", "bits", *WIDE, _place().alias("place"), F.explode(F.array("lo", F.bitwise_not("hi"))).alias("key"))
    first = keyed.groupBy("key").agg(F.min(F.struct("place", "sig", "n", "bits", *WIDE)).alias("c"), F.count("*").alias("met")).where("met > 1")
    first = first.select("key", F.col("c.sig").alias("a"), *(F.col(f"c.{x}").alias(f"{x}_a") for x in ("place", "n", "bits", *WIDE)))
    met = keyed.join(first, "key").where((F.col("sig") != F.col("a")) & (_apart("", "_a") <= _limit(F.col("n"), F.col("n_a"))))
    pairs = materialise(met.groupBy("a", F.col("sig").alias("b")).agg(F.first("place_a").alias("p")), "line-stars")
    good = verify(pairs.select("a", "b"), found)
    return materialise(good.join(pairs, ["a", "b"]).select("a", "b", "n_b", "d", "p.doc", "p.text_key", "p.line"), "line-near")


def homes(near: DataFrame) -> DataFrame:
    """sig, home, g: each node of a verified star with the earliest it was verified with; g = 9 d - n."""
    best = near.groupBy(F.col("b").alias("sig")).agg(F.min(F.struct(_place().alias("place"), F.col("a").alias("home"), "d", "n_b")).alias("s"))
    return best.select("sig", "s.home", ((_NUM + _DEN) * F.col("s.d") - F.col("s.n_b")).alias("g"))


def sure(members: DataFrame) -> DataFrame:
    """sig, n: how many others of its home each member matches by the triangle inequality alone."""
    cells = members.groupBy("home", "g").agg(F.count("*").alias("many"))
    asked = cells.select("home", F.col("g").alias("g"), (-F.col("g")).alias("spot"), F.lit(1).alias("ask"), F.lit(0).cast("long").alias("many"))
    points = cells.select("home", "g", F.col("g").alias("spot"), F.lit(0).alias("ask"), "many")
    # a home has as many cells as values of g: few hundred, whatever its members
    upto = Window.partitionBy("home").orderBy("spot", "ask").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    told = asked.unionByName(points).withColumn("upto", F.sum("many").over(upto)).where("ask = 1")
    told = told.select("home", "g", (F.col("upto") - F.when(F.col("g") <= 0, 1).otherwise(0)).alias("sure")).where("sure > 0")
    return members.join(told, ["home", "g"]).select("sig", F.col("sure").alias("n"))


def candidates(own: DataFrame, count: bool) -> DataFrame:
    """a, b: nodes that share a prefix token, pass the filters, and aren't settled by the stars.

    a is the smaller set (of equal sizes, the one of the lesser sig). As at least 8/9 of the smaller set are shared, its
    first n / 9 + 1 tokens are enough to meet the first n / 5 + 1 of the greater. Both meet in the greater set's band of sizes,
    which is the smaller one's own or the next."""
    kept = ("home", "g") if count else ("late", "doc", "text_key", "line")
    band = lambda n: F.floor(F.log(n.cast("double")) / F.lit(BAND)).cast("int")
    rows = own.where(F.col("n") >= SHORT).select("sig", "n", "bits", *WIDE, *kept, "prefix", F.posexplode("prefix").alias("at", "key"))
    rows = rows.withColumn("before", F.when(F.col("at") > 0, F.get("prefix", F.col("at") - 1))).drop("prefix")
    n = F.col("n")
    lesser = rows.where(F.col("at") * (_NUM + _DEN) <= n * (_DEN - _NUM)).withColumn("band", F.explode(F.sequence(band(n), band(F.floor(n * _DEN / F.lit(_NUM))))))
    greater = rows.withColumn("band", band(n))
    part = lambda rows, k: rows.where(F.col("key").bitwiseAND(F.lit(PASSES - 1)) == k)
    side = lambda rows, x: rows.select("key", "band", *(F.col(c).alias(f"{c}_{x}") for c in rows.columns if c not in ("key", "band")))
    na, nb, ia, ib = (F.col(c) for c in ("n_a", "n_b", "at_a", "at_b"))
    near = ((na < nb) | ((na == nb) & (F.col("sig_a") < F.col("sig_b")))) & _within(nb - na, na, nb)
    # at most `limit` tokens are in one set only: of those before the shared token, the places differ by no more
    near = near & _within(F.abs(ia - ib) + F.abs((na - ia) - (nb - ib)), na, nb) & _within(_apart("_a", "_b"), na, nb)
    # where the tokens before are shared too, the pair has come by them
    near = near & ~F.coalesce(F.col("before_a") == F.col("before_b"), F.lit(False))
    if count:
        near = near & ~F.coalesce((F.col("home_a") == F.col("home_b")) & (F.col("g_a") + F.col("g_b") <= 0), F.lit(False))
    else:
        near = near & ~F.when(_place("_a") < _place("_b"), F.col("late_b")).otherwise(F.col("late_a"))
    met = lambda k: side(part(lesser, k), "a").join(side(part(greater, k), "b"), ["key", "band"]).where(near).select(F.col("sig_a").alias("a"), F.col("sig_b").alias("b"))
    parts = [materialise(met(k).distinct(), "line-part") for k in range(PASSES)]
    return functools.reduce(DataFrame.unionByName, parts).distinct()


def classes(found: DataFrame, count: bool) -> DataFrame:
    """sig, doc, text_key, line (the earliest line of the set), copies, n_links (0 without count) and late, for the sets
    that have a copy, a link or go."""
    own = materialise(nodes(found, rarity(found)), "line-nodes")
    near = stars(own, found)
    if count:
        away = materialise(homes(near), "line-homes")
        centres = away.select(F.col("home").alias("sig")).distinct().join(away, "sig", "left_anti").join(own.select("sig", "n"), "sig")
        members = materialise(away.unionByName(centres.select("sig", F.col("sig").alias("home"), (-F.col("n")).alias("g"))), "line-members")
        marked = own.join(_held(members), "sig", "left")
    else:
        late = materialise(near.select(F.col("b").alias("sig"), F.lit(True).alias("late")).distinct(), "line-late")
        marked = own.join(_held(late), "sig", "left").withColumn("late", F.coalesce("late", F.lit(False)))
    pairs = materialise(candidates(marked, count), "line-pairs")
    more = materialise(verify(pairs, found).select("a", "b"), "line-links")
    ends = near.select(F.col("b").alias("sig"), F.lit(0).cast("long").alias("n_links"), F.lit(True).alias("late"))
    ends = ends.unionByName(more.select(F.col("b").alias("sig"), F.lit(1).cast("long").alias("n_links"), F.lit(True).alias("late")))
    if count:
        ends = ends.unionByName(more.select(F.col("a").alias("sig"), F.lit(1).cast("long").alias("n_links"), F.lit(False).alias("late")))
        ends = ends.unionByName(sure(members).select("sig", F.col("n").alias("n_links"), F.lit(False).alias("late")))
    linked = ends.groupBy("sig").agg(F.sum("n_links").alias("n_links"), F.max("late").alias("late"))
    out = own.select("sig", "doc", "text_key", "line", "copies").join(linked, "sig", "left")
    return out.select("sig", "doc", "text_key", "line", "copies", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("late", F.lit(False)).alias("late")).where("copies > 1 OR n_links > 0 OR late")


def judge_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each line with a word: doc_id, line_no, first_doc and first_line (the earliest line of an equal set, which
    names the line's class), n_links (classes that match its class) and removed."""
    with discarding(docs.sparkSession):
        found = materialise(lines(docs, doc_id, text, False), "line-tokens")
        told = materialise(classes(found, True).drop("text_key").withColumnsRenamed({"doc": "first_doc", "line": "first_line"}), "line-classes", keep=True)
        each = materialise(found.select("doc", "line", "sig"), "line-places", keep=True)
    out = each.join(told, "sig", "left")
    # lines of other sets are classes of their own
    alone = F.col("copies").isNull()
    first_doc, first_line = F.when(alone, F.col("doc")).otherwise(F.col("first_doc")), F.when(alone, F.col("line")).otherwise(F.col("first_line"))
    later = F.struct(F.col("doc").isNull(), F.col("doc"), F.col("line")) > F.struct(F.col("first_doc").isNull(), F.col("first_doc"), F.col("first_line"))
    removed = ~alone & (F.col("late") | later)
    return out.select(F.col("doc").alias("doc_id"), F.col("line").alias("line_no"), first_doc.alias("first_doc"), first_line.alias("first_line"), F.coalesce("n_links", F.lit(0)).alias("n_links"), removed.alias("removed"))


def removed_lines(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc, text_key, gone (array<int>): the numbers of the lines that go, for the rows (named by id and text hash) that lose some."""
    with discarding(docs.sparkSession):
        found = materialise(lines(docs, doc_id, text, True), "line-tokens")
        told = classes(found, False).select("sig", "late", *(F.col(c).alias(f"{c}_first") for c in ("doc", "text_key", "line")))
        lost = found.select("doc", "text_key", "line", "sig").join(told, "sig").where(F.col("late") | (_place() > _place("_first")))
        return materialise(lost.groupBy("doc", "text_key").agg(F.collect_set("line").alias("gone")), "line-gone", keep=True)


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with removed lines cut from their texts; documents that lose all their lines with words go."""
    key, own_id, own_key, gone, cut = (free(docs, f"line_dedup_{x}") for x in ("key", "id", "text_key", "gone", "text"))
    keyed = docs.withColumn(key, F.xxhash64(text))
    worded = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(ASCII_SPACE)) != ""
    keyed = single(keyed, [doc_id, key], worded)
    lost = removed_lines(keyed, doc_id, text).withColumnsRenamed({"doc": own_id, "text_key": own_key, "gone": gone})
    kept = keyed.join(lost, F.col(doc_id).eqNullSafe(F.col(own_id)) & (F.col(key) == F.col(own_key)), "left")
    left = F.filter(F.split(text, "\n"), lambda _, i: ~F.array_contains(gone, i))
    kept = kept.withColumn(cut, F.when(F.col(gone).isNull(), F.col(text)).otherwise(F.array_join(left, "\n")))
    kept = kept.where(F.col(gone).isNull() | (F.btrim(cut, F.lit(ASCII_SPACE)) != ""))
    return kept.select(*(F.col(cut).alias(c) if c == text else F.col(c) for c in docs.columns))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = dedup(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_lines(table(spark, sf_dir, "documents"))


def oracle() -> str:
    """Candidates by shared prefix tokens, decided on the whole sets; no stars, no parities."""
    return r"""
WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS said, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) - 1 AS line_no FROM documents),
s AS (SELECT doc_id, line_no::INT AS line_no, list_sort(list_distinct(regexp_extract_all(lower(said), '[^\x20\x09-\x0D]+'))) AS toks FROM l),
p AS (SELECT *, array_to_string(toks, ' ') AS k FROM s WHERE len(toks) > 0),
c AS (SELECT k, any_value(toks) AS toks, any_value(len(toks)) AS n, arg_min(doc_id, (doc_id, line_no)) AS first_doc, arg_min(line_no, (doc_id, line_no)) AS first_line FROM p GROUP BY k),
t AS (SELECT k, n, unnest(toks) AS tok FROM c),
f AS (SELECT tok, count(*) AS df FROM t GROUP BY tok),
o AS (SELECT t.k, t.n, t.tok, row_number() OVER (PARTITION BY t.k ORDER BY f.df, t.tok) AS spot FROM t JOIN f USING (tok)),
x AS (SELECT k, n, tok FROM o WHERE spot <= n - (4 * n + 4) // 5 + 1),
m AS (SELECT DISTINCT a.k AS a, b.k AS b FROM x a JOIN x b ON a.tok = b.tok AND a.k < b.k AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n),
v AS (SELECT m.a, m.b, len(list_intersect(ca.toks, cb.toks)) AS shared, ca.n + cb.n AS both_n, (ca.first_doc, ca.first_line) < (cb.first_doc, cb.first_line) AS a_first FROM m JOIN c ca ON ca.k = m.a JOIN c cb ON cb.k = m.b),
g AS (SELECT * FROM v WHERE 5 * shared >= 4 * (both_n - shared)),
e AS (SELECT a AS k, NOT a_first AS late FROM g UNION ALL SELECT b, a_first FROM g),
n AS (SELECT k, count(*) AS n_links, bool_or(late) AS late FROM e GROUP BY k)
SELECT p.doc_id, p.line_no, c.first_doc, c.first_line, coalesce(n.n_links, 0)::BIGINT AS n_links, (p.doc_id, p.line_no) > (c.first_doc, c.first_line) OR coalesce(n.late, false) AS removed
FROM p JOIN c USING (k) LEFT JOIN n USING (k)"""
