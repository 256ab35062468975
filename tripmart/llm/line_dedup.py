"""Fuzzy line dedup (DataFrame functions only).

Lines are lower-cased and every run of ASCII characters other than letters and
digits becomes one space; leading and trailing spaces go. Lines are whole, whatever their length. Two
normalised lines are linked if their edit similarity (1 - Levenshtein / longer length) is ``SIMILARITY`` or
more and one of two ways finds them. Of each connected group, the first occurrence stays (by document id, null
last, then text hash and place); all others go.

1. SimHash over the pairs of neighbouring words of every line, 64 bits (``fingerprint``). The fingerprint is cut into ``DISTANCE`` + 2 blocks; fingerprints
   within ``DISTANCE`` bits agree in two of them, so they meet in one of the cells for two blocks, and many
   that differ in more bits do too. In a cell pairs of up to ``NEAR`` different bits are candidates: each
   fingerprint near the cell's first one with that, the others with all near them (``_candidates``).
2. Candidates are verified by their edit distance. Lengths and letter counts rule out most
   others before they are aligned. First each line with one candidate, then the pairs, and lines near the
   same first fingerprint, that are not connected by then.
3. Words are few in a short line, and one edit moves many bits of its fingerprint. So lines that agree but for one
   stretch of at most ``1 - SIMILARITY`` of either one's length in UTF-8 bytes are found as well, by
   blocks of the line itself: the block (i, j) holds its first i and last j bytes,
   i + j >= ``SIMILARITY`` of its length; i and j are multiples of a step, a power of two of at most a
   ``STEPS``-th of the length (half as many steps for lines of ``SHORT`` bytes or more). Lines that agree in a block are similar, all with all, so a
   block is linked as a star around its smallest member: nothing in it is compared pair by
   pair, and a block with a third of all lines costs no more than its rows. Such a link leaves 0.4 of both lines alike
   at the beginning or at the end, so only lines that share such a beginning or end have blocks (``_ends``). A
   bit map of fixed size keeps the others back; when it fills up it costs work but changes nothing.
   One edit of up to a fifth of the length less two steps is always found, a longer one if it lies well between the steps.
4. Connected components of the links; equal lines (64-bit hash) are one node.

Defined cases: lines without a word are never removed nor counted as
copies; null text has no lines; rows alike in id and text keep the same lines.
Lines, blocks and ends with the same 64-bit hash count as equal.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm._common import keyed, read, stage
from tripmart.llm._graph import components

SIMILARITY = 0.8
DISTANCE = 3              # bits: fingerprints that differ in no more always meet
NEAR = 12                 # bits: of fingerprints that meet, those that differ in no more are candidates
STEPS = 24                # of a line under SHORT bytes; half as many of a longer one
SHORT = 192
RATIO = 1.26              # of neighbouring lengths of ends; over 1 / SIMILARITY
FIELD = 16                # bits of a counter beside others; lines of 2**15 words or more count in wider ones
CHUNK = 4                 # words counted at a time
MAP_BITS = 26             # bits of the map of wanted keys: at most 2**20 rows of 64 are broadcast


def lines_of(text: Column) -> Column:
    """The lines of a text."""
    return F.split(text, "\n", -1)


# named one by one, as a class of ranges is searched slower
OTHER = [f"\\x{c:02X}" for c in range(128) if chr(c) not in "0123456789abcdefghijklmnopqrstuvwxyz"]


def _spaced(text: Column, other: list[str]) -> Column:
    return F.regexp_replace(F.lower(text), f"[{''.join(other)}]+", " ")


def normalised(line: Column) -> Column:
    return F.trim(_spaced(line, OTHER))


def _worded(docs: DataFrame) -> DataFrame:
    """(id, th, u, x) of the lines x with a word, as they are; u is the line's number. A filter on the normalised
    line would normalise every line twice."""
    rows = docs.select("id", "th", F.posexplode(lines_of(F.col("text"))).alias("u", "x"))
    return rows.filter(F.col("x").rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"))


def _lines(rows: DataFrame) -> DataFrame:
    """(id, th, u, norm, a) of lines as from ``_worded``: a is the hash of the normalised line."""
    return rows.select("id", "th", "u", normalised(F.col("x")).alias("norm")).withColumn("a", F.xxhash64("norm"))


def fingerprint(norm: Column) -> Column:
    """64-bit SimHash of a normalised line: a bit is 1 if it is 1 in over half of the hashes of its words, each with the
    next one (single words are so often alike that unlike lines would meet). Counters are fields of ``width`` bits,
    added side by side; the last bit is counted by itself."""
    zero = F.lit(0).cast("long")

    def counted(hashes: Column, width: int) -> Column:
        ones = sum(1 << (width * i) for i in range(63 // width))
        # the top bit of a field comes out set where its count is over half
        more = (F.lit((1 << (width - 1)) - 1).cast("long") - F.shiftright(F.size(hashes).cast("long"), 1)) * F.lit(ones)

        def every(j: int) -> Column:
            """Bits j, j + width, j + 2 * width ..."""
            count = F.aggregate(hashes, zero, lambda acc, h: acc + F.shiftrightunsigned(h, j).bitwiseAND(F.lit(ones)))
            return F.shiftleft(F.shiftrightunsigned((count + more).bitwiseAND(F.lit(ones << (width - 1))), width - 1), j)

        return reduce(Column.bitwiseOR, map(every, range(width)))

    def bits(hashes: Column) -> Column:
        n = F.size(hashes)
        last = F.aggregate(hashes, zero, lambda acc, h: acc + F.shiftrightunsigned(h, 63))
        most = F.when(n < 1 << 6, counted(hashes, 7)).when(n < 1 << 8, counted(hashes, 9)).when(n < 1 << 20, counted(hashes, 21)).otherwise(counted(hashes, 63))
        return most.bitwiseOR(F.when(last * 2 > n, F.lit(-(1 << 63))).otherwise(zero))

    # arrays of one element name what is used more than once
    hashes = F.transform(F.array(F.split(norm, " ")), lambda w: F.transform(w, lambda x, i: F.xxhash64(x, F.get(w, i + 1))))
    return F.transform(hashes, bits)[0]


def _normalised_lines(docs: DataFrame) -> DataFrame:
    """(id, th, u, norm) as ``_lines`` makes of ``_worded``, of all lines: normalised a text at a time, but for line ends."""
    text = _spaced(F.col("text"), [c for c in OTHER if c != "\\x0A"])
    rows = docs.select("id", "th", F.posexplode(lines_of(text)).alias("u", "x"))
    return rows.select("id", "th", "u", F.trim("x").alias("norm")).filter("norm <> ''")


def _fingerprinted(rows: DataFrame) -> DataFrame:
    """(id, th, u, a, ends, fp) of lines (id, th, u, norm): the hash of each, its ends and its ``fingerprint``. Words are
    rows here, ``CHUNK`` at a time, and their bits are counted by an aggregation, as functions over an array cost more for each."""
    rows = rows.withColumn("w", F.split("norm", " "))
    rows = rows.select("id", "th", "u", F.monotonically_increasing_id().alias("row"), F.xxhash64("norm").alias("a"), _ends(F.col("norm")).alias("ends"),
                       F.when(F.size("w") >= 1 << (FIELD - 1), fingerprint(F.col("norm"))).alias("long"), "w")
    keys = ["id", "th", "u", "row", "a", "ends", "long"]
    n = F.when(F.col("long").isNull(), F.size("w")).otherwise(1)
    rows = rows.select(*keys, "w", n.alias("of")).select(*keys, "w", "of", F.explode(F.sequence(F.lit(0), F.col("of") - 1, F.lit(CHUNK))).alias("p"))
    hashes = [F.when(F.col("p") + k < F.col("of"), F.xxhash64(F.get("w", F.col("p") + k), F.get("w", F.col("p") + k + 1)))
              .otherwise(F.lit(0).cast("long")).alias(f"h{k}") for k in range(CHUNK)]
    rows = rows.select(*keys, F.least(F.col("of") - F.col("p"), F.lit(CHUNK)).alias("n"), *hashes)
    ones = F.lit(sum(1 << i for i in range(0, 64, FIELD)))
    # coalesced, as code for columns without nulls is short enough to be compiled
    total = lambda x: F.coalesce(F.sum(x), F.lit(0).cast("long"))
    counts = [total(reduce(Column.__add__, [F.shiftrightunsigned(f"h{k}", j).bitwiseAND(ones) for k in range(CHUNK)])).alias(f"c{j}") for j in range(FIELD)]
    rows = rows.groupBy(*keys).agg(total("n").alias("n"), *counts)
    # every other field, so that there is room for a bit above: it comes out set where the count is over half
    ones = sum(1 << i for i in range(0, 64, 2 * FIELD))
    more = (F.lit((1 << FIELD) - 1) - F.shiftright("n", 1)) * F.lit(ones)

    def bits(j: int, half: int) -> Column:
        count = F.shiftrightunsigned(f"c{j}", half) if half else F.col(f"c{j}")
        over = (count.bitwiseAND(F.lit(((1 << FIELD) - 1) * ones)) + more).bitwiseAND(F.lit(ones << FIELD))
        return F.shiftleft(over, j) if half else F.shiftrightunsigned(over, FIELD - j)

    fp = reduce(Column.bitwiseOR, [bits(j, half) for j in range(FIELD) for half in (0, FIELD)])
    return rows.select("id", "th", "u", "a", "ends", F.coalesce("long", fp).alias("fp"))


def _cells(fp: Column) -> Column:
    """Keys of the cells of a fingerprint: the bits of two blocks and the table's number."""
    n = DISTANCE + 2
    cut = [round(64 * i / n) for i in range(n + 1)]
    block = lambda i: F.shiftrightunsigned(fp, cut[i]).bitwiseAND(F.lit((1 << (cut[i + 1] - cut[i])) - 1))
    keys = []
    for t, (i, j) in enumerate(combinations(range(n), 2)):
        width = cut[j + 1] - cut[j]
        keys.append(F.shiftleft(block(i), width).bitwiseOR(block(j)).bitwiseOR(F.lit(t << 2 * -(-64 // n))))
    return F.array(*keys)


def _near(x: Column, y: Column) -> Column:
    return F.bit_count(x.bitwiseXOR(y)) <= NEAR


def _alike(one: DataFrame) -> DataFrame:
    """(fp, top, lines) of the fingerprints in ``one`` (a, fp): the smallest line and how many there are."""
    return one.groupBy("fp").agg(F.min("a").alias("top"), F.count(F.lit(1)).alias("lines"))


def _candidates(one: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs (u, v) of lines to verify, and (k, a, fp) of the lines near the first fingerprint of their cell k, of
    which any two may be similar. ``one``: (a, fp) of the different lines."""
    alike = stage(_alike(one), "fingerprints")
    dealt = alike.select(F.explode(_cells(F.col("fp"))).alias("k"), "fp")
    firsts = dealt.repartition("k").groupBy("k").agg(F.min("fp").alias("p"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    firsts = stage(firsts.withColumnRenamed("k", "kp"), "firsts")
    met = (F.col("k") == F.col("kp")) & (F.col("fp") != F.col("p")) & (_near(F.col("fp"), F.col("p")) | (F.col("n") > 2))
    # the map's places are the high bits of a key, which a cell's key does not use
    hashed = F.xxhash64("k").alias("k")
    dealt = _in_map(dealt.withColumn("own", F.col("k")).withColumn("k", hashed), firsts.select(F.col("kp").alias("k")).select(hashed))
    dealt = dealt.select(F.col("own").alias("k"), "fp")
    member = stage(dealt.join(firsts, met).select("k", "p", "fp", "n", _near(F.col("fp"), F.col("p")).alias("near")), "cells")
    # of the lines, those with a fingerprint that is in a pair
    wanted = member.select("fp").unionByName(member.select(F.col("p").alias("fp"))).unionByName(alike.filter("lines > 1").select("fp"))
    one = stage(_in_map(one.withColumn("k", F.xxhash64("fp")), wanted.select(F.xxhash64("fp").alias("k"))).drop("k"), "met")
    alike = stage(_alike(one), "met-fingerprints")
    star = member.filter("near")
    x = member.filter("n > 2").select("k", F.col("fp").alias("x"), "near")
    y = member.filter("not near").select(F.col("k").alias("ky"), F.col("fp").alias("y"))
    # of two that are both not near the first one, one order is enough
    beside = x.join(y, (F.col("k") == F.col("ky")) & (F.col("near") | (F.col("x") < F.col("y"))) & (F.col("x") != F.col("y"))
                    & _near(F.col("x"), F.col("y"))).select("x", "y").distinct()
    lines = lambda fp, a: one.select(F.col("fp").alias(fp), F.col("a").alias(a))
    tops = alike.select(F.col("fp").alias("p"), F.col("top").alias("u"))
    pairs = [star.select("p", "fp").distinct().join(tops, "p").join(lines("fp", "v"), "fp").select("u", "v"),
             beside.join(lines("x", "u"), "x").join(lines("y", "v"), "y").select("u", "v"),
             one.join(alike.filter("lines > 1"), "fp").filter("a <> top").select(F.col("top").alias("u"), F.col("a").alias("v"))]
    pairs = reduce(DataFrame.unionByName, pairs).select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    at = star.select("k", "fp").unionByName(star.select("k", F.col("p").alias("fp")).distinct())
    at = at.unionByName(alike.filter("lines > 1").select(F.xxhash64("fp").alias("k"), "fp"))
    return stage(pairs, "pairs"), stage(at.join(one, "fp").select("k", "a", "fp"), "near")


ALLOWED = f"cast(floor({1 - SIMILARITY} * greatest(lu, lv) + 1e-9) as int)"


def _measured(texts: DataFrame) -> DataFrame:
    """(a, norm) with the length and the counts of letters."""
    bag = F.array(*[F.length("norm") - F.length(F.replace("norm", F.lit(c), F.lit(""))) for c in "abcdefghijklmnopqrstuvwxyz"])
    return texts.select("a", "norm", F.length("norm").alias("len"), bag.alias("bag"))


def _possible() -> Column:
    """What a pair with enough edit similarity must meet, cheap to test: each edit
    changes the length by one at most, and one letter's count up and one's down."""
    def more(x, y):
        return F.aggregate(F.zip_with(x, y, lambda p, q: F.greatest(p - q, F.lit(0))), F.lit(0), lambda a, d: a + d)
    allowed = F.expr(ALLOWED)
    return (F.abs(F.col("lu") - F.col("lv")) <= allowed) & (more("bu", "bv") <= allowed) & (more("bv", "bu") <= allowed)


def unlike(x: Column, y: Column) -> Column:
    """Two strings as fields ``x`` and ``y``, backwards and without what is alike at their beginnings and ends, which
    their edit distance does not depend on: its cost grows with the product of the lengths."""
    halves = F.array(*[F.lit(1 << i) for i in range(15, -1, -1)])

    def shorter(both, n):
        alike = F.substring(both["x"], F.lit(1), n) == F.substring(both["y"], F.lit(1), n)
        rest = F.struct(*[F.substring(both[c], n + 1, F.lit((1 << 31) - 1)).alias(c) for c in "xy"])
        return F.when(alike, rest).otherwise(both)

    def backwards(both):
        return F.struct(*[F.reverse(both[c]).alias(c) for c in "xy"])

    return F.aggregate(halves, F.aggregate(halves, F.struct(x.alias("x"), y.alias("y")), shorter, backwards), shorter)


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Of different pairs (u, v), those with enough edit similarity. ``texts``: as from ``_measured``."""
    x, y = (texts.select(F.col("a").alias(k), F.col("norm").alias(f"t{k}"), F.col("len").alias(f"l{k}"), F.col("bag").alias(f"b{k}"))
            for k in "uv")
    rest = pairs.join(x, "u").join(y, "v").filter(_possible()).select("u", "v", unlike(F.col("tu"), F.col("tv")).alias("t"), F.expr(ALLOWED).alias("most"))
    # written first: a filter on these columns would work them out at each use.
    # The cost grows with the bound: most pairs that pass differ by a word or a few
    return stage(rest, "unlike").filter((F.greatest(F.length("t.x"), F.length("t.y")) <= F.col("most")) | _few_words(F.col("t.x"), F.col("t.y"), F.col("most")) | F.expr(
        " or ".join(f"levenshtein(t.x, t.y, least({n}, most)) >= 0" for n in (40, (1 << 31) - 1)))).select("u", "v")


def _few_words(x: Column, y: Column, most: Column) -> Column:
    """Whether two strings have the same number of words, and writing those that differ anew takes at most ``most`` edits.
    Their edit distance is no greater than that, and needn't be worked out then."""
    p, q = F.split(x, " "), F.split(y, " ")
    cost = F.zip_with(p, q, lambda v, w: F.when(v == w, 0).otherwise(F.greatest(F.length(v), F.length(w))))
    return (F.size(p) == F.size(q)) & (F.aggregate(cost, F.lit(0), lambda acc, n: acc + n) <= most)


def _apart(pairs: DataFrame, comp: DataFrame) -> DataFrame:
    """Pairs (u, v) that are not connected yet."""
    cu, cv = (comp.select(F.col("node").alias(k), F.col("comp").alias(f"c{k}")) for k in "uv")
    return (pairs.join(cu, "u", "left").join(cv, "v", "left")
            .filter(F.coalesce("cu", "u") != F.coalesce("cv", "v")).select("u", "v"))


def _late(near: DataFrame, comp: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (u, v) of lines near the same first fingerprint that are not connected yet, if they may be similar."""
    at = near.join(comp.withColumnRenamed("node", "a"), "a", "left").select("k", "a", "fp", F.coalesce("comp", "a").alias("g"))
    at = stage(at, "near-first")
    split = at.groupBy("k").agg(F.min("g").alias("g0"), F.max("g").alias("g1")).filter("g0 < g1").select("k")
    at = stage(at.join(split, "k").join(texts.drop("norm"), "a"), "split")
    x, y = (at.select(F.col("k").alias(f"k{n}"), F.col("a").alias(n), *[F.col(c).alias(c[0] + n) for c in ("fp", "g", "len", "bag")]) for n in "uv")
    return x.join(y, (F.col("ku") == F.col("kv")) & (F.col("u") < F.col("v")) & (F.col("gu") != F.col("gv"))
                  & _near(F.col("fu"), F.col("fv")) & _possible()).select("u", "v").distinct()


def _power(x: Column) -> Column:
    """The largest power of two up to x, 1 at least."""
    return F.pow(F.lit(2), F.floor(F.log2(F.greatest(x, F.lit(1.0))))).cast("int")


def _ends(norm: Column) -> Column:
    """Hashes of beginnings and ends: of linked lines one is shared. Linked lines agree in 0.4 of either one's
    length at the beginning or the end, and their lengths differ by a factor of 1.25 at most: of the lengths
    ``RATIO`` ** k up to 0.4 of a line's the last two are taken, and one of them is the other line's too."""
    raw = norm.cast("binary")
    n = F.length(raw)
    level = F.floor(F.log(F.greatest(n * (SIMILARITY / 2), F.lit(1.0))) / math.log(RATIO))
    keys = []
    for k in (level, F.greatest(level - 1, F.lit(0))):
        m = F.floor(F.pow(F.lit(RATIO), k) + 1e-9).cast("int")
        keys += [F.xxhash64(F.lit(0), k, F.substring(raw, F.lit(1), m)), F.xxhash64(F.lit(1), k, F.substring(raw, n - m + 1, m))]
    return F.array_distinct(F.array(*keys))


def _grid(texts: DataFrame) -> DataFrame:
    """(a, n, need, step, head, tail) of lines (a, norm): length, bytes that must agree, step, and the hashes of
    the first and last 0, step, 2 * step ... bytes."""
    rows = texts.select("a", F.col("norm").cast("binary").alias("b")).withColumn("n", F.length("b"))
    rows = rows.withColumn("need", (F.col("n") - F.floor(F.col("n") * (1 - SIMILARITY) + 1e-9)).cast("int"))
    rows = stage(rows.withColumn("step", _power(F.col("n") / F.when(F.col("n") < SHORT, STEPS).otherwise(STEPS // 2))), "texts")
    at = F.sequence(F.lit(0), F.col("n"), F.col("step"))
    return rows.select("a", "n", "need", "step", F.transform(at, lambda i: F.xxhash64(F.substring("b", F.lit(1), i))).alias("head"),
                       F.transform(at, lambda j: F.xxhash64(F.substring("b", F.col("n") - j + 1, j))).alias("tail"))


def _blocks(grid: DataFrame) -> DataFrame:
    """(a, k): the hashes of the blocks (i, j) of the rows of ``_grid``. For each i the shortest ends that make up for it,
    eight or four of a short line and two of a long one: lines of somewhat different length have one in common."""
    n, need, step, x = F.col("n"), F.col("need"), F.col("step"), F.col("x")
    ends = F.when(n < SHORT / 2, 8).when(n < SHORT, 4).otherwise(2)
    # steps at the beginning and at the end, a row each: functions over arrays of arrays cost ten times as much
    rows = grid.select("*", F.explode(F.sequence(F.lit(0), F.ceil(need / step).cast("int"))).alias("x"))
    rows = rows.withColumn("y", F.greatest(F.lit(0), F.ceil((need - x * step) / step)).cast("int")).filter("x * step + y * step <= n")
    more = F.sequence(F.col("y"), F.least(F.col("y") + ends - 1, F.floor((n - x * step) / step).cast("int")))
    rows = rows.select("a", "step", "x", "head", "tail", F.explode(more).alias("v"))
    return rows.select("a", F.xxhash64(x * step, F.col("v") * step, F.get("head", x), F.get("tail", F.col("v"))).alias("k"))


def _shared(rows: DataFrame) -> DataFrame:
    """(k, p) of the keys k in ``rows`` (k, a) that different lines have; p is the smallest of them."""
    return rows.groupBy("k").agg(F.min("a").alias("p"), F.max("a").alias("q")).filter("p <> q").select("k", "p")


def _in_map(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose ``k`` is in ``keys`` (k), and perhaps a few others."""
    place = F.shiftrightunsigned("k", 64 - MAP_BITS)
    at = [F.shiftright(place, 6).alias("cell"), place.bitwiseAND(F.lit(63)).cast("int").alias("at")]
    bitmap = keys.select(*at).groupBy("cell").agg(F.expr("bit_or(shiftleft(1L, at))").alias("bits"))
    return (rows.select("*", *at).join(F.broadcast(stage(bitmap, "bitmap")), "cell").filter(F.expr("getbit(bits, at)") == 1)
            .drop("cell", "at", "bits"))


def groups(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """(a, comp) of the lines (a: hash of the normalised line) that have a link to another. ``lines``: their
    places, hashes, fingerprints and ends, so that only texts with a line worth a look are read again."""
    pairs, near = _candidates(stage(lines.select("a", "fp").distinct(), "distinct"))
    named = pairs.select(F.col("u").alias("k")).unionByName(pairs.select(F.col("v").alias("k"))).distinct()
    named = stage(named, "named")
    ends = lines.select("th", "u", "a", F.explode("ends").alias("k"))
    shared = stage(_shared(ends.select("k", "a")).select("k"), "ends")
    # a line is read again at one place
    place = F.min(F.struct("th", "u")).alias("at")
    worth = stage(_in_map(ends, shared).groupBy("a").agg(place).select("a", "at.*"), "worth")
    compared = stage(_in_map(lines.select("th", "u", "a", F.col("a").alias("k")), named).groupBy("a").agg(place).select("a", "at.*"), "compared")
    wanted = worth.unionByName(compared)
    some = _in_map(docs.withColumn("k", F.col("th")), wanted.select(F.col("th").alias("k"))).drop("k")
    at = F.xxhash64("th", "u").alias("k")
    some = _in_map(_worded(some).select("*", at), wanted.select(at)).drop("k")
    texts = stage(_lines(some).groupBy("a").agg(F.min("norm").alias("norm")), "read-again")
    measured = stage(_measured(texts.join(named, texts["a"] == named["k"]).drop("k")), "measured")
    first = stage(pairs.groupBy("v").agg(F.min("u").alias("u")).select("u", "v"), "first-pairs")
    links = stage(_verified(first, measured), "verified")
    grid = stage(_grid(_in_map(texts.withColumn("k", F.col("a")), worth.select(F.col("a").alias("k"))).drop("k")), "grid")
    blocks = _blocks(grid)
    stars = stage(_shared(blocks), "blocks")
    same = _in_map(blocks, stars.select("k")).join(stars, "k").filter("a <> p").select(F.col("p").alias("u"), F.col("a").alias("v")).distinct()
    links = stage(links.unionByName(same).distinct(), "links")
    comp = stage(components(links), "components")
    rest = _apart(pairs, comp).unionByName(_late(near, comp, measured)).distinct().join(first, ["u", "v"], "left_anti")
    rest = stage(_verified(stage(rest, "rest"), measured), "verified")
    if rest.take(1):
        comp = components(links.unionByName(rest))
    return comp.withColumnRenamed("node", "a")


def removed(docs: DataFrame) -> DataFrame:
    """(id, th, units): the places of the lines that go, of documents that lose any."""
    lines = stage(_fingerprinted(_normalised_lines(docs)), "lines")
    comp = groups(docs, lines)
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "th", "u")
    # lines on their own are named by their hash, groups by a number
    at = stage(lines.drop("ends", "fp").join(comp, "a", "left").select("id", "th", "u", F.coalesce("comp", "a").alias("g"), F.col("comp").isNull().alias("own")), "grouped")
    many = at.groupBy("g", "own").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    many = stage(many, "many")
    key = F.xxhash64("g", "own").alias("k")
    at = stage(_in_map(at.select("*", key), many.select(key)).drop("k").join(many, ["g", "own"]), "copies")
    first = at.groupBy("g", "own").agg(F.min(place).alias("first"))
    gone = at.join(first, ["g", "own"]).filter(place != F.col("first"))
    return gone.groupBy("id", "th").agg(F.sort_array(F.collect_set("u")).alias("units"))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, th, n_lines, n_removed and removed (the lines' numbers, from 0)."""
    rows = keyed(docs, id_col, text_col)
    gone = stage(removed(rows), "removed").select(F.col("id").alias("i"), F.col("th").alias("t"), "units")
    n = rows.select("id", "th", F.when(F.length("text") > 0, F.octet_length("text") - F.octet_length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).otherwise(0).cast("long").alias("n_lines"))
    return (n.join(gone, F.col("id").eqNullSafe(F.col("i")) & (F.col("th") == F.col("t")), "left")
            .select("id", "th", "n_lines", F.coalesce(F.size("units"), F.lit(0)).cast("long").alias("n_removed"),
                    F.coalesce("units", F.array().cast("array<int>")).alias("removed")))


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the removed lines cut out of the text column; other columns
    and all rows stay, null text too."""
    id_, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string")
    gone = stage(removed(keyed(docs, id_col, text_col)), "removed")
    gone = gone.select(F.col("id").alias("__ld_i"), F.col("th").alias("__ld_t"), F.col("units").alias("__ld_units"))
    x = docs.withColumn("__ld_th", F.xxhash64(F.coalesce(text, F.lit(""))))
    x = x.join(gone, id_.eqNullSafe(F.col("__ld_i")) & (F.col("__ld_th") == F.col("__ld_t")), "left")
    kept = F.array_join(F.filter(lines_of(text), lambda _, u: ~F.array_contains("__ld_units", u)), "\n")
    return (x.withColumn(text_col, F.when(F.col("__ld_units").isNull(), text).otherwise(kept))
            .drop("__ld_th", "__ld_i", "__ld_t", "__ld_units"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = report(read(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_lines", "n_removed", F.array_join("removed", ",").alias("removed"))
