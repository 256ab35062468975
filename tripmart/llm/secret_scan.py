"""Secret scan with multipart credential linking (DataFrame functions only).

Base spans are found by pattern in every whole text. Weak parts, which alone say
little, are collected beside them:

* identifier: key ids of other kinds, ``client_id = ...`` and the like;
* secret: a run of exactly 40 base64 characters;
* endpoint: a URL or a host with a port.

An identifier (weak, or a base ``access``) opens a scope of ``SCOPE`` code points
on either side. Parts are joined with scopes by document and bin of ``SCOPE``
code points (an interval join whose buckets are bounded by the text's length in
them); both stand in every bin they cover and meet in the first they share.
Reported are: a secret in the scope of an identifier; a weak identifier
whose scope holds a secret (weak, or a base ``assign``); an endpoint in a scope
that holds a secret too. Base spans stay as they are.

Positions are code points, end exclusive. They are sums over the text pieces
between matches; the sums are taken in chunks of sqrt(n) so that a long text with
many matches stays cheap. Defined cases: null or empty text has no span; rows
alike in id and text are scanned each and get equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm._common import keyed, read, stage

# The patterns of the base spans.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"          # the leftmost match of a run is its longest: 20 characters or more
HEX = r"[0-9a-f]{24,}"
# Weak parts.
IDENTIFIER = (r"(?:ASIA|AIDA|AROA|ABIA|ACCA)[A-Z0-9]{12,}"
              r"""|(?:client|access|key)[_-]?[iI][dD]["']?\x20*[:=]\x20*["']?[A-Za-z0-9._-]{6,}""")
SECRET = r"[A-Za-z0-9+/]{40,}"         # 40 exactly is kept
ENDPOINT = r"""https?://[^\s"'<>]+|[a-z0-9][a-z0-9.-]*\.[a-z]{2,}:[0-9]{2,5}"""
KINDS = ["assign", "access", "hex", "identifier", "secret", "endpoint"]      # order of ties
SCOPE = 256


def _running(x: Column) -> Column:
    """[0, x1, x1 + x2, ...]"""
    return F.aggregate(x, F.array(F.lit(0).cast("long")),
                       lambda acc, v: F.concat(acc, F.array(F.element_at(acc, -1) + v)))


def _starts(lengths: Column) -> Column:
    """Sums of all lengths before each place, by chunks of sqrt(n)."""
    n = F.size(lengths)
    step = F.ceil(F.sqrt(n)).cast("int")
    chunks = F.transform(F.sequence(F.lit(0), n - 1, step), lambda k: _running(F.slice(lengths, k + 1, step)))
    base = lambda c: _running(F.transform(c, lambda x: F.element_at(x, -1)))     # noqa: E731
    # struct of (chunks, their offsets) by way of a one-element array, so that chunks are made once
    one = F.transform(F.array(chunks), lambda c: F.struct(c.alias("c"), base(c).alias("b")))
    return F.element_at(F.transform(one, lambda s: F.flatten(F.transform(
        s["c"], lambda x, i: F.transform(F.slice(x, 1, F.size(x) - 1), lambda v: v + F.get(s["b"], i))))), 1)


def find(text: Column, pattern: str, keep=None) -> Column:
    """array<struct<start, end>> of the leftmost non-overlapping matches that ``keep`` lets through."""
    p = F.lit(pattern)
    match = F.regexp_extract_all(text, p, F.lit(0))
    parts = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), match.alias("hit"))
    with_len = F.transform(F.filter(parts, lambda z: z["hit"].isNotNull()),
                           lambda z: F.struct(F.length(z["gap"]).cast("long").alias("gap"),
                                              F.length(z["hit"]).cast("long").alias("len"),
                                              (keep(z["hit"]) if keep else F.lit(True)).alias("ok")))
    one = F.transform(F.array(with_len), lambda w: F.struct(
        w.alias("w"), _starts(F.transform(w, lambda z: z["gap"] + z["len"])).alias("s")))
    spans = F.element_at(F.transform(one, lambda o: F.transform(
        F.filter(F.arrays_zip(o["w"].alias("w"), o["s"].alias("s")), lambda z: z["w"]["ok"]),
        lambda z: F.struct((z["s"] + z["w"]["gap"]).alias("start"), (z["s"] + z["w"]["gap"] + z["w"]["len"]).alias("end")))), 1)
    return F.when(F.regexp_like(text, p), spans).otherwise(F.array().cast("array<struct<start:long,end:long>>"))


def _tagged(spans: Column, kind: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def parts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, base, weak): spans as array<struct<start, kind, end>>, kind a number of ``KINDS``."""
    rows = keyed(docs, id_col, text_col)
    t = F.col("text")
    forty = lambda m: F.length(m) == 40                                               # noqa: E731
    value = lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 6                   # noqa: E731
    base = [find(t, ASSIGN, value), find(t, ACCESS), find(t, HEX)]
    weak = [find(t, IDENTIFIER), find(t, SECRET, forty), find(t, ENDPOINT)]
    return rows.select("id", "th", F.array_sort(F.concat(*[_tagged(c, i) for i, c in enumerate(base)])).alias("base"),
                       F.concat(*[_tagged(c, i + 3) for i, c in enumerate(weak)]).alias("weak"))


def linked(found: DataFrame) -> DataFrame:
    """(id, th, start, kind, end): weak parts whose complements co-occur."""
    some = found.filter("size(weak) > 0")
    one = (some.select("id", "th", F.explode(F.concat("base", "weak")).alias("p")).select("id", "th", "p.*")
           .distinct())
    binned = lambda df, hi: df.withColumn("bin", F.explode(F.sequence("lo", F.floor(hi / SCOPE))))      # noqa: E731
    ids = binned(one.filter("kind in (1, 3)")
                 .select("id", "th", F.col("start").alias("s"), F.col("end").alias("e"), F.col("kind").alias("k"),
                         F.floor(F.greatest(F.col("start") - SCOPE, F.lit(0)) / SCOPE).alias("lo")), F.col("e") + SCOPE - 1)
    other = binned(one.filter("kind in (0, 4, 5)").withColumn("lo", F.floor(F.col("start") / SCOPE)), F.col("end") - 1)
    i, o = ids.alias("i"), other.alias("o")
    pairs = (i.join(o, F.col("i.id").eqNullSafe(F.col("o.id")) & (F.col("i.th") == F.col("o.th"))
                    & (F.col("i.bin") == F.col("o.bin")) & (F.col("i.bin") == F.greatest("i.lo", "o.lo"))
                    & (F.col("o.start") < F.col("i.e") + SCOPE)
                    & (F.col("o.end") > F.col("i.s") - SCOPE))
             .select("i.id", "i.th", "s", "e", "k", "o.start", "o.kind", "o.end"))
    scope = (pairs.groupBy("id", "th", "s", "e", "k")
             .agg(F.max(F.col("kind").isin(0, 4)).alias("secret"),
                  F.collect_set(F.when(F.col("kind") != 0, F.struct("start", "kind", "end"))).alias("near"))
             .filter("secret"))
    own = F.when(F.col("k") == 3, F.array(F.struct(F.col("s").alias("start"), F.lit(3).alias("kind"), F.col("e").alias("end"))))
    empty = F.array().cast("array<struct<start:long,kind:int,end:long>>")
    return (scope.select("id", "th", F.explode(F.concat("near", F.coalesce(own, empty))).alias("p"))
            .select("id", "th", "p.*").distinct())


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, th, base, added) per row; ``added`` are the linked weak parts, sorted."""
    found = stage(parts(docs, id_col, text_col), "parts")
    extra = linked(found).groupBy("id", "th").agg(F.array_sort(F.collect_set(F.struct("start", "kind", "end"))).alias("added"))
    none = F.array().cast("array<struct<start:long,kind:int,end:long>>")
    f, x = found.alias("f"), extra.alias("x")
    return (f.join(x, F.col("f.id").eqNullSafe(F.col("x.id")) & (F.col("f.th") == F.col("x.th")), "left")
            .select("f.id", "f.th", "base", F.coalesce("added", none).alias("added")))


def _text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scan(read(spark, sf_dir, "documents"))
    n = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")      # noqa: E731
    return out.select(F.col("id").alias("doc_id"), n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
                      F.sha2(_text(F.col("base")), 256).alias("base_sha256"),
                      _text(F.array_sort(F.concat("base", "added"))).alias("spans"))


def _sql_spans(kind: int, pattern: str, keep: str = "true", flags: str = "") -> str:
    p = "'" + flags + pattern.removeprefix("(?i)").replace("'", "''") + "'"
    return f"""
  select doc_id, {kind} as kind, st + gap as s, st + gap + len as e from (
    select doc_id, len(g) as gap, len(h) as len, h,
           coalesce(sum(len(g) + len(h)) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding), 0) as st
    from (select doc_id, unnest(string_split_regex(text, {p})) as g, unnest(regexp_extract_all(text, {p})) as h,
                 generate_subscripts(regexp_extract_all(text, {p}), 1) as i
          from documents where regexp_matches(text, {p}))
    where h is not null) where {keep}"""


_KEEP_ASSIGN = "len(regexp_extract(h, '(?i)" + ASSIGN.removeprefix("(?i)").replace("'", "''") + "', 2)) >= 6"
ORACLE = f"""
with span as ({' union all '.join([
    _sql_spans(0, ASSIGN, _KEEP_ASSIGN, '(?i)'), _sql_spans(1, ACCESS), _sql_spans(2, HEX),
    _sql_spans(3, IDENTIFIER), _sql_spans(4, SECRET, 'len = 40'), _sql_spans(5, ENDPOINT)])}),
near as (select i.doc_id, i.s as is_, i.e as ie, i.kind as ik, o.s, o.e, o.kind from span i join span o
  on i.doc_id = o.doc_id and i.kind in (1, 3) and o.kind in (0, 4, 5) and o.s < i.e + {SCOPE} and o.e > i.s - {SCOPE}),
good as (select distinct doc_id, is_, ie, ik from near where kind in (0, 4)),
added as (select distinct n.doc_id, n.kind, n.s, n.e from near n join good g using (doc_id, is_, ie, ik) where n.kind > 0
  union select doc_id, 3, is_, ie from good where ik = 3),
named as (select doc_id, kind, s, e, ['{"','".join(KINDS)}'][kind + 1] || ':' || s::bigint || ':' || e::bigint as t
  from (select * from span where kind < 3 union all select doc_id, kind, s, e from added))
select d.doc_id, count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access,
  count(*) filter (kind = 2) as n_hex, sha256(coalesce(string_agg(t, ',' order by s, kind) filter (kind < 3), '')) as base_sha256,
  coalesce(string_agg(t, ',' order by s, kind), '') as spans
from documents d left join named n on d.doc_id = n.doc_id group by d.doc_id"""
