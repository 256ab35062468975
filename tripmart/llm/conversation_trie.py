"""Prefix trie of conversations, by double arrays in shards.

Every distinct sequence of the first d turns (role, text) of some conversation is
a node; the conversations that start with it are its members. For each node the
trie tells its members, children, leaves and the tokens that computing a shared
prefix only once would save.

1. A conversation becomes its turns' hashes (two of 64 bits; texts are not moved) and
   lengths, in order. Equal sequences are one row from there on, with their number.
2. Prefix shards: a sequence is dealt by its first turn. Where the sequences of a
   prefix hold over ``GROUP`` turns they are dealt by the first 2 turns, then 4, 8
   and so on; a sequence that ends before is a group of its own. So no group is
   large, however many conversations begin alike, save for one long conversation.
3. A task packs the groups it gets, some ten thousand turns at a time, into BASE and CHECK
   arrays over dense turn ids (``DoubleArray``) and traverses them for the nodes.
   Nodes from a group's own prefix downwards are complete there.
4. The nodes above are shared between groups: each group tells its path, and paths
   are merged by node. What counts once however many groups hold a node (its length,
   whether it is a leaf) is told by one owner, the node's smallest group.
5. Ids of members that end in a node are sorted by range, joined in chunks and hashed in
   order, so that a sequence with very many copies is gathered nowhere.

Defined cases: null role or text is the empty one; turns are ordered by turn (null
first), then role, then the MD5 of the text; a null conversation id is no conversation;
repeated rows are turns of their own; no conversation, no node. A conversation's
hashes (about 40 bytes a turn) must fit into a task.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripmart.llm._common import mix, read, stage

GROUP = 4096             # turns of a group that shares a prefix; more are dealt by a longer one
SHARD = 1 << 16          # turns packed into one double array
CHUNK = 512              # ids joined before they are hashed
SALT = 16
EMPTY = hashlib.sha256(b"").hexdigest()


# -------------------------------------------------------------- sequences

def sequences(conv: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """(conv, seq): the turns of each conversation in order, as array<struct<a, b, n>>: two
    hashes of role and text, and the text's code points."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = (conv.select(F.col(f"`{id_col}`").cast("long").alias("conv"), F.col(f"`{turn_col}`").alias("turn"),
                        role.alias("role"), text.alias("text")).filter("conv is not null"))
    rows = rows.select("conv", F.struct("turn", "role", F.md5("text").alias("m"), F.xxhash64("role", "text").alias("a"),
                                        F.xxhash64(F.lit(1), "text", "role").alias("b"),
                                        F.length("text").cast("long").alias("n")).alias("x"))
    return rows.groupBy("conv").agg(F.sort_array(F.collect_list("x")).alias("x")).select(
        "conv", F.transform("x", lambda t: F.struct(t["a"].alias("a"), t["b"].alias("b"), t["n"].alias("n"))).alias("seq"))


def _prefix(depth: Column | int) -> list[Column]:
    part = F.slice("seq", F.lit(1), depth if isinstance(depth, Column) else F.lit(depth))
    part = F.transform(part, lambda t: F.struct(t["a"], t["b"]))
    return [F.xxhash64(part), F.xxhash64(F.lit(1), part)]


def _dealt(seqs: DataFrame) -> DataFrame:
    """(k1, k2, n, low, seq, level, g1, g2): distinct sequences with their number and smallest
    conversation, and the group they are dealt to: that of their first 2 ** level turns."""
    k1, k2 = _prefix(F.size("seq"))
    one = stage(seqs.groupBy(k1.alias("k1"), k2.alias("k2")).agg(
        F.count(F.lit(1)).alias("n"), F.min("conv").alias("low"), F.first("seq").alias("seq")), "distinct")
    depths = F.filter(F.array(*[F.lit(1 << i) for i in range(31)]), lambda d: d <= F.size("seq"))
    each = one.select("k1", "k2", F.size("seq").alias("w"), "seq", F.posexplode(depths).alias("level", "d"))
    g1, g2 = _prefix(F.col("d"))
    each = each.select("k1", "k2", "w", "level", g1.alias("g1"), g2.alias("g2"))
    heavy = each.groupBy("level", "g1", "g2").agg(F.sum("w").alias("w")).filter(F.col("w") > GROUP)
    # few prefixes are heavy, but one may hold a third of all sequences: salt the join
    heavy = stage(heavy.select("level", "g1", "g2"), "heavy").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    each = each.withColumn("salt", F.pmod("k1", F.lit(SALT)).cast("int"))
    deep = each.join(heavy, ["level", "g1", "g2", "salt"]).groupBy("k1", "k2").agg((F.max("level") + 1).alias("level"))
    out = one.join(deep, ["k1", "k2"], "left").withColumn("level", F.coalesce("level", F.lit(0)))
    g1, g2 = _prefix(F.least(F.expr("shiftleft(1, level)"), F.size("seq")))
    return out.select("k1", "k2", "n", "low", "seq", "level", g1.alias("g1"), g2.alias("g2"))


# ------------------------------------------------------------------- trie

class DoubleArray:
    """Trie of sequences of codes from 1: node t is the child of s for code c if
    t = base[s] + c and check[t] = s. The root is 0."""

    def __init__(self, codes: np.ndarray, first: np.ndarray, size: np.ndarray):
        self.codes, self.first, self.size = codes, first, size
        self.check, self._next = [0], [1]
        base = {}
        state = np.zeros(len(size), np.int64)
        width = int(codes.max()) + 1 if len(codes) else 1
        for d in range(int(size.max()) if len(size) else 0):
            at = np.flatnonzero(size > d)
            edge, own = np.unique(state[at] * width + codes[first[at] + d], return_inverse=True)
            src, lab = np.divmod(edge, width)
            cut = np.append(np.flatnonzero(np.append(True, src[1:] != src[:-1])), len(src)).tolist()
            src_, lab_ = src.tolist(), lab.tolist()
            node = np.empty(len(src), np.int64)
            for lo, hi in zip(cut, cut[1:], strict=False):
                b = base[src_[lo]] = self._place(src_[lo], lab_[lo:hi])
                node[lo:hi] = lab[lo:hi] + b
            state[at] = node[own]
        self.check = np.array(self.check, np.int64)
        self.base = np.zeros(len(self.check), np.int64)
        self.base[list(base)] = list(base.values())

    def _free(self, x: int) -> int:
        """Smallest free place from x on."""
        nxt, check = self._next, self.check
        while True:
            while len(check) <= x:
                check.append(-1)
                nxt.append(len(nxt))
            if nxt[x] == x:
                return x
            if nxt[x] < len(nxt):
                nxt[x] = nxt[nxt[x]]
            x = nxt[x]

    def _place(self, src: int, labels: list[int]) -> int:
        """Base for a node with these children (rising), whose places are taken."""
        f = self._free(labels[0] + 1)
        while True:
            b = f - labels[0]
            if all(b + c >= len(self.check) or self.check[b + c] < 0 for c in labels[1:]):
                break
            f = self._free(f + 1)
        for c in labels:
            t = self._free(b + c)
            self.check[t], self._next[t] = src, t + 1
        return b

    def walk(self):
        """Yield (depth, rows, nodes): where the sequences stand after each turn."""
        state = np.zeros(len(self.size), np.int64)
        yield 0, np.arange(len(state)), state.copy()
        for d in range(int(self.size.max()) if len(self.size) else 0):
            at = np.flatnonzero(self.size > d)
            to = self.base[state[at]] + self.codes[self.first[at] + d]
            assert (self.check[to] == state[at]).all()
            state[at] = to
            yield d + 1, at, to


PATH = pa.list_(pa.struct([("p1", pa.int64()), ("p2", pa.int64()), ("len", pa.int64())]))
PARTS = pa.schema([("is_node", pa.bool_()), ("conv", pa.int64()), ("depth", pa.int64()), ("parent", pa.int64()),
                   ("n", pa.int64()), ("children", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()),
                   ("k1", pa.int64()), ("k2", pa.int64()), ("p1", pa.int64()), ("p2", pa.int64()),
                   ("gid", pa.struct([("level", pa.int32()), ("g1", pa.int64()), ("g2", pa.int64())])),
                   ("path", PATH), ("has_top", pa.bool_())])
PARTS_SQL = ("is_node boolean, conv long, depth long, parent long, n long, children long, leaves long, saved long, k1 long, "
             "k2 long, p1 long, p2 long, gid struct<level: int, g1: long, g2: long>, "
             "path array<struct<p1: long, p2: long, len: long>>, has_top boolean")


def _shard(level, g1, g2, k1, k2, n, low, size, a, b, length) -> pa.RecordBatch:
    """Nodes and paths of whole groups: one row per sequence, sorted by group; ``size``
    turns each of (a, b, length)."""
    first = np.cumsum(size) - size
    o = np.lexsort((b, a))
    new = np.append(True, (a[o][1:] != a[o][:-1]) | (b[o][1:] != b[o][:-1]))[:len(o)]
    codes = np.empty(len(o), np.int64)
    codes[o] = np.cumsum(new)                                     # dense turn ids from 1
    ids = [np.append(0, x[o][new]) for x in (a, b, length)]       # by turn id
    trie = DoubleArray(codes, first, size)
    m = len(trie.check)
    head = np.flatnonzero(np.append(True, (level[1:] != level[:-1]) | (g1[1:] != g1[:-1]) | (g2[1:] != g2[:-1])))
    cut = 1 << level.astype(np.int64)                             # a group's own nodes start at this depth
    members, smallest, depth = np.zeros(m, np.int64), np.full(m, np.iinfo(np.int64).max), np.full(m, -1)
    name = [np.zeros(m, np.uint64), np.zeros(m, np.uint64)]       # hashes of the node's turns, alike in all shards
    ends, shared, last = np.full(m, -1), np.zeros(m, bool), np.zeros(m, np.int64)
    tops, steps = np.full(len(size), -1), []
    by_depth = []
    for d, at, node in trie.walk():
        np.add.at(members, node, n[at])
        np.minimum.at(smallest, node, low[at])
        here = np.unique(node)
        by_depth.append(here)
        depth[here] = d
        if d:
            src = trie.check[here]
            c = here - trie.base[src]
            last[here] = ids[2][c]
            for x, salt in ((0, 1), (1, 2)):
                name[x][here] = mix(mix(name[x][src] + np.uint64(salt)) + mix(ids[x][c].astype(np.int64).view(np.uint64)))
        done = size[at] == d
        ends[node[done]] = at[done]
        shared[node[d < cut[at]]] = True
        tops[at[cut[at] == d]] = node[cut[at] == d]
        rep = np.isin(at, head) & (d < cut[at])
        steps.append((at[rep], node[rep]))
    kids, leaves, saved = np.zeros(m, np.int64), np.zeros(m, np.int64), (members - 1) * last
    for here in reversed(by_depth):
        leaves[here[kids[here] == 0]] = 1
        up = here[depth[here] > 0]
        np.add.at(kids, trie.check[up], 1)
        np.add.at(leaves, trie.check[up], leaves[up])
        np.add.at(saved, trie.check[up], saved[up])
    own = np.flatnonzero((depth >= 0) & ~shared)
    src = trie.check[own]
    top = shared[src]
    i64 = lambda x, null=None: pa.array(np.ascontiguousarray(x).astype(np.int64, copy=False), pa.int64(), mask=null)
    sig = [x.view(np.int64) for x in name]
    no_end = ends[own] < 0
    nodes = {"conv": i64(smallest[own]), "depth": i64(depth[own]), "parent": i64(smallest[src], top), "n": i64(members[own]),
             "children": i64(kids[own]), "leaves": i64(leaves[own]), "saved": i64(saved[own]),
             "k1": i64(k1[ends[own]], no_end), "k2": i64(k2[ends[own]], no_end), "p1": i64(sig[0][src], ~top), "p2": i64(sig[1][src], ~top)}
    # a group's path: the shared nodes from the root on
    who = np.concatenate([s[0] for s in steps])
    where = np.concatenate([s[1] for s in steps])
    o = np.argsort(who, kind="stable")
    who, where = who[o], where[o]
    path = pa.ListArray.from_arrays(
        pa.array(np.append(np.searchsorted(who, head), len(who)), pa.int32()),
        pa.StructArray.from_arrays([i64(sig[0][where]), i64(sig[1][where]), i64(last[where])], names=["p1", "p2", "len"]))
    t = tops[head]
    has = t >= 0
    groups = {"conv": i64(np.minimum.reduceat(low, head)), "n": i64(np.add.reduceat(n, head)),
              "leaves": i64(np.where(has, leaves[t], 0)), "saved": i64(np.where(has, saved[t], 0)),
              "k1": i64(k1[head], has), "k2": i64(k2[head], has),
              "gid": pa.StructArray.from_arrays([pa.array(level[head].astype(np.int32)), i64(g1[head]), i64(g2[head])], names=["level", "g1", "g2"]),
              "path": path, "has_top": pa.array(has)}
    parts = []
    for is_node, cols, rows in ((True, nodes, len(own)), (False, groups, len(head))):
        arrays = [pa.array([is_node] * rows, pa.bool_()) if f.name == "is_node" else
                  cols[f.name].cast(f.type) if f.name in cols else pa.nulls(rows, f.type) for f in PARTS]
        parts.append(pa.RecordBatch.from_arrays(arrays, schema=PARTS))
    return pa.concat_batches(parts)


def _pack(batches):
    held, turns = [], 0
    cols = ("level", "g1", "g2", "k1", "k2", "n", "low")

    def close(final):
        rows = [np.concatenate([h[i] for h in held]) for i in range(len(cols) + 4)]
        head = rows[:3]
        cut = len(head[0])
        if not final:                            # the last group may go on in the next batch
            same = np.logical_and.reduce([x == x[-1] for x in head])
            cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        at = int(rows[7][:cut].sum())
        rest = [x[cut:] for x in rows[:8]] + [x[at:] for x in rows[8:]]
        out = _shard(*[x[:cut] for x in rows[:8]], *[x[:at] for x in rows[8:]]) if cut else None
        return out, rest

    for b in batches:
        seq = b.column(b.schema.get_field_index("seq"))
        offs = np.frombuffer(seq.buffers()[1], np.int32)[seq.offset:seq.offset + len(seq) + 1].astype(np.int64)
        flat = seq.values.slice(offs[0], offs[-1] - offs[0])
        turn = [flat.field(i).to_numpy(zero_copy_only=False) for i in range(3)]
        held.append([b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in cols] + [np.diff(offs), *turn])
        turns += len(flat)
        if turns >= SHARD:
            out, rest = close(False)
            held, turns = [rest], len(rest[8])
            if out is not None:
                yield out
    if held and sum(len(h[0]) for h in held):
        yield close(True)[0]


# ------------------------------------------------------------------- whole

def _ends(seqs: DataFrame) -> DataFrame:
    """(k1, k2, ends): SHA-256 of the ids of the conversations with this sequence."""
    k1, k2 = _prefix(F.size("seq"))
    rows = seqs.select(k1.alias("k1"), k2.alias("k2"), "conv").sort("k1", "k2", "conv")

    def join(batches):
        for b in batches:
            x, y, c = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            head = np.flatnonzero(np.append(True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])))
            at = np.concatenate([np.arange(lo, hi, CHUNK) for lo, hi in zip(head, np.append(head[1:], len(x)), strict=True)])
            ids = c.tolist()
            nxt = np.minimum(np.append(at[1:], len(x)), at + CHUNK)
            yield pa.RecordBatch.from_pydict({
                "k1": pa.array(x[at]), "k2": pa.array(y[at]), "conv": pa.array(c[at]),
                "ids": pa.array([",".join(map(str, ids[i:j])) for i, j in zip(at.tolist(), nxt.tolist(), strict=True)], pa.string())})

    def digest(batches):
        now, sha, done = None, None, []

        def flush():
            x, y, s = zip(*done, strict=True)
            done.clear()
            return pa.RecordBatch.from_pydict({"k1": pa.array(x, pa.int64()), "k2": pa.array(y, pa.int64()), "ends": pa.array(s, pa.string())})

        for b in batches:
            for x, y, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3), strict=True):
                if (x, y) != now:
                    if now is not None:
                        done.append((*now, sha.hexdigest()))
                    now, sha = (x, y), hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ids.as_py().encode())
            if len(done) > 10_000:
                yield flush()
        if now is not None:
            done.append((*now, sha.hexdigest()))
            yield flush()

    return (rows.mapInArrow(join, "k1 long, k2 long, conv long, ids string")
            .repartition("k1", "k2").sortWithinPartitions("k1", "k2", "conv")
            .mapInArrow(digest, "k1 long, k2 long, ends string"))


def _upper(groups: DataFrame) -> DataFrame:
    """The nodes that groups share, merged: (p1, p2, q1, q2: the parent's name, conv, depth, n,
    children, leaves, saved, k1, k2)."""
    i, last = F.col("i"), F.size("path") - 1
    step = (groups.select("gid", "conv", "n", "k1", "k2", "has_top", "path", "leaves", "saved", F.posexplode("path").alias("i", "p"))
            .select("gid", "i", "conv", "n", "p.*", F.get("path", i - 1).alias("q"), ((i < last) | F.col("has_top")).alias("inner"),
                    F.when(i == last, F.struct("k1", "k2")).alias("k"),
                    *[F.when(i == last, F.col(c)).otherwise(F.lit(0)).alias(c) for c in ("leaves", "saved")],
                    ((i == last) & F.col("has_top")).cast("long").alias("tops")))
    step = stage(step, "paths")
    k = F.when(F.col("k.k1").isNotNull(), F.col("k"))
    node = (step.groupBy("p1", "p2")
            .agg(F.min("i").alias("depth"), F.min("conv").alias("conv"), F.sum("n").alias("n"), F.max("inner").alias("inner"),
                 F.min("gid").alias("owner"), F.max(k).alias("k"), F.max(F.struct("q.p1", "q.p2")).alias("q"), F.max("len").alias("len")))
    node = stage(node, "shared")
    owned = node.select(F.col("owner").alias("gid"), F.col("depth").alias("i"), F.lit(1).alias("own"), (~F.col("inner")).cast("long").alias("leaf"))
    down = Window.partitionBy("gid").orderBy(F.col("i").desc())
    sums = (step.join(owned, ["gid", "i"], "left")
            .select("p1", "p2", "tops",
                    F.sum(F.col("n") * F.col("len") - F.coalesce("own", F.lit(0)) * F.col("len") + F.col("saved")).over(down).alias("saved"),
                    F.sum(F.coalesce("leaf", F.lit(0)) + F.col("leaves")).over(down).alias("leaves")))
    kids = node.filter("depth > 0").select(F.col("q.p1").alias("p1"), F.col("q.p2").alias("p2"), F.lit(1).cast("long").alias("tops"),
                                           F.lit(0).cast("long").alias("saved"), F.lit(0).cast("long").alias("leaves"))
    sums = sums.unionByName(kids).groupBy("p1", "p2").agg(F.sum("tops").alias("children"), F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    return node.join(sums, ["p1", "p2"]).select("p1", "p2", F.col("q.p1").alias("q1"), F.col("q.p2").alias("q2"), "conv",
                                                F.col("depth").cast("long").alias("depth"), "n", "children", "leaves", "saved", "k.k1", "k.k2")


def prefix_trie(seqs: DataFrame) -> DataFrame:
    """One row per node of the trie of ``seqs`` (conv, seq; see ``sequences``): conv_id (smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    seqs = stage(seqs, "sequences")
    dealt = (_dealt(seqs).select("level", "g1", "g2", "k1", "k2", "n", "low", "seq")
             .repartition("g1", "g2").sortWithinPartitions("level", "g1", "g2"))
    parts = stage(dealt.mapInArrow(_pack, PARTS_SQL), "parts")
    upper = stage(_upper(parts.filter("not is_node")), "upper")
    values = ["conv", "depth", "n", "children", "leaves", "saved", "k1", "k2"]
    nodes = parts.filter("is_node")
    # parents: known within the shard; the root, one row, for nodes at depth 1; other shared nodes by a salted join
    inner = nodes.filter("p1 is null").select(*values, "parent")
    rest = (nodes.filter("p1 is not null").select(*values, "p1", "p2")
            .unionByName(upper.filter("depth > 0").select(*values, F.col("q1").alias("p1"), F.col("q2").alias("p2"))))
    root = upper.filter("depth = 0")
    lowest = root.agg(F.min("conv")).first()[0]
    first = rest.filter("depth = 1").select(*values, F.lit(lowest).cast("long").alias("parent"))
    named = (upper.filter("depth > 0").select("p1", "p2", F.col("conv").alias("parent"))
             .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))))
    deeper = (rest.filter("depth > 1").withColumn("salt", F.pmod("conv", F.lit(SALT)).cast("int"))
              .join(named, ["p1", "p2", "salt"]).select(*values, "parent"))
    every = root.select(*values, F.lit(None).cast("long").alias("parent")).unionByName(inner).unionByName(first).unionByName(deeper)
    some = every.filter("k1 is not null").join(_ends(seqs), ["k1", "k2"])
    none = every.filter("k1 is null").withColumn("ends", F.lit(EMPTY))
    return some.unionByName(none).select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.col("ends").alias("ends_sha256"))


def rebuilt(seqs: DataFrame) -> DataFrame:
    """Conversations (conv, seq) of which the first h turns are those of conversation
    conv - conv % 100, with h = crc32 of the id modulo 6; their own follow from turn h on."""
    seqs = stage(seqs, "conversations")
    heads = seqs.filter("conv % 100 = 0").select(F.col("conv").alias("base"), F.slice("seq", 1, 5).alias("head"))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % 6).cast("int")
    rows = seqs.select("conv", "seq", h.alias("h"), (F.col("conv") - F.col("conv") % 100).alias("base"))
    rows = rows.join(heads, "base", "left")
    own = F.slice("seq", F.col("h") + 1, F.size("seq"))
    return rows.select("conv", F.when(F.col("head").isNull(), own).otherwise(
        F.concat(F.slice("head", F.lit(1), F.col("h")), own)).alias("seq"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(rebuilt(sequences(read(spark, sf_dir, "conversations"))))


# crc32 goes over the digits of the id bit by bit; a node's name is the string of its turns' MD5
ORACLE = r"""
WITH t AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (
  SELECT c, c - c % 100 AS base, n,
         xor(list_reduce(flatten(list_transform(string_split(CAST(c AS VARCHAR), ''),
               lambda ch: list_concat([CAST(ascii(ch) AS BIGINT)], list_transform(range(8), lambda i: CAST(-1 AS BIGINT))))),
             lambda acc, y: CASE WHEN y >= 0 THEN xor(acc, y) WHEN (acc & 1) = 1 THEN xor(acc >> 1, CAST(3988292384 AS BIGINT)) ELSE acc >> 1 END,
             CAST(4294967295 AS BIGINT)), CAST(4294967295 AS BIGINT)) % 6 AS h
  FROM (SELECT c, count(*) AS n FROM t GROUP BY c)),
s AS (
  SELECT i.c, b.pos + 1 AS d, b.r, b.x FROM ids i JOIN t b ON b.c = i.base AND b.pos < i.h
  UNION ALL
  SELECT i.c, o.pos - i.h + 1 + least(i.h, coalesce(b.n, 0)), o.r, o.x
  FROM ids i JOIN t o ON o.c = i.c AND o.pos >= i.h LEFT JOIN ids b ON b.c = i.base),
p AS (
  SELECT c, d, length(x) AS len,
         string_agg(md5(length(r) || ':' || r || x), '' ORDER BY d) OVER (PARTITION BY c ORDER BY d) AS path FROM s),
nodes AS (
  SELECT path, min(c) AS conv_id, count(*) AS n, any_value(d) AS depth, any_value(len) AS len FROM p GROUP BY path
  UNION ALL SELECT '', min(c), count(*), 0, 0 FROM ids HAVING count(*) > 0),
kids AS (SELECT substr(path, 1, length(path) - 32) AS path, count(*) AS k FROM nodes WHERE depth > 0 GROUP BY 1),
val AS (SELECT nodes.*, coalesce(k, 0) AS k, (n - 1) * len AS own FROM nodes LEFT JOIN kids USING (path)),
up AS (
  SELECT substr(path, 1, CAST(32 * a AS BIGINT)) AS path, sum(own) AS saved, sum(CASE WHEN k = 0 THEN 1 ELSE 0 END) AS leaves
  FROM (SELECT path, own, k, unnest(range(0, depth + 1)) AS a FROM val) GROUP BY 1),
full_ AS (SELECT ids.c, coalesce(max_by(path, d), '') AS path FROM ids LEFT JOIN p ON p.c = ids.c GROUP BY ids.c),
ends AS (SELECT path, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS e FROM full_ GROUP BY path)
SELECT val.conv_id, CAST(val.depth AS BIGINT) AS depth, par.conv_id AS parent_conv_id, CAST(val.n AS BIGINT) AS n_convs,
       CAST(val.k AS BIGINT) AS n_children, CAST(up.leaves AS BIGINT) AS n_leaves, CAST(up.saved AS BIGINT) AS saved_tokens,
       sha256(coalesce(ends.e, '')) AS ends_sha256
FROM val JOIN up USING (path) LEFT JOIN ends USING (path)
LEFT JOIN nodes par ON val.depth > 0 AND par.path = substr(val.path, 1, length(val.path) - 32)
"""
