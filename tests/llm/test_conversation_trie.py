"""The trie of conversations against dictionaries of prefixes."""
import collections
import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def _ordered(rows):
    conv = collections.defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            conv[c].append((t is not None, t or 0, r or "", hashlib.md5((x or "").encode()).hexdigest(), x or ""))
    return {c: [(v[2], v[4]) for v in sorted(vs)] for c, vs in conv.items()}


def _rebuilt(conv):
    cut = lambda c: zlib.crc32(str(c).encode()) % 6          # noqa: E731
    return {c: conv.get(int(c - np.fmod(c, 100)), [])[:cut(c)] + own[cut(c):] for c, own in conv.items()}


def _trie(conv):
    member, kids = collections.defaultdict(list), collections.Counter()
    leaves, saved, ends = collections.Counter(), collections.Counter(), collections.defaultdict(list)
    for c, s in conv.items():
        for d in range(len(s) + 1):
            member[tuple(s[:d])].append(c)
        ends[tuple(s)].append(c)
    for k in member:
        if k:
            kids[k[:-1]] += 1
    for k, v in member.items():
        for d in range(len(k) + 1):
            saved[k[:d]] += (len(v) - 1) * len(k[-1][1]) if k else 0
            leaves[k[:d]] += kids[k] == 0
    return sorted(((min(v), len(k), min(member[k[:-1]]) if k else None, len(v), kids[k], leaves[k], saved[k],
                    hashlib.sha256(",".join(map(str, sorted(ends.get(k, [])))).encode()).hexdigest()) for k, v in member.items()), key=str)


def _rows(seed=3, n=260):
    rnd = random.Random(seed)
    say = ["", "hi", "größe", "a\nb", "x" * 40, "hi ", None, "yes", "no", "perhaps"]
    rows = []
    for c in [*range(0, n), *range(1000, 1040), -7, -300, -301, 205_050, 205_051]:
        if c in (200,):                                     # a missing base: some conversations lose all turns
            continue
        hot = rnd.random() < 0.4
        first = [("system", "You are the one everybody starts with."), ("user", "hi")] if hot else []
        own = first + [(rnd.choice(["user", "assistant", None]), rnd.choice(say)) for _ in range(rnd.choice([0, 1, 2, 3, 7]))]
        own = own or [("user", "hi")]
        rows += [(c, t, r, x) for t, (r, x) in enumerate(own)]
    rows += [(1001, None, "user", "turn unknown"), (1001, 0, "user", "same turn"), (1001, 0, "user", "same turn"), (1002, 0, None, None),
             (None, 0, "user", "nobody's"), (None, None, None, None)]
    rows += [(c, t, "user", f"long {t}") for c in (3000, 3001, 3002) for t in range(70 + c % 3)]
    rnd.shuffle(rows)
    return rows


SCHEMA = "conv_id long, turn int, role string, text string, conv int, seq string, n int"


@pytest.fixture(scope="module")
def rows():
    return _rows()


@pytest.fixture(scope="module")
def conv(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(5)


@pytest.mark.parametrize("group", [4096, 6])
def test_trie_matches_dictionaries(conv, rows, monkeypatch, group):
    from tripmart.llm import conversation_trie as m
    monkeypatch.setattr(m, "GROUP", group)
    monkeypatch.setattr(m, "CHUNK", 3)
    plain = _ordered(rows)
    seqs = m.sequences(conv)
    assert sorted(map(tuple, m.prefix_trie(seqs).select(*COLUMNS).collect()), key=str) == _trie(plain)
    if group == 6:
        assert sorted(map(tuple, m.prefix_trie(m.rebuilt(seqs)).select(*COLUMNS).collect()), key=str) == _trie(_rebuilt(plain))


def test_query_matches_dictionaries_and_sql(spark, rows, conv, tmp_path):
    from tripmart.llm import conversation_trie as m
    path = f"{tmp_path}/conversations.parquet"
    conv.write.parquet(path)
    want = _trie(_rebuilt(_ordered(rows)))
    assert any(not s for s in _rebuilt(_ordered(rows)).values())           # a turnless conversation
    assert sorted(map(tuple, m.op12_conversation_trie(spark, str(tmp_path)).select(*COLUMNS).collect()), key=str) == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{path}/*.parquet')")
    got = con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({m.ORACLE})").fetchall()
    assert sorted(got, key=str) == want


def test_no_conversation_no_node(spark, conv):
    from tripmart.llm import conversation_trie as m
    for none in (conv.limit(0), conv.filter("conv_id is null")):
        assert m.prefix_trie(m.rebuilt(m.sequences(none))).count() == 0


def test_heavy_prefixes_are_dealt_by_longer_ones(conv, monkeypatch):
    from tripmart.llm import conversation_trie as m
    monkeypatch.setattr(m, "GROUP", 30)
    rows = m._dealt(m.sequences(conv)).collect()
    weight, size, lone = collections.Counter(), collections.Counter(), {}
    for r in rows:
        g = (r.level, r.g1, r.g2)
        weight[g] += len(r.seq)
        size[g] += 1
        lone[g] = len(r.seq)
    assert max(r.level for r in rows) >= 2 and len(rows) == len({(r.k1, r.k2) for r in rows})
    assert all(w <= 30 or size[g] == 1 for g, w in weight.items())


def test_double_array_holds_every_sequence():
    from tripmart.llm.conversation_trie import DoubleArray
    rnd = np.random.default_rng(1)
    seqs = sorted({tuple(rnd.integers(1, rnd.choice([3, 40, 500]), rnd.integers(0, 9)).tolist()) for _ in range(400)})
    codes = np.array([c for s in seqs for c in s], np.int64)
    size = np.array([len(s) for s in seqs])
    trie = DoubleArray(codes, np.cumsum(size) - size, size)
    prefixes = {s[:d] for s in seqs for d in range(len(s) + 1)}
    assert int((trie.check[1:] >= 0).sum()) + 1 == len(prefixes)
    seen = {}
    for d, at, node in trie.walk():
        for i, t in zip(at.tolist(), node.tolist(), strict=True):
            assert seen.setdefault(t, seqs[i][:d]) == seqs[i][:d]
    assert len(seen) == len(prefixes)


def test_shards_of_any_size_tell_the_same(conv, monkeypatch):
    from tripmart.llm import conversation_trie as m
    monkeypatch.setattr(m, "GROUP", 12)
    t = m._dealt(m.sequences(conv)).select("level", "g1", "g2", "k1", "k2", "n", "low", "seq").sort("level", "g1", "g2", "k1").toArrow()
    told = []
    for shard in (1, 25, 1 << 20):
        monkeypatch.setattr(m, "SHARD", shard)
        rows = [r for b in m._pack(iter(t.to_batches(max_chunksize=7))) for r in b.to_pylist()]
        told.append(sorted(map(str, rows)))
    assert told[0] == told[1] == told[2]
