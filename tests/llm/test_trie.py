"""The prefix trie against a plain dictionary, with a sketch that proves little, and on odd turns."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest

from flatweave.llm import trie

TURNS = "conv_id long, turn int, role string, text string, depth int, D0 string, `a.b` map<string,int>"
EMPTY = hashlib.sha256().hexdigest()


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(some)] for c, some in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - int(np.fmod(c, 100)), [])[:h] + turns[h:]
    return out


def expected(rows):
    convs = rebuilt(rows)
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    for node, some in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(some) - 1) * len(node[-1][1]) if node else 0
    out = []
    for node, some in members.items():
        ends = ",".join(str(c) for c in sorted(some) if len(convs[c]) == len(node))
        out.append((min(some), len(node), min(members[node[:-1]]) if node else None, len(some),
                    children[node], leaves[node], saved[node],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return out


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    out = []
    for c in [*range(0, 260, 3), *range(1, 40, 4), 200, 1000000007, -5, -100, -203, 305, 399]:
        n = int(rng.integers(1, 9))
        for t in range(n):
            out.append((c, t if c % 7 else None, ("user", "assistant", None)[t % 3],
                        f"turn {rng.integers(0, 2)} é𝄞" if t else "hello"))
    out += [(c, t, "user", f"long {t % 3}") for c in (3000, 3001) for t in range(40)]
    out += [(500 + i, 0, None, None) for i in range(5)] + [(600, None, "", "x")] * 3
    out += [(None, 1, "user", "lost"), (None, None, None, None), (700, 2, "b", "x"), (700, 2, "a", "y")]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, 9, "z", {"k": 1}) for r in rows], TURNS).repartition(3)


@pytest.mark.parametrize("cells", [trie.MOST_CELLS, 64, 1024])
def test_nodes_equal_a_plain_trie(spark, rows, cells, monkeypatch):
    if cells < 1024:
        monkeypatch.setattr(trie, "sketch_width", lambda prefixes, most: most)
    found = trie.prefix_trie(frame(spark, rows), cells)
    assert ordered(found.collect()) == ordered(expected(rows))


def test_parts_of_one_conversation_and_of_one_list(spark, rows, monkeypatch):
    monkeypatch.setattr(trie, "TURNS_PER_BUCKET", 3)
    monkeypatch.setattr(trie, "CHUNK_BYTES", 8)
    some = [(r[0], 0 if r[1] is None else r[1], *r[2:]) for r in rows]
    some = list({r[:2]: r for r in some}.values())
    assert ordered(trie.prefix_trie(frame(spark, some)).collect()) == ordered(expected(some))


def test_empty_and_turnless(spark):
    assert trie.prefix_trie(frame(spark, [])).collect() == []
    assert trie.prefix_trie(frame(spark, [(None, 1, "a", "b")])).collect() == []
    short = [c for c in range(1, 99) if zlib.crc32(str(c).encode()) % 6 > 0]
    rows = [(c, 0, "user", "hi") for c in short]  # no head: nothing is left of any
    assert ordered(trie.prefix_trie(frame(spark, rows)).collect()) == ordered(expected(rows))
    assert len(expected(rows)) == 1


def test_one_conversation_a_thousand_times(spark):
    rows = [(c, t, "user", f"t{t}" if c % 3 else f"{c} {t}") for c in range(1, 1200) for t in range(8)]
    assert ordered(trie.prefix_trie(frame(spark, rows)).collect()) == ordered(expected(rows))


def test_the_sketch_counts_never_too_few(spark, rows):
    paths = trie.paths_of(trie.with_heads(trie.hashed_turns(frame(spark, rows)))[0])
    times = defaultdict(int)
    for r in paths.collect():
        times[r.d0, r.d1] += 1
    for width in (64, 1 << 12):
        alone = [(r.d0, r.d1) for r in trie.screened(paths, width).where("alone").collect()]
        assert all(times[x] == 1 for x in alone)
    assert len(alone) >= 0.95 * sum(n == 1 for n in times.values())
    assert [trie.sketch_width(n) for n in (0, 1, 300, 1 << 40)] == [1024, 1024, 2048, trie.MOST_CELLS]
    cells = np.arange(64) % 3
    assert (trie.unpack(trie.pack(cells.astype(np.uint8))) == cells).all()
