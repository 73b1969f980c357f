"""The trie against one built in memory, with small shards, blocks and queues."""

import hashlib
import random
import re
import zlib

import pytest

from quotelift.llm import prefix_trie
from quotelift.llm.prefix_trie import SpillingQueue

SCHEMA = "conv_id long, turn long, role string, text string, depth int, k1 string, len int"


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn, role or "", text or ""))
    for turns in convs.values():
        turns.sort(
            key=lambda t: (t[0] is not None, t[0] or 0, hashlib.sha256(f"{len(t[1])}:{t[1]}{t[2]}".encode()).hexdigest())
        )
    made = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        first = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        made[c] = tuple(t[1:] for t in convs.get(first, [])[:h] + turns[h:])
    nodes = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    out = []
    for path, members in nodes.items():
        below = [p for p in nodes if p[: len(path)] == path]
        leaves = sum(not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below) for p in below)
        words = [len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0 for p in below]
        ends = ",".join(str(c) for c in sorted(members) if len(made[c]) == len(path))
        out.append(
            (
                min(members),
                len(path),
                min(nodes[path[:-1]]) if path else None,
                len(members),
                sum(len(p) == len(path) + 1 for p in below),
                leaves,
                sum((len(nodes[p]) - 1) * w for p, w in zip(below, words, strict=True)),
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def run(spark, rows, **options):
    frame = spark.createDataFrame([(*r, 1, "k", 2) for r in rows], SCHEMA)
    return sorted([tuple(r) for r in prefix_trie.trie(frame, **options).collect()], key=repr)


def conversations(seed):
    rng = random.Random(seed)
    rows = []
    for c in [*range(45), 60, 63, -3, -20, -21, 1007]:
        for turn in range(rng.randint(1, 6)):
            rows.append((c, turn if rng.random() < 0.9 else None, rng.choice(["user", None, ""]), rng.choice(["a b", "a", "", None])))
    # one conversation that many share, one that is far longer than the others
    rows += [(c, t, "user", f"w{t} same") for c in range(200, 300) for t in range(5)]
    rows += [(5000, t, "user", f"long {t}") for t in range(90)] + [(5001, t, "user", f"long {t}") for t in range(70)]
    rows += [(None, 1, "user", "lost"), (7, 1, "user", "again"), (7, 1, "user", "again"), (8, 2, "u", "tie"), (8, 2, "v", "tie")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shard_turns", [7, 40, 1 << 16])
def test_equals_a_trie_in_memory(spark, shard_turns, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 16)
    monkeypatch.setattr(prefix_trie, "CHUNK", 64)
    rows = conversations(shard_turns)
    assert run(spark, rows, shard_turns=shard_turns, queue=3) == brute(rows)


def test_turnless_conversations_end_at_the_root(spark):
    ids = [c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 > 1]
    rows = [(c, 0, "user", "only turn") for c in ids]  # the first of their twenty is absent
    got = run(spark, rows)
    assert got == brute(rows) and len(got) == 1 and got[0][3] == len(ids)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_queue_gives_back_in_order_what_it_spilled():
    rng = random.Random(3)
    queue, want, got = SpillingQueue(limit=10), [], []
    for _ in range(500):
        item = (rng.randint(0, 50), rng.random())
        queue.push(item)
        want.append(item)
        if rng.random() < 0.3:
            least = queue.least()
            assert least == min(want)
            want.remove(queue.pop())
    while queue.least() is not None:
        got.append(queue.pop())
    assert got == sorted(want) and queue.spilled > 100
