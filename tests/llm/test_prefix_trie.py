import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from cardwarden.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, a int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    """The contract with a dictionary from path to members."""
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[c].append((turn is not None, turn or 0, tie, (role, text)))
    own = {c: [t[3] for t in sorted(ts)] for c, ts in own.items()}
    made = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        made[c] = own.get(base, [])[:h] + ts[h:]
    members = defaultdict(list)
    for c in sorted(made):
        for d in range(len(made[c]) + 1):
            members[tuple(made[c][:d])].append(c)
    out = []
    for path, mine in members.items():
        below = [p for p in members if p[: len(path)] == path]
        children = [p for p in below if len(p) == len(path) + 1]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below)]
        saved = sum((len(members[p]) - 1) * len(WORD.findall(p[-1][1])) for p in below if p)
        ends = ",".join(str(c) for c in mine if made[c] == list(path))
        parent = min(members[path[:-1]]) if path else None
        out.append((mine[0], len(path), parent, len(mine), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(spark, rows, parts=3):
    turns, convs = prefix_trie.rebuilt(spark.createDataFrame(rows, SCHEMA).repartition(parts))
    return sorted([tuple(r[c] for c in COLUMNS) for r in prefix_trie.prefix_trie(turns, convs).collect()], key=repr)


def threads(rng, convs, longest, hot=0):
    rows = []
    for c in convs:
        n = rng.randrange(0, longest)
        for t in range(n):
            text = "hello there" if t == 0 and rng.random() < 0.6 else rng.choice([None, "", "yes", "no no", "a\tb c", "é ü"])
            rows.append((c, rng.choice([None, 0]) if t == 0 else t, rng.choice(["user", "user", None]), text, "x", 1))
    for c in range(1000, 1000 + hot):
        rows += [(c, t, "user", f"same {t}", "x", 1) for t in range(5)]
    return rows


@pytest.mark.parametrize("segment,shard", [(256, 2048), (3, 7)])
def test_against_brute_force(spark, monkeypatch, segment, shard):
    monkeypatch.setattr(prefix_trie, "SEGMENT", segment)
    monkeypatch.setattr(prefix_trie, "SHARD", shard)
    rows = threads(random.Random(5), [*range(-25, 60), 200, 219], 7, hot=60)
    rows += [(300, t, "user", f"long {t // 2}", "x", 1) for t in range(17)] + [(301, t, "user", f"long {t // 2}", "x", 1) for t in range(13)]
    rows += rows[:20] + [(None, 1, "user", "no conversation", "x", 1)]
    rows.append((320, 0, "user", "very long " * 100_000, "x", 1))
    assert got(spark, rows) == brute(rows)


def test_segments_hold_one_long_conversation_in_parts(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SEGMENT", 8)
    rows = [(1, t, "user", f"word {t}", "x", 1) for t in range(90)] + [(2, t, "user", f"word {t}", "x", 1) for t in range(70)] + [(4, 0, "user", "word 0", "x", 1)]
    found = got(spark, rows)
    assert found == brute(rows) and len({r[1] for r in found}) == 88


def test_empty_and_end_lists_longer_than_a_row(spark):
    assert got(spark, []) == []
    rows = [(c, 0, "user", "hello", "x", 1) for c in range(1300)]
    found = got(spark, rows, 5)
    assert found == brute(rows) and found[0][3] == 1300
