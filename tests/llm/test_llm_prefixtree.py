import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from conftest import rows

from tidemark.llm import prefixtree
from tidemark.llm.prefixtree import prefix_tree

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(turns):
    """The contract by prefixes in a dictionary; rows of one turn must be equal."""
    own = defaultdict(list)
    for c, turn, role, text in sorted(turns, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0)):
        if c is not None:
            own[c].append((role or "", text or ""))
    rebuilt = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        rebuilt[c] = tuple(own.get(base, [])[:h] + v[h:])
    nodes = defaultdict(list)
    for c, v in rebuilt.items():
        for d in range(len(v) + 1):
            nodes[v[:d]].append(c)
    children, leaves, saved = Counter(n[:-1] for n in nodes if n), Counter(), Counter()
    for n, members in nodes.items():
        for d in range(len(n) + 1):
            saved[n[:d]] += (len(members) - 1) * len(n[-1][1]) if n else 0
            leaves[n[:d]] += not children[n]
    out = []
    for n, members in nodes.items():
        ended = ",".join(str(c) for c in sorted(members) if len(rebuilt[c]) == len(n))
        parent = min(nodes[n[:-1]]) if n else None
        digest = hashlib.sha256(ended.encode()).hexdigest()
        out.append((min(members), len(n), parent, len(members), children[n], leaves[n], saved[n], digest))
    return sorted(out, key=repr)


def tree(spark, turns):
    return rows(prefix_tree(spark.createDataFrame(turns, SCHEMA)).drop("nx", "ny"))


def test_small_conversations(spark):
    turns = [(c, t, "user" if t % 2 == 0 else "assistant", f"say {(c * t) % 3}") for c in range(90, 125) for t in range(c % 7)]
    turns += [(200 + c, t, "user", f"say {t}") for c in range(100) for t in range(1 + c % 4)]
    turns += [(-250, 0, "user", "say 0"), (-200, 0, "user", "say 0"), (-200, 1, "user", "é👍")]
    assert tree(spark, turns) == plain(turns)


def test_missing_and_repeated_values(spark):
    turns = [(1, None, None, "a"), (1, 0, "user", None), (1, 0, "user", None), (None, 0, "user", "lost"), (101, 5, "", ""), (101, 6, None, None)]
    turns += [(100, -3, "user", "x" * 200_000), (102, -3, "user", "x" * 200_000), (2**62, 0, "user", ""), (-(2**62), 2**63 - 1, "user", "")]
    assert tree(spark, turns) == plain(turns)


def test_families_without_a_first_conversation_and_turnless_members(spark):
    turns = [(c, t, "user", "same") for c in range(301, 360) for t in range(2)]
    expected = plain(turns)
    assert tree(spark, turns) == expected
    root = next(r for r in expected if r[1] == 0)
    assert root[3] == 59 and root[7] != hashlib.sha256().hexdigest()  # some have lost all their turns


def test_long_conversations_go_on_in_further_rows(spark, monkeypatch):
    monkeypatch.setattr(prefixtree, "SPAN", 4)  # so that spans are joined up too
    turns = [(c, t, "user", f"say {t % 5}") for c in (0, 5, 7, 100, 107) for t in range(70 + c % 9)]
    turns += [(c, t, "user", f"say {t % 5 if t < 40 else c}") for c in range(10, 20) for t in range(45)]
    turns += [(30, t, "user", "") for t in range(8)] + [(31, t, "user", "") for t in range(16)]
    assert tree(spark, turns) == plain(turns)


def test_copies_and_one_large_conversation(spark):
    turns = [(c, t, "user", "all alike") for c in range(1000) for t in range(3)] + [(2000, t, "user", f"{t // 2}") for t in range(1500)]
    assert tree(spark, turns) == plain(turns)


def test_empty_table_and_other_columns(spark):
    assert tree(spark, []) == []
    extra = spark.createDataFrame([(1, 0, "user", "a", 7, b"x", 9)], SCHEMA + ", pos long, id binary, blk long")
    assert rows(prefix_tree(extra).drop("nx", "ny")) == plain([(1, 0, "user", "a")])


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_given_conversations(spark, sf):
    df = spark.read.parquet(f"/root/testdata/{sf}/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert rows(prefix_tree(df).drop("nx", "ny")) == plain([tuple(r) for r in df.collect()])
