"""The prefix trie against a dictionary of all prefixes."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import prefixes

SCHEMA = "conv_id long, turn long, role string, text string"
CLASHING = ("c", "pos", "depth", "x", "y", "n", "h", "words", "digest", "weight", "leaves", "ids", "first")


def brute(rows, group: int = 20, heads: int = 4):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role or '')}:{role or ''}{text or ''}".encode()).hexdigest(), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    whole = {}
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % heads
        whole[conv] = own.get(conv - conv % group, [])[:h] + turns[h:]
    members = defaultdict(list)
    for conv, turns in whole.items():
        for depth in range(len(turns) + 1):
            members[tuple(turns[:depth])].append(conv)
    children, leaves, saved = Counter(k[:-1] for k in members if k), Counter(), Counter()
    for key, convs in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", key[-1][1])) if key else 0
        for depth in range(len(key) + 1):
            saved[key[:depth]] += (len(convs) - 1) * words
            leaves[key[:depth]] += key not in children
    out = []
    for key, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(whole[c]) == len(key))
        parent = min(members[key[:-1]]) if key else None
        out.append(
            (min(convs), len(key), parent, len(convs), children[key], leaves[key], saved[key], hashlib.sha256(ends.encode()).hexdigest())
        )
    return sorted(out)


def of(frame, **options):
    return sorted(map(tuple, prefixes.trie(frame, **options).collect()))


@pytest.fixture(scope="module")
def varied():
    """Shared openings, a hot conversation, a long one, nulls, equal turns, missing bases, negative ids."""
    rng, out = random.Random(5), []
    for conv in range(120):
        for turn in range(rng.randrange(1, 7)):
            out.append((conv, turn, rng.choice(["user", "assistant", None]), rng.choice(["a b", "c", "d  e\tf", "", None])))
    out += [(conv, turn, "user", f"hot {turn}") for conv in range(200, 280) for turn in range(4)]
    out += [(141, turn, "user", f"long {turn}") for turn in range(90)]
    out += [(300, None, "user", "null first"), (300, 0, "user", "zero"), (300, 1, "a", "tie"), (300, 1, "b", "tie"), (300, 1, "b", "tie")]
    out += [(-7, 0, "user", "minus"), (-20, 3, "user", "base"), (None, 0, "user", "nowhere")]
    out += [(401, 0, "user", "gone"), (403, 0, "user", "gone")]
    return out


@pytest.mark.parametrize("limit, band, most", [(None, 4096, 200_000), (6, 2, 3), (40, 1, 5), (1, 3, 2)])
def test_equals_dictionary(spark, varied, limit, band, most):
    # the remainder of a negative id is negative here, as in SQL
    frame = spark.createDataFrame([r for r in varied if (r[0] or 0) >= 0], SCHEMA)
    assert of(frame, limit=limit, band=band, most=most) == brute([r for r in varied if (r[0] or 0) >= 0])


def test_turnless_conversations_are_members_of_the_root(spark):
    lone = next(c for c in range(1000, 1100) if c % 20 and zlib.crc32(str(c).encode()) % 4)
    [root] = of(spark.createDataFrame([(lone, 0, "user", "x")], SCHEMA))
    assert root[:7] == (lone, 0, None, 1, 0, 1, 0)
    assert root[7] == hashlib.sha256(str(lone).encode()).hexdigest()


def test_negative_and_missing_ids(spark):
    rows = [(-7, 0, "user", "minus"), (-7, 1, "user", "more"), (None, 0, "user", "nowhere")]
    assert {r[0] for r in of(spark.createDataFrame(rows, SCHEMA))} == {-7}


def test_extra_columns_and_empty_table(spark, varied):
    rows = [r for r in varied if r[0] is not None and 0 <= r[0] < 30]
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in CLASHING:
        frame = frame.withColumn(name, F.lit("other"))
    assert of(frame) == brute(rows)
    assert of(spark.createDataFrame([], SCHEMA)) == []


def test_long_conversation_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "STRETCH", 16)
    rows = [(20, t, "user", f"t{t}") for t in range(100)] + [(40, t, "user", f"t{t}" if t < 77 else f"u{t}") for t in range(90)]
    assert of(spark.createDataFrame(rows, SCHEMA), limit=20, band=8) == brute(rows)


def test_queue_spills_and_sums():
    rng = random.Random(1)
    queue, want = prefixes.SpillingQueue(most=7), Counter()
    for _ in range(500):
        key = (rng.randrange(9), rng.randrange(9), 0)
        want[key] += 3
        queue.push(key, 1, 2)
    assert queue.runs
    for key in sorted(want):
        assert sum(queue.take(key)) == want[key]
    assert not queue.held and not queue.runs


def test_ends_in_short_lists_hash_alike(spark):
    import pyarrow as pa

    ids = list(range(95, 1205))
    batch = pa.RecordBatch.from_arrays([pa.array([1] * len(ids)), pa.array([2] * len(ids)), pa.array([3] * len(ids)), pa.array(ids)], names=["depth", "x", "y", "c"])
    lists = list(prefixes._ends(iter([batch]), size=40))
    assert sum(b.num_rows for b in lists) > 50
    [done] = [b for b in prefixes._hashes(iter(lists)) if b.num_rows]
    assert done.column("ends_sha256").to_pylist() == [hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()]
