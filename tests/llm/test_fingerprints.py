"""Order MinHash against a plain restatement, and what it promises about order, repeats and neighbours."""

import hashlib
import random
import re
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from paceline.llm import order_minhash as om

TOKEN = re.compile("[⺀-鿿가-힯豈-﫿\U00020000-\U0003ffff]|[^\x20\x09-\x0d⺀-鿿가-힯豈-﫿\U00020000-\U0003ffff]{1,16}")
MASK = (1 << 64) - 1


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def chained(*values):
    """Spark's 64-bit hash of several columns: each value is hashed with the hash before it as the seed."""
    h = 42
    for v in values:
        if v is not None:
            h = xxhash.xxh64(v.encode() if isinstance(v, str) else struct.pack("<q", v), seed=h & MASK).intdigest()
    return signed(h)


def fingerprint(text):
    words = [chained(w) for w in TOKEN.findall(text or "")]
    if not words:
        return []
    kmers = [chained(*words[i : i + om.K]) for i in range(len(words) - om.K + 1)] if len(words) >= om.K else None
    if kmers is None:
        # The fold starts at 42 as a value, not as a seed.
        h = 42
        for w in words:
            h = chained(h, w)
        kmers = [h]
    seen, items = {}, []
    for i, x in sorted(enumerate(kmers), key=lambda p: p[0]):
        top = x >> 30
        number = seen.get(top, 0)
        seen[top] = number + 1
        h = signed(xxhash.xxh64(struct.pack("<i", number), seed=chained(x) & MASK).intdigest())
        items.append((h >> 30, i))
    items.sort()
    n, out = len(items), []
    for j in range(om.COMPONENTS):
        anchor = ((j - om.COMPONENTS // 2) << (64 - 6)) >> 30
        at = next((i for i, (h, _) in enumerate(items) if h >= anchor), 0)
        places = sorted(items[(at + t) % n][1] for t in range(min(om.TUPLE, n)))
        h = 42
        for p in places:
            h = chained(h, kmers[p])
        out.append((h >> 32) & 0xFFFFFFFF)
    return out


def shown(marks):
    return "".join(f"{x:08x}" for x in marks)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice(["ba", "ko", "é", "ti", "na", "漢字", "𠀀", "x" * 40]) for _ in range(rng.randint(1, 3))) for _ in range(90)]
    text = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", "\n", "  ", "\t"]) for _ in range(n))
    out = [(i * 3 - 20, text(rng.randint(0, 60))) for i in range(150)]
    out += [(1000, "again and again " * 200), (1001, None), (1002, ""), (1003, " \n\t "), (1004, "one"), (1005, "two words"), (1006, text(6000)), (1000, "other"), (1000, "other"), (1000, "other"), (None, "no id"), (None, None), (5, out[9][1])]
    rng.shuffle(out)
    return out


def ordered(rows):
    return sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(r[1].encode()).hexdigest()))


def expected(rows):
    rows, out = ordered(rows), []
    for i, (d, t) in enumerate(rows):
        after = rows[(i + 1) % len(rows)][1]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        a, b, c = fingerprint(t), fingerprint(edited), fingerprint(after)
        near = lambda x, y: 1.0 if not x and not y else 0.0 if not x or not y else sum(p == q for p, q in zip(x, y, strict=True)) / len(x)
        out.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest(), shown(a), shown(b), near(a, b), near(a, c)))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(d, t, 1, "x", 2) for d, t in rows], "doc_id long, text string, marks int, next_text string, _block int").repartition(3)


def test_fingerprints_equal_brute_force(spark, rows):
    out = om.document_fingerprints(frame(spark, rows))
    assert out.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert sorted(map(tuple, out.collect()), key=repr) == expected(rows)


def test_blocks_with_many_rows_are_split_and_give_the_same(spark, rows):
    many = rows + [(7, "the same row again and again")] * 400 + [(None, f"no id {i % 50}") for i in range(300)]
    plain = om.with_next(frame(spark, many).select("doc_id", "text"), "doc_id", "text")
    found = sorted(((d, t or "", n or "") for d, t, n in plain.collect()), key=repr)
    order = [(d, t) for d, t in ordered(many)]
    pairs = sorted(((d, t, order[(i + 1) % len(order)][1]) for i, (d, t) in enumerate(order)), key=repr)
    assert found == pairs
    # No window holds the hot id: its rows stand in several blocks.
    text = plain._jdf.queryExecution().optimizedPlan().toString()
    assert "fine_copy" in text


def test_single_and_no_document(spark):
    one = om.document_fingerprints(spark.createDataFrame([(4, "abcdef")], "doc_id long, text string")).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abcabc").hexdigest() and one["near_next"] == 1.0
    assert om.document_fingerprints(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_order_and_small_edits(spark):
    rng = random.Random(5)
    words = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    blocks = [words[i : i + 20] for i in range(0, 400, 20)]
    moved = [w for b in rng.sample(blocks, len(blocks)) for w in b]
    edited = [*words[:200], "new", *words[200:]]
    data = [(0, " ".join(words)), (1, " ".join(edited)), (2, " ".join(moved)), (3, " ".join(words)), (4, " ".join(f"v{w}" for w in words))]
    marks = {r["i"]: r["m"] for r in om.fingerprinted(spark.createDataFrame(data, "i long, t string"), F.col("t"), "m").collect()}
    near = lambda a, b: sum(p == q for p, q in zip(marks[a], marks[b], strict=True)) / len(marks[a])
    assert marks[0] == marks[3] and near(0, 4) == 0
    # The moved text keeps four fifths of its k-mers, but of two minimal ones half change places.
    assert near(0, 1) > 0.85 and near(0, 2) < 0.6


def test_repeats_count(spark):
    data = [(0, "a b c d e f " * 3), (1, "a b c d e f " * 30)]
    a, b = (r["m"] for r in om.fingerprinted(spark.createDataFrame(data, "i long, t string"), F.col("t"), "m").orderBy("i").collect())
    assert a != b


def test_no_python_in_the_plan(spark, rows):
    plan = om.document_fingerprints(frame(spark, rows))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan
