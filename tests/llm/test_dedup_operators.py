from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import decontaminate, exact_dedup, simhash, substring

from .helpers import corpus, passage, plain, table


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]", "", t or "")


@pytest.mark.parametrize("bits", [64, 2])
def test_exact_dedup_is_brute_force(spark, bits):
    """Two bits for an identifier make nearly all chunks share one, so that ordinals decide."""
    groups = defaultdict(list)
    for i, t, *_ in corpus():
        groups[norm(t)].append((-len(t or ""), i is None, i or 0, i))
    want = [(i, min(groups[norm(t)])[3], len(groups[norm(t)]), i == min(groups[norm(t)])[3], hashlib.sha256(norm(t).encode()).hexdigest()) for i, t, *_ in corpus()]
    got = exact_dedup.exact_dedup(table(spark), id_bits=bits, min_chars=8, max_chars=40).drop("n_chunks")
    assert plain(got.collect()) == plain(want)


def test_exact_dedup_of_nothing_and_of_clashing_names(spark):
    assert exact_dedup.exact_dedup(table(spark, [])).count() == 0
    odd = table(spark).withColumnsRenamed({"lang": "recipe", "source": "n"}).withColumn("norm", F.lit(1))
    assert exact_dedup.exact_dedup(odd).count() == len(corpus())


def test_exact_dedup_of_very_long_and_other_scripts(spark):
    rng = __import__("random").Random(6)
    say = lambda a, n: "".join(chr(a + rng.randrange(80)) + " " * (rng.random() < 0.2) for _ in range(n))
    long, greek, han = say(0x41, 200_000), say(0x391, 9_000), say(0x4E00, 9_000)
    rows = [(1, long), (2, long.replace(" ", "\n")), (3, long[:-1]), (4, greek), (5, greek + " "), (6, han), (7, " " + han), (8, han[5:])]
    got = exact_dedup.exact_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    groups = defaultdict(list)
    for i, t in rows:
        groups[norm(t)].append((-len(t), i))
    assert sorted((r.doc_id, r.keep_id, r.group_size) for r in got) == sorted((i, min(groups[norm(t)])[1], len(groups[norm(t)])) for i, t in rows)


def fingerprint(t):
    words = (t or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_components_are_brute_force(spark):
    rows = corpus()
    codes = [fingerprint(t) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (codes[a] ^ codes[b]).bit_count() <= 2:
                root[find(a)] = find(b)
    least = {}
    for k, (i, *_) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    want = [(i, f"{codes[k]:016x}", least.get(find(k))) for k, (i, *_) in enumerate(rows)]
    got = simhash.near_duplicates(table(spark)).select("doc_id", simhash.hexed(F.col("fp")), "component_id")
    assert plain(got.collect()) == plain(want)
    assert len({w[2] for w in want}) < len(rows) - 8


@pytest.mark.parametrize("bucket", [64, 2])
def test_links_connect_what_two_bits_connect(spark, bucket):
    """A bucket of two sends nearly all fingerprints the way without pairs."""
    import random

    r = random.Random(4)
    codes = {r.getrandbits(64) for _ in range(20)}
    for c in list(codes):
        for _ in range(12):
            c ^= 1 << r.randrange(64)
            c ^= (1 << r.randrange(64)) if r.random() < 0.7 else 0
            codes.add(c)
    signed = [c - (1 << 64) * (c >> 63) for c in codes]
    from millrace.operators.graph import connected_components

    found = simhash.links(spark.createDataFrame([(c,) for c in signed], "fp long"), bucket)
    roots = {x.node: x.root for x in connected_components(found).collect()}
    near = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2}
    assert near and all(roots[a] == roots[b] for a, b in near)
    assert all(((x.src ^ x.dst) & ((1 << 64) - 1)).bit_count() <= 2 for x in found.collect())
    assert set(roots) == {x for pair in near for x in pair}
    if bucket == 64:
        assert {tuple(sorted(x)) for x in near} == {(x.src, x.dst) for x in found.collect()}


def test_simhash_of_nothing_and_of_clashing_names(spark):
    assert simhash.near_duplicates(table(spark, [])).count() == 0
    odd = table(spark).withColumnsRenamed({"lang": "fp", "source": "value"}).withColumn("segment", F.lit(1)).withColumn("id", F.lit("x"))
    assert simhash.near_duplicates(odd).count() == len(corpus())


@pytest.mark.parametrize("bucket", [64, 3])
def test_near_copies_are_found_and_others_left_alone(spark, bucket):
    """Copies with some words changed, of 0.85 and more by their sets of five words, against brute force."""
    import random

    r = random.Random(7)
    rows = [(i, passage(900 + i, 200), None, None, None) for i in range(40)]
    for i in range(40, 90):
        words = rows[i % 10][1].split()
        for _ in range(r.randint(0, 3)):
            words[r.randrange(len(words))] = "changed"
        rows.append((i, " ".join(words), None, None, None))
    rows += [(100, None, None, None, None), (101, "", None, None, None), (None, rows[3][1], None, None, None)]
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t, *_ in rows[:90]}
    got = {x.doc_id: x.component_id for x in simhash.near_copies(table(spark, rows), bucket=bucket).collect()}
    like = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.9]
    assert len(like) > 60 and sum(got[a] == got[b] for a, b in like) / len(like) > 0.95
    assert len({got[i] for i in range(40)}) == 40 and all(got[i] == i for i in range(10, 40))
    assert got[100] == got[101] == 100 and got[None] == got[3]
    assert simhash.near_copies(table(spark, [])).count() == 0


@pytest.mark.parametrize(("bucket", "block"), [(16, 2048), (1, 2048), (1, 7)])
def test_near_copies_connect_what_every_pair_of_a_segment_value_connects(spark, bucket, block):
    """Unlike texts of one boilerplate crowd the segment values, whose least is then near to few of them.

    A bucket of one sends every shared value the way of the crowded, a block of seven divides those.
    """
    import random

    import numpy as np

    r = random.Random(12)
    shared = passage(800, 120)
    texts = []
    for i in range(60):
        words = (shared + " " + passage(1000 + i, 55)).split()
        for _ in range(r.randint(1, 5)):
            words = list(words)
            words[r.randrange(len(words))] = f"changed{r.randrange(99)}"
            texts.append(" ".join(words))
    bits = np.array([simhash.long_fingerprint(t.encode(), 5) for t in texts])
    size = simhash.segment_bits(len(texts))
    cut = bits[:, : bits.shape[1] // size * size].reshape(len(texts), -1, size)
    least = list(range(len(texts)))
    for a in range(len(texts)):
        for b in range(a):
            if (cut[a] == cut[b]).all(1).any() and (bits[a] != bits[b]).sum() <= simhash.bits_at(0.8):
                least = [min(least[a], least[b]) if x in (least[a], least[b]) else x for x in least]
    got = simhash.near_copies(table(spark, [(i, t, None, None, None) for i, t in enumerate(texts)]), bucket=bucket, **({} if block == 2048 else {"block": block}))
    assert 20 < len(set(least)) < len(texts) - 40
    assert dict(got.collect()) == dict(enumerate(least))


def removal(rows):
    starts = defaultdict(set)
    for i, t, *_ in rows:
        words = (t or "").encode().split()
        for k in range(len(words) - 12):
            starts[tuple(words[k : k + 13])].add(i if i is not None else 1 << 62)
    out = []
    for i, t, *_ in rows:
        words = (t or "").encode().split()
        gone = {j for k in range(len(words) - 12) if min(starts[tuple(words[k : k + 13])]) < (i if i is not None else 1 << 62) for j in range(k, k + 13)}
        kept = b" ".join(w for j, w in enumerate(words) if j not in gone)
        out.append((i, len(words), len(gone), kept.decode()))
    return out


def test_substring_dedup_is_brute_force(spark):
    got = substring.substring_dedup(table(spark), shards=5).select("doc_id", "n_words", "n_removed", "kept_text")
    want = removal(corpus())
    assert plain(got.collect()) == plain(want) and sum(w[2] for w in want) > 6000
    assert substring.substring_dedup(table(spark, [])).count() == 0


def test_substring_dedup_of_clashing_names_and_many_null_ids(spark):
    rows = [*corpus(), *[(None, passage(70 + i % 3, 40), None, None, None) for i in range(30)]]
    odd = table(spark, rows).withColumnsRenamed({"lang": "shard", "source": "bucket"}).withColumn("id", F.lit("x"))
    got = substring.substring_dedup(odd, shards=5).select("doc_id", "n_words", "n_removed", "kept_text")
    assert plain(got.collect()) == plain(removal(rows))
    with pytest.raises(TypeError):
        substring.substring_dedup(table(spark).withColumn("doc_id", F.concat(F.lit("d"), "doc_id")))


def test_substring_history_acts_as_one_table(spark):
    """Runs of three batches, kept with different numbers of buckets and small pieces, then a fourth against them."""
    rows = corpus()
    history = None
    for part, buckets in ((rows[:7], 4), (rows[7:11], 2), (rows[11:15], 7)):
        history = substring.index_runs(table(spark, part), buckets=buckets, shards=3, history=history)
    got = substring.substring_dedup(table(spark, rows[15:]), history=history, buckets=5, shards=3).select("doc_id", "n_words", "n_removed", "kept_text")
    assert plain(got.collect()) == plain(removal(rows)[15:])
    assert history.select("kind", "bucket").distinct().count() == history.count() <= 14


@pytest.mark.parametrize("fractions", [(), (0.3,), (0.2, 0.5, 0.8)])
def test_batches_act_as_one_table(spark, fractions):
    got = substring.incremental_dedup(table(spark), fractions=fractions).select("doc_id", "n_words", "n_removed", "kept_text")
    assert plain(got.collect()) == plain(removal(corpus()))
    assert substring.incremental_dedup(table(spark, []), fractions=fractions).count() == 0


def folded(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))


@pytest.mark.parametrize("block_words", [1_000_000, 20])
def test_decontamination_is_brute_force(spark, block_words):
    items = [(3, passage(1, 20)), (20, passage(7, 30)), (5, "A b"), (None, passage(105, 12)), (6, ""), (7, None), (8, "a"), (3, passage(2, 9))]
    windows = defaultdict(set)
    for item, t in items:
        words = folded(t)
        for k in range(max(1, len(words) - 7)) if words else ():
            windows[tuple(words[k : k + 8])].add(item)
    want = []
    for i, t, *_ in corpus():
        words, hit, found = folded(t), set(), set()
        for n in {len(w) for w in windows}:
            for k in range(len(words) - n + 1):
                owners = windows.get(tuple(words[k : k + n]))
                if owners:
                    hit |= set(range(k, k + n))
                    found |= owners
        ids = sorted(str(x) for x in found if x is not None)
        want.append((i, len(words), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), len(ids) >= 2))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.digest(decontaminate.decontaminate(table(spark), bench, block_words=block_words))
    assert plain(got.collect()) == plain(want) and any(w[5] for w in want)
    assert decontaminate.decontaminate(table(spark), bench.limit(0)).filter("n_hit > 0").count() == 0
    assert decontaminate.decontaminate(table(spark, []), bench, block_words=block_words).count() == 0
    odd = table(spark).withColumnsRenamed({"lang": "row", "source": "spans"}).withColumn("id", F.lit("x")).withColumn("items", F.lit(1))
    assert decontaminate.decontaminate(odd, bench, block_words=block_words).count() == len(corpus())


def test_a_block_stays_within_forty_bytes_a_word():
    import pickle
    import random

    r = random.Random(3)
    items = [(str(k), [b"%x" % r.randrange(1 << 28) for _ in range(200)]) for k in range(500)]
    block = decontaminate.Block(items, 8)
    assert len(pickle.dumps(block)) < 50 * 100_000
    words = [b"x"] * 50 + items[7][1][100:120] + [b"y"] * 9 + items[9][1][:7] + [b"z"] * 9 + items[11][1][:8]
    assert block.scan(words) == ([(50, 70), (95, 103)], ["11", "7"])
