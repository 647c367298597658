"""op11, op12 and op13: SQL on the driver's tables, brute force and edge rows on small ones."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tablewright.llm import mixing, prefix_trie, shared_queries, spelling
from tests.oracle import connect, differences

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_source_mix", "op13_spelling_variants"])
def test_against_sql(spark, name):
    from tablewright.llm.queries import ORACLES, QUERIES

    assert differences(connect(SMALL), QUERIES[name](spark, SMALL), ORACLES[name]) == ""


# ------------------------------------------------------------------ op11


def plain_trie(sequences: dict[int, tuple]) -> dict:
    members = defaultdict(list)
    for key, s in sequences.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(key)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)

    def sums(p):
        own = (len(members[p]) - 1) * len(p[-1][1].split()) if p else 0
        below = [sums(c) for c in children[p]]
        return sum(x for x, _ in below) if below else 1, own + sum(y for _, y in below)

    out = {}
    for p, keys in members.items():
        ends = ",".join(str(k) for k in sorted(keys) if len(sequences[k]) == len(p))
        out[len(p), min(keys)] = (
            min(members[p[:-1]]) if p else None, len(keys), len(children[p]), *sums(p), hashlib.sha256(ends.encode()).hexdigest()
        )
    return out


def nodes(spark, sequences):
    rows = [(k, i + 1, *t, 7) for k, s in sequences.items() for i, t in enumerate(s)]
    turns = spark.createDataFrame([*rows, (None, 1, "a", "b", 0)], "conv_id long, pos long, role string, text string, depth long")
    keys = spark.createDataFrame([(k,) for k in [*sequences, None]], "seq long")
    words = F.size(F.filter(F.split("text", " "), lambda w: w != ""))
    got = prefix_trie.trie(prefix_trie.symbols(turns, "conv_id", "pos", ["role", "text"], words), keys).collect()
    found = {(r["depth"], r["conv_id"]): tuple(r[c] for c in ("parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")) for r in got}
    assert len(found) == len(got)
    return found


def test_trie_by_brute_force(spark):
    draw = random.Random(3)
    turns = [("u", "a b"), ("a", "a b"), ("u", "c"), ("ua", " b"), ("u", "")]
    sequences = {-7: (), 8: (), 4096: tuple(turns[:2]), 3: tuple(turns[:2])}
    for k in range(60):
        sequences[k * 977 % 5000] = tuple(draw.choice(turns[: 2 + k % 4]) for _ in range(draw.randrange(0, 12)))
    for k in (5001, 5002):  # one long branch beside equal ones
        sequences[k] = (turns[0],) * 37
    assert nodes(spark, sequences) == plain_trie(sequences)


def test_trie_of_one_key_and_of_none(spark):
    assert nodes(spark, {5: ()}) == plain_trie({5: ()})
    one = {5: (("u", "a"), ("u", "a"), ("u", "b"))}
    assert nodes(spark, one) == plain_trie(one)
    assert nodes(spark, {}) == {}


def test_rebuilt_conversations(spark):
    rows = [(c, t, "u" if t else None, f"{c} {t}" if c != 21 else "x", 0) for c in (0, 1, 2, 21, 22, 45, -3) for t in (None, 2, 1, 1)]
    table = spark.createDataFrame([*rows, (None, 1, "u", "x", 0)], "conv_id long, turn long, role string, text string, pos int")
    turns, keys = shared_queries.rebuilt(table)
    got = defaultdict(dict)
    for r in turns.collect():
        assert r["pos"] not in got[r["conv_id"]]
        got[r["conv_id"]][r["pos"]] = (r["role"], r["text"])
    own = defaultdict(list)
    for c, t, role, text, _ in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3])):
        own[c].append((role or "", text))
    assert sorted(r["seq"] for r in keys.collect()) == sorted(own)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        want = (own[base][:h] if base in own else []) + own[c][h:]
        assert [got[c][i + 1] for i in range(len(got[c]))] == want


def test_digest_of_many_keys(spark):
    members = spark.range(-5000, 9000).select(F.lit(1).cast("bigint").alias("group"), F.col("id").alias("key"))
    members = members.unionAll(spark.range(3).select(F.lit(2).cast("bigint"), F.col("id")))
    got = {r["group"]: r["sha256"] for r in prefix_trie.key_digests(members).collect()}
    digest = lambda keys: hashlib.sha256(",".join(map(str, keys)).encode()).hexdigest()
    assert got == {1: digest(range(-5000, 9000)), 2: digest(range(3))}


# ------------------------------------------------------------------ op12


def test_permutations(spark):
    for n in (1, 2, 3, 97, 1000):
        keys = mixing.round_keys(F.lit(n).cast("bigint"), F.lit(5).cast("bigint"))
        got = [r[0] for r in spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("bigint"), keys)).collect()]
        assert sorted(got) == list(range(n)) and (n < 97 or got != sorted(got))


def test_targets(spark):
    sizes = {"a": 100, "b": 10, "c": 1000, "d": 7, None: 383}
    rows = spark.createDataFrame([(i, s, n) for i, (s, n) in enumerate(sizes.items())], "key long, source string, size long")
    got = {r["source"]: r["target"] for r in mixing.targets(rows).collect()}
    # b and d stop at three times their size, and so does a after the first sharing.
    assert got["b"] == 30 and got["d"] == 21 and got["a"] + got["c"] + got[None] == pytest.approx(1449)
    left = 1500 - 51
    want = {"a": left / 6, "c": left * 3 / 6, None: left * 2 / 6}
    assert {s: got[s] for s in want} == pytest.approx(want)


def test_mix_of_odd_rows(spark):
    rows = [(1, "x", "a b " * 500), (1, "x", "a b " * 500), (None, None, "c " * 300), (None, None, "d e " * 300), (2, "y", None), (3, "y", ""), (4, "z", "w " * 5000)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, source string, text string, size int, idx int")
    got = mixing.mixed(docs).collect()
    assert sorted((r["doc_id"] or 0, r["size"]) for r in got) == [(0, 300), (0, 300), (1, 1000), (1, 1000), (2, 0), (3, 0), (4, 5000)]
    by_source = defaultdict(lambda: [0.0, 0])
    for r in got:
        assert r["taken"] <= 3 * r["size"]
        by_source[r["source_size"]][0] = r["target"]
        by_source[r["source_size"]][1] += r["taken"]
    for target, taken in by_source.values():
        assert abs(target - taken) <= 1.5 * mixing.BLOCK
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mixed(docs.repartition(5)).collect()), key=str)
    assert mixing.mixed(docs.limit(0)).count() == 0
    none = mixing.mixed(docs.filter("doc_id in (2, 3)")).collect()
    assert [(r["target"], r["taken"]) for r in none] == [(0.0, 0), (0.0, 0)]


def test_slots_use_every_block_once_an_epoch(spark):
    rows = spark.createDataFrame([(i, "abc"[i % 3], 40 * i) for i in range(200)], "key long, source string, size long")
    sources = mixing.targets(rows)
    slots = mixing.slots(sources, block=16, shard=64).collect()
    places = sorted((s["shard"], s["place"]) for s in slots)
    assert places == [(i // 64, i % 64) for i in range(len(slots))]
    full = {r["idx"]: (r["n_blocks"], r["full"]) for r in mixing.quotas(sources, 16).collect()}
    for idx, (n, epochs) in full.items():
        for e in range(4):
            blocks = [s["block"] for s in slots if s["idx"] == idx and s["epoch"] == e]
            assert len(set(blocks)) == len(blocks) and (e >= epochs or len(blocks) == n)


def test_mix_stays_in_the_jvm(spark):
    docs = spark.createDataFrame([(1, "x", "a b")], "doc_id long, source string, text string")
    plan = mixing.mixed(docs)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


# ------------------------------------------------------------------ op13


def plain_variants(docs):
    counts = Counter()
    for ident, text in docs:
        lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
        run = ""
        for c in lowered + " ":
            if "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c
                continue
            if run:
                h = zlib.crc32(f"{'' if ident is None else ident}:{run}".encode())
                word = run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run
                counts[word] += 1
            run = ""
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        if len(a) > len(b):
            a, b = b, a
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    form = {}
    out = {}
    for w, n in words.items():
        others = sorted(((-words[o], o) for o in words if o != w and near(w, o)))
        form[w] = others[0][1] if others and -others[0][0] >= 2 * n else None
        out[w] = [n, len(others), form[w], words.get(form[w])]
    for w in words:
        last = w
        while form[last]:
            last = form[last]
        out[w].append(last)
    return {w: tuple(v) for w, v in out.items()}


def got_variants(docs):
    rows = spelling.variants(docs).collect()
    out = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("cell", [8192, 40])
def test_variants_by_brute_force(spark, monkeypatch, cell):
    monkeypatch.setattr(spelling, "CELL_ROWS", cell)
    draw = random.Random(5)
    base = ["".join(draw.choice("abcé×") for _ in range(draw.randrange(4, 8))) for _ in range(60)]
    docs = []
    for i in range(60):
        words = []
        for _ in range(120):
            w = draw.choice(base[: 5 + i])
            if draw.random() < 0.4:
                at = draw.randrange(len(w))
                w = draw.choice([w[:at] + w[at + 1 :], w[:at] + draw.choice("abcEÉ") + w[at:], w[:at] + "b" + w[at + 1 :], w[::-1]])
            words.append(w.upper() if draw.random() < 0.1 and w.isascii() else w)
        docs.append((draw.choice([i, i, None]), draw.choice([" ", "Ā", "1"]).join(words)))
    long = "x" * 70_000
    docs += [(900, None), (901, ""), (902, f"{long} {long}a {long[1:]}b " * 3), (902, f"{long} " * 9), (902, "ab abc abcd")]
    table = spark.createDataFrame([(*d, "w", 1) for d in docs], "doc_id long, text string, word string, n int")
    assert got_variants(table) == plain_variants(docs)


def test_chains_of_forms(spark):
    words = {"aaaaa": 3, "aaaab": 6, "aaabb": 12, "aabbb": 24, "abbbb": 48, "bbbbb": 96}
    text = " ".join(w for w, n in words.items() for _ in range(n))
    table = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = got_variants(table)
    assert got == plain_variants([(1, text)]) and got["aaaaa"][4] == "bbbbb"
    assert got_variants(table.limit(0)) == {}
