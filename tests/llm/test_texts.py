"""op3, op4, op5 and op9 against brute force on small tables."""

import random
import re
import time
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from tablewright.llm import components, decontaminate, jaccard, licenses, quality
from tablewright.llm.common import stored
from tests.oracle import connect, differences

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SMALL = "/root/testdata/sf0.001"


# ------------------------------------------------------------------ op3


def brute_groups(rows):
    sets: dict = {}
    for key, text in rows:
        w = ["".join(c.lower() if "A" <= c <= "Z" else c for c in x) for x in WORD.findall(text or "")]
        s = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        sets.setdefault(key, []).append(s)
    keys = sorted(sets)
    group = {k: k for k in keys}

    def top(k):
        while group[k] != k:
            k = group[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[:i]:
            if any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                low, high = sorted((top(a), top(b)))
                group[high] = low
    return {k: top(k) for k in keys}, sets


def made_texts(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["an", "the", "is", "or", "él", "un", "x"]) for _ in range(rng.randint(1, 4)))
    passage = [word() for _ in range(30)]
    rows, base = [], [word() for _ in range(60)]
    for i in range(120):
        kind = rng.random()
        if kind < 0.3:  # near copies of one text, from close to just beyond the threshold
            w = list(base)
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = word()
            rows.append((i, " ".join(w)))
        elif kind < 0.6:  # a passage that many share
            rows.append((i, " ".join([word() for _ in range(rng.randint(2, 40))] + passage[: rng.randint(5, 30)])))
        elif kind < 0.8:
            rows.append((i, " ".join(word() for _ in range(rng.randint(0, 6)))))
        else:
            rows.append((i, "\n".join(word() for _ in range(rng.randint(5, 80))).upper()))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_by_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(jaccard, "SALT_ROWS", 3)
    rows = made_texts(seed) + [(500, None), (501, ""), (502, " \n"), (503, "The end"), (504, "the END"), (505, "end the")]
    rows += [(600, rows[0][1]), (600, "another text altogether here"), (601, "another text altogether here")]
    df = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, component_id string").repartition(5)
    want, sets = brute_groups(rows)
    got = jaccard.similar(df).collect()
    assert Counter(r["doc_id"] for r in got) == Counter(k for k, _ in rows)
    assert {(r["doc_id"], r["component_id"]) for r in got} == set(want.items())
    assert Counter((r["doc_id"], r["n_shingles"]) for r in got) == Counter((k, len(s)) for k in sets for s in sets[k])


def test_groups_whatever_is_common(spark, monkeypatch):
    rows = made_texts(3)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want, _ = brute_groups(rows)
    for repeats, most in ((1, 10), (2, 100_000), (10**9, 5)):
        monkeypatch.setattr(jaccard, "REPEATS", repeats)
        hot = jaccard.hot_tokens(df, "text", most)
        monkeypatch.setattr(jaccard, "hot_tokens", lambda d, t, hot=hot: hot)
        assert {(r["doc_id"], r["component_id"]) for r in jaccard.similar(df).collect()} == set(want.items())
        monkeypatch.undo()


def test_no_documents_and_null_keys(spark):
    assert jaccard.similar(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    rows = jaccard.similar(spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f")], "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["component_id"]) for r in rows} == {(None, None), (1, 1)}


def test_null_key_ahead_of_a_keyed_copy(spark):
    text = " ".join(f"word{i}" for i in range(40))
    rows = [(None, text), (1, text), (2, text + " more"), (3, "of another kind")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.similar(docs).collect()}
    assert got == {(None, 36, None), (1, 36, 1), (2, 37, 1), (3, 1, 3)}


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 130)] + [(7, 7), (130, 129)]
    random.Random(4).shuffle(chain)
    got = dict(components.components(spark.createDataFrame(chain, "u long, v long")).collect())
    assert got == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 131), 100)}


# ------------------------------------------------------------------ op4


def brute_quality(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    seen = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    hit = set()
    for i in range(len(words) - 4):
        if seen[tuple(words[i : i + 5])] > 1:
            hit.update(range(i, i + 5))
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(hit)


def test_counts_by_brute_force(spark):
    rng = random.Random(5)
    texts = [None, "", "\n \n", "###", "a b c d e a b c d e", "x\x1cy z é", "a\na\n\na \na"]
    texts += [" ".join(rng.choice("ab#é\n") for _ in range(rng.randint(0, 60))) for _ in range(100)]
    df = spark.createDataFrame([(i, t, 9) for i, t in enumerate(texts)], "id int, text string, n_words int")
    names = quality.FEATURES[:5]
    got = {r["id"]: tuple(r[n] for n in names) for r in quality.features(df).collect()}
    assert got == {i: brute_quality(t) for i, t in enumerate(texts)}


def plain_estimate(votes):
    """Expectation-maximisation text by text: the share of good texts and P(vote good | class, voted) of each rule."""
    share, table = quality.SHARE, [[list(quality.START[0]), list(quality.START[1])] for _ in votes[0]]
    chance = []
    for _ in range(300):
        chance = []
        for row in votes:
            good, bad = share, 1 - share
            for vote, ((g1, b1), (g2, b2)) in zip(row, table, strict=True):
                good, bad = (good * g1, bad * g2) if vote > 0 else (good * b1, bad * b2) if vote < 0 else (good, bad)
            chance.append(good / (good + bad))
        n, k = len(votes), quality.PRIOR_VOTES
        for r in range(len(table)):
            for c in (0, 1):
                weight = [p if c == 0 else 1 - p for p in chance]
                seen = [sum(w for w, row in zip(weight, votes, strict=True) if row[r] == v) + k * quality.START[c][i] for i, v in enumerate((1, -1))]
                table[r][c] = [x / sum(seen) for x in seen]
        share = (sum(chance) + k * quality.SHARE) / (n + k)
    return share, table, chance


def test_estimates_agree_with_plain_ones(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    measured = quality.features(docs, keep_text=False)
    model = quality.fit(measured)
    names = list(quality.rules())
    rows = quality.judged(measured, model).select("base_failed", "quality_posterior", "kept", *[v.alias(f"_{n}") for n, v in quality.rules().items()]).collect()
    passed = [r for r in rows if not r["base_failed"]]
    share, table, chance = plain_estimate([[r[f"_{n}"] for n in names] for r in passed])
    assert abs(model.share - share) < 1e-6
    for n, (good, bad) in zip(names, table, strict=True):
        assert np.abs(np.array(model.votes[n]) - np.array([good, bad])).max() < 1e-5
        assert all(abs(sum(row) - 1) < 1e-9 for row in model.tables()[n])
    assert max(abs(r["quality_posterior"] - p) for r, p in zip(passed, chance, strict=True)) < 2e-6
    assert all(r["kept"] == (not r["base_failed"] and r["quality_posterior"] >= 0.5) for r in rows)


def test_tables_and_share_are_found():
    rng = np.random.default_rng(6)
    good = rng.random(60_000) < 0.85
    right = np.array([[0.95, 0.7], [0.9, 0.6], [0.85, 0.8], [0.97, 0.5], [0.8, 0.75]])  # P(good vote | good), P(bad vote | bad)
    yes = rng.random((60_000, 5)) < np.where(good[:, None], right[:, 0], 1 - right[:, 1])
    votes = np.where(rng.random((60_000, 5)) < 0.9, np.where(yes, 1, -1), 0)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    share, cast, silent = quality.expectation_maximisation(patterns.astype(float), counts.astype(float))
    assert abs(share - 0.85) < 0.02 and np.abs(silent - 0.1).max() < 0.02
    assert np.abs(cast[:, 0, 0] - right[:, 0]).max() < 0.03 and np.abs(cast[:, 1, 1] - right[:, 1]).max() < 0.05


def test_weighing_beats_passing_every_rule(spark):
    folder = "/root/testdata/sf0.1"
    measured = stored(quality.features(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text"), keep_text=False))
    strict = ~F.col("base_failed")
    for vote in quality.rules().values():
        strict = strict & (vote != -1)
    judged = quality.judged(measured, quality.fit(measured)).withColumn("strict", strict)
    got = judged.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").select("quality", "kept", "strict", "base_failed").collect()
    assert sum(r["kept"] != r["strict"] for r in got) > 10
    errors = {v: sum(r[v] != bool(r["quality"]) for r in got) for v in ("kept", "strict")}
    assert errors["kept"] < errors["strict"]
    good = [r["kept"] for r in got if r["quality"] == 1 and not r["base_failed"]]
    assert np.mean(good) > 0.99 and np.mean([r["kept"] for r in got if r["quality"] == 0]) < 0.03
    assert not any(r["kept"] and r["base_failed"] for r in got)


def test_quality_of_nothing(spark):
    empty = quality.features(spark.createDataFrame([], "text string"))
    model = quality.fit(empty)
    assert model.share == pytest.approx(quality.SHARE) and quality.judged(empty, model).count() == 0
    rows = quality.judged(quality.features(spark.createDataFrame([(None,), ("",)], "text string")), model).collect()
    assert [(r["base_failed"], r["kept"]) for r in rows] == [(True, False)] * 2


def test_quality_of_a_long_text(spark):
    text = "Und die Katze ist im Haus. " * 60_000 + "#" * 2_000_000
    row = quality.features(spark.createDataFrame([(text,)], "text string")).first()
    assert (row["n_words"], row["n_symbols"], row["n_common_words"], row["n_letters"]) == (360_001, 2_000_000, 240_000, 20 * 60_000)


# ------------------------------------------------------------------ op5


def test_licenses_are_found_where_they_stand(spark):
    rng = random.Random(7)
    filler = lambda n: " ".join(rng.choice(["an", "licenses", "beneath", "é", "from", "publics", "versions"]) for _ in range(n))
    rows, want = [], set()
    for i, (name, template) in enumerate(sorted(licenses.TEMPLATES.items())):
        before = filler(20) + "\n"
        rows.append((i, before + template.upper() + "\n" + filler(10)))
        want.add((i, name, len(before)))
        words = template.split()
        if len(words) > 20:
            del words[7]
            words.insert(12, "extra")
            rows.append((100 + i, before + "  ".join(words)))
            want.add((100 + i, name, len(before)))
    rows += [(900, None), (901, ""), (902, filler(300)), (903, "Released under the MIT License. " * 3)]
    got = licenses.scan(spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id int, text string, license string")).collect()
    assert want <= {(r["doc_id"], r["license"], r["start"]) for r in got}
    assert all(r["coverage_percent"] == 100 for r in got if r["doc_id"] < 100 and (r["doc_id"], r["license"], r["start"]) in want)
    assert [r["start"] for r in got if r["doc_id"] == 903] == [0, 32, 64]
    assert not [r for r in got if r["doc_id"] in (900, 901, 902)]
    assert licenses.scan(spark.createDataFrame([], "doc_id int, text string")).count() == 0


def test_banded_alignment_counts_what_full_alignment_counts():
    rng = np.random.default_rng(8)
    for _ in range(30):
        p = rng.integers(0, 9, 12).astype(np.uint64)
        t = np.concatenate([rng.integers(10, 19, 5).astype(np.uint64), np.delete(p, rng.integers(0, 12)), rng.integers(10, 19, 5).astype(np.uint64)])
        wide, narrow = licenses.banded(p, t, -30, 30), licenses.banded(p, t, 3, 7)
        assert narrow[0] == wide[0] >= 10 or narrow[0] == wide[0]


def test_license_query_by_plain_search(spark):
    from tablewright.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = {(r["doc_id"], r["license"], docs[r["doc_id"]][r["start"] : r["end"]]) for r in QUERIES["op5_license_scans"](spark, folder).collect()}
    want = set()
    for name in ("MIT", "Apache-2.0", "CC-BY-NC-4.0", "GPL-3.0"):
        plain = licenses.TEMPLATES[name].rstrip(".")
        want |= {(k, name, plain) for k, t in docs.items() if plain in t}
    assert want and want == got


# ------------------------------------------------------------------ op9


def brute_distance(pattern, text):
    row, out = list(range(len(pattern) + 1)), []
    for c in text:
        new = [0]
        for i, p in enumerate(pattern):
            new.append(min(row[i + 1] + 1, new[i] + 1, row[i] + (p != c)))
        row = new
        out.append(row[-1])
    return out


def test_bit_parallel_distance():
    rng = random.Random(9)
    for _ in range(150):
        p = "".join(rng.choice("abc") for _ in range(rng.randint(1, 80)))
        t = "".join(rng.choice("abc") for _ in range(rng.randint(0, 60)))
        assert list(decontaminate.distances(decontaminate.masks(p), len(p), t)) == brute_distance(p, t)


def edited(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        at, kind = rng.randrange(len(chars)), rng.random()
        if kind < 0.4:
            chars[at] = rng.choice("abcdefgh")
        elif kind < 0.7:
            del chars[at]
        else:
            chars.insert(at, rng.choice("abcdefgh "))
    return "".join(chars)


def test_leaks_by_brute_force(spark):
    rng = random.Random(10)
    word = lambda: "".join(rng.choice(["an", "the", "is", "or", "un", "ed"]) for _ in range(rng.randint(1, 4)))
    items = [(i, " ".join(word() for _ in range(rng.randint(4, 40)))) for i in range(12)] + [(50, None), (51, "?!"), (52, "")]
    docs = [(900, None), (901, ""), (902, "...")]
    for d in range(60):
        text = " ".join(word() for _ in range(30))
        if d % 2:
            text += "\n " + edited(rng, rng.choice(items[:12])[1].upper(), rng.randint(0, 14)) + "! " + word()
        docs.append((d, text))
    got = decontaminate.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    found = {(r["doc_id"], r["item_id"]): r["distance"] for r in got.collect()}
    want = {}
    for d, text in docs:
        for i, item in items:
            p, t = decontaminate.normalise(item), decontaminate.normalise(text)
            k = len(p) * decontaminate.PERCENT // 100
            least = min(brute_distance(p, t), default=None) if p and t else None
            if least is not None and least <= k:
                least = brute_on_words(p, t)
                if least <= k:
                    want[d, i] = least
    assert found == want and len(want) > 10


def brute_on_words(pattern, text):
    """The least distance to a stretch that begins and ends with whole words, or with the space beside one."""
    starts = [0] + [i for i, c in enumerate(text) if c == " "] + [i + 1 for i, c in enumerate(text) if c == " "]
    ends = {len(text)} | {i for i, c in enumerate(text) if c == " "} | {i + 1 for i, c in enumerate(text) if c == " "}
    best = len(pattern)
    for a in starts:
        row = list(range(len(pattern) + 1))
        for j, c in enumerate(text[a:]):
            new = [j + 1]
            for i, p in enumerate(pattern):
                new.append(min(row[i + 1] + 1, new[i] + 1, row[i] + (p != c)))
            row = new
            if a + j + 1 in ends:
                best = min(best, row[-1])
    return best


def test_short_items_and_parts_of_words_are_no_leaks(spark):
    items = spark.createDataFrame([(1, "no"), (2, "The answer is no"), (3, None), (4, "in another country")], "item_id long, text string")
    docs = [(1, "there is another one"), (2, "so the answer is no, he said"), (3, "the answer is nobody's"), (4, "within another country side"), (5, "no")]
    rows = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, distance string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(rows, items).collect()}
    assert got == {(2, 2)}
    assert {r["doc_id"] for r in decontaminate.without_leaks(rows, items).collect()} == {1, 3, 4, 5}
    assert {(r["item_id"], r["n_chars"]) for r in decontaminate.short_items(items).collect()} == {(1, 2), (3, 0)}


def test_templated_items_cost_what_unlike_ones_do():
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("aeiounrst") for _ in range(rng.randint(3, 8)))
    like = [(i, f"what is the capital city of the country number {i} and how many people live there in all") for i in range(500)]
    unlike = [(i, " ".join(word() for _ in range(17))) for i in range(500)]
    text = " ".join([*(word() for _ in range(300)), like[77][1], *(word() for _ in range(300)), unlike[99][1], "what is the capital city of the moon"])
    spent = []
    for items in (like, unlike):
        matcher = decontaminate.Matcher(items, decontaminate.PERCENT)
        began = time.process_time()
        found = {m.item: m.distance for m in matcher.search(text)}
        spent.append(time.process_time() - began)
        assert min(found.values()) == 0
    assert found == {99: 0}
    assert spent[0] < 3.0


def test_leaks_in_a_long_text():
    item = "one two three four five six seven eight nine ten eleven twelve"
    matcher = decontaminate.Matcher([(1, item)], decontaminate.PERCENT)
    text = "filler words " * 80_000 + item.replace("seven", "sevn") + " more filler" * 80_000
    assert [(m.distance, text[m.start : m.end]) for m in matcher.search(text)] == [(1, item.replace("seven", "sevn"))]


def test_leaks_are_dropped(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    docs = spark.createDataFrame(
        [(1, f"Before. {item.title()}, after", "x"), (2, "clean text", "y"), (3, None, None), (4, item.replace("seven", "sevn"), "z")], "doc_id long, text string, item_id string"
    )
    items = spark.createDataFrame([(7, item), (7, item)], "item_id long, text string")
    kept = decontaminate.without_leaks(docs, items)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {2, 3}
    first = decontaminate.matches(docs.select("doc_id", "text"), items).filter("doc_id = 1").first()
    assert f"Before. {item.title()}, after"[first["start"] : first["end"]] == item.title()
    assert decontaminate.without_leaks(docs, items.limit(0)).count() == 4
    assert decontaminate.matches(docs.limit(0), items).count() == 0


def test_items_without_a_key_count(spark):
    item = "one two three four five six seven eight nine ten eleven twelve"
    docs = spark.createDataFrame([(1, f"so {item} on"), (2, "clean text"), (None, item.replace("six", "sx"))], "doc_id long, text string")
    items = spark.createDataFrame([(None, item), (None, item), (None, None)], "item_id long, text string")
    found = Counter((r["doc_id"], r["item_id"], r["distance"]) for r in decontaminate.matches(docs, items).collect())
    assert found == {(1, None, 0): 2, (None, None, 1): 2}
    assert [r["doc_id"] for r in decontaminate.without_leaks(docs, items).collect()] == [2]


def test_many_items_go_in_blocks(spark):
    items = spark.createDataFrame([(i, f"item number {i} of the list") for i in range(20)], "item_id long, text string")
    assert len(decontaminate.item_blocks(items, "item_id", "text", 8, limit=100)) > 3


# ------------------------------------------------------------------ SQL


@pytest.mark.parametrize("name", ["op3_jaccard_join"])
def test_against_sql(spark, name):
    from tablewright.llm.queries import ORACLES, QUERIES

    assert differences(connect(SMALL), QUERIES[name](spark, SMALL), ORACLES[name]) == ""


def test_words_of_arrow_columns():
    from tablewright.llm.words import Words, letters

    texts = pa.array(["ab  cd", None, "", "ab", " x\n", "é cd"], pa.string())
    for column in (texts, pa.concat_arrays([texts, texts]).slice(6)):
        w = Words(column)
        assert [w.text(i) for i in range(len(w.starts))] == ["ab", "cd", "ab", "x", "é", "cd"]
        assert w.places.tolist() == [0, 2, 2, 2, 3, 4, 6]
        h = w.hashes(letters(1))
        assert h[0] == h[2] and h[1] == h[5] and len(set(h.tolist())) == 4
