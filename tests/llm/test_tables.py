"""op6, op7, op10 and the pipeline: SQL on the driver's tables, edge rows by hand."""

import gzip
import json

import pytest

from tablewright.llm import chat, decontaminate, url_filters, warc
from tablewright.llm.asof import latest_before
from tablewright.llm.common import table
from tests.oracle import connect, differences

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op6_url_filters", "op7_warc_revisits", "op10_chat_formatting"])
def test_against_sql(spark, name):
    from tablewright.llm.queries import ORACLES, QUERIES

    assert differences(connect(SMALL), QUERIES[name](spark, SMALL), ORACLES[name]) == ""


def test_lists_change_over_time(spark):
    day = url_filters.DAY
    events = spark.createDataFrame(
        [
            ("bad", "host", "a.example.com", "add", 10 * day),
            ("bad", "host", "a.example.com", "add", 12 * day),
            ("bad", "host", "a.example.com", "remove", 20 * day),
            ("bad", "host", "a.example.com", "add", 100 * day),
            ("bad", "host", "a.example.com", "add", 100 * day),
            ("adult", "domain", "example.com", "add", 15 * day),
            ("adult", "domain", "example.com", "remove", 15 * day),
            ("spam", "url", "http://b.example.org/x", "add", 0),
            ("spam", "url", None, "add", 0),
            (None, "host", "c", "add", 0),
        ],
        "list string, kind string, pattern string, action string, at long",
    )
    url = "http://A.example.com:80/p#q"
    rows = [(1, url, 10 * day - 1), (2, url, 10 * day), (3, url, 20 * day - 1), (4, url, 20 * day), (5, url, 150 * day), (5, url, 150 * day)]
    rows += [(6, None, 5), (7, "no url", 5), (8, url, None), (9, "http://b.example.org/x#y", 5), (10, "http://b.example.org/x/z", 5)]
    captures = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, fetched_at long, lists string")
    got = url_filters.judged(captures, events, "page_id", "url", "fetched_at").collect()
    assert sorted((r["page_id"], r["blocked"], r["lists"]) for r in got) == [
        (1, False, ""), (2, True, "bad"), (3, True, "bad"), (4, False, ""), (5, True, "bad"), (5, True, "bad"), (6, False, ""),
        (7, False, ""), (8, False, ""), (9, True, "spam"), (10, False, ""),
    ]
    assert url_filters.judged(captures.limit(0), events, "page_id", "url", "fetched_at").count() == 0
    assert not any(r["blocked"] for r in url_filters.judged(captures, events.limit(0), "page_id", "url", "fetched_at").collect())


def test_latest_before_in_chunks(spark):
    right = [("k", t, t * 10 + j) for t in range(0, 400, 3) for j in (0, 1)] + [("m", 5, 1), (None, 1, 9), ("k", None, 9)]
    left = [("k", t) for t in range(-5, 420, 2)] * 2 + [("m", 5), ("m", 6), ("z", 7), (None, 3), ("k", None)]
    r = spark.createDataFrame(right, "by string, at long, id long")
    rows = spark.createDataFrame(left, "by string, at long")

    def want(by, at):
        earlier = [(t, i) for b, t, i in right if b == by and by is not None and None not in (t, at) and t < at]
        return max(earlier)[1] if earlier else None

    for limit in (10, 37, 100_000):
        got = latest_before(rows, r, "by", "at", "id", "found", limit).collect()
        assert len(got) == len(left) and all(g["found"] == want(g["by"], g["at"]) for g in got)


def test_revisits(spark):
    url = "HTTP://Example.com:80/p?b=2&a=1#x"
    header = {"ETag": '"1"', "Date": "1", "Content-Type": "text/html"}
    rows = [
        (1, "response", "http://example.com/p?a=1&b=2", 10, '"1"', "m", header, "d1"),
        (2, "response", "http://example.com/p?a=1&b=2", 20, '"2"', "n", None, "d2"),
        (3, "revisit", url, 15, 'W/"1"', None, {"date": "2", "EXPIRES": "3", "content-length": "0"}, None),
        (4, "revisit", url, 25, '"1"', "n", None, None),
        (5, "revisit", url, 20, None, "m", {}, None),
        (6, "revisit", url, 10, None, None, {}, None),
        (7, "revisit", None, 30, None, None, {}, None),
        (8, "revisit", url, 30, None, None, {"ETag": '"9"'}, None),
        (8, "revisit", url, 30, None, None, {"ETag": '"9"'}, None),
    ]
    schema = "record_id long, type string, url string, at long, etag string, last_modified string, headers map<string,string>, payload_digest string"
    records = spark.createDataFrame(rows, schema)
    for limit in (1, 100_000):
        got = sorted(warc.resolve(records, limit).collect(), key=lambda r: r["record_id"])
        assert [(r["record_id"], r["state"], r["response_id"], r["response_digest"]) for r in got] == [
            (3, "resolved", 1, "d1"), (4, "changed", 2, None), (5, "resolved", 1, "d1"), (6, "no_response", None, None),
            (7, "no_response", None, None), (8, "resolved", 2, "d2"), (8, "resolved", 2, "d2"),
        ]
        assert got[0]["headers"] == {"etag": '"1"', "date": "2", "content-type": "text/html", "expires": "3"}
        assert got[-1]["headers"] == {"etag": '"9"'}
    assert warc.resolve(records.limit(0)).count() == 0


def test_warc_bytes():
    one = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    two = b"WARC/1.1\r\nWARC-Type: revisit\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    for data in (one + two, gzip.compress(one) + gzip.compress(two)):
        assert [(f["warc-type"], b) for f, b in warc.parse(data)] == [("response", b"hello"), ("revisit", b"")]
    assert list(warc.parse(one[:-8])) == [] and list(warc.parse(b"")) == []


def test_chat_links(spark):
    calls = [
        (1, 1, "a", "t", {"q": 'say "hi"\n\x01\\'}, None),
        (1, 3, "b", "t", {"n": "7", "q": "x", "z": "1"}, "a"),
        (1, 5, "c", "t", {"n": "07", "f": "true"}, "b"),
        (1, 7, "d", "none", None, "gone"),
        (2, 1, "a", "t", {"q": None}, "b"),
        (2, 3, "b", "t", {"q": "é"}, "a"),
        (2, 5, "c", "t", {"q": ""}, "a"),
        (2, 6, "c", "t", {"q": "later, left out"}, None),
        (None, 1, "a", "t", {}, None),
        (3, 1, None, "t", {}, None),
    ]
    results = [(1, "a", 2, "ok"), (1, "a", 4, "again"), (1, "b", 2, None), (9, "a", 1, "no call")]
    schemas = [("t", "q", "string", True), ("t", "n", "integer", False), ("t", "f", "boolean", False)]
    kinds = "conv_id long, turn long, call_id string, tool string, arguments map<string,string>, after string"
    c = spark.createDataFrame(calls, kinds)
    r = spark.createDataFrame(results, "conv_id long, call_id string, turn long, content string")
    s = spark.createDataFrame(schemas, "tool string, field string, kind string, required boolean")
    got = {(x["conv_id"], x["call_id"]): x for x in chat.linked(c, r, s).collect()}
    assert {k: (x["depth"], x["status"], x["n_results"], x["problems"]) for k, x in got.items()} == {
        (1, "a"): (0, "answered", 2, ""),
        (1, "b"): (1, "early", 1, "unknown z"),
        (1, "c"): (2, "open", 0, "missing q;type n"),
        (1, "d"): (0, "open", 0, "unknown tool"),
        (2, "a"): (None, "open", 0, ""),
        (2, "b"): (None, "open", 0, ""),
        (2, "c"): (None, "open", 0, ""),
    }
    assert got[1, "a"]["json"] == '{"arguments":{"q":"say \\"hi\\"\\n\\u0001\\\\"},"id":"a","name":"t","result":"ok"}'
    assert got[1, "b"]["json"] == '{"arguments":{"n":7,"q":"x","z":"1"},"id":"b","name":"t","result":null}'
    assert got[1, "c"]["json"] == '{"arguments":{"f":true,"n":"07"},"id":"c","name":"t","result":null}'
    assert got[2, "a"]["json"] == '{"arguments":{"q":null},"id":"a","name":"t","result":null}'
    assert chat.linked(c.limit(0), r, s).count() == 0


def test_whole_turns_are_arguments(spark):
    from tablewright.llm.queries import ORACLES, QUERIES

    df = QUERIES["op10_whole_turns"](spark, SMALL)
    assert differences(connect(SMALL), df, ORACLES["op10_whole_turns"]) == ""
    turns = table(spark, SMALL, "conversations").filter("role = 'assistant'")
    texts = {(r["conv_id"], r["turn"]): r["text"] for r in turns.collect()}
    asked = {(r["conv_id"], r["turn"]): json.loads(r["json"])["arguments"]["query"] for r in df.collect()}
    assert asked == {k: texts[k] for k in asked} and any(len(t) > 1000 for t in asked.values())


def test_long_chains_of_calls(spark):
    n = 300
    calls = spark.createDataFrame([(1, i, f"c{i}", "t", {}, f"c{i - 1}") for i in range(n)], "conv_id long, turn long, call_id string, tool string, arguments map<string,string>, after string")
    got = {r["call_id"]: r["depth"] for r in chat.depths(chat.first_calls(calls)).collect()}
    assert got == {f"c{i}": i for i in range(n)}


def test_chat_runs_without_python(spark):
    from tablewright.llm.queries import QUERIES

    plan = QUERIES["op10_chat_formatting"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


# ------------------------------------------------------------------ pipeline


def test_every_stage_by_brute_force(spark):
    import corpus_pipeline as p
    from tests.llm.test_texts import brute_groups

    docs = table(spark, SMALL, "documents")
    names = [n for n, _ in p.STAGES]
    assert names == ["quality_rules", "jaccard_join", "decontamination", "bpe"]
    good = p.STAGES[0][1](spark, docs, SMALL)
    assert good.columns == docs.columns and 0 < good.count() < docs.count()
    rows = [(r["doc_id"], r["text"]) for r in good.collect()]
    groups, _ = brute_groups(rows)
    alone = p.STAGES[1][1](spark, good, SMALL)
    assert alone.columns == docs.columns and sorted(r["doc_id"] for r in alone.collect()) == sorted(set(groups.values()))
    items = [decontaminate.normalise(r["text"]) for r in table(spark, SMALL, "benchmark").collect()]
    clean = p.STAGES[2][1](spark, alone, SMALL)
    left = {r["doc_id"] for r in clean.collect()}
    exact = {r["doc_id"] for r in alone.collect() if any(i in decontaminate.normalise(r["text"]) for i in items)}
    assert clean.columns == docs.columns and not left & exact and len(left) >= alone.count() - len(exact) - 2
    assert {r["doc_id"] for r in p.run(spark, SMALL).select("doc_id").collect()} == left


def test_stages_take_odd_rows(spark):
    import corpus_pipeline as p

    schema = "doc_id long, text string, lang string, source string, n_chars long, n_words string, _row string"
    text = "a fine little text of more than ten words that nobody else has written down here before"
    rows = [(1, text, None, "s", 1, "kept", "r"), (1, text, "en", "s", 1, "kept", "r"), (2, text.upper(), "en", None, None, None, None)]
    rows += [(3, None, "en", "s", 0, None, None), (None, text + " again and again", "en", "s", 1, None, None), (4, "", None, None, 0, None, None)]
    docs = spark.createDataFrame(rows, schema)
    for k, (_, stage) in enumerate(p.STAGES):
        out = stage(spark, docs, SMALL)
        assert stage(spark, docs.limit(0), SMALL).count() == 0
        if k < 3:
            assert out.columns == docs.columns
        ids = sorted(map(str, (r["doc_id"] for r in out.collect())))
        assert ids == {0: ["1", "1", "2", "None"], 1: ["1", "3", "4", "None"]}.get(k, ["1", "1", "2", "3", "4", "None"])
