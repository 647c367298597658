"""Tool calls in chat logs: linked to their results, ordered, validated and written as canonical JSON.

Native: DataFrame functions and joins only. Calls have conv_id, turn, call_id, tool, arguments
(map<string,string>), after (the call that this one waits for, or null). Results have conv_id, call_id,
turn, content. Schemas have tool, field, kind (string, integer or boolean) and required.

* Link: a hash join of calls and results on (conversation, call id).
* Order: a call comes after the call that it waits for. Its depth, the number of calls it waits for in turn,
  is found by pointer doubling: every round joins each call with the call at the end of its known chain, so
  a chain of n calls takes log2 n joins and no conversation is gathered in one place.
* Validate: arguments and schema fields are joined by name.
* Serialise: keys sorted, no spaces, JSON's short escapes and lower-case \\u00xx for other control
  characters; integers and booleans unquoted.

Defined cases: without a result ``status`` is ``open``; of several results the one with the smallest turn,
then text, counts, and ``n_results`` tells their number; repeated calls with one id in a conversation give
one row, that of the smallest turn; results without a call are left out; a wait for an unknown call counts
as none; calls on or behind a waiting circle have a null depth. Unknown tools make a call invalid. Null
conversations or call ids are left out. Null arguments count as none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.common import stored

INTEGER = r"^-?(0|[1-9][0-9]*)$"


def escaped(text: Column) -> Column:
    """A JSON string with its quotes."""
    out = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    short = {8: "\\b", 9: "\\t", 10: "\\n", 12: "\\f", 13: "\\r"}
    clean = out
    for code in range(32):
        clean = F.replace(clean, F.lit(chr(code)), F.lit(short.get(code, f"\\u{code:04x}")))
    # Most texts hold no control character beyond line breaks; the long chain is for those that do.
    rare = out.rlike("[\\x00-\\x09\\x0b-\\x1f]")
    clean = F.when(rare, clean).otherwise(F.replace(out, F.lit("\n"), F.lit("\\n")))
    return F.concat(F.lit('"'), clean, F.lit('"'))


def first_calls(calls: DataFrame) -> DataFrame:
    known = calls.filter("conv_id is not null and call_id is not null")
    row = F.struct("turn", "tool", "after", F.to_json("arguments").alias("arguments"))
    one = known.groupBy("conv_id", "call_id").agg(F.min(row).alias("_c"))
    arguments = F.from_json("_c.arguments", "map<string,string>").alias("arguments")
    return one.select("conv_id", "call_id", "_c.turn", "_c.tool", "_c.after", arguments)


def depths(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, depth): the number of calls before this one on its chain; null in a circle."""
    ids = calls.select("conv_id", F.col("call_id").alias("after"))
    waits = calls.select("conv_id", "call_id", "after").join(ids.withColumn("_known", F.lit(True)), ["conv_id", "after"], "left")
    # ``to`` is the call that ``steps`` waits lead to; null where the chain has ended.
    state = waits.select("conv_id", "call_id", F.when(F.col("_known"), F.col("after")).alias("to"), F.when(F.col("_known"), 1).otherwise(0).alias("steps"))
    # No chain is longer than its conversation: what has not ended by then waits in a circle.
    state = stored(state.join(calls.groupBy("conv_id").agg(F.count(F.lit(1)).alias("calls")), "conv_id"))
    done = []
    span = 1
    while True:
        open_ = (F.col("to").isNotNull()) & (F.col("calls") >= span)
        if state.filter(open_).isEmpty():
            break
        ends = state.select("conv_id", F.col("call_id").alias("to"), F.col("to").alias("_to"), F.col("steps").alias("_steps"))
        ahead = state.filter(open_).join(ends, ["conv_id", "to"], "left")
        further = ahead.select("conv_id", "call_id", F.col("_to").alias("to"), (F.col("steps") + F.coalesce("_steps", F.lit(0))).alias("steps"), "calls")
        # Only conversations with an open chain are looked at again.
        active = state.filter(open_).select("conv_id").distinct()
        done.append(state.join(active, "conv_id", "left_anti"))
        state = stored(further.unionByName(state.filter(~open_).join(active, "conv_id", "left_semi")))
        span *= 2
    for part in done:
        state = state.unionByName(part)
    return state.select("conv_id", "call_id", F.when(F.col("to").isNull(), F.col("steps")).cast("bigint").alias("depth"))


def checked(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """(conv_id, call_id, problems, arguments_json): problems are sorted texts, empty for a valid call."""
    fields = schemas.groupBy("tool").agg(
        F.map_from_entries(F.array_agg(F.struct("field", "kind"))).alias("_kinds"),
        F.array_agg(F.when(F.col("required"), F.col("field"))).alias("_required"),
    )
    joined = calls.join(fields, "tool", "left")
    have = F.coalesce(F.map_keys("arguments"), F.array().cast("array<string>"))
    kind = lambda k: F.element_at("_kinds", k)
    value = lambda k: F.element_at("arguments", k)
    plain = lambda k: ((kind(k) == "integer") & value(k).rlike(INTEGER)) | ((kind(k) == "boolean") & value(k).isin("true", "false"))
    wrong = F.filter(have, lambda k: kind(k).isin("integer", "boolean") & ~F.coalesce(plain(k), F.lit(False)))
    problems = F.concat(
        F.transform(F.filter("_required", lambda f: ~F.array_contains(have, f)), lambda f: F.concat(F.lit("missing "), f)),
        F.transform(F.filter(have, lambda k: kind(k).isNull()), lambda k: F.concat(F.lit("unknown "), k)),
        F.transform(wrong, lambda k: F.concat(F.lit("type "), k)),
    )
    problems = F.when(F.col("_kinds").isNull(), F.array(F.lit("unknown tool"))).otherwise(F.array_sort(problems))
    item = lambda k: F.concat(
        escaped(k),
        F.lit(":"),
        F.when(value(k).isNull(), "null").when(F.coalesce(plain(k), F.lit(False)), value(k)).otherwise(escaped(value(k))),
    )
    text = F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(have), item), ","), F.lit("}"))
    return joined.select("conv_id", "call_id", problems.alias("problems"), text.alias("arguments_json"))


def linked(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call: conv_id, call_id, turn, depth, status, n_results, valid, problems and json.

    Ordered by (conv_id, depth, turn), which puts every call behind the one that it waits for.
    """
    one = stored(first_calls(calls))
    answers = (
        results.filter("conv_id is not null and call_id is not null")
        .groupBy("conv_id", "call_id")
        .agg(F.min(F.struct("turn", "content")).alias("_r"), F.count(F.lit(1)).alias("n_results"))
    )
    keys = ["conv_id", "call_id"]
    joined = one.join(answers, keys, "left").join(depths(one), keys).join(checked(one, schemas), keys)
    status = F.when(F.col("n_results").isNull(), "open").when(F.col("_r.turn") < F.col("turn"), "early").otherwise("answered")
    content = F.when(F.col("_r.content").isNull(), "null").otherwise(escaped(F.col("_r.content")))
    json = F.concat(
        F.lit('{"arguments":'),
        F.col("arguments_json"),
        F.lit(',"id":'),
        escaped(F.col("call_id").cast("string")),
        F.lit(',"name":'),
        F.coalesce(escaped(F.col("tool")), F.lit("null")),
        F.lit(',"result":'),
        F.coalesce(content, F.lit("null")),
        F.lit("}"),
    )
    return joined.select(
        "conv_id",
        "call_id",
        "turn",
        "depth",
        status.alias("status"),
        F.coalesce("n_results", F.lit(0)).cast("bigint").alias("n_results"),
        (F.size("problems") == 0).alias("valid"),
        F.array_join("problems", ";").alias("problems"),
        json.alias("json"),
    ).orderBy("conv_id", "depth", "turn")
