"""Chats with tool calls: link calls and results, order, validate, write canonical JSON.

Messages are rows ``conv_id, turn, role, content, tool_calls, tool_call_id``. ``tool_calls``
is a JSON array of ``{"id", "name", "arguments", "after"}``: ``arguments`` an object or a
string that holds one, ``after`` the ids of calls that must come before, in an array or, if it
is one, as a string. A row with the role ``tool`` is the result of the call that
``tool_call_id`` names. All of it is DataFrame expressions and joins on (conversation, id).

Message rows are numbered by turn and content, so rows of one turn keep their own calls. The
order of the calls of a conversation is found in one row: an array with the places of the
calls that each one comes after is folded from the front, which settles every link to an
earlier call at once. Links to later calls need further folds, from the back and the front in
turn, until nothing changes; what never settles is on a circle or after one.

Canonical JSON has sorted keys and no white space outside of strings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from proxysift.operators.lookup import fits_broadcast
from proxysift.session import durable

_CALL = "array<struct<id:string,name:string,arguments:variant,after:variant>>"

# What JSON values a parameter type takes, as patterns over the type of the value.
TYPE_PATTERNS = {
    "string": "STRING", "boolean": "BOOLEAN", "integer": "BIGINT", "number": "BIGINT|DOUBLE|DECIMAL.*",
    "object": "OBJECT<.*", "array": "ARRAY<.*", "null": "VOID",
}


def canonical_json(text: Column) -> Column:
    """The text as canonical JSON; null for null and for what is no JSON."""
    return F.to_json(F.try_parse_json(text))


def json_value(value: Column) -> Column:
    """A string or number as JSON, ``null`` for null."""
    listed = F.to_json(F.array(value), {"ignoreNullFields": "false"})
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def numbered(messages: DataFrame) -> DataFrame:
    """The six columns of messages with ``row``, their number in the conversation from 1.

    They are ordered by turn, nulls first, then by all other columns; equal rows may change
    places, which changes nothing.
    """
    names = ("turn", "role", "content", "tool_calls", "tool_call_id")
    return messages.select("conv_id", *names).withColumn(
        "row", F.row_number().over(Window.partitionBy("conv_id").orderBy(*names))
    )


def parse_calls(rows: DataFrame) -> DataFrame:
    """``conv_id, row, position, call_id, name, arguments, after, strange, place`` of each call.

    ``arguments`` is a variant, null if it is no JSON. Of calls with one id in a conversation
    the first is the call and has a ``place`` among these, from 0; the others have none.
    ``strange`` is an ``after`` that holds no ids. An entry without an id or a ``tool_calls``
    that is no array is no call.
    """
    calls = rows.where("tool_calls IS NOT NULL").select(
        "conv_id", "row", F.posexplode(F.from_json("tool_calls", _CALL)).alias("position", "c")
    ).where("c.id IS NOT NULL")
    given, after = F.col("c.arguments"), F.col("c.after")
    inner = F.try_parse_json(F.try_variant_get(given, "$", "string"))
    arguments = F.when(F.schema_of_variant(given) == "STRING", inner).otherwise(given)
    kind = F.schema_of_variant(after)
    ids = F.when(kind == "STRING", F.array(F.try_variant_get(after, "$", "string"))).otherwise(
        F.try_variant_get(after, "$", "array<string>")
    )
    order = Window.partitionBy("conv_id").orderBy("row", "position")
    nth = F.row_number().over(Window.partitionBy("conv_id", "c.id").orderBy("row", "position"))
    found = calls.withColumn("nth", nth).withColumn("before", F.count_if(F.col("nth") == 1).over(order))
    return found.select(
        "conv_id", "row", "position", F.col("c.id").alias("call_id"), F.col("c.name").alias("name"),
        arguments.alias("arguments"), F.coalesce(ids, F.array().cast("array<string>")).alias("after"),
        (kind.isNotNull() & (kind != "VOID") & ids.isNull()).alias("strange"),
        F.when(F.col("nth") == 1, F.col("before").cast("int") - 1).alias("place"),
    )


def levels_of(links: Column) -> Column:
    """Levels from an array that has, by place, the places of the calls that each comes after.

    A level is the length of the longest chain of calls before a call, -1 if it never settles.
    """
    last = F.size(links) - 1
    places = F.sequence(F.lit(0), last)
    none = F.array().cast("array<int>")

    def level(of: Column, known) -> Column:
        found = F.transform(of, known)
        return F.when(F.exists(found, lambda x: x < 0), -1).otherwise(F.coalesce(F.array_max(found), F.lit(-1)) + 1)

    def from_front(old: Column) -> Column:
        return F.aggregate(places, none, lambda new, i: F.concat(new, F.array(
            level(F.get(links, i), lambda p: F.when(p < i, F.get(new, p)).otherwise(F.get(old, p)))
        )))

    def from_back(old: Column) -> Column:
        return F.reverse(F.aggregate(places, none, lambda new, i: F.concat(new, F.array(
            level(F.get(links, last - i), lambda p: F.when(last - p < i, F.get(new, last - p)).otherwise(F.get(old, p)))
        ))))

    unknown = F.transform(places, lambda _: F.lit(-1))
    forward = F.aggregate(links, F.struct(F.lit(0).alias("at"), F.lit(0).alias("n")), lambda s, of: F.struct(
        (s["at"] + 1).alias("at"), (s["n"] + F.when(F.exists(of, lambda p: p >= s["at"]), 1).otherwise(0)).alias("n")
    ))["n"]

    def again(state: Column) -> Column:
        new = from_back(from_front(state["levels"]))
        return F.get(F.transform(F.array(new), lambda x: F.struct(x.alias("levels"), (x != state["levels"]).alias("moved"))), F.lit(0))

    # A chain of links to later calls passes one more of them in each round.
    rounds = F.aggregate(
        F.sequence(F.lit(0), forward), F.struct(unknown.alias("levels"), F.lit(True).alias("moved")),
        lambda state, _: F.when(state["moved"], again(state)).otherwise(state),
    )["levels"]
    return F.when(forward == 0, from_front(unknown)).otherwise(rounds)


def call_levels(calls: DataFrame) -> DataFrame:
    """``conv_id, place, level`` of the calls with a place; the level of what never settles is null.

    An id in ``after`` that no call has is left out. Only the places of a conversation's calls
    meet in a row, not the calls themselves.
    """
    firsts = calls.where("place IS NOT NULL")
    known = firsts.select(F.col("conv_id").alias("_conv"), F.col("call_id").alias("_id"), F.col("place").alias("link"))
    wanted = firsts.select("conv_id", "place", F.explode("after").alias("_before"))
    links = wanted.join(
        known, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("_before") == F.col("_id"))
    ).select("conv_id", "place", "link")
    every = firsts.select("conv_id", "place", F.lit(None).cast("int").alias("link"))
    listed = links.unionByName(every).groupBy("conv_id", "place").agg(F.collect_set("link").alias("links"))
    rows = listed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("place", "links"))).alias("calls"))
    found = rows.select("conv_id", F.posexplode(levels_of(F.col("calls.links"))).alias("place", "level"))
    return found.select("conv_id", "place", F.when(F.col("level") >= 0, F.col("level")).alias("level"))


def argument_faults(arguments: Column, fields: Column) -> Column:
    """Names of parameters that are missing, unknown or of another type, sorted.

    ``fields`` is an array of (field, type, required); arguments that are no object have the
    fault ``*``.
    """
    values = F.try_variant_get(arguments, "$", "map<string,variant>")
    known = F.transform(fields, lambda f: f["field"])
    unknown = F.array_except(F.map_keys(values), known)
    pattern = F.create_map(*[F.lit(x) for pair in TYPE_PATTERNS.items() for x in pair])

    def wrong(f: Column) -> Column:
        value = F.element_at(values, f["field"])
        fits = F.regexp(F.schema_of_variant(value), F.concat(F.lit("^("), F.element_at(pattern, f["type"]), F.lit(")$")))
        return F.when(F.map_contains_key(values, f["field"]), ~F.coalesce(fits, F.lit(False))).otherwise(f["required"])

    faults = F.concat(unknown, F.transform(F.filter(fields, wrong), lambda f: f["field"]))
    return F.when(values.isNull(), F.array(F.lit("*"))).otherwise(F.sort_array(F.array_distinct(faults)))


def _same(*pairs: tuple[str, str]) -> Column:
    """Equality of a conversation (null is one) and of ids."""
    (left, right), *others = pairs
    found = F.col(left).eqNullSafe(F.col(right))
    for a, b in others:
        found &= F.col(a) == F.col(b)
    return found


def link_calls(rows: DataFrame, schemas: DataFrame) -> DataFrame:
    """Per call of numbered messages its result, level, canonical arguments and status.

    ``schemas`` has ``name, field, type, required`` per parameter (a null field: a tool
    without parameters). Of several results of a call the first by row counts. A result
    without its call is a row without a ``call_id``, with the status ``lost_result``. The
    status is otherwise the first that applies of ``repeated``, ``unknown_tool``,
    ``bad_arguments``, ``bad_links`` (an ``after`` that holds no ids), ``circular``,
    ``no_result``, ``ok``. Rows with a null conv_id are one conversation; equal message rows
    repeat their calls. The level of a repeated or circular call is null.
    """
    calls = parse_calls(rows)
    levels = call_levels(calls).select(F.col("conv_id").alias("_lc"), F.col("place").alias("_lp"), "level")
    results = rows.where("role = 'tool' AND tool_call_id IS NOT NULL").groupBy(
        F.col("conv_id").alias("_rc"), F.col("tool_call_id").alias("_ri")
    ).agg(F.min(F.struct("row", F.coalesce("content", F.lit("")).alias("content"))).alias("_result"))
    field = F.struct("field", F.lower("type").alias("type"), F.coalesce("required", F.lit(False)).alias("required"))
    # A tool's parameters are one small list.
    tools = schemas.where("name IS NOT NULL").groupBy(F.col("name").alias("_tool")).agg(
        F.collect_list(F.when(F.col("field").isNotNull(), field)).alias("fields")
    )
    sized = durable(tools.withColumn("_text", F.to_json("fields")))
    tools = F.broadcast(sized.drop("_text")) if fits_broadcast(sized.select("_tool", "_text")) else sized.drop("_text")
    linked = (
        calls.join(results, _same(("conv_id", "_rc"), ("call_id", "_ri")), "full")
        .join(levels, _same(("conv_id", "_lc"), ("place", "_lp")), "left")
        .join(tools, F.col("name") == F.col("_tool"), "left")
    )
    faults = F.when(F.col("_tool").isNotNull(), argument_faults(F.col("arguments"), F.col("fields")))
    linked = linked.withColumn("faults", faults)
    status = (
        F.when(F.col("call_id").isNull(), "lost_result").when(F.col("place").isNull(), "repeated")
        .when(F.col("_tool").isNull(), "unknown_tool").when(F.size("faults") > 0, "bad_arguments")
        .when(F.col("strange"), "bad_links").when(F.col("level").isNull(), "circular")
        .when(F.col("_result").isNull(), "no_result").otherwise("ok")
    )
    lost = F.col("call_id").isNull()
    return linked.select(
        F.when(lost, F.col("_rc")).otherwise(F.col("conv_id")).alias("conv_id"),
        F.when(lost, F.col("_result.row")).otherwise(F.col("row")).alias("row"), "position", "call_id", "name",
        F.to_json("arguments").alias("arguments"), "level",
        F.when(lost | F.col("place").isNotNull(), F.col("_result.content")).alias("result"), "faults", status.alias("status"),
    )


def format_chats(messages: DataFrame, schemas: DataFrame) -> DataFrame:
    """``conv_id, n_messages, n_calls, n_ok, n_lost, chat``: each conversation as canonical JSON.

    The calls of a message stand in it in topological order (level, then position; calls
    without a level last) with their results; results are no messages of their own, and
    those of no call are only counted (``n_lost``). A chat is one record, so its messages meet
    in one row, which a JVM bounds at 2 GB; chats are spread by conversation.
    """
    rows = numbered(messages)
    calls = link_calls(rows, schemas)
    entry = F.concat(
        F.lit('{"arguments":'), F.coalesce("arguments", F.lit("null")), F.lit(',"id":'), json_value(F.col("call_id")),
        F.lit(',"level":'), json_value(F.col("level")), F.lit(',"name":'), json_value(F.col("name")),
        F.lit(',"result":'), json_value(F.col("result")), F.lit(',"status":'), json_value(F.col("status")), F.lit("}"),
    )
    # A row per message, its calls with it, of one shuffle: the calls are rows beside it.
    spoken = rows.where("role IS NULL OR role != 'tool'").select(
        "conv_id", "row", F.struct("turn", "role", "content").alias("said"),
        *[F.lit(None).cast(kind).alias(name) for name, kind in (("call", "struct<level:int,position:int,entry:string>"), ("status", "string"))],
    )
    made = calls.select(
        "conv_id", "row", F.lit(None).cast(spoken.schema["said"].dataType).alias("said"),
        F.struct(F.coalesce("level", F.lit(2**31 - 1)).alias("level"), "position", entry.alias("entry")).alias("call"), "status",
    )
    called = F.col("status") != "lost_result"
    by_row = spoken.unionByName(made).groupBy("conv_id", "row").agg(
        F.first("said", ignorenulls=True).alias("said"),
        F.transform(F.sort_array(F.collect_list(F.when(called, F.col("call")))), lambda c: c["entry"]).alias("entries"),
        F.count_if(called).alias("n_calls"), F.count_if(F.col("status") == "ok").alias("n_ok"),
        F.count_if(F.col("status") == "lost_result").alias("n_lost"),
    )
    line = F.when(F.col("said").isNotNull(), F.concat(
        F.lit('{"content":'), json_value(F.col("said.content")), F.lit(',"role":'), json_value(F.col("said.role")),
        F.when(F.size("entries") > 0, F.concat(F.lit(',"tool_calls":['), F.array_join("entries", ","), F.lit("]"))).otherwise(""),
        F.lit(',"turn":'), json_value(F.col("said.turn")), F.lit("}"),
    ))
    lines = by_row.withColumn("line", line)
    return lines.groupBy("conv_id").agg(
        F.count("line").alias("n_messages"), F.sum("n_calls").alias("n_calls"), F.sum("n_ok").alias("n_ok"), F.sum("n_lost").alias("n_lost"),
        F.concat(F.lit('{"messages":['), F.array_join(F.transform(
            F.sort_array(F.collect_list(F.when(F.col("line").isNotNull(), F.struct("row", "line")))), lambda m: m["line"]
        ), ","), F.lit("]}")).alias("chat"),
    ).where("n_messages > 0")
