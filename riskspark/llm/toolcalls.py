"""Chat formatting: links tool calls to their results, all in DataFrame operations.

* Calls and results meet in a hash join on conversation and identifier.
* Calls are put in a topological order of what they wait for: a call stands at its own turn
  or, if something that it waits for comes at the same turn or later, one step after that.
  Turns mostly agree with the waits, so only calls that a late one holds up go through
  rounds; calls on a ring are marked and stand nowhere.
* Arguments are checked against the schema of their tool: required, type, range of a number
  or of a text's length, unknown names.
* Each call with its result becomes one canonical JSON: keys in order, no blanks.

Results: null texts are empty arguments or contents; arguments that are no JSON object fail
the check; a call without result, a result without call, a repeated identifier (the first
turn counts), a tool without schema and a wait for an unknown call each have a status or an
error of their own, and no row is lost; rows without conversation, turn or identifier link to
nothing; further columns are not read; an empty table gives an empty table. Texts may be of
any length. Arguments of more than ``PARSED_CHARS`` characters or nested deeper than
``PARSED_DEPTH`` are beyond what the JSON functions take: they are not parsed, have an error of
their own and stand in the canonical JSON as the whole text. Depth is measured on the text,
before anything recurses into it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm.common import staged

KEY = ["conv_id", "call_id"]
PARSED_CHARS = 10_000_000
PARSED_DEPTH = 200


def first_of(rows: DataFrame, by: list[str], turn: str = "turn") -> DataFrame:
    """One row for each key, that of the smallest turn (ties: the least of the rest)."""
    rest = [c for c in rows.columns if c not in by]
    least = F.min(F.struct(turn, *(c for c in rest if c != turn))).alias("_least")
    return rows.groupBy(*by).agg(least).select(*by, *(F.col(f"_least.{c}").alias(c) for c in rest))


def parted(rows: DataFrame, whole: Column) -> tuple[DataFrame, list[DataFrame]]:
    """The first row of each key, and all the others: without a key, or repeated."""
    keyed, others = rows.filter(whole), [rows.filter(~F.coalesce(whole, F.lit(False)))]
    if keyed.groupBy(*KEY).count().filter("count > 1").isEmpty():
        return keyed, others
    first = first_of(keyed, KEY)
    # equal rows as one with their number, less the one that came first
    counted = keyed.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n"))
    marks = first.select(*KEY, *(F.col(c).alias(f"_first_{c}") for c in rows.columns if c not in KEY))
    same = F.lit(True)
    for c in rows.columns:
        if c not in KEY:
            same = same & F.col(c).eqNullSafe(F.col(f"_first_{c}"))
    left = counted.join(marks, KEY).withColumn("_n", F.col("_n") - F.when(same, 1).otherwise(0)).filter("_n > 0")
    return first, [*others, left.withColumn("_i", F.explode(F.expr("sequence(1, _n)"))).select(*rows.columns)]


def ordered(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, order_turn, order_step, ring, missing) of calls (conv_id, call_id, turn, after array).

    Sorting by (order_turn, order_step, turn) is a topological order of the calls that are on no ring.
    """
    known = calls.select("conv_id", "call_id", "turn")
    waits = calls.filter(F.size("after") > 0).select("conv_id", "call_id", "turn", F.explode("after").alias("on"))
    first = known.select("conv_id", F.col("call_id").alias("on"), F.col("turn").alias("on_turn"))
    edges = staged(waits.join(first.hint("shuffle_hash"), ["conv_id", "on"], "left"))
    missing = edges.filter("on_turn IS NULL").groupBy(*KEY).agg(F.sort_array(F.collect_set("on")).alias("missing"))
    links = edges.filter("on_turn IS NOT NULL").select(*KEY, "turn", "on")
    at = F.struct(F.col("turn").cast("long").alias("t"), F.lit(0).cast("long").alias("s"))
    # calls moved from their turn so far: (conv_id, call_id, place); begins with those behind a call of the same or a later turn
    late = edges.filter("on_turn >= turn").groupBy(*KEY).agg(
        F.max(F.struct(F.col("on_turn").cast("long").alias("t"), F.lit(1).cast("long").alias("s"))).alias("place"))
    moved, active, step = late, late, 1
    rings = None
    if not late.isEmpty():
        moved = active = staged(late)
        while True:
            ahead = active.select("conv_id", F.col("call_id").alias("on"), F.struct(F.col("place.t").alias("t"), (F.col("place.s") + 1).alias("s")).alias("pushed"))
            offers = links.join(ahead, ["conv_id", "on"]).groupBy(*KEY, "turn").agg(F.max("pushed").alias("pushed"))
            now = offers.join(moved, KEY, "left").select(*KEY, F.col("pushed").alias("place"), F.coalesce("place", at).alias("had"))
            grown = staged(now.filter(F.col("place") > F.col("had")).select(*KEY, "place"))
            step += 1
            # a walk of more steps than calls ever moved in its conversation passes one of them twice
            ever = moved.select(*KEY).union(grown.select(*KEY)).distinct().groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
            on_ring = staged(grown.join(ever, "conv_id").filter(F.col("n") < step).select(*KEY))
            rings = on_ring if rings is None else staged(rings.union(on_ring).distinct())
            active = grown.join(rings, KEY, "left_anti")
            moved = staged(moved.join(grown.select(*KEY, F.col("place").alias("newer")), KEY, "full").select(*KEY, F.greatest("place", "newer").alias("place")))
            if active.isEmpty():
                break
        if not rings.isEmpty():
            rings = downstream(rings, links)
    placed = known.join(moved, KEY, "left").join(missing, KEY, "left")
    placed = placed.join(rings.withColumn("ring", F.lit(True)), KEY, "left") if rings is not None else placed.withColumn("ring", F.lit(False))
    place = F.coalesce("place", at)
    ring = F.coalesce("ring", F.lit(False))
    return placed.select(*KEY, F.when(~ring, place["t"]).alias("order_turn"), F.when(~ring, place["s"]).alias("order_step"),
                         ring.alias("ring"), F.coalesce("missing", F.array().cast("array<string>")).alias("missing"))


def downstream(start: DataFrame, links: DataFrame) -> DataFrame:
    """``start`` and all calls that wait for one of them."""
    found = new = start
    while True:
        reached = links.join(new.select("conv_id", F.col("call_id").alias("on")), ["conv_id", "on"]).select(*KEY).distinct()
        new = staged(reached.join(found, KEY, "left_anti"))
        if new.isEmpty():
            return found
        found = staged(found.union(new))


def problems(arguments: Column, fields: Column) -> Column:
    """What is wrong with arguments (map<string,variant>) under ``fields``
    (array<struct<field,kind,required,least,most>>), as sorted texts."""

    def kind(v: Column) -> Column:
        name = F.schema_of_variant(v)
        return (F.when(name == "STRING", "string").when(name == "BOOLEAN", "boolean").when(name == "BIGINT", "integer")
                .when(name.startswith("ARRAY"), "array").when(name.startswith("OBJECT"), "object").when(name == "VOID", "null").otherwise("number"))

    def wrong(f: Column) -> Column:
        v = F.try_element_at(arguments, f["field"])
        size = F.when(kind(v) == "string", F.length(F.try_variant_get(v, "$", "string")).cast("double")).otherwise(F.try_variant_get(v, "$", "double"))
        fits = (kind(v) == f["kind"]) | ((f["kind"] == "number") & (kind(v) == "integer"))
        return (F.when(v.isNull(), F.when(f["required"], F.concat(f["field"], F.lit(": required"))))
                .when(~fits, F.concat(f["field"], F.lit(": not "), f["kind"]))
                .when((f["least"].isNotNull() & (size < f["least"])) | (f["most"].isNotNull() & (size > f["most"])), F.concat(f["field"], F.lit(": out of range"))))

    bad = F.filter(F.transform(fields, wrong), lambda x: x.isNotNull())
    strange = F.transform(F.array_except(F.map_keys(arguments), F.transform(fields, lambda f: f["field"])), lambda x: F.concat(x, F.lit(": unknown")))
    return F.array_sort(F.concat(bad, strange))


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row for each call and for each result that no call asked for.

    ``calls`` (conv_id, call_id, turn, name, arguments JSON, after array<string>), ``results``
    (conv_id, call_id, turn, content), ``schemas`` (name, field, kind, required, least, most).
    Gives conv_id, call_id, turn, result_turn, order_turn, order_step, status, errors, json.
    """
    calls = calls.select("conv_id", "call_id", "turn", "name", F.coalesce("arguments", F.lit("")).alias("arguments"),
                         F.coalesce("after", F.array().cast("array<string>")).alias("after"))
    results = results.select("conv_id", "call_id", "turn", F.coalesce("content", F.lit("")).alias("content"))
    whole = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull() & F.col("turn").isNotNull()
    first_calls, more_calls = parted(calls, whole)
    first_results, more_results = parted(results, whole)
    first_results = first_results.withColumnRenamed("turn", "result_turn")
    tools = schemas.groupBy("name").agg(F.sort_array(F.collect_list(F.struct("field", "kind", "required", "least", "most"))).alias("fields"))
    # hash join by identifier: either side may stay alone
    pairs = first_calls.join(first_results.hint("shuffle_hash"), KEY, "full").join(ordered(first_calls), KEY, "left").join(tools, "name", "left")
    pairs = pairs.withColumn("_nested", nesting(F.col("arguments")))
    parsed = F.when(F.col("_nested") == "", F.try_parse_json("arguments"))
    is_object = F.coalesce(F.schema_of_variant(parsed).startswith("OBJECT"), F.lit(False))
    pairs = pairs.withColumn("args", F.when(is_object, F.from_json("arguments", "map<string,variant>")))
    errors = (F.when(F.col("turn").isNull(), F.array().cast("array<string>"))
              .when(F.col("_nested").isin("too long", "nested too deep"), F.array(F.concat(F.lit("arguments "), F.col("_nested"))))
              .when(F.col("fields").isNull(), F.array(F.lit("no schema")))
              .when(F.col("args").isNull(), F.array(F.lit("no JSON object")))
              .otherwise(problems(F.col("args"), F.col("fields"))))
    waiting = F.transform(F.coalesce("missing", F.array().cast("array<string>")), lambda x: F.concat(F.lit("waits for unknown "), x))
    status = (F.when(F.col("turn").isNull(), "no call").when(F.col("ring"), "ring").when(F.col("result_turn").isNull(), "no result").otherwise("linked"))
    out = pairs.select(*KEY, F.col("turn").cast("long").alias("turn"), F.col("result_turn").cast("long").alias("result_turn"), "order_turn", "order_step",
                       status.alias("status"), F.concat(errors, waiting).alias("errors"), "name", "arguments", "content", "args")
    status = lambda what: F.when(whole, f"repeated {what}").otherwise("no identifier").alias("status")
    none = F.array().cast("array<string>").alias("errors")
    for rest in more_calls:
        out = out.unionByName(rest.select(*KEY, F.col("turn").cast("long").alias("turn"), status("call"), none, "name", "arguments"), allowMissingColumns=True)
    for rest in more_results:
        out = out.unionByName(rest.select(*KEY, F.col("turn").cast("long").alias("result_turn"), status("result"), none, "content"), allowMissingColumns=True)
    given = F.when(F.col("args").isNotNull(), F.to_json(F.when(F.col("args").isNotNull(), F.try_parse_json("arguments")))).otherwise(quoted(F.col("arguments")))
    return out.withColumn("json", canonical(
        arguments=given, call_id=quoted(F.col("call_id")), name=quoted(F.col("name")), result=quoted(F.col("content")),
        valid=(F.size("errors") == 0).cast("string"))).drop("name", "arguments", "content", "args")


def nesting(text: Column) -> Column:
    """Empty where brackets outside of strings close each other within ``PARSED_DEPTH`` levels;
    else ``too long``, ``nested too deep``, or ``unbalanced``. Each round takes away the innermost pairs."""
    leaf = "\\[\\]|\\{\\}"
    bare = F.regexp_replace(F.regexp_replace(text, '"[^"\\\\]*+(?:\\\\.[^"\\\\]*+)*+"', ""), "[^\\[\\]{}]++", "")
    left = F.aggregate(F.sequence(F.lit(1), F.lit(PARSED_DEPTH)), bare, lambda b, _: F.when(b == "", b).otherwise(F.regexp_replace(b, leaf, "")))
    state = F.when(left == "", "").when(left.rlike(leaf), "nested too deep").otherwise("unbalanced")
    return F.when(text.isNotNull(), F.when(F.length(text) > PARSED_CHARS, "too long").otherwise(state))


def quoted(text: Column) -> Column:
    """A text as a JSON string of any length; null stays null."""
    whole = F.to_json(F.struct(text.alias("x")))
    return F.when(text.isNotNull(), F.substring(whole, F.lit(6), F.length(whole) - 6))


def canonical(**fields: Column) -> Column:
    """JSON object of parts that are JSON already, keys in order and no blanks; null parts are left out."""
    parts = [F.concat(F.lit(f'"{k}":'), v) for k, v in sorted(fields.items())]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


#: tools of plain conversations, and what they take
TOOLS = [("reply", "prompt", "string", True, 1.0, 400.0), ("reply", "words", "integer", True, 1.0, 60.0),
         ("reply_block", "prompt", "string", True, 1.0, 400.0), ("reply_block", "lines", "integer", True, 2.0, 6.0),
         ("reply_block", "words", "integer", True, 1.0, None)]


def tool_schemas(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TOOLS, "name string, field string, kind string, required boolean, least double, most double")


def from_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls and results of plain conversations (conv_id, turn, role, text).

    A user's turn is a call of ``reply``, or of ``reply_block`` if it has several lines; the
    assistant's next turn is its result. A ``reply`` builds on the request before it, two turns
    earlier, if that is a ``reply`` too. A ``reply_block`` is worked on once the request after it,
    two turns later, has said what else is wanted. A wait for what was no call is none.
    """
    text = F.coalesce("text", F.lit(""))
    name = lambda shift: F.concat_ws(":", F.col("conv_id").cast("string"), (F.col("turn") + shift).cast("string"))
    lines = F.size(F.split(text, "\n"))
    words = F.size(F.filter(F.split(text, "[ \n]"), lambda w: w != ""))
    block = lines > 1
    users = turns.filter("role = 'user'")
    calls = users.select("conv_id", name(0).alias("call_id"), "turn", block.alias("block"), F.when(block, "reply_block").otherwise("reply").alias("name"), F.to_json(F.struct(
        F.when(block, lines).alias("lines"), text.alias("prompt"), words.alias("words"))).alias("arguments"))
    # who may wait for a call: the block two turns before it, and if it is a reply the reply two turns after it
    offers = F.array_compact(F.array(F.struct((F.col("turn") - 2).alias("turn"), F.lit(True).alias("block")),
                                     F.when(~block, F.struct((F.col("turn") + 2).alias("turn"), F.lit(False).alias("block")))))
    waits = users.select("conv_id", name(0).alias("on"), F.explode(offers).alias("o")).select("conv_id", "on", "o.*").distinct()
    calls = calls.join(waits.hint("shuffle_hash"), ["conv_id", "turn", "block"], "left").withColumn(
        "after", F.filter(F.array("on"), lambda x: x.isNotNull())).drop("on", "block")
    results = turns.filter("role = 'assistant'").select("conv_id", name(-1).alias("call_id"), "turn", text.alias("content"))
    return calls, results


def format_conversations(turns: DataFrame) -> DataFrame:
    calls, results = from_conversations(turns)
    return link(calls, results, tool_schemas(turns.sparkSession))


def other_turns(turns: DataFrame) -> DataFrame:
    """One row of status ``context`` for each turn that is neither a call nor a result: a role of another name, or none."""
    return turns.filter(~F.coalesce(F.col("role").isin("user", "assistant"), F.lit(False))).select(
        "conv_id", F.lit(None).cast("string").alias("call_id"), F.col("turn").cast("long").alias("turn"), F.lit(None).cast("long").alias("result_turn"),
        F.col("turn").cast("long").alias("order_turn"), F.when(F.col("turn").isNotNull(), F.lit(0).cast("long")).alias("order_step"),
        F.lit("context").alias("status"), F.array().cast("array<string>").alias("errors"),
        canonical(content=quoted(F.coalesce("text", F.lit(""))), role=quoted(F.col("role"))).alias("json"))


def whole_conversations(turns: DataFrame) -> DataFrame:
    """``format_conversations`` and ``other_turns``: every turn is in one row, as a call, a result or context."""
    return format_conversations(turns).unionByName(other_turns(turns))
