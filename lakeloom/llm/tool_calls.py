"""Tool-call linking for chat data, in DataFrame expressions alone.

Messages carry JSON: a caller's ``{"tool_calls": [{"id", "name", "arguments",
"parent_id", "parent_ids"}, ...]}``, a tool's ``{"tool_call_id", "content"}``.
Calls and results are reduced to one row per identifier (pre-aggregated per
task, so repeated rows never multiply), hash-joined on (conversation,
identifier), ordered topologically, checked against the tools' schemas and
written as canonical JSON (keys sorted, no blanks).

Order: a call follows any number of others (``parent_id`` and ``parent_ids``
together).  Its depth is the longest way from a call without parents, so sorting
by (depth, turn, call_id) puts every call after all it follows.  A run of calls
with one parent each is crossed by pointer doubling (log2(n) rounds for n of
them) up to its anchor, a call with none or several parents.  What is left is
the graph of calls with several parents: a round settles those whose anchors are
all settled, so the rounds are as many as such calls follow one another.  Both
work on joined tables; no conversation is ever gathered in one task.  When a
round settles nothing, what is left lies on or behind a cycle.

Arguments are parsed to a variant and checked in place, without a row per
argument.  A rule names its value by a path: ``a.b`` is the property b of the
object a, ``a[]`` every item of the array a (so names holding dots or ending in
brackets cannot be named).  Checked are the type, presence in every object that
could hold it (``required``), bounds of a number, of a string's length or of an
array's size (``least``, ``most``), and membership in ``enum`` (an optional
column: an array of JSON texts).  The whole arguments, and every object some
rule names a property of, may hold named properties only.

Defined cases: NULL or malformed messages hold no calls or results; a call
without an identifier or conversation, and a result without one, is left out;
of several calls (results) with one identifier the earliest counts and
``n_calls`` (``n_results``) tells how many there were; a result without a call
is an ``orphan_result``; a parent that is not there is left out of the order and
gives the error ``unknown parent``; a call that names a parent twice follows it
once; malformed or non-object arguments give the error ``arguments are no
object`` and are written as null; a number beyond the range of a double is
written as null, with the error ``number out of range`` (so is a string of
nothing but U+0003, which stands for it on the way); a tool without rules gives
``unknown tool``; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.store import written

MESSAGE = ("tool_calls array<struct<id:string,name:string,parent_id:string,parent_ids:array<string>,arguments:string>>, "
           "tool_call_id string, content string")
#: What stands for a number beyond the range of a double until it is written as null.
BEYOND = r'"\u0003"'
#: JSON type of a value from the name of its variant type.
JSON_TYPE = ("CASE WHEN {0} = 'BIGINT' OR {0} RLIKE '^DECIMAL[(][0-9]+,0[)]$' THEN 'integer' "
             "WHEN {0} LIKE 'DECIMAL%' OR {0} IN ('DOUBLE', 'FLOAT') THEN 'number' WHEN {0} = 'STRING' THEN 'string' "
             "WHEN {0} = 'BOOLEAN' THEN 'boolean' WHEN {0} LIKE 'OBJECT%' THEN 'object' "
             "WHEN {0} LIKE 'ARRAY%' THEN 'array' ELSE 'null' END")


def finite(text: str) -> str:
    """SQL: the JSON ``text`` with ``BEYOND`` for numbers out of a double's range.
    Escapes are set aside by two control characters (which JSON never holds bare),
    then every second piece between quotes lies outside strings."""
    number = "x RLIKE '^-?[0-9]' AND abs(try_cast(x AS double)) = double('Infinity')"
    outside = (f"array_join(transform(regexp_extract_all(p, '[-+.0-9eE]+|[^-+.0-9eE]+', 0), "
               f"x -> CASE WHEN {number} THEN r'{BEYOND}' ELSE x END), '')")
    aside = rf"replace(replace({text}, r'\\', chr(1)), r'\"', chr(2))"
    whole = f"array_join(transform(split({aside}, '\"'), (p, i) -> CASE WHEN i % 2 = 0 THEN {outside} ELSE p END), '\"')"
    return (rf"CASE WHEN {text} RLIKE '[eE][+]?[0-9]{{3}}|[0-9]{{200}}' AND instr({text}, chr(1)) + instr({text}, chr(2)) = 0 "
            rf"THEN replace(replace({whole}, chr(2), r'\"'), chr(1), r'\\') ELSE {text} END")


def parsed(messages: DataFrame, conv_col: str, turn_col: str, json_col: str) -> tuple[DataFrame, DataFrame]:
    """``calls`` (conv, call_id, turn, name, parents, arguments, n_calls) and
    ``results`` (conv, call_id, result_turn, content, n_results)."""
    m = (messages.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(json_col).alias("text"))
         .where("conv IS NOT NULL").select("conv", "turn", F.from_json(F.expr(finite("text")), MESSAGE).alias("m")))
    parents = F.expr("array_sort(array_distinct(array_compact(array_append(coalesce(c.parent_ids, array()), c.parent_id))))")
    first = F.min(F.struct("turn", "c.name", parents.alias("parents"), "c.arguments"))
    calls = (m.select("conv", "turn", F.explode("m.tool_calls").alias("c")).where("c.id IS NOT NULL")
             .groupBy("conv", F.col("c.id").alias("call_id")).agg(first.alias("f"), F.count(F.lit(1)).alias("n_calls"))
             .select("conv", "call_id", "f.*", "n_calls"))
    results = (m.where("m.tool_call_id IS NOT NULL")
               .groupBy("conv", F.col("m.tool_call_id").alias("call_id"))
               .agg(F.min(F.struct("turn", "m.content")).alias("f"), F.count(F.lit(1)).alias("n_results"))
               .select("conv", "call_id", F.col("f.turn").alias("result_turn"), "f.content", "n_results"))
    return calls, results


def _anchors(nodes: DataFrame) -> DataFrame:
    """``conv, call_id, at, dist, done``: the call without parents or with several
    (``at``) that each call of ``nodes`` reaches over calls with one parent, and
    the steps to it; not ``done``: a cycle of such calls."""
    alone = F.col("n_up") == 1
    state = written(nodes.select("conv", "call_id", F.when(alone, F.col("up")).otherwise(F.col("call_id")).alias("at"),
                                 alone.cast("long").alias("dist"), (~alone).alias("done")), "anchors")
    before = None
    while True:
        n = state.where("NOT done").count()
        if not n or n == before:
            return state
        before = n
        above = state.select("conv", F.col("call_id").alias("at"), F.col("at").alias("next"), F.col("dist").alias("more"),
                             F.col("done").alias("ends"))
        state = written(state.where("done").unionByName(
            state.where("NOT done").join(above, ["conv", "at"])
            .select("conv", "call_id", F.col("next").alias("at"), (F.col("dist") + F.col("more")).alias("dist"),
                    F.col("ends").alias("done"))), "anchors")


def _join_levels(edges: DataFrame) -> DataFrame:
    """``conv, call_id, level`` of calls with several parents that lie on or behind
    no cycle.  ``edges``: ``conv, call_id, anchor, w, level``, the longest way of ``w``
    steps from each anchor, and the level it gives where that is known."""
    levels = edges.select("conv", "call_id", F.col("level")).where("false")
    parts = [levels]
    while True:
        settled = written(edges.groupBy("conv", "call_id").agg(F.max("level").alias("level"), F.every(F.col("level").isNotNull()).alias("all"))
                          .where("all").drop("all"), "settled")
        if not settled.take(1):
            break
        parts.append(settled)
        if len(parts) > 16:         # a table instead of a long union
            parts = [written(reduce(DataFrame.unionByName, parts), "levels")]
        found = settled.select("conv", F.col("call_id").alias("anchor"), F.col("level").alias("there"))
        edges = written(edges.join(settled, ["conv", "call_id"], "left_anti").join(found, ["conv", "anchor"], "left")
                        .select("conv", "call_id", "anchor", "w", F.coalesce("level", F.col("there") + F.col("w")).alias("level")), "open")
    return reduce(DataFrame.unionByName, parts)


def depths(calls: DataFrame) -> DataFrame:
    """``conv, call_id, depth, missing_parent`` (depth NULL on or behind a cycle)."""
    known = calls.select("conv", F.col("call_id").alias("up"), F.lit(True).alias("there"))
    ways = (calls.select("conv", "call_id", F.explode_outer("parents").alias("up")).join(known, ["conv", "up"], "left")
            .select("conv", "call_id", F.when(F.col("there"), F.col("up")).alias("up"),
                    (F.col("up").isNotNull() & F.col("there").isNull()).alias("missing")))
    ways = written(ways, "ways")
    nodes = written(ways.groupBy("conv", "call_id").agg(F.count("up").alias("n_up"), F.min("up").alias("up"),
                                                        F.max("missing").alias("missing_parent")), "nodes")
    state = _anchors(nodes)
    several = nodes.where("n_up > 1").select("conv", "call_id")
    reached = state.join(several.withColumnsRenamed({"call_id": "at"}).withColumn("open", F.lit(True)), ["conv", "at"], "left")
    if several.take(1):
        above = reached.select("conv", F.col("call_id").alias("up"), F.col("at").alias("anchor"), (F.col("dist") + 1).alias("w"),
                               (F.col("done") & F.col("open").isNull()).alias("ends"))
        edges = (ways.where("up IS NOT NULL").join(several, ["conv", "call_id"], "left_semi").join(above, ["conv", "up"])
                 .groupBy("conv", "call_id", "anchor").agg(F.max("w").alias("w"), F.every("ends").alias("ends"))
                 .select("conv", "call_id", "anchor", "w", F.when(F.col("ends"), F.col("w")).alias("level")))
        levels = _join_levels(written(edges, "edges")).withColumnsRenamed({"call_id": "at"})
        reached = reached.join(levels, ["conv", "at"], "left")
    else:
        reached = reached.withColumn("level", F.lit(None).cast("long"))
    start = F.when(F.col("open"), F.col("level")).otherwise(F.lit(0))
    return (reached.select("conv", "call_id", F.when(F.col("done"), start + F.col("dist")).alias("depth"))
            .join(nodes.select("conv", "call_id", "missing_parent"), ["conv", "call_id"]))


def _reached(steps: str) -> str:
    """SQL: the values of the arguments ``v`` at the end of a path."""
    item = "CASE WHEN s = '[]' THEN coalesce(try_cast(x AS array<variant>), array()) ELSE " \
           "coalesce(array_compact(array(try_cast(x AS map<string, variant>)[s])), array()) END"
    return f"aggregate({steps}, array(v), (found, s) -> flatten(transform(found, x -> {item})))"


def _errors() -> Column:
    """Array of what is wrong with the arguments ``v`` under ``rules`` and ``holders``."""
    kind = JSON_TYPE.format("schema_of_variant(y)")
    measure = ("CASE r.type WHEN 'string' THEN length(try_variant_get(y, '$', 'string')) "
               "WHEN 'array' THEN size(try_cast(y AS array<variant>)) ELSE try_variant_get(y, '$', 'double') END")
    keys = "map_keys(try_cast(y AS map<string, variant>))"
    here, above, inside = _reached("r.steps"), _reached("r.above"), _reached("h.steps")
    return F.expr(f"""concat(
        transform(filter(rules, r -> r.required AND r.last <> '[]' AND
            exists({above}, y -> NOT array_contains({keys}, r.last))), r -> concat('missing ', r.arg)),
        transform(filter(rules, r -> exists({here}, y -> NOT ({kind} = r.type OR ({kind} = 'integer' AND r.type = 'number')))),
            r -> concat('type of ', r.arg)),
        transform(filter(rules, r -> exists({here}, y -> {measure} < r.least OR {measure} > r.most)), r -> concat('range of ', r.arg)),
        transform(filter(rules, r -> exists({here}, y -> NOT array_contains(r.enum, to_json(y)))), r -> concat('value of ', r.arg)),
        array_distinct(flatten(transform(holders, h -> flatten(transform({inside},
            y -> transform(array_except(coalesce({keys}, array()), h.names), k -> concat('unknown ', h.holder, k))))))))""")


def _rules(schemas: DataFrame) -> DataFrame:
    """``name, rules, holders`` per tool: its rules with their paths in steps, and
    the objects whose properties they name."""
    enum = F.col("enum") if "enum" in schemas.columns else F.lit(None).cast("array<string>")
    steps = F.split(F.regexp_replace("arg", r"\[\]", ".[]"), "[.]")
    r = schemas.select(F.col("tool").alias("name"), "arg", steps.alias("steps"), "type", "required", "least", "most",
                       F.transform(enum, lambda e: F.to_json(F.try_parse_json(e))).alias("enum"))
    r = r.select("*", F.element_at("steps", -1).alias("last"), F.expr("slice(steps, 1, size(steps) - 1)").alias("above"))
    rules = r.groupBy("name").agg(F.array_sort(F.collect_list(
        F.struct("arg", "steps", "above", "last", "type", "required", "least", "most", "enum"))).alias("rules"))
    whole = r.select("name", F.array().cast("array<string>").alias("above"), F.lit(None).cast("string").alias("last"))
    each = r.select("name", F.explode(F.expr(       # a rule names every step on its path
        "transform(steps, (s, i) -> struct(slice(steps, 1, i) AS above, s AS last))")).alias("e")).select("name", "e.*")
    holders = (each.unionByName(whole).where("last IS NULL OR last <> '[]'")
               .groupBy("name", "above").agg(F.collect_set("last").alias("names"))
               .groupBy("name").agg(F.array_sort(F.collect_list(F.struct(
                   F.col("above").alias("steps"), "names",
                   F.expr("CASE WHEN size(above) > 0 THEN concat(replace(array_join(above, '.'), '.[]', '[]'), '.') ELSE '' END").alias("holder"))))
                   .alias("holders")))
    return rules.join(holders, "name")


def link_tool_calls(messages: DataFrame, schemas: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                    json_col: str = "message") -> DataFrame:
    """One row per call, and per result without a call: ``conv_id, call_id,
    turn, result_turn, depth, n_calls, n_results, status, errors, json``.

    ``schemas`` has ``tool, arg, type, required, least, most`` (NULL: no bound) and
    may have ``enum``; ``arg`` is a path, see above.  ``status`` is the first that
    holds of ``orphan_result``, ``cycle``, ``invalid``, ``unanswered``, ``ok``."""
    calls, results = parsed(messages, conv_col, turn_col, json_col)
    calls = written(calls, "calls")
    checked = (calls.join(_rules(schemas), "name", "left").withColumn("text", F.expr(finite("arguments")))
               .withColumn("beyond", F.coalesce(F.instr("text", BEYOND) > 0, F.lit(False)))
               .withColumn("v", F.expr(f"try_parse_json(replace(text, r'{BEYOND}', 'null'))"))
               .withColumn("object", F.expr("coalesce(schema_of_variant(v) LIKE 'OBJECT%', false)"))
               .withColumn("errors", F.when(F.col("rules").isNull(), F.array(F.lit("unknown tool")))
                           .when(~F.col("object"), F.array(F.lit("arguments are no object")))
                           .otherwise(F.array_sort(_errors())))
               .withColumn("arguments", F.expr("CASE WHEN object THEN to_json(v) END"))
               .join(depths(calls), ["conv", "call_id"])
               .withColumn("errors", F.concat(
                   "errors", F.when(F.col("beyond"), F.array(F.lit("number out of range"))).otherwise(F.array().cast("array<string>")),
                   F.when(F.col("missing_parent"), F.array(F.lit("unknown parent"))).otherwise(F.array().cast("array<string>"))))
               .select("conv", "call_id", "turn", "name", "parents", "arguments", "errors", "depth", "n_calls"))
    both = checked.join(results, ["conv", "call_id"], "full")
    status = (F.when(F.col("n_calls").isNull(), "orphan_result").when(F.col("depth").isNull(), "cycle")
              .when(F.size("errors") > 0, "invalid").when(F.col("n_results").isNull(), "unanswered").otherwise("ok"))
    text = lambda c: F.coalesce(F.expr(f"substr(to_json(array({c})), 2, length(to_json(array({c}))) - 2)"), F.lit("null"))
    line = F.concat(F.lit('{"arguments":'), F.coalesce("arguments", F.lit("null")), F.lit(',"depth":'),
                    F.coalesce(F.col("depth").cast("string"), F.lit("null")), F.lit(',"id":'), text("call_id"),
                    F.lit(',"name":'), text("name"), F.lit(',"parents":'), F.coalesce(F.to_json("parents"), F.lit("[]")),
                    F.lit(',"result":'), text("content"), F.lit(',"status":"'), F.col("status"), F.lit('"}'))
    return (both.withColumn("status", status).withColumn("json", line)
            .select(F.col("conv").alias(conv_col), "call_id", "turn", "result_turn", "depth",
                    F.coalesce("n_calls", F.lit(0)).alias("n_calls"), F.coalesce("n_results", F.lit(0)).alias("n_results"),
                    "status", F.array_join(F.coalesce("errors", F.array().cast("array<string>")), "; ").alias("errors"), "json"))
