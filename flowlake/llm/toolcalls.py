"""Tool-call linking, on Spark expressions alone."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.llm.blocks import stored

_CALL = ["conv_id", "call_id"]

# What an argument that is the string "$result:<call_id>" refers to; the quote
# that opens it is not an escaped one inside a longer string, and it is no key.
_REFERENCE = r'(?<!\\)"\$result:([^"\\]+)"(?!:)'

# Digits that a number keeps: as a decimal, and as a double if it has an exponent.
_DIGITS, _DOUBLE_DIGITS, _EXPONENT = 38, 15, 290

# JSON Schema types and the variant types that fit them.
_TYPES = {
    "string": "^STRING$",
    "integer": r"^(?:BIGINT|DECIMAL\(\d+,0\))$",
    "number": r"^(?:BIGINT|DECIMAL|DOUBLE)",
    "boolean": "^BOOLEAN$",
    "object": "^OBJECT",
    "array": "^ARRAY",
    "null": "^VOID$",
}


def exact_numbers(text: Column) -> Column:
    """Whether every number of a JSON text can be kept as it is.

    A number without exponent may have 38 digits, one with an exponent 15 and an
    exponent of at most 290 either way; others would change their value.
    """
    # Without escapes every quote opens or closes a string.
    bare = F.replace(F.replace(text, F.lit("\\\\"), F.lit("")), F.lit('\\"'), F.lit(""))
    numbers = F.regexp_extract_all(F.regexp_replace(bare, '"[^"]*+"', '""'), F.lit("[0-9][0-9.eE+-]*+"), F.lit(0))

    def kept(number: Column) -> Column:
        power = F.regexp_extract(number, "[eE]([+-]?[0-9]+)", 1)
        digits = F.length(F.regexp_replace(F.regexp_replace(number, "[eE].*", ""), "[^0-9]", ""))
        near = F.coalesce(F.abs(power.try_cast("long")) <= _EXPONENT, F.lit(False))
        return F.when(power == "", digits <= _DIGITS).otherwise((digits <= _DOUBLE_DIGITS) & near)

    return F.forall(numbers, kept)


def canonical_json(text: Column) -> Column:
    """JSON with sorted keys and no spaces; null unless ``text`` is JSON whose
    objects have no key twice and whose numbers are all kept, see ``exact_numbers``."""
    return F.when(exact_numbers(text), F.to_json(F.try_parse_json(text)))


def _quoted(value: Column) -> Column:
    """JSON string of a text."""
    whole = F.to_json(F.struct(value.alias("v")))
    return F.when(value.isNull(), "null").otherwise(F.substr(whole, F.lit(6), F.length(whole) - 6))


def argument_errors(name: Column, parsed: Column, schemas: dict[str, dict]) -> Column:
    """What is wrong with the ``parsed`` arguments of tool ``name``, sorted.

    A schema is a JSON Schema of an object: ``properties`` with ``type``, ``enum``
    (of strings), ``minimum``, ``maximum``, ``minLength``, ``maxLength``;
    ``required``; ``additionalProperties`` (only whether it is false).
    """
    errors = F.array(F.lit("unknown tool"))
    for tool, schema in schemas.items():
        found = []
        known = schema.get("properties", {})
        for field, rule in known.items():
            value = F.try_variant_get(parsed, f'$["{field}"]', "variant")
            kind = F.schema_of_variant(value)
            there = value.isNotNull()
            number = F.try_variant_get(parsed, f'$["{field}"]', "double")
            text = F.try_variant_get(parsed, f'$["{field}"]', "string")
            is_text, is_number = kind.rlike(_TYPES["string"]), kind.rlike(_TYPES["number"])
            wrong = []
            if "type" in rule:
                wrong.append(("type", ~kind.rlike(_TYPES[rule["type"]])))
            if "enum" in rule:
                wrong.append(("enum", ~F.coalesce(is_text & text.isin(*rule["enum"]), F.lit(False))))
            if "minimum" in rule:
                wrong.append(("minimum", is_number & (number < rule["minimum"])))
            if "maximum" in rule:
                wrong.append(("maximum", is_number & (number > rule["maximum"])))
            if "minLength" in rule:
                wrong.append(("minLength", is_text & (F.length(text) < rule["minLength"])))
            if "maxLength" in rule:
                wrong.append(("maxLength", is_text & (F.length(text) > rule["maxLength"])))
            found += [F.when(there & test, F.lit(f"{field}: {what}")) for what, test in wrong]
            if field in schema.get("required", ()):
                found.append(F.when(~there, F.lit(f"{field}: required")))
        found += [
            F.when(F.try_variant_get(parsed, f'$["{field}"]', "variant").isNull(), F.lit(f"{field}: required"))
            for field in schema.get("required", ())
            if field not in known
        ]
        listed = F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")
        if schema.get("additionalProperties") is False:
            keys = F.coalesce(F.json_object_keys(F.to_json(parsed)), F.array().cast("array<string>"))
            others = F.array_except(keys, F.array(*map(F.lit, known)).cast("array<string>"))
            listed = F.concat(listed, F.transform(others, lambda k: F.concat(k, F.lit(": unexpected"))))
        errors = F.when(name == tool, listed).otherwise(errors)
    object_ = F.coalesce(F.schema_of_variant(parsed).rlike("^OBJECT"), F.lit(False))
    return F.array_sort(F.when(object_, errors).otherwise(F.array(F.lit("arguments are not an object"))))


def order_calls(calls: DataFrame, needs: DataFrame) -> DataFrame:
    """(conv_id, call_id, level): 0 for calls that need no other, else one more
    than the highest level among those needed; null on or behind a cycle.

    ``needs`` has (conv_id, call_id, needed).  Calls with one need are contracted
    first: each points to the call its chain ends in, found by doubling in as many
    rounds as the length of the longest chain has binary digits.  What is left, calls
    with several needs, is peeled level by level along chains as weighted steps, so
    these rounds are the most such calls in a row.  Each round is a written table.
    """
    needs = stored(needs.distinct(), "needs")
    waiting = stored(
        needs.groupBy(*_CALL).agg(F.count(F.lit(1)).alias("open"), F.min("needed").alias("needed")), "waiting"
    )
    chained = _chain_ends(waiting.where("open = 1").select(*_CALL, F.col("needed").alias("top")))
    ends = chained.select("conv_id", F.col("call_id").alias("needed"), "top", "steps")
    waiting = waiting.where("open > 1").select(*_CALL, "open", F.lit(0).alias("level"))
    steps = (
        needs.join(waiting.select(*_CALL), _CALL, "left_semi")
        .join(ends, ["conv_id", "needed"], "left")
        .select(
            *_CALL,
            F.coalesce("top", "needed").alias("needed"),
            (F.coalesce("steps", F.lit(0)) + 1).alias("steps"),
        )
    )
    steps = stored(steps, "steps")
    waiting = stored(waiting, "waiting")
    last = stored(calls.join(needs, _CALL, "left_anti").select(*_CALL, F.lit(0).alias("level")), "level")
    placed = [last]
    while not waiting.isEmpty() and not last.isEmpty():
        met = (
            steps.join(last.select("conv_id", F.col("call_id").alias("needed"), "level"), ["conv_id", "needed"])
            .groupBy(*_CALL)
            .agg(F.count(F.lit(1)).alias("met"), F.max(F.col("level") + F.col("steps")).alias("reached"))
        )
        waiting = stored(
            waiting.join(met, _CALL, "left").select(
                *_CALL,
                (F.col("open") - F.coalesce("met", F.lit(0))).alias("open"),
                F.greatest("level", "reached").alias("level"),
            ),
            "waiting",
        )
        last = waiting.where("open = 0").select(*_CALL, "level")
        waiting = waiting.where("open > 0")
        placed.append(last)
    levels = reduce(DataFrame.unionByName, placed)
    ended = levels.select("conv_id", F.col("call_id").alias("top"), F.col("level").alias("start"))
    along = chained.join(ended, ["conv_id", "top"], "left")
    never = waiting.select(*_CALL, F.lit(None).cast("int").alias("level"))
    return levels.unionByName(along.select(*_CALL, (F.col("start") + F.col("steps")).alias("level"))).unionByName(never)


def _chain_ends(chains: DataFrame) -> DataFrame:
    """(conv_id, call_id, top, steps) from (conv_id, call_id, top), the one call each
    needs: the first call on the way that is none of these, and how far it is.

    Steps double each round.  A round in which no chain ends is the last: where some
    call is farther from its end than any so far, so is one half as far.  Calls on or
    behind a cycle keep a top that is one of these calls.
    """
    inner = F.col("next").isNotNull()
    links = stored(chains.withColumn("steps", F.lit(1)), "chains")
    ended, going = [], links
    before = None
    while True:
        on = links.select("conv_id", F.col("call_id").alias("top"), F.col("top").alias("next"), F.col("steps").alias("more"))
        moved = stored(going.join(on, ["conv_id", "top"], "left"), "chains")
        ended.append(moved.where(~inner).select(*_CALL, "top", "steps"))
        going = moved.where(inner).select(*_CALL, F.col("next").alias("top"), (F.col("steps") + F.col("more")).alias("steps"))
        left = going.count()
        if left in (0, before):
            return reduce(DataFrame.unionByName, [*ended, going])
        before = left
        # Those that have ended are jumped to as well: their next is their end.
        links = reduce(DataFrame.unionByName, [*ended, going])


def link_tool_calls(calls: DataFrame, results: DataFrame, schemas: dict[str, dict]) -> DataFrame:
    """Calls with their results, in an order in which they can be run.

    ``calls``: (conv_id, turn, call_id, name, arguments); ``results``: (conv_id,
    turn, call_id, content).  One row per row of either: conv_id, kind ("call" or
    "result"), turn, call_id, name, level, status, valid, errors, record.

    Sorting by (conv_id, level, turn, call_id) orders the calls of a conversation
    topologically: a call whose arguments hold the string "$result:<call_id>"
    comes after that call.  ``status`` of a call is "answered", "unanswered" or
    "duplicate" (an earlier call has its id); of a result "linked", "repeated" (an
    earlier result answers the call) or "orphan".  ``errors`` names violations of
    the tool's schema, numbers that would change, references to calls that are not
    there, and cycles.
    ``record`` is the canonical JSON of a call: sorted keys, no spaces, the result
    included; null on rows that are no call of their own.

    Earlier means the smaller turn, then the smaller content.  Rows without
    conv_id or call_id are "duplicate" and "orphan".  A null name is an unknown
    tool, null arguments are not an object, a null content is a null result.
    Rows equal in all columns count once.  A conversation may be of any size: calls and results meet by id,
    and nothing of a conversation is gathered.  Other columns are ignored.
    """
    calls = stored(
        calls.select(
            F.col("conv_id").cast("long"),
            F.col("turn").cast("long"),
            F.col("call_id").cast("string"),
            F.col("name").cast("string"),
            F.col("arguments").cast("string"),
        )
        .distinct(),
        "calls",
    )
    results = stored(
        results.select(
            F.col("conv_id").cast("long"),
            F.col("turn").cast("long"),
            F.col("call_id").cast("string"),
            F.col("content").cast("string"),
        )
        .distinct(),
        "results",
    )
    usable = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    # Nulls come first within a tie, as everywhere in Spark.
    first_call = calls.where(usable).groupBy(*_CALL).agg(F.min(F.struct("turn", "name", "arguments")).alias("c"))
    first_result = results.where(usable).groupBy(*_CALL).agg(F.min(F.struct("turn", "content")).alias("r"))
    firsts = stored(
        first_call.join(first_result, _CALL, "left").select(*_CALL, "c", "r"), "linked"
    )
    nodes = firsts.select(*_CALL, F.to_json(F.try_parse_json("c.arguments")).alias("plain"))
    references = stored(
        nodes.select(
            *_CALL,
            F.explode(F.array_distinct(F.regexp_extract_all("plain", F.lit(_REFERENCE), F.lit(1)))).alias("needed"),
        ),
        "references",
    )
    there = firsts.select("conv_id", F.col("call_id").alias("needed"), F.lit(True).alias("there"))
    checked = stored(references.join(there, ["conv_id", "needed"], "left"), "checked")
    levels = order_calls(nodes.select(*_CALL), checked.where("there").select(*_CALL, "needed"))
    missing = (
        checked.where("there IS NULL")
        .groupBy(*_CALL)
        .agg(F.sort_array(F.collect_list(F.concat(F.lit("no such call: "), "needed"))).alias("missing"))
    )
    none = F.array().cast("array<string>")
    parsed = F.try_parse_json("c.arguments")
    exact = F.coalesce(exact_numbers(F.col("c.arguments")), F.lit(True)) | parsed.isNull()
    changed = F.when(~exact, F.array(F.lit("a number cannot be kept"))).otherwise(none)
    cycle = F.when(F.col("level").isNull(), F.array(F.lit("cycle"))).otherwise(none)
    # Keys in order of the alphabet; arguments that are no JSON, or hold a number that
    # would change, stay a string.
    record = F.concat(
        F.lit('{"arguments":'),
        F.coalesce(canonical_json(F.col("c.arguments")), _quoted(F.col("c.arguments"))),
        F.lit(',"id":'),
        _quoted(F.col("call_id")),
        F.lit(',"name":'),
        _quoted(F.col("c.name")),
        F.lit(',"result":'),
        _quoted(F.col("r.content")),
        F.lit("}"),
    )
    linked = (
        firsts.join(levels, _CALL, "left")
        .join(missing, _CALL, "left")
        .select(
            *_CALL,
            F.col("c.turn").alias("turn"),
            F.col("c.name").alias("name"),
            "level",
            F.when(F.col("r").isNotNull(), "answered").otherwise("unanswered").alias("status"),
            F.concat(
                argument_errors(F.col("c.name"), parsed, schemas), changed, F.coalesce("missing", none), cycle
            ).alias("errors"),
            record.alias("record"),
        )
    )
    order = F.struct("turn", "name", "arguments")
    repeated = (
        calls.join(firsts.select(*_CALL, "c"), _CALL, "left")
        .where(F.col("c").isNull() | ~F.col("c").eqNullSafe(order))
        .select(*_CALL, "turn", "name", F.lit("duplicate").alias("status"))
    )
    answer = F.struct("turn", "content")
    answers = results.join(firsts.select(*_CALL, "r"), _CALL, "left").select(
        *_CALL,
        "turn",
        F.when(F.col("r").isNull(), "orphan")
        .when(F.col("r").eqNullSafe(answer), "linked")
        .otherwise("repeated")
        .alias("status"),
    )
    rows = (
        linked.withColumn("kind", F.lit("call"))
        .unionByName(repeated.withColumn("kind", F.lit("call")), allowMissingColumns=True)
        .unionByName(answers.withColumn("kind", F.lit("result")), allowMissingColumns=True)
    )
    return rows.select(
        "conv_id", "kind", "turn", "call_id", "name", "level", "status",
        (F.size("errors") == 0).alias("valid"), "errors", "record",
    )
