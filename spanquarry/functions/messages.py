"""Text and usage out of chat messages and provider responses (all given as JSON text)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

CONTENT = "STRUCT<type: STRING, role: STRING, content: STRING>"

# Keys tried in order where there are no messages.
INPUT_KEYS = ("input", "query", "question", "human_input")
OUTPUT_KEYS = ("output", "text", "answer", "result", "response")

PART = "STRUCT<type: STRING, text: STRING, name: STRING, input: STRING>"


def _field(parsed: Column, key: str) -> Column:
    """A string field of a parsed object; other kinds do not count."""
    v = F.try_variant_get(parsed, f"$.{key}", "variant")
    return F.when(F.schema_of_variant(v) == "STRING", F.nullif(F.try_variant_get(v, "$", "string"), F.lit("")))


def _ladder(payload: Column, keys) -> Column:
    """The first string field there is. The payload is parsed once for all keys, and only where it can be an object: a failed parse costs most."""
    parsed = F.when(F.ltrim(payload, F.lit(" \t\n\r")).startswith("{"), F.try_parse_json(payload))
    return F.element_at(F.transform(F.array(parsed), lambda v: F.coalesce(*[_field(v, k) for k in keys])), 1)


def _messages(payload: Column, path: str = "$.messages") -> Column:
    return F.from_json(F.get_json_object(payload, path), f"ARRAY<{CONTENT}>")


def _who(m: Column) -> Column:
    return F.coalesce(m["type"], m["role"])


def _parts_text(content: Column, kinds: tuple[str, ...], pick: str) -> Column:
    """Texts of a content list: all joined by a space, or only the first or last."""
    parts = F.filter(F.from_json(content, f"ARRAY<{PART}>"), lambda p: p["type"].isin(*kinds))
    texts = F.transform(parts, lambda p: F.coalesce(p["text"], F.lit("")))
    if pick == "join":
        joined = F.trim(F.array_join(F.filter(texts, lambda t: t != ""), " "))
        return F.nullif(joined, F.lit(""))
    return F.when(F.size(texts) > 0, F.element_at(texts, 1 if pick == "first" else -1))


def _is_list(content: Column) -> Column:
    return F.coalesce(content.startswith("["), F.lit(False))


def chain_input_text(payload: Column) -> Column:
    """Chain log: first human message, else the first message, else the key ladder, else the payload."""
    messages = _messages(payload)
    human = F.filter(messages, lambda m: _who(m).isin("human", "user") & ~_is_list(m["content"]))
    first_human = F.when(F.size(human) > 0, F.element_at(human, 1)["content"])
    first = F.when(F.size(messages) > 0, F.element_at(messages, 1)["content"])
    first = F.when(~_is_list(first), first)
    return F.coalesce(first_human, first, _ladder(payload, INPUT_KEYS), payload)


def agent_input_text(messages_json: Column) -> Column:
    """Agent log: last user message; a content list gives its last text part."""
    users = F.filter(F.from_json(messages_json, f"ARRAY<{CONTENT}>"), lambda m: m["role"] == "user")
    texts = F.transform(
        users,
        lambda m: F.when(_is_list(m["content"]), _parts_text(m["content"], ("text", "input_text"), "last")).otherwise(m["content"]),
    )
    known = F.filter(texts, lambda t: t.isNotNull())
    return F.coalesce(F.nullif(F.when(F.size(known) > 0, F.element_at(known, -1)), F.lit("")), messages_json)


def chain_output_text(payload: Column) -> Column:
    """Last assistant text; structured parts are joined by a space; then the key ladder."""
    answers = F.filter(_messages(payload), lambda m: _who(m).isin("ai", "assistant"))
    texts = F.transform(
        answers,
        lambda m: F.when(_is_list(m["content"]), _parts_text(m["content"], ("text",), "join")).otherwise(
            F.when(F.trim(m["content"]) != "", m["content"])
        ),
    )
    known = F.filter(texts, lambda t: t.isNotNull())
    return F.coalesce(F.when(F.size(known) > 0, F.element_at(known, -1)), _ladder(payload, OUTPUT_KEYS), payload)


def agent_output_text(messages_json: Column) -> Column:
    """Agent log: text of the last message item or assistant entry that has one."""
    items = F.filter(
        F.from_json(messages_json, f"ARRAY<{CONTENT}>"), lambda m: (F.coalesce(m["type"], F.lit("")) == "message") | (m["role"] == "assistant")
    )
    texts = F.transform(
        items,
        lambda m: F.when(_is_list(m["content"]), _parts_text(m["content"], ("output_text", "text"), "first")).otherwise(m["content"]),
    )
    known = F.filter(texts, lambda t: t.isNotNull())
    return F.coalesce(F.when(F.size(known) > 0, F.element_at(known, -1)), messages_json)


def _described(calls: Column) -> Column:
    return F.when(F.size(calls) > 0, F.concat(F.lit("[tool call] "), F.array_join(calls, ", ")))


def _call(name: Column, args: Column) -> Column:
    return F.concat(F.coalesce(name, F.lit("unknown")), F.lit("("), F.coalesce(args, F.lit("None")), F.lit(")"))


def _choices_output(response: Column) -> Column:
    schema = "ARRAY<STRUCT<message: STRUCT<content: STRING, tool_calls: ARRAY<STRUCT<function: STRUCT<name: STRING, arguments: STRING>>>>>>"
    choices = F.from_json(F.get_json_object(response, "$.choices"), schema)
    texts = F.filter(F.transform(choices, lambda c: c["message"]["content"]), lambda t: t.isNotNull() & (t != ""))
    calls = F.flatten(
        F.transform(
            choices,
            lambda c: F.transform(
                F.coalesce(c["message"]["tool_calls"], F.from_json(F.lit("[]"), "ARRAY<STRUCT<function: STRUCT<name: STRING, arguments: STRING>>>")),
                lambda t: _call(t["function"]["name"], t["function"]["arguments"]),
            ),
        )
    )
    return F.coalesce(F.when(F.size(texts) > 0, F.array_join(texts, "\n")), _described(calls))


def _blocks_output(response: Column) -> Column:
    blocks = F.from_json(F.get_json_object(response, "$.content"), f"ARRAY<{PART}>")
    texts = F.transform(F.filter(blocks, lambda b: (b["type"] == "text") & (b["text"] != "")), lambda b: b["text"])
    calls = F.transform(F.filter(blocks, lambda b: b["type"] == "tool_use"), lambda b: _call(b["name"], b["input"]))
    return F.coalesce(F.when(F.size(texts) > 0, F.array_join(texts, "\n")), _described(calls))


def _candidate_parts(response: Column) -> Column:
    schema = "ARRAY<STRUCT<content: STRUCT<parts: ARRAY<STRUCT<text: STRING, function_call: STRUCT<name: STRING, args: STRING>>>>>>"
    candidates = F.from_json(F.get_json_object(response, "$.candidates"), schema)
    return F.flatten(F.filter(F.transform(candidates, lambda c: c["content"]["parts"]), lambda p: p.isNotNull()))


def _part_calls(parts: Column) -> Column:
    return F.transform(
        F.filter(parts, lambda p: p["function_call"].isNotNull()),
        lambda p: _call(p["function_call"]["name"], p["function_call"]["args"]),
    )


def _candidates_output(response: Column) -> Column:
    """The whole text if given, else the first text part, else the calls."""
    parts = _candidate_parts(response)
    texts = F.filter(parts, lambda p: p["text"] != "")
    return F.coalesce(
        F.nullif(F.get_json_object(response, "$.text"), F.lit("")),
        F.when(F.size(texts) > 0, F.element_at(texts, 1)["text"]),
        _described(_part_calls(parts)),
    )


def _parts_output(response: Column) -> Column:
    """One content object: all text parts joined by a space, else the calls."""
    schema = "ARRAY<STRUCT<text: STRING, function_call: STRUCT<name: STRING, args: STRING>>>"
    parts = F.from_json(F.get_json_object(response, "$.parts"), schema)
    texts = F.transform(F.filter(parts, lambda p: p["text"] != ""), lambda p: p["text"])
    return F.coalesce(F.when(F.size(texts) > 0, F.array_join(texts, " ")), _described(_part_calls(parts)))


def provider_output(provider: Column, response: Column) -> Column:
    """Reply text, else ``[tool call] name(args), …``, by the provider's response shape."""
    return (
        F.when(provider.isin("openai", "litellm"), _choices_output(response))
        .when(provider == "anthropic", _blocks_output(response))
        .when(provider == "genai", _candidates_output(response))
        .when(provider == "adk", _parts_output(response))
    )


def provider_usage(provider: Column, usage: Column) -> Column:
    """Struct ``input, output, cache_read, cache_write`` out of a usage block; no block, no counts.

    One provider reports cache tokens beside the input, so they are added to make the total; for
    the others they are already part of it.
    """

    def n(path: str) -> Column:
        return F.get_json_object(usage, path).try_cast("bigint")

    none = F.lit(None).cast("bigint")
    zero = F.lit(0).cast("bigint")
    chat = provider.isin("openai", "litellm")
    split = provider == "anthropic"
    write, read = n("$.cache_creation_input_tokens"), n("$.cache_read_input_tokens")
    extra = F.coalesce(write, zero) + F.coalesce(read, zero)
    total = F.when(extra > 0, F.coalesce(n("$.input_tokens"), zero) + extra).otherwise(n("$.input_tokens"))
    any_in = F.coalesce(F.nullif(n("$.prompt_tokens"), zero), n("$.input_tokens"))
    any_out = F.coalesce(F.nullif(n("$.completion_tokens"), zero), n("$.output_tokens"))
    return F.struct(
        F.when(chat, n("$.prompt_tokens")).when(split, total).when(provider == "genai", n("$.prompt_token_count")).otherwise(any_in).alias("input"),
        F.when(chat, n("$.completion_tokens")).when(split, n("$.output_tokens")).when(provider == "genai", n("$.candidates_token_count")).otherwise(any_out).alias("output"),
        F.when(chat, n("$.prompt_tokens_details.cached_tokens")).when(split, read).when(provider == "genai", n("$.cached_content_token_count")).otherwise(none).alias("cache_read"),
        F.when(split, write).otherwise(none).alias("cache_write"),
    )


def fold_system(system: Column, messages: Column) -> Column:
    """Put the system text in front as the first message; blank system text changes nothing."""
    first = F.array(F.struct(F.lit("system").alias("role"), system.alias("content")))
    empty = F.filter(first, lambda m: F.lit(False))
    folded = F.concat(first, F.coalesce(messages, empty))
    return F.when(F.coalesce(system, F.lit("")) == "", messages).otherwise(folded)


def tool_defs_cap(tools: Column, max_tools: int | None = None, max_chars: int | None = None) -> Column:
    """Tool definitions of a nested declaration list: the first ``max_tools``, and null when their JSON is longer than ``max_chars``.

    Without limits, the default, all are kept. An empty list is null.
    """
    kept = F.flatten(F.filter(tools, lambda t: t.isNotNull()))
    kept = kept if max_tools is None else F.slice(kept, 1, max_tools)
    short = F.lit(True) if max_chars is None else F.length(F.to_json(kept)) <= max_chars
    return F.when((F.size(kept) > 0) & short, kept)
