"""Normalising column expressions."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Chain runs that are plumbing, not agent structure.
NOISE_NAMES = (
    "RunnableSequence", "RunnableParallel", "RunnableLambda", "RunnableAssign", "RunnablePick", "RunnableBinding",
    "RunnableWithFallbacks", "RunnableWithMessageHistory", "RunnableBranch", "ChatPromptTemplate", "PromptTemplate",
    "StrOutputParser", "JsonOutputParser", "ToolsAgentOutputParser", "OpenAIFunctionsAgentOutputParser", "LangGraph",
    "CompiledStateGraph", "Prompt", "_Exception",
)
NOISE_PREFIXES = ("ChannelWrite", "ChannelRead", "Branch<", "RunnableParallel<", "_")


def is_noise_chain(name: Column, graph_node: Column | None = None) -> Column:
    """Plumbing by name or prefix; a stated graph node is never plumbing."""
    noise = name.isin(*NOISE_NAMES)
    for prefix in NOISE_PREFIXES:
        noise = noise | name.startswith(prefix)
    if graph_node is not None:
        noise = noise & ~F.coalesce(name == graph_node, F.lit(False))
    return F.coalesce(noise, F.lit(False))


# -- text and list fields ----------------------------------------------------------------------


def nullish_text(c: Column) -> Column:
    """Trimmed text; blank and ``nan`` are null."""
    return F.nullif(F.nullif(F.trim(c), F.lit("")), F.lit("nan"))


def split_semi(c: Column) -> Column:
    """``;`` list with trimmed, non-empty items; blank, ``nan`` and item-less text is null."""
    items = F.filter(F.transform(F.split(c, ";"), lambda x: F.trim(x)), lambda x: x != "")
    return F.when(nullish_text(c).isNotNull() & (F.size(items) > 0), items)


def first_field(columns: list[str], *candidates: str) -> Column:
    """First candidate present in ``columns`` whose value is neither null nor ''."""
    present = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in candidates if c in columns]
    return F.coalesce(*present) if present else F.lit(None).cast("string")


def first_truthy_text(*columns: Column) -> Column:
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


# -- raw agent output --------------------------------------------------------------------------


def _get(v: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, path, kind)


def _kind(v: Column) -> Column:
    """OBJECT, ARRAY, STRING, BOOLEAN, a number type, or VOID."""
    return F.regexp_extract(F.schema_of_variant(v), "^([A-Z]+)", 1)


def truthy(v: Column) -> Column:
    """Truth of a JSON value as Python sees it: null, false, 0, '', [] and {} are false."""
    text, kind = _get(v, "$"), _kind(v)
    number = ~kind.isin("OBJECT", "ARRAY", "STRING", "BOOLEAN", "VOID")
    empty = (
        (kind == "VOID")
        | ((kind == "STRING") & (text == ""))
        | ((kind == "BOOLEAN") & (text == "false"))
        | (kind.isin("OBJECT", "ARRAY") & text.isin("[]", "{}"))
        | (number & (text.try_cast("double") == 0))
    )
    return F.coalesce(v.isNotNull() & ~empty, F.lit(False))


def _plain_as(v: Column, kind: Column) -> Column:
    """Text of a value of known kind; booleans read as Python prints them."""
    return F.when(kind == "BOOLEAN", F.initcap(_get(v, "$"))).otherwise(_get(v, "$"))


def _plain(v: Column) -> Column:
    return _plain_as(v, _kind(v))


# JSON texts that are false as Python sees them, next to the zeros.
FALSY = ("null", '""', "false", "[]", "{}")


def _json_truthy(json_text: Column) -> Column:
    return F.coalesce(~json_text.isin(*FALSY) & ~json_text.rlike(r"^-?0(\.0*)?([eE].*)?$"), F.lit(False))


def _json_plain(json_text: Column) -> Column:
    """Text of a JSON value: strings unquoted, booleans as Python prints them."""
    return F.when(json_text.isin("true", "false"), F.initcap(json_text)).otherwise(F.get_json_object(json_text, "$"))


WHOLE = r"^\s*[+-]?\d+(\.\d+)?\s*$"


def to_int(*candidates: Column) -> Column:
    """First truthy candidate as a whole number; what does not parse is null."""
    text = F.coalesce(*[F.nullif(F.nullif(c, F.lit("")), F.lit("0")) for c in candidates])
    return F.when(text.rlike(WHOLE), F.trim(text).try_cast("double").try_cast("bigint"))


def normalize_result(df: DataFrame, raw: str = "raw", out: str = "r") -> DataFrame:
    """Add struct ``text, extra_keys, error_type, error_message, input_tokens, output_tokens`` of a raw answer.

    ``raw`` holds the JSON of what the agent returned: a string, an object, or anything else. The
    text is the first truthy of output, text, response. A blank answer without an error becomes an
    explicit ``EmptyOutput`` failure, unless the output object carries other keys than ``text``.

    The steps are separate projections on purpose: each value is parsed once and read many times,
    and the optimizer does not merge projections that would repeat an expensive expression.
    """
    ladder = ("output", "text", "response")
    parsed = df.withColumn("__v", F.try_parse_json(F.col(raw)))
    v = F.col("__v")
    fields = parsed.select(
        "*",
        F.to_json(v).alias("__j"),
        *[F.to_json(_get(v, f"$.{k}", "variant")).alias(f"__j_{k}") for k in (*ladder, "error")],
    )
    chosen = F.coalesce(*[F.when(_json_truthy(F.col(f"__j_{k}")), F.col(f"__j_{k}")) for k in ladder])
    picked = fields.select("*", chosen.alias("__chosen"))

    is_object = F.coalesce(F.col("__j").startswith("{"), F.lit(False))
    chosen, err = F.col("__chosen"), F.col("__j_error")
    nested = F.coalesce(chosen.startswith("{"), F.lit(False))
    object_text = F.when(nested, F.get_json_object(chosen, "$.text")).otherwise(_json_plain(chosen))
    other = F.when(F.coalesce(F.col("__j"), F.lit("null")) == "null", "").otherwise(_json_plain(F.col("__j")))
    text = F.when(is_object, object_text).otherwise(other)
    keys = F.json_object_keys(F.when(is_object & nested, chosen))
    extra = F.size(F.array_except(keys, F.array(F.lit("text")))) > 0
    has_err = is_object & _json_truthy(err)
    err_object = err.startswith("{")
    err_type = F.when(has_err, F.coalesce(F.when(err_object, F.get_json_object(err, "$.type")), F.lit("Exception")))
    err_message = F.when(has_err, F.coalesce(F.when(err_object, F.get_json_object(err, "$.message")), _json_plain(err)))

    def tokens(top: str, *fallback: str) -> Column:
        own = _get(v, f"$.{top}")
        own_int = F.when(own.rlike(WHOLE), F.trim(own).try_cast("double").try_cast("bigint"))
        return F.when(is_object, F.coalesce(own_int, to_int(*[_get(v, f"$.metadata.{k}") for k in fallback])))

    final = picked.select(
        *df.columns,
        F.coalesce(text, F.lit("")).alias("__text"),
        F.coalesce(extra, F.lit(False)).alias("__extra"),
        has_err.alias("__has_err"),
        err_type.alias("__err_type"),
        err_message.alias("__err_message"),
        tokens("input_tokens", "input_tokens", "prompt_tokens").alias("__in"),
        tokens("output_tokens", "output_tokens", "completion_tokens").alias("__out"),
    )
    blank = ~F.col("__has_err") & ~F.col("__extra") & (F.trim("__text") == "")
    return final.select(
        *df.columns,
        F.struct(
            F.col("__text").alias("text"),
            F.col("__extra").alias("extra_keys"),
            F.when(blank, "EmptyOutput").otherwise(F.col("__err_type")).alias("error_type"),
            F.when(blank, "Agent returned no output").otherwise(F.col("__err_message")).alias("error_message"),
            F.col("__in").alias("input_tokens"),
            F.col("__out").alias("output_tokens"),
        ).alias(out),
    )


def normalize_error(error_type: Column, message: Column) -> Column:
    """The failed row of a raised exception: empty text, type and message, not retryable."""
    return F.struct(
        F.lit("").alias("text"),
        error_type.alias("error_type"),
        message.alias("error_message"),
        F.lit(False).alias("retryable"),
    )


def empty_output_fail(text: Column, error: Column, keys: Column) -> Column:
    only_text = F.size(F.array_except(keys, F.array(F.lit("text")))) <= 0
    return (F.trim(F.coalesce(text, F.lit(""))) == "") & error.isNull() & only_text


def error_coerce(error_json: Column) -> Column:
    """``type, message`` of an error given as an object or a scalar; falsy means no error."""
    v = F.try_parse_json(error_json)
    is_object = F.coalesce(_kind(v) == "OBJECT", F.lit(False))
    kind = F.coalesce(F.when(is_object, _get(v, "$.type")), F.lit("Exception"))
    message = F.coalesce(F.when(is_object, _get(v, "$.message")), _plain(v))
    return F.when(truthy(v), F.struct(kind.alias("type"), message.alias("message")))


def response_lift(response: Column, output_json: Column) -> Column:
    """The response text, or the ``text`` of an output object."""
    return F.coalesce(response, F.get_json_object(output_json, "$.text"))


def hoist(nested: Column, top: Column) -> Column:
    """A metric found at top level fills the nested one where that is absent."""
    return F.coalesce(nested, top)


def trace_event_coerce(events_json: Column) -> Column:
    """Observed events (object with ``events``, or a list) as an array of structs.

    A scalar item becomes ``unknown`` with the item as its summary; nulls are dropped.
    """
    v = F.try_parse_json(events_json)
    items = F.coalesce(F.try_variant_get(v, "$.events", "array<variant>"), F.try_variant_get(v, "$", "array<variant>"))
    items = F.filter(items, lambda e: e.isNotNull() & ~F.is_variant_null(e))

    def one(e: Column) -> Column:
        is_object = F.coalesce(_kind(e) == "OBJECT", F.lit(False))
        latency = F.coalesce(F.nullif(_get(e, "$.latency_ms", "bigint"), F.lit(0)), _get(e, "$.latencyMs", "bigint"))
        return F.struct(
            F.when(is_object, F.coalesce(_get(e, "$.type"), F.lit("unknown"))).otherwise("unknown").alias("type"),
            F.when(is_object, _get(e, "$.name")).alias("name"),
            F.when(is_object, _get(e, "$.summary")).otherwise(_plain(e)).alias("summary"),
            F.when(is_object, latency).alias("latency_ms"),
        )

    return F.transform(items, one)


# Fixed value: the wire's ceiling of one trace payload in bytes, for callers that send it.
TRACE_BYTES = 20_000


def trace_budget_prefix(events: Column, limit: int | None = None) -> Column:
    """Longest prefix of serialised events that fits the byte budget; without a budget, the default, all events.

    Everything is kept when the whole payload fits; otherwise each event costs its bytes plus one,
    on top of two for the brackets.
    """
    if limit is None:
        return events
    sizes = F.transform(events, lambda e: F.octet_length(e).cast("long"))
    whole = F.aggregate(sizes, F.lit(0).cast("long"), lambda a, s: a + s) + F.lit(14) + 2 * F.greatest(F.size(events) - 1, F.lit(0))
    start = F.struct(F.lit(2).cast("long").alias("used"), F.lit(0).alias("n"), F.lit(True).alias("open"))

    def step(acc, size):
        fits = acc["open"] & (acc["used"] + size + 1 <= limit)
        return F.struct(
            F.when(fits, acc["used"] + size + 1).otherwise(acc["used"]).alias("used"),
            F.when(fits, acc["n"] + 1).otherwise(acc["n"]).alias("n"),
            fits.alias("open"),
        )

    kept = F.aggregate(sizes, start, step, lambda acc: acc["n"])
    return F.when(whole <= limit, events).otherwise(F.slice(events, F.lit(1), kept))


# -- labels ------------------------------------------------------------------------------------


def framework_label(explicit: Column, integration: Column, detected: Column) -> Column:
    return F.lower(F.coalesce(explicit, integration, detected, F.lit("other")))


def span_kind(explicit: Column, metadata_kind: Column, name: Column, model: Column) -> Column:
    """Stated kind, then metadata, then the auto-numbered names, then a model, else other."""
    return (
        F.when(explicit.isNotNull(), explicit)
        .when(metadata_kind.isNotNull(), metadata_kind)
        .when(name.rlike("^LLM Call [0-9]+$"), "llm")
        .when(name.rlike("^Retrieval [0-9]+$"), "retrieval")
        .when(model.isNotNull(), "llm")
        .otherwise("other")
    )


# Lower bounds of the high and medium bands per metric.
BANDS = {
    "rating": (7.0, 4.0),
    "consistency": (7.0, 4.0),
    "cosine": (0.85, 0.6),
    "jaccard": (0.6, 0.3),
    "bleu": (0.6, 0.3),
    "rouge": (0.6, 0.3),
}


def rating_band(value: Column, metric: str) -> Column:
    high, medium = BANDS[metric]
    return F.when(value >= high, "high").when(value >= medium, "medium").when(value.isNotNull(), "low")


def price_valid(price_text: Column) -> Column:
    """A price must be a finite number of at least 0."""
    p = price_text.try_cast("double")
    return F.coalesce(p.isNotNull() & ~F.isnan(p) & (p >= 0) & (p < float("inf")), F.lit(False))


def ref_unwrap(ref: Column) -> Column:
    """An id given as a scalar or as an object with ``_id`` or ``id``."""
    v = F.try_parse_json(ref)
    is_object = F.coalesce(_kind(v) == "OBJECT", F.lit(False))
    return F.when(is_object, F.coalesce(_get(v, "$._id"), _get(v, "$.id"))).otherwise(F.coalesce(_get(v, "$"), ref))


def idempotency_key(run_id: Column, case_id: Column, run_number: Column) -> Column:
    return F.concat(run_id, F.lit(":"), case_id, F.lit(":run-"), run_number.cast("string"))


def agent_name(override: str | None, domain: Column, prefix: str, default: str) -> Column:
    if override:
        return F.lit(override)
    return F.when(F.nullif(domain, F.lit("")).isNotNull(), F.concat(F.lit(prefix), domain)).otherwise(default)


def message_role(bot: Column) -> Column:
    return F.when(F.coalesce(bot, F.lit("")) != "", "bot").otherwise("user")


def retrieval_join_text(docs: Column) -> tuple[Column, Column]:
    """Joined text of the retrieved chunks and their count; no chunks gives nulls."""
    some = F.size(docs) > 0
    texts = F.filter(docs, lambda d: d.isNotNull() & (d != ""))
    return F.when(some, F.array_join(texts, "\n\n---\n\n")), F.when(some, F.size(docs).cast("long"))


def wire_rename(df, names: dict[str, str], allowed: set[str]):
    """snake_case columns to their wire names; an unknown column is an error, not ignored."""
    unknown = sorted(set(df.columns) - allowed - set(names))
    if unknown:
        raise ValueError(f"unknown fields: {unknown}")
    return df.withColumnsRenamed(names)
