"""Recommendations: text for the model, parsing of its answers, rule fallback (REC-*)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions.scalars import defaulted, fixed, percent, plain_number, signed_int
from marketlake.operators import similarity
from marketlake.schemas import RECOMMENDATION_FIELDS

# fixed values: wording and defaults that results must carry unchanged
NO_PATTERNS = "No similar historical patterns found."
NO_MODEL = "LLM unavailable — using rule-based fallback."
DEFAULT_ACTION, DEFAULT_CONFIDENCE = "HOLD", 50
DEFAULT_REASONING = "Insufficient data for analysis."
DEFAULT_RISK, DEFAULT_TIMEFRAME = "MEDIUM", "short-term"
PROMPT = """Analyze the following cryptocurrency and provide a recommendation.

CURRENT STATE:
{snapshot}

SIMILAR HISTORICAL PATTERNS:
{patterns}

Based on the current technical indicators and the outcomes of similar historical patterns, 
provide your recommendation for {symbol}."""


def _join(*parts: Column | str) -> Column:
    """Concatenate columns and literal text; a Column stays, a str is literal."""
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def snapshot_text(prefix: str = "") -> Column:
    """Readable text of a snapshot (FLT-15)."""
    def c(name: str) -> Column:
        return F.col(prefix + name)

    def money(name: str) -> Column:
        return F.concat(F.lit("$"), fixed(c(name), 2, comma=True))

    return _join(
        c("name"), " (", F.upper(c("symbol")), ") on ", c("date").cast("string"), ":\n",
        "  Price: ", money("price_usd"), " (daily return: ", percent(defaulted(c("daily_return"), 0.0)), ")\n",
        "  RSI(14): ", fixed(c("rsi_14"), 1), "\n",
        "  MACD: ", fixed(c("macd_line"), 4), " (signal: ", fixed(c("macd_signal"), 4),
        ", histogram: ", fixed(c("macd_histogram"), 4, plus=True), ")\n",
        "  SMA20: ", money("sma_20"), " (price is ", fixed(c("price_vs_sma20"), 1, plus=True), "% vs SMA20)\n",
        "  SMA50: ", money("sma_50"), " (price is ", fixed(c("price_vs_sma50"), 1, plus=True), "% vs SMA50)\n",
        "  Bollinger: position ", fixed(c("bb_position"), 2), " (0=lower, 1=upper)\n",
        "  Volume: ", fixed(c("volume_ratio"), 2), "x 20-day average\n",
        "  Return streak: ", signed_int(c("return_streak")), " days\n",
        "  Signal: ", F.upper(c("signal")), " (confidence: ", c("confidence").cast("string"), "%)",
    )


def pattern_text() -> Column:
    """Text of the pattern alone, without absolute prices (FLT-16)."""
    c = F.col
    return _join(
        c("symbol"), " pattern on ", c("date").cast("string"), ": ",
        "RSI=", plain_number(c("rsi_14")), ", ",
        "MACD_hist=", fixed(c("macd_histogram"), 6, plus=True), ", ",
        "price_vs_SMA20=", fixed(c("price_vs_sma20"), 1, plus=True), "%, ",
        "price_vs_SMA50=", fixed(c("price_vs_sma50"), 1, plus=True), "%, ",
        "BB_pos=", fixed(c("bb_position"), 2), ", ",
        "vol_ratio=", fixed(c("volume_ratio"), 2), "x, ",
        "streak=", signed_int(c("return_streak")), ", ",
        "signal=", c("signal"), ", ",
        "daily_return=", fixed(defaulted("daily_return", 0.0), 4, plus=True),
    )


def _one_pattern(p: Column, number: Column) -> Column:
    def or_unknown(name: str) -> Column:
        return F.coalesce(p[name].cast("string"), F.lit("?"))

    return _join(
        "Pattern ", number.cast("string"), " (similarity: ", fixed(defaulted(p["similarity"], 0.0), 2), "):\n",
        "  ", or_unknown("symbol"), " on ", or_unknown("date"), " — ",
        "RSI: ", F.coalesce(plain_number(p["rsi_14"]), F.lit("?")), ", ",
        "MACD hist: ", F.coalesce(plain_number(p["macd_histogram"]), F.lit("?")), ", ",
        "Signal: ", or_unknown("signal"), ", ",
        "Daily return: ", percent(defaulted(p["daily_return"], 0.0)), "\n",
        "  Volume ratio: ", fixed(defaulted(p["volume_ratio"], 1.0), 2), "x",
    )


def patterns_text(patterns: Column) -> Column:
    """Numbered list of the found patterns; a fixed sentence if there are none (FLT-17).

    ``patterns`` is an array of structs ordered by rank, never longer than the
    number of neighbours asked for.
    """
    lines = F.transform(patterns, lambda p, i: _one_pattern(p, i + 1))
    return F.when(F.coalesce(F.size(patterns), F.lit(0)) > 0, F.array_join(lines, "\n")).otherwise(NO_PATTERNS)


def prompt_text(snapshot: Column, patterns: Column, symbol: Column) -> Column:
    """Prompt for an external model (FLT-18)."""
    before, rest = PROMPT.split("{snapshot}")
    middle, rest = rest.split("{patterns}")
    after, end = rest.split("{symbol}")
    return _join(before, snapshot, middle, patterns, after, F.upper(symbol), end)


# ---- answers ---------------------------------------------------------------


def answer_body(response: Column) -> Column:
    """The JSON part of an answer: inside a fence if there is one, else all of it."""
    fenced = F.regexp_extract(response, r"(?s)```json(.*?)(?:```|\z)", 1)
    plain = F.regexp_extract(response, r"(?s)```(.*?)(?:```|\z)", 1)
    body = F.when(response.contains("```json"), fenced).when(response.contains("```"), plain).otherwise(response)
    return F.regexp_replace(body, r"(?U)^\s+|\s+$", "")


BODY_END = "end of the answer"
ANSWER_FIELDS = ["action", "confidence", "reasoning", "risk_level", "timeframe"]


def parse_answers(df: DataFrame, response: str = "response") -> DataFrame:
    """Add ``parsed``, the fields of each answer, null if it cannot be used (REC-02).

    A missing key takes its default. Anything the rules cannot read makes the
    whole answer unusable: no JSON object, an action or risk level that is not
    text, a confidence that is no whole number. Built in steps, so that the
    text is parsed once and the generated code stays small.
    """
    doc = F.col("_doc")
    # The parser stops after the first value, so text behind the body would pass.
    # In front of a mark in an array the body has to be one whole value.
    listed = _join("[", F.col("_body"), f',"{BODY_END}"]')
    read = (
        df.withColumn("_body", answer_body(F.col(response)))
        .withColumn("_listed", F.try_parse_json(listed))
        .withColumn("_doc", F.when(F.try_variant_get("_listed", "$[1]", "string") == BODY_END,
                                   F.try_variant_get("_listed", "$[0]", "variant")))
    )
    typed = read.withColumns({
        **{f"_{k}": F.try_variant_get(doc, f"$.{k}", "variant") for k in ANSWER_FIELDS},
        "_type": F.schema_of_variant(doc),
    }).withColumns({
        **{f"_{k}_text": F.try_variant_get(F.col(f"_{k}"), "$", "string") for k in ANSWER_FIELDS},
        **{f"_{k}_type": F.schema_of_variant(f"_{k}") for k in ("action", "confidence", "risk_level")},
    })

    def upper_or(key: str, default: str) -> Column:
        return F.when(F.col(f"_{key}").isNull(), default).when(
            F.col(f"_{key}_type") == "STRING", F.upper(f"_{key}_text"))

    def any_or(key: str, default: str) -> Column:
        return F.when(F.col(f"_{key}").isNull(), default).otherwise(F.col(f"_{key}_text"))

    text, kind = F.col("_confidence_text"), F.col("_confidence_type")
    digits = F.regexp_replace(F.trim(text), r"(?<=\d)_(?=\d)", "")
    number = (
        F.when(kind == "STRING", F.when(digits.rlike(r"^[+-]?\d+$"), digits.try_cast("double")))
        .when(kind == "BOOLEAN", F.when(text == "true", 1.0).otherwise(0.0))
        .when(kind.rlike("^(BIGINT|DOUBLE|DECIMAL)"), text.try_cast("double"))
    )
    fields = typed.withColumns({"_action": upper_or("action", DEFAULT_ACTION),
                                "_risk_level": upper_or("risk_level", DEFAULT_RISK),
                                "_reasoning": any_or("reasoning", DEFAULT_REASONING),
                                "_timeframe": any_or("timeframe", DEFAULT_TIMEFRAME),
                                "_number": F.when(F.col("_confidence").isNull(), float(DEFAULT_CONFIDENCE))
                                .otherwise(number)})
    usable = (
        F.col("_type").startswith("OBJECT") & F.col("_action").isNotNull()
        & F.col("_risk_level").isNotNull() & F.col("_number").isNotNull()
    )
    # greatest and least skip nulls, but only usable answers get here
    confidence = F.least(F.lit(100.0), F.greatest(F.lit(0.0), F.col("_number"))).cast("int")
    packed = F.struct(
        F.col("_action").alias("action"), confidence.alias("confidence"),
        *[F.col(f"_{k}").alias(k) for k in ANSWER_FIELDS[2:]],
    )
    # through a generator: a later filter on ``parsed`` must not be rewritten into
    # a second evaluation of all of the above below the projections
    parsed = F.when(F.coalesce(usable, F.lit(False)), packed)
    return fields.select(*df.columns, F.explode(F.array(parsed)).alias("parsed"))


def rule(rsi: Column) -> Column:
    """The rule used without a usable answer (REC-01)."""
    level = fixed(rsi, 0)
    low, high = rsi < 30, rsi > 70
    return F.struct(
        F.when(low, "BUY").when(high, "SELL").otherwise("HOLD").alias("action"),
        F.when(low | high, 55).otherwise(40).alias("confidence"),
        F.when(low, _join("RSI at ", level, " indicates oversold conditions."))
        .when(high, _join("RSI at ", level, " indicates overbought conditions."))
        .otherwise(NO_MODEL).alias("reasoning"),
        F.lit(DEFAULT_RISK).alias("risk_level"),
        F.lit(DEFAULT_TIMEFRAME).alias("timeframe"),
    )


def _records(df: DataFrame, chosen: Column, found: Column, at: Column) -> DataFrame:
    return df.withColumn("_rec", chosen).select(
        "coin_id", F.upper("symbol").alias("symbol"), "name", "_rec.*",
        found.cast("int").alias("similar_patterns"), at.alias("generated_at"),
    ).select(*RECOMMENDATION_FIELDS)


def _now() -> Column:
    return F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def fallback(snapshots: DataFrame, found: Column | None = None, at: Column | None = None) -> DataFrame:
    """Rule-based record per snapshot (REC-01)."""
    none = F.lit(0) if found is None else found
    return _records(snapshots, rule(F.col("rsi_14")), none, _now() if at is None else at)


def decide(
    snapshots: DataFrame, response: str = "response", found: Column | None = None, at: Column | None = None,
) -> DataFrame:
    """Parsed answer per snapshot, or the rule where it cannot be used (REC-02, REC-03)."""
    chosen = F.coalesce("parsed", rule(F.col("rsi_14")))
    return _records(parse_answers(snapshots, response), chosen, F.lit(0) if found is None else found, _now() if at is None else at)


def with_patterns(snapshots: DataFrame, matches: DataFrame, patterns: DataFrame) -> DataFrame:
    """Attach each snapshot's matches as one ranked array plus text and prompt (REC-04).

    ``matches`` holds at most k rows per snapshot, so the arrays are short. Hand
    it in as a stored table: then Spark knows that it is the small side of the
    join with the collection.
    """
    meta = ["symbol", "date", "rsi_14", "macd_histogram", "signal", "daily_return", "volume_ratio"]
    found = matches.join(patterns.select(F.col("id").alias("match_id"), *meta), "match_id")
    listed = found.groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct("rank", "similarity", *meta))).alias("patterns")
    )
    keyed = snapshots.withColumn("query_id", similarity.pattern_id())
    out = keyed.join(listed, "query_id", "left").withColumn("similar", F.coalesce(F.size("patterns"), F.lit(0)))
    snapshot, text = snapshot_text(), patterns_text(F.col("patterns"))
    return out.withColumns({
        "snapshot_text": snapshot, "patterns_text": text,
        "prompt": prompt_text(snapshot, text, F.col("symbol")),
    }).drop("query_id")


def recommend(
    snapshots: DataFrame, matches: DataFrame, patterns: DataFrame, answer=None, at: Column | None = None,
) -> DataFrame:
    """Records for all snapshots (REC-04).

    ``answer`` maps the prompt column to a response column, for instance a
    ``pandas_udf`` around a model; without it the rule decides.
    """
    ready = with_patterns(snapshots, matches, patterns)
    if answer is None:
        return fallback(ready, F.col("similar"), at)
    return decide(ready.withColumn("response", answer(F.col("prompt"))), "response", F.col("similar"), at)
