"""Patterns, recommendations and summary marts (PAT-*, REC-*, SUM-*, FLT-15..18)."""

import re

from pyspark.sql import functions as F

from marketlake.operators import indicators, recommend, similarity, vector_index
from marketlake.plans import gold, jobs, summary
from marketlake.registry.core import query, sql
from marketlake.session import shared_folder
from marketlake.sources import tables, testbed

AT = "2001-11-05T00:00:00+00:00"


def snapshots(spark, d):
    return indicators.snapshots(testbed.facts(spark, d), testbed.coins(spark, d))


def stored_snapshots(spark, d):
    """Snapshots as the table later steps read; they need them more than once."""
    path = shared_folder(spark, "snapshots")
    tables.write_table(snapshots(spark, d), path)
    return tables.read_table(spark, path)


def recs(spark, d):
    """Rule-based records of the coins."""
    return recommend.fallback(snapshots(spark, d), at=F.lit(AT))


def answered(spark, d):
    """One record per model answer, in the order of the events."""
    out = recommend.decide(answers(spark, d), at=F.lit(AT))
    return out.withColumn("pos", F.col("coin_id").cast("bigint"))


# ---- text -------------------------------------------------------------------

# fixed text: the template must come out character by character
_MONEY = "'$' || format('{{:,.2f}}', {c})".format
_TEXT = """name || ' (' || upper(symbol) || ') on ' || CAST("date" AS VARCHAR) || ':' || chr(10)
  || '  Price: $' || format('{:,.2f}', price_usd) || ' (daily return: ' || format('{:+.2f}', daily_return * 100) || '%)' || chr(10)
  || '  RSI(14): ' || format('{:.1f}', rsi_14) || chr(10)
  || '  MACD: ' || format('{:.4f}', macd_line) || ' (signal: ' || format('{:.4f}', macd_signal) || ', histogram: ' || format('{:+.4f}', macd_histogram) || ')' || chr(10)
  || '  SMA20: $' || format('{:,.2f}', sma_20) || ' (price is ' || format('{:+.1f}', price_vs_sma20) || '% vs SMA20)' || chr(10)
  || '  SMA50: $' || format('{:,.2f}', sma_50) || ' (price is ' || format('{:+.1f}', price_vs_sma50) || '% vs SMA50)' || chr(10)
  || '  Bollinger: position ' || format('{:.2f}', bb_position) || ' (0=lower, 1=upper)' || chr(10)
  || '  Volume: ' || format('{:.2f}', volume_ratio) || 'x 20-day average' || chr(10)
  || '  Return streak: ' || format('{:+d}', return_streak) || ' days' || chr(10)
  || '  Signal: ' || upper(signal) || ' (confidence: ' || confidence || '%)'"""


@query("flt_15_snapshot_text", sql(f"SELECT coin_id, {_TEXT} AS text FROM snapshot", "snapshot"))
def snapshot_text(spark, d):
    return snapshots(spark, d).select("coin_id", recommend.snapshot_text().alias("text"))


@query("flt_16_pattern_text", sql("""
SELECT coin_id, symbol || ' pattern on ' || CAST("date" AS VARCHAR) || ': RSI=' || CAST(rsi_14 AS VARCHAR)
  || ', MACD_hist=' || format('{:+.6f}', macd_histogram) || ', price_vs_SMA20=' || format('{:+.1f}', price_vs_sma20)
  || '%, price_vs_SMA50=' || format('{:+.1f}', price_vs_sma50) || '%, BB_pos=' || format('{:.2f}', bb_position)
  || ', vol_ratio=' || format('{:.2f}', volume_ratio) || 'x, streak=' || format('{:+d}', return_streak)
  || ', signal=' || signal || ', daily_return=' || format('{:+.4f}', daily_return) AS text FROM snapshot""", "snapshot"))
def pattern_text(spark, d):
    return snapshots(spark, d).select("coin_id", recommend.pattern_text().alias("text"))


# ---- patterns ---------------------------------------------------------------

_VECTORS = """
vectors AS (
  SELECT coin_id, coin_id || '_' || CAST("date" AS VARCHAR) AS id, [
    coalesce(greatest(-4.0, least(4.0, (rsi_14 - 50) / 15.0)), 0),
    coalesce(greatest(-4.0, least(4.0, macd_histogram * 100 / nullif(price_usd, 0))), 0),
    greatest(-4.0, least(4.0, price_vs_sma20 / 10.0)),
    greatest(-4.0, least(4.0, price_vs_sma50 / 15.0)),
    greatest(-4.0, least(4.0, (bb_position - 0.5) / 0.3)),
    greatest(-4.0, least(4.0, (volume_ratio - 1) / 0.5)),
    greatest(-4.0, least(4.0, return_streak / 3.0)),
    code,
    coalesce(greatest(-4.0, least(4.0, daily_return / 0.05)), 0)] AS v
  FROM (SELECT *, CASE signal WHEN 'bullish' THEN 1.0 WHEN 'bearish' THEN -1.0 ELSE 0.0 END AS code FROM snapshot))"""


@query("pat_01_vectors", sql("""
SELECT id, i AS place, round_even(v[i] / sqrt(list_sum(list_transform(v, lambda x: x * x))), 6) AS weight
FROM (SELECT id, v, CAST(unnest(range(1, 10)) AS INTEGER) AS i FROM vectors)""", "snapshot", extra=_VECTORS))
def pattern_vectors(spark, d):
    out = similarity.pattern_vectors(stored_snapshots(spark, d))
    return out.select("id", F.posexplode("embedding").alias("place", "weight")).select(
        "id", (F.col("place") + 1).alias("place"), F.bround("weight", 6).alias("weight"))


@query("pat_02_upsert", sql("""
SELECT id, coin_id, price_usd FROM (
  SELECT coin_id || '_' || CAST("date" AS VARCHAR) AS id, coin_id,
    CASE WHEN signal = 'neutral' THEN price_usd ELSE price_usd * 2 END AS price_usd FROM snapshot)""", "snapshot"))
def upsert(spark, d):
    first = similarity.pattern_vectors(stored_snapshots(spark, d))
    text = recommend.snapshot_text()
    stored = first.withColumn("document", text)
    again = first.where("signal <> 'neutral'").withColumn("price_usd", F.col("price_usd") * 2)
    return similarity.store(stored, again, text).select("id", "coin_id", "price_usd")


def _knn_sql(k, where):
    return f"""
WITH v AS (SELECT CAST(vec_id AS VARCHAR) AS id, CAST(label AS VARCHAR) AS coin_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)
SELECT query_id, match_id, round(round(similarity, 9), 6) AS similarity, rank FROM (
  SELECT q.id AS query_id, p.id AS match_id, list_cosine_similarity(q.e, p.e) AS similarity,
    CAST(row_number() OVER (PARTITION BY q.id ORDER BY round(list_cosine_similarity(q.e, p.e), 9) DESC, p.id) AS INTEGER) AS rank
  FROM v q JOIN v p ON {where})
WHERE rank <= {k}"""


@query("pat_03_similar", _knn_sql(5, "true"))
def similar(spark, d):
    v = testbed.vectors(spark, d)
    return similarity.similar_patterns(v, v, 5, ship=True).withColumn("similarity", F.round("similarity", 6))


@query("pat_03_similar_other_coin", _knn_sql(5, "q.coin_id <> p.coin_id"))
def similar_other(spark, d):
    v = testbed.vectors(spark, d)
    out = similarity.similar_patterns(v, v, 5, exclude_same_coin=True, ship=True)
    return out.withColumn("similarity", F.round("similarity", 6))


@query("jn_07_similarity_join", _knn_sql(3, "q.id <> p.id"))
def similarity_join(spark, d):
    # the way for a query side of any size
    v = testbed.vectors(spark, d)
    out = similarity.similar_patterns(v, v, 3, exclude_self=True, chunk=256)
    return out.withColumn("similarity", F.round("similarity", 6))


@query("top_07_top_match", _knn_sql(1, "q.coin_id <> p.coin_id"))
def top_match(spark, d):
    v = testbed.vectors(spark, d)
    out = similarity.similar_patterns(v, v, 1, exclude_same_coin=True)
    return out.withColumn("similarity", F.round("similarity", 6))


@query("pat_04_approximate", """
SELECT CAST(vec_id AS VARCHAR) AS query_id, least(5, (SELECT count(*) FROM embeddings)) AS matches, true AS itself_first,
  true AS recalled FROM embeddings""")
def approximate(spark, d):
    """Every query finds k, itself first, and at least nine tenths of the exact matches are found."""
    v = testbed.vectors(spark, d)
    near = staged_matches(spark, similarity.similar_patterns(v, v, 5, probe=8, chunk=64))
    return judged(v, near)


def judged(v, near):
    """One row a query: matches, whether it is its own best match, and whether recall is at least 0.9."""
    exact = similarity.similar_patterns(v, v, 5, ship=True)
    share = exact.join(near.select("query_id", "match_id", F.lit(1).alias("hit")), ["query_id", "match_id"], "left").agg(
        F.avg(F.coalesce("hit", F.lit(0))).alias("recall"))
    own = F.max((F.col("rank") == 1) & (F.col("match_id") == F.col("query_id")))
    return near.groupBy("query_id").agg(F.count("*").alias("matches"), own.alias("itself_first")).withColumn(
        "recalled", share.scalar() >= 0.9)


@query("pat_04_index", """
SELECT CAST(vec_id AS VARCHAR) AS query_id, least(5, (SELECT count(*) FROM embeddings)) AS matches, true AS itself_first,
  true AS recalled, CASE WHEN vec_id % 4 = 0 OR vec_id % 10 = 1 THEN 2 ELSE 1 END AS run FROM embeddings""")
def indexed(spark, d):
    """An index of three quarters, a run of the rest and of some rows once more, and a search for every vector."""
    v = testbed.vectors(spark, d)
    number, folder = F.col("id").cast("bigint"), shared_folder(spark, "index")
    vector_index.build_index(v.where(number % 4 != 0), folder)
    vector_index.add_run(v.where((number % 4 == 0) | (number % 10 == 1)), folder)
    near = staged_matches(spark, vector_index.search_index(v, folder, 5))
    runs = vector_index.entries(spark, folder).select(F.col("id").alias("query_id"), "run")
    return judged(v, near).join(runs, "query_id")


def staged_matches(spark, matches):
    return jobs.stored_matches(spark, matches)


@query("pat_05_count", "SELECT count(*) AS patterns FROM embeddings")
def pattern_count(spark, d):
    return testbed.vectors(spark, d).agg(F.count("*").alias("patterns"))


@query("pat_06_store_counts", """
SELECT CASE WHEN n_null THEN 'vector has missing values' ELSE 'stored' END AS outcome, count(*) AS n
FROM (SELECT label = 3 AS n_null FROM embeddings) GROUP BY 1""")
def store_counts(spark, d):
    v = testbed.vectors(spark, d).withColumn("date", F.lit("2001-11-04"))
    broken = F.when(F.col("coin_id") == "3", F.transform("embedding", lambda x: F.lit(None).cast("double"))).otherwise(
        F.col("embedding"))
    marked = similarity.split_storable(v.withColumn("embedding", broken))
    return marked.groupBy(F.coalesce("error", F.lit("stored")).alias("outcome")).agg(F.count("*").alias("n"))


# ---- recommendations --------------------------------------------------------

_REC = "coin_id, symbol, name, action, CAST(confidence AS INTEGER) AS confidence, reasoning, risk_level, timeframe"


@query("rec_01_rule", sql(f"SELECT {_REC} FROM recs", "recs"))
def rule(spark, d):
    return recommend.fallback(snapshots(spark, d), at=F.lit(AT)).drop("similar_patterns", "generated_at")


_FENCE = "'```'"
_ANSWERS = """
answers AS (
  SELECT event_id, event_type, "value" AS rsi_14, CASE event_id % 12
    WHEN 0 THEN '```json' || chr(10) || body || chr(10) || '```'
    WHEN 1 THEN 'Here it is: ```' || body || '``` done'
    WHEN 2 THEN body
    WHEN 3 THEN '{"action": "sell", "confidence": "80", "reasoning": "text"}'
    WHEN 4 THEN '{"action": "BUY", "confidence": 150, "risk_level": "high"}'
    WHEN 5 THEN '{"action": "hold", "confidence": -5, "timeframe": "medium-term"}'
    WHEN 6 THEN '{}'
    WHEN 7 THEN '{"action": "buy", "confidence": "80%"}'
    WHEN 8 THEN '{"action": null, "confidence": 70}'
    WHEN 9 THEN 'I would hold ' || event_type
    WHEN 10 THEN '[1, 2]'
    ELSE '{"action": "buy", "confidence": 61.9, "reasoning": null}' END AS response
  FROM (SELECT *, '{"action": "' || event_type || '", "confidence": ' || CAST(event_id % 120 AS VARCHAR)
    || ', "reasoning": "user ' || CAST(user_id AS VARCHAR) || '", "risk_level": "low"}' AS body FROM events))"""


def answers(spark, d):
    """Answers of every usable and unusable shape, one per event."""
    e = testbed.table(spark, d, "events")
    body = F.concat(
        F.lit('{"action": "'), "event_type", F.lit('", "confidence": '), (F.col("event_id") % 120).cast("string"),
        F.lit(', "reasoning": "user '), F.col("user_id").cast("string"), F.lit('", "risk_level": "low"}'))
    shapes = [
        F.concat(F.lit("```json\n"), body, F.lit("\n```")),
        F.concat(F.lit("Here it is: ```"), body, F.lit("``` done")),
        body,
        F.lit('{"action": "sell", "confidence": "80", "reasoning": "text"}'),
        F.lit('{"action": "BUY", "confidence": 150, "risk_level": "high"}'),
        F.lit('{"action": "hold", "confidence": -5, "timeframe": "medium-term"}'),
        F.lit("{}"),
        F.lit('{"action": "buy", "confidence": "80%"}'),
        F.lit('{"action": null, "confidence": 70}'),
        F.concat(F.lit("I would hold "), "event_type"),
        F.lit("[1, 2]"),
        F.lit('{"action": "buy", "confidence": 61.9, "reasoning": null}'),
    ]
    chosen = F.element_at(F.array(*shapes), (F.col("event_id") % len(shapes) + 1).cast("int"))
    return e.select(
        F.col("event_id").cast("string").alias("coin_id"), F.col("event_type").alias("symbol"),
        F.col("event_type").alias("name"), F.col("value").alias("rsi_14"), chosen.alias("response"))


_PARSED = """
bodies AS (
  SELECT *, trim(CASE WHEN contains(response, '```json') THEN split_part(split_part(response, '```json', 2), '```', 1)
    WHEN contains(response, '```') THEN split_part(response, '```', 2) ELSE response END, chr(10) || ' ') AS b FROM answers),
docs AS (
  SELECT *, CASE WHEN json_valid(b) THEN CAST(b AS JSON) END AS j FROM bodies),
parsed AS (
  SELECT *, json_type(j, '$.confidence') AS ct, json_extract_string(j, '$.confidence') AS cv,
    CASE WHEN NOT json_exists(j, '$.action') THEN 'HOLD' WHEN json_type(j, '$.action') = 'VARCHAR'
      THEN upper(json_extract_string(j, '$.action')) END AS action,
    CASE WHEN NOT json_exists(j, '$.risk_level') THEN 'MEDIUM' WHEN json_type(j, '$.risk_level') = 'VARCHAR'
      THEN upper(json_extract_string(j, '$.risk_level')) END AS risk_level,
    CASE WHEN NOT json_exists(j, '$.reasoning') THEN 'Insufficient data for analysis.'
      ELSE json_extract_string(j, '$.reasoning') END AS reasoning,
    CASE WHEN NOT json_exists(j, '$.timeframe') THEN 'short-term' ELSE json_extract_string(j, '$.timeframe') END AS timeframe
  FROM docs),
scored AS (
  SELECT *, CASE WHEN NOT json_exists(j, '$.confidence') THEN 50
    WHEN ct = 'VARCHAR' AND NOT regexp_full_match(cv, '[+-]?[0-9]+') THEN NULL
    ELSE CAST(least(100, greatest(0, trunc(TRY_CAST(cv AS DOUBLE)))) AS INTEGER) END AS confidence FROM parsed),
decided AS (
  SELECT *, coalesce(json_type(j) = 'OBJECT' AND action IS NOT NULL AND confidence IS NOT NULL
    AND risk_level IS NOT NULL, false) AS usable FROM scored)"""


@query("rec_02_parsed_answers", sql("""
SELECT CAST(event_id AS VARCHAR) AS coin_id, action, confidence, reasoning, risk_level, timeframe FROM decided WHERE usable""",
    extra=_ANSWERS.strip() + "," + _PARSED))
def parsed_answers(spark, d):
    return recommend.parse_answers(answers(spark, d)).where("parsed IS NOT NULL").select("coin_id", "parsed.*")


@query("rec_03_fallback", sql("""
SELECT CAST(event_id AS VARCHAR) AS coin_id,
  CASE WHEN usable THEN action WHEN rsi_14 < 30 THEN 'BUY' WHEN rsi_14 > 70 THEN 'SELL' ELSE 'HOLD' END AS action,
  CASE WHEN usable THEN confidence WHEN rsi_14 < 30 OR rsi_14 > 70 THEN 55 ELSE 40 END AS confidence,
  CASE WHEN usable THEN reasoning
       WHEN rsi_14 < 30 THEN 'RSI at ' || format('{:.0f}', rsi_14) || ' indicates oversold conditions.'
       WHEN rsi_14 > 70 THEN 'RSI at ' || format('{:.0f}', rsi_14) || ' indicates overbought conditions.'
       ELSE 'LLM unavailable — using rule-based fallback.' END AS reasoning,
  CASE WHEN usable THEN risk_level ELSE 'MEDIUM' END AS risk_level,
  CASE WHEN usable THEN timeframe ELSE 'short-term' END AS timeframe
FROM decided""", extra=_ANSWERS.strip() + "," + _PARSED))
def with_fallback(spark, d):
    return recommend.decide(answers(spark, d), at=F.lit(AT)).drop("symbol", "name", "similar_patterns", "generated_at")


def _matched(spark, d):
    """All coins matched against the stored collection."""
    path = shared_folder(spark, "patterns")
    tables.write_table(similarity.pattern_vectors(stored_snapshots(spark, d)), path)
    patterns = tables.read_table(spark, path)
    return patterns, jobs.stored_matches(spark, similarity.similar_patterns(patterns, patterns, 5, ship=True)), patterns


_FOUND = _VECTORS + """,
near AS (
  SELECT q.coin_id, p.coin_id AS other, round(list_cosine_similarity(q.v, p.v), 9) AS similarity,
    row_number() OVER (PARTITION BY q.id ORDER BY round(list_cosine_similarity(q.v, p.v), 9) DESC, p.id) AS rank
  FROM vectors q, vectors p QUALIFY rank <= 5),
listed AS (
  SELECT n.coin_id, count(*) AS similar_patterns, string_agg('Pattern ' || n.rank || ' (similarity: ' || format('{:.2f}', n.similarity)
    || '):' || chr(10) || '  ' || s.symbol || ' on ' || CAST(s."date" AS VARCHAR) || ' — RSI: ' || CAST(s.rsi_14 AS VARCHAR)
    || ', MACD hist: ' || CAST(s.macd_histogram AS VARCHAR) || ', Signal: ' || s.signal || ', Daily return: '
    || format('{:+.2f}', s.daily_return * 100) || '%' || chr(10) || '  Volume ratio: ' || format('{:.2f}', s.volume_ratio) || 'x',
    chr(10) ORDER BY n.rank) AS patterns_text
  FROM near n JOIN snapshot s ON s.coin_id = n.other GROUP BY n.coin_id)"""


@query("rec_04_recommend", sql(f"""
SELECT coin_id, symbol, name, action, CAST(confidence AS INTEGER) AS confidence, reasoning, risk_level, timeframe,
  CAST(similar_patterns AS INTEGER) AS similar_patterns, '{AT}' AS generated_at FROM recs JOIN listed USING (coin_id)""",
    "recs", extra=_FOUND))
def recommend_all(spark, d):
    top, matches, patterns = _matched(spark, d)
    return recommend.recommend(top, matches, patterns, at=F.lit(AT))


@query("flt_17_patterns_text", sql("SELECT coin_id, patterns_text FROM listed", "snapshot", extra=_FOUND))
def patterns_text(spark, d):
    top, matches, patterns = _matched(spark, d)
    return recommend.with_patterns(top, matches, patterns).select("coin_id", "patterns_text")


_PROMPT_SQL = " || ".join(
    {"snapshot": f"({_TEXT})", "patterns": "patterns_text", "symbol": "upper(symbol)"}.get(
        part, "'" + part.replace("'", "''") + "'")
    for part in re.split(r"[{}]", recommend.PROMPT))


@query("flt_18_prompt", sql(
    f"SELECT coin_id, {_PROMPT_SQL} AS prompt FROM snapshot JOIN listed USING (coin_id)", "snapshot", extra=_FOUND))
def prompt(spark, d):
    top, matches, patterns = _matched(spark, d)
    return recommend.with_patterns(top, matches, patterns).select("coin_id", "prompt")


# ---- summary ----------------------------------------------------------------

_FINAL = """
final AS (
  SELECT event_id, upper(event_type) AS symbol, CASE WHEN usable THEN risk_level ELSE 'MEDIUM' END AS risk_level,
    CASE WHEN usable THEN reasoning
         WHEN rsi_14 < 30 THEN 'RSI at ' || format('{:.0f}', rsi_14) || ' indicates oversold conditions.'
         WHEN rsi_14 > 70 THEN 'RSI at ' || format('{:.0f}', rsi_14) || ' indicates overbought conditions.'
         ELSE 'LLM unavailable — using rule-based fallback.' END AS reasoning,
    CASE WHEN usable THEN action WHEN rsi_14 < 30 THEN 'BUY' WHEN rsi_14 > 70 THEN 'SELL' ELSE 'HOLD' END AS action,
    CASE WHEN usable THEN confidence WHEN rsi_14 < 30 OR rsi_14 > 70 THEN 55 ELSE 40 END AS confidence
  FROM decided),
counts AS (
  SELECT count(*) FILTER (WHERE action = 'BUY') AS buy, count(*) FILTER (WHERE action = 'SELL') AS sell,
    count(*) FILTER (WHERE action = 'HOLD') AS hold, count(*) AS total_coins FROM final),
felt AS (
  SELECT *, CASE WHEN buy > sell * 2 THEN 'BULLISH' WHEN sell > buy * 2 THEN 'BEARISH' ELSE 'NEUTRAL' END AS market_sentiment
  FROM counts)"""
_RUN = ",".join([_ANSWERS.strip(), _PARSED, _FINAL])


def _top_sql(action):
    return sql(f"""
SELECT CAST(event_id AS VARCHAR) AS coin_id, symbol, action, CAST(confidence AS INTEGER) AS confidence, risk_level, reasoning,
  CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (ORDER BY confidence DESC, event_id) AS rank FROM final WHERE action = '{action}')
WHERE rank <= 3""", extra=_RUN)


def _listed_sql(action):
    """The three records of a top list as text."""
    return f"""(SELECT coalesce(string_agg(concat_ws('|', rank, event_id, symbol, action, confidence, risk_level, coalesce(reasoning, '')),
    ';' ORDER BY rank), '') FROM (SELECT *, row_number() OVER (ORDER BY confidence DESC, event_id) AS rank FROM final WHERE action = '{action}')
    WHERE rank <= 3)"""


@query("sum_01_market_summary", sql(f"""
SELECT market_sentiment, buy, sell, hold, total_coins, '{AT}' AS generated_at,
  {_listed_sql("BUY")} AS top_buys, {_listed_sql("SELL")} AS top_sells FROM felt""", extra=_RUN))
def market_summary(spark, d):
    def listed(name):
        fields = ["rank", *summary.TOP_COLUMNS]
        return F.array_join(F.transform(name, lambda x: F.concat_ws("|", *[F.coalesce(x[f].cast("string"), F.lit("")) for f in fields])), ";").alias(name)

    return summary.market_summary(answered(spark, d)).select(
        "market_sentiment", "signal_counts.*", "total_coins", "generated_at", listed("top_buys"), listed("top_sells"))


@query("agg_05_conditional_counts", sql("SELECT buy, sell, hold FROM counts", extra=_RUN))
def conditional_counts(spark, d):
    return summary.signal_counts(answered(spark, d)).select("buy", "sell", "hold")


@query("sum_02_recommendations", sql(f"""
SELECT coin_id, symbol, name, action, CAST(confidence AS INTEGER) AS confidence, risk_level, reasoning,
  '{AT}' AS generated_at FROM recs""", "recs"))
def recommendations_table(spark, d):
    return summary.recommendations_table(recs(spark, d))


@query("sum_03_indicators", sql("""
SELECT coin_id, symbol, name, price_usd, rsi_14, macd_line, macd_signal, macd_histogram, sma_20, sma_50, bb_position,
  volume_ratio, signal, confidence FROM snapshot""", "snapshot"))
def indicators_table(spark, d):
    return summary.indicators_table(snapshots(spark, d))


for _name, _action in (("buys", "BUY"), ("sells", "SELL")):
    @query(f"sum_04_top_{_name}", _top_sql(_action))
    def top_actions(spark, d, action=_action):
        return summary.top_actions(answered(spark, d), action)


@query("sum_05_metrics", sql("""
SELECT 'market_sentiment' AS target, market_sentiment AS "value" FROM felt
UNION ALL SELECT 'total_coins', CAST(total_coins AS VARCHAR) FROM felt
UNION ALL SELECT 'signal_counts.buy', CAST(buy AS VARCHAR) FROM felt
UNION ALL SELECT 'signal_counts.sell', CAST(sell AS VARCHAR) FROM felt
UNION ALL SELECT 'signal_counts.hold', CAST(hold AS VARCHAR) FROM felt""", extra=_RUN))
def metrics(spark, d):
    return summary.metrics(summary.market_summary(answered(spark, d)))


@query("flt_10_dotted_path", sql(
    "SELECT 'signal_counts.buy' AS target, CAST(buy AS VARCHAR) AS \"value\" FROM felt", extra=_RUN))
def dotted(spark, d):
    return summary.metric(summary.market_summary(answered(spark, d)), "signal_counts.buy")


@query("sum_06_tag_values", sql("""
SELECT 'coin_id' AS kind, coin_id AS text FROM snapshot UNION SELECT 'signal', signal FROM snapshot""", "snapshot"))
def tags(spark, d):
    return summary.tag_values(snapshots(spark, d), recs(spark, d))


@query("sum_06_tag_keys", sql("""
SELECT 'coin_id' AS text, 'string' AS type, count(DISTINCT coin_id) AS n FROM snapshot
UNION ALL SELECT 'signal', 'string', count(DISTINCT signal) FROM snapshot""", "snapshot"))
def tag_keys(spark, d):
    rows = snapshots(spark, d)
    found = summary.tag_values(rows, recs(spark, d)).groupBy(F.col("kind").alias("text")).agg(F.count("*").alias("n"))
    return summary.tag_keys(rows).join(found, "text")


@query("sum_07_health", sql("""
SELECT 'ok' AS status, (SELECT count(*) FROM recs) AS recommendations_loaded, (SELECT count(*) FROM snapshot) AS indicators_loaded""",
    "recs"))
def health(spark, d):
    return summary.health(recs(spark, d), snapshots(spark, d))


@query("sum_08_explorer", sql("""
SELECT coin_id, symbol, name, round_even(price_usd, 4) AS price_usd, rsi_14, round_even(macd_histogram, 4) AS macd_histogram,
  sma_20, sma_50, bb_position, volume_ratio, signal, confidence
FROM snapshot WHERE signal IN ('bullish', 'bearish') ORDER BY rsi_14""", "snapshot"))
def explorer(spark, d):
    return summary.explore(snapshots(spark, d), ["bullish", "bearish"], "rsi_14")


@query("sum_09_run_check", sql("""
SELECT count(*) AS rows, min(coin_id) AS coin_id, arg_min(signal, coin_id) AS signal, arg_min(rsi_14, coin_id) AS rsi_14
FROM snapshot""", "snapshot"))
def run_check(spark, d):
    return summary.run_check(snapshots(spark, d))
