"""Prices, decisions and published picks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.functions.market import (
    decimal_odds,
    devig_two_way,
    disagreement_pp,
    expected_value,
    implied_prob,
    kelly_fraction,
    vig_percent,
)
from tallyframe.functions.scalars import wall_clock
from tallyframe.operators.decisions import (
    anchor_market,
    attach_latest,
    available_books,
    build_picks,
    feature_map,
    map_names,
    odds_game_count,
    pick_json,
    picks_with_outcomes,
)
from tallyframe.operators.views import distinct_games
from tallyframe.operators.windows import rolling_outputs, trailing
from tallyframe.sources.landing import outcome_rows, parse_odds

from .base import GAMES, ODDS_SQL, WINDOW, customer_bound, customer_games, load, odds_games, rolled_sql, six
from .registry import query

# Prices of both signs, zero included, from every line item.
_PRICED = """priced AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice,
  CASE WHEN l_linenumber % 2 = 0 THEN -(100 + l_quantity::INTEGER * 4) ELSE (l_quantity::INTEGER - 1) * 6 END AS home_odds,
  CASE WHEN l_returnflag = 'R' THEN 100 + l_quantity::INTEGER * 3 ELSE -(105 + l_linenumber * 3) END AS away_odds, round(l_discount * 10.5, 4) AS prob FROM lineitem)"""


def priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = F.col("l_quantity").cast("int")
    return load(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        "l_extendedprice",
        F.when(F.col("l_linenumber") % 2 == 0, -(quantity * 4 + 100)).otherwise((quantity - 1) * 6).alias("home_odds"),
        F.when(F.col("l_returnflag") == "R", quantity * 3 + 100).otherwise(-(F.col("l_linenumber") * 3 + 105)).alias("away_odds"),
        F.round(F.col("l_discount") * 10.5, 4).alias("prob"),
    )


_ID = ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"]
_IDS = ", ".join(_ID)


def _implied(c: str) -> str:
    return f"(CASE WHEN {c} < 0 THEN -{c} / (-{c} + 100.0::DOUBLE) WHEN {c} > 0 THEN 100.0::DOUBLE / ({c} + 100) END)"


def _decimal(c: str) -> str:
    return f"(CASE WHEN {c} < 0 THEN 1 + 100.0::DOUBLE / -{c} WHEN {c} > 0 THEN 1 + {c} / 100.0::DOUBLE END)"


def _ev(p: str, c: str) -> str:
    return f"(CASE WHEN {p} BETWEEN 0 AND 1 THEN {p} * ({_decimal(c)} - 1) - (1 - {p}) END)"


def _kelly(p: str, c: str, scale: str) -> str:
    return (
        f"(CASE WHEN {p} BETWEEN 0 AND 1 AND {c} <> 0 THEN greatest(({p} * {_decimal(c)} - 1) / ({_decimal(c)} - 1), 0) * {scale} END)"
    )


_H, _A = _implied("home_odds"), _implied("away_odds")
_FAIR = f"CASE WHEN {_H} + {_A} > 1 THEN {_H} / ({_H} + {_A}) END"
_FAIR_AWAY = f"CASE WHEN {_H} + {_A} > 1 THEN {_A} / ({_H} + {_A}) END"


@query("implied_prob", f"WITH {_PRICED} SELECT {_IDS}, home_odds, round({_H}, 6) AS home_implied_prob, round({_A}, 6) AS away_implied_prob FROM priced")
def implied(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = priced(spark, sf_dir).select(
        *_ID, "home_odds", implied_prob("home_odds").alias("home_implied_prob"), implied_prob("away_odds").alias("away_implied_prob")
    )
    return six(out, "home_implied_prob", "away_implied_prob")


@query("decimal_odds", f"WITH {_PRICED} SELECT {_IDS}, round({_decimal('home_odds')}, 6) AS decimal_odds FROM priced")
def decimals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return six(priced(spark, sf_dir).select(*_ID, decimal_odds("home_odds").alias("decimal_odds")), "decimal_odds")


@query("devig", f"WITH {_PRICED} SELECT {_IDS}, round({_FAIR}, 6) AS fair_home, round({_FAIR_AWAY}, 6) AS fair_away FROM priced")
def devig(spark: SparkSession, sf_dir: str) -> DataFrame:
    fair = priced(spark, sf_dir).withColumn("fair", devig_two_way("home_odds", "away_odds"))
    return six(fair.select(*_ID, "fair.*"), "fair_home", "fair_away")


@query("vig_percent", f"WITH {_PRICED} SELECT {_IDS}, round(({_H} + {_A} - 1) * 100, 6) AS vig_percent FROM priced")
def vig(spark: SparkSession, sf_dir: str) -> DataFrame:
    return six(priced(spark, sf_dir).select(*_ID, vig_percent("home_odds", "away_odds").alias("vig_percent")), "vig_percent")


@query("expected_value", f"WITH {_PRICED} SELECT {_IDS}, prob, round({_ev('prob', 'home_odds')}, 6) AS ev FROM priced")
def ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return six(priced(spark, sf_dir).select(*_ID, "prob", expected_value("prob", "home_odds").alias("ev")), "ev")


@query(
    "kelly",
    f"WITH {_PRICED} SELECT {_IDS}, round({_kelly('prob', 'home_odds', '1')}, 6) AS kelly_full, round({_kelly('prob', 'home_odds', '0.5::DOUBLE')}, 6) AS kelly_half, "
    f"round(CASE WHEN {_kelly('prob', 'home_odds', '0.5::DOUBLE')} > 0.05 THEN 0.05::DOUBLE ELSE {_kelly('prob', 'home_odds', '0.5::DOUBLE')} END, 6) AS kelly_capped FROM priced",
)
def kelly(spark: SparkSession, sf_dir: str) -> DataFrame:
    stakes = priced(spark, sf_dir).select(
        *_ID,
        kelly_fraction("prob", "home_odds").alias("kelly_full"),
        kelly_fraction("prob", "home_odds", 0.5).alias("kelly_half"),
    )
    half = F.col("kelly_half")
    out = stakes.withColumn("kelly_capped", F.when(half.isNotNull(), F.least(half, F.lit(0.05))))
    return six(out, "kelly_full", "kelly_half", "kelly_capped")


@query("disagreement", f"WITH {_PRICED} SELECT {_IDS}, round(abs(prob - ({_FAIR})) * 100, 6) AS disagreement_pp FROM priced")
def disagreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    fair = devig_two_way("home_odds", "away_odds")["fair_home"]
    return six(priced(spark, sf_dir).select(*_ID, disagreement_pp("prob", fair).alias("disagreement_pp")), "disagreement_pp")


# ---- odds -----------------------------------------------------------------------

_FETCHED = "2030-01-01T00:00:00Z"


def odds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested quotes of every order as long rows."""
    return outcome_rows(odds_games(spark, sf_dir), F.lit(_FETCHED).cast("timestamp"))


@query(
    "odds_flatten",
    f"WITH {ODDS_SQL} SELECT game_id, game_date, strftime(commence_ts, '%Y-%m-%d %H:%M:%S') AS commence_time, home_team, away_team, sportsbook, market_type, "
    "outcome_name, price, point FROM odds",
)
def odds_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON text per order, parsed and flattened."""
    text = odds_games(spark, sf_dir).select(F.to_json(F.struct("*")).alias("body"))
    long = parse_odds(text, "body", F.lit(_FETCHED).cast("timestamp"))
    return long.withColumn("commence_time", F.date_format(wall_clock("commence_time", "UTC"), "yyyy-MM-dd HH:mm:ss")).drop("fetched_at")


@query("available_books", f"WITH {ODDS_SQL} SELECT DISTINCT game_id, sportsbook FROM odds")
def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    return available_books(odds(spark, sf_dir))


@query("odds_game_count", f"WITH {ODDS_SQL} SELECT count(DISTINCT game_id) AS n_games FROM odds")
def game_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odds_game_count(odds(spark, sf_dir))


@query("distinct_games", f"WITH {ODDS_SQL} SELECT DISTINCT game_id, home_team, away_team FROM odds")
def games_of_odds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_games(odds(spark, sf_dir))


@query(
    "odds_for_date",
    f"WITH {ODDS_SQL}, last AS (SELECT max(o_orderdate::DATE) AS d FROM orders) SELECT game_id, sportsbook, market_type, outcome_name, price FROM odds, last WHERE game_date = last.d",
)
def odds_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest order date's prices."""
    newest = load(spark, sf_dir, "orders").agg(F.max(F.to_date("o_orderdate")).alias("game_date"))
    return odds(spark, sf_dir).join(newest, "game_date", "left_semi").select(
        "game_id", "sportsbook", "market_type", "outcome_name", "price"
    )


@query(
    "name_map_join",
    "SELECT c_custkey, n_name AS name, CASE WHEN n_nationkey < 20 THEN n_nationkey END AS code FROM customer JOIN nation ON c_nationkey = n_nationkey",
)
def names_mapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full names to codes; names the mapping does not hold get NULL."""
    nation = load(spark, sf_dir, "nation")
    named = load(spark, sf_dir, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    mapping = nation.filter("n_nationkey < 20").select(F.col("n_name").alias("name"), F.col("n_nationkey").alias("code"))
    out = map_names(named.select("c_custkey", F.col("n_name").alias("name")), "name", "code", mapping)
    return out.select("c_custkey", "name", "code")


_ANCHOR = """anchor AS (
  SELECT game_id, max(game_date) AS game_date, max(home_team) AS home_team_full, max(away_team) AS away_team_full,
    max(CASE WHEN sportsbook = 'pinnacle' AND market_type = 'h2h' AND outcome_name = home_team THEN price END) AS home_odds,
    max(CASE WHEN sportsbook = 'pinnacle' AND market_type = 'h2h' AND outcome_name = away_team AND away_team <> 'Status P' THEN price END) AS away_odds,
    bool_or(away_team = 'Status P') AS unknown, bool_or(sportsbook = 'pinnacle') AS has_anchor
  FROM odds GROUP BY game_id),
market AS (SELECT *, CASE WHEN unknown THEN 'unknown_team_name' WHEN NOT has_anchor THEN 'no_anchor_book' END AS reject_reason FROM anchor)"""


def code_of(name: Column) -> Column:
    """"Status P" is a name the feed uses and the mapping does not know."""
    return F.when(name == "Status P", F.lit(None).cast("string")).otherwise(
        F.regexp_replace(name, "^(Customer|Status) ", "C")
    )


def market(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchor_market(
        odds(spark, sf_dir),
        code=code_of(F.col("outcome_name")),
        home_code=code_of(F.col("home_team")),
        away_code=code_of(F.col("away_team")),
    )


@query(
    "anchor_market",
    f"WITH {ODDS_SQL}, {_ANCHOR} SELECT game_id, game_date, home_team_full, away_team_full, home_odds, away_odds, reject_reason FROM market",
)
def anchored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market(spark, sf_dir).select(
        "game_id", "game_date", "home_team_full", "away_team_full", "home_odds", "away_odds", "reject_reason"
    )


# ---- picks ----------------------------------------------------------------------

# Entering-the-event win share of the customer is the probability; on a first
# event there is none, which rejects the game.
_PROB_WINDOW = "PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING"
_PROBS = f"""probs AS (SELECT o_orderkey::VARCHAR AS game_id, round(0.5::DOUBLE + 0.25::DOUBLE * avg((o_orderstatus = 'F')::INTEGER) OVER ({_PROB_WINDOW}), 4) AS p,
  (o_totalprice > 300000) AS home_won, true AS known, o_orderdate::DATE AS order_date FROM orders)"""
# Decisions over ``market`` and ``probs``.
_JUDGED = f"""judged0 AS (SELECT game_id, game_date, home_team_full, away_team_full, home_odds, away_odds, p, home_won,
    coalesce(reject_reason, CASE WHEN NOT known THEN 'missing_features' WHEN home_odds IS NULL OR away_odds IS NULL THEN 'missing_price' WHEN home_odds = 0 OR away_odds = 0 THEN 'invalid_price'
      WHEN p IS NULL OR NOT p BETWEEN 0 AND 1 THEN 'invalid_probability' WHEN NOT {_H} + {_A} > 1 THEN 'market_without_margin' END) AS reject_reason,
    {_FAIR} AS fair_home_prob, {_ev('p', 'home_odds')} AS ev_home, {_ev('(1 - p)', 'away_odds')} AS ev_away, ({_H} + {_A} - 1) * 100 AS vig_percent
  FROM market JOIN probs USING (game_id)),
judged AS (SELECT *, abs(p - fair_home_prob) * 100 AS disagreement_pp, CASE WHEN abs(p - fair_home_prob) * 100 > 10 THEN 'no_bet' WHEN ev_home > 0 AND ev_home >= ev_away THEN 'home'
    WHEN ev_away > 0 THEN 'away' ELSE 'no_bet' END AS pick_side FROM judged0),
staked AS (SELECT *, CASE pick_side WHEN 'home' THEN {_kelly('p', 'home_odds', '0.5::DOUBLE')} WHEN 'away' THEN {_kelly('(1 - p)', 'away_odds', '0.5::DOUBLE')} END AS raw_kelly FROM judged),
picks AS (SELECT game_id AS pick_id, game_date, home_team_full, away_team_full, p AS model_prob_home_win, home_odds, away_odds, home_won,
    round(fair_home_prob, 6) AS fair_home_prob, round(vig_percent, 6) AS vig_percent, pick_side,
    CASE pick_side WHEN 'home' THEN home_odds WHEN 'away' THEN away_odds END AS pick_american_odds,
    round(CASE pick_side WHEN 'home' THEN ev_home WHEN 'away' THEN ev_away END, 6) AS expected_value, round(CASE WHEN raw_kelly > 0.05 THEN 0.05::DOUBLE ELSE raw_kelly END, 6) AS kelly_fraction_half,
    round(disagreement_pp, 6) AS disagreement_pp, CASE WHEN pick_side = 'no_bet' THEN CASE WHEN disagreement_pp > 10 THEN 'disagreement_too_large' ELSE 'no_edge' END END AS no_bet_reason,
    coalesce(raw_kelly > 0.05, false) AS kelly_was_capped FROM staked WHERE reject_reason IS NULL)"""


def decided_sql(probs: str) -> str:
    """CTEs down to ``staked`` and ``picks`` for the games of a ``probs`` table."""
    return f"{ODDS_SQL}, {_ANCHOR}, {probs}, {_JUDGED}"


DECIDED = decided_sql(_PROBS)
PICK_COLUMNS = (
    "pick_id, game_date, home_team_full, away_team_full, model_prob_home_win, home_odds, away_odds, fair_home_prob, vig_percent, pick_side, pick_american_odds, "
    "expected_value, kelly_fraction_half, disagreement_pp, no_bet_reason, kelly_was_capped"
)


def decisions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = load(spark, sf_dir, "orders")
    won = (F.col("o_orderstatus") == "F").cast("int")
    probs = trailing(
        orders,
        {"share": F.avg(won)},
        ["o_custkey"],
        ["o_orderdate", "o_orderkey"],
        WINDOW,
        include_current=False,
    ).select(
        F.col("o_orderkey").cast("string").alias("game_id"),
        F.round(F.col("share") * 0.25 + 0.5, 4).alias("model_prob_home_win"),
        F.col("share").alias("home_rolling_win_pct"),
    )
    games = market(spark, sf_dir).join(probs, "game_id")
    return build_picks(
        games,
        "catalog",
        F.lit(_FETCHED).cast("timestamp"),
        feature_names=["home_rolling_win_pct"],
    )


def flat_picks(picks: DataFrame) -> DataFrame:
    out = picks.select(
        "pick_id",
        "game_date",
        "home_team_full",
        "away_team_full",
        "model_prob_home_win",
        F.col("market.home_odds_american").alias("home_odds"),
        F.col("market.away_odds_american").alias("away_odds"),
        F.col("market.fair_home_prob").alias("fair_home_prob"),
        F.col("market.vig_percent").alias("vig_percent"),
        "pick_side",
        "pick_american_odds",
        "expected_value",
        "kelly_fraction_half",
        "disagreement_pp",
        "no_bet_reason",
        "kelly_was_capped",
    )
    return six(out, "fair_home_prob", "vig_percent", "expected_value", "kelly_fraction_half", "disagreement_pp")


@query("picks", f"WITH {DECIDED} SELECT {PICK_COLUMNS} FROM picks")
def picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_picks(decisions(spark, sf_dir)[0])


@query(
    "pick_rejects",
    f"WITH {DECIDED} SELECT game_id, game_date, home_team_full, away_team_full, reject_reason FROM staked WHERE reject_reason IS NOT NULL",
)
def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decisions(spark, sf_dir)[1]


def _document(texts: dict[str, str], numbers: dict[str, str]) -> T.StructType:
    """The parts of a published pick at the given paths; texts as written, numbers as doubles."""
    leaves = [(p, T.StringType()) for p in texts.values()] + [(p, T.DoubleType()) for p in numbers.values()]
    parts: dict[str, T.StructType] = {name: T.StructType() for name in ("market", "model_features")}
    whole = T.StructType()
    for path, kind in [*leaves, ("$.model_features.home_rolling_win_pct", T.DoubleType())]:
        *above, name = path.split(".")[1:]
        (parts[above[0]] if above else whole).add(name, kind)
    for name, part in parts.items():
        whole = whole.add(name, part)
    return whole


@query(
    "json_out",
    f"""WITH {DECIDED} SELECT pick_id, game_date, strftime(game_date, '%Y-%m-%d') AS doc_date, '2030-01-01T00:00:00+00:00' AS doc_published, pick_side AS doc_side,
      home_odds::VARCHAR AS doc_home_odds, kelly_was_capped::VARCHAR AS doc_capped, no_bet_reason AS doc_reason, home_team_full AS doc_home, away_team_full AS doc_away,
      'catalog' AS doc_model, 'pinnacle' AS doc_book, away_odds::VARCHAR AS doc_away_odds, pick_american_odds::VARCHAR AS doc_pick_odds,
      round(model_prob_home_win, 6) AS doc_prob, expected_value AS doc_value, kelly_fraction_half AS doc_kelly, round_even(raw_gap, 4) AS doc_disagreement,
      fair_home_prob AS doc_fair, round_even(raw_vig, 4) AS doc_vig, 10.0::DOUBLE AS doc_max_disagreement, 0.05::DOUBLE AS doc_max_kelly,
      round((model_prob_home_win - 0.5) * 4, 2) AS doc_feature,
      'Made by a model for study. It can be wrong and is no advice to stake money.' AS doc_notes, 22 AS n_fields, true AS keys_sorted
      FROM picks JOIN (SELECT game_id AS pick_id, disagreement_pp AS raw_gap, vig_percent AS raw_vig FROM staked) raw USING (pick_id)""",
)
def json_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published text, read back field by field."""
    docs = pick_json(decisions(spark, sf_dir)[0])
    texts = {
        "doc_date": "$.game_date",
        "doc_published": "$.published_at",
        "doc_side": "$.pick_side",
        "doc_home_odds": "$.market.home_odds_american",
        "doc_away_odds": "$.market.away_odds_american",
        "doc_pick_odds": "$.pick_american_odds",
        "doc_capped": "$.kelly_was_capped",
        "doc_reason": "$.no_bet_reason",
        "doc_home": "$.home_team_full",
        "doc_away": "$.away_team_full",
        "doc_model": "$.model_version",
        "doc_book": "$.market.sportsbook",
        "doc_notes": "$.notes",
    }
    numbers = {
        "doc_prob": "$.model_prob_home_win",
        "doc_value": "$.expected_value",
        "doc_kelly": "$.kelly_fraction_half",
        "doc_disagreement": "$.disagreement_pp",
        "doc_fair": "$.market.fair_home_prob",
        "doc_vig": "$.market.vig_percent",
        "doc_max_disagreement": "$.max_disagreement_pp_used",
        "doc_max_kelly": "$.max_kelly_fraction_used",
    }
    keys = F.col("keys")
    # A document is parsed once for all fields, and once for its keys.
    read = docs.select("pick_id", "game_date", F.from_json("doc", _document(texts, numbers)).alias("$"), F.json_object_keys("doc").alias("keys"))
    return read.select(
        "pick_id",
        "game_date",
        *[F.col(path).alias(name) for name, path in (texts | numbers).items()],
        F.round(F.col("$.model_features.home_rolling_win_pct"), 2).alias("doc_feature"),
        F.size(keys).alias("n_fields"),
        (keys == F.array_sort(keys)).alias("keys_sorted"),
    )


@query(
    "picks_with_outcomes",
    f"""WITH {DECIDED} SELECT pick_id, pick_side, CASE WHEN game_date = order_date THEN probs.home_won END AS home_won,
      CASE WHEN game_date = order_date THEN CASE pick_side WHEN 'home' THEN probs.home_won WHEN 'away' THEN NOT probs.home_won END END AS pick_won
      FROM picks JOIN probs ON pick_id = game_id""",
)
def outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger keyed by date and teams; results of the order itself, known only
    where the local game date is the order date."""
    results = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("pick_id"),
        F.to_date("o_orderdate").alias("game_date"),
        (F.col("o_totalprice") > 300000).alias("win"),
    )
    made = decisions(spark, sf_dir)[0]
    # Several orders share customer, status and day, so the order id is part of
    # the team code here to make (date, home, away) a key.
    keyed = made.withColumn("home_team_abbr", F.col("pick_id")).withColumn("away_team_abbr", F.lit("A"))
    processed = results.select(
        "game_date",
        F.col("pick_id").alias("team_abbreviation"),
        F.lit("A").alias("opponent_abbreviation"),
        F.lit(True).alias("is_home"),
        "win",
    )
    return picks_with_outcomes(keyed, processed).select("pick_id", "pick_side", "home_won", "pick_won")


_LATEST_COLUMNS = ["games_in_window", "rolling_pts", "rolling_win_pct"]


@query(
    "odds_with_features",
    f"""WITH {GAMES}, {rolled_sql('games', 'current')}, latest AS (
        SELECT team_abbreviation, {', '.join(f'arg_max({c}, (game_date, game_id)) AS {c}' for c in _LATEST_COLUMNS if c != 'rolling_win_pct')},
          arg_max(struct_pack(v := rolling_win_pct), (game_date, game_id)).v AS rolling_win_pct FROM rolled GROUP BY 1)
      SELECT o_orderkey AS game_id, round(h.games_in_window::DOUBLE, 6) AS home_games_in_window, round(h.rolling_pts, 6) AS home_rolling_pts, round(h.rolling_win_pct, 6) AS home_rolling_win_pct,
        h.team_abbreviation IS NOT NULL AS home_known, a.team_abbreviation IS NOT NULL AS away_known, round(a.rolling_pts, 6) AS away_rolling_pts
      FROM orders LEFT JOIN latest h ON h.team_abbreviation = 'C' || o_custkey LEFT JOIN latest a ON a.team_abbreviation = 'C' || (o_orderkey % 2000)""",
)
def odds_with_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games with both teams' newest features; some away teams do not exist."""
    games = customer_games(spark, sf_dir)
    features = trailing(
        games, rolling_outputs(games.columns), window=WINDOW, bound_by=customer_bound(spark, sf_dir)
    )
    fixtures = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("game_id"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("home_team_abbr"),
        F.concat(F.lit("C"), (F.col("o_orderkey") % 2000).cast("string")).alias("away_team_abbr"),
    )
    out = attach_latest(fixtures, features.select("team_abbreviation", "game_date", "game_id", *_LATEST_COLUMNS), _LATEST_COLUMNS)
    numbers = ["home_games_in_window", "home_rolling_pts", "home_rolling_win_pct", "away_rolling_pts"]
    return six(out.select("game_id", "home_known", "away_known", *numbers), *numbers)


@query(
    "pick_features",
    f"""WITH {GAMES}, {rolled_sql('games', 'current')} SELECT game_id, (rolling_pts IS NOT NULL)::INTEGER + (rolling_pts_home IS NOT NULL)::INTEGER + (rolling_pts_away IS NOT NULL)::INTEGER AS n_features,
      round(rolling_pts_home, 6) AS pts_home FROM rolled""",
)
def pick_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit map of the inputs without the missing ones."""
    games = customer_games(spark, sf_dir)
    features = trailing(
        games, rolling_outputs(games.columns), window=WINDOW, bound_by=customer_bound(spark, sf_dir)
    )
    audit = feature_map(["rolling_pts", "rolling_pts_home", "rolling_pts_away"])
    out = features.select("game_id", audit.alias("m"))
    return six(
        out.select("game_id", F.size("m").alias("n_features"), F.try_element_at("m", F.lit("rolling_pts_home")).alias("pts_home")),
        "pts_home",
    )


