"""The star-schema tables read as box scores, games, two-sided games and odds.

Each DataFrame builder has a SQL fragment of the same content beside it, used as
a common table expression by the queries' SQL twins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.functions.scalars import safe_div
from tallyframe.operators.skew import DEFAULT_POLICY, SplitPlan, SplitPolicy, plan_splits
from tallyframe.operators.windows import BOX_ENTITY, BOX_ORDER
from tallyframe.schema import ROLLING_COLUMNS

WINDOW = 10


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def nearest(c: Column) -> Column:
    """Nearest whole number, half away from zero, of a non-negative column."""
    return F.floor(c + 0.5)


def code(key: Column) -> Column:
    """A four-letter code of a number."""
    letters = [F.chr(F.lit(65) + F.shiftright(key, 4 * i) % 16) for i in range(4)]
    return F.concat(*letters)


def code_sql(key: str) -> str:
    letters = " || ".join(f"chr((65 + ({key} // {16**i}) % 16)::INTEGER)" for i in range(4))
    return f"({letters})"


# ---- lineitem as player rows --------------------------------------------------


def box_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as player-game rows: order = game, supplier = team, part = player."""
    li = load(spark, sf_dir, "lineitem")
    reb = F.col("l_quantity").cast("long")
    ast = nearest(F.col("l_discount") * 100)
    tov = nearest(F.col("l_tax") * 100)
    own, other = code(F.col("l_suppkey")), code(F.col("l_partkey"))
    joint = (
        F.when(F.col("l_returnflag") == "R", " vs. ").when(F.col("l_returnflag") == "A", " @ ").otherwise(" - ")
    )
    return li.select(
        F.col("l_orderkey").alias("game_id"),
        F.col("l_suppkey").alias("team_id"),
        F.when(tov > 0, F.concat(F.lit("P"), F.lpad(F.col("l_partkey").cast("string"), 9, "0"))).alias("player_name"),
        F.concat(own, joint, other).alias("matchup"),
        F.when(F.col("l_linestatus") == "F", "W").when(ast > 5, "L").alias("wl"),
        F.floor("l_extendedprice").cast("long").alias("pts"),
        reb.alias("reb"),
        ast.alias("ast"),
        tov.alias("tov"),
        reb.alias("fgm"),
        (reb + ast + 1).alias("fga"),
        tov.alias("fg3m"),
        (ast + tov).alias("fg3a"),
        tov.alias("ftm"),
        tov.alias("fta"),
        F.when(F.col("l_linenumber") == 7, "")
        .when(F.col("l_linenumber") == 6, "DNP")
        .when(F.col("l_linenumber") == 5, "0:00")
        .otherwise(F.concat(reb.cast("string"), F.lit(":30")))
        .alias("min"),
        F.when(ast > 0, F.col("l_discount") * 1000).alias("off_rating"),
        (F.col("l_tax") * 1000).alias("def_rating"),
        F.col("l_quantity").alias("pace"),
    )


BOX = f"""box AS (
  SELECT l_orderkey AS game_id, l_suppkey AS team_id,
    CASE WHEN round(l_tax*100) > 0 THEN 'P' || lpad(l_partkey::VARCHAR, 9, '0') END AS player_name,
    {code_sql('l_suppkey')} || CASE l_returnflag WHEN 'R' THEN ' vs. ' WHEN 'A' THEN ' @ ' ELSE ' - ' END || {code_sql('l_partkey')} AS matchup,
    CASE WHEN l_linestatus = 'F' THEN 'W' WHEN round(l_discount*100) > 5 THEN 'L' END AS wl,
    floor(l_extendedprice)::BIGINT AS pts, l_quantity::BIGINT AS reb,
    round(l_discount*100)::BIGINT AS ast, round(l_tax*100)::BIGINT AS tov,
    l_quantity::BIGINT AS fgm, l_quantity::BIGINT + round(l_discount*100)::BIGINT + 1 AS fga,
    round(l_tax*100)::BIGINT AS fg3m, round(l_discount*100)::BIGINT + round(l_tax*100)::BIGINT AS fg3a,
    round(l_tax*100)::BIGINT AS ftm, round(l_tax*100)::BIGINT AS fta,
    CASE l_linenumber WHEN 7 THEN '' WHEN 6 THEN 'DNP' WHEN 5 THEN '0:00' ELSE l_quantity::BIGINT::VARCHAR || ':30' END AS min,
    CASE WHEN round(l_discount*100) > 0 THEN l_discount*1000 END AS off_rating,
    l_tax*1000 AS def_rating, l_quantity AS pace
  FROM lineitem)"""


# ---- orders as one entity's games ---------------------------------------------


def order_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem folded to one row per order before anything is joined to it."""
    li = load(spark, sf_dir, "lineitem")
    cents = nearest(F.col("l_extendedprice") * 100)
    return li.groupBy(F.col("l_orderkey").alias("game_id")).agg(
        F.sum(F.floor("l_extendedprice").cast("long")).alias("pts"),
        F.sum(F.col("l_quantity").cast("long")).alias("reb"),
        F.sum(nearest(F.col("l_discount") * 100)).alias("ast"),
        F.sum(nearest(F.col("l_tax") * 100)).alias("tov"),
        F.count(F.lit(1)).alias("lines"),
        F.max("l_quantity").alias("pace"),
        # Price in cents above, supplier below: one number, so the whole
        # aggregate stays hash-based.
        F.max(F.shiftleft(cents, 36) + F.col("l_suppkey")).alias("top"),
    ).withColumn("main_supplier", F.col("top") % F.lit(1 << 36)).drop("top")


TOTALS = """totals AS (
  SELECT l_orderkey AS game_id, sum(floor(l_extendedprice)::BIGINT)::BIGINT AS pts, sum(l_quantity::BIGINT)::BIGINT AS reb,
    sum(round(l_discount*100)::BIGINT)::BIGINT AS ast, sum(round(l_tax*100)::BIGINT)::BIGINT AS tov,
    count(*) AS lines, max(l_quantity) AS pace,
    arg_max(l_suppkey, (l_extendedprice, l_suppkey)) AS main_supplier
  FROM lineitem GROUP BY 1)"""


def _metrics() -> dict[str, Column]:
    return {
        "effective_fg_pct": safe_div("reb", F.col("reb") + F.col("ast")),
        "true_shooting_pct": safe_div("ast", F.col("ast") + F.col("tov")),
        "assist_to_turnover": safe_div("ast", "tov"),
        "off_rating": safe_div("pts", "reb"),
        "def_rating": safe_div("reb", "lines"),
        "net_rating": safe_div("pts", "reb") - safe_div("reb", "lines"),
    }


_METRICS_SQL = """reb::DOUBLE / nullif(reb + ast, 0) AS effective_fg_pct,
    ast::DOUBLE / nullif(ast + tov, 0) AS true_shooting_pct, ast::DOUBLE / nullif(tov, 0) AS assist_to_turnover,
    pts::DOUBLE / nullif(reb, 0) AS off_rating, reb::DOUBLE / nullif(lines, 0) AS def_rating,
    pts::DOUBLE / nullif(reb, 0) - reb::DOUBLE / nullif(lines, 0) AS net_rating, pace"""


def customer_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One team-game row per order: the customer is the team. Orientation and
    result are three-valued; orders without lines have no statistics."""
    orders = load(spark, sf_dir, "orders")
    status, priority = F.col("o_orderstatus"), F.substring("o_orderpriority", 1, 1)
    games = orders.select(
        F.year("o_orderdate").alias("season"),
        F.to_date("o_orderdate").alias("game_date"),
        F.col("o_orderkey").alias("game_id"),
        F.when(F.year("o_orderdate") % 2 == 0, "Playoffs").otherwise("Regular Season").alias("season_type"),
        F.col("o_custkey").alias("team_id"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("team_abbreviation"),
        F.concat(F.lit("Q"), priority).alias("opponent_abbreviation"),
        F.when(status == "F", True).when(status == "O", False).alias("is_home"),
        F.when(priority.isin("1", "2"), True).when(priority == "5", False).alias("win"),
    )
    return games.join(order_totals(spark, sf_dir), "game_id", "left").withColumns(_metrics())


GAMES = f"""{TOTALS},
games AS (
  SELECT year(o_orderdate)::INTEGER AS season, o_orderdate::DATE AS game_date, o_orderkey AS game_id,
    CASE WHEN year(o_orderdate) % 2 = 0 THEN 'Playoffs' ELSE 'Regular Season' END AS season_type,
    o_custkey AS team_id, 'C' || o_custkey AS team_abbreviation, 'Q' || substr(o_orderpriority, 1, 1) AS opponent_abbreviation,
    CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS is_home,
    CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN true WHEN substr(o_orderpriority, 1, 1) = '5' THEN false END AS win,
    pts, reb, ast, tov, lines, main_supplier,
    {_METRICS_SQL}
  FROM orders LEFT JOIN totals ON o_orderkey = totals.game_id)"""


def customer_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many rows per team as :func:`customer_games` has, from one column."""
    return load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("team_id"))


# ---- orders as two-sided games --------------------------------------------------


def _sided_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    priority = F.substring("o_orderpriority", 1, 1)
    flat = orders.select(
        F.year("o_orderdate").alias("season"),
        F.to_date("o_orderdate").alias("game_date"),
        F.col("o_orderkey").alias("game_id"),
        F.col("o_custkey"),
        priority.isin("1", "2", "3").alias("home_won"),
        F.when(F.col("o_orderstatus") != "P", True).alias("home_flag"),
    ).join(order_totals(spark, sf_dir), "game_id", "left")
    # Only the side is exploded, so that columns nobody asks for are never read or moved.
    both, one = F.array(F.lit(True), F.lit(False)), F.array(F.lit(True))
    sides = F.explode(F.when(F.col("main_supplier").isNotNull(), both).otherwise(one))
    flat = flat.withColumn("at_home", sides)

    def side(home: Column, away: Column) -> Column:
        return F.when(F.col("at_home"), home).otherwise(away)

    customer, supplier = F.col("o_custkey"), F.col("main_supplier")
    return flat.select(
        "season",
        "game_date",
        "game_id",
        "reb",
        "ast",
        "tov",
        "lines",
        "pace",
        F.concat(side(F.lit("C"), F.lit("S")), side(customer, supplier).cast("string")).alias("team_abbreviation"),
        # Suppliers get negative ids, so the two kinds of team never share one.
        side(customer, -supplier - 1).alias("team_id"),
        side(F.col("home_flag"), F.lit(False)).alias("is_home"),
        side(F.col("home_won"), ~F.col("home_won")).alias("win"),
        side(F.col("pts"), F.col("pts") - F.col("reb")).alias("pts"),
    )


def sided_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rows per order: customer at home, the order's main supplier away.

    Orders under way (status P) have no orientation on the home row, and orders
    without lines have no away row: both are unusable games.
    """
    return _sided_rows(spark, sf_dir).withColumns(_metrics())


SIDED = f"""{TOTALS},
flat AS (
  SELECT year(o_orderdate)::INTEGER AS season, o_orderdate::DATE AS game_date, o_orderkey AS game_id, o_custkey,
    substr(o_orderpriority, 1, 1) IN ('1', '2', '3') AS home_won,
    CASE WHEN o_orderstatus <> 'P' THEN true END AS home_flag, totals.* EXCLUDE (game_id)
  FROM orders LEFT JOIN totals ON o_orderkey = totals.game_id),
sided0 AS (
  SELECT season, game_date, game_id, 'C' || o_custkey AS team_abbreviation, o_custkey AS team_id, home_flag AS is_home, home_won AS win,
    pts, reb, ast, tov, lines, pace FROM flat
  UNION ALL
  SELECT season, game_date, game_id, 'S' || main_supplier, -main_supplier - 1, false, NOT home_won,
    pts - reb, reb, ast, tov, lines, pace FROM flat WHERE main_supplier IS NOT NULL),
sided AS (
  SELECT season, game_date, game_id, team_abbreviation, team_id, is_home, win, pts, reb, ast, tov, {_METRICS_SQL} FROM sided0)"""


def sided_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At least as many rows per team as :func:`sided_games`: every line of a
    supplier instead of its orders."""
    suppliers = load(spark, sf_dir, "lineitem").select((-F.col("l_suppkey") - 1).alias("team_id"))
    return customer_bound(spark, sf_dir).unionByName(suppliers)


def sided_by_team(
    spark: SparkSession, sf_dir: str, policy: SplitPolicy = DEFAULT_POLICY
) -> tuple[DataFrame, SplitPlan]:
    """:func:`sided_games` and their cuts for windows over teams.

    While no team is cut, rows are dealt by team before the ratios are worked out,
    as the counts they are made of are narrower. A team to be cut is not gathered first.
    """
    games = sided_games(spark, sf_dir)
    plan = plan_splits(games, BOX_ENTITY, BOX_ORDER, WINDOW, policy, sided_bound(spark, sf_dir))
    if plan.active:
        return games, plan
    return _sided_rows(spark, sf_dir).repartition(*BOX_ENTITY).withColumns(_metrics()), plan


# ---- rolling columns ------------------------------------------------------------

ROLLING_SQL = {
    "games_in_window": "count(game_id) OVER {w}",
    "rolling_pts": "avg(pts::DOUBLE) OVER {w}",
    "rolling_efg_pct": "avg(effective_fg_pct) OVER {w}",
    "rolling_ts_pct": "avg(true_shooting_pct) OVER {w}",
    "rolling_ast_to_tov": "avg(assist_to_turnover) OVER {w}",
    "rolling_win_pct": "avg(win::INTEGER) OVER {w}",
    "rolling_pts_home": "avg(CASE WHEN is_home THEN pts::DOUBLE END) OVER {w}",
    "rolling_pts_away": "avg(CASE WHEN NOT is_home THEN pts::DOUBLE END) OVER {w}",
    "rolling_ortg": "avg(off_rating) OVER {w}",
    "rolling_drtg": "avg(def_rating) OVER {w}",
    "rolling_net_rtg": "avg(net_rating) OVER {w}",
    "rolling_pace": "avg(pace) OVER {w}",
}
assert list(ROLLING_SQL) == ROLLING_COLUMNS


def rolled_sql(source: str, frame: str, name: str = "rolled", window: int = WINDOW) -> str:
    """A CTE adding the twelve rolling columns; ``frame`` is ``current`` or ``prior``."""
    rows = f"ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW"
    if frame == "prior":
        rows = f"ROWS BETWEEN {window} PRECEDING AND 1 PRECEDING"
    columns = ", ".join(f"{v.format(w='w')} AS {k}" for k, v in ROLLING_SQL.items())
    return (
        f"{name} AS (SELECT season, game_date, game_id, team_id, team_abbreviation, is_home, win, {columns} "
        f"FROM {source} WINDOW w AS (PARTITION BY team_id ORDER BY game_date, game_id {rows}))"
    )


def to_six(c: str) -> Column:
    """Six decimals, half away from zero, on plain doubles."""
    x = F.col(f"`{c}`") if "." not in c else F.col(c)
    return F.signum(x) * F.floor(F.abs(x) * 1e6 + 0.5) / 1e6 + 0.0


def six(df: DataFrame, *columns: str) -> DataFrame:
    """Doubles at six decimals, as both engines may add in another order."""
    return df.withColumns({c: to_six(c) for c in columns})


def six_sql(columns, prefix: str = "") -> str:
    return ", ".join(f"round({prefix}{c}, 6) AS {c}" for c in columns)


# ---- odds -----------------------------------------------------------------------

BOOKS = ["pinnacle", "book_b", "book_c"]


def odds_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested odds document per order, built from the order's own columns."""
    o = load(spark, sf_dir, "orders")
    cents = nearest(F.col("o_totalprice") * 100)
    home, away = _team_names()
    start = F.date_add(F.to_date("o_orderdate"), 0).cast("timestamp") + F.make_dt_interval(
        hours=(F.col("o_orderkey") % 24).cast("int")
    )

    def outcome(name: Column, price: Column, point: Column) -> Column:
        return F.struct(name.alias("name"), price.cast("int").alias("price"), point.cast("double").alias("point"))

    def book(i: int, key: str) -> Column:
        fav = -(cents % 150 + 110 + i)
        dog = (cents % 120) + 100 - i
        moneyline = F.struct(
            F.lit("h2h").alias("key"),
            F.array(outcome(home, fav, F.lit(None)), outcome(away, dog, F.lit(None))).alias("outcomes"),
        )
        totals = F.struct(
            F.lit("totals").alias("key"),
            F.array(
                outcome(F.lit("Over"), F.lit(-110), cents % 40 + 200.5), outcome(F.lit("Under"), F.lit(-112), cents % 40 + 200.5)
            ).alias("outcomes"),
        )
        return F.struct(F.lit(key).alias("key"), F.array(moneyline, totals).alias("markets"))

    books = F.array(*[book(i, k) for i, k in enumerate(BOOKS)])
    # Cancelled quotes: no books at all, or none from the anchor.
    kept = F.when(F.col("o_orderpriority") == "5-LOW", F.slice(books, 2, 2)).otherwise(books)
    return o.select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.date_format(start, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("commence_time"),
        home.alias("home_team"),
        away.alias("away_team"),
        kept.alias("bookmakers"),
    )


def _team_names() -> tuple[Column, Column]:
    home = F.concat(F.lit("Customer "), F.col("o_custkey").cast("string"))
    away = F.concat(F.lit("Status "), F.col("o_orderstatus"))
    return home, away


ODDS_SQL = """quotes AS (
  SELECT o_orderkey::VARCHAR AS game_id,
    o_orderdate::DATE::TIMESTAMP + to_hours((o_orderkey % 24)::INTEGER) AS commence_ts,
    'Customer ' || o_custkey AS home_team, 'Status ' || o_orderstatus AS away_team,
    round(o_totalprice*100)::BIGINT AS cents, o_orderpriority,
    unnest([{'b': 'pinnacle', 'i': 0}, {'b': 'book_b', 'i': 1}, {'b': 'book_c', 'i': 2}]) AS book
  FROM orders),
kept AS (SELECT * FROM quotes WHERE NOT (o_orderpriority = '5-LOW' AND book.i = 0)),
odds AS (
  SELECT game_id, ((commence_ts AT TIME ZONE 'UTC') AT TIME ZONE 'US/Eastern')::DATE AS game_date, commence_ts,
    home_team, away_team, book.b AS sportsbook, unnest(m).mt AS market_type, unnest(m).n AS outcome_name,
    unnest(m).p::INTEGER AS price, unnest(m).pt::DOUBLE AS point
  FROM (SELECT *, [
    {'mt': 'h2h', 'n': home_team, 'p': -(cents % 150 + 110 + book.i), 'pt': NULL::DOUBLE},
    {'mt': 'h2h', 'n': away_team, 'p': (cents % 120) + 100 - book.i, 'pt': NULL::DOUBLE},
    {'mt': 'totals', 'n': 'Over', 'p': -110, 'pt': (cents % 40 + 200.5)::DOUBLE},
    {'mt': 'totals', 'n': 'Under', 'p': -112, 'pt': (cents % 40 + 200.5)::DOUBLE}] AS m FROM kept))"""
