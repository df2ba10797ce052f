"""Trailing windows, lags, latest rows and as-of joins per entity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.schema import ADVANCED_COLUMNS, ROLLING, ROLLING_COLUMNS, conform

from .skew import DEFAULT_POLICY, SplitPlan, SplitPolicy, assign_chunks, plan_splits, window_input

DEFAULT_WINDOW = 10
BOX_ENTITY = ("team_id",)
BOX_ORDER = ("game_date", "game_id")


def _checked(window: int) -> int:
    if window < 1:
        raise ValueError(f"window must be >= 1, got {window}")
    return window


def trailing(
    df: DataFrame,
    outputs: dict[str, Column],
    entity: Sequence[str] = BOX_ENTITY,
    order: Sequence[str] = BOX_ORDER,
    window: int = DEFAULT_WINDOW,
    include_current: bool = True,
    policy: SplitPolicy = DEFAULT_POLICY,
    splits: SplitPlan | None = None,
    bound_by: DataFrame | None = None,
) -> DataFrame:
    """Add aggregates over the last ``window`` rows of each entity.

    ``outputs`` maps names to plain aggregates (``F.avg("pts")``). All share one
    window, hence one shuffle and one sort. With ``include_current=False`` the
    frame ends before the current row: what was known on entering the event.
    ``splits`` reuses a :func:`plan_splits` result with enough look-back;
    ``bound_by`` lets the check for large entities read a cheaper frame.
    """
    _checked(window)
    lookback = window - 1 if include_current else window
    plan = splits or plan_splits(df, entity, order, lookback, policy, bound_by)
    if plan.active and plan.lookback < lookback:
        raise ValueError(f"split plan looks back {plan.lookback} rows, {lookback} needed")
    source = window_input(df, plan)
    frame = Window.partitionBy(*source.partition_cols).orderBy(*order)
    frame = frame.rowsBetween(-(window - 1), 0) if include_current else frame.rowsBetween(-window, -1)
    return source.finish(source.rows.withColumns({n: agg.over(frame) for n, agg in outputs.items()}))


def rolling_outputs(columns: Sequence[str]) -> dict[str, Column]:
    """The twelve rolling statistics of a team-game row; sources that are absent
    give NULL."""
    points = F.col("pts").cast("double")
    outputs = {
        "games_in_window": F.count("game_id"),
        "rolling_pts": F.avg(points),
        "rolling_efg_pct": F.avg("effective_fg_pct"),
        "rolling_ts_pct": F.avg("true_shooting_pct"),
        "rolling_ast_to_tov": F.avg("assist_to_turnover"),
        "rolling_win_pct": F.avg(F.col("win").cast("int")),
        "rolling_pts_home": F.avg(F.when(F.col("is_home"), points)),
        "rolling_pts_away": F.avg(F.when(~F.col("is_home"), points)),
    }
    sources = dict(zip(ADVANCED_COLUMNS, ROLLING_COLUMNS[8:], strict=True))
    outputs.update({out: F.avg(src) for src, out in sources.items() if src in columns})
    return outputs


def rolling_features(
    df: DataFrame,
    window: int = DEFAULT_WINDOW,
    include_current: bool = True,
    policy: SplitPolicy = DEFAULT_POLICY,
    bound_by: DataFrame | None = None,
) -> DataFrame:
    """Team-game rows to rolling features in the declared schema.

    Windows run across seasons, as one team's games are one sequence.
    """
    rolled = trailing(
        df,
        rolling_outputs(df.columns),
        window=window,
        include_current=include_current,
        policy=policy,
        bound_by=bound_by,
    )
    return conform(rolled, ROLLING)


def lagged(
    df: DataFrame,
    columns: Sequence[str],
    entity: Sequence[str] = BOX_ENTITY,
    order: Sequence[str] = BOX_ORDER,
    prefix: str = "lag_",
    policy: SplitPolicy = DEFAULT_POLICY,
    splits: SplitPlan | None = None,
    bound_by: DataFrame | None = None,
) -> DataFrame:
    """Each column's value one event earlier; NULL on an entity's first event."""
    plan = splits or plan_splits(df, entity, order, 1, policy, bound_by)
    source = window_input(df, plan)
    by_entity = Window.partitionBy(*source.partition_cols).orderBy(*order)
    return source.finish(
        source.rows.withColumns({f"{prefix}{c}": F.lag(c, 1).over(by_entity) for c in columns})
    )


def drop_first_event(df: DataFrame, sentinel: str = "lag_games_in_window") -> DataFrame:
    """Remove rows without history. Only the sentinel decides: other lagged
    columns may be NULL for good reasons."""
    return df.filter(F.col(sentinel).isNotNull())


def latest_per_entity(
    df: DataFrame, entity: Sequence[str] = ("team_abbreviation",), order: Sequence[str] = BOX_ORDER
) -> DataFrame:
    """The last row of each entity. An aggregate, so every task first reduces its
    rows to one per entity and a hot entity costs nothing extra."""
    rest = [c for c in df.columns if c not in entity]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("__row")
    return df.groupBy(*entity).agg(newest).select(*entity, "__row.*").select(*df.columns)


def leaderboard_order(df: DataFrame, metric: str = "rolling_ts_pct", tie: Sequence[str] = ()) -> DataFrame:
    """Best first, missing last."""
    return df.orderBy(F.col(metric).desc_nulls_last(), *tie)


def trajectories(
    df: DataFrame,
    entities: Sequence,
    metrics: Sequence[str],
    entity: str = "team_abbreviation",
    order: Sequence[str] = BOX_ORDER,
) -> DataFrame:
    """Ordered metric series of the chosen entities, tagged by entity."""
    return (
        df.filter(F.col(entity).isin(list(entities)))
        .select(entity, *order, *metrics)
        .orderBy(entity, *order)
    )


def asof_join(
    left: DataFrame,
    right: DataFrame,
    entity: str,
    left_time: str,
    right_order: Sequence[str],
    values: Sequence[str],
    prefix: str = "",
    allow_equal: bool = False,
    left_entity: str | None = None,
    policy: SplitPolicy = DEFAULT_POLICY,
    bound_by: DataFrame | None = None,
) -> DataFrame:
    """Every left row with the latest right row of its entity before it.

    Both sides are stacked and read once in time order, so the cost is one
    shuffle and no pair of rows is ever formed. A hot entity is cut into chunks;
    the last right row of the earlier chunks (one row per chunk) is handed to
    each chunk, so the look-back is unlimited.

    ``right_order`` starts with the time column; further columns break ties.
    Strictly before unless ``allow_equal``. ``bound_by`` is a cheaper frame with,
    under ``entity``, at least as many rows of each entity as both sides together.
    """
    time, *ties = right_order
    own = F.col(left_entity or entity)
    placed = own.isNotNull() & F.col(left_time).isNotNull()
    # Rows without entity or time match nothing and stay out of the sort.
    unplaced, left = left.filter(~placed), left.filter(placed)
    # A row without entity or time precedes nothing.
    right = right.filter(F.col(entity).isNotNull() & F.col(time).isNotNull())
    payload = F.struct(*[F.col(v) for v in values])
    no_payload = F.lit(None).cast(right.select(payload.alias("p")).schema["p"].dataType)
    left_first = F.lit(1 if allow_equal else 0)
    right_side = F.lit(0 if allow_equal else 1)
    no_row = F.lit(None).cast(left.select(F.struct("*").alias("r")).schema["r"].dataType)
    # A left row's tie columns are irrelevant: only its side of the date counts.
    stacked_left = left.select(
        F.col(left_entity or entity).alias("__entity"),
        F.col(left_time).alias("__time"),
        left_first.alias("__side"),
        *[F.lit(None).cast(right.schema[t].dataType).alias(f"__tie{i}") for i, t in enumerate(ties)],
        F.xxhash64(*left.columns).alias("__spread"),
        F.struct("*").alias("__left"),
        no_payload.alias("__right"),
    )
    stacked_right = right.select(
        F.col(entity).alias("__entity"),
        F.col(time).alias("__time"),
        right_side.alias("__side"),
        *[F.col(t).alias(f"__tie{i}") for i, t in enumerate(ties)],
        F.lit(0).cast("long").alias("__spread"),
        no_row.alias("__left"),
        payload.alias("__right"),
    )
    rows = stacked_left.unionByName(stacked_right)
    order = ["__time", "__side", *[f"__tie{i}" for i in range(len(ties))], "__spread"]
    bound = None if bound_by is None else bound_by.select(F.col(entity).alias("__entity"))
    plan = plan_splits(rows, ["__entity"], order, 1, policy, bound)
    keys = ["__entity"]
    if plan.active:
        rows = assign_chunks(rows, plan)
        keys = ["__entity", "__chunk"]
        carried = _carry_in(rows, order)
    seen = F.last("__right", ignorenulls=True).over(
        Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    rows = rows.withColumn("__seen", seen).filter(F.col("__left").isNotNull())
    if plan.active:
        rows = rows.join(F.broadcast(carried), keys, "left").withColumn(
            "__seen", F.coalesce("__seen", "__carried")
        )
    found = [F.col(f"__seen.{v}").alias(f"{prefix}{v}") for v in values]
    missing = [F.lit(None).cast(right.schema[v].dataType).alias(f"{prefix}{v}") for v in values]
    return rows.select("__left.*", *found).unionByName(unplaced.select("*", *missing))


def _carry_in(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Last right row before each chunk of a cut entity. One row per chunk goes
    in and out, so both window and broadcast are bounded by the number of cuts."""
    tails = (
        rows.filter(F.col("__bounds").isNotNull())
        .groupBy("__entity", "__chunk")
        .agg(
            F.max_by("__right", F.when(F.col("__right").isNotNull(), F.struct(*order))).alias("__tail")
        )
    )
    earlier = (
        Window.partitionBy("__entity").orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    return tails.select(
        "__entity", "__chunk", F.last("__tail", ignorenulls=True).over(earlier).alias("__carried")
    )

